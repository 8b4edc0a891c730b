"""Content and identity hashes, split buckets, 64-bit signatures (survey 2.K, 2.N)."""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sha256_prefix(text: Column, digits: int = 8) -> Column:
    """The first hex digits of sha256 as a number."""
    return F.conv(F.substring(F.sha2(text, 256), 1, digits), 16, 10).cast("long")


def split_bucket(key: Column, seed: str = "seed", train: int = 7000, validation: int = 8500) -> Column:
    """70/15/15 by the first 4 bytes of sha256("seed:key") mod 10000 (K1)."""
    b = F.pmod(sha256_prefix(F.concat(F.lit(seed + ":"), key)), F.lit(10000))
    return F.when(b < train, "train").when(b < validation, "validation").otherwise("test")


def unit_interval(key: Column) -> Column:
    """The first 8 hex digits of sha256 over 0xFFFFFFFF."""
    return sha256_prefix(key) / F.lit(4294967295.0)


def unit_split(key: Column, train: float = 0.65, validation: float = 0.80) -> Column:
    """65/15/20 by the hash unit interval (K3)."""
    u = unit_interval(key)
    return F.when(u < train, "train").when(u < validation, "validation").otherwise("test")


def mod10_split(key: Column) -> Column:
    """0: validation, 1: test, else train (K4)."""
    b = F.pmod(sha256_prefix(key), F.lit(10))
    return F.when(b == 0, "validation").when(b == 1, "test").otherwise("train")


def sha256_mod(key: Column, modulus: int = 10000) -> Column:
    """The whole 256-bit sha256 modulo a small number, by Horner's rule over its bytes (K5)."""
    digits = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.conv(F.substring(F.sha2(key, 256), i * 2 + 1, F.lit(2)), 16, 10).cast("long"))
    return F.aggregate(digits, F.lit(0).cast("long"), lambda a, d: (a * 256 + d) % modulus)


@F.pandas_udf(T.LongType())
def blake2b_mod100(key: pd.Series) -> pd.Series:
    """blake2b-64 of the text modulo 100 (K2); not built in, hence a vectorised function."""
    return key.map(lambda k: int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "big") % 100 if k is not None else None)


def hamming(a: Column, b: Column) -> Column:
    """Bits in which two 64-bit signatures differ; the sign bit counts like any other."""
    return F.bit_count(a.bitwiseXOR(b))


def hex64(text: Column) -> Column:
    """16 hex digits as a signed 64-bit number."""
    return F.conv(text, 16, -10).cast("long")


def band_masks(radius: int, match: int = 2) -> list[int]:
    """Masks of all choices of ``match`` of radius + match bit blocks: within the radius two signatures
    agree under at least one (N4, D15). With 25 bits a choice (radius 3) rows that are not near seldom meet."""
    n = radius + match
    cuts = [64 * i // n for i in range(n + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(block, match)]


def sign_signature(vector: Column) -> Column:
    """One bit per component, set where it is positive: the signature twin of an image hash (Q2)."""
    return F.aggregate(F.transform(vector, lambda x, i: F.when(x > 0, F.expr("1L")).otherwise(F.expr("0L"))), F.lit(0).cast("long"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b))


def ordered_digest(column: Column, sep: str = "\n") -> Column:
    """sha256 over the sorted values joined by ``sep``."""
    return F.sha2(F.array_join(F.sort_array(F.collect_list(column)), sep), 256)


class _Words(dict):
    """The first 8 bytes of the md5 of each word met; long words are not kept."""

    def __missing__(self, word: bytes) -> bytes:
        h = hashlib.md5(word).digest()[:8]
        if len(word) <= 64:
            if len(self) > 500_000:
                self.clear()
            self[word] = h
        return h


_SEEN = _Words()
#: The bits of each byte, a byte each, as one number: sums of up to 255 of them do not carry.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()
#: Words summed before lanes are widened, and words of a text taken at a time.
_LANE, _PART = 255, 255 * 64


def _signature(text: str | None) -> int | None:
    words = text.encode().split() if text else None  # bytes split at \x20 and \x09-\x0D, and nowhere else
    if not words:
        return None
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(words), _PART):
        part = np.frombuffer(b"".join(map(_SEEN.__getitem__, words[at : at + _PART])), dtype=np.uint8).reshape(-1, 8)
        sums = np.add.reduceat(_SPREAD[part], np.arange(0, len(part), _LANE), axis=0)
        ones += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(words)).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def _simhash(text: pd.Series) -> pd.Series:
    return pd.Series([_signature(t) for t in text], dtype="Int64")


def simhash(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``id, sig`` and ``more``: our 64-bit signature twin of an image hash, from md5 of each word (Q2).

    Bit i is set where more words have it than not. Row by row, each distinct word hashed once a
    worker, bits counted eight lanes at a time; a text without words has no row. Those go before: a test of
    the signature would be pushed below it by Spark and sign each text twice.
    """
    return df.where(F.col(text_col).rlike(r"[^\x20\x09-\x0D]")).select(F.col(id_col).alias("id"), _simhash(F.col(text_col)).alias("sig"), *more)
