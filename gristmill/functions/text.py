"""Text, date, licence and url expressions (survey 2.N)."""

from __future__ import annotations

import unicodedata
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def collapse(text: Column) -> Column:
    """White-space runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def match_key(text: Column) -> Column:
    """Lower-cased collapsed text: the key of equal statements."""
    return F.lower(collapse(text))


def slug(text: Column) -> Column:
    """Lower case, what is no letter or digit becomes one '-', none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"[^\p{L}\p{N}]+", "-"), "^-+|-+$", "")


def strip_number(name: Column) -> Column:
    """A numeric suffix removed, unless nothing would be left."""
    cut = F.regexp_replace(name, r"[-#]\d+$", "")
    return F.when(cut == "", name).otherwise(cut)


def parse_time(text: Column, formats: tuple[str, ...] = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH-mm-ss", "yyyy-MM-dd")) -> Column:
    """The first format that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def date_bucket(text: Column) -> Column:
    """The first 10 characters, or date-unknown."""
    return F.coalesce(F.nullif(F.substring(text, 1, 10), F.lit("")), F.lit("date-unknown"))


def licence_id(text: Column) -> Column:
    """A canonical id from a licence url or short name, null if none is known."""
    t = F.lower(F.trim(text))
    cc = F.regexp_extract(t, r"(?:licenses/|cc[ -])(by(?:-nc)?(?:-sa|-nd)?)[/ -](\d\.\d)", 1)
    version = F.regexp_extract(t, r"(?:licenses/|cc[ -])(by(?:-nc)?(?:-sa|-nd)?)[/ -](\d\.\d)", 2)
    return F.when(cc != "", F.concat(F.lit("cc-"), cc, F.lit("-"), version)).when(t.rlike("cc0|publicdomain/zero"), "cc0-1.0").when(t.rlike("public domain"), "public-domain").when(t.rlike("apache"), "apache-2.0").when(t.rlike(r"\bmit\b"), "mit").when(t.rlike("general public license"), "gpl")


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode normal form C."""
    return text.map(lambda t: unicodedata.normalize("NFC", t) if t is not None else None)


@F.pandas_udf(T.StringType())
def casefold(text: pd.Series) -> pd.Series:
    """Full case folding, where lower() would differ."""
    return text.map(lambda t: t.casefold() if t is not None else None)


@F.pandas_udf(T.StringType())
def join_url(base: pd.Series, link: pd.Series) -> pd.Series:
    """A link resolved against the page it stands on."""
    return pd.Series([urljoin(b, x) if b is not None and x is not None else None for b, x in zip(base, link, strict=True)], dtype=object)


@F.pandas_udf(T.StringType())
def base36(hex_text: pd.Series) -> pd.Series:
    """A hex number of any length in base 36."""

    def one(h: str | None) -> str | None:
        if h is None:
            return None
        n, out = int(h, 16), ""
        while n:
            n, d = divmod(n, 36)
            out = "0123456789abcdefghijklmnopqrstuvwxyz"[d] + out
        return out or "0"

    return hex_text.map(one)
