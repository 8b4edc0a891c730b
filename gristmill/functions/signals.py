"""Signals held in arrays (survey 2.F)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StructType([T.StructField("place", T.IntegerType()), T.StructField("score", T.DoubleType())]))
def contained_offset(reference: pd.Series, part: pd.Series) -> pd.DataFrame:
    """Where a shorter signal fits best into a longer one, by normalised correlation.

    Null for a part without variation or longer than the reference. Ties go to the first place.
    """
    out = []
    for r, q in zip(reference, part, strict=True):
        if r is None or q is None or not 0 < len(q) <= len(r):
            out.append((None, None))
            continue
        r, q = np.asarray(r, dtype=np.float64), np.asarray(q, dtype=np.float64)
        q = q - q.mean()
        norm = np.sqrt(q @ q)
        if norm <= 1e-8:
            out.append((None, None))
            continue
        n, size = len(q), len(r) + len(q)
        dot = np.fft.irfft(np.fft.rfft(r, size) * np.conj(np.fft.rfft(q, size)), size)[: len(r) - n + 1]
        s, s2 = np.concatenate(([0.0], np.cumsum(r))), np.concatenate(([0.0], np.cumsum(r * r)))
        spread = np.maximum(s2[n:] - s2[:-n] - (s[n:] - s[:-n]) ** 2 / n, 1e-12)
        score = np.round(dot / (np.sqrt(spread) * norm), 9)
        at = int(np.argmax(score))
        out.append((at, float(score[at])))
    return pd.DataFrame(out, columns=["place", "score"]).astype({"place": "Int32"})
