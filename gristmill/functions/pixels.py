"""Hashes and measures of decoded images (survey 2.Q).

An image is a row of ``width, height`` and its pixels: a binary of height x width x 3 bytes (RGB).
Decoding files is left to the caller. All functions run over Arrow batches, an image at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Weights of the grey level, in 65536ths.
LUMA = np.array([19595, 38470, 7471], dtype=np.int64)


def grey(rgb: np.ndarray) -> np.ndarray:
    """The grey level of each pixel, rounded."""
    return ((rgb.astype(np.int64) @ LUMA + 0x8000) >> 16).astype(np.uint8)


def _weights(size: int, out: int, lobes: int) -> np.ndarray:
    """[out, size] weights of a windowed-sinc (``lobes`` 3) or triangle (1) filter, wider where it shrinks."""
    scale = max(size / out, 1.0)
    x = (np.arange(size)[None, :] + 0.5 - ((np.arange(out) + 0.5) * size / out)[:, None]) / scale
    w = np.sinc(x) * np.sinc(x / lobes) * (np.abs(x) < lobes) if lobes > 1 else np.maximum(0, 1 - np.abs(x))
    return w / w.sum(axis=1, keepdims=True)


def resized(image: np.ndarray, width: int, height: int, lobes: int = 3) -> np.ndarray:
    """``image`` (rows, columns[, channels]) resampled, rounded to bytes after each direction."""
    to_bytes = lambda a: np.clip(np.floor(a + 0.5), 0, 255)
    a = image.astype(np.float64)
    a = a[:, :, None] if a.ndim == 2 else a
    if a.shape[1] != width:
        a = to_bytes(np.einsum("ox,yxc->yoc", _weights(a.shape[1], width, lobes), a))
    if a.shape[0] != height:
        a = to_bytes(np.einsum("oy,yxc->oxc", _weights(a.shape[0], height, lobes), a))
    return a.astype(np.uint8).reshape(height, width, *image.shape[2:])


def _hex(bits: np.ndarray) -> str:
    return np.packbits(bits.ravel()).tobytes().hex()


def difference_hash(rgb: np.ndarray) -> str:
    """Whether each of 8 x 8 places is brighter than its right neighbour (Q1)."""
    g = resized(grey(rgb), 9, 8).astype(int)
    return _hex(g[:, :-1] > g[:, 1:])


def perceptual_hash(rgb: np.ndarray) -> str:
    """Which of the 8 x 8 lowest cosine coefficients of 32 x 32 places exceed their median (Q2)."""
    n = np.arange(32)
    cosine = 2 * np.cos(np.pi * np.outer(n, 2 * n + 1) / 64)
    low = (cosine @ resized(grey(rgb), 32, 32).astype(np.float64) @ cosine.T)[:8, :8]
    return _hex(low > np.median(low))


def pixel_digest(rgb: np.ndarray) -> str:
    """sha256 over width, height (4 bytes each, the high one first) and the pixels (Q3)."""
    height, width, _ = rgb.shape
    return hashlib.sha256(width.to_bytes(4, "big") + height.to_bytes(4, "big") + rgb.tobytes()).hexdigest()


def thumbnail_digest(rgb: np.ndarray) -> str:
    """sha256 over a 32 x 32 thumbnail whose bytes keep their five high bits (Q4)."""
    return hashlib.sha256((resized(rgb, 32, 32) & 0xF8).tobytes()).hexdigest()


def light(rgb: np.ndarray) -> tuple[float, float, float]:
    """(brightness, contrast, edge energy) of 256 x 256 grey places, as shares of 255 (Q5).

    Edges: eight times a place less its neighbours, cut to a byte; border places as they are.
    """
    g = resized(grey(rgb), 256, 256, 1).astype(np.int64)
    around = sum(g[1 + y : 255 + y, 1 + x : 255 + x] for y in (-1, 0, 1) for x in (-1, 0, 1))
    edges = g.copy()
    edges[1:-1, 1:-1] = np.clip(9 * g[1:-1, 1:-1] - around, 0, 255)
    return float(g.mean() / 255), float(g.std() / 255), float(edges.mean() / 255)


_TEXT, _NUMBER = ("dhash", "phash", "pixels", "thumbnail"), ("brightness", "contrast", "edges")
_OUT = T.StructType([T.StructField(n, T.StringType()) for n in _TEXT] + [T.StructField(n, T.DoubleType()) for n in _NUMBER])


@F.pandas_udf(_OUT)
def image_marks(width: pd.Series, height: pd.Series, pixels: pd.Series) -> pd.DataFrame:
    """All hashes and measures of an image; nulls where its bytes are not width x height x 3."""
    rows = []
    for w, h, raw in zip(width, height, pixels, strict=True):
        if raw is None or w is None or h is None or not w > 0 or len(raw) != w * h * 3:
            rows.append((None,) * 7)
            continue
        rgb = np.frombuffer(raw, dtype=np.uint8).reshape(int(h), int(w), 3)
        rows.append((difference_hash(rgb), perceptual_hash(rgb), pixel_digest(rgb), thumbnail_digest(rgb), *light(rgb)))
    return pd.DataFrame(rows, columns=[*_TEXT, *_NUMBER])
