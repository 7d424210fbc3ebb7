"""Hashes of decoded images. Decoding stays outside: pixels come in as bytes or numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SIDE, KEPT = 32, 8


def pixel_digest(pixels: Column, width: Column, height: Column) -> Column:
    """SHA-256 of the RGB bytes behind a header of their size."""
    head = F.encode(F.concat(width.cast("string"), F.lit("x"), height.cast("string"), F.lit("\u0000RGB\u0000")), "UTF-8")
    return F.sha2(F.concat(head, pixels), 256)


def cosine_basis(n: int = SIDE) -> np.ndarray:
    k, x = np.arange(n)[:, None], np.arange(n)[None, :]
    basis = np.cos(np.pi * (2 * x + 1) * k / (2 * n)) * np.sqrt(2 / n)
    basis[0] /= np.sqrt(2)
    return basis


def perceptual_hashes(gray: np.ndarray) -> list[str]:
    """The 64-bit hash of each row of 32 x 32 gray values: which of the 8 x 8 lowest cosine
    coefficients exceed their median, the first the highest bit."""
    basis = cosine_basis()
    low = np.einsum("ij,njk,lk->nil", basis[:KEPT], gray.reshape(-1, SIDE, SIDE), basis[:KEPT]).reshape(-1, KEPT * KEPT)
    bits = low > np.median(low, axis=1, keepdims=True)
    return [np.packbits(b).tobytes().hex() for b in bits]


def perceptual_hash(gray: Column) -> Column:
    """Of an array of 1024 gray values; null unless it is one."""

    @F.pandas_udf(StringType())
    def hashed(values: pd.Series) -> pd.Series:
        fine = values.map(lambda v: v is not None and len(v) == SIDE * SIDE)
        out = pd.Series([None] * len(values), index=values.index, dtype=object)
        if fine.any():
            out[fine] = perceptual_hashes(np.stack(values[fine].to_numpy()).astype(float))
        return out

    return hashed(gray)
