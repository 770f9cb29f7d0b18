"""MinHash signatures, bands and their similarity.

The family is ((a x + b) mod 2**64) mod (2**61 - 1): the product wraps at 64 bits before
the modulus. Two shingle hashes are offered: ``blake2b`` (default) and ``md5``, which SQL
engines can reproduce. Signatures are computed on whole Arrow batches, one permutation
at a time over the shingles of all rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

PRIME = (1 << 61) - 1
MAX_HASH = (1 << 32) - 1
NUM_PERM, NUM_BANDS, SHINGLE, SEED, THRESHOLD = 128, 16, 5, 1337, 0.8


def coefficients(num_perm: int = NUM_PERM, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers in [1, p) and offsets in [0, p) from NumPy's default generator."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, PRIME, size=num_perm, dtype=np.uint64)
    return a, rng.integers(0, PRIME, size=num_perm, dtype=np.uint64)


def _digest(kind: str):
    if kind == "blake2b":
        return lambda b: hashlib.blake2b(b, digest_size=4).digest()
    if kind == "md5":
        return lambda b: hashlib.md5(b, usedforsecurity=False).digest()[:4]
    raise ValueError(f"unknown shingle hash {kind!r}")


def shingles(text: str, n: int = SHINGLE, kind: str = "blake2b") -> set[int]:
    """The 32-bit hashes of a text's runs of ``n`` words; a shorter text is one shingle, as it is."""
    digest, w = _digest(kind), text.split()
    units = [text] if len(w) < n else [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]
    return {int.from_bytes(digest(u.encode("utf-8", "surrogatepass")), "big") for u in units}


def signatures_of(values: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(rows, num_perm) minima; a row without values has 2**32 - 1 throughout."""
    rows = len(bounds) - 1
    out = np.full((rows, len(a)), MAX_HASH, np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    starts, p = bounds[:-1][full], np.uint64(PRIME)
    for i in range(len(a)):
        v = values * a[i]
        v += b[i]
        v = (v & p) + (v >> np.uint64(61))  # v mod p up to one p
        v[v >= p] -= p
        out[full, i] = np.minimum.reduceat(v, starts)
    return out


def similarity_of(left: np.ndarray, right: np.ndarray) -> float:
    """The share of equal positions."""
    return float((left == right).mean())


def _signer(key: str, text: str, n: int, kind: str, a: np.ndarray, b: np.ndarray, rows: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                sets = [shingles(t, n, kind) for t in part.column(text).to_pylist()]
                bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                values = np.fromiter((x for s in sets for x in s), np.uint64, bounds[-1])
                sig = signatures_of(values, bounds, a, b).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(key), pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, len(a), dtype=np.int32)), pa.array(sig.reshape(-1)))], [key, "sig"])

    return run


def signatures(df: DataFrame, key: str = "ord", text: str = "text", n: int = SHINGLE, num_perm: int = NUM_PERM, seed: int = SEED, kind: str = "blake2b") -> DataFrame:
    """(key, sig): the signature of every non-null text."""
    _digest(kind)
    a, b = coefficients(num_perm, seed)
    rows = df.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias(key), text)
    return rows.mapInArrow(_signer(key, text, n, kind, a, b), f"{key} long, sig array<long>")


def bands(df: DataFrame, num_bands: int = NUM_BANDS, num_perm: int = NUM_PERM, sig: str = "sig") -> DataFrame:
    """``df`` with one row per band: ``band`` and its ``bucket`` (the band's positions); positions that fill no band are unused."""
    if not 1 <= num_bands <= num_perm:
        raise ValueError("num_bands must be between 1 and num_perm")
    rows = num_perm // num_bands
    cut = F.array(*(F.struct(F.lit(i).alias("band"), F.slice(sig, i * rows + 1, rows).alias("bucket")) for i in range(num_bands)))
    return df.withColumn("_b", F.explode(cut)).select("*", "_b.band", "_b.bucket").drop("_b")


def similarity(left: Column | str, right: Column | str, num_perm: int = NUM_PERM) -> Column:
    """Share of equal positions of two signature columns."""
    same = F.aggregate(F.zip_with(left, right, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, v: s + v)
    return same / F.lit(float(num_perm))


