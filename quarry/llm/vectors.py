"""Whole-number vectors: taking part, packing into rows of blocks, exact products."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Products are exact in double precision below this.
EXACT = 2.0**53
LONG = 2**63 - 1
#: Length classes a doubling of the length.
CLASSES = 8


def usable(vector: Column, scale: int) -> Column:
    """The vector has no null and no non-finite component, before and after scaling."""
    x = F.transform(vector, lambda c: c.cast("double"))
    return vector.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < F.lit(float("inf"))))


def floored(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x, as doubles."""
    x = F.transform(vector, lambda c: c.cast("double") * scale)
    return F.transform(x, lambda c: c - F.pmod(c, F.lit(1.0)))


def length_class(v: Column) -> Column:
    """Classes of similar length; at most 1024 * CLASSES: doubles have no longer vectors."""
    square = F.aggregate(v, F.lit(0.0), lambda a, c: a + c * c)
    return F.floor(F.least(F.log2(square + 1), F.lit(2049.0)) * CLASSES / 2).cast("long")


def in_blocks(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """``rows`` (vec_id, v and more) with a block number: about ``size`` rows of one length class; and the number of rows."""
    classes = rows.withColumn("class", length_class(F.col("v")))
    counts = classes.groupBy("class").agg(F.count(F.lit(1)).alias("in_class")).collect()  # bounded: see length_class
    if not counts:
        return classes.withColumn("block", F.col("class")).drop("class"), 0
    parts = F.coalesce(*[F.when(F.col("class") == r["class"], -(-r.in_class // size)) for r in counts], F.lit(1))
    block = F.col("class") * (1 << 40) + F.pmod(F.xxhash64("vec_id"), parts)
    return classes.withColumn("block", block).drop("class"), sum(r.in_class for r in counts)


def matrix_of(vectors) -> np.ndarray:
    """Rows of one width; shorter vectors are padded with zeros."""
    dims = max(map(len, vectors), default=0)
    data = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        data[i, : len(v)] = np.floor(v)
    return data


def to_bytes(data: np.ndarray) -> bytes:
    small = np.abs(data).max(initial=0) < 2**15
    return (b"s" if small else b"d") + data.astype(np.int16 if small else np.float64).tobytes()


def from_bytes(raw: bytes, n: int, dims: int) -> np.ndarray:
    return np.frombuffer(raw, np.int16 if raw[:1] == b"s" else np.float64, offset=1).reshape(n, dims).astype(np.float64)


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products: doubles below 2^53, else Python integers (cut to longs)."""
    dims = min(queries.shape[1], data.shape[1])
    q, d = queries[:, :dims], data[:, :dims]
    if np.abs(q).max(initial=0) * np.abs(d).max(initial=0) * max(dims, 1) < EXACT:
        return q @ d.T
    whole = np.array([[int(x) for x in row] for row in q], object).reshape(q.shape) @ np.array(
        [[int(x) for x in row] for row in d], object).reshape(d.shape).T
    return np.clip(whole, -LONG, LONG)


def below(bounds: np.ndarray) -> np.ndarray:
    """Bounds as doubles that no rounding has raised."""
    out = np.asarray(bounds, np.float64)
    return np.where(np.abs(out) < EXACT, out, out - np.abs(out) * 1e-12)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (-score, id), ties to smaller ids."""
    if len(ids) > 4 * k and scores.dtype != object:  # no tie of the k-th is lost
        able = scores >= np.partition(scores, len(ids) - k)[len(ids) - k]
        ids, scores = ids[able], scores[able]
    return sorted(zip((-int(s) for s in scores), map(int, ids), strict=True))[:k]
