"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into blocks of bounded size (a length class is cut
by a hash of the id when it holds more).  In a block each query gets its local threshold, the cosine that a candidate
needs to reach the query's k-th score so far, and is pruned by coordinates (high thresholds) or by length
(low ones); surviving candidates are verified by whole integer products.

Blocks move once, when they are made, and are searched where they lie.  Queries are broadcast in groups of at
most about ``GROUP``, one after the other, and search the blocks in rounds, each sixteen times the one
before: the scores that a round finds are the bounds of the next.  Only a query's k best of a
task's blocks that reach its bound leave the task, so what a round moves is some multiple of k for each
query, however many blocks there are.  No vector pair is ever a row.  The query set is stated: ids divisible by ``stride``.

Defined cases: vectors that are null or hold null or non-finite components take no
part, as query or candidate; shorter vectors count as padded with zeros; a query isn't its own
candidate, nor is any row with its id; of query rows with one id the smallest vector asks; null ids take no part; ties go to the
smaller id; components that leave the doubles when scaled count as non-finite, products beyond a long saturate; no candidates: no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import shared_path, staged
from quarry.llm.vectors import below, matrix_of

#: Vectors in a block and queries in a broadcast group, expected; growth of the rounds.
BLOCK, GROUP, GROWTH = 1024, 4096, 16
#: Length classes a doubling of the length.
CLASSES = 8
#: Local thresholds (cosines) from which coordinates prune, and how many are looked at.
COORD_FROM, FOCUS = 0.7, 3
#: Products are exact in double precision below this.
EXACT = 2.0**53
LONG = 2**63 - 1

BLOCK_TYPE = "block long, n int, dims int, longest double, ids binary, data binary"


def scaled(embeddings: DataFrame, vector: str = "embedding", scale: int = 64) -> DataFrame:
    """vec_id and v, the floor of each component times ``scale``; rows that take no part are gone."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < F.lit(float("inf"))))
    floor = F.transform(x, lambda c: c * scale - F.pmod(c * scale, F.lit(1.0)))
    return embeddings.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), floor.alias("v"))


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    """One row of a block: vectors by descending length, then id."""
    dims = max(map(len, group["v"]))
    data = np.zeros((len(group), dims))
    for i, v in enumerate(group["v"]):
        data[i, : len(v)] = np.floor(v)
    ids, length = group["vec_id"].to_numpy(np.int64), np.linalg.norm(data, axis=1)
    order = np.lexsort((ids, -length))
    return pd.DataFrame({"block": [group["block"].iloc[0]], "n": [len(group)], "dims": [dims], "longest": [length.max()],
                         "ids": [ids[order].tobytes()], "data": [_bytes(data[order])]})


def _bytes(data: np.ndarray) -> bytes:
    small = np.abs(data).max(initial=0) < 2**15
    return (b"s" if small else b"d") + data.astype(np.int16 if small else np.float64).tobytes()


def _matrix(raw: bytes, n: int, dims: int) -> np.ndarray:
    return np.frombuffer(raw, np.int16 if raw[:1] == b"s" else np.float64, offset=1).reshape(n, dims).astype(np.float64)


def blocked(vectors: DataFrame, size: int, spread: int) -> DataFrame:
    """Blocks of about ``size`` vectors of one length class each."""
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    classes = vectors.withColumn("class", F.floor(F.least(F.log2(square + 1), F.lit(1025.0)) * CLASSES / 2).cast("long"))
    # At most 1024 * CLASSES classes exist: doubles have no longer vectors.
    counts = classes.groupBy("class").agg(F.count(F.lit(1)).alias("in_class"))
    parts = F.ceil(F.col("in_class") / size)
    return (classes.join(F.broadcast(counts), "class")
            .withColumn("block", F.col("class") * (1 << 40) + F.pmod(F.xxhash64("vec_id"), parts))
            .select("block", "vec_id", "v").repartition(spread, "block").groupBy("block").applyInPandas(_pack, BLOCK_TYPE))


def _products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    dims = min(queries.shape[1], data.shape[1])
    q, d = queries[:, :dims], data[:, :dims]
    if np.abs(q).max(initial=0) * np.abs(d).max(initial=0) * max(dims, 1) < EXACT:
        return q @ d.T
    whole = np.array([[int(x) for x in row] for row in q], object).reshape(q.shape) @ np.array(
        [[int(x) for x in row] for row in d], object).reshape(d.shape).T
    return np.clip(whole, -LONG, LONG)


def _by_coordinates(query: np.ndarray, cosine: float, unit: np.ndarray) -> np.ndarray:
    """Candidates (rows of ``unit``) whose focus coordinates allow this cosine with the query."""
    alive = np.ones(len(unit), bool)
    for f in np.argsort(-np.abs(query))[:FOCUS]:
        spread = np.sqrt(max(0.0, (1 - cosine**2) * (1 - query[f] ** 2)))
        alive &= np.abs(unit[:, f] - query[f] * cosine) <= np.where(
            np.sign(query[f]) * unit[:, f] > np.abs(query[f]) * cosine, np.inf, spread + 1e-9)
    return alive.nonzero()[0]


def search(q_ids, queries, bounds, c_ids, data, k):
    """Yields (query row, ids, scores): the k best of this block that reach the query's bound."""
    q_len, c_len = np.linalg.norm(queries, axis=1), np.linalg.norm(data, axis=1)
    unit = data / np.where(c_len == 0, 1, c_len)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(bounds > 0, bounds / (q_len * max(c_len.max(initial=0), 1e-300)), -np.inf)
    open_ = (local <= 1 + 1e-9).nonzero()[0]
    by_coord = open_[local[open_] >= COORD_FROM]
    by_length = open_[local[open_] < COORD_FROM]
    for i in by_coord:
        rows = _by_coordinates(queries[i] / max(q_len[i], 1e-300), min(1.0, local[i]), unit)
        yield from _best(q_ids[i : i + 1], _products(queries[i : i + 1], data[rows]), bounds[i : i + 1], c_ids[rows], k, [i])
    if len(by_length):
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(bounds[by_length] > 0, bounds[by_length] / q_len[by_length], 0).min()
        reach = int(np.searchsorted(-c_len, -need + 1e-9, side="right"))  # a prefix: blocks go by length
        yield from _best(q_ids[by_length], _products(queries[by_length], data[:reach]), bounds[by_length], c_ids[:reach], k, by_length)


def _best(q_ids, scores, bounds, c_ids, k, numbers):
    for row, number in enumerate(numbers):
        able = ((c_ids != q_ids[row]) & (scores[row] >= bounds[row])).nonzero()[0]
        if len(able) > 4 * k:  # no tie of the k-th is lost
            kth = np.partition(scores[row][able], len(able) - k)[len(able) - k]
            able = able[scores[row][able] >= kth]
        able = able[np.lexsort((c_ids[able], -scores[row][able].astype(np.float64)))][:k] if scores.dtype != object else np.array(
            sorted(able, key=lambda j: (-scores[row][j], c_ids[j]))[:k], int)
        if len(able):
            yield number, c_ids[able], [int(x) for x in scores[row][able]]


def _merge(best: dict, found, k: int) -> None:
    """best: query row -> its k best (-score, vec_id) so far."""
    for number, ids, scores in found:
        best[number] = sorted([*best.get(number, []), *zip([-s for s in scores], map(int, ids), strict=True)])[:k]


FOUND_TYPE = "query_id long, score long, vec_id long"


def _searched(held, k: int):
    """The task function: each query's k best of the blocks of a partition, among those that reach its bound."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, queries, bounds = held.value
        bounds, best = bounds.copy(), {}
        for batch in batches:
            for b in batch.itertuples():
                _merge(best, search(ids, queries, bounds, np.frombuffer(b.ids, np.int64), _matrix(b.data, b.n, b.dims), k), k)
                for i, found in best.items():
                    if len(found) == k:
                        bounds[i] = max(bounds[i], below(-found[-1][0]))
        rows = [(int(ids[i]), -s, c) for i, found in best.items() for s, c in found]
        yield pd.DataFrame(rows, columns=["query_id", "score", "vec_id"]).astype("int64")

    return run


def top_k(embeddings: DataFrame, vector: str = "embedding", k: int = 20, stride: int = 20, scale: int = 64,
          block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest products of each query, ids divisible by ``stride``."""
    spark = embeddings.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    vectors = scaled(embeddings, vector, scale)
    n, rounds = vectors.count(), 0
    while n > block * GROWTH**rounds:
        rounds += 1
    share = F.pmod(F.xxhash64("block"), F.lit(GROWTH**rounds))
    turn = sum([F.when(share >= GROWTH**i, 1).otherwise(0) for i in range(rounds)], F.lit(0))
    spread = max(2 * spark.sparkContext.defaultParallelism, n // (8 * block))
    blocks = staged(blocked(vectors, block, spread).withColumn("turn", turn), "blocks")
    asked = staged(vectors.where(F.col("vec_id") % stride == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    groups = -(-asked.count() // group)
    if not groups:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")  # rows here are whole blocks
    path = shared_path(spark, "found")
    found = spark.read.schema(f"{FOUND_TYPE}, grp int, turn int")
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = lambda rows: rows.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    for number in range(groups):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == number).collect()  # a group's queries
        ids, queries = np.array([r.vec_id for r in rows], np.int64), matrix_of([r.v for r in rows])
        at = {int(x): i for i, x in enumerate(ids)}
        bounds = np.full(len(rows), -np.inf)
        for i in range(rounds + 1 if rows else 0):
            held = spark.sparkContext.broadcast((ids, queries, bounds))
            part = blocks.where(F.col("turn") == i).mapInPandas(_searched(held, k), FOUND_TYPE)
            part.write.mode("append").parquet(f"{path}/grp={number}/turn={i}")
            held.destroy()
            if i < rounds:  # a bound for each query of the group
                for r in best(found.parquet(path).where(F.col("grp") == number)).where(F.col("rank") == k).select("query_id", "score").collect():
                    bounds[at[r.query_id]] = below(r.score)
    return best(found.parquet(path)).select("query_id", "rank", "vec_id", "score")
