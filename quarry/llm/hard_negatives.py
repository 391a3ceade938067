"""Hard-negative mining by coordinate pruning over length buckets.

Vectors are cut into blocks of one length class; a block holds its vectors and, for every
coordinate, the list of its rows in the order of that coordinate's value in the unit vector.  An
anchor that needs a score of at least ``low`` needs from a block the local cosine ``low / (|anchor| * longest)``.
That cosine bounds each coordinate of a vector that can reach it: the ranges of the anchor's largest
(focus) coordinates are cut out of the sorted lists by binary search, and only rows that all of these lists
hold are verified by whole integer products.  Where the cosine is too small for the ranges to exclude
anything, all rows of the block are verified.

Anchors are broadcast in groups of at most about ``GROUP``, one after the other; blocks stay where they lie and move
once, when they are made.  Blocks are searched in rounds, each sixteen times the one before; what a round
finds raises the bounds of the next, so the rows that leave the tasks of a round are some
multiple of what is asked for, whatever the number of blocks.  First come the positives (the best rows of the anchor's label),
then, with the ranges of scores they set, the negatives.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component (scaled ones
too) take no part; shorter vectors count as padded with zeros; rows with the anchor's id are neither its
positives nor its negatives; of anchor rows with one id the one of the smallest label, then vector, asks; other repeated
rows count one by one; ties go to the smaller id; a positive of negative score has no negatives; products beyond a long
saturate; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import shared_path, staged
from quarry.llm.vectors import below, best, floored, from_bytes, in_blocks, matrix_of, products, to_bytes, usable

#: Expected vectors in a block, anchors in a broadcast group, growth of the rounds.
BLOCK, GROUP, GROWTH = 2048, 2048, 16
#: Focus coordinates of an anchor, and the local cosine from which their ranges are looked up.
FOCUS, COORD_FROM = 4, 0.5
PER_ANCHOR, PER_POSITIVE, STRIDE, SCALE = 5, 5, 100, 256
#: A negative scores between this share (in percent) of its positive's score and that score.
LEAST = 80

BLOCK_TYPE = "block long, n int, dims int, longest double, ids binary, labels binary, data binary, lists binary"
FOUND_TYPE = "anchor_id long, place int, score long, vec_id long"


def _units(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length = np.linalg.norm(data, axis=1)
    return length, data / np.where(length == 0, 1, length)[:, None]


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    """One row of a block, with the sorted list of every coordinate."""
    data = matrix_of(list(group["v"]))
    length, unit = _units(data)
    lists = np.argsort(unit, axis=0, kind="stable").astype(np.int32)
    return pd.DataFrame({
        "block": [group["block"].iloc[0]], "n": [len(group)], "dims": [data.shape[1]], "longest": [length.max()],
        "ids": [group["vec_id"].to_numpy(np.int64).tobytes()], "labels": [group["label"].to_numpy(np.int64).tobytes()],
        "data": [to_bytes(data)], "lists": [lists.tobytes()]})


class Block:
    def __init__(self, row):
        self.ids, self.labels = np.frombuffer(row.ids, np.int64), np.frombuffer(row.labels, np.int64)
        self.data, self.longest = from_bytes(row.data, row.n, row.dims), row.longest
        self.lists = np.frombuffer(row.lists, np.int32).reshape(row.n, row.dims)
        self.sorted = np.take_along_axis(_units(self.data)[1], self.lists, axis=0)

    def feasible(self, unit: np.ndarray, cosine: float) -> np.ndarray | None:
        """Rows whose focus coordinates allow this cosine with ``unit``; None: all rows."""
        held, lists = None, 0
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            if f >= self.sorted.shape[1]:
                continue  # all rows have 0 there
            spread = np.sqrt(max(0.0, (1 - cosine**2) * (1 - unit[f] ** 2)))
            low = -1.0 if -unit[f] >= cosine else unit[f] * cosine - spread
            high = 1.0 if unit[f] >= cosine else unit[f] * cosine + spread
            start, stop = np.searchsorted(self.sorted[:, f], [low - 1e-9, high + 1e-9])
            if stop - start < len(self.ids):
                held = np.zeros(len(self.ids), np.int8) if held is None else held
                held[self.lists[start:stop, f]] += 1
                lists += 1
        return None if held is None else (held == lists).nonzero()[0]


class Anchors:
    """A group of anchors: ids, labels, vectors."""

    def __init__(self, rows: list):
        self.ids = np.array([r.vec_id for r in rows], np.int64)
        self.labels = np.array([r.label for r in rows], np.int64)
        self.data = matrix_of([r.v for r in rows])
        self.length, self.unit = _units(self.data)
        self.place = {int(x): i for i, x in enumerate(self.ids)}


def verified(anchors: Anchors, block: Block, low: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, scores) of the rows that may reach the anchor's ``low``; infinite: it asks for nothing."""
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(low > 0, low / (anchors.length * max(block.longest, 1e-300)), -np.inf)
    able = cosine <= 1 + 1e-9  # not so for infinities and, with a positive low, for anchors of zeros
    every = np.arange(len(block.ids))
    whole = (able & (cosine < COORD_FROM)).nonzero()[0].tolist()
    for a in (able & (cosine >= COORD_FROM)).nonzero()[0]:
        rows = block.feasible(anchors.unit[a], min(1.0, cosine[a]))
        if rows is None:
            whole.append(a)
        elif len(rows):
            yield a, rows, products(anchors.data[a : a + 1], block.data[rows])[0]
    if whole:
        for a, scores in zip(whole, products(anchors.data[whole], block.data), strict=True):
            yield a, every, scores


def _merged(old: list, ids: np.ndarray, scores: np.ndarray, k: int) -> list:
    return sorted(old + best(ids, scores, k))[:k]


def _rows(found: dict) -> pd.DataFrame:
    rows = [(a, place, -s, c) for (a, place), best_ in found.items() for s, c in best_]
    return pd.DataFrame(rows, columns=["anchor_id", "place", "score", "vec_id"]).astype(
        {"anchor_id": "int64", "place": "int32", "score": "int64", "vec_id": "int64"})


def _positives(held, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors, low = held.value
        low, found = low.copy(), {}
        for batch in batches:
            for block in map(Block, batch.itertuples()):
                asks = np.where(np.isin(anchors.labels, block.labels), low, np.inf)
                for a, rows, scores in verified(anchors, block, asks):
                    own = (block.labels[rows] == anchors.labels[a]) & (block.ids[rows] != anchors.ids[a]) & (scores >= low[a])
                    if own.any():
                        key = int(anchors.ids[a]), 0
                        found[key] = _merged(found.get(key, []), block.ids[rows[own]], scores[own], k)
                        if len(found[key]) == k:
                            low[a] = max(low[a], below(-found[key][-1][0]))
        yield _rows(found)

    return run


def _negatives(held, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors, low, top = held.value  # (anchor, place of its positive): bounds; infinite and None without one
        low, found = low.copy(), {}
        for batch in batches:
            for block in map(Block, batch.itertuples()):
                for a, rows, scores in verified(anchors, block, low.min(axis=1)):
                    other = (block.labels[rows] != anchors.labels[a]) & (block.ids[rows] != anchors.ids[a]) & (scores >= low[a].min())
                    ids, scores = block.ids[rows[other]], scores[other]
                    for place, high in enumerate(top[a] if len(ids) else []):
                        if high is None:
                            continue
                        fits = (scores >= low[a, place]) & (scores <= high)
                        if fits.any():
                            key = int(anchors.ids[a]), place
                            found[key] = _merged(found.get(key, []), ids[fits], scores[fits], k)
                            if len(found[key]) == k:
                                low[a, place] = max(low[a, place], below(-found[key][-1][0]))
        yield _rows(found)

    return run


def _kept(found: DataFrame, k: int) -> DataFrame:
    """The k best of each (anchor, place), with rank."""
    order = Window.partitionBy("anchor_id", "place").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(embeddings: DataFrame, vector: str = "embedding", label: str = "label", per_anchor: int = PER_ANCHOR,
         per_positive: int = PER_POSITIVE, stride: int = STRIDE, scale: int = SCALE, least: int = LEAST,
         block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; anchors have ids divisible by ``stride``."""
    spark = embeddings.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col(label).isNotNull() & usable(F.col(vector), scale)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), floored(F.col(vector), scale).alias("v"))
    cut, n = in_blocks(rows, block)
    rounds = 0
    while n > block * GROWTH**rounds:
        rounds += 1
    spread = max(2 * spark.sparkContext.defaultParallelism, n // (8 * block))
    packed = cut.repartition(spread, "block").groupBy("block").applyInPandas(_pack, BLOCK_TYPE)
    share = F.pmod(F.xxhash64("block"), F.lit(GROWTH**rounds))
    turn = sum([F.when(share >= GROWTH**i, 1).otherwise(0) for i in range(rounds)], F.lit(0))
    blocks = staged(packed.withColumn("turn", turn), "blocks")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")  # rows here are whole blocks
    asked = rows.where(F.col("vec_id") % stride == 0).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.*")
    asked = staged(asked, "anchors")
    groups = -(-asked.count() // group)
    if not groups:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    first, second = shared_path(spark, "positives"), shared_path(spark, "negatives")
    in_group = F.pmod(F.xxhash64("vec_id"), F.lit(groups))
    found = {p: spark.read.schema(f"{FOUND_TYPE}, grp int, turn int") for p in (first, second)}

    def searched(task, values, k: int, path: str, number: int) -> Iterator[list]:
        """Runs ``task`` over the blocks, a round at a time; yields the k best so far of the anchors of the group."""
        for i in range(rounds + 1):
            held = spark.sparkContext.broadcast(values())
            part = blocks.where(F.col("turn") == i).mapInPandas(task(held, k), FOUND_TYPE)
            part.write.mode("append").parquet(f"{path}/grp={number}/turn={i}")
            held.destroy()
            yield _kept(found[path].parquet(path).where(F.col("grp") == number), k).collect()  # at most k for each bound of a group

    for number in range(groups):
        anchors = Anchors(asked.where(in_group == number).collect())
        if not len(anchors.ids):
            continue
        low = np.full(len(anchors.ids), -np.inf)
        best_: list = []
        for best_ in searched(_positives, lambda: (anchors, low), per_anchor, first, number):  # noqa: B023
            for r in best_:
                if r.rank == per_anchor:
                    low[anchors.place[r.anchor_id]] = below(r.score)
        floor, top = np.full((len(low), per_anchor), np.inf), [[None] * per_anchor for _ in low]
        for r in best_:
            if r.score >= 0:
                a = anchors.place[r.anchor_id]
                floor[a, r.rank - 1] = below(-(-least * r.score // 100))
                top[a][r.rank - 1] = r.score
        for best_ in searched(_negatives, lambda: (anchors, floor, top), per_positive, second, number):  # noqa: B023
            for r in best_:
                if r.rank == per_positive:
                    floor[anchors.place[r.anchor_id], r.place] = below(r.score)

    positives = _kept(found[first].parquet(first), per_anchor).select(
        "anchor_id", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    negatives = _kept(found[second].parquet(second), per_positive).select(
        "anchor_id", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (positives.join(negatives, ["anchor_id", "place"])
            .where(least * F.col("positive_score") <= 100 * F.col("negative_score"))
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
