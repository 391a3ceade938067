"""Packing token sequences by best-fit decreasing.

Documents are tokenised, each with an end token, and cut: overlong ones give full
windows first, the rest is one piece.  Pieces go by descending length into the
open window with the least room that still takes them; a segment tree over the remaining capacities
0..window, holding the number of open windows of each, finds it.

Best fit depends on lengths alone, and windows with equal room are interchangeable,
so the packing is computed for the histogram of lengths (at most ``window`` rows,
whatever the data): all pieces of a length that go to windows of one capacity are
placed in one step, as ranges of piece ranks and window numbers.  This plan is bounded
by the window size; every piece then finds its sequence and offset from its rank
among the pieces of its length.  The task that cuts the texts numbers its pieces of each length, and
counts of (task, length) cells give every task its first rank of each length; the pieces are stored bucketed by
task, so they meet these ranks where they lie, and token ids move only once, to their sequence.

Texts below U+0250 without the file's special strings are split by the tokenizer's
own pattern and their pieces encoded by its model through a table of bounded size; all other
texts are encoded whole.  Both are what the ``tokenizers`` library gives for the text.

Defined cases: null or empty text is a piece of the end token alone; repeated rows are packed as
often as they occur; null ids are allowed; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, shared_path, text_or_empty
from quarry.llm.pieces import EXOTIC, Memo, byte_level

WINDOW, END = 1024, 0
#: Distinct pieces kept in each of a worker's two generations.
MEMO = 200_000
#: The byte-level pre-tokenizer's pattern (fixed value, public), for texts without exotic characters.
PATTERN = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.memo = Memo(self._piece, MEMO)
        #: All ids fit 16 bits.
        self.short = self.lib.get_vocab_size(with_added_tokens=True) <= 1 << 16

    def _piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(byte_level(piece))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if EXOTIC.search(text) or any(s in text for s in self.special):
            ids = self.lib.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.memo.__getitem__, PATTERN.findall(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class CapacityTree:
    """Segment tree over capacities 0..window: the number of open windows of each."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.sums = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        at = capacity + self.size
        while at:
            self.sums[at] += n
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity >= least that has an open window."""
        at = least + self.size
        while not self.sums[at]:
            while at & 1:  # a right child: nothing further right below this parent
                at >>= 1
                if at <= 1:
                    return None
            at += 1
            if at & (at - 1) == 0:  # past the last leaf of this level
                return None
        while at < self.size:
            at = 2 * at if self.sums[2 * at] else 2 * at + 1
        return at - self.size


def plan(counts: dict[int, int], window: int = WINDOW) -> tuple[list[tuple], int]:
    """Steps (length, first rank, pieces, first window, pieces a window, offset) and the number of windows.

    The piece of rank r in a step goes to window first + (r - first rank) // pieces a window.
    """
    tree, ranges, steps, made = CapacityTree(window), {}, [], 0  # ranges: capacity -> [(first window, n)]

    def opened(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            ranges.setdefault(capacity, []).append((first, n))
            tree.add(capacity, n)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, each = window, window // length
                first, n = made, -(-left // each)
                made += n
            else:
                first, n = ranges[capacity].pop()
                each = capacity // length  # the fullest window stays the tightest until it takes no more
                tree.add(capacity, -n)
            whole = min(n, left // each)
            if whole:
                steps.append((length, rank, whole * each, first, each, window - capacity))
                opened(capacity - each * length, first, whole)
                rank, left = rank + whole * each, left - whole * each
            if whole < n:
                if left:  # fewer pieces than this window takes
                    steps.append((length, rank, left, first + whole, each, window - capacity))
                    opened(capacity - left * length, first + whole, 1)
                    left, whole = 0, whole + 1
                opened(capacity, first + whole, n - whole)
    return steps, made


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, digest: bool = False) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens of every piece of every text, and part, nth: its task and number among the task's pieces of its length.

    ``ids``: the piece's token ids as little-endian unsigned numbers of 16 bits if the vocabulary allows it, else of 32;
    with ``digest`` the CRC32 of the 32-bit ones, ``ids_crc32``, in their place.  Stored, bucketed by ``part``.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    last = np.array([end], "<u4").tobytes()
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen = TaskContext.get().partitionId(), [0] * (window + 1)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encoder(path).encode(text) + last
                total = len(ids) // 4
                for s in range(0, total, window):
                    length, own = min(window, total - s), ids[4 * s : 4 * (s + window)]
                    if digest:
                        own = zlib.crc32(own)
                    elif encoder(path).short:
                        own = np.frombuffer(own, "<u4").astype("<u2").tobytes()
                    rows.append((doc, s, length, own, total, part, seen[length]))
                    seen[length] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", content.split()[0], "doc_tokens", "part", "nth"])

    plain = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
    content = "ids_crc32 long" if digest else "ids binary"
    cuts = plain.mapInPandas(cut, f"doc_id string, start long, length long, {content}, doc_tokens long, part int, nth long")
    table = f"pieces_{uuid.uuid4().hex}"
    (cuts.withColumn("doc_id", F.col("doc_id").cast(kind)).write.format("parquet").option("path", shared_path(spark, "pieces"))
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").saveAsTable(table))
    return spark.table(table)


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset of every piece."""
    return place(pieces(docs, path, window, end), window)


def place(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """The columns of ``pieces`` without part and nth, and sequence_id and offset of every piece."""
    cells = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.length: r.n for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``window`` rows
    steps, _ = plan(counts, window)
    grouped: dict[int, list] = {}
    for s in steps:
        grouped.setdefault(s[0], []).append(s[1:])
    table = {length: tuple(np.array(col, np.int64) for col in zip(*rows, strict=True)) for length, rows in grouped.items()}

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        encoder.cache_clear()  # the worker may be one that cut texts: its table isn't needed any more
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for one in np.unique(lengths):
            rows = (lengths == one).nonzero()[0]
            first, _, window_, each, used = table[int(one)]
            step = np.searchsorted(first, ranks[rows], side="right") - 1
            inside = ranks[rows] - first[step]
            sequence[rows] = window_[step] + inside // each[step]
            offset[rows] = used[step] + inside % each[step] * one
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # A row a task: at most ``window`` first ranks, by length.
    firsts = starts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("firsts"))
    ranked = cut.join(firsts.hint("shuffle_hash"), "part").withColumn("rank", F.try_element_at("firsts", F.col("length")) + F.col("nth"))
    return ranked.withColumn("at", placed("length", "rank")).select(
        *[c for c in cut.columns if c not in ("part", "nth")], "at.sequence_id", "at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and the pieces (doc_id, start, length, doc_tokens, offset) of every packed sequence.

    ``ids``: the token ids of the whole sequence as little-endian unsigned 32-bit numbers, its pieces in order of their
    offsets; a row has ``window`` ids at most.
    """
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "doc_tokens")))
    # Moved as they are: ids gain nothing from an aggregation before the shuffle.
    rows = packed.repartition("sequence_id").groupBy("sequence_id").agg(F.expr("listagg(ids) WITHIN GROUP (ORDER BY offset)").alias("ids"), inside.alias("all"))
    parts = F.transform("all", lambda p: F.struct(*[p[c].alias(c) for c in ("doc_id", "start", "length", "doc_tokens", "offset")]))
    total = F.aggregate("all", F.lit(0).cast("long"), lambda n, p: n + p["length"])
    wide = F.when(F.octet_length("ids") == 4 * total, F.col("ids")).otherwise(F.unhex(F.regexp_replace(F.hex("ids"), "(.{4})", "$10000")))
    return rows.select("sequence_id", wide.alias("ids"), parts.alias("pieces"))


def piece_index(made: DataFrame) -> DataFrame:
    """What ``place`` gives for pieces with digests, read back from ``sequences``: every piece with the CRC32 of its ids at its offset."""
    each = made.select("sequence_id", "ids", F.explode("pieces").alias("p"))
    part = F.substring("ids", (4 * F.col("p.offset") + 1).cast("int"), (4 * F.col("p.length")).cast("int"))
    return each.select("p.doc_id", "p.start", "p.length", F.crc32(part).alias("ids_crc32"), "p.doc_tokens", "sequence_id", "p.offset")
