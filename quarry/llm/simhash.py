"""Near-duplicates by SimHash and pigeonhole blocks.

A fingerprint has a bit set if over half of the document's word shingles' hashes
(XXH64, seed 42) have it.  Fingerprints within ``distance`` bits link; a component
is named by its smallest doc_id.

Equal texts and equal fingerprints fold into one row first.  The 64 bits
are cut into ``BLOCKS`` pieces; fingerprints within 2 bits agree on at
least ``BLOCKS`` - 2 of them, so close pairs meet in a bucket of some choice of that many
pieces, where the Hamming distance is verified.  A bucket of more than
``BUCKET`` fingerprints emits no pairs: each of its fingerprints is joined with the
ones that share a neighbour (one bit flipped) instead; two fingerprints are within 2 bits exactly if
their one-bit neighbourhoods meet, so the links are the same.  Components grow by
joins that hook each node to its smallest neighbour and then shorten the paths, one staged table a round.

Defined cases: null or word-less text has fingerprint zero and links like any other; fewer words than a
shingle make one shingle; a component of null ids only has a null name; repeated rows
get a row each; an empty table gives an empty result; further columns are ignored by ``components``
and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, staged, text_or_empty

SHINGLE, DISTANCE = 3, 2
#: Pieces of a fingerprint; more pieces make buckets smaller and choices more.
BLOCKS = 4
#: Fingerprints in a bucket up to which its pairs are compared.
BUCKET = 64


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a text."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    grams = ([b" ".join(words)] if len(words) < shingle else
             [b" ".join(g) for g in zip(*[words[i:] for i in range(shingle)], strict=False)])
    half = len(grams)
    ones = np.zeros(64, np.int64)
    for start in range(0, half, 1 << 16):
        part = grams[start : start + (1 << 16)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in part), np.uint64, len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > half, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprint_of(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: fingerprint(t, shingle)).astype("int64")

    return prints(text)


def _masks(distance: int, blocks: int) -> list[int]:
    """Bits of each choice of pieces on which a close pair must agree in one case at least."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    pieces = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(choice) for choice in combinations(pieces, blocks - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fp`` as all links within ``distance`` bits would."""
    masks = _masks(distance, blocks)
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks])).alias("m", "key"))
    counts = keyed.groupBy("m", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(keyed.join(counts, ["m", "key"]), "buckets")
    small = shared.where(F.col("n") <= bucket).select("m", "key", "fp")
    near = (small.withColumnRenamed("fp", "a").join(small.withColumnRenamed("fp", "b"), ["m", "key"])
            .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
            .select("a", "b"))
    crowded = shared.where(F.col("n") > bucket).select("fp").distinct()
    if distance != 2:
        raise ValueError("the neighbourhoods of crowded buckets are those of distance 2")
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i)).cast("long")) for i in range(64)])
    meets = crowded.select("fp", F.explode(flips).alias("via"))
    hubs = meets.groupBy("via").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("via", "a")
    stars = meets.join(hubs, "via").where(F.col("a") != F.col("fp")).select("a", F.col("fp").alias("b"))
    return near.union(stars).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) reaches."""
    both = staged(edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
                  .union(edges.select("b", "a")), "edges")
    label = staged(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")), "labels")
    while True:
        roots = label.select(F.col("node").alias("other"), F.col("root").alias("seen"))
        # the smallest label around a node hooks the node and the root it had, then paths are shortened
        offer = both.join(roots, "other").groupBy("node").agg(F.min("seen").alias("seen"))
        heard = staged(label.join(offer, "node").select("node", "root", F.least("root", "seen").alias("low")), "heard")
        hooks = heard.groupBy("root").agg(F.min("low").alias("hook")).withColumnRenamed("root", "top")
        hooked = heard.join(hooks, F.col("low") == F.col("top"), "left").select(
            "node", "root", F.least("low", F.coalesce("hook", "low")).alias("new"))
        own = hooks.select(F.col("top").alias("mine"), F.col("hook").alias("own_hook"))
        new = hooked.join(own, F.col("root") == F.col("mine"), "left").select(
            "node", "root", F.least("new", F.coalesce("own_hook", "new")).alias("new"))
        step = staged(new, "labels")
        label = step.select("node", F.col("new").alias("root"))
        if step.where(F.col("root") != F.col("new")).isEmpty():
            return label


def components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    rows = printed(docs, shingle)
    return linked(rows, distance, blocks).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def printed(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, fp and the text's hash tid; staged, one pass over the texts."""
    bounded_batches(docs.sparkSession)
    return staged(docs.select("doc_id", fingerprint_of(text_or_empty(), shingle).alias("fp"),
                              F.xxhash64(text_or_empty()).alias("tid")), "prints")


def linked(rows: DataFrame, distance: int, blocks: int) -> DataFrame:
    """rows (doc_id, fp, tid) with root and component_id; ``rows`` is a staged table."""
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = connected(links(prints, distance, blocks))
    classes = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(classes.join(names, "root").select("fp", "root", "component_id"), "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id.

    Of rows that repeat this id one with the smallest text hash stays; a component of null ids
    keeps one row likewise.
    """
    named = linked(printed(docs, shingle), distance, blocks)
    first = (named.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("root").agg(F.first("doc_id").alias("doc_id"), F.min("tid").alias("tid")))
    have = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("tid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    chosen = have.alias("d").join(first.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.tid") == F.col("f.tid")))
    one = chosen.groupBy("d.doc_id", "d.tid").agg(F.first("d.row").alias("row"))
    return one.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
