"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Sources by code point (null last) weigh 5, 2, 1, repeating, and share 150 % of
all words; a source's target stops at twice its size and the excess goes to the
others by weight.  Every document of a source is expected target / size times; the
expected copies are prefix-summed within the source, one random offset is added,
and a document is emitted once for each integer that its stretch crosses.  Documents
stand in the order of their size (in bands of two digits, shuffled inside), so the words
taken come near the target as well.

The prefix sum never puts a source into one task: documents are numbered in
(source, band, slice) cells, and cells and bands are summed over tables of at
most 256 slices a band and 90 bands a power of ten.  The one window over all rows
of a table runs over the table of sources, one row each.

Defined cases: null text has size 0; a source of size 0 has target 0 and gives nothing;
null source is a source of its own; repeated rows are documents of their own; null ids are
allowed; an empty table gives an empty result; ``mix`` ignores further columns, ``mixed_documents``
keeps them, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD, group_rank, md5_number, null_key, staged

WEIGHTS = (5, 2, 1)
SHARE, CAP, SEED = 1.5, 2, "mix-1"


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def band_of(size: Column) -> Column:
    """Digits and first two digits of a size: grows with it."""
    digits = size.cast("string")
    return F.length(digits) * 100 + F.substring(F.rpad(digits, 2, "0"), 1, 2).cast("int")


def targets(sizes: DataFrame) -> DataFrame:
    """key, source_size -> the same with target, by filling sources up to their caps."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy()
    place = F.row_number().over(Window.orderBy("key")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    fill = Window.orderBy(F.col("cap") / F.col("w"), "key")
    rows = (sizes.withColumn("w", weight).withColumn("cap", CAP * F.col("source_size").cast("double"))
            .withColumn("all", SHARE * F.sum(F.col("source_size").cast("double")).over(everything))
            .withColumn("caps_before", F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
            .withColumn("w_from", F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("full", F.col("cap") * F.col("w_from") <= (F.col("all") - F.col("caps_before")) * F.col("w"))
            .withColumn("caps", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything))
            .withColumn("ws", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(everything)))
    share = F.col("w") * ((F.col("all") - F.col("caps")) / F.col("ws"))
    return rows.select("key", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", share)).alias("target"))


def _crossed(place: Column, rate: Column, offset: Column) -> Column:
    return F.floor((place + 1) * rate + offset) - F.floor(place * rate + offset)


def _copies(rows: DataFrame, seed: str) -> DataFrame:
    """rows (key, band, slice, size, doc_id, tie and more) with source_size, target and copies.

    ``rows`` is planned twice, for the counts and for the numbering.
    """
    per_band = rows.groupBy("key", "band").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    by_source = Window.partitionBy("key").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = per_band.withColumn("band_start", F.coalesce(F.sum("n").over(by_source), F.lit(0)))
    aims = targets(per_band.groupBy("key").agg(F.sum("words").alias("source_size")))
    offset = md5_number(F.concat(F.lit(seed + ":"), F.col("key")), 8) / F.lit(4294967296.0)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    bands = bands.join(aims, "key").select("key", "band", "band_start", "source_size", "target", rate.alias("rate"), offset.alias("start"))
    ranked = group_rank(rows, ["key", "band"], "slice", ["size", "doc_id", "tie"], "place", bands)
    place = (F.col("band_start") + F.col("place")).cast("double")
    return (ranked
            .withColumn("copies", F.least(F.lit(CAP), _crossed(place, F.col("rate"), F.col("start"))).cast("long"))
            .drop("rate", "start", "band_start", "place"))


def _keyed(docs: DataFrame, source: str) -> DataFrame:
    return docs.withColumns({
        "key": null_key(source), "size": size_of(),
        "slice": md5_number(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 2), "tie": F.xxhash64("text"),
    }).withColumn("band", band_of(F.col("size")))


def mix(docs: DataFrame, source: str = "source", seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every document."""
    narrow = _keyed(docs.select("doc_id", "text", F.col(source).alias("source")), "source").drop("text", "source")
    return _copies(staged(narrow, "sizes"), seed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_documents(docs: DataFrame, source: str = "source", seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    packed = docs.select("doc_id", "text", F.col(source).alias("source"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = _copies(_keyed(packed, "source").drop("text", "source"), seed).where("copies > 0")
    each = rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return each.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
