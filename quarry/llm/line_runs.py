"""Line deduplication over levelled sorted runs of line hashes, with DataFrame functions only.

A line's key is the line stripped of ASCII white space at both ends, A-Z in lower
case; two XXH64 values (128 bits) stand for it.  A run is a table of keys with the
documents that held them, bucketed and sorted by key.  Each new batch is counted
(a document counts once for a key), merge-anti-joined with the runs, so that keys a
run already counts as frequent aren't stored again, and its rest is written as a run of
level 0.  When a level has ``fanout`` runs, they are merged into one run of the next level
and deleted.  Runs share the bucketing of the counts, so a merge join moves neither side again.

``dedup`` feeds a whole table in batches (groups of input partitions), then drops every line whose
key at least ``min_docs`` documents hold, first copies included.  ``LineRuns.unseen`` serves a feed
of batches: a batch loses the lines that earlier batches made frequent and then adds its own keys.

No group is unbounded: keys are counted with a partial aggregation; of the frequent keys the
hottest (a fixed share of all counts each, so at most ``HOT_KEYS``) are broadcast, and only the others are
merge-joined with the texts' lines.  Copies of one text share one list of dropped positions.

Defined cases: null or empty text is one empty line; keys shorter than ``min_chars`` code points are
never counted nor dropped; every row is a document, rows with one id or one text too; null ids
are allowed; a text that loses all lines is empty; an empty table gives an empty result; further columns
stay as they are, whatever their names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import SPACES, discard, fresh, shared_path

MIN_DOCS, MIN_CHARS = 10, 1
#: Runs of a level before they are merged, and batches of a whole table.
FANOUT, BATCHES = 4, 8
#: A key with more than this part of all counts is hot; there can't be more of them.
HOT_KEYS = 4096
KEY = ["h1", "h2"]


def line_keys(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """The hashed key (h1, h2) of every line; null for keys that are too short."""
    folded = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    stripped = F.transform(F.split(folded, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)))
    return F.transform(stripped, lambda k: F.when(
        F.length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))))


def _text_key(text: Column) -> list[Column]:
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(1), whole).alias("t2")]


def counted(keyed: DataFrame) -> DataFrame:
    """h1, h2, docs: in how many rows of ``keyed`` (lines: hashed keys) a key stands."""
    by_key = keyed.select(F.sort_array(F.filter("lines", lambda x: x.isNotNull())).alias("sorted"))
    once = F.filter("sorted", lambda x, i: ~x.eqNullSafe(F.get("sorted", i - 1)))
    return (by_key.select(F.explode(once).alias("k")).select("k.*")
            .groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs")))


@dataclass
class Run:
    level: int
    table: str
    path: str


@dataclass
class LineRuns:
    """The runs written so far; ``min_docs`` documents make a key frequent."""

    spark: SparkSession
    min_docs: int = MIN_DOCS
    fanout: int = FANOUT
    runs: list[Run] = field(default_factory=list)

    def _read(self, run: Run) -> DataFrame:
        return self.spark.table(run.table)

    def _write(self, counts: DataFrame, level: int) -> None:
        path, table = shared_path(self.spark, "run"), f"line_run_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (counts.select(*KEY, "docs").write.format("parquet").option("path", path)
         .bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(table))
        self.runs.append(Run(level, table, path))

    def _merge(self, runs: list[Run], level: int) -> None:
        # Read as plain files: Spark 4.1 takes a union of bucketed scans for partitioned by key, which it is not.
        both = self.spark.read.schema("h1 long, h2 long, docs long").parquet(*[run.path for run in runs])
        self._write(both.groupBy(*KEY).agg(F.sum("docs").alias("docs")), level)
        for run in runs:
            self.runs.remove(run)
            self.spark.sql(f"DROP TABLE {run.table}")
            discard(self.spark, run.path)

    def add(self, counts: DataFrame) -> None:
        """Adds a batch's ``counted`` keys but those that a run already counts as frequent; compacts full levels."""
        for run in self.runs:
            full = self._read(run).where(F.col("docs") >= self.min_docs).select(*KEY)
            counts = counts.join(full.hint("merge"), KEY, "left_anti")
        self._write(counts, 0)
        level = 0
        while len(full := [r for r in self.runs if r.level == level]) >= self.fanout:
            level += 1
            self._merge(full, level)

    def compact(self) -> None:
        """All runs merged into one."""
        if len(self.runs) > 1:
            self._merge(list(self.runs), max(r.level for r in self.runs) + 1)

    def frequent(self) -> tuple[DataFrame, DataFrame]:
        """Keys of at least ``min_docs`` documents: the hot ones (at most ``HOT_KEYS``) and the others."""
        self.compact()
        run = self._read(self.runs[0])
        total = run.agg(F.sum("docs")).first()[0] or 0
        hot = F.col("docs") > max(self.min_docs - 1, total / HOT_KEYS)
        return run.where(hot).select(*KEY), run.where((F.col("docs") >= self.min_docs) & ~hot).select(*KEY)

    def unseen(self, docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
        """The batch without the lines that earlier batches made frequent; its own keys are added after.

        Columns as ``dedup`` gives them.  The result is written before the runs change.
        """
        path = shared_path(self.spark, "batch")
        keyed = docs.select(*_text_key(F.col("text")), line_keys(F.col("text"), min_chars).alias("lines"))
        kept = without(docs, positions(keyed, *self.frequent()) if self.runs else None)
        kept.write.parquet(path)
        self.add(counted(keyed))
        return self.spark.read.schema(kept.schema).parquet(path)

    def drop(self) -> None:
        """Deletes the runs."""
        for run in self.runs:
            self.spark.sql(f"DROP TABLE {run.table}")
            discard(self.spark, run.path)
        self.runs = []


def positions(keyed: DataFrame, hot: DataFrame, cold: DataFrame) -> DataFrame:
    """t1, t2, gone: the positions of the lines with frequent keys in each text that has some."""
    each = keyed.select("t1", "t2", F.posexplode("lines").alias("pos", "k")).where("k IS NOT NULL").select("t1", "t2", "pos", "k.*")
    found = each.join(F.broadcast(hot), KEY, "left_semi").unionByName(
        each.join(F.broadcast(hot), KEY, "left_anti").join(cold.hint("merge"), KEY, "left_semi"))
    return found.groupBy("t1", "t2").agg(F.collect_set("pos").alias("gone"))


def without(docs: DataFrame, gone: DataFrame | None, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` lacking the lines of ``gone``, and n_lines, n_dropped (a free name near it if taken)."""
    n, out, t1, t2, lost, lines = fresh(docs, "n_lines", "n_dropped", "t1", "t2", "gone", "lines")
    keys = [k.alias(name) for k, name in zip(_text_key(F.col(text)), (t1, t2), strict=True)]
    if gone is None:
        joined = docs.select("*", F.lit(None).cast("array<int>").alias(lost))
    else:
        joined = docs.select("*", *keys).join(gone.select(F.col("t1").alias(t1), F.col("t2").alias(t2), F.col("gone").alias(lost)), [t1, t2], "left")
    split = joined.withColumn(lines, F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost)
    rest = F.array_join(F.transform(stay, lambda p: F.get(F.col(lines), p)), "\n")
    kept = F.when(F.col(lost).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(rest)
    return split.select(*[kept.alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in docs.columns],
                        F.size(lines).cast("long").alias(n), F.coalesce(F.size(lost), F.lit(0)).cast("long").alias(out))


def dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """``docs`` (text without the lines of frequent keys) with n_lines and n_dropped of every row."""
    spark = docs.sparkSession
    path = shared_path(spark, "keys")
    batch = F.pmod(F.spark_partition_id(), F.lit(batches))
    (docs.select(*_text_key(F.col("text")), line_keys(F.col("text"), min_chars).alias("lines"), batch.alias("batch"))
     .write.partitionBy("batch").parquet(path))
    schema = "t1 long, t2 long, lines array<struct<h1: long, h2: long>>, batch int"
    keyed = spark.read.schema(schema).parquet(path)
    runs = LineRuns(spark, min_docs)
    for i in range(batches):
        part = keyed.where(F.col("batch") == i)
        if i == 0 or part.limit(1).count():  # tables of few partitions fill few batches
            runs.add(counted(part))
    return without(docs, positions(keyed, *runs.frequent()))
