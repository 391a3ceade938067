"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir

#: Rows per Arrow batch handed to Python: bounds the memory of a batch of long texts.
ARROW_ROWS = 512
#: The six ASCII white-space bytes that end a word; ``bytes.split()`` uses the same set.
SPACES = " \t\n\x0b\x0c\r"
#: A word, as Java's and DuckDB's regular expressions write it.
WORD = r"[^\x20\x09-\x0D]+"


def bounded_batches(spark: SparkSession) -> None:
    """Sets the rows per Arrow batch for the Python stages planned from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


#: Folders named by ``shared_path`` in this process and not deleted since.
_named: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder that driver and executors share."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    _named.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage at a table that outlives any executor, so later passes
    neither repeat the work above nor see other rows than the first pass.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table below the checkpoint folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    if path in _named:
        _named.remove(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that were staged inside; their results must be written by then."""
    before = set(_named)
    yield
    for path in [p for p in _named if p not in before]:
        discard(spark, path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names near ``names`` that ``df`` doesn't have in any letter case."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def null_key(name: str) -> Column:
    """A non-null string key: values keep their code-point order behind '0', null ('1') comes last."""
    return F.when(F.col(name).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(name).cast("string")))


def md5_number(value: Column, digits: int) -> Column:
    """The first ``digits`` hex digits of md5 as a long; SQL engines agree on it."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, digits), 16, 10).cast("long")


def group_rank(df: DataFrame, group: list[str], slice_col: str, order: list[str], out: str,
               facts: DataFrame | None = None) -> DataFrame:
    """Adds ``out``: the 0-based position of a row in its group, by (slice, ``order``).

    A group may hold a third of all rows, so no window spans it: rows are
    numbered inside (group, slice) cells, the cells' counts are summed up within
    the group (a window over its slices only), and each cell adds its offset.
    ``df`` is scanned twice and should be a table; group and slice aren't null.
    ``facts``, a row for each group, travel with the offsets, so the rows move only once.
    """
    cell = [*group, slice_col]
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*cell).orderBy(*order)) - 1)
    before = Window.partitionBy(*group).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    offset = fresh(df, "cell_offset")[0]
    offsets = (df.groupBy(*cell).agg(F.count(F.lit(1)).alias(offset))
               .withColumn(offset, F.coalesce(F.sum(offset).over(before), F.lit(0))))
    if facts is not None:
        offsets = offsets.join(facts, group)
    return ranked.join(offsets, cell).withColumn(out, F.col(out) + F.col(offset)).drop(offset)
