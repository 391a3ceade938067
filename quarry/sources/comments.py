"""Comment dumps: JSON lines, plain or compressed, one or many files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMENT_SCHEMA = "body string, _corrupt_record string"


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    """``(body, _corrupt_record, file_path)``; bad lines are kept and countable.

    ``path`` may be a glob; ``.bz2`` files are split by Spark, ``.gz`` are not
    (repartition after reading them).
    """
    df = (spark.read.schema(COMMENT_SCHEMA).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    return df.withColumn("file_path", F.col("_metadata.file_path"))


def bad_records(df: DataFrame) -> DataFrame:
    """lines that were not JSON objects."""
    # Spark refuses queries that read only the corrupt-record column of raw files.
    return df.where(F.col("_corrupt_record").isNotNull() & F.col("body").isNull())
