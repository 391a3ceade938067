"""Joins that stay balanced when one key holds a large share of the rows.

A template such as a citation helper can appear in a third of all pages, so
the rows of one call key would land in one task of a plain shuffle join.
``lookup`` joins a many-rows-per-key side to a one-row-per-key dictionary:

* key frequencies are counted first, in one pass and by a hash of the key, so long keys don't move for it;
* keys with at least ``hot_rows`` rows and a thousandth of all rows are *hot*;
  there are at most ``MAX_HOT_KEYS`` of them, however large the data, and their
  hashes tell both sides' rows apart (a key that shares a hot one's hash goes with it);
* the dictionary rows of hot keys are measured: under ``max_broadcast_bytes``
  they are broadcast and hot rows are joined map-side without moving;
  otherwise hot rows get a salt and the hot dictionary rows are repeated
  once per salt, spreading each hot key over ``salts`` tasks;
* cold keys use an ordinary shuffle join.

Rows and dictionary that are made from one partitioned table need not move: in the session ``within_parts`` a join on the column
they are partitioned by and others takes them as they lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir

HOT_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64
#: A hot key has at least this part of all rows, so no more keys than this are hot.
MAX_HOT_KEYS = 1_000


def within_parts(spark: SparkSession) -> SparkSession:
    """A copy of the session in which sides that are partitioned by some of a join's columns aren't partitioned again.

    Only for rows that are spread well by those columns, so other queries keep their session.
    """
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own


def key_frequencies(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))


def hot_hashes(counted: DataFrame, key: str, hot_rows: int) -> list[int]:
    """Hashes of the hot keys, at most ``MAX_HOT_KEYS``; ``counted`` has a number ``_rows`` beside each key.

    One pass over ``counted``; a null key joins nothing, so it isn't hot.
    """
    per_key = counted.where(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias("_h")).agg(F.sum("_rows").alias("_rows"))
    # A row for every key that may be hot and one for all others, which the total needs.
    checkpoint_dir(counted.sparkSession)
    few = (per_key.groupBy(F.when(F.col("_rows") >= hot_rows, F.col("_h")).alias("_h")).agg(F.sum("_rows").alias("_rows"))
           .checkpoint(eager=True))
    limit = max(hot_rows, (few.agg(F.sum("_rows")).first()[0] or 0) // MAX_HOT_KEYS)
    return [r._h for r in few.where(F.col("_h").isNotNull() & (F.col("_rows") >= limit)).select("_h").collect()]


def lookup(rows: DataFrame, values: DataFrame, key: str | list[str], freq: DataFrame | None = None,
           hot_rows: int | None = HOT_ROWS, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
           salts: int = SALTS, spread_by: str | None = None, how: str = "inner") -> DataFrame:
    """Join of ``rows`` (many per key) with ``values`` (at most one per key), hot keys split.

    ``how`` is ``inner`` or ``left`` (rows without a value keep NULLs).  Several columns may be the key if ``hot_rows`` is None.
    """
    if hot_rows is None:
        # The caller knows there are fewer rows than the threshold: no key can be hot.
        return rows.join(values, key, how)
    hot = hot_hashes(freq if freq is not None else rows.withColumn("_rows", F.lit(1)), key, hot_rows)
    if not hot:
        return rows.join(values, key, how)
    is_hot = F.xxhash64(key).isin(hot)
    # Written once: it is measured, then joined.
    checkpoint_dir(values.sparkSession)
    hot_vals = values.where(is_hot).checkpoint(eager=True)
    size = [F.octet_length(F.col(c).cast("string")) for c in values.columns]
    stats = hot_vals.agg(F.coalesce(F.sum(sum(size[1:], size[0])), F.lit(0)).alias("bytes")).first()
    cold = rows.where(~is_hot).join(values, key, how)
    hot_rows_df = rows.where(is_hot)
    if stats.bytes <= max_broadcast_bytes:
        # Hot rows stay where they are: the measured hot dictionary rows travel to them.
        return cold.unionByName(hot_rows_df.join(F.broadcast(hot_vals), key, how))
    spread = F.col(spread_by) if spread_by else F.monotonically_increasing_id()
    salted = hot_rows_df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    repeated = hot_vals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
    return cold.unionByName(salted.join(repeated, [key, "_salt"], how).drop("_salt"))
