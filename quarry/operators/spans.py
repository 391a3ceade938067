"""Source offsets of what the cleaning rules C02-C05 remove.

The chain of column rules rewrites the text rule by rule; here the rules only say
which parts of the source go, as rows of (key, rule, s, e), 0-based and end-exclusive
in code points.  :func:`cleaned` unites the spans of all rules and cuts the text once.

Marks are found by one scan of the text for each rule; everything after it is windows
over narrow rows of one page, behind one shuffle by the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.markup import COMMENT_RE, SELF_CLOSING_RE, ignored_tags_pattern
from quarry.operators.shape import drop_spans
from quarry.options import Options


def _patterns(opts: Options) -> dict[str, str]:
    found = {"comment": COMMENT_RE, "self_closing": SELF_CLOSING_RE}
    if opts.ignore_tags_all:
        found["ignored_tag"] = ignored_tags_pattern(opts.ignore_tags_all)
    if opts.discard_elements:
        alt = "|".join(opts.discard_elements)
        found["element"] = rf"(?i)<\s*(?:{alt})\b[^>/]*>|<\s*/\s*(?:{alt})>"
    return found


def _marks(text: Column, rule: str, pattern: str) -> Column:
    """Every match of a rule in order: its number, length, the length of the text before it, its tag and whether it closes one."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    scan = F.array(F.struct(gaps.alias("gaps"), found.alias("found")))
    tag = (lambda m: F.lower(F.regexp_extract(m, r"^<[\s/]*(\w+)", 1))) if rule == "element" else (lambda m: F.lit(None).cast("string"))
    return F.flatten(F.transform(scan, lambda x: F.transform(x["found"], lambda m, i: F.struct(
        F.lit(rule).alias("rule"), i.alias("nth"), F.length(m).cast("long").alias("width"), F.length(F.get(x["gaps"], i)).cast("long").alias("gap"),
        tag(m).alias("tag"), m.rlike(r"^<\s*/").alias("closes")))))


def rule_spans(texts: DataFrame, opts: Options = Options(), key: str = "page_id", text: str = "text") -> DataFrame:
    """(key, rule, s, e) of every comment, self-closing tag, ignored tag and discarded element; they may overlap.

    ``key`` must be unique and not null.  A close ends the nearest open of its tag that isn't closed yet, at any depth; opens
    and closes without a partner give no span, nor do marks inside a comment or tag that goes.  Null texts have no spans.
    """
    found = F.flatten(F.array(*[_marks(F.col(text), rule, p) for rule, p in _patterns(opts).items()]))
    rows = texts.where(F.col(text).contains("<")).select(key, F.explode(found).alias("m")).select(key, "m.*").repartition(key)
    before = (Window.unboundedPreceding, -1)
    end = F.sum(F.col("gap") + F.col("width")).over(Window.partitionBy(key, "rule").orderBy("nth"))
    rows = rows.withColumn("e", end).withColumn("s", F.col("e") - F.col("width")).drop("nth", "gap", "width")
    plain = F.col("tag").isNull()
    reach = F.max(F.when(plain, F.col("e"))).over(Window.partitionBy(key).orderBy("s", F.col("tag").isNotNull()).rowsBetween(*before))
    rows = rows.withColumn("reach", reach).where(plain | F.col("reach").isNull() | (F.col("reach") <= F.col("s")))
    # Depth of each tag: the running sum of its marks over the lowest it has been, so closes too many count nothing.
    tags = Window.partitionBy(key, "tag").orderBy("s")
    rows = rows.withColumn("sum", F.sum(F.when(F.col("closes"), -1).otherwise(1)).over(tags))
    rows = rows.withColumn("depth", F.col("sum") - F.least(F.lit(0), F.min("sum").over(tags.rowsBetween(Window.unboundedPreceding, 0))))
    rows = rows.withColumn("level", F.when(F.col("closes"), F.coalesce(F.lag("depth").over(tags), F.lit(0))).otherwise(F.col("depth")))
    # Opens and closes of one level alternate: a close's partner is the mark before it.
    partner = F.lag("s").over(Window.partitionBy(key, "tag", "level").orderBy("s"))
    rows = rows.withColumn("partner", partner).where(plain | (F.col("closes") & (F.col("level") > 0)))
    return rows.select(key, "rule", F.when(plain, F.col("s")).otherwise(F.col("partner")).alias("s"), "e")


def cleaned(texts: DataFrame, opts: Options = Options(), key: str = "page_id", text: str = "text") -> DataFrame:
    """C02-C05 by offsets: the texts without the union of all rules' spans."""
    return drop_spans(texts, rule_spans(texts, opts, key, text), key, text)
