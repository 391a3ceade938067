"""Page selection and projections (operators F01-F07, P01-P08, W01, W02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.functions.text import col_, lcfirst, ucfirst
from quarry.options import TEMPLATE_NS_KEYS, Options

DISAMBIG_RE = r"(?m)^\{\{disambig(uation)?(\|[^}]*)?\}\}"


def spread(df: DataFrame) -> DataFrame:
    """Round-robin repartition when the scan gave fewer partitions than cores.

    Text rules are CPU-heavy per row; a small input file would otherwise run
    them in one task.  At cluster scale the scan already yields many splits
    and this is a no-op.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# F01
def articles(df: DataFrame) -> DataFrame:
    return df.where(F.col("ns") == 0)


# F02
def drop_redirects(df: DataFrame) -> DataFrame:
    return df.where(F.col("redirect_title").isNull())


# F03
def drop_disambiguation(df: DataFrame, ignore_case: bool = False) -> DataFrame:
    """A line starting with ``{{disambig}}``, ``{{disambiguation}}`` or ``{{disambig|..}}`` marks the page."""
    pat = ("(?i)" if ignore_case else "") + DISAMBIG_RE
    return df.where(~F.coalesce(F.col("text").rlike(pat), F.lit(False)))


def keep_pages(df: DataFrame, opts: Options = Options()) -> DataFrame:
    """F01 + F02 (+ F03 when asked): the pages that become documents."""
    df = drop_redirects(articles(df))
    return drop_disambiguation(df) if opts.filter_disambig_pages else df


# F04
def text_length(lines: Column) -> Column:
    """Sum of line lengths, newlines between lines not counted."""
    return F.aggregate(lines, F.lit(0).cast("bigint"), lambda acc, x: acc + F.length(x))


def min_length(df: DataFrame, n: int, lines: str = "lines") -> DataFrame:
    return df.where(text_length(F.col(lines)) >= n) if n > 0 else df


# W01
MAX_RANGES = 256


def _literal(value, kind) -> Column:
    if isinstance(kind, StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    return F.lit(value).cast(kind)


def range_bounds(df: DataFrame, order: str, n: int, per_range: int = 64) -> list:
    """At most ``n`` - 1 values of ``order`` that cut it into similar shares.

    From a sample picked by a hash of the value, about ``n * per_range`` of them.
    """
    values = df.select(F.col(order).alias("v")).where(F.col("v").isNotNull())
    step = max(1, values.count() // (n * per_range))
    found = [r.v for r in values.where(F.pmod(F.xxhash64("v"), F.lit(step)) == 0).distinct().sort("v").collect()]
    picked = [found[i * len(found) // n] for i in range(1, n)] if found else []
    return [x for i, x in enumerate(picked) if i == 0 or x != picked[i - 1]]


def _in_ranges(df: DataFrame, order: str, partitions: int | None = None) -> DataFrame:
    """Adds ``_range``: the number of a row's range of ``order``, from the row's own value."""
    n = min(MAX_RANGES, partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kind = df.schema[order].dataType
    bounds = [_literal(x, kind) for x in range_bounds(df, order, n)]
    below = F.filter(F.array(*bounds), lambda x: x < F.col(order)) if bounds else F.array()
    return df.withColumn("_range", F.when(F.col(order).isNull(), 0).otherwise(F.size(below)))


def with_running(df: DataFrame, order: str, totals: dict[str, Column], partitions: int | None = None) -> DataFrame:
    """Running sums (each row's own value included) in ``order``, without a single-task global window.

    As in W01: sums inside the ranges, plus the sums of the ranges before, which a table of at most
    ``MAX_RANGES`` rows gives.  Rows of equal ``order`` go by a hash of the row.
    """
    ranged = _in_ranges(df.withColumns({f"_v_{k}": v for k, v in totals.items()}), order, partitions)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_range").agg(*[F.sum(f"_v_{k}").alias(f"_s_{k}") for k in totals])
    offsets = sums.select("_range", *[F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in totals])
    inside = Window.partitionBy("_range").orderBy(order, F.xxhash64(*df.columns)).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({f"_s_{k}": F.sum(f"_v_{k}").over(inside) for k in totals}).join(F.broadcast(offsets), "_range")
    return summed.select(*df.columns, *[(F.col(f"_s_{k}") + F.col(f"_o_{k}")).alias(k) for k in totals])


def with_page_num(df: DataFrame, order: str = "page_id", partitions: int | None = None) -> DataFrame:
    """Consecutive 0-based number in ``order`` without a single-task global window.

    Range bounds (fewer than ``MAX_RANGES``, as literals) are taken once; a row's
    range follows from its own value, so the numbering inside the ranges and
    the ranges' counts, two passes over ``df``, agree whatever the partitioning.
    Rows are numbered inside their range by value, then by a hash of the whole
    row, and the offset of a range is the count of the rows before it.
    """
    ranged = _in_ranges(df, order, partitions)
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    place = Window.partitionBy("_range").orderBy(order, F.xxhash64(*df.columns))
    return (ranged.withColumn("_pos", F.row_number().over(place) - 1)
            .join(F.broadcast(offsets), "_range")
            .withColumn("page_num", F.col("_off") + F.col("_pos"))
            .drop("_range", "_pos", "_off"))


# F05 / W02
def drop_repeated_ids(df: DataFrame, order: str = "page_num") -> DataFrame:
    """Drop a page whose id equals the id of the page just before it in dump order.

    ``order`` is consecutive (W01), so "the page before" has number
    ``order - 1``.  Each row is sent twice -- as itself under its number and
    as the previous id under the next number -- and one ``groupBy`` on the
    number (a unique key, so no skew) pairs them: ``df`` is computed once and
    no global window is needed.
    """
    row_type = df.select(F.struct(*df.columns).alias("r")).schema["r"].dataType
    id_type = df.schema["page_id"].dataType
    both = df.select(F.explode(F.array(
        F.struct(F.col(order).alias("_k"), F.struct(*df.columns).alias("_row"),
                 F.lit(None).cast(id_type).alias("_prev")),
        F.struct((F.col(order) + 1).alias("_k"), F.lit(None).cast(row_type).alias("_row"),
                 F.col("page_id").alias("_prev")))).alias("_e")).select("_e.*")
    paired = both.groupBy("_k").agg(F.max("_row").alias("_row"), F.max("_prev").alias("_prev"))
    return paired.where(F.col("_row").isNotNull() & (
        F.col("_prev").isNull() | (F.col("_prev") != F.col("_row.page_id")))).select("_row.*")


def one_per_id(pages: DataFrame) -> DataFrame:
    """F05 for pages in the order of their dump file and id: of the pages of a file that repeat an id one stays.

    In that order repeats stand together, so dropping a page whose id equals the one before keeps one of each
    (file, id): here the one of the smallest revision.  Equal ids of different files, and pages without an
    id, are pages of their own.  Ids are counted on narrow rows; page texts move only where an id does repeat.
    """
    keys = [c for c in ("file_path", "page_id") if c in pages.columns]
    repeated = pages.where(F.col("page_id").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)
    if not repeated.take(1):
        return pages
    first = F.min_by(F.struct("*"), F.struct("rev_id", F.xxhash64("title", "text")))
    chosen = pages.join(repeated, keys, "left_semi").groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(first.alias("_row"))
    return pages.join(repeated, keys, "left_anti").unionByName(chosen.select("_row.*"))


# F06
def template_pages(df: DataFrame) -> DataFrame:
    return df.where(F.col("ns").isin(*TEMPLATE_NS_KEYS))


# P01
def page_url(page_id, url_base) -> Column:
    return F.concat(col_(url_base) if not isinstance(url_base, str) else F.lit(url_base),
                    F.lit("?curid="), col_(page_id).cast("string"))


# P02
def with_title_parts(df: DataFrame, title: str = "title") -> DataFrame:
    t = F.col(title)
    colon = F.locate(":", t)
    page = F.when(colon > 0, F.substring(t, colon + 1, 1 << 30)).otherwise(t)
    slash_last = F.length(page) - F.locate("/", F.reverse(page)) + 1
    has_slash = F.locate("/", page) > 0
    return (df.withColumn("NAMESPACE", F.when(colon > 0, F.substring_index(t, ":", 1)).otherwise(F.lit("")))
            .withColumn("PAGENAME", page)
            .withColumn("FULLPAGENAME", t)
            .withColumn("BASEPAGENAME", F.when(has_slash, F.substring(page, 1, slash_last - 1)).otherwise(page))
            .withColumn("SUBPAGENAME", F.when(has_slash, F.substring(page, slash_last + 1, 1 << 30)).otherwise(F.lit("")))
            .withColumn("ROOTPAGENAME", F.when(has_slash, F.substring_index(page, "/", 1)).otherwise(page)))


# P05
def title_line(title, to_html: bool = False) -> Column:
    t = col_(title)
    return F.concat(F.lit("<h1>"), t, F.lit("</h1>")) if to_html else F.concat(t, F.lit("\n"))


# P06
def normalize_title(title, known_namespaces=("Template",)) -> Column:
    """Trim spaces/underscores, squeeze them, first letter up; a known namespace loses the space after ``:``."""
    t = F.regexp_replace(F.regexp_replace(col_(title), r"^[ _]+|[ _]+$", ""), r"(?U)[\s_]+", " ")
    m = r"^([^:]*):(\s*)(\S.*)$"
    prefix = F.regexp_extract(t, m, 1)
    space = F.regexp_extract(t, m, 2)
    rest = F.regexp_extract(t, m, 3)
    matched = t.rlike(m)
    ns = ucfirst(prefix)
    known = F.array(*[F.lit(k) for k in known_namespaces]) if known_namespaces else F.array().cast("array<string>")
    return (F.when(matched & F.array_contains(known, ns), F.concat(ns, F.lit(":"), ucfirst(rest)))
            .when(matched, F.concat(ns, F.lit(":"), F.when(space != "", F.lit(" ")).otherwise(F.lit("")), ucfirst(rest)))
            .otherwise(ucfirst(t)))


# P07 re-exported
first_upper = ucfirst
first_lower = lcfirst


# P08
def qualified_template_title(title, template_prefix: str = "Template:", known_namespaces=("Template",)) -> Column:
    """Leading ``:`` = main namespace; ``Ns:x`` with a known namespace kept; else the template prefix."""
    t = col_(title)
    prefix = ucfirst(F.substring_index(t, ":", 1))
    rest = F.substring(t, F.locate(":", t), 1 << 30)
    known = F.array(*[F.lit(k) for k in known_namespaces]) if known_namespaces else F.array().cast("array<string>")
    return (F.when(t.startswith(":"), ucfirst(F.substring(t, 2, 1 << 30)))
            .when((F.locate(":", t) > 1) & F.array_contains(known, prefix), F.concat(prefix, ucfirst(rest)))
            .when(t != "", F.concat(F.lit(template_prefix), ucfirst(t)))
            .otherwise(F.lit("")))
