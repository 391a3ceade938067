"""Structure shaping over a lines table (operators L01-L13, W03, W04, O02).

A page's text becomes one row per line (``posexplode``).  The sequential
state of the reference's line loop (open lists, pending section headers,
blank-line collapsing) is rebuilt with window functions over
``partitionBy(page_id).orderBy(line_no)``.  Pages are hash-partitioned by
``page_id`` once before the explode, so the windows and the regrouping
``groupBy(page_id)`` reuse that partitioning and add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.options import Options

HEADER_RE = r"(?sU)^(==+)\s*(.*?)\s*\1"
LIST_CHARS = "*#;"
# Before which ``$`` matches, besides a newline.
LINE_ENDS = ("\r", "\u0085", "\u2028", "\u2029")


def lines(df: DataFrame, key: str = "page_id", text: str = "text") -> DataFrame:
    """One row per line with its 0-based number."""
    return df.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def _sentence(title: Column) -> Column:
    """Add a full stop unless the title ends with ``!`` or ``?`` (empty stays empty)."""
    return F.when((title == "") | title.rlike(r"[!?]$"), title).otherwise(F.concat(title, F.lit(".")))


def classify(ln: DataFrame) -> DataFrame:
    """Kind of each line and the header level/title."""
    line = F.col("line")
    first = F.substring(line, 1, 1)
    # Patterns read a whole line, so they are asked only where the line's start or end lets them match.
    level = F.when(line.startswith("=="), F.length(F.regexp_extract(line, HEADER_RE, 1))).otherwise(0)
    kind = (F.when(line == "", "blank")
            .when(level > 0, "header")
            .when(line.startswith("++"), "title")
            .when(first == ":", "indent")
            .when(F.col("first").isin(*LIST_CHARS), "list")
            .otherwise("other"))
    return (ln.withColumn("first", first)
            .withColumn("kind", kind)
            .withColumn("level", F.when(F.col("kind") == "header", level))
            .withColumn("head", F.when(F.col("kind") == "header",
                                       _sentence(F.regexp_extract(line, HEADER_RE, 2))))
            .withColumn("residue", first.isin("{", "|") | line.endswith("}"))
            .withColumn("irrelevant", ((first == "(") & line.endswith(")"))
                        | (first.isin("", ".", "-", *LINE_ENDS) & line.rlike(r"^[.\-]*$"))))


def shape_lines(ln: DataFrame, opts: Options = Options(), key: str = "page_id") -> DataFrame:
    """Decide, per line, what it contributes to the output (array ``out``)."""
    w = Window.partitionBy(key).orderBy("line_no")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    c = ln if "kind" in ln.columns else classify(ln)
    kind = F.col("kind")
    line = F.col("line")
    item = F.trim(F.regexp_replace(line, r"^[*#;:]+", ""))
    # Lists are open when the last list-affecting line was a list line.
    affects = kind.isin("blank", "header", "list", "other")
    c = c.withColumn("in_list", F.coalesce(
        F.last(F.when(affects, kind == "list"), ignorenulls=True).over(before), F.lit(False)))
    c = c.withColumn("body", (kind == "other") & ~F.col("in_list") & ~F.col("residue") & ~F.col("irrelevant"))
    # Headers wait for the first line that consumes them.
    consumes = F.col("body")
    if opts.keep_lists:
        consumes = consumes | ((kind == "list") & (item != ""))
    c = c.withColumn("consumes", consumes)
    c = c.withColumn("last_head", F.max(F.when(kind == "header", F.col("line_no"))).over(before))
    c = c.withColumn("last_consume", F.max(F.when(F.col("consumes"), F.col("line_no"))).over(before))
    c = c.withColumn("pending", F.col("last_head").isNotNull()
                     & (F.col("last_head") > F.coalesce(F.col("last_consume"), F.lit(-1))))
    # A section stays empty from its header until a body line takes the
    # pending headers or a blank line closes a list.
    event = (F.when(kind == "header", True)
             .when(F.col("body") & F.col("pending"), False)
             .when((kind == "blank") & F.col("in_list"), False))
    c = c.withColumn("empty_section", F.coalesce(F.last(event, ignorenulls=True).over(before), F.lit(False)))
    title_text = F.substring(line, 3, F.length(line) - 4)
    emit = (
        F.when(kind == "title", F.when(title_text != "", F.array(_sentence(title_text))))
        .when((kind == "other") & F.col("in_list"), F.array(line))
        .when(F.col("body") & F.col("pending"), F.array(line))
        .when(F.col("body") & ~F.col("empty_section") & ~line.startswith(" "), F.array(line))
    )
    if opts.keep_lists:
        emit = F.when((kind == "list") & (item != ""), F.array(_bullet(c, key))).otherwise(emit)
    elif opts.to_html:
        c = _with_list_tags(c, affects, key)
        emit = F.when((kind == "list") & (item != ""), F.array(_html_item(item))).otherwise(emit)
    if opts.to_html:
        emit = F.when(kind == "header", F.array(F.format_string(
            "<h%d>%s</h%d>", F.col("level"), F.regexp_extract(line, HEADER_RE, 2), F.col("level")))).otherwise(emit)
    list_tags = opts.to_html and not opts.keep_lists
    if list_tags:  # what a line closes and opens stands before it, but a blank line before what it closes
        both = F.concat("tags_before", F.coalesce(F.when(kind == "blank", F.array().cast("array<string>")).otherwise(emit), F.array().cast("array<string>")))
        emit = F.when(F.size(both) > 0, both)
    c = c.withColumn("emit", emit)
    # A blank line is kept inside a list, or right after a kept non-blank line (a tag that closes a list is one).
    kept = (kind != "blank") & F.col("emit").isNotNull()
    blank = kind == "blank"
    if not opts.to_html:
        kept = kept & (kind != "header")
    if list_tags:
        kept, blank = kept | (blank & F.col("in_list")), blank & ~F.col("in_list")
    c = c.withColumn("last_kept", F.max(F.when(kept, F.col("line_no"))).over(before))
    c = c.withColumn("last_blank", F.max(F.when(blank, F.col("line_no"))).over(before))
    blank_kept = F.col("in_list") | (F.col("last_kept").isNotNull() & (
        F.col("last_blank").isNull() | (F.col("last_blank") < F.col("last_kept"))))
    out = F.when(kind == "blank", F.when(blank_kept, F.array(F.lit("")))).otherwise(F.col("emit"))
    if list_tags:
        none = F.array().cast("array<string>")
        out = F.concat(F.coalesce(out, none), F.when(kind == "blank", F.col("tags_before")).otherwise(none), F.col("tags_after"))
    return c.withColumn("out", out)


def _bullet(c: DataFrame, key: str) -> Column:
    """``N. item`` for ``#`` items (N counts within the open list), ``- item`` otherwise."""
    line = F.col("line")
    prefix = F.regexp_extract(line, r"^[*#;:]+", 0)
    item = F.trim(F.regexp_replace(line, r"^[*#;:]+", ""))
    bullet = F.when(F.substring(prefix, -1, 1) == "#",
                    F.concat(F.col("item_no").cast("string"), F.lit(". "))).otherwise(F.lit("- "))
    return F.concat(F.rpad(bullet, F.greatest(F.length(bullet), F.length(prefix)), " "), item)


_HTML_ITEM = {"*": "<li>%s</li>", "#": "<li>%s</li>", ";": "<dt>%s</dt>", ":": "<dd>%s</dd>"}


def _html_item(item: Column) -> Column:
    last = F.substring(F.regexp_extract(F.col("line"), r"^[*#;:]+", 0), -1, 1)
    r = F.format_string(_HTML_ITEM["*"], item)
    for ch in (";", ":"):
        r = F.when(last == ch, F.format_string(_HTML_ITEM[ch], item)).otherwise(r)
    return r


# The list that a prefix character opens; ``:`` goes with ``;``.
_HTML_LIST = {"*": "ul", "#": "ol", ";": "dl"}


def _tags(chars: Column, form: str) -> Column:
    """The list tags of prefix characters, in order."""
    named = F.create_map(*[F.lit(x) for c, t in _HTML_LIST.items() for x in (c, form % t)])
    return F.transform(F.filter(F.split(chars, ""), lambda c: c != ""), lambda c: F.try_element_at(named, c))


def _with_list_tags(c: DataFrame, affects: Column, key: str) -> DataFrame:
    """The list tags that a line closes and opens (``tags_before``) and that the end of the page closes (``tags_after``).

    Lists are properly nested: a line closes what its prefix does not share with the line before, innermost first, and
    opens the rest of its own; blank, header and other lines and the end of the page close all.
    """
    w = Window.partitionBy(key).orderBy("line_no")
    prefix = F.translate(F.regexp_extract("line", r"^[*#;:]+", 0), ":", ";")
    own = F.when(F.col("kind") == "list", prefix).when(affects, "")
    c = c.withColumn("_now", own)
    c = c.withColumn("_was", F.coalesce(F.last("_now", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit("")))
    c = c.withColumn("_now", F.coalesce("_now", "_was"))
    shared = F.length(F.regexp_extract(F.concat("_was", F.lit("\n"), "_now"), r"^(.*).*\n\1", 1))
    rest = lambda x: F.substring(x, shared + 1, F.length(x))
    closed, opened = _tags(F.reverse(rest(F.col("_was"))), "</%s>"), _tags(rest(F.col("_now")), "<%s>")
    last = F.lead("line_no").over(w).isNull()
    left = F.when(last, _tags(F.reverse(F.col("_now")), "</%s>")).otherwise(F.array().cast("array<string>"))
    return c.withColumn("tags_before", F.concat(closed, opened)).withColumn("tags_after", left).drop("_now", "_was")


def with_item_numbers(c: DataFrame, key: str) -> DataFrame:
    """Item number of a list line within its open list at its depth, at any depth.

    A depth's counter restarts when the list closes (blank, header or other
    line) or when the prefix up to that depth changes; it survives deeper
    items in between.  A line is repeated once for each depth of its own
    prefix; it breaks the depths beyond the prefix it shares with the line
    before, and what the depth had counted before its last break is taken off.
    """
    w = Window.partitionBy(key).orderBy("line_no")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    kind = F.col("kind")
    affects = kind.isin("blank", "header", "list", "other")
    c = c.withColumn("prefix", F.when(kind == "list", F.regexp_extract(F.col("line"), r"^[*#;:]+", 0)))
    c = c.withColumn("depth", F.length("prefix"))
    c = c.withColumn("prev_prefix", F.last(F.when(affects, F.coalesce("prefix", F.lit(""))),
                                           ignorenulls=True).over(before))
    # The longest prefix of both: a back-reference finds it.
    c = c.withColumn("_shared", F.length(F.regexp_extract(F.concat(
        F.coalesce("prev_prefix", F.lit("")), F.lit("\n"), F.col("prefix")), r"^(.*).*\n\1", 1)))
    c = c.withColumn("_d", F.explode(F.when(kind == "list", F.sequence(F.lit(1), F.col("depth")))
                                     .otherwise(F.array(F.lit(0)))))
    wd = Window.partitionBy(key, "_d").orderBy("line_no")
    counted = ((kind == "list") & (F.col("_d") == F.col("depth"))
               & (F.trim(F.regexp_replace("line", r"^[*#;:]+", "")) != "")).cast("int")
    # Counts never fall, so what was counted before the last break is the most that was counted before any.
    c = c.withColumn("_n", F.sum(counted).over(wd))
    c = c.withColumn("_before", F.coalesce(F.sum(counted).over(wd.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    since = F.max(F.when(F.col("_shared") < F.col("_d"), F.col("_before"))).over(wd)
    c = c.withColumn("item_no", F.when(kind == "list", F.col("_n") - F.coalesce(since, F.lit(0))))
    return c.where((kind != "list") | (F.col("_d") == F.col("depth"))).drop("_d", "_shared", "_n", "_before")


def compact(df: DataFrame, opts: Options = Options(), key: str = "page_id", text: str = "text",
            out_col: str = "lines") -> DataFrame:
    """Text -> shaped list of lines, one row per page (other columns kept)."""
    ln = lines(df, key, text)
    if opts.keep_lists:
        ln = with_item_numbers(classify(ln), key)
    shaped = shape_lines(ln, opts, key)
    if opts.keep_sections:
        shaped = _attach_sections(shaped, key)
    grouped = (shaped.groupBy(key)
               .agg(F.sort_array(F.collect_list(F.struct("line_no", "out"))).alias("_l")))
    flat = F.flatten(F.transform(F.col("_l"), lambda s: F.coalesce(s["out"], F.array().cast("array<string>"))))
    rest = df.drop(text)
    return rest.join(grouped.select(key, flat.alias(out_col)), key, "left")


def _attach_sections(c: DataFrame, key: str) -> DataFrame:
    """Put the open headers in front of the first consuming line of each run (keep_sections)."""
    w = Window.partitionBy(key).orderBy("line_no")
    c = c.withColumn("run", F.coalesce(F.sum(F.col("consumes").cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    wr = Window.partitionBy(key, "run")
    heads = F.collect_list(F.when(F.col("kind") == "header",
                                  F.struct("line_no", "level", "head"))).over(wr)
    c = c.withColumn("_heads", heads)
    survivors = F.filter(F.col("_heads"), lambda h: ~F.exists(
        F.col("_heads"), lambda g: (g["line_no"] > h["line_no"]) & (g["level"] <= h["level"])))
    ordered = F.transform(F.array_sort(survivors, lambda a, b: F.when(a["level"] < b["level"], -1)
                                       .when(a["level"] > b["level"], 1).otherwise(0)),
                          lambda h: h["head"])
    out = F.when(F.col("pending") & F.col("consumes"),
                 F.concat(ordered, F.coalesce(F.col("out"), F.array().cast("array<string>"))))\
        .otherwise(F.col("out"))
    return c.withColumn("out", out)


def drop_spans(texts: DataFrame, spans: DataFrame, key: str = "page_id", text: str = "text") -> DataFrame:
    """Remove the union of possibly overlapping ``[s, e)`` spans (0-based) from each text.

    Gaps-and-islands: spans sorted by start open a new island when they start
    at or after the running maximum end; kept text is what lies between islands (null text stays null).
    """
    w = Window.partitionBy(key).orderBy("s", "e")
    run_end = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    s = spans.withColumn("_new", run_end.isNull() | (F.col("s") >= run_end))
    s = s.withColumn("_island", F.sum(F.col("_new").cast("int")).over(w))
    islands = s.groupBy(key, "_island").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    per_page = islands.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("_isl"))
    t = texts.join(per_page, key, "left")
    isl = F.coalesce(F.col("_isl"), F.array().cast("array<struct<s:bigint,e:bigint>>"))
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(isl, lambda x: x["e"]))
    ends = F.concat(F.transform(isl, lambda x: x["s"]), F.array(F.length(text).cast("bigint")))
    kept = F.array_join(F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda g: F.when(
        g["b"] > g["a"], F.substring(F.col(text), (g["a"] + 1).cast("int"), (g["b"] - g["a"]).cast("int")))
        .otherwise(F.lit(""))), "")
    return t.withColumn(text, F.when(F.col(text).isNotNull(), kept)).drop("_isl")
