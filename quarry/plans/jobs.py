"""Whole jobs (B01-B04) composed from the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions import markup
from quarry.functions.text import unescape
from quarry.operators import select, shape
from quarry.options import Options
from quarry.session import checkpoint_dir


def page_text(pages: DataFrame, opts: Options = Options(), templates: DataFrame | None = None,
              raw: bool = True, titles: DataFrame | None = None, key: str = "page_id", unique: bool = False) -> DataFrame:
    """Pages -> expanded, cleaned text (before shaping).

    ``raw`` pages still hold the dump's ``&lt;`` escapes (decoded here once,
    as the XML reader does).
    """
    from quarry.operators import templates as tpl

    df = pages.withColumn("text", unescape("text")) if raw else pages
    if opts.expand_templates:
        if templates is None:
            raise ValueError("expansion needs the template dictionary (built from all pages)")
        df = tpl.expand(df, templates, opts, key, titles, unique=unique)
    return markup.to_text(df, "text", opts)


def documents(pages: DataFrame, opts: Options = Options(), templates: DataFrame | None = None,
              raw: bool = True, numbered: bool = False) -> DataFrame:
    """Dump pages -> documents ``(id, url, title, text[, revid])``; with ``numbered`` also ``page_num``.

    Plan: narrow filters -> repeated ids (F05) -> a number per page -> template
    rounds -> cleaning (row-local) -> lines window -> regroup on the same
    partitioning -> length filter -> render.  Lines and calls are kept apart by the page's number, so pages
    of several dumps that share an id, and pages without one, are documents of their own.
    """
    if opts.expand_templates and templates is None:
        from quarry.operators import templates as tpl

        # Q03 fix: the dictionary comes from the dump itself (all namespaces).
        decoded = pages.withColumn("text", unescape("text")) if raw else pages
        templates = tpl.template_dictionary(decoded)
    kept = select.one_per_id(select.keep_pages(pages, opts))
    # A number per page in scan order; the first round of the expansion writes it down, else it is written here.
    kept = kept.withColumn("_key", F.monotonically_increasing_id())
    if not opts.expand_templates:
        kept = checkpointed(kept)
    # Q12 option: #ifexist asks the titles of every page in the dump.
    titles = pages.select("title") if opts.ifexist_titles else None
    text = page_text(kept, opts, templates, raw, titles, "_key", unique=True)
    place = ["file_path"] if "file_path" in pages.columns and numbered else []
    shaped = shape.compact(text.select("_key", "page_id", "title", "rev_id", *place, "text"), opts, "_key")
    head = select.title_line(F.col("title"), opts.to_html)
    full = F.concat(F.array(head), F.coalesce(F.col("lines"), F.array().cast("array<string>")))
    out = shaped.withColumn("_lines", full)
    out = select.min_length(out, opts.min_text_length, "_lines")
    cols = [F.col("page_id").cast("string").alias("id"),
            select.page_url("page_id", opts.url_base).alias("url"),
            F.col("title"),
            F.array_join("_lines", "\n").alias("text")]
    if opts.print_revision:
        cols.append(F.col("rev_id").cast("string").alias("revid"))
    if numbered:
        # W01 over the documents, in the order of their files and ids.
        made = checkpointed(out.select(*cols, F.struct(*place, "page_id", "_key").alias("_order")))
        return select.with_page_num(made, "_order").drop("_order")
    return out.select(*cols)


def update_dictionary(spark, pages: DataFrame, path: str, opts: Options = Options(), raw: bool = True) -> tuple[DataFrame, Options]:
    """The dictionary saved at ``path`` with the definitions of ``pages`` on top (or only these, if there is none).

    The result is written beside the old one and then put in its place, so a run that breaks off leaves the old one.
    Returns it and the options with the namespace names that the template and module pages show.
    """
    from quarry.operators import sinks
    from quarry.operators import templates as tpl
    from quarry.sources.dump import read_templates

    made = tpl.template_dictionary(pages.withColumn("text", unescape("text")) if raw else pages)
    if list_dir(spark, path):
        made = tpl.merge_dictionaries(read_templates(spark, path), made)
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    sinks.save_templates(made, beside)
    replace_dir(spark, beside, path)
    names = {r.ns: r.ns_name + ":" for r in tpl.template_prefixes(pages).collect()}  # two rows at most
    return read_templates(spark, path), opts.with_(template_prefix=names.get(10, opts.template_prefix),
                                                   module_prefix=names.get(828, opts.module_prefix))


def write_corpus(pages: DataFrame, path: str, opts: Options = Options(), templates: DataFrame | None = None, raw: bool = True) -> dict[str, int]:
    """B01 with its sinks (K01-K04, K07) and its totals (A04), which are observed in the passes that the job makes anyway."""
    from quarry.operators import sinks

    read, written = Observation("pages"), Observation("documents")
    kept = (F.col("ns") == 0) & F.col("redirect_title").isNull()
    seen = pages.observe(read, F.count(F.lit(1)).alias("pages"), F.count(F.when(kept, 1)).alias("articles"),
                         F.count(F.when(F.col("ns").isin(10, 828), 1)).alias("templates"))
    docs = documents(seen, opts, templates, raw, numbered=True)
    out = docs.observe(written, F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"))
    sinks.write_documents(out, path, opts)
    return {**read.get, **written.get}


def html_text(pages: DataFrame, opts: Options = Options(), html: str = "html") -> DataFrame:
    """Web pages -> text with the cleaning rules."""
    return markup.clean(pages.withColumnRenamed(html, "text"), "text", opts.with_(to_html=False))


def run_totals(pages: DataFrame) -> DataFrame:
    """Pages read, articles kept and template pages, as one row."""
    kept = (F.col("ns") == 0) & F.col("redirect_title").isNull()
    return pages.agg(F.count(F.lit(1)).alias("pages"),
                     F.sum(F.when(kept, 1).otherwise(0)).alias("articles"),
                     F.sum(F.when(F.col("ns").isin(10, 828), 1).otherwise(0)).alias("templates"))


def comment_job(spark, in_path: str, out_path: str, make_annotator=None, batch_size: int = 10_000, totals: dict | None = None):
    """Comment dump -> stripped -> batches -> annotated -> tagged sentences, one folder per batch.

    ``make_annotator`` builds the caller's model once per task; its spans, if it gives any, are merged (R02, R03).
    Without one, lines are sentences and spaces separate tokens (``comments.native_tokens``).
    ``totals`` is filled with the records read and the bad ones (F08), observed in the reading pass.
    What is done is a property of the input files (J05): ``out_path/_files``
    names those of finished runs and the first free batch number.  A run takes
    the other files and writes their batches from that number on, then names
    them; a run that broke off in between is repeated under the same numbers
    and replaces its folders.
    """
    from quarry.operators import comments as cm
    from quarry.operators import sinks
    from quarry.sources.comments import read_comments

    lines = read_comments(spark, in_path)
    first = 0
    if "_files" in list_dir(spark, out_path):
        done = spark.read.schema(DONE_SCHEMA).parquet(f"{out_path}/_files")
        lines = cm.pending_batches(lines, done, "file_path")
        first = done.agg(F.max("next_batch")).first()[0] or 0
    read = Observation("comments")
    lines = lines.observe(read, F.count(F.lit(1)).alias("records"),
                          F.count(F.when(F.col("_corrupt_record").isNotNull() & F.col("body").isNull(), 1)).alias("bad_records"))
    texts = cm.comment_texts(lines)
    # Written once: the numbering and the texts come from the same rows.
    texts = checkpointed(texts.select("file_path", "text").withColumn("_id", F.monotonically_increasing_id()))
    if totals is not None:
        totals.update(read.get)
    docs = cm.batches(texts, batch_size, ["file_path", "_id"]).select(F.col("row_num").alias("doc_id"), "text")
    if make_annotator:
        noted = checkpointed(cm.annotate(docs, make_annotator))
        tokens, spans = cm.annotated_tokens(noted), cm.annotated_spans(noted)
    else:
        tokens, spans = cm.native_tokens(docs).drop("start"), spark.createDataFrame([], cm.SPAN_SCHEMA)
    batch = first + F.floor(F.col("doc_id") / batch_size)
    out = cm.render(tokens, spans).withColumn("batch_id", batch)
    sinks.write_batches(out, out_path, mode="overwrite", replace="dynamic")
    batches = -(-texts.count() // batch_size)
    (texts.select("file_path").distinct().withColumn("next_batch", F.lit(first + batches).cast("long"))
     .write.mode("append").parquet(f"{out_path}/_files"))
    return out


DONE_SCHEMA = "file_path string, next_batch long"


def checkpointed(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def list_dir(spark, path: str) -> list[str]:
    """Names in a folder of any Hadoop file system (local, HDFS, object stores); empty if missing."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def replace_dir(spark, made: str, path: str) -> None:
    """Puts the folder ``made`` in the place of ``path``."""
    jvm = spark.sparkContext._jvm
    new, old = jvm.org.apache.hadoop.fs.Path(made), jvm.org.apache.hadoop.fs.Path(path)
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"{made} can't be renamed to {path}")
