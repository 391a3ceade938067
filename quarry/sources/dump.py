"""Encyclopedia XML dumps as tables (S01-S05, S02 compression, S07 globs).

Spark 4's built-in XML source splits a dump on ``<page>`` elements (bz2 is
splittable; gzip is not, so a gzip dump is repartitioned after the scan).
The schema is given explicitly: only the fields that are used are
parsed, and the text stays as written (``ignoreSurroundingSpaces=false``).
The XML source decodes ``&lt;`` once, as the reader should.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = ("title string, ns int, id long, redirect struct<_title:string>, "
               "revision array<struct<id:long, text:string, contributor:struct<id:long, username:string>>>")
SITEINFO_SCHEMA = ("sitename string, base string, "
                   "namespaces struct<namespace:array<struct<_key:int, _case:string, _VALUE:string>>>")


def _xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return (spark.read.format("xml").option("rowTag", row_tag)
            .option("ignoreSurroundingSpaces", "false").schema(schema).load(path))


def read_pages(spark: SparkSession, path: str, all_revisions: bool = False) -> DataFrame:
    """``pages(page_id, ns, title, redirect_title, rev_id, text, file_path)``.

    The latest revision is kept (Q01/Q02 fixes); ``all_revisions`` joins
    every revision's text, as the reference's line reader does (A02).
    """
    raw = _xml(spark, path, "page", PAGE_SCHEMA)
    last = F.element_at("revision", -1)
    text = (F.array_join(F.transform("revision", lambda r: F.coalesce(r["text"], F.lit(""))), "")
            if all_revisions else F.coalesce(last["text"], F.lit("")))
    df = raw.select(F.col("id").alias("page_id"), F.coalesce("ns", F.lit(0)).alias("ns"), "title",
                    F.col("redirect._title").alias("redirect_title"), last["id"].alias("rev_id"),
                    text.alias("text"), F.col("_metadata.file_path").alias("file_path"))
    if path.endswith(".gz"):
        df = df.repartition(spark.sparkContext.defaultParallelism)
    return df


def write_pages(pages: DataFrame, path: str, compress: bool = True, mode: str = "overwrite") -> None:
    """Pages as XML dump files that ``read_pages`` reads, a file per partition, bz2-compressed unless told otherwise.

    ``revisions`` (array of id and text, oldest first) gives a page all of them; without that column
    ``rev_id`` and ``text`` are its only one.
    """
    revision = (F.col("revisions") if "revisions" in pages.columns
                else F.array(F.struct(F.col("rev_id").alias("id"), F.col("text").alias("text"))))
    redirect = F.when(F.col("redirect_title").isNotNull(), F.struct(F.col("redirect_title").alias("_title")))
    out = pages.select("title", "ns", F.col("page_id").alias("id"), redirect.alias("redirect"), revision.alias("revision"))
    writer = out.write.mode(mode).format("xml").option("rowTag", "page").option("rootTag", "mediawiki")
    (writer.option("compression", "bzip2") if compress else writer).save(path)


def read_siteinfo(spark: SparkSession, path: str) -> DataFrame:
    """``(sitename, base, url_base)``, one row per different site among the dumps of ``path``."""
    s = _xml(spark, path, "siteinfo", SITEINFO_SCHEMA)
    return s.distinct().select("sitename", "base", F.regexp_replace("base", r"/[^/]*$", "").alias("url_base"))


def read_namespaces(spark: SparkSession, path: str) -> DataFrame:
    """``namespaces(ns_key, ns_name)``; key 0 has no name."""
    s = _xml(spark, path, "siteinfo", SITEINFO_SCHEMA)
    ns = s.select(F.explode("namespaces.namespace").alias("n"))
    return ns.select(F.col("n._key").alias("ns_key"),
                     F.when(F.trim(F.col("n._VALUE")) != "", F.col("n._VALUE")).alias("ns_name")).distinct()


def site_options(spark: SparkSession, path: str, opts):
    """Options completed from the dump header: URL base, known namespaces, template/module prefixes.

    Both tables are tiny (one row, one row per namespace) and are collected.
    """
    sites = read_siteinfo(spark, path).select("url_base").distinct().limit(2).collect()
    if len(sites) > 1:
        raise ValueError("the dumps are of several sites: read each site's with options of its own")
    info = sites[0] if sites else None
    names = [(r.ns_name, r.ns_key) for r in read_namespaces(spark, path).collect() if r.ns_name]
    kw = {"known_namespaces": tuple(names) or opts.known_namespaces}
    if info is not None:
        kw["url_base"] = info.url_base
    for name, key in names:
        if key == 10:
            kw["template_prefix"] = name + ":"
        elif key == 828:
            kw["module_prefix"] = name + ":"
    return opts.with_(**kw)


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """A template dictionary saved by K05 (parquet)."""
    return spark.read.parquet(path)
