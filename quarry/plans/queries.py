"""Registered queries: one per operator family of the inventory.

Each takes ``(spark, sf_dir)``, reads the driver's tables (or the wiki /
comment views Spark derives from them) and returns a DataFrame whose
columns match the SQL twin in ``quarry.plans.oracles``.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import markup
from quarry.functions.text import unescape
from quarry.operators import comments as cm
from quarry.operators import joins, links, select, shape, sinks, spans
from quarry.operators import templates as tpl
from quarry.options import Options
from quarry.plans import jobs
from quarry.session import checkpoint_dir, shuffle_partitions
from quarry.sources import dump, fixtures
from quarry.streaming import incremental

URL_BASE = "https://wiki.example.org/wiki"
OPTS = Options(url_base=URL_BASE)
#: V3 has a template that calls itself: it stops at this depth.
NESTED_OPTS = OPTS.with_(max_template_depth=6)


def _v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.wiki_pages(spark, sf_dir)


def _v1_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _v1(spark, sf_dir).withColumn("text", unescape("text"))


def _kept_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles, spread over the cores after the filters, then decoded."""
    return select.spread(select.keep_pages(_v1(spark, sf_dir))).withColumn("text", unescape("text"))


def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.spread(fixtures.table(spark, sf_dir, "pages"))


# ---------------------------------------------------------------- selection

def q_articles(spark, sf_dir):
    """F01."""
    return select.articles(_v1(spark, sf_dir)).select("page_id", "title")


def q_kept_pages(spark, sf_dir):
    """F01 + F02."""
    return select.keep_pages(_v1(spark, sf_dir)).select("page_id", "title")


def q_disambiguation(spark, sf_dir):
    """F03 on decoded article text."""
    d = select.articles(_v1_decoded(spark, sf_dir))
    return select.drop_disambiguation(d).select("page_id", "title")


def q_template_pages(spark, sf_dir):
    """F06."""
    return select.template_pages(_v1(spark, sf_dir)).select("page_id", "ns", "title")


def q_page_num(spark, sf_dir):
    """W01 (range partitions + offsets) + P01 + P04 on kept pages."""
    d = select.with_page_num(select.keep_pages(_v1(spark, sf_dir)))
    return d.select("page_id", "page_num", select.page_url("page_id", URL_BASE).alias("url"),
                    F.col("rev_id").cast("string").alias("revid"))


def q_title_parts(spark, sf_dir):
    """P02 over every page title."""
    d = select.with_title_parts(_v1(spark, sf_dir))
    return d.select("page_id", "NAMESPACE", "PAGENAME", "FULLPAGENAME", "BASEPAGENAME",
                    "SUBPAGENAME", "ROOTPAGENAME")


def q_normalize_title(spark, sf_dir):
    """P06, P07, P08 on titles written in untidy forms."""
    d = _v1(spark, sf_dir)
    raw = F.concat(F.lit(" _"), F.lower(F.col("title")), F.lit("__ "))
    spaced = F.regexp_replace(F.col("title"), ":", ":  ")
    return d.select(
        "page_id",
        select.normalize_title(raw, ["Template", "Module", "Project"]).alias("norm_title"),
        select.normalize_title(spaced, ["Template"]).alias("norm_spaced"),
        select.first_upper(F.lower("title")).alias("ucfirst"),
        select.first_lower(F.col("title")).alias("lcfirst"),
        select.qualified_template_title(F.lower(F.substring_index("title", ":", -1)), "Template:",
                                        ["Template", "Module"]).alias("qualified"))


# ---------------------------------------------------------------- templates

def q_template_definitions(spark, sf_dir):
    """F06 + E04 + E05 + F07."""
    return tpl.definitions(_v1_decoded(spark, sf_dir)).select("page_id", "title", "ns", "body", "redirect_to")


def q_template_dictionary(spark, sf_dir):
    """Last definition wins, redirects beside."""
    return tpl.template_dictionary(_v1_decoded(spark, sf_dir))


def q_template_calls(spark, sf_dir):
    """E01 + E02 + E03: innermost calls of articles, their title and bound arguments."""
    d = select.keep_pages(_v1_decoded(spark, sf_dir))
    calls = d.select("page_id", F.posexplode(F.regexp_extract_all("text", F.lit(tpl.INNER_CALL_RE), 0))
                     .alias("pos", "call"))
    parts = tpl.call_parts(F.col("call"))
    bound = calls.select("page_id", "pos", "call", tpl.call_title(F.col("call")).alias("name"),
                         F.explode_outer(tpl.bind(F.slice(parts, 2, 1 << 20))).alias("arg", "value"))
    return bound


def q_expanded_text(spark, sf_dir):
    """E09 (J01, J02, E06): article text after template expansion."""
    d = select.keep_pages(_v1(spark, sf_dir)).repartition("page_id").withColumn("text", unescape("text"))
    t = tpl.template_dictionary(_v1_decoded(spark, sf_dir))
    return tpl.expand(d, t, OPTS).select("page_id", "text")


def q_parser_functions(spark, sf_dir):
    """Calls built from each whole document, evaluated as columns."""
    # A document's calls repeat its text a dozen times and their values half as often, so neither moves: the documents do, once, to where
    # copies of their text are.  There the distinct calls are evaluated and looked up, the rows by the calls' digests.
    docs = _beside_copies(fixtures.table(joins.within_parts(spark), sf_dir, "documents"))
    calls = _function_calls(docs, "_place")
    digest = F.unhex(F.sha2(F.col("call"), 256)).alias("_call")
    none = docs.sparkSession.sql("SELECT '' AS title, '' AS body WHERE false")  # known to be empty: nothing moves to be joined with it
    values = tpl.evaluate_calls(calls.select("_place", "call").distinct(), none, OPTS, hot_rows=None, keep=("_place",))
    # No place has many rows, so no call of one is hot.
    values = values.select("_place", digest, "value").hint("merge")  # far larger than the files by which Spark judges whether to broadcast them
    return joins.lookup(calls.select("_place", "doc_id", "fn", digest), values, ["_place", "_call"], hot_rows=None).select("doc_id", "fn", "value")


#: Bytes of text in a partition, about, and copies of a text from which they are spread over several places.
PLACE_BYTES, MANY_COPIES = 8 << 20, 1_000


def _beside_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_place``, partitioned by it: copies of a text share one, those of a text with many one of ``SALTS``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = joins.hot_hashes(docs.select("text", F.lit(1).alias("_rows")), "text", MANY_COPIES)
    place = F.when(F.col("text").isNull(), F.xxhash64("doc_id"))
    if many:
        place = place.when(F.xxhash64("text").isin(many), F.xxhash64("text", F.pmod(F.xxhash64("doc_id"), F.lit(joins.SALTS))))
    placed = docs.withColumn("_place", place.otherwise(F.xxhash64("text")))
    return placed.repartition(max(shuffle_partitions(docs.sparkSession), -(-size // PLACE_BYTES)), "_place")


def _function_values(calls: DataFrame) -> DataFrame:
    """Values of the distinct calls, written once: the join reads them for its hot and its other keys."""
    none = calls.sparkSession.createDataFrame([], "title string, body string")
    # No title is found in a dictionary without rows, so none needs a split join.
    values = tpl.evaluate_calls(calls.select("call").distinct(), none, OPTS, hot_rows=None)
    return jobs.checkpointed(values.select("call", "value"))


def _function_calls(docs: DataFrame, *keep: str) -> DataFrame:
    a, b = F.regexp_replace(F.col("text"), r"[|{}=\[\]]", ""), F.coalesce("lang", F.lit(""))
    n = F.col("doc_id").cast("string")
    forms = {
        "uc": F.concat(F.lit("{{uc:"), a, F.lit("}}")),
        "lc": F.concat(F.lit("{{lc:"), a, F.lit("}}")),
        "ucfirst": F.concat(F.lit("{{ucfirst:"), F.lower(a), F.lit("}}")),
        "lcfirst": F.concat(F.lit("{{lcfirst:"), a, F.lit("}}")),
        "urlencode": F.concat(F.lit("{{urlencode:"), a, F.lit(" "), b, F.lit("}}")),
        "int": F.concat(F.lit("{{int: "), n, F.lit(" }}")),
        "if": F.concat(F.lit("{{#if:"), F.when(F.col("doc_id") % 3 == 0, F.lit(" ")).otherwise(a),
                       F.lit("| yes |no }}")),
        "ifeq": F.concat(F.lit("{{#ifeq: "), F.col("lang"), F.lit(" |en| same | other}}")),
        "switch": F.concat(F.lit("{{#switch: "), F.col("lang"), F.lit(" | fr = French | de | es = Iberian | #default = other}}")),
        "expr": F.concat(F.lit("{{#expr: "), n, F.lit(" + 1}}")),
        "len": F.concat(F.lit("{{#invoke:String|len|"), a, F.lit("}}")),
        "sub": F.concat(F.lit("{{#invoke:String|sub|"), a, F.lit("|2|3}}")),
        "pos": F.concat(F.lit("{{#invoke:String|pos|"), a, F.lit("|1}}")),
        "find": F.concat(F.lit("{{#invoke:String|find|"), a, F.lit(" "), b, F.lit("|e}}")),
        "replace": F.concat(F.lit("{{#invoke:String|replace|"), a, F.lit("|e|E}}")),
        "roman": F.concat(F.lit("{{#invoke:Roman|main|"), n, F.lit("}}")),
        "if_empty": F.concat(F.lit("{{#invoke:If empty|main||"), b, F.lit("|x}}")),
        "convert": F.concat(F.lit("{{#invoke:convert|convert|"), n, F.lit("|km}}")),
    }
    return docs.select(*keep, "doc_id", F.explode(F.create_map(*[x for k, v in forms.items() for x in (F.lit(k), v)]))
                       .alias("fn", "call"))


def q_more_functions(spark, sf_dir):
    """Error tests, existence, the functions without a value, parts and repeats of texts."""
    docs = fixtures.table(spark, sf_dir, "documents")
    a, lang = F.regexp_replace(F.col("text"), r"[|{}=\[\]]", ""), F.coalesce("lang", F.lit(""))
    test = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit('<strong class="error">'), lang, F.lit("</strong>"))).otherwise(F.concat(F.lit("fine "), lang))
    call = lambda *parts: F.concat(F.lit("{{"), *[F.lit(x) if isinstance(x, str) else x for x in parts], F.lit("}}"))
    forms = {
        "iferror": call("#iferror: ", test, " | bad | good "), "iferror_2": call("#iferror: ", test, "|bad"),
        "iferror_1": call("#iferror: ", test), "ifexist": call("#ifexist: ", lang, " | yes | no"), "ifexist_2": call("#ifexist:", lang, "|yes"),
        **{name: call(f"#{name}: ", lang, "|x") for name in ("ifexpr", "rel2abs", "language", "time", "timel", "titleparts")},
        "sublength": call("#invoke:String|sublength|", a, "|3|4"), "sublength_end": call("#invoke:String|sublength|", a, "|-5|3"),
        "rep": call("#invoke:String|rep|", lang, "|", (F.col("doc_id") % 4).cast("string")),
    }
    calls = docs.select("doc_id", F.explode(F.create_map(*[x for k, v in forms.items() for x in (F.lit(k), v)])).alias("fn", "call"))
    return joins.lookup(calls, _function_values(calls), "call", spread_by="doc_id").select("doc_id", "fn", "value")


def q_nowiki(spark, sf_dir):
    """Calls between ``<nowiki>`` marks stay as they are, those beside them are expanded."""
    plain = F.translate("text", "{}|<>", "     ")
    lang, source = F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))
    docs = fixtures.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"), F.lit("P").alias("title"),
        F.concat(F.lit("a <nowiki>{{Pair|"), lang, F.lit("}} </nowiki>{{Pair|"), source, F.lit("}} <nowiki>{{</nowiki> "), plain).alias("text"))
    pair = spark.createDataFrame([(1, 10, "Template:Pair", "({{{1}}}+{{{1}}})")], "page_id long, ns int, title string, text string")
    return tpl.expand(docs.repartition("page_id"), tpl.template_dictionary(pair), OPTS).select("page_id", "text")


# ---------------------------------------------------------------- cleaning

def q_kept_tables(spark, sf_dir):
    """Documents between table marks, with tables kept."""
    head = F.concat(F.lit('{| class=x\n! style="width:20%;" '), F.coalesce("lang", F.lit("")), F.lit('\n!style="width:5%;color:#ff0" H\n|-\n| '))
    d = fixtures.table(spark, sf_dir, "documents").select("doc_id", F.concat(head, F.coalesce("text", F.lit("")), F.lit("\n|}")).alias("text"))
    return markup.clean(d, "text", OPTS.with_(keep_tables=True))


def q_escaped_html(spark, sf_dir):
    """The cleaning chain on web pages in HTML mode."""
    return markup.clean(_html(spark, sf_dir).select("page_id", F.col("html").alias("text")), "text", OPTS.with_(to_html=True))


def q_image_links(spark, sf_dir):
    """External links whose label is an image, or isn't, without and with links kept."""
    end = F.when(F.col("doc_id") % 3 == 0, ".png").when(F.col("doc_id") % 3 == 1, ".JPG").otherwise(".txt")
    text = F.concat(F.lit("a [http://e.org/"), "doc_id", F.lit(" http://e.org/i/"), "doc_id", end, F.lit("] [https://x.org/ "), F.coalesce("lang", F.lit("")),
                    F.lit(" label] "), F.translate("text", "[]", "  "))
    d = fixtures.table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return d.select("doc_id", markup.external_links("text", OPTS).alias("plain"), markup.external_links("text", OPTS.with_(to_html=True)).alias("linked"))


def q_unescape_html(spark, sf_dir):
    """C01 on raw web pages."""
    return _html(spark, sf_dir).select("page_id", unescape("html").alias("text"))


def q_html_tags(spark, sf_dir):
    """C02-C05 on raw web pages."""
    d = _html(spark, sf_dir).select("page_id", F.col("html").alias("text"))
    steps = markup.clean_steps(OPTS)[:3] + [lambda c: markup.drop_elements(c, OPTS.discard_elements)]
    return markup.steps_apply(d, "text", steps)


def q_spans(spark, sf_dir):
    """Spans of C02-C05 on raw web pages by rule, and the texts without their union."""
    d = _html(spark, sf_dir).select("page_id", F.col("html").alias("text"))
    counted = spans.rule_spans(d, OPTS).groupBy("page_id").agg(*[
        F.count(F.when(F.col("rule") == rule, 1)).alias(f"n_{rule}") for rule in ("comment", "self_closing", "ignored_tag")])
    out = spans.cleaned(d, OPTS).join(counted, "page_id", "left")
    return out.select("page_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counted.columns[1:]], "text")


def q_html_to_text(spark, sf_dir):
    """Cleaning chain on web pages."""
    return jobs.html_text(_html(spark, sf_dir), OPTS).select("page_id", "text")


def q_wiki_markup(spark, sf_dir):
    """Calls and tables dropped, quotes, internal and external links, switches."""
    d = _kept_decoded(spark, sf_dir).select("page_id", "text")
    return markup.wiki2text(d, "text", OPTS)


def q_wiki_markup_html(spark, sf_dir):
    """C06-C14 in HTML mode: bold and italic tags, internal and external links kept as anchors."""
    d = _kept_decoded(spark, sf_dir).select("page_id", "text")
    return markup.wiki2text(d, "text", OPTS.with_(to_html=True))


def q_clean_text(spark, sf_dir):
    """The whole chain (no expansion) on articles."""
    d = _kept_decoded(spark, sf_dir).select("page_id", "text")
    return markup.to_text(d, "text", OPTS.with_(expand_templates=False))


def q_tidy_documents(spark, sf_dir):
    """C17-C21 on documents."""
    d = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text")
    steps = [lambda c, t=t, w=w: markup.placeholder(c, t, w) for t, w in markup.PLACEHOLDER_TAGS] + markup.tidy_steps()
    return markup.steps_apply(d, "text", steps)


def q_strip_comments(spark, sf_dir):
    """C26 + S09: comment metadata stripped, trimmed, non-null."""
    return cm.comment_texts(fixtures.comments(spark, sf_dir)).select("conv_id", "turn", "text")


# ---------------------------------------------------------------- shaping

def _cleaned(spark, sf_dir):
    d = select.keep_pages(_v1(spark, sf_dir)).select("page_id", "title", "text").repartition(shuffle_partitions(spark), "page_id")
    return markup.to_text(d.withColumn("text", unescape("text")), "text", OPTS)


def q_lines(spark, sf_dir):
    """L01 + L03: every line of cleaned articles with its kind and header."""
    ln = shape.classify(shape.lines(_cleaned(spark, sf_dir)))
    return ln.select("page_id", "line_no", "line", "kind", "level", "head")


def q_compact(spark, sf_dir):
    """L13 (L02-L12, W03): shaped lines joined."""
    c = shape.compact(_cleaned(spark, sf_dir).select("page_id", "text"), OPTS)
    return c.select("page_id", F.array_join("lines", "\n").alias("text"))


def q_compact_sections(spark, sf_dir):
    """Sections and lists kept."""
    o = OPTS.with_(keep_sections=True, keep_lists=True)
    c = shape.compact(_cleaned(spark, sf_dir).select("page_id", "text"), o)
    return c.select("page_id", F.array_join("lines", "\n").alias("text"))


def q_html_lists(spark, sf_dir):
    """L04, L06 in HTML mode: headers, and items between the tags of their lists."""
    c = shape.compact(_cleaned(spark, sf_dir).select("page_id", "text"), OPTS.with_(to_html=True))
    return c.select("page_id", F.array_join("lines", "\n").alias("text"))


def q_page_titles(spark, sf_dir):
    """Lines that hold a page's title between plus signs, some of them empty."""
    mark = F.concat(F.lit("++"), "title", F.when(F.col("page_id") % 3 == 0, "?").otherwise(""), F.lit("++\n"), F.when(F.col("page_id") % 5 == 0, "++++\n").otherwise(""))
    d = _v1(spark, sf_dir).select("page_id", F.concat(mark, "text").alias("text"))
    return shape.compact(d, OPTS).select("page_id", F.array_join("lines", "\n").alias("text"))


# ---------------------------------------------------------------- links

def q_internal_links(spark, sf_dir):
    """G01 (F09 column)."""
    return links.internal_links(_kept_decoded(spark, sf_dir), OPTS)


def q_external_links(spark, sf_dir):
    """G02."""
    return links.external_links(_kept_decoded(spark, sf_dir))


# ---------------------------------------------------------------- jobs and sinks

def q_documents(spark, sf_dir):
    """The flagship, dump pages -> documents."""
    return jobs.documents(_v1(spark, sf_dir), OPTS)


def q_json_lines(spark, sf_dir):
    """JSON line per document, with revid."""
    d = jobs.documents(_v1(spark, sf_dir), OPTS.with_(print_revision=True, min_text_length=300))
    return d.select("id", sinks.json_line(d).alias("line"))


def q_doc_blocks(spark, sf_dir):
    """K02 with revision ids."""
    o = OPTS.with_(print_revision=True)
    d = jobs.documents(_v1(spark, sf_dir), o)
    return d.select("id", sinks.doc_block(d, o).alias("block"))


def q_word_counts(spark, sf_dir):
    """A05 keyed map-reduce: words of stripped comments counted."""
    return cm.word_counts(cm.comment_texts(fixtures.comments(spark, sf_dir)))


def q_tagged_sentences(spark, sf_dir):
    """Annotated tokens rendered as tagged sentences."""
    toks, spans = fixtures.stand_in_annotation(fixtures.table(spark, sf_dir, "conversations"))
    return cm.render(toks, spans)


def q_comment_batches(spark, sf_dir):
    """Batches of 100 comments in (conv_id, turn) order."""
    c = cm.comment_texts(fixtures.comments(spark, sf_dir))
    return cm.batches(c, 100, ["conv_id", "turn"]).select("conv_id", "turn", "batch_id")


def q_run_totals(spark, sf_dir):
    """Pages read, kept and template pages."""
    return jobs.run_totals(_v1(spark, sf_dir))


def q_repeated_ids(spark, sf_dir):
    """F05/W02 on a dump where every page appears twice in a row (FIXTURES F1 edge case)."""
    v = _v1(spark, sf_dir).select("page_id", "title")
    twice = v.withColumn("copy", F.lit(0)).unionByName(v.withColumn("copy", F.lit(1)))
    numbered = select.with_page_num(twice.withColumn("_o", F.struct("page_id", "copy")), "_o").drop("_o")
    return select.drop_repeated_ids(numbered).select("page_id", "page_num", "copy")


def _nested(spark, sf_dir):
    """V3 articles expanded, with the errors met on the way."""
    pages = fixtures.nested_pages(spark, sf_dir)
    return tpl.expand(select.keep_pages(pages), tpl.template_dictionary(pages), NESTED_OPTS, errors=True)


def q_nested_expansion(spark, sf_dir):
    """Templates that call templates, in arguments, defaults and branches."""
    return _nested(spark, sf_dir).select("page_id", "text")


def q_template_errors(spark, sf_dir):
    """Per article, calls without a title and template calls at the depth cap, counted while expanding."""
    return _nested(spark, sf_dir).select("page_id", *tpl.ERRORS)


def q_frame_arguments(spark, sf_dir):
    """Module calls without arguments, two templates below the call whose arguments they take."""
    docs = fixtures.table(spark, sf_dir, "documents")
    word = F.regexp_replace("text", r"[|{}=\[\]]", "")
    call = (F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("{{String|"), word, F.lit("}}{{Lone|zz}}")))
            .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("{{Outer|a="), F.col("source"), F.lit("}}")))
            .otherwise(F.concat(F.lit("{{String|{{Lone|k}}}}/{{String|s="), F.col("lang"), F.lit("}}"))))
    pages = docs.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"), call.alias("text"))
    bodies = [("Template:String", "<{{Wrap|q}}>"), ("Template:Wrap", "{{Lone|zz}}:{{#invoke:String|pos}}"),
              ("Template:Lone", "{{#invoke:String|len}}"), ("Template:Outer", "{{String|{{{a}}}!}}-{{Wrap}}")]
    templates = spark.createDataFrame([(t, b, None) for t, b in bodies], "title string, body string, redirect_to string")
    return tpl.expand(pages, templates, OPTS).select("page_id", "text")


def q_magic_words(spark, sf_dir):
    """E07 (P02, P03, J03): magic words of each page, answered through the expansion rounds."""
    d = _v1(spark, sf_dir).select("page_id", "title", F.lit(
        "{{PAGENAME}}|{{NAMESPACE}}|{{NAMESPACENUMBER}}|{{SUBPAGENAME}}|{{CURRENTYEAR}}-{{CURRENTMONTH}}"
        "|{{CURRENTTIME}}|{{FULLPAGENAME}}{{!}}").alias("text")).repartition("page_id")
    empty = spark.createDataFrame([], "title string, body string, redirect_to string")
    return tpl.expand(d, empty, OPTS).select("page_id", "text")


FILE_BYTES = 200 * 1024


def q_file_numbers(spark, sf_dir):
    """Documents packed greedily into files of at most 200 KiB."""
    rec = sinks.rendered(jobs.documents(_v1(spark, sf_dir), OPTS), OPTS).withColumn("page_num", F.col("id").cast("long"))
    return sinks.file_numbers(sinks._kept(rec.select("id", "page_num", "bytes")), FILE_BYTES).select("id", "file_id", "bytes")


def q_written_corpus(spark, sf_dir):
    """Documents written as JSON lines in bz2 files of at most 200 KiB and read back in order; the run's totals."""
    path = _scratch(spark, "corpus")
    totals = jobs.write_corpus(_v1(spark, sf_dir), path, OPTS.with_(write_json=True, compress=True, file_bytes=FILE_BYTES))
    lines = spark.read.text(path, wholetext=True)
    each = lines.select(F.col("file_id").cast("string").alias("file"), F.posexplode(F.split(F.regexp_replace("value", r"\n$", ""), "\n")).alias("nth", "line"))
    rows = [(k, 0, str(n)) for k, n in totals.items()]
    return each.unionByName(spark.createDataFrame(rows, "file string, nth int, line string"))


def _two_dumps(spark, sf_dir):
    """V1 as the dumps of two sites whose ids agree: pages of each that come twice, and pages without an id."""
    v = _v1(spark, sf_dir)
    one = v.withColumn("file_path", F.lit("a.xml"))
    two = v.where("page_id % 3 <> 0").select("*", F.lit("b.xml").alias("file_path")).withColumn("title", F.concat("title", F.lit(" B")))
    twice = one.where("page_id % 4 = 1").withColumn("rev_id", F.col("rev_id") + 1).withColumn("title", F.concat("title", F.lit(" again")))
    lost = F.when(F.col("page_id") % 7 != 3, F.col("page_id"))
    return one.unionByName(two).unionByName(twice).withColumn("page_id", lost)


def q_repeated_documents(spark, sf_dir):
    """Pages of two dumps under one path keep their own documents, repeats in a row give one."""
    d = jobs.documents(_two_dumps(spark, sf_dir), OPTS.with_(expand_templates=False), numbered=True)
    return d.select("id", "title", "text")


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _dump(spark, sf_dir):
    """V1 written as bz2 dump files, two revisions a page."""
    path = _scratch(spark, "dump")
    old = F.struct((F.col("rev_id") - 50000).alias("id"), F.concat(F.lit("old "), "title", F.lit("\n")).alias("text"))
    new = F.struct(F.col("rev_id").alias("id"), F.col("text").alias("text"))
    dump.write_pages(_v1(spark, sf_dir).withColumn("revisions", F.array(old, new)), path)
    return path


def q_dump_round_trip(spark, sf_dir):
    """Pages written as a compressed XML dump and read back, latest revision."""
    return dump.read_pages(spark, f"{_dump(spark, sf_dir)}/*.bz2").drop("file_path")


def q_all_revisions(spark, sf_dir):
    """All revisions of a page run together, from the same dump."""
    return dump.read_pages(spark, f"{_dump(spark, sf_dir)}/*.bz2", all_revisions=True).select("page_id", "text")


def q_merged_dictionary(spark, sf_dir):
    """A dictionary of the first half of the pages, saved, then brought up to date with the second."""
    pages, path = _v1(spark, sf_dir), _scratch(spark, "dictionary")
    half = (pages.agg(F.max("page_id")).first()[0] or 0) // 2
    jobs.update_dictionary(spark, pages.where(F.col("page_id") <= half), path, OPTS)
    return jobs.update_dictionary(spark, pages.where(F.col("page_id") > half), path, OPTS)[0]


def q_exactly_once(spark, sf_dir):
    """Comments streamed in several micro-batches, one of them run twice."""
    where = _scratch(spark, "stream")
    bodies = fixtures.comments(spark, sf_dir).select("conv_id", "turn", "body")
    bodies.repartition(4).write.json(f"{where}/in")
    src = spark.readStream.schema(bodies.schema).option("maxFilesPerTrigger", 1).json(f"{where}/in")

    def write(batch, number, out_dir):
        for _ in range(2 if number == 1 else 1):
            incremental.write_batch(batch, number, out_dir)

    incremental.stream_in_batches(src, f"{where}/out", f"{where}/checkpoint", cm.comment_texts, write)
    return incremental.read_batches(spark, f"{where}/out").select("conv_id", "turn", "text")


def q_comment_job(spark, sf_dir):
    """B03, R06 (S06, S07, F08, J05, K06): comments in bz2 files, some lines broken, done in two runs; sentences of all batches and what was read."""
    where = _scratch(spark, "comments")
    bodies = fixtures.comments(spark, sf_dir).select("conv_id", F.to_json(F.struct("body")).alias("value"))
    broken = bodies.where(F.col("conv_id") % 10 == 0).withColumn("value", F.expr("left(value, length(value) - 2)"))
    files = bodies.unionByName(broken).repartition(3, "conv_id")
    halves = [files.where(F.col("conv_id") % 2 == half).select("value") for half in (0, 1)]
    read = {"records": 0, "bad_records": 0}
    for half, rows in enumerate(halves):  # the second run meets the first one's files again
        rows.write.option("compression", "bzip2").text(f"{where}/in/{half}")
        totals: dict = {}
        jobs.comment_job(spark, f"{where}/in/*/*.bz2", f"{where}/out", batch_size=100, totals=totals)
        read = {k: n + totals[k] for k, n in read.items()}
    sentences = spark.read.text(f"{where}/out").select(F.lit("sentence").alias("kind"), "value")
    return sentences.unionByName(spark.createDataFrame([(k, str(n)) for k, n in read.items()], "kind string, value string"))


def q_map_reduce(spark, sf_dir):
    """A caller's map (words by first character), combiner and reduce over comments."""
    def mapped(pdf):
        words = pdf["text"].str.split().explode().dropna()
        return pd.DataFrame({"first": words.str[:1], "n": 1, "longest": words.str.len()})

    def folded(pdf):
        return pdf.groupby("first", as_index=False).agg({"n": "sum", "longest": "max"})

    texts = cm.comment_texts(fixtures.comments(spark, sf_dir)).select("text")
    return cm.map_reduce(texts, mapped, "first string, n long, longest long", folded, key="first", combiner=folded)


def q_per_batch(spark, sf_dir):
    """A caller's worker over batches of 50 comments, with an extra argument."""
    def worker(pdf, least):
        long_ = pdf["text"].str.len() >= least
        return pd.DataFrame({"batch_id": pdf["batch_id"].iloc[:1], "n": len(pdf), "n_long": int(long_.sum()), "chars": int(pdf["text"].str.len().sum())})

    texts = cm.comment_texts(fixtures.comments(spark, sf_dir)).select("conv_id", "turn", "text")
    numbered = cm.batches(texts, 50, ["conv_id", "turn"]).select("batch_id", "text")
    return cm.per_batch(numbered, worker, "batch_id long, n long, n_long long, chars long", least=80)


def q_annotated(spark, sf_dir):
    """The offset-carrying tokens of every message."""
    docs = fixtures.table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
    return cm.native_tokens(docs).select("doc_id", "sent_id", "tok_id", "text", "start", "is_space", "like_url")


def q_highlighted_code(spark, sf_dir):
    """C15 through the whole chain: code keeps its tags and entities, text beside it doesn't."""
    docs = fixtures.table(spark, sf_dir, "documents")
    code = F.concat(F.lit('a <syntaxhighlight lang="x"><i>'), F.regexp_replace("text", "[^A-Za-z]", ""), F.lit("</i> &lt;b&gt; "), F.col("lang"),
                    F.lit("</syntaxhighlight> <i>z</i> &amp;lt;"))
    return markup.to_text(docs.select("doc_id", code.alias("text")), "text", OPTS.with_(expand_templates=False))


def q_deep_nesting(spark, sf_dir):
    """C05-C07, C11 on markup nested doc_id % 41 deep around each document's letters."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    depth = (F.col("doc_id") % 41).cast("int")
    words = F.regexp_replace("text", "[^A-Za-z ]", "")
    wrap = lambda a, z: F.concat(F.lit("L "), F.call_function("repeat", F.lit(a), depth), words,
                                 F.call_function("repeat", F.lit(z), depth), F.lit(" R"))
    d = docs.select("doc_id", wrap("{{x|", "}}").alias("calls"), wrap("{| a ", "|}").alias("tables"),
                    wrap("<div>", "</div>").alias("elements"), wrap("[[a|", "]]").alias("links"))
    for name, rule in (("calls", markup.drop_templates), ("tables", markup.drop_tables),
                       ("elements", lambda c: markup.drop_elements(c, ("div", "gallery"))), ("links", markup.internal_links)):
        d = d.withColumn(name, rule(F.col(name)))
    return d


def q_deep_items(spark, sf_dir):
    """W04 on lists that go doc_id % 12 + 1 deep and come back up, one item a word."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", (F.col("doc_id") % 12 + 1).cast("int").alias("d"))
    # Lines of one form compress to next to nothing: partitions joined by size would hold gigabytes of them.
    docs = docs.repartition(shuffle_partitions(spark), "doc_id")
    mark = lambda k: F.concat(F.call_function("repeat", F.lit("#"), k.cast("int")), F.lit(" x"))
    lines = F.concat(F.transform(F.sequence(F.lit(1), F.col("d")), mark), F.array(mark(F.col("d")), mark(F.lit(1))),
                     F.transform(F.sequence(F.lit(1), F.col("d")), mark))
    text = docs.select("doc_id", F.array_join(lines, "\n").alias("text"))
    c = shape.with_item_numbers(shape.classify(shape.lines(text, "doc_id", "text")), "doc_id")
    return c.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.length("prefix").cast("long").alias("depth"),
                    F.col("item_no").cast("long").alias("item_no"))


QUERIES = {
    "c11_deep_nesting": q_deep_nesting,
    "w04_deep_items": q_deep_items,
    "f01_articles": q_articles,
    "f02_kept_pages": q_kept_pages,
    "f03_disambiguation": q_disambiguation,
    "f06_template_pages": q_template_pages,
    "w01_page_num": q_page_num,
    "p02_title_parts": q_title_parts,
    "p06_normalize_title": q_normalize_title,
    "e04_template_definitions": q_template_definitions,
    "a01_template_dictionary": q_template_dictionary,
    "e03_template_calls": q_template_calls,
    "e09_expanded_text": q_expanded_text,
    "e10_parser_functions": q_parser_functions,
    "c01_unescape_html": q_unescape_html,
    "c05_html_tags": q_html_tags,
    "u01_spans": q_spans,
    "b04_html_to_text": q_html_to_text,
    "c14_wiki_markup": q_wiki_markup,
    "c14_wiki_markup_html": q_wiki_markup_html,
    "c25_clean_text": q_clean_text,
    "c21_tidy_documents": q_tidy_documents,
    "c26_strip_comments": q_strip_comments,
    "l03_lines": q_lines,
    "l13_compact": q_compact,
    "l06_html_lists": q_html_lists,
    "l04_compact_sections": q_compact_sections,
    "g01_internal_links": q_internal_links,
    "g02_external_links": q_external_links,
    "b01_documents": q_documents,
    "k01_json_lines": q_json_lines,
    "k02_doc_blocks": q_doc_blocks,
    "a05_word_counts": q_word_counts,
    "r05_tagged_sentences": q_tagged_sentences,
    "w06_comment_batches": q_comment_batches,
    "a04_run_totals": q_run_totals,
    "f05_repeated_ids": q_repeated_ids,
    "a03_template_errors": q_template_errors,
    "e07_magic_words": q_magic_words,
    "k03_file_numbers": q_file_numbers,
    "k04_written_corpus": q_written_corpus,
    "e09_nested": q_nested_expansion,
    "j06_frame_arguments": q_frame_arguments,
    "b01_repeated": q_repeated_documents,
    "s01_dump_round_trip": q_dump_round_trip,
    "a02_all_revisions": q_all_revisions,
    "b02_merged_dictionary": q_merged_dictionary,
    "s08_exactly_once": q_exactly_once,
    "r01_annotated": q_annotated,
    "n03_more_functions": q_more_functions,
    "c16_nowiki": q_nowiki,
    "c23_kept_tables": q_kept_tables,
    "c24_escaped_html": q_escaped_html,
    "c13_image_links": q_image_links,
    "l12_page_titles": q_page_titles,
    "b03_comment_job": q_comment_job,
    "x01_map_reduce": q_map_reduce,
    "x02_per_batch": q_per_batch,
    "c15_highlighted_code": q_highlighted_code,
}
