"""Comment corpus.

Annotation itself (a language model) is a caller-given function run with
``mapInPandas``, loaded once per task.  Everything after it -- span merging,
noun-chunk trimming, tag mapping, sentence assembly -- is joins and grouped
aggregation over token rows, partitioned once by document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import col_, strip_ws
from quarry.operators.select import with_page_num
from quarry.session import shuffle_partitions

# Entity label -> coarse tag.
LABELS = {
    "ENT": "ENT", "PERSON": "ENT", "NORP": "ENT", "FAC": "ENT", "ORG": "ENT", "GPE": "ENT",
    "LOC": "ENT", "LAW": "ENT", "PRODUCT": "ENT", "EVENT": "ENT", "WORK_OF_ART": "ENT",
    "LANGUAGE": "ENT", "DATE": "DATE", "TIME": "TIME", "PERCENT": "PERCENT", "MONEY": "MONEY",
    "QUANTITY": "QUANTITY", "ORDINAL": "ORDINAL", "CARDINAL": "CARDINAL",
}
# Dependency labels a noun chunk may start with.
CHUNK_START_DEPS = ("advmod", "amod", "compound")

TOKEN_SCHEMA = ("doc_id long, sent_id int, tok_id int, text string, pos string, dep string, "
                "ent_type string, is_space boolean, like_url boolean")
SPAN_SCHEMA = "doc_id long, kind string, start_tok int, end_tok int, label string"


def _struct_of(schema: str) -> str:
    """The fields of a row schema but its doc_id, as a struct type."""
    fields = [f.strip().split() for f in schema.split(",")]
    return "struct<" + ", ".join(f"{n}: {t}" for n, t in fields if n != "doc_id") + ">"


NOTED_SCHEMA = f"doc_id long, tokens array<{_struct_of(TOKEN_SCHEMA)}>, spans array<{_struct_of(SPAN_SCHEMA)}>"


def labels_map() -> Column:
    return F.create_map(*[x for k, v in LABELS.items() for x in (F.lit(k), F.lit(v))])


# C26
def strip_meta(c) -> Column:
    """Markdown link -> its text; ``&gt;``/``&lt;`` decoded; one leading and one trailing `` ` * ~ `` dropped."""
    t = F.regexp_replace(col_(c), r"\[([^\]]+)\]\(https?://[^\)]+\)", "$1")
    t = F.replace(F.replace(t, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<"))
    t = F.regexp_replace(t, r"^[`*~]", "")
    return F.regexp_replace(t, r"[`*~]$", "")


def comment_texts(df: DataFrame, body: str = "body") -> DataFrame:
    """S09 + F08: bad records (NULL body) skipped, metadata stripped, trimmed."""
    return df.where(F.col(body).isNotNull()).withColumn("text", strip_ws(strip_meta(body)))


# W06
def batches(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Batches of ``n`` records in ``order`` (consecutive numbering without a global window)."""
    key = "_ord"
    keyed = df.withColumn(key, F.struct(*order))
    numbered = with_page_num(keyed, key).withColumnRenamed("page_num", "row_num")
    return numbered.withColumn("batch_id", F.floor(F.col("row_num") / n)).drop(key)


# A05 / X01
def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Keyed map-reduce: map = split into words, reduce = count per word (partial counts before the shuffle)."""
    words = df.select(F.explode(F.split(F.col(text), r"(?U)\s+")).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def map_reduce(df: DataFrame, mapper: Callable[[pd.DataFrame], pd.DataFrame], map_schema: str,
               reducer: Callable[[pd.DataFrame], pd.DataFrame] | None = None, reduce_schema: str | None = None,
               key: str | None = None, combiner: Callable[[pd.DataFrame], pd.DataFrame] | None = None) -> DataFrame:
    """Caller-given map (per Arrow batch) and, if given, reduce per key (grouped map).

    A reducer gets all rows of a key at once; a ``combiner`` (mapped rows to
    fewer mapped rows, run on each batch before the shuffle) keeps a hot key small.
    """
    def run(batches_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches_:
            yield combiner(mapper(b)) if combiner else mapper(b)

    mapped = df.mapInPandas(run, map_schema)
    if reducer is None:
        return mapped
    if key is None:
        raise ValueError("a reducer needs a key column")
    return mapped.groupBy(key).applyInPandas(reducer, reduce_schema or map_schema)


def per_batch(df: DataFrame, fn: Callable, schema: str, batch_col: str = "batch_id", **extra) -> DataFrame:
    """A worker over each batch with fixed extra arguments (grouped map)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return fn(pdf, **extra)

    return df.groupBy(batch_col).applyInPandas(run, schema)


# R01
def annotate(df: DataFrame, make_annotator: Callable[[], Callable], doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Run a caller-given annotator over texts; it is built once per task.

    The annotator maps a text to token dicts with the TOKEN_SCHEMA fields
    (``sent_id, tok_id, text, pos, dep, ent_type, is_space, like_url``), or to
    such a list and a list of span dicts (``kind`` ent or np, ``start_tok``,
    ``end_tok`` after its last token, ``label``).  One row per text with both.
    """
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nlp = make_annotator()
        for b in it:
            found = [nlp(t or "") for t in b[text]]
            pairs = [f if isinstance(f, tuple) else (f, []) for f in found]
            yield pd.DataFrame({"doc_id": b[doc].astype("int64"), "tokens": [t for t, _ in pairs], "spans": [s for _, s in pairs]})

    return df.select(F.col(doc).cast("long").alias(doc), text).mapInPandas(run, NOTED_SCHEMA)


def _unpacked(noted: DataFrame, name: str, schema: str) -> DataFrame:
    fields = [f.strip().split()[0] for f in schema.split(",")]
    return noted.select("doc_id", F.explode(name).alias("x")).select("doc_id", *[f"x.{f}" for f in fields if f != "doc_id"])


def annotated_tokens(noted: DataFrame) -> DataFrame:
    """TOKEN_SCHEMA rows of annotated texts."""
    return _unpacked(noted, "tokens", TOKEN_SCHEMA)


def annotated_spans(noted: DataFrame) -> DataFrame:
    """SPAN_SCHEMA rows of annotated texts."""
    return _unpacked(noted, "spans", SPAN_SCHEMA)


def native_tokens(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """R01 without a model: TOKEN_SCHEMA rows and ``start``, the token's offset in its text; no Python worker.

    Lines are sentences, single spaces separate tokens.  Every token but the last is followed by one separator, so
    a running sum of lengths gives the offsets; a text's tokens are one input row's worth.
    """
    lines = F.transform(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1), lambda line, s: F.transform(
        F.split(line, " ", -1), lambda w: F.struct(s.alias("sent_id"), w.alias("text"))))
    # Texts move, not their tokens; token rows are too small when compressed for partitions joined by size.
    texts = df.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).repartition(shuffle_partitions(df.sparkSession), "doc_id")
    rows = texts.select("doc_id", F.posexplode(F.flatten(lines)).alias("tok_id", "t"))
    before = Window.partitionBy("doc_id").orderBy("tok_id").rowsBetween(Window.unboundedPreceding, -1)
    w = F.col("t.text")
    return rows.select(
        "doc_id", F.col("t.sent_id").cast("int").alias("sent_id"), F.col("tok_id").cast("int").alias("tok_id"), w.alias("text"),
        F.lit("").alias("pos"), F.lit("").alias("dep"), F.lit("").alias("ent_type"), w.rlike(r"(?U)^\s*$").alias("is_space"),
        w.rlike(r"^(https?://|www\.)").alias("like_url"),
        F.coalesce(F.sum(F.length(w) + 1).over(before), F.lit(0)).cast("long").alias("start"))


def whitespace_annotator() -> Callable[[str], list[dict]]:
    """Default annotator: lines are sentences, spaces separate tokens, no tags."""
    def nlp(t: str) -> list[dict]:
        out, n = [], 0
        for s, line in enumerate(t.split("\n")):
            for w in line.split(" "):
                out.append(dict(sent_id=s, tok_id=n, text=w, pos="", dep="", ent_type="",
                                is_space=(w.strip() == ""), like_url=w.startswith(("http://", "https://", "www."))))
                n += 1
        return out

    return nlp


TOKEN_FIELDS = ["sent_id", "text", "pos", "dep", "ent_type", "is_space", "like_url"]


# R02, R03, J08
def spans_per_token(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """J08 + R03: each token with its covering entity span and its trimmed noun chunk.

    Of several spans of one kind over a token the first in the order of start, end and label counts.  In this order a span
    thus reaches from the greatest end before it, or its own start, to its end; what is left of a kind's spans is disjoint.
    A sweep over the token ids then needs a row for every span, however long: the last span begun covers a token that lies before its end.

    Tokens and spans are unioned and shuffled once by ``doc_id``, to as many partitions as the session sets: token rows
    compress so well that partitions joined by their compressed size would hold gigabytes of them.  The windows here, the per-token grouping and every
    later grouping of :func:`render` have ``doc_id`` among their keys, so they reuse that partitioning.
    A document is one comment, so no ``doc_id`` holds more than one input row's worth of tokens.
    No token x span pairs are formed.  Spans that end before they start, or lack an end, cover nothing.
    """
    span = F.struct("kind", "start_tok", "end_tok", "label")
    began = spans.where(F.col("end_tok") > F.col("start_tok")).select("doc_id", F.lit(None).cast("int").alias("tok_id"), span.alias("_span"))
    toks = tokens.select("doc_id", "tok_id", F.struct(*TOKEN_FIELDS).alias("_tok"))
    rows = (toks.withColumn("_span", F.lit(None).cast(began.schema["_span"].dataType))
            .unionByName(began.withColumn("_tok", F.lit(None).cast(toks.schema["_tok"].dataType)))
            .repartition(shuffle_partitions(tokens.sparkSession), "doc_id"))
    of_kind = Window.partitionBy("doc_id", F.col("_span.kind")).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.greatest("_span.start_tok", F.max("_span.end_tok").over(of_kind))  # greatest() skips nulls
    rows = rows.withColumn("_begin", begin).where(F.col("_span").isNull() | (F.col("_begin") < F.col("_span.end_tok")))
    sweep = Window.partitionBy("doc_id").orderBy(F.coalesce("_begin", "tok_id"), F.col("_span").isNull()).rowsBetween(Window.unboundedPreceding, 0)

    def open_span(kind: str):
        last = F.last(F.when(F.col("_span.kind") == kind, F.col("_span")), ignorenulls=True).over(sweep)
        return F.when(last["end_tok"] > F.col("tok_id"), last)

    per_tok = (rows.withColumn("ent", open_span("ent")).withColumn("np", open_span("np")).where(F.col("_tok").isNotNull())
               .groupBy("doc_id", "tok_id").agg(F.max("_tok").alias("_tok"), F.min("ent").alias("ent"), F.min("np").alias("np"))
               .select("doc_id", "tok_id", "_tok.*", "ent", "np"))
    # A chunk starts at its first token with an allowed dependency, else at its last token.
    chunk = Window.partitionBy("doc_id", F.col("np.start_tok"), F.col("np.end_tok"))
    last = F.col("np.end_tok") - 1
    first_ok = F.min(F.when(F.col("dep").isin(*CHUNK_START_DEPS), F.col("tok_id"))).over(chunk)
    np_start = F.least(F.coalesce(first_ok, last), last)
    # Entity spans win over noun chunks.
    chosen = (F.when(F.col("ent").isNotNull(), F.struct(F.lit("ent").alias("kind"), F.col("ent.start_tok").alias(
        "start_tok"), F.col("ent.label").alias("label")))
        .when(F.col("np").isNotNull() & (F.col("tok_id") >= np_start), F.struct(
            F.lit("np").alias("kind"), np_start.alias("start_tok"), F.col("np.label").alias("label"))))
    return per_tok.withColumn("span", chosen).drop("ent", "np")


# R02, R04, J07, J08, F10, A06, R05
def render(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """Merged tokens rendered ``text|TAG``, sentences by space, documents by newline -> ``(doc_id, text)``.

    One shuffle (see :func:`spans_per_token`); the three groupings below
    (span unit, sentence, document) run where the tokens already are.
    """
    t = spans_per_token(tokens, spans)
    unit = F.coalesce(F.col("span.start_tok"), F.col("tok_id"))
    merged = (t.groupBy("doc_id", "sent_id", unit.alias("unit"))
              .agg(F.sort_array(F.collect_list(F.struct("tok_id", "text"))).alias("parts"),
                   F.max_by("pos", "tok_id").alias("pos"),
                   F.max_by("ent_type", "tok_id").alias("root_ent"),
                   F.first("span.kind", ignorenulls=True).alias("kind"),
                   F.first("span.label", ignorenulls=True).alias("label"),
                   F.min(F.col("is_space").cast("int")).alias("all_space"),
                   F.max(F.col("like_url").cast("int")).alias("any_url"),
                   F.count(F.lit(1)).alias("n")))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), " ")
    ent = F.when(F.col("kind") == "ent", F.try_element_at(labels_map(), F.col("label"))).otherwise(F.col("root_ent"))
    tag = F.coalesce(F.try_element_at(labels_map(), ent), F.col("pos"))
    tag = F.when(F.coalesce(tag, F.lit("")) == "", F.lit("?")).otherwise(tag)
    word = F.when(F.col("any_url") == 1, F.lit("%%URL|X")).otherwise(
        F.concat(F.regexp_replace(text, r"\s", "_"), F.lit("|"), tag))
    words = merged.select("doc_id", "sent_id", "unit", (F.col("all_space") == 1).alias("space"), word.alias("w"),
                          text.alias("raw"))
    sent = (words.groupBy("doc_id", "sent_id")
            .agg(F.sort_array(F.collect_list(F.when(~F.col("space"), F.struct("unit", "w")))).alias("ws"),
                 F.max(F.when(F.trim("raw") != "", 1).otherwise(0)).alias("has_text")))
    sent = sent.where(F.col("has_text") == 1).select(
        "doc_id", "sent_id", F.array_join(F.transform("ws", lambda x: x["w"]), " ").alias("s"))
    doc = sent.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("sent_id", "s"))).alias("ss"))
    return doc.select("doc_id", F.concat(F.array_join(F.transform("ss", lambda x: x["s"]), "\n"),
                                         F.lit("\n")).alias("text"))


# J05
def pending_batches(batch_ids: DataFrame, done: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Batches not written yet (anti-join against the finished ones)."""
    return batch_ids.join(done.select(batch_col).distinct(), batch_col, "left_anti")
