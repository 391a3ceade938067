"""Incremental runs (S08, J05), comment rendering (R01-R06), user map/reduce."""

import json
import random

import pandas as pd
from pyspark.sql import functions as F

from quarry.operators import comments as cm
from quarry.streaming.incremental import stream_comment_texts


def test_incremental_run_skips_finished_files(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    src.mkdir()
    (src / "a.json").write_text(json.dumps({"body": "*one~"}) + "\n")
    stream_comment_texts(spark, str(src), str(out), str(ck))
    (src / "b.json").write_text(json.dumps({"body": "two"}) + "\n")
    stream_comment_texts(spark, str(src), str(out), str(ck))
    got = sorted(r.text for r in spark.read.json(str(out)).collect())
    assert got == ["one", "two"]


def test_render_merges_spans_and_maps_tags(spark):
    toks = spark.createDataFrame([
        (1, 0, 0, "New", "PROPN", "compound", "GPE", False, False),
        (1, 0, 1, "York", "PROPN", "pobj", "GPE", False, False),
        (1, 0, 2, "is", "VERB", "ROOT", "", False, False),
        (1, 0, 3, "", "", "", "", True, False),
        (1, 0, 4, "very", "ADV", "advmod", "", False, False),
        (1, 0, 5, "big", "ADJ", "amod", "", False, False),
        (1, 1, 6, "http://x.org", "X", "", "", False, True),
        (1, 1, 7, "a\tb", "", "", "", False, False),
        (1, 2, 8, " ", "", "", "", True, False),
    ], cm.TOKEN_SCHEMA)
    spans = spark.createDataFrame([(1, "ent", 0, 2, "GPE"), (1, "np", 2, 6, "")], cm.SPAN_SCHEMA)
    out = cm.render(toks, spans).first().text
    # The noun chunk [is .. big] is trimmed to start at "very" (advmod).
    assert out == "New_York|ENT is|VERB very_big|ADJ\n%%URL|X a_b|?\n"


def test_batches_and_pending(spark):
    df = spark.range(0, 250).withColumnRenamed("id", "k")
    b = cm.batches(df, 100, ["k"])
    assert [r.n for r in b.groupBy("batch_id").count().withColumnRenamed("count", "n").orderBy("batch_id").collect()] \
        == [100, 100, 50]
    done = spark.createDataFrame([(0,)], "batch_id long")
    pending = b.select("batch_id").distinct().join(done, "batch_id", "left_anti")
    assert sorted(r.batch_id for r in pending.collect()) == [1, 2]


def test_user_map_reduce_and_per_batch(spark):
    df = spark.createDataFrame([("a b a",), ("b c",)], "text string")

    def mapper(pdf):
        words = pdf["text"].str.split().explode()
        return pd.DataFrame({"word": words, "n": 1})

    def reducer(pdf):
        return pd.DataFrame({"word": [pdf["word"].iloc[0]], "n": [int(pdf["n"].sum())]})

    got = cm.map_reduce(df, mapper, "word string, n long", reducer, key="word")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 2), ("b", 2), ("c", 1)]
    b = spark.createDataFrame([(0, "x"), (0, "y"), (1, "z")], "batch_id long, text string")
    r = cm.per_batch(b, lambda pdf, sep: pd.DataFrame({"batch_id": [pdf.batch_id.iloc[0]],
                                                      "joined": [sep.join(pdf.text)]}),
                     "batch_id long, joined string", sep="+")
    assert sorted(tuple(x) for x in r.collect()) == [(0, "x+y"), (1, "z")]


def test_annotate_with_caller_model(spark):
    df = spark.createDataFrame([(7, "hi there\nhttp://a.b")], "doc_id long, text string")
    toks = cm.annotated_tokens(cm.annotate(df, cm.whitespace_annotator))
    assert toks.count() == 3
    out = cm.render(toks, spark.createDataFrame([], cm.SPAN_SCHEMA)).first().text
    assert out == "hi|? there|?\n%%URL|X\n"
    assert toks.where(F.col("like_url")).count() == 1


def _first_cover(spans, kind, tok):
    over = [s for s in spans if s[1] == kind and s[2] <= tok < s[3]]
    return min(over, key=lambda s: s[2:])[2:] if over else None


def test_spans_per_token_equal_the_first_cover(spark):
    rng = random.Random(5)
    toks, spans = [], []
    for doc in range(40):
        n = rng.randint(1, 25)
        toks += [(doc, i // 6, i, f"w{i}", "NOUN", "dep", "", False, False) for i in range(n)]
        for _ in range(rng.randint(0, 14)):  # overlapping, nested, equal, empty and reversed spans
            at = rng.randint(0, n)
            spans.append((doc, rng.choice(["ent", "np"]), at, at + rng.randint(-1, 9), rng.choice(["GPE", "DATE"])))
    again = [(d, s, t, "a", *rest) for d, s, t, _, *rest in toks[::3]]  # repeated tokens: one stays, the greatest
    rows = cm.spans_per_token(spark.createDataFrame(toks + again, cm.TOKEN_SCHEMA), spark.createDataFrame(spans, cm.SPAN_SCHEMA)).collect()
    assert sorted((r.doc_id, r.tok_id, r.text) for r in rows) == sorted((t[0], t[2], t[3]) for t in toks)
    by_doc = {d: [s for s in spans if s[0] == d] for d in range(40)}
    for r in rows:
        ent, np_ = (_first_cover(by_doc[r.doc_id], k, r.tok_id) for k in ("ent", "np"))
        if ent:
            assert (r.span.kind, r.span.start_tok, r.span.label) == ("ent", ent[0], ent[2])
        elif np_ and r.tok_id == np_[1] - 1:  # no token has a dependency that starts a chunk: it is its last token
            assert (r.span.kind, r.span.start_tok, r.span.label) == ("np", r.tok_id, np_[2])
        else:
            assert r.span is None


def test_long_spans_cost_a_row_each(spark):
    n = 100_000
    toks = spark.range(n).selectExpr("1L AS doc_id", "0 AS sent_id", "CAST(id AS int) AS tok_id", "'w' AS text", "'' AS pos", "'' AS dep",
                                     "'' AS ent_type", "false AS is_space", "false AS like_url")
    spans = spark.range(200).selectExpr("1L AS doc_id", "'ent' AS kind", "CAST(id AS int) AS start_tok",
                                        f"{n} - 200 + CAST(id AS int) AS end_tok", "CONCAT('L', id) AS label")
    got = cm.spans_per_token(toks, spans)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert {(r.s, r.n) for r in got.groupBy("span.start_tok").agg(F.count("*").alias("n")).withColumnRenamed("start_tok", "s").collect()} \
        == {(0, n - 200)} | {(i, 1) for i in range(1, 200)} | {(None, 1)}
