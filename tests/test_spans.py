"""Spans of the cleaning rules by source offsets."""

import random

from pyspark.sql import functions as F

from quarry.functions import markup
from quarry.operators import spans
from quarry.options import DEFAULT_DISCARD_ELEMENTS, Options

OPTS = Options()


def _texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "page_id long, text string")


def _chain(df):
    steps = [markup.drop_comments, markup.drop_self_closing, lambda c: markup.unwrap_ignored_tags(c, OPTS.ignore_tags_all),
             lambda c: markup.drop_elements(c, OPTS.discard_elements)]
    return {r.page_id: r.text for r in markup.steps_apply(df, "text", steps).collect()}


def test_spans_have_source_offsets(spark):
    text = "é<!-- c -->x<br/>y<b>z</b> <div>in<div>ner</div></div>!<DIV a=1>q</DIV>"
    got = {(r.rule, text[r.s:r.e]) for r in spans.rule_spans(_texts(spark, [text])).collect()}
    assert got == {("comment", "<!-- c -->"), ("self_closing", "<br/>"), ("ignored_tag", "<b>"), ("ignored_tag", "</b>"),
                   ("element", "<div>in<div>ner</div></div>"), ("element", "<div>ner</div>"), ("element", "<DIV a=1>q</DIV>")}


def test_cleaned_on_hand_written_texts(spark):
    cases = {
        "": "", "no marks": "no marks", "a < b > c": "a < b > c",
        "<div>open": "<div>open", "close</div>": "close</div>", "</div><div>x</div>y": "</div>y",
        "<div><div>x</div>y": "<div>y", "<div>x</div></div>z": "</div>z",
        "<!-- <div> -->a<div>b</div>c": "ac",  # marks in a comment are none
        "<div>a<!-- </div> -->b</div>c": "c",
        "<div>a<table>b</div>c</table>d": "d",  # crossing elements: their union goes
        "𝒳<b>𝒴</b><hr />": "𝒳𝒴",
    }
    df = _texts(spark, [*cases, None])
    got = {r.page_id: r.text for r in spans.cleaned(df).collect()}
    assert got == {**dict(enumerate(cases.values())), len(cases): None}


def _nested(rng, depth=0):
    parts = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.randint(0, 5)
        if kind == 0 and depth < 5:
            tag = rng.choice(DEFAULT_DISCARD_ELEMENTS[:6])
            parts.append(f"<{tag}>{_nested(rng, depth + 1)}</{tag.upper()}>")
        elif kind == 1:
            parts.append(f"<b>{_nested(rng, depth + 1) if depth < 5 else 'k'}</b>")
        else:
            parts.append(rng.choice(["words ", "é𝒳", "<!-- note -->", "<br/>", "\n", "<p class='x'>"]))
    return "".join(parts)


def test_cleaned_equals_the_chain_on_nested_texts(spark):
    rng = random.Random(3)
    df = _texts(spark, [_nested(rng) for _ in range(300)])
    assert {r.page_id: r.text for r in spans.cleaned(df).collect()} == _chain(df)


def test_one_shuffle_of_marks(spark):
    plan = spans.rule_spans(_texts(spark, ["<b>"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_long_page(spark):
    n = 20_000
    df = spark.range(1).select(F.lit(1).alias("page_id"), F.repeat(F.lit("<div>a<div>b</div>c</div>x"), n).alias("text"))
    row = spans.cleaned(df).select(F.length("text").alias("n"), F.regexp_count("text", F.lit("x")).alias("x")).first()
    assert (row.n, row.x) == (n, n)
