"""Skew-aware lookup, span removal (U01), repeated ids (F05), error counts (A03), comment job."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import comments as cm
from quarry.operators import joins, select, shape
from quarry.operators import templates as tpl
from quarry.plans import queries


def _skewed(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}") for i in range(300)], "page_id long, call string")
    values = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"V{i}") for i in range(7)], "call string, value string")
    return rows, values


def test_lookup_broadcast_and_salted_paths_equal_plain_join(spark):
    rows, values = _skewed(spark)
    plain = sorted(tuple(r) for r in rows.join(values, "call").collect())
    hot_bcast = joins.lookup(rows, values, "call", hot_rows=50, spread_by="page_id")
    hot_salted = joins.lookup(rows, values, "call", hot_rows=50, max_broadcast_bytes=0, salts=8, spread_by="page_id")
    assert sorted(tuple(r) for r in hot_bcast.select(*rows.columns[::-1], "value").select("call", "page_id", "value").collect()) == plain
    assert sorted(tuple(r) for r in hot_salted.select("call", "page_id", "value").collect()) == plain


def test_drop_spans_union_of_overlaps(spark):
    texts = spark.createDataFrame([(1, "0123456789"), (2, "abc")], "page_id long, text string")
    spans = spark.createDataFrame([(1, 1, 3), (1, 2, 5), (1, 4, 4), (1, 7, 8), (1, 9, 12)], "page_id long, s long, e long")
    got = {r.page_id: r.text for r in shape.drop_spans(texts, spans).collect()}
    assert got == {1: "0568", 2: "abc"}


def test_drop_repeated_ids(spark):
    df = spark.createDataFrame([(0, 5), (1, 5), (2, 6), (3, 6), (4, 5)], "page_num long, page_id long")
    assert sorted(r.page_num for r in select.drop_repeated_ids(df).collect()) == [0, 2, 4]


def test_running_sums_agree_whatever_the_partitions(spark):
    rows = [(i * 37 % 500, i % 9) for i in range(700)]
    df = spark.createDataFrame(rows, "at long, v long")
    want, total = [], 0
    for at, v in sorted(rows):
        total += v
        want.append((at, total))
    ends = {}
    for at, t in want:
        ends[at] = t  # rows of equal order may come either way round
    for n in (1, 3, 16):
        got = select.with_running(df, "at", {"total": F.col("v"), "n": F.lit(1)}, n).collect()
        last = {}
        for r in got:
            last[r["at"]] = max(last.get(r["at"], 0), r.total)
        assert last == ends and sorted(r.n for r in got) == list(range(1, 701))


def test_one_per_id(spark):
    df = spark.createDataFrame([("a", 1, 5, "old", ""), ("a", 1, 6, "new", ""), ("b", 1, 9, "b", ""), ("a", None, 1, "x", ""), ("a", None, 1, "x", ""),
                                ("a", 2, None, "n", "")], "file_path string, page_id long, rev_id long, title string, text string")
    assert sorted(r.title for r in select.one_per_id(df).collect()) == ["b", "n", "old", "x", "x"]
    assert select.one_per_id(df.where("page_id = 2")).count() == 1


def test_comment_job_writes_batches_once(spark, tmp_path):
    from quarry.plans import jobs

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join(json.dumps({"body": f"*c{i} http://x.org~"}) for i in range(25)) + "\n")
    out = str(tmp_path / "out")
    jobs.comment_job(spark, str(src / "*.json"), out, batch_size=10)
    first = spark.read.text(out).count()
    jobs.comment_job(spark, str(src / "*.json"), out, batch_size=10)
    assert first == spark.read.text(out).count() == 25
    assert spark.read.text(out).where(F.col("value").startswith("c1|?")).count() == 1


def test_numbers_agree_whatever_the_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 3000).alias("page_id"), F.col("id").alias("copy"))
    for n in (1, 3, 16):
        out = select.with_page_num(df, partitions=n).collect()
        assert sorted(r.page_num for r in out) == list(range(5000))
        in_order = [r.page_id for r in sorted(out, key=lambda r: r.page_num)]
        assert in_order == sorted(in_order)
    pair = df.withColumn("o", F.struct("page_id", "copy"))
    out = select.with_page_num(pair, "o", 8).orderBy("page_num").collect()
    assert [(r.page_id, r.copy) for r in out] == sorted((r.page_id, r.copy) for r in out)


def test_nesting_has_no_depth_limit(spark):
    from conftest import one

    from quarry.functions import markup

    assert one(spark, markup.drop_templates, "a" + "{{x|" * 40 + "}}" * 40 + "b") == "ab"
    assert one(spark, markup.drop_tables, "a" + "{| x " * 20 + "|}" * 20 + "b") == "ab"
    assert one(spark, lambda c: markup.drop_elements(c, ("div",)), "a" + "<div>" * 20 + "</div>" * 20 + "b") == "ab"
    assert one(spark, markup.internal_links, "[[a|" * 15 + "x" + "]]" * 15) == "x"
    assert one(spark, markup.drop_templates, "{{ {{ {{x}} y") == "{{ {{  y"


def test_repeated_page_is_one_document(spark):
    from quarry.options import Options
    from quarry.plans import jobs

    df = spark.createDataFrame([(1, 0, "T", None, 5, "alpha\nbeta"), (1, 0, "T", None, 6, "gamma\ndelta")],
                               "page_id long, ns int, title string, redirect_title string, rev_id long, text string")
    out = jobs.documents(df, Options(expand_templates=False, url_base="u")).collect()
    assert len(out) == 1 and "alpha" in out[0].text and "gamma" not in out[0].text


def test_comment_job_takes_new_files_on_a_rerun(spark, tmp_path):
    from quarry.plans import jobs

    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    write = lambda name, ids: (src / name).write_text("".join(json.dumps({"body": f"c{i}"}) + "\n" for i in ids))
    run = lambda: jobs.comment_job(spark, str(src / "*.json"), out, batch_size=10)
    words = lambda: sorted(r.value for r in spark.read.text(out).collect())
    write("a.json", range(15))
    run()
    write("b.json", range(15, 20))
    run()
    run()
    assert words() == sorted(f"c{i}|?" for i in range(20))
    assert {r.batch_id for r in spark.read.text(out).select("batch_id").distinct().collect()} == {0, 1, 2}


def test_annotators_spans_are_merged(spark):
    from quarry.operators import comments as cm

    def make():
        plain = cm.whitespace_annotator()
        return lambda t: (plain(t), [{"kind": "ent", "start_tok": 0, "end_tok": 2, "label": "PERSON"}])

    df = spark.createDataFrame([(7, "Ada Lovelace wrote")], "doc_id long, text string")
    noted = cm.annotate(df, make)
    text = cm.render(cm.annotated_tokens(noted), cm.annotated_spans(noted)).first().text
    assert text.split()[0].startswith("Ada_Lovelace|") and text.split()[1] == "wrote|?"


def test_corpus_job_observes_its_totals(spark, tmp_path):
    from quarry.options import Options
    from quarry.plans import jobs

    rows = [(i, 10 if i % 4 == 0 else 0, f"Template:T{i}" if i % 4 == 0 else f"P{i}", "P1" if i % 7 == 6 else None, i, f"{{{{T{i // 4 * 4}|x}}}} text {i}\n")
            for i in range(1, 40)]
    pages = spark.createDataFrame(rows, "page_id long, ns int, title string, redirect_title string, rev_id long, text string")
    totals = jobs.write_corpus(pages, str(tmp_path / "out"), Options(write_json=True, file_bytes=400))
    want = jobs.run_totals(pages).first().asDict()
    assert {k: totals[k] for k in want} == want
    written = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert totals["documents"] == want["articles"] == len(written)
    assert totals["chars"] == sum(len(d["text"]) for d in written)


def test_dictionary_is_brought_up_to_date(spark, tmp_path):
    from quarry.options import Options
    from quarry.plans import jobs

    page = "page_id long, ns int, title string, text string"
    first = spark.createDataFrame([(1, 10, "Vorlage:A", "a1"), (2, 10, "Vorlage:B", "#REDIRECT [[Vorlage:A]]"), (3, 828, "Modul:M", "m")], page)
    later = spark.createDataFrame([(4, 10, "Vorlage:A", "a2"), (5, 10, "Vorlage:C", "c"), (6, 0, "P", "p")], page)
    path = str(tmp_path / "dictionary")
    _, opts = jobs.update_dictionary(spark, first, path, Options())
    assert (opts.template_prefix, opts.module_prefix) == ("Vorlage:", "Modul:")
    made, _ = jobs.update_dictionary(spark, later, path, opts)
    rows = {r.title: r for r in made.collect()}
    assert {t: (r.body, r.redirect_to, r.definitions) for t, r in rows.items()} == {
        "Vorlage:A": ("a2", None, 2), "Vorlage:B": (None, "Vorlage:A", 0), "Vorlage:C": ("c", None, 1), "Modul:M": ("m", None, 1)}
    assert tpl.resolved_bodies(made).where("title = 'Vorlage:B'").first().body == "a2"


def test_bad_records_are_observed(spark, tmp_path):
    from quarry.plans import jobs

    (tmp_path / "a.json").write_text("\n".join(json.dumps({"body": f"c{i}"}) for i in range(7)) + "\nnot json\n")
    totals = {}
    jobs.comment_job(spark, str(tmp_path / "*.json"), str(tmp_path / "out"), totals=totals)
    assert totals == {"records": 8, "bad_records": 1}


def test_unfinished_batches_are_not_read(spark, tmp_path):
    from quarry.streaming import incremental

    out = str(tmp_path / "out")
    incremental.write_batch(spark.range(3), 0, out)
    incremental.write_batch(spark.range(5), 1, out)
    incremental.write_batch(spark.range(4), 1, out)
    spark.range(9).write.parquet(f"{out}/rows/batch=2")  # broke off before its ledger entry
    assert sorted((r.batch, r.id) for r in incremental.read_batches(spark, out).collect()) == [(0, i) for i in range(3)] + [(1, i) for i in range(4)]


def test_native_tokens_carry_offsets(spark):
    text = "a  b\n\nhttp://x c"
    rows = cm.native_tokens(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).collect()
    first = sorted((r.tok_id, r.sent_id, r.text, r.start, r.is_space, r.like_url) for r in rows if r.doc_id == 1)
    assert [r[2] for r in first] == ["a", "", "b", "", "http://x", "c"] and [r[1] for r in first] == [0, 0, 0, 1, 2, 2]
    assert all(text[r[3]:].startswith(r[2]) for r in first)
    assert [r.text for r in rows if r.doc_id == 2] == [""]


def test_null_keys_are_not_hot_and_values_are_computed_once_for_both_paths(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 4 == 0 else None if i % 4 == 1 else f"k{i % 5}") for i in range(400)], "page_id long, call string")
    seen = spark.sparkContext.accumulator(0)

    def counted(it):
        for pdf in it:
            seen.add(len(pdf))
            yield pdf

    values = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"V{i}") for i in range(5)], "call string, value string")
    left = joins.lookup(rows, values, "call", hot_rows=90, how="left").collect()
    assert len(left) == 400 and all(r.value == (None if r.call is None else "H" if r.call == "hot" else "V" + r.call[1:]) for r in left)
    nulls = rows.where("call is null").withColumn("_rows", F.lit(1))
    assert joins.hot_hashes(nulls, "call", 50) == []
    # Hot values are written down: measuring and joining them reads that copy.
    lazy = values.mapInPandas(counted, values.schema)
    joins.lookup(rows, lazy, "call", hot_rows=90).collect()
    assert seen.value == 2 * values.count()


@pytest.mark.parametrize("many", [2, 1_000])
def test_parser_functions_move_documents_and_not_their_calls(spark, tmp_path, monkeypatch, many):
    texts = ["Ab {c|d} e", "Ab {c|d} e", "Ab {c|d} e", "", None, None, "x=[y] é", "q" * 50]
    rows = [(i if i != 6 else None, texts[i % 8], [None, "en", "fr", "es"][i % 4]) for i in range(40)] + [(1, texts[1], "en")] * 2
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    calls = queries._function_calls(docs)
    want = joins.lookup(calls, queries._function_values(calls), "call", spread_by="doc_id").select("doc_id", "fn", "value")
    monkeypatch.setattr(queries, "MANY_COPIES", many, raising=False)
    monkeypatch.setattr(queries, "PLACE_BYTES", 100, raising=False)
    got = queries.QUERIES["e10_parser_functions"](spark, str(tmp_path))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    exchanges = [x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x]
    assert exchanges and all("REPARTITION_BY_NUM" in x for x in exchanges)
    # Only this query's session takes sides as they lie.
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
