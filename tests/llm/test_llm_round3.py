"""Line runs, collocations and hard negatives: pieces of the method, batches and shards against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_tables import compare, hard  # noqa: F401

from quarry.llm import collocations, hard_negatives, line_runs, norm_buckets, perspectives, queries, vectors

MEDIUM = "/root/testdata/sf0.01"


# 11: line runs

def lines_of(n, seed):
    r = random.Random(seed)
    return [(i, "\n".join(r.choice(["Hot line ", "hot LINE", f"rare {r.randrange(400)}", "", " \t", f"mid {r.randrange(12)}"]) for _ in range(r.randrange(12))))
            for i in range(n)]


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def kept_lines(rows, min_docs, min_chars=1):
    seen = Counter(k for _, t in rows for k in {key_of(x) for x in t.split("\n")} if len(k) >= min_chars)
    return {i: "\n".join(x for x in t.split("\n") if len(key_of(x)) < min_chars or seen[key_of(x)] < min_docs) for i, t in rows}


@pytest.mark.parametrize(("parts", "min_docs", "min_chars"), [(1, 10, 1), (16, 10, 1), (16, 2, 5), (5, 1, 1)])
def test_dedup_over_batches(spark, parts, min_docs, min_chars):
    rows = lines_of(150, parts)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = {r.doc_id: r.text for r in line_runs.dedup(docs, min_docs, min_chars).collect()}
    assert got == kept_lines(rows, min_docs, min_chars)


def test_runs_are_compacted_and_sum_up(spark):
    runs, all_rows = line_runs.LineRuns(spark, min_docs=6, fanout=2), []
    for i in range(5):
        rows = lines_of(20, 100 + i)
        all_rows += rows
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        runs.add(line_runs.counted(docs.select(line_runs.line_keys(F.col("text")).alias("lines"))))
        levels = Counter(r.level for r in runs.runs)
        assert max(levels.values()) < 2
    assert sorted(r.level for r in runs.runs) == [0, 2]
    hot, cold = runs.frequent()
    keys = Counter(k for _, t in all_rows for k in {key_of(x) for x in t.split("\n")} if k)
    assert hot.count() + cold.count() == sum(n >= 6 for n in keys.values())
    assert hot.count() <= line_runs.HOT_KEYS
    table = runs.runs[0].table
    runs.drop()
    assert not spark.catalog.tableExists(table)


def test_a_feed_loses_what_earlier_batches_held(spark):
    runs, seen = line_runs.LineRuns(spark, min_docs=1), set()
    for i in range(3):
        rows = lines_of(15, 200 + i)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: r.text for r in runs.unseen(docs).collect()}
        assert got == {k: "\n".join(x for x in t.split("\n") if key_of(x) not in seen) for k, t in rows}
        seen |= {key_of(x) for _, t in rows for x in t.split("\n")} - {""}
    runs.drop()


def test_columns_stay_whatever_their_names(spark):
    docs = spark.createDataFrame([(1, "a\nb", 5, "x")], "doc_id long, TEXT string, n_lines int, t1 string")
    out = line_runs.dedup(docs, min_docs=1)
    assert out.columns == ["doc_id", "TEXT", "n_lines", "t1", "n_lines_", "n_dropped"]
    assert tuple(out.first()) == (1, "", 5, "x", 2, 2)


# 12: collocations

def test_double_array_accepts_its_keys_only():
    r = random.Random(3)
    word = lambda: bytes(r.choice(b"abcdefgh\x01\xc3") for _ in range(r.randrange(1, 6)))
    keys = list({(b"en" if r.random() < 0.5 else b"e") + b"\t" + word() + b" " + word() for _ in range(20_000)} | {b"a\nb\t" + b"x" * 300 + b" y"})
    trie = collocations.Trie.build(keys)
    number = {k: i for i, k in enumerate(keys)}
    words = [word() for _ in range(5000)] + [b"x" * 300, b"y"]
    text, start, end, _ = collocations._bounds(b" ".join(words))
    for lang in ("en", "e", "a\nb", "none", ""):
        got = trie.accept(text, lang, start[:-1], end[1:])
        assert got.tolist() == [number.get(lang.encode() + b"\t" + a + b" " + b, -1) for a, b in zip(words, words[1:], strict=False)]
    parents = (trie.nodes >> 32)[trie.nodes != 0]
    assert (parents > 0).all()


def test_wide_nodes_find_room():
    keys = [b"l\t" + bytes([a, b]) for a in range(11, 256) for b in range(11, 256) if a != 32 != b]
    trie = collocations.Trie.build(keys)
    text, start, end, _ = collocations._bounds(b" ".join(k[2:] for k in keys))
    assert trie.accept(text, "l", start, end).tolist() == list(range(len(keys)))


def test_word_hashes_do_not_depend_on_the_place():
    words = [b"a", b"ab", b"x" * (3 << 20), b"ba", b"a"] * 2
    text, start, end, _ = collocations._bounds(b" ".join(words))
    got = collocations.word_hashes(text, start, end).tolist()
    assert len(set(got)) == 4
    assert got[:5] == got[5:] and got[0] == got[4]


def test_normal_text():
    assert collocations.normal("A b,c  \n\n d\te.. F ;") == b"a b\nc\nd e\nf"
    assert collocations.normal(" \t..\n") == b""
    assert collocations.normal("Ä\x1cB") == "Ä\x1cb".encode()


@pytest.mark.parametrize("trie_bytes", [400, 1 << 20])
def test_counts_over_shards_and_longer_phrases(spark, trie_bytes):
    r = random.Random(8)
    rows = [(r.choice(["en", None]), " ".join(r.choice("a b c d E ff gg hh".split()) + r.choice(["", "", "", "."]) for _ in range(60))) for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    counts, totals = collocations.phrase_counts(docs, min_count=5, max_words=4, trie_bytes=trie_bytes)
    want, n = Counter(), Counter()
    for lang, text in rows:
        for piece in text.lower().split("."):
            w = piece.split()
            n[lang or "und"] += len(w)
            want.update((lang or "und", " ".join(w[i : i + k]), k) for k in range(1, 5) for i in range(len(w) - k + 1))
    assert {(x.lang, x.phrase, x.words): x.f for x in counts.collect()} == {k: v for k, v in want.items() if v >= 5}
    assert {x.lang: x.n for x in totals.collect()} == n


def test_blocks_are_read_once_a_level_by_any_number_of_tries(spark, monkeypatch):
    reads = []
    for name in ("_pass", "_send"):
        real = getattr(collocations, name, None)
        monkeypatch.setattr(collocations, name, lambda *a, real=real: reads.append(1) or real(*a), raising=False)
    r = random.Random(5)
    words = [f"{c}{i}é" for c in "abcdef" for i in range(12)]
    rows = [(r.choice(["en", "de", None]), " ".join(r.choice(words[: 4 + i % 60]) + r.choice(["", "", "."]) for _ in range(80))) for i in range(120)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    counts, _ = collocations.phrase_counts(docs, min_count=4, max_words=3, trie_bytes=80)
    got = {(x.lang, x.phrase): x.f for x in counts.collect()}
    assert len(reads) == 3
    want = Counter()
    for lang, text in rows:
        for piece in text.split("."):
            w = piece.split()
            want.update((lang or "und", " ".join(w[i : i + k])) for k in range(1, 4) for i in range(len(w) - k + 1))
    assert got == {k: v for k, v in want.items() if v >= 4}
    assert max(k[1].count(" ") for k in got) == 2


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    rows = [("en", "a", big + 7, 1), ("en", "b", big + 9, 1), ("en", "a b", big, 2)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, f long, words int")).first()
    assert (got.score, got.l, got.r) == (10**6 * big * big // ((big + 7) * (big + 9)), big + 7, big + 9)


# 13: hard negatives

def test_feasible_rows_hold_all_that_reach_the_cosine():
    rng = np.random.default_rng(5)
    data = np.floor(rng.normal(size=(300, 12)) * 100)
    data[:40] = np.floor(data[0] + rng.normal(size=(40, 12)) * 8)
    row = hard_negatives._pack(__import__("pandas").DataFrame({"block": 1, "vec_id": range(300), "label": 0, "v": list(data)})).iloc[0]
    block = hard_negatives.Block(row)
    fewer = 0
    for q in data[:60]:
        unit = q / np.linalg.norm(q)
        cosine = (data @ unit) / np.linalg.norm(data, axis=1)
        for least in (0.5, 0.8, 0.95, 0.999):
            got = block.feasible(unit, least)
            if got is not None:
                assert set((cosine >= least).nonzero()[0]) <= set(got.tolist())
                fewer += len(got) < len(data) / 4
    assert fewer > 30


def mined(rows, stride, k, least):
    out = []
    for a, (la, va) in sorted({i: min((lb, v) for j, lb, v in rows if j == i) for i, _, _ in rows if i % stride == 0}.items()):
        others = [(sum(x * y for x, y in zip(va, v, strict=True)), i, lb) for i, lb, v in rows if i != a]
        for p, i, _ in sorted([x for x in others if x[2] == la], key=lambda x: (-x[0], x[1]))[:k]:
            negatives = sorted([x for x in others if x[2] != la and least * p <= 100 * x[0] <= 100 * p], key=lambda x: (-x[0], x[1]))[:k]
            out += [(a, i, n + 1, j, p, s) for n, (s, j, _) in enumerate(negatives)]
    return sorted(out)


@pytest.mark.parametrize(("block", "group", "least"), [(16, 4, 80), (2048, 2048, 95), (7, 100, 20)])
def test_mining_over_blocks_groups_and_rounds(spark, block, group, least):
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(5, 10))
    rows = []
    for i in range(400):
        v = centres[i % 5] * (1 + i % 3) + rng.normal(size=10) * 0.15
        rows.append((i if i < 390 else 40, int(rng.integers(0, 3)), [float(x) for x in v]))
    rows += [(500 + i, i % 2, rows[3][2]) for i in range(60)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = sorted(tuple(r) for r in hard_negatives.mine(df, stride=10, block=block, group=group, least=least).collect())
    whole = [(i, lb, [int(np.floor(x * 256)) for x in v]) for i, lb, v in rows]
    want = mined(whole, 10, 5, least)
    assert len(want) > 20
    assert got == want


def test_products_stay_exact_beyond_doubles():
    a = np.array([[2.0**40, 3.0]])
    assert vectors.products(a, np.array([[2.0**20, 1.0]]))[0, 0] == 2**60 + 3
    assert vectors.best(np.array([5, 2, 9]), np.array([1, 1, 0], object), 2) == [(-1, 2), (-1, 5)]


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_lines_go_on_tables_of_any_size(spark, folder):
    gone = queries.op1_line_frequency(spark, f"/root/testdata/{folder}").agg(F.sum("n_removed_words")).first()[0]
    assert gone > 0


def test_whole_dialogues(spark):
    rows = [("c", i, "ann" if i % 2 else "bob", f"m{i}") for i in range(700)] + [("c", 3, "ann", "m3"), ("c", None, "bob", "late")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {r.participant: r for r in perspectives.rotate(df, block=None).collect()}
    assert set(got) == {"ann", "bob"}
    assert [x.split("<|im_end|>")[0] for x in got["bob"].rendered.split("\n")[1::2]] == [
        f"m{i}" for i in range(4)] + ["m3"] + [f"m{i}" for i in range(4, 700)] + ["late"]
    assert got["ann"].n_messages == 702 and got["ann"].n_assistant == 351


def test_shuffle_of_top_k_follows_the_table(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(1200, 8))
    data /= np.linalg.norm(data, axis=1)[:, None]  # equal lengths: nothing is pruned by length
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    out = norm_buckets.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=40, group=25)
    whole = np.floor(64 * data)
    got = {}
    for r in out.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 1200, 20):
        scores = sorted((-int(whole[q] @ whole[i]), i) for i in range(1200) if i != q)[:20]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]


@pytest.mark.parametrize("name", ["op11_line_runs", "op12_collocations", "op13_hard_negatives"])
def test_medium_tables(spark, name):
    assert compare(spark, name, MEDIUM)
    assert name in queries.QUERIES
