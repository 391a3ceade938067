"""Each stage of the corpus pipeline on its own input, against brute force."""

from collections import Counter, defaultdict

import pytest
from test_llm_brute import brute_fingerprint, brute_roots
from test_llm_tables import empty, hard, prose  # noqa: F401

import corpus_pipeline as cp
from quarry.llm import line_frequency, mixing, queries

STAGES = dict(cp.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return Counter(map(str, df.collect()))


@pytest.fixture
def docs(spark, hard):  # noqa: F811
    return spark.read.parquet(f"{hard}/documents.parquet")


def test_order_and_columns(spark, docs, hard):  # noqa: F811
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "language_id", "simhash_dedup", "mix_sources", "pack_sequences"]
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, hard).dtypes == docs.dtypes


def test_quality_rules(spark, docs, hard):  # noqa: F811
    got = STAGES["quality_rules"](spark, docs, hard).collect()
    verdicts = queries.op1_line_frequency(spark, hard).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in verdicts if r.kept)
    hot = [r for r in got if r.source == "hot"]
    assert hot and all(len(r.text.split("\n")) == 1 and "stands in" not in r.text.lower() for r in hot)
    before = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == before[r.doc_id] for r in got if r.source != "hot" and r.doc_id not in (None, 7))


def test_copies_are_no_reason_to_remove(spark):
    made = [(i, f"{prose(1, 70)}\n{prose(2, 20)}", "en", "one", 1) for i in range(150)]
    made += [(200 + i, f"{prose(3, 20)}\n{prose(10 + i, 90)}", "en", "one", 1) for i in range(101)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in line_frequency.line_verdicts(df).collect()}
    assert all(out[i].kept and out[i].n_removed_words == 0 for i in range(150))
    assert all(out[200 + i].kept and out[200 + i].n_removed_words == 20 for i in range(101))


def test_share_decides_at_every_size(spark):
    made, shared = [], {}
    for n in (50, 300, 500):  # a fifth of each host's documents share a line of 9 words; 5 of each share another
        shared[n] = {f"{n}:{i}" for i in range(0, n, 5)}
        for i in range(n):
            lines = [" ".join(f"w{i}x{k}" for k in range(80)).translate(str.maketrans("0123456789", "abcdefghij"))]
            made.append((f"{n}:{i}", "\n".join(lines + ["this line is on every fifth page of it"] * (i % 5 == 0)
                                               + ["a line that five documents happen to share here"] * (i % 10 == 1 and i < 50)),
                         "en", f"h{n}", 1))
    df = spark.createDataFrame(made, "doc_id string, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r.text for r in STAGES["quality_rules"](spark, df, "").collect()}
    assert len(out) == len(made)
    for n, ids in shared.items():
        assert all("every fifth page" not in out[i] for i in ids)
        assert sum("five documents" in t for i, t in out.items() if i.startswith(f"{n}:")) == 5


def test_language_id(spark, docs, hard):  # noqa: F811
    got = rows(STAGES["language_id"](spark, docs, hard))
    have = rows(docs)
    assert not got - have
    gone = {r.doc_id for r in docs.collect() if str(r) not in got}
    assert {0, 1, 2, 3} <= gone and not gone & set(range(1000, 1260))


def test_simhash_dedup(spark, docs, hard):  # noqa: F811
    got = STAGES["simhash_dedup"](spark, docs, hard).collect()
    have = docs.collect()
    roots = brute_roots({brute_fingerprint(r.text) for r in have})
    groups = defaultdict(list)
    for r in have:
        groups[roots[brute_fingerprint(r.text)]].append(r)
    assert len(got) == len(groups)
    assert not rows(STAGES["simhash_dedup"](spark, docs, hard)) - Counter(map(str, have))
    least = Counter(str(min((r.doc_id for r in g if r.doc_id is not None), default=None)) for g in groups.values())
    assert Counter(str(r.doc_id) for r in got) == least


def test_mix_sources(spark, docs, hard):  # noqa: F811
    got = Counter(str(r.doc_id) for r in STAGES["mix_sources"](spark, docs, hard).collect())
    want = Counter()
    source = {r.doc_id: r.source for r in docs.collect()}
    sums = defaultdict(lambda: [0, 0, 0.0, 0])
    for r in mixing.mix(docs).collect():
        want[str(r.doc_id)] += r.copies
        assert 0 <= r.copies <= 2
        if r.doc_id is None:  # its source can't be told from here
            continue
        s = sums[source[r.doc_id], r.target]
        s[0], s[1], s[2], s[3] = s[0] + r.size, s[1] + r.taken, r.target, max(s[3], r.size)
    assert got == +want
    for _, taken, target, largest in sums.values():
        assert abs(taken - target) <= 2 * largest + 0.1 * target


def test_run(spark, hard, empty):  # noqa: F811
    out = cp.run(spark, hard)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 100
    assert cp.run(spark, empty).collect() == []
