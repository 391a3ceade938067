"""Queries with SQL against DuckDB, on the driver's smallest tables, on hard cases and on empty tables."""

import math
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from quarry.llm import oracles, queries

SMALL = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i * (seed % 5 + 1) + i * 3) % len(WORDS)] + str((seed + i) % 97) for i in range(n))


def documents() -> pa.Table:
    shared = "This line stands in very many documents of one host 2024"
    texts = [None, "", " \t\n \x0b\x0c\r", "...", "Ünïcode wörter Ä ß x", "a b c a b c a b c", "x" * 5000,
             "### $$ <b> | & %\n\n### $$ <b> | & %\n", prose(1, 30_000), "<|endoftext|> a <|startoftext|>b", "日本語 の テキスト 🎉"]
    rows = [(i, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else "web") for i, t in enumerate(texts)]
    for i in range(260):  # a host whose documents share a line, in three spellings
        line = (shared, shared.upper(), "  " + shared.replace("2024", "1999").replace(" ", "\t"))[i % 3]
        rows.append((1000 + i, f"{line}\n{prose(i, 12 if i % 50 == 0 else 70)}\n{line}", "de", "hot"))
    rows += [(5000 + i, prose(9, 80), "en", f"s{i % 6}") for i in range(40)]  # copies
    rows += [rows[12], rows[12], (None, prose(3, 60), "en", "web"), (None, None, None, None), (7, prose(4, 60), "fr", "web")]
    cols = list(zip(*rows, strict=True))
    n = len(rows)
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    extra = ["n_words", "kept", "size", "key", "band", "slice", "copies", "row", "fp", "component_id", "h", "host_", "tid_", "tid", "score", "place"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    data = [pa.array(c, k) for c, k in zip([*cols, [len(t or "") for t in cols[1]]], kinds, strict=True)]
    return pa.table(dict(zip(names + extra, data + [pa.array([i % 3 for i in range(n)])] * len(extra), strict=True)))


def embeddings() -> pa.Table:
    nan, inf = math.nan, math.inf
    vectors = [None, [nan, 1.0], [1.0, None, 2.0], [inf, 0.0], []] + [[math.sin(i * k) / 3 for k in range(1, 9)] for i in range(300)]
    vectors += [[0.5] * 8] * 120 + [[0.25] * 8] * 60 + [[0.0] * 8] * 30 + [[-3.0 * i] * 8 for i in range(20)]
    ids = list(range(len(vectors)))
    vectors += [vectors[20], [0.9] * 8, [0.1] * 8, [0.2] * 8, vectors[7]]  # ids that repeat, queries and anchors among them
    ids += [20, 40, 100, 100, 7]
    return pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())),
                     "label": pa.array([None if i % 50 == 3 else i // 2 % 3 for i in range(len(ids))], pa.int32()), "block": pa.array(ids), "rank": pa.array(ids)})


def pages() -> pa.Table:
    html = [None, "", "<p>a</p>", "<p>a</p>", "<p>ä\r\n\r\nWARC/1.1\r\n</p>", "x" * 300_000, None, "<p>a</p>"] + ["<hot>"] * 200 + [f"<p>{i}</p>" for i in range(50)]
    ids = [*range(len(html) - 1, 0, -1), None]
    return pa.table({"page_id": pa.array(ids, pa.int64()), "url": pa.array([None if i % 5 == 0 else f"http://h/{i}\n x" for i in range(len(html))]),
                     "html": html, "digest": pa.array(ids), "first": pa.array(ids), "sha1": pa.array(ids)})


def conversations() -> pa.Table:
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, None, "who?"), (1, 3, "ann", "tie"), (1, 3, "ann", "tie2"),
            (1, None, "bob", "lost"), (None, 0, "ann", "no id"), (2, 0, "ann", "x"), (2, 0, "ann", "x"), (3, 0, "system", "only"), (4, 0, None, None)]
    rows += [(9, i, ("ann", "bob", "cy", "assistant")[i % 4], f"m{i}\n<|im_end|>") for i in range(700)]
    rows += [(10, 5, "ann" if i % 2 else "bob", f"same turn {i}") for i in range(600)]
    c = list(zip(*rows, strict=True))
    return pa.table({"conv_id": pa.array(c[0], pa.int64()), "turn": pa.array(c[1], pa.int64()), "role": list(c[2]), "text": list(c[3]),
                     "key": list(c[1]), "block": list(c[1]), "messages": list(c[1])})


@pytest.fixture(scope="session")
def hard(tmp_path_factory) -> str:
    d = tmp_path_factory.mktemp("hard")
    labels = pa.table({"doc_id": pa.array([0, 1, 1, None, 1005], pa.int64()), "quality": pa.array([1, 0, None, 1, 1], pa.int32()),
                       "toxic": pa.array([0, 1, None, 1, 1], pa.int32())})
    for name, table in (("documents", documents()), ("embeddings", embeddings()), ("pages", pages()), ("conversations", conversations()), ("labels", labels)):
        pq.write_table(table, d / f"{name}.parquet")
    return str(d)


@pytest.fixture(scope="session")
def empty(tmp_path_factory, hard) -> str:
    d = tmp_path_factory.mktemp("empty")
    for p in Path(hard).glob("*.parquet"):
        pq.write_table(pq.read_table(p).slice(0, 0), d / p.name)
    return str(d)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted("\x1f".join(show(r[i]) for i in order) for r in rows)


def compare(spark, name, folder):
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = queries.QUERIES[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(oracles.ORACLES[name])
    names = [c[0] for c in res.description]
    assert sorted(names) == sorted(df.columns)
    want = rows_of(names, res.fetchall())
    assert len(got) == len(want)
    assert got == want
    return got


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_small_tables(spark, name):
    assert compare(spark, name, SMALL)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_hard_cases(spark, hard, name):
    assert compare(spark, name, hard)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).collect() == []
