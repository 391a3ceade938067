"""Registered queries against their DuckDB twins on the smallest tables (the driver's gate)."""

import hashlib
import math
import os
import re

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from quarry.sources.fixtures import TABLES

SF = "/root/testdata/sf0.001"
ALL = os.environ.get("QUARRY_ALL_ORACLES") == "1"
FAST = ["f03_disambiguation", "w01_page_num", "p06_normalize_title", "a01_template_dictionary",
        "e03_template_calls", "c01_unescape_html", "b04_html_to_text", "c26_strip_comments",
        "g01_internal_links", "a05_word_counts", "w06_comment_batches", "e10_parser_functions",
        "r05_tagged_sentences", "b01_documents", "l04_compact_sections", "f05_repeated_ids", "e07_magic_words",
        "c14_wiki_markup_html", "u01_spans", "l06_html_lists", "b03_comment_job", "x01_map_reduce", "x02_per_batch"]


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    canon = lambda v: "∅" if v is None else (f"{v:.6g}" if isinstance(v, float) and not math.isnan(v) else str(v))
    lines = sorted("\x1f".join(canon(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()) if ALL else FAST)
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_every_query_has_sql_or_is_listed():
    no_sql = set(queries()) - set(oracle_sql())
    # The optional training-data queries have tests of their own.
    assert {n for n in no_sql if not re.match(r"op\d+_|pipeline$", n)} == set()


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["id", "url", "title", "text"]
    assert df.count() > 0
