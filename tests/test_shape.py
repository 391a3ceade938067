"""Line shaping (L01-L13, W03, W04): hand-written pages with their lines, and properties."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators import shape
from quarry.options import Options

PLAIN, KEPT = Options(), Options(keep_sections=True, keep_lists=True)


def shaped(spark, pages, opts=PLAIN):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, text string")
    return [list(r.lines) for r in shape.compact(df, opts).orderBy("page_id").collect()]


# page -> lines by default -> lines with sections and lists kept
CASES = [
    ("one\ntwo", ["one", "two"], ["one", "two"]),
    # blank lines: only after a kept line, and one of a run
    ("\n\na\n\n\nb", ["a", "", "b"], ["a", "", "b"]),
    # a header shows up when a line of its section does
    ("a\n== H ==\nb", ["a", "b"], ["a", "H.", "b"]),
    ("== H ==\n=== S! ===\nb", ["b"], ["H.", "S!", "b"]),
    ("== H ==\n== I ==\nb", ["b"], ["I.", "b"]),
    ("=== S ===\n== I ==\nb", ["b"], ["I.", "b"]),
    ("a\n== Empty ==", ["a"], ["a"]),
    # list lines, dropped or numbered
    ("* x\n* y", [], ["- x", "- y"]),
    ("# x\n# y\n\n# z", [""], ["1. x", "2. y", "", "1. z"]),
    ("# x\n## y\n## z\n# w", [], ["1. x", "1. y", "2. z", "2. w"]),
    ("#  \n# x", [], ["1. x"]),
    ("== L ==\n* x", [], ["L.", "- x"]),
    # the line that closes a list is kept whatever it is
    ("* x\n{| t", ["{| t"], ["- x", "{| t"]),
    # indents, table residue, brackets and dashes go
    (": in\na", ["a"], ["a"]),
    ("{| t\n| c\nend}\na", ["a"], ["a"]),
    ("(x)\n--\n.-.\na", ["a"], ["a"]),
    # preformatted lines go, but for the first of a section
    ("a\n pre", ["a"], ["a"]),
    ("== H ==\n pre", [" pre"], ["H.", " pre"]),
    ("++Title++\na", ["Title.", "a"], ["Title.", "a"]),
    ("++What?++", ["What?"], ["What?"]),
]


@pytest.mark.parametrize("opts, at", [(PLAIN, 1), (KEPT, 2)])
def test_pages(spark, opts, at):
    for case, got in zip(CASES, shaped(spark, [c[0] for c in CASES], opts), strict=True):
        assert got == case[at], case[0]


PIECES = ["", "text a", " pre", "== H ==", "=== S ===", "* item", "# num", "## deep", ": ind", "(x)", "--", "{| t", "++T++"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PIECES), min_size=1, max_size=12), min_size=2, max_size=12))
def test_properties(spark, pages):
    texts = ["\n".join(p) for p in pages]
    for opts in (PLAIN, KEPT):
        together = shaped(spark, texts, opts)
        assert shaped(spark, texts[:1], opts) == together[:1]                  # a page depends on itself alone
        for text, out in zip(texts, together, strict=True):
            assert all(a or b for a, b in zip(out, out[1:], strict=False))     # never two blanks in a row
            have = text.split("\n")
            if opts is PLAIN:                                                  # nothing is made up or reordered
                rest = iter([x[2:-2] + "." if x.startswith("++") else x for x in have])
                assert all(line in rest for line in out)
            else:
                assert sum(line.startswith(("- ", "1. ", "2. ")) or line[:1].isdigit() for line in out) == sum(x[:1] in ("*", "#") for x in have if x)


def test_lines_and_headers(spark):
    df = spark.createDataFrame([(1, "a\n== H ==\n=== S! ===\nb")], "page_id long, text string")
    rows = shape.classify(shape.lines(df)).orderBy("line_no").collect()
    assert [r.kind for r in rows] == ["other", "header", "header", "other"]
    assert [r.head for r in rows if r.head] == ["H.", "S!"]


def test_item_numbers_at_any_depth(spark):
    text = "\n".join("#" * d + f" i{d}" for d in range(1, 10)) + "\n" + "#" * 9 + " again\n## up\n" + "#" * 7 + " new"
    c = shape.with_item_numbers(shape.classify(shape.lines(spark.createDataFrame([(1, text)], "page_id long, text string"), "page_id", "text")), "page_id")
    assert [r.item_no for r in c.orderBy("line_no").collect()] == [1] * 9 + [2, 2, 1]


def test_html_keeps_the_blank_after_a_header(spark):
    df = spark.createDataFrame([(1, "==H==\n\ntext")], "page_id long, text string")
    out = shape.compact(df, Options(to_html=True)).first().lines
    assert "" in out and out.index("") == 1


# page -> lines in HTML mode
HTML_CASES = [
    ("* a\n* b", ["<ul>", "<li>a</li>", "<li>b</li>", "</ul>"]),
    ("* a\n** b\n* c\nend", ["<ul>", "<li>a</li>", "<ul>", "<li>b</li>", "</ul>", "<li>c</li>", "</ul>", "end"]),
    ("# a\n* b", ["<ol>", "<li>a</li>", "</ol>", "<ul>", "<li>b</li>", "</ul>"]),
    ("*## a\n* b", ["<ul>", "<ol>", "<ol>", "<li>a</li>", "</ol>", "</ol>", "<li>b</li>", "</ul>"]),
    ("; t\n;: d", ["<dl>", "<dt>t</dt>", "<dl>", "<dd>d</dd>", "</dl>", "</dl>"]),
    ("*; t\n*: d", ["<ul>", "<dl>", "<dt>t</dt>", "<dd>d</dd>", "</dl>", "</ul>"]),
    # an indent leaves a list open; a blank line stands before what it closes, and a further one after that
    ("* a\n: x\n* b", ["<ul>", "<li>a</li>", "<li>b</li>", "</ul>"]),
    ("* a\n: x", ["<ul>", "<li>a</li>", "</ul>"]),
    ("* a\n\n\n\nb", ["<ul>", "<li>a</li>", "", "</ul>", "", "b"]),
    ("* a\n== H ==\nb", ["<ul>", "<li>a</li>", "</ul>", "<h2>H</h2>", "b"]),
    # empty items open and close lists
    ("*\n*\n** x", ["<ul>", "<ul>", "<li>x</li>", "</ul>", "</ul>"]),
    ("a\n\nb", ["a", "", "b"]),
    ("", []),
]


def test_html_lists(spark):
    for case, got in zip(HTML_CASES, shaped(spark, [c[0] for c in HTML_CASES], Options(to_html=True)), strict=True):
        assert got == case[1], case[0]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from([*PIECES, "*# x", "*#; y", "; t", ";: d", "*"]), min_size=1, max_size=14), min_size=2, max_size=12))
def test_html_lists_nest(spark, pages):
    for page, lines in zip(pages, shaped(spark, ["\n".join(p) for p in pages], Options(to_html=True)), strict=True):
        open_, items = [], 0
        for line in lines:
            if line in ("<ul>", "<ol>", "<dl>"):
                open_.append(line)
            elif line in ("</ul>", "</ol>", "</dl>"):
                assert open_.pop() == line.replace("/", "")
            elif line.startswith(("<li>", "<dt>", "<dd>")):
                assert open_
                items += 1
        assert not open_
        assert items == sum(x[0] in "*#;" and x.strip("*#;:") != "" for x in page if x)


def test_token_and_item_rows_keep_the_sessions_partitions(spark):
    from quarry.operators import comments as cm

    texts = spark.createDataFrame([(i, "a b\nc d e") for i in range(200)], "doc_id long, text string")
    tokens = cm.native_tokens(texts).drop("start")
    none = spark.createDataFrame([], cm.SPAN_SCHEMA)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Joined by size, these few bytes would be one partition.
    assert n > 1 and tokens.rdd.getNumPartitions() == n and cm.render(tokens, none).rdd.getNumPartitions() == n


def test_patterns_of_lines_are_asked_by_start(spark):
    """Kinds, heads and flags are those of the patterns alone."""
    from pyspark.sql import functions as F

    texts = ["", ".", "-", ".-.", ".a", "-\r", "\r", "\u0085", " ", ". ", "\r\r", "(", ")", "()", "(a)", "(a) ", "}", "a}", "{", "|", "== H ==", "==H", "= H =", "===", "====",
             " == H ==", "=== S === x", "== ==", "++t++", "++", ":", "*", "a\r"]
    ln = spark.createDataFrame(list(enumerate(texts)), "line_no int, line string")
    level = F.length(F.regexp_extract("line", shape.HEADER_RE, 1))
    first, last = F.substring("line", 1, 1), F.substring("line", -1, 1)
    got = shape.classify(ln).select(
        "line_no", (F.col("kind") == "header").eqNullSafe((F.col("line") != "") & (level > 0)), F.col("level").eqNullSafe(F.when(level > 0, level)),
        F.col("residue") == (first.isin("{", "|") | (last == "}")),
        F.col("irrelevant") == (((first == "(") & (last == ")")) | F.col("line").rlike(r"^[.\-]*$")))
    assert all(all(r[1:]) for r in got.collect())


def test_item_numbers_sort_lines_twice(spark):
    texts = ["# a\n## b\n## \n## c\n# d\n\n# e\n#* f\n## g\nx\n## h", "## a\n# b\n### c\n## d"]
    df = spark.createDataFrame(list(enumerate(texts)), "page_id long, text string")
    out = shape.with_item_numbers(shape.classify(shape.lines(df)), "page_id")
    got = {}
    for r in out.where("kind = 'list'").orderBy("page_id", "line_no").collect():
        got.setdefault(r.page_id, []).append(r.item_no)
    assert got == {0: [1, 1, 1, 2, 2, 1, 1, 1, 1], 1: [1, 1, 1, 1]}
    # Once by line and once by depth, not a third time by open list.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Sort [") == 2
