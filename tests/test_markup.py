"""Text rules (C01-C26) on small inputs, including the reference's docstring examples."""

from conftest import one
from pyspark.sql import functions as F

from quarry.functions import markup, text
from quarry.operators import select
from quarry.options import Options


def chained(spark, steps, value):
    """The text after a list of rules, applied as the jobs do."""
    return markup.steps_apply(spark.createDataFrame([(value,)], "text string"), "text", steps).first().text


def test_unescape_named_numeric_hex_and_unknown(spark):
    assert one(spark, text.unescape, "a&amp;b &eacute;&#233;&#x41; &bogus; &#X41; &#1114112;") == \
        "a&b ééA &bogus; &#X41; &#1114112;"
    # One pass only: double escapes decode one level.
    assert one(spark, text.unescape, "&amp;lt;") == "&lt;"


def test_ucfirst_keeps_rest(spark):
    assert one(spark, text.ucfirst, "hELLO world") == "HELLO world"
    assert one(spark, text.lcfirst, "Hello") == "hello"


def test_url_quote_matches_python_quote(spark):
    from urllib.parse import quote

    s = "a b/c~*+é&=?"
    assert one(spark, text.url_quote, s) == quote(s)


def test_normalize_title_examples(spark):
    f = lambda c: select.normalize_title(F.col(c), ["Category"])
    assert one(spark, f, "Category:  Births") == "Category:Births"
    assert one(spark, f, "3001:   The_Final_Odyssey") == "3001: The Final Odyssey"
    assert one(spark, f, " _foo__bar_ ") == "Foo bar"


def test_drop_nested_templates_and_tables(spark):
    r = lambda s: one(spark, lambda c: markup.drop_templates(c), s)
    assert r("a{{b|{{c}}|d}}e") == "ae"
    assert r("x {{a}}} y") == "x } y"
    t = lambda s: one(spark, lambda c: markup.drop_tables(c), s)
    assert t("a\n{| class=t\n| x {| in |} y\n|}\nb") == "a\n\nb"


def test_quotes(spark):
    q = lambda s: chained(spark, markup.quote_steps(), s)
    assert q("'''''bi''''' '''b''' ''i'' ''\"q\"''") == 'bi b "i" "q"'
    # The lazy italic rule pairs the first two quotes of ''' with the next ''.
    assert q("a ''' b '' c") == "a \"' b \" c"


def test_internal_links(spark):
    o = Options()
    r = lambda s: one(spark, lambda c: markup.internal_links(markup.internal_links(c, o), o), s)
    assert r("[[a|b]]s [[c]] [[Category:x]]y [[w:Foo|bar]] [[:File:z|q]]") == "bs c y bar "
    assert r("[[File:a.jpg|thumb|A [[b]] c]] end") == " end"
    assert r("[[a| many | label ]]") == "label"


def test_external_links(spark):
    r = lambda s: one(spark, lambda c: markup.external_links(c, Options()), s)
    assert r("[http://e.org/x site name] [http://e.org] [https://e.org/a.png http://e.org/b/c.png] x") == \
        "site name   x"
    kept = one(spark, lambda c: markup.external_links(c, Options(keep_links=True)), "[http://e.org/a b]")
    assert kept == '<a href="http%3A//e.org/a">b</a>' or kept == '<a href="http://e.org/a">b</a>'


def test_discard_nested_elements(spark):
    r = lambda s: one(spark, lambda c: markup.drop_elements(c, ["div", "ref"]), s)
    assert r("<div a=1><div>a</div>b</div>c<ref name=x>r</ref>d<ref name=y/>") == "cd<ref name=y/>"


def test_placeholders_count_per_page(spark):
    r = lambda s: one(spark, lambda c: markup.placeholder(c, "math", "formula"), s)
    assert r("<math>x</math> <math>x</math> <math display=block>y</math>") == "formula_1 formula_2 formula_3"


def test_tidy(spark):
    r = lambda s: chained(spark, markup.tidy_steps(), s)
    assert r("a\t b  c.... <<x>>\n-- \nd,, e,.") == "a b c... «x»\nd, e."


def test_comment_strip(spark):
    from quarry.operators.comments import strip_meta

    r = lambda s: one(spark, strip_meta, s)
    assert r("*[x](http://e.org/1) &gt; y &lt;~") == "x > y <"
    assert r("~~a~~") == "~a~"


def test_cleaning_is_idempotent(spark):
    o = Options()
    df = spark.createDataFrame([("<!-- c --><div>x</div>{{t}}{| a |} <br/>keep",)], "text string")
    once = markup.steps_apply(df, "text", [markup.drop_comments, markup.drop_self_closing,
                                           lambda c: markup.drop_elements(c, o.discard_elements),
                                           lambda c: markup.drop_templates(c), lambda c: markup.drop_tables(c)])
    twice = markup.steps_apply(once, "text", [markup.drop_comments, markup.drop_self_closing,
                                              lambda c: markup.drop_elements(c, o.discard_elements),
                                              lambda c: markup.drop_templates(c), lambda c: markup.drop_tables(c)])
    assert once.first().text == twice.first().text == " keep"


def test_html_mode_escapes(spark):
    df = spark.createDataFrame([("a < b & c",)], "text string")
    out = markup.clean(df, "text", Options(to_html=True)).first().text
    assert out == "a &lt; b &amp; c"


def test_long_plain_runs_are_set_aside_once_and_come_back(spark):
    run = "plain words, without marks; " * 8
    deep = "[[a|" * 6 + " " + run + "]]" * 6
    texts = {
        "x " + deep + " y": "x " + run.strip() + " y",
        f"[[{run.strip()}:t|gone]]kept [[w:{run}|  {run}]]": "kept " + run.strip(),
        f"{run}[[File:a|{run}]]{run}[[b]]": run + run + "b",
        f"7 [[a|[[b|{run}]]]]": f"7 {run.strip()}",
    }
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r.text: r.out for r in df.select("text", markup.internal_links("text").alias("out")).collect()} == texts
    # The rule sees marks in the place of the runs.
    seen = df.limit(1).select(markup.with_runs_aside(F.lit("[[a|" + "b" * 500 + "]]"), r"\[\]|:", 64, lambda t: F.length(t).cast("string")).alias("n"))
    assert int(seen.first().n) < 20


PROSE = "Plain prose, longer than any name that a rule looks for and without marks: "[:-2] + " of any kind at all, so that it is set aside"
PIECES = [
    PROSE, PROSE, PROSE + ".", "ref " + PROSE, "math " + PROSE, "code " + PROSE + " x", "'" + PROSE + "'", "(" + PROSE + ")", "é" + PROSE + "…",
    PROSE + " ", " " + PROSE, PROSE.replace(",", "  "), PROSE + "....", PROSE.replace(",", ",,"), PROSE.replace(",", ",."), PROSE + "\r", PROSE.replace(" ", "\t"),
    PROSE + " " + PROSE, "x " + "- " * 60 + ".", "; " + PROSE, PROSE + ";", PROSE + ": a", PROSE + "/", PROSE + "''", PROSE + '"', "w " + PROSE,
    "[[", "]]", "[[a|", "[[w:", "[[File:x|", "[[Category:", "|", "[[b]]", "[http://e.org ", "[http://e.org", "]", "{{", "}}", "{{t|", "{|", "|}", "''", "'''", "'''''", '""', "''\"", "\"''",
    "<", "<ref>", "</ref>", "<ref", "/>", ">", "<br", "<div>", "</div>", "<b>", "</b", "<code>", "</code>", "<math", "</math>", "<!--", "-->", "<syntaxhighlight l>", "</syntaxhighlight>",
    "&", "&amp;", "&#", "65;", ";", "__TOC__", "__", "!!", "- -", "==", "== H ==", "* x", "", " ", "x", "<<", ">>", "", "0"]


def mixed_texts(n, seed):
    import random

    r = random.Random(seed)
    texts = []
    for _ in range(n):
        pieces = PIECES if r.random() < 0.1 else PIECES[:-2]
        texts.append("".join(r.choice(pieces) + r.choice(["\n", "\n", "\n", " ", ""]) for _ in range(r.randint(1, 14))))
    return texts


def test_marked_lines_give_the_texts_of_the_plain_chain(spark):
    df = spark.createDataFrame([(t,) for t in [*mixed_texts(400, 7), None, "", PROSE, f"{PROSE}\n{PROSE}"]], "raw string").repartition(4).cache()
    for o in (Options(), Options(to_html=True), Options(keep_tables=True, keep_links=True)):
        for part, steps in ((markup.wiki2text, markup.wiki2text_steps(o)), (markup.to_text, markup.wiki2text_steps(o) + markup.clean_steps(o))):
            got = part(df.withColumn("text", F.col("raw")), "text", o).select("raw", "text").collect()
            plain = markup.steps_apply(df.withColumn("text", F.col("raw")), "text", steps).select("raw", "text").collect()
            assert dict(map(tuple, got)) == dict(map(tuple, plain)) and len(got) == len(plain)


def test_rules_see_marks_in_the_place_of_plain_lines(spark):
    page = f"'''a'''\n{PROSE}\n{PROSE}  {PROSE}\n[[b\n{PROSE}\n]]"
    df = spark.createDataFrame([(page,), (page + markup.LINE_OPEN,)], "text string")
    size = lambda c: F.length(c).cast("string")
    seen = [int(r.text) for r in markup.steps_on_marked_lines(df, "text", [size]).collect()]
    assert seen[0] < len(page) - 2 * (len(PROSE) - 12) and seen[1] == len(page) + 1
    # In HTML a link's target is escaped, so pages with links over several lines stay whole.
    assert [int(r.text) for r in markup.steps_on_marked_lines(df, "text", [size], html=True).collect()] == [len(page), len(page) + 1]


def test_references_are_cut_without_a_pattern(spark):
    for raw, want in (("&amp;", "&"), ("&&amp;;&", "&&;&"), ("a&b;&lt", "a&b;&lt"), ("", ""), ("&", "&")):
        assert one(spark, text.unescape, raw) == want
