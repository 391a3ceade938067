"""Template dictionary and expansion (E01-E12, N, M, J01-J06)."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.operators import templates as tpl
from quarry.options import Options


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, ns int, title string, redirect_title string, text string")


def _expand(spark, defs, article, opts=Options(), title="Some page/Sub"):
    rows = [(i + 100, 10, t, None, b) for i, (t, b) in enumerate(defs)]
    rows.append((1, 0, title, None, article))
    pages = _pages(spark, rows)
    d = tpl.template_dictionary(pages)
    return tpl.expand(pages.where("ns = 0"), d, opts).first().text


def test_dictionary_last_wins_redirect_and_includes(spark):
    pages = _pages(spark, [
        (1, 10, "Template:A", None, "old"),
        (2, 10, "Template:A", None, "<noinclude>doc</noinclude>new<includeonly>!</includeonly>"),
        (3, 10, "Template:B", None, "#REDIRECT [[Template:A]]"),
        (4, 10, "Template:C", None, "x<onlyinclude>o1</onlyinclude>y<onlyinclude>o2</onlyinclude>"),
        (5, 10, "Template:D", None, "<noinclude>only doc"),
    ])
    d = {r.title: r for r in tpl.template_dictionary(pages).collect()}
    assert d["Template:A"].body == "new!" and d["Template:A"].definitions == 2
    assert d["Template:B"].redirect_to == "Template:A"
    assert d["Template:C"].body == "o1o2"
    assert "Template:D" not in d


def test_arguments_named_positional_defaults(spark):
    defs = [("Template:T", "[{{{1}}}|{{{2|d2}}}|{{{3|d3}}}|{{{x|dx}}}]")]
    # {{t|a|b|c|2=B}} is {{t|a|B|c}}; {{t|a||c}} leaves 2 empty.
    assert _expand(spark, defs, "{{T|a|b|c|2=B}}") == "[a|B|c|dx]"
    assert _expand(spark, defs, "{{T|a||c}}") == "[a||c|dx]"
    assert _expand(spark, defs, "{{T| a | x = y }}") == "[a|d2|d3|y]"


def test_nested_defaults_and_indirect_names(spark):
    assert _expand(spark, [("Template:N", "{{{1|{{{2|none}}}}}}")], "{{N}}/{{N||two}}/{{N|one}}") == "none//one"
    # Template:ppp holds {{{{{{p}}}}}}: {{ppp|p=q|q=r}} gives r.
    assert _expand(spark, [("Template:Ppp", "{{{{{{p}}}}}}")], "{{ppp|p=q|q=r}}") == "r"


def test_redirects_nesting_and_missing(spark):
    defs = [("Template:Outer", "<{{Inner|{{{1}}}}}>"), ("Template:Inner", "in:{{{1}}}"),
            ("Template:Alias", "#REDIRECT [[Template:Outer]]")]
    assert _expand(spark, defs, "{{Alias|v}} {{Missing}}.") == "<in:v> ."


def test_magic_words_and_subst(spark):
    out = _expand(spark, [("Template:S", "s")], "{{PAGENAME}}|{{SUBPAGENAME}}|{{ROOTPAGENAME}}|{{subst:S}}|{{NAMESPACE}}")
    assert out == "Some page/Sub|Sub|Some page|s|"


def test_parser_functions(spark):
    art = ("{{#if: x | yes | no }},{{#if: | yes | no }},{{#ifeq: a | a | same | diff}},"
           "{{#switch: b | a = 1 | b | c = 3 | #default = 9}},{{#switch: z | a = 1 | #default = 9}},"
           "{{#switch: z | a = 1 | last}},{{lc:ABC}},{{uc:abc}},{{ucfirst:abc}},{{int: 42 }},{{#expr: 1+1}},"
           "{{#ifexist: X | a | b}},{{urlencode:a b/c}}")
    # An argument given empty wins over the default; #ifexist returns its else branch unstripped.
    assert _expand(spark, [], art) == "yes,no,same,3,9,last,abc,ABC,Abc,42,, b,a%20b/c"


def test_modules(spark):
    art = ("{{#invoke:String|len|hello}},{{#invoke:String|sub|hello|2|3}},{{#invoke:String|sub|s=hello|i=-3}},"
           "{{#invoke:String|pos|hello|-1}},{{#invoke:String|find|hello|l}},{{#invoke:String|replace|hello|l|L|1}},"
           "{{#invoke:String|rep|ab|3}},{{#invoke:Roman|main|1994}},{{#invoke:Roman|main|6000|big}},"
           "{{#invoke:If empty|main||b|c}},{{#invoke:convert|convert|5|km}}")
    assert _expand(spark, [], art) == "5,el,llo,o,3,heLlo,ababab,MCMXCIV,big,b,5 km"


def test_module_call_takes_frame_arguments(spark):
    defs = [("Template:String", "{{#invoke:String|len}}")]
    assert _expand(spark, defs, "{{String|s=abcd}}") == "4"


def test_link_pipes_do_not_split_arguments(spark):
    assert _expand(spark, [("Template:L", "({{{1}}})")], "{{L|[[a|b]]}}") == "([[a|b]])"


def test_loop_is_capped(spark):
    # The call at the cap gives empty text and counts as an error; the depth is that of calls, not of rounds.
    assert _expand(spark, [("Template:Loop", "x{{Loop}}")], "{{Loop}}", Options(max_template_depth=5)) == "xxxx"


def test_errors_are_counted_while_expanding(spark):
    pages = _pages(spark, [(100, 10, "Template:Loop", None, "x{{Loop}}{{}}"), (1, 0, "A", None, "{{Loop}} {{|y}} {{ | z}} {{:}}"),
                           (2, 0, "B", None, "{{Missing}}{{{1}}}")])
    d = tpl.template_dictionary(pages)
    out = tpl.expand(pages.where("ns = 0"), d, Options(max_template_depth=3), errors=True)
    assert {r.page_id: (r.text, r.title_errors, r.recursion_errors) for r in out.collect()} == {
        1: ("xx   ", 3 + 2, 1), 2: ("{{{1}}}", 0, 0)}


def test_each_distinct_call_is_evaluated_once(spark, monkeypatch):
    met = []
    evaluate = tpl.evaluate_calls

    def counted(calls, *rest):
        met.extend(r.call for r in calls.collect())
        return evaluate(calls, *rest)

    monkeypatch.setattr(tpl, "evaluate_calls", counted)
    defs = [("Template:A", "{{C}}{{B}}"), ("Template:B", "({{C}})"), ("Template:C", "c")]
    assert _expand(spark, defs, "{{A}}{{C}}{{B}}{{A}}") == "c(c)c(c)c(c)"
    assert sorted(met) == ["{{A}}", "{{B}}", "{{C}}"]


def test_frames_are_found_through_other_calls(spark):
    defs = [("Template:String", "<{{Mid|zz}}>"), ("Template:Mid", "{{#invoke:String|len}}|{{#invoke:Roman|main}}")]
    assert _expand(spark, defs, "{{String|abc}}{{Mid|abcd}}{{String|{{Mid}}}}") == "<3|>|<1|>"


def test_defaults_hold_calls(spark):
    defs = [("Template:D", "{{{1|{{E|a|b={{{2|{{E|z}}}}}}}}}}"), ("Template:E", "{{{1}}}{{{b|}}}")]
    assert _expand(spark, defs, "{{D}},{{D|x}},{{D|2=y}},{{E|{single}}}") == "az,x,ay,{single}"


def test_if_empty_reads_all_arguments_in_order(spark):
    assert _expand(spark, [], "{{#invoke:If empty|main|||||||||||k|l}}") == "k"
    assert _expand(spark, [], "{{#invoke:If empty|main||10=j|9=i|b=x}}") == "i"


def test_scanner_defers_calls_in_branches():
    d = tpl.defer_branches
    m = lambda t: t.translate(str.maketrans("{}|", "".join(tpl.DEFER_MASK)))
    assert d("{{#if: {{A}} | {{B|x}} | c }}") == "{{#if: {{A}} | " + m("{{B|x}}") + " | c }}"
    # #ifeq compares two expanded values; #switch labels are expanded, its values are not.
    assert d("{{#ifeq: {{A}} | {{B}} | {{C}} }}") == "{{#ifeq: {{A}} | {{B}} | " + m("{{C}}") + " }}"
    assert d("{{#switch: {{P}} | {{L}} = {{V}} | b }}") == "{{#switch: {{P}} | {{L}} = " + m("{{V}}") + " | b }}"
    # Nested branches, links and parameters inside a branch are masked with it.
    assert d("{{#if:a|[[{{X}}|y]]{{#if:b|{{Y}}}}}}") == "{{#if:a|[[" + m("{{X}}") + "|y]]" + m("{{#if:b|{{Y}}}}") + "}}"
    assert d("{{T|{{#if:|{{X}}}}}}") == "{{T|{{#if:|" + m("{{X}}") + "}}}}"
    assert d("{{T|a}} {{#lc:B}}") == "{{T|a}} {{#lc:B}}"


def test_only_the_chosen_branch_is_expanded(spark):
    defs = [("Template:Count", "{{#if:{{{1|}}}|x{{Count}}|end}}"), ("Template:Loop", "{{Loop}}"),
            ("Template:A", "a"), ("Template:B", "b"), ("Template:L", "z")]
    opts = Options(max_template_depth=12)
    # A self-recursive template stops at its guard instead of the depth cap.
    assert _expand(spark, defs, "{{Count|1}}", opts) == "xend"
    assert _expand(spark, defs, "{{#ifeq: {{A}} | a | {{B}} | {{Loop}} }}", opts) == "b"
    assert _expand(spark, defs, "{{#switch: z | {{L}} = {{B}}{{B}} | #default = {{Loop}} }}", opts) == "bb"
    assert _expand(spark, defs, "{{#if: | [[{{Loop}}]] | n{{A}} }}", opts) == "na"
    assert _expand(spark, defs, "[{{#if: {{A}} | [[p|{{B}}]] }}]", opts) == "[[[p|b]]]"


def test_ifexist_option_asks_the_dump_titles(spark):
    pages = _pages(spark, [(1, 0, "Some page", None, "{{#ifexist: other | yes | no}},{{#ifexist: Missing | yes | no}}"),
                           (2, 0, "Other", None, "x")])
    d = tpl.template_dictionary(pages)
    art = pages.where("page_id = 1")
    on = tpl.expand(art, d, Options(ifexist_titles=True), titles=pages.select("title")).first().text
    off = tpl.expand(art, d, Options(), titles=pages.select("title")).first().text
    # Off (the reference): always the else branch, unstripped.
    assert (on, off) == ("yes, no", " no, no")


def test_nowiki_protects(spark):
    assert _expand(spark, [("Template:T", "t")], "<nowiki>{{T}}</nowiki>{{T}}") == "<nowiki>{{T}}</nowiki>t"


def test_expansion_independent_of_partitions(spark):
    rows = [(i, 0, f"P{i}", None, "{{T|%d}}{{#if:%d|a|b}}" % (i, i % 2)) for i in range(40)]
    rows.append((1000, 10, "Template:T", None, "<{{{1}}}>"))
    pages = _pages(spark, rows)
    d = tpl.template_dictionary(pages)
    arts = pages.where("ns = 0")
    a = sorted(tuple(r) for r in tpl.expand(arts.repartition(1), d).select("page_id", "text").collect())
    b = sorted(tuple(r) for r in tpl.expand(arts.repartition(7), d).select("page_id", "text").collect())
    assert a == b and a[3][1] == "<3>a"


def test_hot_calls_take_the_split_path(spark):
    rows = [(i, 0, f"P{i}", None, "{{Hot|x}} {{T|%d}} {{Nope}}" % (i % 3)) for i in range(30)]
    rows += [(1000, 10, "Template:Hot", None, "h={{{1}}}"), (1001, 10, "Template:T", None, "t{{{1}}}"),
             (1002, 10, "Template:Alias", None, "#REDIRECT [[Template:Hot]]")]
    pages = _pages(spark, rows)
    d = tpl.template_dictionary(pages)
    arts = pages.where("ns = 0")
    normal = sorted(tuple(r) for r in tpl.expand(arts, d).select("page_id", "text").collect())
    split = sorted(tuple(r) for r in tpl.expand(arts, d, Options(hot_key_rows=5)).select("page_id", "text").collect())
    assert normal == split and normal[4][1] == "h=x t1 "


def test_registries_and_title_normalization(spark):
    from pyspark.sql import functions as F

    tpl.register_parser_function("#reverse", lambda a: F.reverse(F.get(a, 0)))
    tpl.register_module("Echo", "twice", lambda p: F.concat(p["v"], p["v"]), ("v",))
    assert _expand(spark, [], "{{#reverse:abc}} {{#invoke:Echo|twice|ab}}") == "cba abab"
    defs = [("Template:Big name", "ok")]
    assert _expand(spark, defs, "{{big_name}}") == ""
    assert _expand(spark, defs, "{{big_name}}", Options(normalize_titles=True)) == "ok"


def test_runaway_page_ends_the_job_if_asked(spark):
    with pytest.raises(Exception, match="max_page_chars"):
        _expand(spark, [("Template:Grow", "{{Grow}}{{Grow}}")], "{{Grow}}", Options(max_page_chars=200))


def test_single_braces_tables_and_own_mask_characters(spark):
    defs = [("Template:T", "<{{{1}}}>"), ("Template:U", "[{{{1|d{e}f}}}]")]
    assert _expand(spark, defs, "{{T|a{b}c}}") == "<a{b}c>"
    assert _expand(spark, defs, "{{T|{| x | y |} }}") == "<{| x | y |}>"
    assert _expand(spark, defs, "{{U|{x {{T|q}} }}") == "[{x <q>]"
    assert _expand(spark, defs, "{{U}}") == "[d{e}f]"
    assert _expand(spark, defs, "\ue001 \ue002\ue000a {{T|\ue006}}") == "\ue001 \ue002\ue000a <\ue006>"


def test_patterns_from_pages_never_end_the_job(spark):
    r = lambda call: _expand(spark, [], call)
    assert r("{{#invoke:String|replace|abc|(|x|0|0}}") == ""
    assert r("{{#invoke:String|replace|abc|b|$9|0|0}}") == "a$9c"
    assert r("{{#invoke:String|replace|a.b.c|[.]|-|1|0}}") == "a-b.c"
    assert r("{{#invoke:String|replace|aXbXX|X+|-|0|0}}") == "a-b-"
    assert r("{{#invoke:String|find|abc|[|1|0}}") == ""
    assert r("{{#invoke:String|find|abc|[bc]|1|0}}") == "2"
    assert r("{{#invoke:String|replace|a\\Eb|\\E|-}}") == "a-b"
    assert r("{{#invoke:String|rep|ab|999999999}}") == ""


_PIECES = ["{{", "}}", "{{{", "}}}", "{", "}", "|", "=", "[[", "]]", "#if:", "#ifeq:", "#switch:", "#IF:",
           "T", "a", " ", "\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(_PIECES), max_size=40))
def test_scanner_round_trips_and_is_stable(pieces):
    text = "".join(pieces)
    out = tpl.defer_branches(text)
    restore = str.maketrans("".join(tpl.DEFER_MASK), "{}|")
    assert out.translate(restore) == text
    assert tpl.defer_branches(out.translate(restore)) == out
    if "#" not in text:
        assert out == text


def test_rounds_carry_only_the_text_between_first_and_last_call(spark):
    texts = ["a { b }} c {{T|x}} d {{ e }", "no call }} {{", "{{T|p}}", "x {{{T|q}}} } y", "}} {{T|r}} {{", "", None]
    pages = spark.createDataFrame([(i, f"P{i}", t) for i, t in enumerate(texts)], "page_id long, title string, text string")
    cut = {r.page_id: (r._head, r.text, r._tail) for r in tpl._with_core(pages).collect()}
    assert cut[0] == ("a { b }} c ", "{{T|x}}", " d {{ e }") and cut[1] == ("no call }} {{", "", "") and cut[2] == ("", "{{T|p}}", "")
    assert cut[3] == ("x ", "{{{T|q}}}", " } y") and cut[4][1:] == ("{{T|r}}", " {{") and cut[5] == ("", "", "") and cut[6][1] is None
    d = spark.createDataFrame([("Template:T", "<{{{1}}}>", None)], "title string, body string, redirect_to string")
    # Keys that repeat don't mix their pages.
    same = pages.withColumn("page_id", pages.page_id % 2)
    out = sorted(r.text for r in tpl.expand(same, d).collect())
    assert out == sorted(["a { b }} c <x> d {{ e }", "no call }} {{", "<p>", "x {{{T|q}}} } y", "}} <r> {{", ""])
