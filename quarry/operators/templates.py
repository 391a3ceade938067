"""Template dictionary and expansion as iterated joins (E01-E12, J01-J06, A01, N, M).

Expansion runs inside-out in rounds.  Each round takes the *innermost* calls
(``{{..}}`` with no braces inside), evaluates the ones a page can answer
itself in its own row (magic words, parser functions, modules) and looks up
template calls with joins:

    distinct calls --(title)--> redirects, templates --> body with the call's
    arguments substituted --(call)--> pages that made the call --(page_id)-->
    text with the values put back

Only pages that still hold a call take part in the next round; finished pages
are set aside.  Each round's active set is checkpointed to the cluster's checkpoint folder so the
lineage stays short.

Calls only stand between a page's first ``{{`` and its last ``}}``, now and in every later round.  The text on both
sides of these is written once, rounds carry what lies between, and one join at the end puts the page together.

A call's value depends on its text alone, so a table call -> value lives across the
rounds and a round evaluates only the calls that are not in it yet (anti-join).

A value that holds further calls is put back between frame marks that name the call it came
from; the marks open before a call are its enclosing calls, outermost first.  Their number is the call's
depth: a template call at the depth cap gives empty text and counts as a recursion error (A03).  A module call
without arguments asks the table of enclosing calls for the arguments of the nearest one of its own
title (J06).
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarry.functions.cache import cached
from quarry.functions.markup import COMMENT_RE, INNER_TABLE_RE
from quarry.functions.text import col_, int_text, lcfirst, roman, strip_ws, sub_with, ucfirst, url_quote
from quarry.operators.joins import lookup
from quarry.operators.select import normalize_title, qualified_template_title, template_pages, with_title_parts
from quarry.options import Options
from quarry.session import checkpoint_dir

# Pipes inside [[links]] and {{!}} must not split arguments; they travel masked.
PIPE_MASK = "\uE001"
# Braces inside <nowiki> are hidden from expansion.
BRACE_MASK = ("\uE002", "\uE003")
# Braces and pipes of calls that wait in an untaken-yet branch of a branching function.
DEFER_MASK = ("\uE004", "\uE005", "\uE006")
# Pipes of calls inside an argument's default, while the default is cut out.
CALL_PIPE = "\uE007"
# Around a value that holds calls: open, id of the call it came from, end of the id; close.
FRAME_OPEN, FRAME_ID, FRAME_CLOSE = "\uE008", "\uE009", "\uE00A"
MASKS = PIPE_MASK + "".join(BRACE_MASK) + "".join(DEFER_MASK) + CALL_PIPE + FRAME_OPEN + FRAME_ID + FRAME_CLOSE
FRAME_MARK_RE = f"{FRAME_OPEN}([0-9A-F]*){FRAME_ID}|{FRAME_CLOSE}"
# Stands before a letter for a mask character that was in the text.
ESCAPE = "\uE000"
# Branching functions: only the chosen branch is expanded.
BRANCHING_RE = r"(?i)\{\{\s*#(?:if|ifeq|iferror|ifexist|ifexpr|switch):"
# No double braces inside; single ones are text.
_SINGLE = r"[^{}]*+(?:\{(?!\{)[^{}]*+|\}(?!\})[^{}]*+)*+"
# Braces after the call close what is around it (``{{{1|{{t}}}}}``) or are text.
INNER_CALL_RE = r"(?<!\{)\{\{(?!\{)" + _SINGLE + r"\}\}"


def _holding_calls(levels: int) -> str:
    """Text with single braces and whole calls, those up to ``levels`` deep."""
    text = _SINGLE
    for _ in range(levels):
        text = r"[^{}]*+(?:(?:\{(?!\{)|\}(?!\})|\{\{(?!\{)" + text + r"\}\})[^{}]*+)*+"
    return text


# Defaults may hold calls (their arguments are substituted first, the calls wait).
INNER_ARG_RE = r"\{\{\{(?!\{)" + _holding_calls(4) + r"\}\}\}"
DEFAULT_CALL_RE = r"\{\{(?!\{)" + _holding_calls(3) + r"\}\}"
# A module call without arguments, and a call without a title.
BARE_INVOKE_RE = r"(?i)^\{\{\s*#invoke:([^|{}]*)\|([^|{}]*)\}\}$"
NO_TITLE_RE = r"(?i)^\{\{\s*(?:subst:|safesubst:)?\s*:?\s*(?:\||\}\}$)"
# What a module call becomes that no enclosing call has arguments for: a failing call.
NO_FRAME = "{{#if:}}"
# Redirect, substitution and error marks.
REDIRECT_RE = r"(?i)^#REDIRECT.*?\[\[([^\]]*)\]\]"
SUBST_RE = r"(?i)^(?:subst:|safesubst:)"
IFERROR_RE = (r'^<(?:strong|span|p|div)\s(?:[^\s>]*\s+)*?class="(?:[^"\s>]*\s+)*?error(?:\s[^">]*)?"')
CLOCK_FORMATS = {"CURRENTYEAR": "yyyy", "CURRENTMONTH": "MM", "CURRENTDAY": "dd",
                 "CURRENTHOUR": "HH", "CURRENTTIME": "HH:mm:ss"}


# ---------------------------------------------------------------------------
# Dictionary

def template_redirect(text) -> Column:
    """Target of ``#REDIRECT [[X]]`` or NULL."""
    t = F.regexp_extract(col_(text), REDIRECT_RE, 1)
    return F.when(col_(text).rlike(REDIRECT_RE), t)


def definition_rows(pages: DataFrame) -> DataFrame:
    """F06 + E04 + E05: every template page with its redirect target or transcluded body.

    Each rule is its own projection so no regex runs twice for a row.  No
    filter here: Catalyst pushes a filter below deterministic projections by
    inlining them, which would run the whole chain twice.
    """
    t = template_pages(pages).select("page_id", "ns", "title", "text")
    t = t.withColumn("redirect_to", template_redirect("text"))
    for pattern in (COMMENT_RE, r"(?s)<noinclude>.*?</noinclude>", r"(?s)<noinclude\s*>.*$", r"<noinclude/>"):
        t = t.withColumn("text", F.when(F.col("redirect_to").isNull(), F.regexp_replace("text", pattern, "")))
    t = t.withColumn("_only", F.array_join(F.regexp_extract_all(
        "text", F.lit(r"(?s)<onlyinclude>(.*?)</onlyinclude>"), 1), ""))
    t = t.withColumn("body", F.when(F.col("_only") != "", F.col("_only")).otherwise(
        F.regexp_replace("text", r"<includeonly>|</includeonly>", "")))
    return t.select("page_id", "ns", "title", "redirect_to", "body")


def definitions(pages: DataFrame) -> DataFrame:
    """F07 on top: template pages that define something (a redirect or a non-empty body)."""
    return definition_rows(pages).where(F.col("redirect_to").isNotNull() | (F.length("body") > 0))


def template_dictionary(pages: DataFrame) -> DataFrame:
    """Last definition (in dump order) wins; redirects kept beside bodies.

    ``templates(title, ns, page_id, body, redirect_to, definitions)`` from one
    ``groupBy(title)`` with conditional ``max_by`` (rows whose ordering value
    is NULL do not take part), so one shuffle with partial aggregation.
    """
    d = definition_rows(pages)
    is_redirect = F.col("redirect_to").isNotNull()
    # F07 inside the aggregate: empty bodies take no part (a filter would be pushed below the rules).
    is_body = ~is_redirect & (F.length("body") > 0)
    g = d.groupBy("title").agg(
        F.max_by(F.struct("ns", "page_id", "body"), F.when(is_body, F.col("page_id"))).alias("b"),
        F.max_by(F.struct("ns", "page_id", "redirect_to"), F.when(is_redirect, F.col("page_id"))).alias("r"),
        F.count(F.when(is_body, F.lit(1))).alias("definitions"))
    g = g.where(F.col("b").isNotNull() | F.col("r").isNotNull())
    return g.select(
        "title",
        F.coalesce(F.col("r.ns"), F.col("b.ns")).alias("ns"),
        F.greatest(F.col("r.page_id"), F.col("b.page_id")).alias("page_id"),
        F.col("b.body").alias("body"),
        F.col("r.redirect_to").alias("redirect_to"),
        "definitions")


def merge_dictionaries(saved: DataFrame, later: DataFrame) -> DataFrame:
    """A saved dictionary brought up to date with that of a later dump, whose bodies and redirects win.

    One full outer join on the title; redirects are resolved when the dictionary is used, so those into
    changed templates follow.
    """
    s, n = saved.alias("s"), later.alias("n")
    redirect = F.coalesce("n.redirect_to", "s.redirect_to")
    ns = (F.when(F.col("n.redirect_to").isNotNull(), F.col("n.ns")).when(F.col("s.redirect_to").isNotNull(), F.col("s.ns"))
          .otherwise(F.coalesce("n.ns", "s.ns")))
    return s.join(n, F.col("s.title") == F.col("n.title"), "full").select(
        F.coalesce("n.title", "s.title").alias("title"), ns.alias("ns"), F.greatest("n.page_id", "s.page_id").alias("page_id"),
        F.coalesce("n.body", "s.body").alias("body"), redirect.alias("redirect_to"),
        (F.coalesce("n.definitions", F.lit(0)) + F.coalesce("s.definitions", F.lit(0))).cast("long").alias("definitions"))


def resolved_bodies(templates: DataFrame) -> DataFrame:
    """J02 applied once: ``(title, body)`` where a redirect takes its target's body (one hop).

    A redirect to a missing template gives an empty body; one row per title.
    One self left-join on the redirect target.
    """
    d = templates.where(F.col("body").isNotNull() | F.col("redirect_to").isNotNull())
    targets = d.where(F.col("body").isNotNull()).select(F.col("title").alias("redirect_to"),
                                                         F.col("body").alias("target_body"))
    return d.join(targets, "redirect_to", "left").select(
        "title", F.when(F.col("redirect_to").isNotNull(), F.coalesce("target_body", F.lit("")))
        .otherwise(F.col("body")).alias("body"))


def template_prefixes(pages: DataFrame) -> DataFrame:
    """Namespace names of templates (10) and modules (828) from the first such title."""
    t = template_pages(pages).where(F.locate(":", "title") > 2)
    return t.groupBy("ns").agg(F.min_by(F.substring_index("title", ":", 1), "page_id").alias("ns_name"))


# ---------------------------------------------------------------------------
# Calls: splitting and binding

def mask_link_pipes(text) -> Column:
    """Pipes inside ``[[..]]`` and ``{|..|}`` do not separate arguments."""
    t = col_(text)
    masked = sub_with(t, r"\[\[[^\[\]{}]*\]\]|" + INNER_TABLE_RE, lambda m: F.translate(m, "|", PIPE_MASK))
    return F.when(t.contains("[[") | t.contains("{|"), masked).otherwise(t)


def own_pipes(value) -> Column:
    """Pipes that a value brings along don't separate the arguments of the call it is put into; those of its own calls do theirs."""
    t = col_(value)
    masked = F.translate(t, "|", PIPE_MASK)
    return (F.when(~t.contains("|"), t).when(~t.contains("{{"), masked)
            .otherwise(sub_with(masked, DEFAULT_CALL_RE, lambda c: F.translate(c, PIPE_MASK, "|"))))


def mask_nowiki(text) -> Column:
    t = col_(text)
    masked = sub_with(t, r"(?s)<nowiki>.*?</nowiki>", lambda m: F.translate(m, "{}", "".join(BRACE_MASK)))
    return F.when(t.contains("<nowiki>"), masked).otherwise(t)


def unmask(text) -> Column:
    masks = PIPE_MASK + "".join(BRACE_MASK) + "".join(DEFER_MASK)
    t = F.translate(strip_frames(text), masks, "|{}{}|")
    own = t
    for i, mark in enumerate(MASKS + ESCAPE):
        own = F.replace(own, F.lit(ESCAPE + chr(97 + i)), F.lit(mark))
    return F.when(t.contains(ESCAPE), own).otherwise(t)


def escape_masks(text) -> Column:
    """Mask characters that the text itself holds, escaped so that ``unmask`` gives them back."""
    t = col_(text)
    own = F.replace(t, F.lit(ESCAPE), F.lit(ESCAPE + chr(97 + len(MASKS))))
    for i, mark in enumerate(MASKS):
        own = F.replace(own, F.lit(mark), F.lit(ESCAPE + chr(97 + i)))
    return F.when(t.rlike(f"[{ESCAPE}{MASKS}]"), own).otherwise(t)


def strip_frames(text) -> Column:
    t = col_(text)
    return F.when(t.rlike(f"[{FRAME_OPEN}{FRAME_CLOSE}]"), F.regexp_replace(t, FRAME_MARK_RE, "")).otherwise(t)


# ---------------------------------------------------------------------------
# Lazy branches.  Rounds expand innermost calls first; a call inside a branch
# of #if / #ifeq / #iferror / #ifexist / #ifexpr or inside a #switch value is
# masked instead, so the branching call becomes innermost once its test is
# expanded, picks a branch as text, and only that branch is expanded in the
# following rounds.  Finding those calls needs brace matching, which no regex
# can do, so a small scanner runs on the rows that hold a branching call.

_TOKEN = re.compile(r"\{+|\}+|\[\[|\]\]|\||=")
_BRANCH_HEAD = re.compile(r"\s*#(if|ifeq|iferror|ifexist|ifexpr|switch):", re.IGNORECASE)
# First argument taken as a branch (argument 0 is the text after the colon).
_FIRST_BRANCH = {"if": 1, "ifeq": 2, "iferror": 1, "ifexist": 1, "ifexpr": 1}
_WIDTH = {"call": 2, "arg": 3}
_DEFER_TABLE = str.maketrans("{}|", "".join(DEFER_MASK))


def _at_branch(frame) -> bool:
    """Is the scan inside a branch argument of this (branching) call?"""
    kind, fn, arg, eq, _, _ = frame
    if kind != "call" or fn is None:
        return False
    if fn == "switch":
        return arg >= 1 and eq          # case values; the labels are compared, so expanded
    return arg >= _FIRST_BRANCH[fn]


def _opened(n: int) -> list:
    """A run of ``n`` opening braces, outermost first: ``{{{{{`` is ``{{`` then ``{{{``."""
    if n % 3 == 2:
        return [(0, "call")] + [(2 + 3 * i, "arg") for i in range(n // 3)]
    return [(n % 3 + 3 * i, "arg") for i in range(n // 3)]    # a lone ``{`` first is text


def defer_branches(text: str) -> str:
    """Mask the braces and pipes of every call that sits in a branch (see above)."""
    # A frame is [kind, branching function, argument number, '=' seen, owner, start]; the
    # owner is the start of the nearest branching call whose branch holds the frame.
    stack, spans, closed = [], [], set()
    for m in _TOKEN.finditer(text):
        tok = m.group()
        top = stack[-1] if stack else None
        if tok[0] == "{" or tok == "[[":
            frames = _opened(len(tok)) if tok[0] == "{" else [(0, "link")]
            for off, kind in frames:
                top = stack[-1] if stack else None
                owner = None if top is None else (top[5] if _at_branch(top) else top[4])
                head = _BRANCH_HEAD.match(text, m.start() + off + 2) if kind == "call" else None
                stack.append([kind, head.group(1).lower() if head else None, 0, False, owner, m.start() + off])
        elif tok[0] == "}":
            pos, left = m.start(), len(tok)
            # Close open frames from the inside while the run lasts; extra braces are text.
            while stack and stack[-1][0] in _WIDTH and left >= _WIDTH[stack[-1][0]]:
                frame = stack.pop()
                pos, left = pos + _WIDTH[frame[0]], left - _WIDTH[frame[0]]
                if frame[0] == "call":
                    closed.add(frame[5])
                    if frame[4] is not None:
                        spans.append((frame[5], pos, frame[4]))
        elif tok == "]]":
            if top is not None and top[0] == "link":
                stack.pop()
        elif top is not None and top[0] == "call":
            if tok == "|":
                top[2], top[3] = top[2] + 1, False
            else:
                top[3] = True
    # Calls in a branching call that never closes are not deferred (it never becomes innermost).
    spans = sorted((start, end) for start, end, owner in spans if owner in closed)
    if not spans:
        return text
    out, pos = [], 0
    for start, end in spans:
        if end <= pos:
            continue                    # inside a span already masked
        start = max(start, pos)
        out.append(text[pos:start])
        out.append(text[start:end].translate(_DEFER_TABLE))
        pos = end
    out.append(text[pos:])
    return "".join(out)


@F.pandas_udf(StringType())
def _defer_branches_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else defer_branches(t))


def with_deferred_branches(pages: DataFrame) -> DataFrame:
    """Re-open last round's deferred calls, then defer the ones still in a branch.

    Only rows holding a branching call are sent to Python (others pass a null).
    """
    text = F.translate("text", "".join(DEFER_MASK), "{}|")
    has = F.coalesce(text.rlike(BRANCHING_RE), F.lit(False))
    return pages.withColumn("text", F.when(has, _defer_branches_udf(F.when(has, text))).otherwise(text))


def call_parts(call: Column) -> Column:
    """``{{title|a|b}}`` -> ``[title, a, b]`` (innermost call: no braces inside)."""
    return F.split(F.substring(call, 3, F.length(call) - 4), r"\|")


def keep_or_strip(v: Column) -> Column:
    """Values are trimmed unless they hold a link end ``]]``."""
    return F.when(v.contains("]]"), v).otherwise(strip_ws(v))


def bind(params: Column) -> Column:
    """Named (``k=v``, first ``=``) and positional arguments -> map; last wins."""
    def entry(p, i):
        named = p.contains("=")
        position = F.size(F.filter(F.slice(params, 1, i + 1), lambda x: ~x.contains("=")))
        key = F.when(named, strip_ws(F.substring_index(p, "=", 1))).otherwise(position.cast("string"))
        value = keep_or_strip(F.when(named, F.substring(p, F.locate("=", p) + 1, 1 << 30)).otherwise(p))
        return F.struct(key.alias("key"), value.alias("value"))

    return F.map_from_entries(F.transform(params, entry))


def substitute_args(body: Column, args: Column, rounds: int) -> Column:
    """``{{{name|default}}}`` -> argument, else default, else empty (innermost first)."""
    def render(m):
        inner = F.substring(m, 4, F.length(m) - 6)
        hidden = F.when(inner.contains("{{"), sub_with(inner, DEFAULT_CALL_RE, lambda c: F.translate(c, "|", CALL_PIPE))).otherwise(inner)
        name = F.substring_index(hidden, "|", 1)
        default = F.when(hidden.contains("|"), F.translate(F.get(F.split(hidden, r"\|"), 1), CALL_PIPE, "|"))
        return F.coalesce(F.try_element_at(args, name), default, F.lit(""))

    r = body
    for _ in range(rounds):
        r = F.when(r.contains("{{{"), sub_with(r, INNER_ARG_RE, render)).otherwise(r)
    return r


# ---------------------------------------------------------------------------
# Parser functions and modules

def _arg(args: Column, i: int) -> Column:
    return F.get(args, i)


def _present(args: Column, i: int) -> Column:
    return F.size(args) > i


def pf_if(a: Column) -> Column:
    t, yes, no = _arg(a, 0), _arg(a, 1), _arg(a, 2)
    return F.when(~_present(a, 1), F.lit("")).when(strip_ws(t) != "", strip_ws(yes)) \
        .otherwise(F.coalesce(strip_ws(no), F.lit("")))


def pf_ifeq(a: Column, blank_equal: bool = False) -> Column:
    left, right, yes, no = (strip_ws(_arg(a, i)) for i in range(4))
    eq = left == right
    if not blank_equal:
        eq = eq & (right != "")
    res = F.when(eq, yes).when(right != "", F.coalesce(no, F.lit("")))
    return F.when(~_present(a, 2), F.lit("")).otherwise(F.coalesce(res, F.lit("")))


def pf_iferror(a: Column) -> Column:
    t = _arg(a, 0)
    return (F.when(t.rlike(IFERROR_RE), F.coalesce(strip_ws(_arg(a, 1)), F.lit("")))
            .when(~_present(a, 2), strip_ws(t))
            .otherwise(strip_ws(_arg(a, 2))))


def pf_switch(a: Column) -> Column:
    """First valued case at or after the first match, else ``#default``, else a bare last case."""
    primary = strip_ws(_arg(a, 0))
    cases = F.slice(a, 2, 1 << 20)
    info = F.transform(cases, lambda c, i: F.struct(
        i.alias("i"), (F.locate("=", c) > 0).alias("eq"),
        strip_ws(F.substring_index(c, "=", 1)).alias("l"),
        strip_ws(F.substring(c, F.locate("=", c) + 1, 1 << 30)).alias("r")))
    hit = F.array_min(F.transform(F.filter(info, lambda x: F.when(
        x["eq"], F.exists(F.split(x["l"], r"\|"), lambda v: strip_ws(v) == primary)).otherwise(x["l"] == primary)),
        lambda x: x["i"]))
    valued = F.array_min(F.transform(F.filter(info, lambda x: x["eq"] & (x["i"] >= hit)), lambda x: x["i"]))
    value = F.get(info, valued)["r"]
    defaults = F.filter(info, lambda x: x["eq"] & (x["l"] == "#default"))
    last = F.get(info, F.size(info) - 1)
    bare_last = F.when((F.size(info) > 0) & ~last["eq"], last["l"])
    return F.coalesce(F.when(hit.isNotNull() & valued.isNotNull(), value), bare_last,
                      F.get(defaults, F.size(defaults) - 1)["r"], F.lit(""))


def pf_ifexist(a: Column) -> Column:
    return F.when(F.size(a) == 3, _arg(a, 2)).otherwise(F.lit(""))


def _empty(_a: Column) -> Column:
    return F.lit("")


PARSER_FUNCTIONS = {
    "#if": pf_if,
    "#ifeq": pf_ifeq,
    "#iferror": pf_iferror,
    "#switch": pf_switch,
    "#ifexist": pf_ifexist,
    "#expr": _empty,
    "#ifexpr": _empty,
    "#rel2abs": _empty,
    "#language": _empty,
    "#time": _empty,
    "#timel": _empty,
    "#titleparts": _empty,
    "urlencode": lambda a: url_quote(_arg(a, 0)),
    "lc": lambda a: F.lower(_arg(a, 0)),
    "uc": lambda a: F.upper(_arg(a, 0)),
    "lcfirst": lambda a: lcfirst(_arg(a, 0)),
    "ucfirst": lambda a: ucfirst(_arg(a, 0)),
    "int": lambda a: int_text(_arg(a, 0)),
}


# Parameter names of each module function, in binding order.
# Module functions and the names of their parameters.
MODULE_PARAMS = {
    ("String", "len"): ("s",),
    ("String", "sub"): ("s", "i", "j"),
    ("String", "sublength"): ("s", "i", "len"),
    ("String", "pos"): ("target", "pos"),
    ("String", "find"): ("source", "target", "start", "plain"),
    ("String", "replace"): ("source", "pattern", "replace", "count", "plain"),
    ("String", "rep"): ("source", "count"),
}


def resolve_module_params(params: Column, names: Column) -> Column:
    """Each name by itself, else the next unused positional argument; missing -> ''.

    One fold over the (short) name list, so the expression stays small.
    """
    init = F.struct(F.lit(1).alias("pos"), F.create_map().cast("map<string,string>").alias("m"))

    def step(acc, n):
        named = F.try_element_at(params, n)
        positional = F.try_element_at(params, acc["pos"].cast("string"))
        return F.struct(
            F.when(named.isNull() & positional.isNotNull(), acc["pos"] + 1).otherwise(acc["pos"]).alias("pos"),
            F.map_concat(acc["m"], F.create_map(n, F.coalesce(named, positional, F.lit("")))).alias("m"))

    return F.aggregate(names, init, step, lambda acc: acc["m"])


def module_params(p: Column, names) -> dict:
    """Resolved parameters (``p`` is the map made by ``resolve_module_params``)."""
    return {n: F.coalesce(F.try_element_at(p, F.lit(n)), F.lit("")) for n in names}


def _int_or(s: Column, default: int) -> Column:
    return F.when(s == "", F.lit(default)).otherwise(strip_ws(s).try_cast("bigint"))


def m_len(p):
    return F.length(module_params(p, ["s"])["s"]).cast("string")


def m_sub(p):
    q = module_params(p, ["s", "i", "j"])
    s, i, j = q["s"], _int_or(q["i"], 1), _int_or(q["j"], -1)
    n = F.length(s)
    start = F.when(i > 0, i - 1).otherwise(F.greatest(n + i, F.lit(0)))
    j2 = F.when(j < 0, j + 1).otherwise(j)
    stop = F.when(j2 == 0, n).when(j2 < 0, n + j2).otherwise(F.least(j2, n))
    return F.when(i.isNull() | j.isNull(), F.lit("")).otherwise(
        F.when(stop > start, F.substring(s, (start + 1).cast("int"), (stop - start).cast("int"))).otherwise(F.lit("")))


def m_sublength(p):
    q = module_params(p, ["s", "i", "len"])
    s, i, ln = q["s"], _int_or(q["i"], 1) - 1, _int_or(q["len"], 1)
    n = F.length(s)
    start = F.when(i >= 0, i).otherwise(F.greatest(n + i, F.lit(0)))
    stop = F.when(i + ln >= 0, F.least(i + ln, n)).otherwise(n + i + ln)
    return F.when(i.isNull() | ln.isNull(), F.lit("")).otherwise(
        F.when(stop > start, F.substring(s, (start + 1).cast("int"), (stop - start).cast("int"))).otherwise(F.lit("")))


def m_pos(p):
    q = module_params(p, ["target", "pos"])
    s, pos = q["target"], _int_or(q["pos"], 1)
    n = F.length(s)
    idx = F.when(pos > 0, pos - 1).otherwise(n + pos)
    return F.when((idx >= 0) & (idx < n), F.substring(s, (idx + 1).cast("int"), 1)).otherwise(F.lit(""))


# Patterns that page text may ask for: literals, escapes, classes, repeats and groups one level deep.
_CLASS = r"\[\^?(?:\\[\w\\.\]\[^-]|a-z|A-Z|0-9|[^\]\[\\&-])+\]"
_ATOM = r"(?:[^\\\[\](){}*+?|]|\\(?:[dswDSWbB]|[^\w\s])|" + _CLASS + ")"
_REPEAT = r"(?:[*+?]\??|\{\d{1,3}(?:,)?\})?"
_SEQUENCE = f"(?:{_ATOM}{_REPEAT}|\\|)*+"
SAFE_PATTERN_RE = f"(?s)^(?:{_ATOM}{_REPEAT}|\\||\\((?:\\?:)?{_SEQUENCE}\\){_REPEAT})++$"
NEVER = r"(?!)"
# Characters that ``rep`` may build; more counts as a failing call.
MAX_REPEATED = 1 << 24


def m_find(p):
    q = module_params(p, ["source", "target", "start", "plain"])
    src, tgt = q["source"], q["target"]
    start = F.coalesce(_int_or(q["start"], 1), F.lit(1))
    plain = F.coalesce(_int_or(q["plain"], 1), F.lit(1))
    safe = tgt.rlike(SAFE_PATTERN_RE)
    pattern = F.when(safe, tgt).otherwise(F.lit(NEVER))
    rest = F.substring(src, F.greatest(start, F.lit(1)).cast("int"), 1 << 30)
    at = F.regexp_instr(rest, pattern)
    found = F.when(plain != 0, F.call_function("locate", tgt, src, F.greatest(start, F.lit(1)).cast("int"))) \
        .otherwise(at + F.when(at > 0, F.greatest(start, F.lit(1)) - 1).otherwise(0))
    # A failing call gives empty text.
    return F.when((src == "") | (tgt == ""), F.lit("0")).when((plain == 0) & ~safe, F.lit("")) \
        .otherwise(found.cast("string"))


def m_replace(p):
    q = module_params(p, ["source", "pattern", "replace", "count", "plain"])
    src, pat, rep = q["source"], q["pattern"], q["replace"]
    count = F.coalesce(_int_or(q["count"], 0), F.lit(0))
    plain = F.coalesce(_int_or(q["plain"], 1), F.lit(1))
    safe = pat.rlike(SAFE_PATTERN_RE)
    quoted = F.concat(F.lit(r"\Q"), F.replace(pat, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E"))
    pattern = F.when(plain != 0, quoted).when(safe, pat).otherwise(F.lit(NEVER))
    limited = F.call_function("array_join", F.split(src, pattern, (count + 1).cast("int")), rep)
    literal = F.regexp_replace(rep, r"([\\$])", r"\\$1")
    every = F.when(plain != 0, F.replace(src, pat, rep)).otherwise(F.regexp_replace(src, pattern, literal))
    return F.when(pat == "", src).when((plain == 0) & ~safe, F.lit("")) \
        .when(count > 0, limited).otherwise(every)


def m_rep(p):
    q = module_params(p, ["source", "count"])
    count = F.coalesce(_int_or(q["count"], 1), F.lit(0))
    return F.when(F.length(q["source"]) * count > MAX_REPEATED, F.lit("")).otherwise(
        F.call_function("repeat", q["source"], F.least(count, F.lit(MAX_REPEATED)).cast("int")))


def m_roman(p):
    n = F.try_element_at(p, F.lit("1")).try_cast("double")
    return F.when(n.isNull(), F.lit("")).otherwise(
        F.when(F.floor(n) == 0, F.lit("")).otherwise(
            roman(F.when(n < 0, F.ceil(n)).otherwise(F.floor(n)),
                  F.coalesce(F.try_element_at(p, F.lit("2")), F.lit("N/A")))))


def m_if_empty(p):
    """The first argument that isn't empty: positional ones by number, then named ones by name."""
    vals = F.sort_array(F.transform(F.map_entries(p), lambda e: F.struct(
        F.coalesce(e["key"].try_cast("bigint"), F.lit(1 << 62)).alias("number"), e["key"].alias("name"), e["value"].alias("value"))))
    return F.coalesce(F.get(F.filter(vals, lambda v: v["value"] != ""), 0)["value"], F.lit(""))


def m_convert(p):
    v, u = F.try_element_at(p, F.lit("1")), F.try_element_at(p, F.lit("2"))
    return F.when(v.isNotNull() & u.isNotNull(), F.concat_ws(" ", v, u)).otherwise(F.lit(""))


MODULES = {
    ("convert", "convert"): m_convert,
    ("If empty", "main"): m_if_empty,
    ("String", "len"): m_len,
    ("String", "sub"): m_sub,
    ("String", "sublength"): m_sublength,
    ("String", "pos"): m_pos,
    ("String", "find"): m_find,
    ("String", "replace"): m_replace,
    ("String", "rep"): m_rep,
    ("Roman", "main"): m_roman,
    ("Numero romano", "main"): m_roman,
}


def register_parser_function(name: str, fn) -> None:
    """Add (or replace) a parser function ``fn(args: Column) -> Column`` under its lower-case name."""
    from quarry.functions.cache import forget

    PARSER_FUNCTIONS[name.lower()] = fn
    forget("parser_functions")


def register_module(module: str, function: str, fn, params: tuple | None = None) -> None:
    """Add a module function ``fn(params_map: Column) -> Column``.

    With ``params`` (names in binding order) the map holds those names,
    resolved by name or position (M10); without, the raw bound arguments.
    """
    from quarry.functions.cache import forget

    MODULES[(module, function)] = fn
    if params:
        MODULE_PARAMS[(module, function)] = tuple(params)
    forget("parser_functions")


def module_names(args: Column) -> Column:
    """Parameter names of the invoked module function (empty for the others)."""
    module, fun = strip_ws(_arg(args, 0)), strip_ws(_arg(args, 1))
    r = F.array().cast("array<string>")
    for (m, f), names in MODULE_PARAMS.items():
        r = F.when((module == m) & (fun == f), F.array(*[F.lit(n) for n in names])).otherwise(r)
    return r


def invoke(args: Column, params: Column, resolved: Column) -> Column:
    """``#invoke:module|function|args`` over the built-in modules.

    ``params`` is the bound map of ``args[2:]``; ``resolved`` the same bound
    to the function's parameter names (M10).
    """
    module, fun = strip_ws(_arg(args, 0)), strip_ws(_arg(args, 1))
    r = F.lit("")
    for (m, f), fn in MODULES.items():
        r = F.when((module == m) & (fun == f), fn(resolved if (m, f) in MODULE_PARAMS else params)).otherwise(r)
    return F.when(F.size(args) >= 2, r).otherwise(F.lit(""))


def parser_function(name: Column, args: Column, params: Column, resolved: Column | None = None,
                    extra: dict | None = None) -> Column:
    """Dispatch on the lower-cased function name; unknown -> empty.

    ``args`` are the call's parts after the name, ``params`` the bound map of
    ``args[2:]`` for ``#invoke``; both should be plain columns (attributes) so
    the many branches refer to them cheaply.
    """
    fns = dict(PARSER_FUNCTIONS)
    fns.update(extra or {})
    if resolved is None:
        resolved = resolve_module_params(params, module_names(args))
    r = F.when(name == "#invoke", invoke(args, params, resolved))
    for fname, fn in fns.items():
        r = r.when(name == fname, fn(args))
    return F.coalesce(r.otherwise(F.lit("")), F.lit(""))


# ---------------------------------------------------------------------------
# Rounds (E07-E09, E12)

def magic_words(opts: Options) -> Column:
    """A map of the magic words a page answers (P02, J03, P03); needs ``_mw``."""
    known = F.create_map(*[x for k, v in opts.known_namespaces for x in (F.lit(k), F.lit(str(v)))])
    ts = F.to_timestamp(F.lit(opts.run_ts))
    entries = [F.lit("!"), F.lit(PIPE_MASK)]
    for w in ("NAMESPACE", "PAGENAME", "FULLPAGENAME", "BASEPAGENAME", "SUBPAGENAME", "ROOTPAGENAME"):
        entries += [F.lit(w), F.col("_mw." + w)]
    entries += [F.lit("NAMESPACENUMBER"), F.coalesce(F.try_element_at(known, F.col("_mw.NAMESPACE")), F.lit("0"))]
    for w, fmt in CLOCK_FORMATS.items():
        entries += [F.lit(w), F.date_format(ts, fmt)]
    return F.create_map(*entries)


def call_title(call: Column) -> Column:
    """Stripped title of an innermost call, ``subst:`` removed."""
    head = F.substring_index(F.substring(call, 3, F.length(call) - 4), "|", 1)
    return F.regexp_replace(strip_ws(head), SUBST_RE, "")


def evaluate_calls(calls: DataFrame, templates: DataFrame, opts: Options,
                   hot_rows: int | None = -1, titles: DataFrame | None = None, keep: tuple = ()) -> DataFrame:
    """Distinct innermost calls -> ``(call, value, frame, serial, arg_errors)``, behind the columns ``keep`` of theirs.

    ``frame`` is the full title of a template that was found, ``serial`` its arguments written as a call has
    them; ``arg_errors`` counts placeholders left at the depth cap of parameters.

    Parser functions and modules are evaluated as columns (E10); template
    calls go through J02 (redirect, one hop) and J01 (definition) joins and
    get their arguments substituted (E03, E06).  ``templates`` is joined on
    title: Spark broadcasts it when its measured size is under the broadcast
    threshold and shuffles both sides otherwise.
    """
    known = [k for k, _ in opts.known_namespaces]
    c = calls.withColumn("_masked", mask_link_pipes("call"))
    c = c.withColumn("_parts", call_parts(F.col("_masked")))
    c = c.withColumn("_title", call_title(F.col("_masked")))
    colon = F.locate(":", "_title")
    is_fn = (colon > 2) & ~F.array_contains(F.array(*[F.lit(k) for k in known]),
                                            ucfirst(F.substring_index("_title", ":", 1)))
    c = c.withColumn("_fn", F.when(is_fn, F.lower(F.substring("_title", 1, colon - 1))))
    c = c.withColumn("_args", F.when(F.col("_fn").isNotNull(), F.concat(
        F.array(strip_ws(F.substring("_title", colon + 1, 1 << 30))), F.transform(
            F.slice("_parts", 2, 1 << 20), lambda x: F.replace(x, F.lit(PIPE_MASK), F.lit("|"))))))
    if titles is not None:
        # N05 option: an existing page turns #ifexist into #if on its (non-empty) title.
        probe = F.when(F.col("_fn") == "#ifexist", ucfirst(strip_ws(F.get(F.col("_args"), 0))))
        c = lookup(c.withColumn("_xt", probe), titles, "_xt",
                   hot_rows=opts.hot_key_rows if hot_rows == -1 else hot_rows, spread_by="call", how="left")
        c = c.withColumn("_fn", F.when(F.col("_exists") & (F.col("_fn") == "#ifexist"), F.lit("#if"))
                         .otherwise(F.col("_fn"))).drop("_xt", "_exists")
    c = c.withColumn("_params", F.when(F.col("_fn") == "#invoke", bind(F.slice("_args", 3, 1 << 20))))
    c = c.withColumn("_resolved", F.when(F.col("_fn") == "#invoke",
                                         resolve_module_params(F.col("_params"), module_names(F.col("_args")))))
    qualified = qualified_template_title("_title", opts.template_prefix, known)
    if opts.normalize_titles:
        qualified = normalize_title(qualified, known)
    # Functions ask for no template: keys of their own keep them apart, nulls would all go to one task.
    c = c.withColumn("qtitle", F.when(F.col("_fn").isNull(), qualified).otherwise(F.concat(F.lit("\0"), F.hex(F.xxhash64("call")))))
    c = c.withColumn("args", F.when(F.col("_fn").isNull(), bind(F.slice("_parts", 2, 1 << 20))))
    # One popular template may have millions of distinct calls: its title is a hot key.
    bodies = templates.select(F.col("title").alias("qtitle"), "body")
    c = lookup(c, bodies, "qtitle", hot_rows=opts.hot_key_rows if hot_rows == -1 else hot_rows,
               spread_by="call", how="left")
    c = c.withColumns({x: F.when(F.col("_fn").isNull(), F.col(x)) for x in ("qtitle", "body")})
    c = c.withColumn("frame", F.when(F.col("body").isNotNull() & (F.col("qtitle") != ""), F.col("qtitle")))
    c = c.withColumn("body", mask_link_pipes(F.coalesce(F.col("body"), F.lit(""))))
    serial = F.array_join(F.transform(F.map_entries(F.col("args")), lambda e: F.concat(
        e["key"], F.lit("="), F.translate(e["value"], "|", PIPE_MASK))), "|")
    for _ in range(opts.max_parameter_depth):
        c = c.withColumn("body", substitute_args(F.col("body"), F.col("args"), 1))
    left = F.when(F.col("body").contains("{{{"), F.regexp_count("body", F.lit(INNER_ARG_RE))).otherwise(0)
    # The dispatch is the largest expression: it enters the plan last, once.
    fval = cached("parser_functions", lambda: parser_function(
        F.col("_fn"), F.col("_args"), F.col("_params"), F.col("_resolved")))
    value = (F.when(F.col("_fn").isNotNull(), fval)
             .when(F.col("qtitle") == "", F.lit(""))
             .otherwise(F.col("body")))
    return c.select(*keep, "call", value.alias("value"), "frame", F.when(F.col("frame").isNotNull(), serial).alias("serial"), left.alias("arg_errors"))


def _checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared checkpoint folder (survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


ERRORS = ["title_errors", "recursion_errors"]


def _enclosing(pieces: Column) -> Column:
    """For each piece of a page's text between calls: the ids of the frames open at its end, outermost first."""
    ids = F.array().cast("array<string>")
    marks = F.transform(pieces, lambda p: F.regexp_extract_all(p, F.lit(FRAME_MARK_RE), 1))  # a close mark gives ''

    def walk(stack, found):
        return F.aggregate(found, stack, lambda s, m: F.when(m != "", F.concat(s, F.array(m))).otherwise(
            F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0)))))

    return F.aggregate(marks, F.struct(ids.alias("open"), F.array().cast("array<array<string>>").alias("all")), lambda acc, m: F.struct(
        walk(acc["open"], m).alias("open"), F.concat(acc["all"], F.array(walk(acc["open"], m))).alias("all")), lambda acc: acc["all"])


def _framed_arguments(active: DataFrame, frames: DataFrame, key: str, opts: Options) -> DataFrame:
    """Module calls without arguments get those of the nearest enclosing call of the module's title; without one they fail.

    Calls by (page, position) are joined to their enclosing calls' table and keep the arguments of the deepest match.
    """
    known = [k for k, _ in opts.known_namespaces]
    bare = F.filter(F.arrays_zip(F.sequence(F.lit(0), F.size("_calls") - 1).alias("pos"), F.col("_calls").alias("call"), F.col("_open").alias("open")),
                    lambda x: x["call"].rlike(BARE_INVOKE_RE))
    opened = active.withColumn("_open", _enclosing(F.split("text", INNER_CALL_RE)))
    asks = opened.select(key, F.explode(bare).alias("x")).select(
        key, "x.pos", F.posexplode("x.open").alias("depth", "id"),
        qualified_template_title(strip_ws(F.regexp_extract("x.call", BARE_INVOKE_RE, 1)), opts.template_prefix, known).alias("frame"))
    # One row per (page, call, enclosing call); an id may enclose the calls of many pages: the frames side is unique.
    found = (asks.join(frames.select("id", "frame", "serial"), ["id", "frame"])
             .groupBy(key, "pos").agg(F.max_by("serial", "depth").alias("serial"))
             .groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("pos", "serial"))).alias("_serial")))
    joined = active.join(found, key, "left")
    filled = F.transform("_calls", lambda c, i: F.when(~c.rlike(BARE_INVOKE_RE), c).otherwise(F.coalesce(
        F.concat(F.substring(c, F.lit(1), F.length(c) - 2), F.lit("|"), F.try_element_at(F.col("_serial"), i), F.lit("}}")), F.lit(NO_FRAME))))
    return joined.withColumn("_calls", filled).drop("_serial")


def _with_core(pages: DataFrame) -> DataFrame:
    """Cuts ``text`` into ``_head``, ``text`` and ``_tail``: no call begins in the head or ends in the tail, whatever values come between.

    A head holds no ``{{`` and doesn't end in a brace, a tail holds no ``}}`` and doesn't begin with one.
    """
    text = F.col("text")
    cut = pages.withColumn("_from", F.locate("{{", text)).withColumn("_upto", F.when(F.col("_from") > 0, F.locate("}}", F.reverse(text))).otherwise(F.lit(0)))
    cut = cut.withColumn("_upto", F.when(F.col("_upto") > 0, F.length(text) - F.col("_upto") + 1).otherwise(F.lit(0)))
    holds = F.col("_upto") > F.col("_from") + 2
    return (cut.withColumn("_head", F.when(holds, F.substring(text, F.lit(1), F.col("_from") - 1)).otherwise(text))
            .withColumn("_tail", F.when(holds, F.substring(text, F.col("_upto") + 1, F.length(text))).otherwise(F.lit("")))
            .withColumn("text", F.when(holds, F.substring(text, F.col("_from"), F.col("_upto") - F.col("_from") + 1)).when(text.isNotNull(), F.lit("")))
            .drop("_from", "_upto"))


def expand(pages: DataFrame, templates: DataFrame | None, opts: Options = Options(),
           key: str = "page_id", titles: DataFrame | None = None, errors: bool = False, unique: bool = False) -> DataFrame:
    """Expand template calls in ``text`` (pages keyed by ``key``).

    ``templates`` is the A01 dictionary; when None it is built from ``pages``
    (Q03 fix).  ``titles`` (a ``title`` column, all pages of the dump) answers
    ``#ifexist`` when ``opts.ifexist_titles`` is set.  With ``errors`` the result has, per page (A03),
    ``title_errors``, the calls without a title, and ``recursion_errors``, the template calls
    at the depth cap and the placeholders at that of parameters, counted as they are met.
    ``unique`` says that no two pages share a key and none lacks it: the result is then partitioned by the key.
    """
    if templates is None:
        templates = template_dictionary(pages)
    # Every round looks templates up: resolve redirects and materialize the dictionary once.
    templates = templates.select("title", "body", "redirect_to")
    if opts.normalize_titles:
        known = [k for k, _ in opts.known_namespaces]
        templates = (templates.withColumn("title", normalize_title("title", known))
                     .withColumn("redirect_to", normalize_title("redirect_to", known)))
    templates = _checkpoint(resolved_bodies(templates).withColumn("body", escape_masks("body")))
    if opts.ifexist_titles and titles is not None:
        # One row per title, written once: every round probes it by key.
        titles = _checkpoint(titles.select(F.col("title").alias("_xt")).distinct()
                             .withColumn("_exists", F.lit(True)))
    else:
        titles = None
    cols = pages.columns
    words = ["NAMESPACE", "PAGENAME", "FULLPAGENAME", "BASEPAGENAME", "SUBPAGENAME", "ROOTPAGENAME"]
    work = (with_title_parts(pages, "title")
            .withColumn("_mw", F.struct(*words)).drop(*words)
            .withColumn("_magic", magic_words(opts))
            .drop("_mw")
            .withColumn("text", escape_masks("text"))
            .withColumn("text", mask_nowiki("text"))
            .withColumns({f"_{e}": F.lit(0).cast("long") for e in ERRORS}))
    row = key if unique else "_row"
    work = _with_core(work if unique else work.withColumn(row, F.monotonically_increasing_id()))
    work = _checkpoint(work.withColumn("_rest", F.length("_head") + F.length("_tail")))
    whole = work.select(*cols, *[c for c in ("_head", "_tail", row) if c not in cols])
    done_parts = []
    cur = work.select(*dict.fromkeys([row, key, "text", "_magic", "_rest", *[f"_{e}" for e in ERRORS]]))
    # Branches are scanned in the rounds after one that held a branching call.  A branching
    # call that first shows up in a round has the calls in its branches expanded once more
    # than needed; templates are pure, so that costs work but never changes the text.
    scan = False
    known: DataFrame | None = None     # every call met so far and its value
    # Depths only grow by a round's values, so calls at the cap need as many rounds; then they give empty text.
    for number in range(8 * opts.max_template_depth):
        if scan:
            cur = with_deferred_branches(cur)
        # Each round's pages are written once; finished ones are set aside.
        calls = F.transform(F.regexp_extract_all("text", F.lit(INNER_CALL_RE), 0), strip_frames)
        cur = _checkpoint(cur.withColumn("_calls", calls))
        done_parts.append(cur.where(F.size("_calls") == 0).drop("_calls"))
        active = cur.where(F.size("_calls") > 0)
        if opts.max_page_chars is not None:
            active = active.withColumn("text", F.when(F.length("text") + F.col("_rest") > opts.max_page_chars, F.raise_error(F.concat(
                F.lit("expansion outgrows max_page_chars on page "), F.col(key).cast("string")))).otherwise(F.col("text")))
        # One small job on the checkpointed round: calls left.  Fewer calls than
        # the hot-key threshold means no key can be hot, so the joins skip that test.
        n_calls, scan, bare = active.agg(
            F.sum(F.size("_calls")), F.max(F.col("text").contains("#") & F.col("text").rlike(BRANCHING_RE)),
            F.max(F.exists("_calls", lambda c: c.rlike(BARE_INVOKE_RE)))).first()
        n_calls, scan = n_calls or 0, bool(scan)
        if n_calls == 0:
            cur = None
            break
        if bare:
            no_frames = "call string, value string, frame string, serial string, arg_errors int, id string"
            active = _checkpoint(_framed_arguments(active, known if known is not None else active.sparkSession.createDataFrame([], no_frames), row, opts))
        hot_rows = opts.hot_key_rows if n_calls >= opts.hot_key_rows else None
        # Magic words are answered in the page's row; everything else by call.
        looked_up = F.array_distinct(F.filter(
            "_calls", lambda c: F.try_element_at(F.col("_magic"), call_title(c)).isNull()))
        # A page without a key gets no values.
        pairs = active.where(F.col(key).isNotNull()).select(row, F.explode(looked_up).alias("call"))
        new = pairs.select("call").distinct()
        if known is not None:
            new = _checkpoint(new.join(known.select("call"), "call", "left_anti"))
        if known is None or new.take(1):
            values = evaluate_calls(new, templates, opts, hot_rows, titles)
            # The id of a frame: enough of it to tell the frames of a page apart.
            values = (values.withColumn("value", own_pipes("value"))
                      .withColumn("id", F.when(F.col("frame").isNotNull() & F.col("value").contains("{{"),
                                               F.substring(F.upper(F.md5("call")), 1, 16))))
            values = _checkpoint(values)
            known = values if known is None else known.unionByName(values)
        given = known.select("call", F.struct("value", "id", F.col("frame").isNotNull().alias("found"), "arg_errors").alias("_v"))
        per_page = (lookup(pairs, given, "call", hot_rows=hot_rows, spread_by=row)
                    .groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct("call", "_v"))).alias("_vals")))
        joined = active.join(per_page, row, "left")
        pieces = F.split("text", INNER_CALL_RE)
        # From here on a call may stand at the cap.
        deep = number + 1 >= opts.max_template_depth
        joined = joined.withColumn("_open", F.transform(_enclosing(pieces), lambda x: F.size(x)) if deep else F.lit(None).cast("array<int>"))

        def answer(c, i):
            v = F.try_element_at(F.col("_vals"), c)
            at_cap = v["found"] & (F.get(F.col("_open"), i) >= opts.max_template_depth - 1) if deep else F.lit(False)
            own = F.when(v["id"].isNull(), v["value"]).otherwise(F.concat(
                F.lit(FRAME_OPEN), v["id"], F.lit(FRAME_ID), v["value"], F.lit(FRAME_CLOSE)))
            magic = F.try_element_at(F.col("_magic"), call_title(c))
            return F.struct(
                F.when(magic.isNotNull(), magic).when(F.coalesce(at_cap, F.lit(False)), F.lit("")).otherwise(F.coalesce(own, F.lit(""))).alias("text"),
                F.when(F.coalesce(at_cap, F.lit(False)), 1).otherwise(F.coalesce(v["arg_errors"], F.lit(0))).alias("errors"))

        joined = joined.withColumn("_vals", F.transform("_calls", answer))
        text = F.array_join(F.transform(pieces, lambda p, i: F.concat(
            p, F.when(i < F.size("_vals"), F.get(F.col("_vals"), i)["text"]).otherwise(F.lit("")))), "")
        cur = (joined.withColumn("text", text)
               .withColumn("_title_errors", F.col("_title_errors") + F.size(F.filter("_calls", lambda c: c.rlike(NO_TITLE_RE))))
               .withColumn("_recursion_errors", F.col("_recursion_errors") + F.aggregate(
                   "_vals", F.lit(0).cast("long"), lambda n, v: n + v["errors"]))
               .drop("_vals", "_calls", "_open"))
    if cur is not None:
        # Rounds are used up: what is left keeps its calls (dropped later by C06).
        done_parts.append(cur.drop("_calls") if "_calls" in cur.columns else cur)
    out = done_parts[0]
    for part in done_parts[1:]:
        out = out.unionByName(part)
    made = out.select(row, F.col("text").alias("_core"), *[f"_{e}" for e in ERRORS])
    out = whole.join(made, row).withColumn("text", F.concat("_head", "_core", "_tail"))
    return out.withColumn("text", unmask("text")).select(*cols, *[F.col(f"_{e}").alias(e) for e in ERRORS if errors])
