"""Wiki and HTML markup rules as column expressions (operators C02-C24).

Nested constructs (``{{..}}``, ``{|..|}``, ``<div>..</div>``, ``[[..]]``) are
removed innermost-first by regex passes, as many as the row's own nesting
asks for, instead of a character-by-character parser, so every rule is a JVM
string function and a page never leaves its row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import NON_WORD, col_, html_escape, strip_ws, sub_with, unescape, url_quote
from quarry.options import Options

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
SELF_CLOSING_TAGS = ("br", "hr", "nobr", "ref", "references", "nowiki")
PLACEHOLDER_TAGS = (("math", "formula"), ("code", "codice"))
URL_PROTOCOLS = (
    "bitcoin:", "ftp://", "ftps://", "geo:", "git://", "gopher://", "http://",
    "https://", "irc://", "ircs://", "magnet:", "mailto:", "mms://", "news:",
    "nntp://", "redis://", "sftp://", "sip:", "sips:", "sms:", "ssh://",
    "svn://", "tel:", "telnet://", "urn:", "worldwind://", "xmpp:", "//",
)
BEHAVIOUR_SWITCHES = (
    "__NOTOC__", "__FORCETOC__", "__TOC__", "__NEWSECTIONLINK__",
    "__NONEWSECTIONLINK__", "__NOGALLERY__", "__HIDDENCAT__", "__NOCONTENTCONVERT__",
    "__NOCC__", "__NOTITLECONVERT__", "__NOTC__", "__START__", "__END__",
    "__INDEX__", "__NOINDEX__", "__STATICREDIRECT__", "__DISAMBIG__",
)
# ---------------------------------------------------------------------------

COMMENT_RE = r"(?s)<!--.*?-->"
SELF_CLOSING_RE = r"(?is)<\s*(?:" + "|".join(SELF_CLOSING_TAGS) + r")\b[^>]*/\s*>"
# The same alternatives with the shared underscores factored out (tested once per position).
SWITCHES_RE = "__(?:" + "|".join(sorted({w.strip("_") for w in BEHAVIOUR_SWITCHES}, key=len, reverse=True)) + ")__"
# Innermost {{...}}: no other {{ or }} inside (single braces allowed).
INNER_BRACES_RE = r"\{\{[^{}]*+(?:\{(?!\{)[^{}]*+|\}(?!\})[^{}]*+)*+\}\}"
# Innermost {|...|}: no other {| or |} inside.
INNER_TABLE_RE = r"\{\|[^{|]*+(?:(?:\{(?!\|)|\|(?!\}))[^{|]*+)*+\|\}"
# Innermost [[...]]: no other [[ or ]] inside.
INNER_LINK_RE = r"\[\[[^\[\]]*+(?:(?:\[(?!\[)|\](?!\]))[^\[\]]*+)*+\]\]"
# What counts as a URL, an anchor, an external link and an image.
_URL_CLASS = r'[^\]\[<>"\x00-\x20\x7F\s]'
_ANCHOR_CLASS = r"[^\]\[\x00-\x08\x0a-\x1F]"
_PROTO = "(?:" + "|".join(re.escape(p) for p in URL_PROTOCOLS) + ")"
EXT_LINK_RE = (r"(?iU)\[(" + _PROTO + _URL_CLASS + r"+)\s*((?:" + _ANCHOR_CLASS + r"++|\[\[" + _ANCHOR_CLASS
               + r"+\]\])*+)\]")
_IMAGE = (r"(?:http://|https://)" + _URL_CLASS + r"+/[A-Za-z0-9_.,~%\-+&;#*?!=()@\x80-\xFF]+\.(?:gif|png|jpg|jpeg)")
EXT_IMAGE_LINK_RE = r"(?iU)\[(" + _PROTO + _URL_CLASS + r"+)\s*(" + _IMAGE + r")\]"
IMAGE_LABEL_RE = r"(?iU)^" + _IMAGE + "$"
SYNTAXHIGHLIGHT_RE = r"(?s)<syntaxhighlight .*?>(.*?)</syntaxhighlight>"


def steps_apply(df, name: str, steps):
    """Apply column rules one ``withColumn`` at a time.

    Catalyst expression trees are trees, not DAGs: nesting rules that use
    their input twice would copy it at every level.  One projection per rule
    keeps each expression small; CollapseProject does not merge projections
    that would repeat an expensive expression.
    """
    for fn in steps:
        df = df.withColumn(name, fn(F.col(name)) if fn is not unescape else unescape(name))
    return df


def guarded(c: Column, needle: str, pattern: str, repl: str) -> Column:
    """``regexp_replace`` only on rows holding the literal every match starts with.

    ``contains`` reads Spark's UTF-8 bytes; a regex needs a Java string copy
    of the whole text, so skipping it where it cannot match saves both.  It
    reads its input three times: use it as one step, not nested.
    """
    return F.when(c.contains(needle), F.regexp_replace(c, pattern, repl)).otherwise(c)


def nesting(c: Column, opens: str, closes: str) -> Column:
    """How deep the marks are nested at most (an upper bound where some have no partner)."""
    found = F.regexp_extract_all(c, F.lit(f"({opens})|(?:{closes})"), 1)
    state = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(s, opened):
        now = F.when(opened != "", s["now"] + 1).otherwise(F.greatest(s["now"] - 1, F.lit(0)))
        return F.struct(now.alias("now"), F.greatest(s["most"], now).alias("most"))

    # One scan of the text for both.
    return F.get(F.transform(F.array(found), lambda marks: F.least(
        F.aggregate(marks, state, step, lambda s: s["most"]), F.size(F.filter(marks, lambda m: m == "")))), 0)


def innermost_first(c: Column, opens: str, closes: str, step) -> Column:
    """``step`` (one pass over the innermost pairs) as often as the row's own nesting asks for.

    The chains put one plain pass (a projection of its own) before the rules that use this: most
    pairs are not nested, so few rows are left to unfold.
    """
    return F.aggregate(F.array_repeat(F.lit(0), nesting(c, opens, closes)), c, lambda text, _: step(text))


# Around the number of a run of plain text that is set aside.
ASIDE_OPEN, ASIDE_CLOSE = "\uE00B", "\uE00C"


def with_runs_aside(c: Column, specials: str, least: int, rule) -> Column:
    """``rule`` on ``c`` with its long runs of plain text set aside, so many passes don't read them again and again.

    A run has more than ``least`` characters, none of ``specials`` (as in a character class), and no space at its ends;
    a short mark stands for it that no space or special character can be cut from.  The rule may drop runs but must not look into them.
    """
    run = rf"(?U)(?<![^{specials}\s])[^{specials}\s][^{specials}]{{{least},}}[^{specials}\s]"
    scan = F.array(F.struct(F.split(c, run).alias("pieces"), F.regexp_extract_all(c, F.lit(run), F.lit(0)).alias("runs")))
    mark = lambda i: F.concat(F.lit(ASIDE_OPEN), i.cast("string"), F.lit(ASIDE_CLOSE))

    def aside(x):
        short = F.array_join(F.transform(x["pieces"], lambda p, i: F.concat(p, F.when(i < F.size(x["runs"]), mark(i)).otherwise(F.lit("")))), "")
        ruled = F.get(F.transform(F.array(short), lambda s: rule(s)), 0)
        pieces = F.split(ruled, ASIDE_OPEN)
        return F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.concat(
            F.get(x["runs"], F.substring_index(p, ASIDE_CLOSE, 1).try_cast("int")), F.substring(p, F.locate(ASIDE_CLOSE, p) + 1, F.length(p))))), "")

    return F.when(c.contains(ASIDE_OPEN) | c.contains(ASIDE_CLOSE), rule(c)).otherwise(F.get(F.transform(scan, aside), 0))


# Around the number of a line whose plain rest is set aside.
LINE_OPEN, LINE_CLOSE = "\uE00D", "\uE00E"
# A first word, then text that no rule of the chains can begin, end or change in; see also :func:`_plain_line`.
_MARKS = r"\[\]{}|<>&\"_:/\t"
PLAIN_LINE_RE = rf"(?U)^[^{_MARKS} ]+ [\p{{L}}\p{{N}}][^{_MARKS}]*[^{_MARKS}\s]\z"
#: Bytes from which a line is worth a mark; longer than any name that a rule looks for.
PLAIN_LINE_BYTES = 96


def _plain_line(line: Column) -> Column:
    """Whether the rules leave a whole line as it is, but for dropping it with what encloses it."""
    plain = (F.octet_length(line) >= PLAIN_LINE_BYTES) & ~line.contains("''") & line.rlike(PLAIN_LINE_RE)
    for tidied in ("  ", "....", ",,", ",."):
        plain = plain & ~line.contains(tidied)
    return plain


def _short_lines(text: Column, lines: Column, html: bool) -> Column:
    """``text`` with each plain line of ``lines`` as its first word and a mark with its number."""
    short = F.array_join(F.transform(lines, lambda x, i: F.when(_plain_line(x), F.concat(
        F.substring_index(x, " ", 1), F.lit(" " + LINE_OPEN), i.cast("string"), F.lit(LINE_CLOSE))).otherwise(x)), "\n")
    if not html:
        return short
    # A link's target is escaped in HTML, so pages with links over several lines (or within links) stay whole.
    one_line = r"\[\[[^\[\]\n]*+\]\]"
    return F.get(F.transform(F.array(short), lambda x: F.when(F.regexp_replace(x, one_line, "").contains("[["), text).otherwise(x)), 0)


def _whole_lines(short: Column, lines: Column) -> Column:
    """``short`` with the rests of the lines in the place of their marks."""
    def rest(line):
        return F.substring(line, F.locate(" ", line) + 1, F.length(line))

    pieces = F.transform(F.split(short, LINE_OPEN), lambda p, i: F.when(i == 0, p).otherwise(F.concat(
        rest(F.get(lines, F.substring_index(p, LINE_CLOSE, 1).cast("int"))), F.substring(p, F.locate(LINE_CLOSE, p) + 1, F.length(p)))))
    return F.array_join(pieces, "")


def steps_on_marked_lines(df, name: str, steps, html: bool = False):
    """:func:`steps_apply` for the chains from links to spacing, with long plain lines set aside.

    Most of a page is prose that every rule would read, decode and write again.  A line without marks can only be
    dropped with what encloses it, so its first word and a mark go through the rules in its place.
    """
    c, lines = F.col(name), F.col("_lines")
    df = df.withColumn("_lines", F.when(~(c.contains(LINE_OPEN) | c.contains(LINE_CLOSE)), F.split(c, "\n")))
    df = df.withColumn(name, F.when(lines.isNull(), c).otherwise(_short_lines(c, lines, html)))
    df = steps_apply(df, name, steps)
    return df.withColumn(name, F.when(lines.isNotNull() & c.contains(LINE_OPEN), _whole_lines(c, lines)).otherwise(c)).drop("_lines")


# C02
def drop_comments(c) -> Column:
    return F.regexp_replace(col_(c), COMMENT_RE, "")


# C03
def drop_self_closing(c) -> Column:
    return F.regexp_replace(col_(c), SELF_CLOSING_RE, "")


def ignored_tags_pattern(tags) -> str:
    alt = "|".join(re.escape(t) for t in tags)
    return r"(?is)<(?:" + alt + r")\b.*?>|</\s*(?:" + alt + r")>"


# C04
def unwrap_ignored_tags(c, tags) -> Column:
    """Drop open and close tags of ``tags``, keeping what they enclose."""
    if not tags:
        return col_(c)
    return F.regexp_replace(col_(c), ignored_tags_pattern(tags), "")


def discard_pattern(tags) -> str:
    alt = "|".join(re.escape(t) for t in tags)
    # An element of one of the tags whose content holds no open/close of the same tag.
    return (r"(?i)<\s*(" + alt + r")\b[^>/]*>[^<]*+(?:<(?!\s*\1\b[^>/]*>|\s*/\s*\1>)[^<]*+)*+<\s*/\s*\1>")


# C05
def drop_elements(c, tags) -> Column:
    """Remove elements with their content, nested ones innermost first, at any depth."""
    c = col_(c)
    if not tags:
        return c
    alt = "|".join(re.escape(t) for t in tags)
    opens, closes = rf"(?i)<\s*(?:{alt})\b[^>/]*>", rf"(?i)<\s*/\s*(?:{alt})>"
    return F.when(c.contains("<") & c.rlike(closes), innermost_first(
        c, opens, closes, lambda t: F.regexp_replace(t, discard_pattern(tags), ""))).otherwise(c)


def drop_inner_elements(c, tags) -> Column:
    """The plain pass before :func:`drop_elements`."""
    c = col_(c)
    return F.when(c.contains("<"), F.regexp_replace(c, discard_pattern(tags), "")).otherwise(c) if tags else c


# C06
def drop_templates(c) -> Column:
    c = col_(c)
    return F.when(c.contains("{{") & c.contains("}}"), innermost_first(
        c, r"\{\{", r"\}\}", lambda t: F.regexp_replace(t, INNER_BRACES_RE, ""))).otherwise(c)


# C07
def drop_tables(c) -> Column:
    c = col_(c)
    return F.when(c.contains("{|") & c.contains("|}"), innermost_first(
        c, r"\{\|", r"\|\}", lambda t: F.regexp_replace(t, INNER_TABLE_RE, ""))).otherwise(c)


def _plain(needle: str, pattern: str):
    """The plain pass before :func:`drop_templates` and :func:`drop_tables`."""
    return lambda c: F.when(col_(c).contains(needle), F.regexp_replace(col_(c), pattern, "")).otherwise(col_(c))


# C08-C10
def quote_steps(to_html: bool = False) -> list:
    """``quotes`` as separate steps, each regex skipped on rows without its literal start."""
    if to_html:
        rules = [("'''''", r"'''''(.*?)'''''", "<b>$1</b>"), ("'''", r"'''(.*?)'''", "<b>$1</b>"),
                 ("''", r"''(.*?)''", "<i>$1</i>")]
    else:
        rules = [("'''''", r"'''''(.*?)'''''", "$1"), ("'''", r"'''(.*?)'''", "$1"),
                 ("''\"", r"''\"([^\"]*?)\"''", "\"$1\""), ("''", r"''(.*?)''", "\"$1\""),
                 ('""', r"\"\"([^\"]*?)\"\"", "\"$1\"")]
    steps = [lambda c, n=n, p=p, r=r: guarded(c, n, p, r) for n, p, r in rules]
    steps.append(lambda c: F.replace(F.replace(c, F.lit("'''"), F.lit("")), F.lit("''"), F.lit('"')))
    return steps


def link_parts(m: Column):
    """Title, label and whether the namespace is accepted, for one ``[[...]]`` match."""
    inner = F.substring(m, 3, F.length(m) - 4)
    piped = inner.contains("|")
    title = F.when(piped, F.regexp_replace(F.substring_index(inner, "|", 1), r"(?U)\s+$", "")).otherwise(inner)
    label = F.when(piped, strip_ws(F.substring_index(inner, "|", -1))).otherwise(inner)
    return inner, title, label


def namespace_ok(title: Column, accepted) -> Column:
    """False when the link title names a namespace outside ``accepted``."""
    acc = F.array(*[F.lit(a) for a in accepted]) if accepted else F.array().cast("array<string>")
    colon = F.locate(":", title)
    prefix = F.substring_index(title, ":", 1)
    colon2 = F.locate(":", title, 2)
    lead = F.substring(title, 2, colon2 - 2)
    bad1 = (colon > 1) & ~F.array_contains(acc, prefix)
    bad2 = (colon == 1) & (colon2 > 2) & ~F.array_contains(acc, lead)
    return ~(bad1 | bad2)


# C11
def internal_links(c, opts: Options = Options()) -> Column:
    """``[[title|...|label]]`` -> label; a foreign namespace gives nothing (the trail stays).

    Innermost links first, at any depth.
    """
    c = col_(c)
    each = lambda step: F.when(c.contains("[[") & c.contains("]]"), innermost_first(c, r"\[\[", r"\]\]", step)).otherwise(c)
    if not opts.links_kept:
        unfold = lambda t: innermost_first(t, r"\[\[", r"\]\]", lambda u: _links_to_labels(u, opts.accepted_namespaces))
        # A run is longer than any namespace it could be taken for.
        least = max([64, *map(len, opts.accepted_namespaces)])
        return F.when(c.contains("[[") & c.contains("]]"), F.get(F.transform(F.array(c), lambda t: with_runs_aside(
            t, r"\[\]|:", least, unfold)), 0)).otherwise(c)

    def render(m):
        _, title, label = link_parts(m)
        shown = (F.concat(F.lit('<a href="'), url_quote(title), F.lit('">'), label, F.lit("</a>"))
                 if opts.links_kept else label)
        return F.when(namespace_ok(title, opts.accepted_namespaces), shown).otherwise(F.lit(""))

    return each(lambda t: sub_with(t, INNER_LINK_RE, render))


def _links_to_labels(c: Column, accepted) -> Column:
    """Plain-text form of one innermost-link round as four regex passes (no per-match arrays).

    A title whose prefix before ``:`` (or after a leading ``:``) is not an
    accepted namespace drops the link; otherwise the label after the last
    ``|`` (trimmed), or the whole content without a pipe.
    """
    ok = "(?!(?:" + "|".join(re.escape(a) for a in accepted) + "):)" if accepted else ""
    r = F.regexp_replace(c, r"\[\[" + ok + r"[^\[\]|:]+:[^\[\]]*\]\]", "")
    r = F.regexp_replace(r, r"\[\[:" + ok + r"[^\[\]|:]+:[^\[\]]*\]\]", "")
    r = F.regexp_replace(r, r"(?U)\[\[[^\[\]|]*\|(?:[^\[\]]*\|)?\s*([^\[\]|]*?)\s*\]\]", "$1")
    return F.regexp_replace(r, r"\[\[([^\[\]|]*)\]\]", "$1")


# C12, C13
def external_links(c, opts: Options = Options()) -> Column:
    """``[url label]`` -> label; no label -> nothing; image label -> nothing (``<img>`` with links)."""
    c = col_(c)
    if not opts.links_kept:
        r = F.regexp_replace(c, EXT_IMAGE_LINK_RE, "")
        r = F.regexp_replace(r, EXT_LINK_RE, "$2")
        return F.when(c.contains("["), r).otherwise(c)

    def render(m):
        url = F.regexp_extract(m, EXT_LINK_RE, 1)
        label = F.regexp_extract(m, EXT_LINK_RE, 2)
        label = F.when(label.rlike(IMAGE_LABEL_RE),
                       F.concat(F.lit('<img src="'), label, F.lit('" alt="">'))).otherwise(label)
        return F.concat(F.lit('<a href="'), url_quote(url), F.lit('">'), label, F.lit("</a>"))

    return F.when(c.contains("["), sub_with(c, EXT_LINK_RE, render)).otherwise(c)


# C14
def drop_switches(c) -> Column:
    c = col_(c)
    return F.when(c.contains("__"), F.regexp_replace(c, SWITCHES_RE, "")).otherwise(c)


# C15
def unwrap_syntaxhighlight(c) -> Column:
    """The content stays as it is: it is escaped here, so tag rules pass it by and the last decode gives it back."""
    c = col_(c)

    def content(m):
        t = F.regexp_extract(m, SYNTAXHIGHLIGHT_RE, 1)
        for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            t = F.replace(t, F.lit(char), F.lit(name))
        return t

    return F.when(c.contains("<syntaxhighlight "), sub_with(c, SYNTAXHIGHLIGHT_RE, content)).otherwise(c)


# C17
def placeholder(c, tag: str, word: str) -> Column:
    """``<math>..</math>`` -> ``formula_N``, ``<code>..</code>`` -> ``codice_N`` (N counts per page)."""
    r = col_(c)
    pat = r"(?is)<\s*" + tag + r"(\s*| [^>]+?)>.*?<\s*/\s*" + tag + r"\s*>"
    pieces = F.split(r, pat)
    joined = F.array_join(
        F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(
            F.concat(F.lit(word + "_"), i.cast("string"), p))), "")
    return F.when(r.contains("<"), joined).otherwise(r)


# C18-C22
# A newline, one non-word character, then non-word characters up to the first
# newline: exactly the match of the lazy rule "newline, non-word+?, newline".
PUNCT_LINE_RE = r"\n" + NON_WORD + r"[^\p{L}\p{N}_\n]*+\n"


def tidy_steps() -> list:
    """``tidy`` as separate steps; each regex runs only where its literal start occurs."""
    return [
        lambda c: F.replace(F.replace(F.replace(c, F.lit("<<"), F.lit("«")), F.lit(">>"), F.lit("»")), F.lit("\t"), F.lit(" ")),
        lambda c: guarded(c, "  ", " {2,}", " "),
        lambda c: guarded(c, "....", r"\.{4,}", "..."),
        lambda c: guarded(c, " ,:.)]»", r" (,:\.\)\]»)", "$1"),
        lambda c: guarded(c, "[(« ", r"(\[\(«) ", "$1"),
        lambda c: F.regexp_replace(c, PUNCT_LINE_RE, "\n"),
        lambda c: F.replace(F.replace(c, F.lit(",,"), F.lit(",")), F.lit(",."), F.lit(".")),
    ]


# C23
def table_residue(c) -> Column:
    # The two style cells that are dropped.
    r = F.regexp_replace(col_(c), r'!(?:\s)?style="[a-z]+:(?:\d+)%;"', "")
    r = F.regexp_replace(r, r'!(?:\s)?style="[a-z]+:(?:\d+)%;[a-z]+:(?:#)?(?:[0-9a-z]+)?"', "")
    return F.replace(F.replace(r, F.lit("|-"), F.lit("")), F.lit("|"), F.lit(""))


def wiki2text_steps(opts: Options = Options()) -> list:
    """Markup to text: residual calls, tables, quotes, links, switches."""
    steps = []
    if not opts.keep_tables:
        steps += [_plain("{{", INNER_BRACES_RE), drop_templates, _plain("{|", INNER_TABLE_RE), drop_tables]
    steps += quote_steps(opts.to_html)
    if not opts.links_kept:
        steps.append(lambda c: F.when(col_(c).contains("[["), _links_to_labels(col_(c), opts.accepted_namespaces)).otherwise(col_(c)))
    steps.append(lambda c: internal_links(c, opts))
    steps.append(lambda c: external_links(c, opts))
    steps.append(drop_switches)
    # Decoding of the dump's own escapes happened once at read time.
    steps.append(unwrap_syntaxhighlight)
    return steps


def clean_steps(opts: Options = Options()) -> list:
    """Tags, elements, entities and spacing."""
    steps = [drop_comments, drop_self_closing, lambda c: unwrap_ignored_tags(c, opts.ignore_tags_all)]
    steps += [lambda c: drop_inner_elements(c, opts.discard_elements), lambda c: drop_elements(c, opts.discard_elements)]
    if not opts.to_html:
        steps.append(unescape)
    steps += [lambda c, t=t, w=w: placeholder(c, t, w) for t, w in PLACEHOLDER_TAGS]
    steps += tidy_steps()
    if opts.keep_tables:
        steps.append(table_residue)
    if opts.to_html:
        steps.append(html_escape)
    return steps


def wiki2text(df, name: str = "text", opts: Options = Options()):
    return steps_on_marked_lines(df, name, wiki2text_steps(opts), opts.links_kept)


def clean(df, name: str = "text", opts: Options = Options()):
    return steps_apply(df, name, clean_steps(opts))


def to_text(df, name: str = "text", opts: Options = Options()):
    """The whole cleaning chain, in the reference's order."""
    return steps_on_marked_lines(df, name, wiki2text_steps(opts) + clean_steps(opts), opts.links_kept)
