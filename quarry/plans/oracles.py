"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written in DuckDB's dialect over the driver's tables.  DuckDB's RE2 has no
look-around and no back-references, so rules are re-expressed with plain
patterns, one per header level, and marks; long chains are CTEs, one step
per rule.
"""

from __future__ import annotations

from quarry.functions.markup import BEHAVIOUR_SWITCHES, URL_PROTOCOLS
from quarry.functions.text import ENTITY_CHARS, ROMAN_HUNDREDS, ROMAN_TENS, ROMAN_THOUSANDS, ROMAN_UNITS
from quarry.operators.comments import LABELS
from quarry.sources.fixtures import DEP_CYCLE, ENT_CYCLE, POS_CYCLE
from quarry.options import DEFAULT_ACCEPTED_NAMESPACES, DEFAULT_DISCARD_ELEMENTS, DEFAULT_IGNORED_TAGS
from quarry.sources.fixtures import COMMENTS_SQL, NESTED_PAGES_SQL, WIKI_PAGES_SQL

URL_BASE = "https://wiki.example.org/wiki"
NL = "chr(10)"
WORD = r"[\p{L}\p{N}_]"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(x: str, pat: str, repl: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {lit(pat)}, {lit(repl)}, '{flags}')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def ucfirst(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || substr({x}, 2))"


def lcfirst(x: str) -> str:
    return f"(lower(substr({x}, 1, 1)) || substr({x}, 2))"


def chain(base: str, steps, col: str = "text") -> str:
    """CTEs ``s0 .. sN``: ``s0`` is ``base``, each next one rewrites ``col`` with a step."""
    ctes = [f"s0 AS ({base})"]
    for i, fn in enumerate(steps, 1):
        ctes.append(f"s{i} AS (SELECT * REPLACE ({fn(col)} AS {col}) FROM s{i - 1})")
    return ctes, f"s{len(steps)}"


def with_ctes(ctes, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ---------------------------------------------------------------- rules

def entity_map() -> str:
    return "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in ENTITY_CHARS.items()) + "}"


def unescape(x: str) -> str:
    q = "('&' || p)"
    name = f"regexp_extract({q}, '^&({WORD}+);', 1)"
    dec = f"regexp_extract({q}, '^&#([0-9]+);', 1)"
    hexa = f"regexp_extract({q}, '^&#x([0-9A-Fa-f]+);', 1)"
    dec_n = f"TRY_CAST({dec} AS BIGINT)"
    hex_n = f"TRY_CAST(('0x' || {hexa}) AS BIGINT)"
    ok = lambda n: f"({n} BETWEEN 1 AND 1114111 AND NOT ({n} BETWEEN 55296 AND 57343))"
    fix = (f"CASE WHEN {name} <> '' AND {entity_map()}[{name}] IS NOT NULL "
           f"THEN {entity_map()}[{name}] || substr({q}, length({name}) + 3) "
           f"WHEN {dec} <> '' AND {ok(dec_n)} THEN chr(CAST({dec_n} AS INTEGER)) || substr({q}, length({dec}) + 4) "
           f"WHEN {hexa} <> '' AND length({hexa}) <= 8 AND {ok(hex_n)} "
           f"THEN chr(CAST({hex_n} AS INTEGER)) || substr({q}, length({hexa}) + 5) "
           f"ELSE {q} END")
    return (f"CASE WHEN strpos({x}, '&') = 0 THEN {x} ELSE array_to_string(list_transform("
            f"string_split({x}, '&'), lambda p, i: CASE WHEN i = 1 THEN p ELSE {fix} END), '') END")


def drop_comments(x):
    return rx(x, r"(?s)<!--.*?-->")


# Self-closing tags.
def drop_self_closing(x):
    return rx(x, r"(?is)<\s*(?:br|hr|nobr|ref|references|nowiki)\b[^>]*/\s*>")


def unwrap_ignored(x, tags=DEFAULT_IGNORED_TAGS + ("a",)):
    alt = "|".join(tags)
    return rx(x, r"(?is)<(?:" + alt + r")\b.*?>|</\s*(?:" + alt + r")>")


def drop_element(tag):
    return lambda x: rx(x, r"(?is)<\s*" + tag + r"\b[^>/]*>.*?<\s*/\s*" + tag + r">")


def drop_templates(x):
    return rx(x, r"\{\{[^{}]*\}\}")


def drop_tables(x):
    return rx(x, r"(?s)\{\|(?:[^{|]|\{[^|]|\|[^}])*?\|\}")


def quotes(x):
    r = rx(x, r"'''''(.*?)'''''", r"\1")
    r = rx(r, r"'''(.*?)'''", r"\1")
    r = rx(r, r"''\"([^\"]*?)\"''", r'"\1"')
    r = rx(r, r"''(.*?)''", r'"\1"')
    r = rx(r, r'""([^"]*?)""', r'"\1"')
    return f"replace(replace({r}, '''''''', ''), '''''', '\"')"


def internal_links(x, accepted=DEFAULT_ACCEPTED_NAMESPACES):
    acc = "|".join(accepted)
    r = rx(x, r"\[\[(:?)(" + acc + r"):", "[[\\1\x01\\2:")
    r = rx(r, r"\[\[[^\[\]|:\x01]+:[^\[\]]*\]\]")
    r = rx(r, r"\[\[:[^\[\]|:\x01]+:[^\[\]]*\]\]")
    r = rx(r, r"\[\[[^\[\]|]*\|(?:[^\[\]]*\|)?\s*([^\[\]|]*?)\s*\]\]", r"\1")
    r = rx(r, r"\[\[([^\[\]|]*)\]\]", r"\1")
    return f"replace({r}, chr(1), '')"


# Characters of URLs, link labels and image names.
_URL = r'[^\]\[<>"\x00-\x20\x7F\s]'
_ANCHOR = r"[^\]\[\x00-\x08\x0a-\x1F]"
_PROTO = "(?:" + "|".join(p.replace("/", "/") for p in URL_PROTOCOLS) + ")"
EXT_LINK = r"(?i)\[(" + _PROTO + _URL + r"+)\s*((?:" + _ANCHOR + r"|\[\[" + _ANCHOR + r"+\]\])*?)\]"
_IMAGE = r"(?:http://|https://)" + _URL + r"+/[A-Za-z0-9_.,~%\-+&;#*?!=()@\x{80}-\x{FF}]+\.(?:gif|png|jpg|jpeg)"


def external_links(x):
    r = rx(x, r"(?i)\[(" + _PROTO + _URL + r"+)\s*(" + _IMAGE + r")\]")
    return rx(r, EXT_LINK, r"\2")


# HTML mode (C08-C13 with --html): bold and italic tags, links kept as anchors.
def quotes_html(x):
    r = rx(x, r"'''''(.*?)'''''", r"<b>\1</b>")
    r = rx(r, r"'''(.*?)'''", r"<b>\1</b>")
    r = rx(r, r"''(.*?)''", r"<i>\1</i>")
    return f"replace(replace({r}, '''''''', ''), '''''', '\"')"


# Innermost [[..]]: single brackets allowed inside, doubled ones not.
LINK = r"\[\[(?:[^\[\]]|\[[^\[\]]|\][^\[\]])*\]\]"


def url_quote(x):
    return f"replace(url_encode({x}), '%2F', '/')"


def splice(x, pat, render):
    """Every match of ``pat`` in ``x`` replaced by ``render(match)`` (pieces and matches zipped)."""
    m = f"regexp_extract_all({x}, {lit(pat)})[i]"
    return (f"array_to_string(list_transform(string_split_regex({x}, {lit(pat)}), lambda p, i: p || "
            f"CASE WHEN i <= len(regexp_extract_all({x}, {lit(pat)})) THEN {render(m)} ELSE '' END), '')")


def namespace_ok(t, accepted=DEFAULT_ACCEPTED_NAMESPACES):
    acc = "(" + ", ".join(lit(a) for a in accepted) + ")"
    colon2 = f"(CASE WHEN strpos(substr({t}, 2), ':') > 0 THEN strpos(substr({t}, 2), ':') + 1 ELSE 0 END)"
    bad1 = f"(strpos({t}, ':') > 1 AND split_part({t}, ':', 1) NOT IN {acc})"
    bad2 = f"(strpos({t}, ':') = 1 AND {colon2} > 2 AND substr({t}, 2, {colon2} - 2) NOT IN {acc})"
    return f"NOT ({bad1} OR {bad2})"


def internal_links_html(x):
    def render(m):
        inner = f"substr({m}, 3, length({m}) - 4)"
        piped = f"strpos({inner}, '|') > 0"
        title = f"(CASE WHEN {piped} THEN {rx(f'split_part({inner}, {lit(chr(124))}, 1)', r'\s+$')} ELSE {inner} END)"
        last = f"regexp_extract({inner}, {lit(r'[^|]*$')})"
        label = f"(CASE WHEN {piped} THEN {strip(last)} ELSE {inner} END)"
        return (f"CASE WHEN {namespace_ok(title)} THEN '<a href=\"' || {url_quote(title)} || '\">' || {label} "
                f"|| '</a>' ELSE '' END")
    return f"CASE WHEN strpos({x}, '[[') > 0 THEN {splice(x, LINK, render)} ELSE {x} END"


def external_links_html(x):
    def render(m):
        url = f"regexp_extract({m}, {lit(EXT_LINK)}, 1)"
        label = f"regexp_extract({m}, {lit(EXT_LINK)}, 2)"
        shown = (f"CASE WHEN regexp_full_match({label}, {lit('(?i)' + _IMAGE)}) "
                 f"THEN '<img src=\"' || {label} || '\" alt=\"\">' ELSE {label} END")
        return f"'<a href=\"' || {url_quote(url)} || '\">' || {shown} || '</a>'"
    return f"CASE WHEN strpos({x}, '[') > 0 THEN {splice(x, EXT_LINK, render)} ELSE {x} END"


def drop_switches(x):
    return rx(x, "|".join(BEHAVIOUR_SWITCHES))


def unwrap_syntaxhighlight(x):
    return rx(x, r"(?s)<syntaxhighlight .*?>(.*?)</syntaxhighlight>", r"\1")


def placeholder(tag, word):
    pat = r"(?is)<\s*" + tag + r"(\s*| [^>]+?)>.*?<\s*/\s*" + tag + r"\s*>"
    return lambda x: (f"array_to_string(list_transform(string_split_regex({x}, {lit(pat)}), lambda p, i: "
                      f"CASE WHEN i = 1 THEN p ELSE '{word}_' || CAST(i - 1 AS VARCHAR) || p END), '')")


def tidy(x):
    r = f"replace(replace({x}, '<<', '«'), '>>', '»')"
    r = f"replace({r}, chr(9), ' ')"
    r = rx(r, " {2,}", " ")
    r = rx(r, r"\.{4,}", "...")
    r = rx(r, r" (,:\.\)\]»)", r"\1")
    r = rx(r, r"(\[\(«) ", r"\1")
    r = f"regexp_replace({r}, '\\n[^\\p{{L}}\\p{{N}}_]+?\\n', chr(10), 'g')"
    return f"replace(replace({r}, ',,', ','), ',.', '.')"


def wiki2text_steps():
    return ([drop_templates] * 3 + [drop_tables] * 3
            + [quotes] + [internal_links] * 2 + [external_links, drop_switches, unwrap_syntaxhighlight])


def wiki2html_steps():
    return ([drop_templates] * 3 + [drop_tables] * 3
            + [quotes_html] + [internal_links_html] * 3 + [external_links_html, drop_switches, unwrap_syntaxhighlight])


def clean_steps():
    return ([drop_comments, drop_self_closing, unwrap_ignored]
            + [drop_element(t) for t in DEFAULT_DISCARD_ELEMENTS]
            + [unescape, placeholder("math", "formula"), placeholder("code", "codice"), tidy])


# ---------------------------------------------------------------- bases

def v1() -> str:
    return WIKI_PAGES_SQL


def v1_decoded() -> str:
    return f"SELECT * REPLACE ({unescape('text')} AS text) FROM ({WIKI_PAGES_SQL})"


def kept_decoded() -> str:
    return f"SELECT * FROM ({v1_decoded()}) WHERE ns = 0 AND redirect_title IS NULL"


# ---------------------------------------------------------------- templates

REDIRECT = r"(?i)^#REDIRECT.*?\[\[([^\]]*)\]\]"


def definitions_sql() -> str:
    t = rx("text", r"(?s)<!--.*?-->")
    t = rx(t, r"(?s)<noinclude>.*?</noinclude>")
    t4 = "t4"
    return f"""SELECT page_id, ns, title, redirect_to,
       CASE WHEN redirect_to IS NULL THEN
         CASE WHEN array_to_string(regexp_extract_all({t4}, '(?s)<onlyinclude>(.*?)</onlyinclude>', 1), '') <> ''
              THEN array_to_string(regexp_extract_all({t4}, '(?s)<onlyinclude>(.*?)</onlyinclude>', 1), '')
              ELSE {rx(t4, '<includeonly>|</includeonly>')} END END AS body
FROM (SELECT *, replace({rx(t, r'(?s)<noinclude\s*>.*$', '', '')}, '<noinclude/>', '') AS t4,
             CASE WHEN regexp_matches(text, {lit(REDIRECT)}) THEN regexp_extract(text, {lit(REDIRECT)}, 1) END AS redirect_to
      FROM ({v1_decoded()}) WHERE ns IN (10, 828))"""


def defs_filtered() -> str:
    return f"SELECT * FROM ({definitions_sql()}) WHERE redirect_to IS NOT NULL OR length(body) > 0"


def dictionary_sql() -> str:
    return f"""WITH d AS ({defs_filtered()}),
b AS (SELECT title, arg_max(ns, page_id) AS ns, max(page_id) AS page_id, arg_max(body, page_id) AS body,
             count(*) AS definitions FROM d WHERE redirect_to IS NULL GROUP BY title),
r AS (SELECT title, arg_max(ns, page_id) AS ns, max(page_id) AS page_id, arg_max(redirect_to, page_id) AS redirect_to
      FROM d WHERE redirect_to IS NOT NULL GROUP BY title)
SELECT coalesce(b.title, r.title) AS title, coalesce(r.ns, b.ns) AS ns,
       CASE WHEN r.page_id IS NULL THEN b.page_id WHEN b.page_id IS NULL THEN r.page_id
            ELSE greatest(r.page_id, b.page_id) END AS page_id,
       b.body AS body, r.redirect_to AS redirect_to, coalesce(b.definitions, 0) AS definitions
FROM b FULL OUTER JOIN r ON b.title = r.title"""


CALL = r"\{\{[^{}]*\}\}"


def calls_sql(pages: str) -> str:
    """(page_id, pos, call, name, params) of the innermost calls in ``pages``."""
    return f"""SELECT page_id, pos, call,
       regexp_replace({strip("split_part(substr(call, 3, length(call) - 4), '|', 1)")}, '(?i)^(?:subst:|safesubst:)', '') AS name,
       list_slice(string_split(substr(call, 3, length(call) - 4), '|'), 2, 1000000) AS params
FROM (SELECT page_id, unnest(regexp_extract_all(text, {lit(CALL)})) AS call,
             unnest(range(len(regexp_extract_all(text, {lit(CALL)})))) AS pos FROM ({pages}))"""


def bound_sql(calls: str) -> str:
    """Arguments as rows ``(.., arg, value, k)``; the last assignment of a name wins."""
    key = (f"CASE WHEN strpos(p, '=') > 0 THEN {strip("split_part(p, '=', 1)")} "
           f"ELSE CAST(len(list_filter(list_slice(params, 1, i), lambda x: strpos(x, '=') = 0)) AS VARCHAR) END")
    val = f"CASE WHEN strpos(p, '=') > 0 THEN substr(p, strpos(p, '=') + 1) ELSE p END"
    kv = f"CASE WHEN strpos(v0, ']]') > 0 THEN v0 ELSE {strip('v0')} END"
    return f"""SELECT * EXCLUDE (v0), {kv} AS value FROM (
  SELECT c.*, e.k AS k, e.key AS arg, e.v0 AS v0
  FROM ({calls}) c
  LEFT JOIN LATERAL (SELECT k, key, v0 FROM (
      SELECT i AS k, {key} AS key, {val} AS v0
      FROM (SELECT unnest(c.params) AS p, unnest(range(1, len(c.params) + 1)) AS i))
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY k DESC) = 1) e ON TRUE)"""


def expanded_sql() -> str:
    """One round of expansion (template bodies in the fixture call no templates)."""
    qt = f"CASE WHEN name = '' THEN '' ELSE 'Template:' || {ucfirst('name')} END"
    placeholder_re = r"\{\{\{[^{}]*\}\}\}"
    return f"""WITH pages AS ({kept_decoded()}),
dict AS ({dictionary_sql()}),
calls AS ({calls_sql('SELECT page_id, text FROM pages')}),
distinct_calls AS (SELECT DISTINCT call, name, params FROM calls),
args AS (SELECT call, map_from_entries(list(struct_pack(key := arg, value := value))) AS m
         FROM ({bound_sql('SELECT call, name, params FROM distinct_calls')}) WHERE arg IS NOT NULL GROUP BY call),
resolved AS (
  SELECT c.call, CASE WHEN c.name = '' THEN '' ELSE coalesce(b.body, '') END AS body, coalesce(a.m, MAP {{}}) AS m
  FROM distinct_calls c
  LEFT JOIN dict r ON r.title = ({qt.replace('name', 'c.name')}) AND r.redirect_to IS NOT NULL
  LEFT JOIN dict b ON b.title = coalesce(r.redirect_to, {qt.replace('name', 'c.name')}) AND b.body IS NOT NULL
  LEFT JOIN args a ON a.call = c.call),
valued AS (
  SELECT call, array_to_string(list_transform(string_split_regex(body, {lit(placeholder_re)}), lambda p, i:
    p || CASE WHEN i <= len(regexp_extract_all(body, {lit(placeholder_re)})) THEN
      coalesce(m[split_part(substr(regexp_extract_all(body, {lit(placeholder_re)})[i], 4,
                   length(regexp_extract_all(body, {lit(placeholder_re)})[i]) - 6), '|', 1)],
               CASE WHEN strpos(regexp_extract_all(body, {lit(placeholder_re)})[i], '|') > 0 THEN
                 split_part(substr(regexp_extract_all(body, {lit(placeholder_re)})[i], 4,
                   length(regexp_extract_all(body, {lit(placeholder_re)})[i]) - 6), '|', 2) END, '')
    ELSE '' END), '') AS value
  FROM resolved),
per_page AS (SELECT c.page_id, list(v.value ORDER BY c.pos) AS vals FROM calls c JOIN valued v ON v.call = c.call
             GROUP BY c.page_id)
SELECT p.page_id, CASE WHEN pp.vals IS NULL THEN p.text ELSE
  array_to_string(list_transform(string_split_regex(p.text, {lit(CALL)}), lambda s, i:
    s || CASE WHEN i <= len(pp.vals) THEN pp.vals[i] ELSE '' END), '') END AS text
FROM pages p LEFT JOIN per_page pp ON pp.page_id = p.page_id"""


# ---------------------------------------------------------------- shaping

HEADER_LEVELS = range(10, 1, -1)


def header_level(x: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({x}, '^={{{k}}}\\s*(.*?)\\s*={{{k}}}') THEN {k}" for k in HEADER_LEVELS)
    return f"CASE {cases} ELSE 0 END"


def header_title(x: str, lv: str) -> str:
    cases = " ".join(f"WHEN {lv} = {k} THEN regexp_extract({x}, '^={{{k}}}\\s*(.*?)\\s*={{{k}}}', 1)"
                     for k in HEADER_LEVELS)
    return f"CASE {cases} END"


def sentence(x: str) -> str:
    return f"CASE WHEN {x} = '' OR regexp_matches({x}, '[!?]$') THEN {x} ELSE {x} || '.' END"


def lines_sql(src: str) -> str:
    """Classified lines of ``src(page_id, text)``."""
    return f"""SELECT *,
  CASE WHEN line = '' THEN 'blank' WHEN lvl > 0 THEN 'header' WHEN starts_with(line, '++') THEN 'title'
       WHEN substr(line, 1, 1) = ':' THEN 'indent' WHEN substr(line, 1, 1) IN ('*', '#', ';') THEN 'list'
       ELSE 'other' END AS kind,
  CASE WHEN lvl > 0 THEN lvl END AS level,
  CASE WHEN lvl > 0 THEN {sentence(header_title('line', 'lvl'))} END AS head,
  (substr(line, 1, 1) IN ('{{', '|') OR right(line, 1) = '}}') AS residue,
  ((substr(line, 1, 1) = '(' AND right(line, 1) = ')') OR regexp_matches(line, '^[.\\-]*$')) AS irrelevant
FROM (SELECT *, {header_level('line')} AS lvl FROM (
  SELECT page_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS line_no FROM ({src})))"""


def compact_sql(src: str, sections: bool = False, lists: bool = False, html: bool = False) -> str:
    """Shaped lines -> ``(page_id, text, chars)``; NULL text when nothing is kept."""
    w = "OVER (PARTITION BY page_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    wr = "OVER (PARTITION BY page_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    item = "trim(regexp_replace(line, '^[*#;:]+', ''))"
    consumes = f"body OR (kind = 'list' AND {item} <> '')" if lists else "body"
    affects = "kind IN ('blank', 'header', 'list', 'other')"
    brks = ", ".join(
        f"sum(CASE WHEN {affects} AND (kind <> 'list' OR prev_prefix IS NULL OR length(prefix) < {d} "
        f"OR substr(prev_prefix, 1, {d}) <> substr(prefix, 1, {d})) THEN 1 ELSE 0 END) {wr} AS isl{d}"
        for d in range(1, 7))
    isl_list = "[" + ", ".join(f"isl{d}" for d in range(1, 7)) + "]"
    bullet = ("CASE WHEN right(prefix, 1) = '#' THEN CAST(item_no AS VARCHAR) || '. ' ELSE '- ' END")
    list_emit = (f"WHEN kind = 'list' AND {item} <> '' THEN rpad({bullet}, CAST(greatest(length({bullet}), length(prefix)) AS INTEGER), ' ') "
                 f"|| {item}") if lists else ""
    emitted, kept, blank, shown = "emit", "kind NOT IN ('blank', 'header') AND emit IS NOT NULL", "kind = 'blank'", "''"
    if html:
        def tags(chars, form):
            for ch, name in (("*", "ul"), ("#", "ol"), (";", "dl")):
                chars = f"replace({chars}, '{ch}', '{form % name}' || chr(10))"
            return chars

        lev = (f"coalesce(CASE WHEN kind = 'list' THEN translate(prefix, ':', ';') WHEN {affects} THEN '' END, {{}})")
        was = "translate(coalesce(prev_prefix, ''), ':', ';')"
        now = lev.format(was)
        shared = f"list_max(list_filter(range(0, least(length({was}), length({now})) + 1), lambda i: substr({was}, 1, i) = substr({now}, 1, i)))"
        before = tags(f"reverse(substr({was}, {shared} + 1))", "</%s>") + " || " + tags(f"substr({now}, {shared} + 1)", "<%s>")
        after = f"CASE WHEN lead(line_no) OVER (PARTITION BY page_id ORDER BY line_no) IS NULL THEN {tags(f'reverse({now})', '</%s>')} ELSE '' END"
        name = "CASE right(prefix, 1) WHEN ';' THEN 'dt' WHEN ':' THEN 'dd' ELSE 'li' END"
        list_emit = (f"WHEN kind = 'list' AND {item} <> '' THEN '<' || {name} || '>' || {item} || '</' || {name} || '>' "
                     f"WHEN kind = 'header' THEN '<h' || level || '>' || {header_title('line', 'level')} || '</h' || level || '>'")
        emitted = f"CASE WHEN kind = 'blank' THEN NULL WHEN emit IS NULL THEN nullif(rtrim({before}, chr(10)), '') ELSE {before} || emit END"
        kept, blank = "(kind <> 'blank' AND emitted IS NOT NULL) OR (kind = 'blank' AND in_list)", "kind = 'blank' AND NOT in_list"
        shown = f"rtrim(chr(10) || {before}, chr(10))"
    heads = ""
    out_expr = "out"
    if html:
        heads = f""",
m AS (SELECT *, CASE WHEN {after} = '' THEN out WHEN out IS NULL THEN rtrim({after}, chr(10))
                     ELSE out || chr(10) || rtrim({after}, chr(10)) END AS out2 FROM h)"""
        out_expr = "out2"
    if sections:
        heads = f""",
k AS (SELECT *, coalesce(sum(CASE WHEN consumes THEN 1 ELSE 0 END) {w}, 0) AS run FROM h),
hs AS (SELECT a.page_id, a.run, list(a.head ORDER BY a.level) AS heads FROM k a
       WHERE a.kind = 'header' AND NOT EXISTS (SELECT 1 FROM k b WHERE b.page_id = a.page_id AND b.run = a.run
             AND b.kind = 'header' AND b.line_no > a.line_no AND b.level <= a.level)
       GROUP BY a.page_id, a.run),
m AS (SELECT k.*, CASE WHEN pending AND consumes AND hs.heads IS NOT NULL
                       THEN array_to_string(list_concat(hs.heads, [out]), chr(10)) ELSE out END AS out2
      FROM k LEFT JOIN hs ON hs.page_id = k.page_id AND hs.run = k.run)"""
        out_expr = "out2"
    final_from = "m" if sections or html else "h"
    return f"""WITH l AS ({lines_sql(src)}),
a0 AS (SELECT *, CASE WHEN kind = 'list' THEN regexp_extract(line, '^[*#;:]+', 0) END AS prefix FROM l),
a1 AS (SELECT *, least(length(prefix), 6) AS depth,
              last_value(CASE WHEN {affects} THEN coalesce(prefix, '') END IGNORE NULLS) {w} AS prev_prefix FROM a0),
a2 AS (SELECT *, {brks} FROM a1),
a3 AS (SELECT *, CASE WHEN kind = 'list' THEN {isl_list}[depth] END AS island FROM a2),
a4 AS (SELECT *, CASE WHEN kind = 'list' THEN sum(CASE WHEN kind = 'list' AND {item} <> '' THEN 1 ELSE 0 END)
                 OVER (PARTITION BY page_id, depth, island ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS item_no FROM a3),
a AS (SELECT *, coalesce(last_value(CASE WHEN {affects} THEN kind = 'list' END
                                    IGNORE NULLS) {w}, false) AS in_list FROM a4),
b AS (SELECT *, (kind = 'other' AND NOT in_list AND NOT residue AND NOT irrelevant) AS body FROM a),
b2 AS (SELECT *, ({consumes}) AS consumes FROM b),
c AS (SELECT *, max(CASE WHEN kind = 'header' THEN line_no END) {w} AS last_head,
                max(CASE WHEN consumes THEN line_no END) {w} AS last_consume FROM b2),
d AS (SELECT *, (last_head IS NOT NULL AND last_head > coalesce(last_consume, -1)) AS pending FROM c),
e AS (SELECT *, coalesce(last_value(CASE WHEN kind = 'header' THEN true WHEN body AND pending THEN false
                                         WHEN kind = 'blank' AND in_list THEN false END IGNORE NULLS) {w}, false)
               AS empty_section FROM d),
f AS (SELECT *, CASE
        {list_emit}
        WHEN kind = 'title' THEN CASE WHEN substr(line, 3, length(line) - 4) <> ''
                                      THEN {sentence('substr(line, 3, length(line) - 4)')} END
        WHEN kind = 'other' AND in_list THEN line
        WHEN body AND pending THEN line
        WHEN body AND NOT empty_section AND NOT starts_with(line, ' ') THEN line END AS emit FROM e),
f2 AS (SELECT *, {emitted} AS emitted FROM f),
g AS (SELECT *, max(CASE WHEN {kept} THEN line_no END) {w} AS last_kept,
                max(CASE WHEN {blank} THEN line_no END) {w} AS last_blank FROM f2),
h AS (SELECT *, CASE WHEN kind = 'blank' THEN CASE WHEN in_list OR (last_kept IS NOT NULL AND
          (last_blank IS NULL OR last_blank < last_kept)) THEN {shown} END ELSE emitted END AS out FROM g){heads}
SELECT page_id, string_agg({out_expr}, chr(10) ORDER BY line_no) AS text, coalesce(sum(length({out_expr})), 0) AS chars
FROM {final_from} GROUP BY page_id"""


def cleaned_sql() -> tuple[list, str]:
    base = "SELECT page_id, title, text FROM (" + kept_decoded() + ")"
    return chain(base, [drop_templates] * 3 + wiki2text_steps()[3:] + clean_steps())


# ---------------------------------------------------------------- the oracle set

def _documents(extra_where: str = "", revid: bool = False) -> str:
    ctes, last = chain(expanded_sql_as_base(), wiki2text_steps() + clean_steps())
    ctes.append(f"shaped AS ({compact_sql('SELECT page_id, text FROM ' + last)})")
    text = (f"CASE WHEN s.text IS NULL THEN p.title || chr(10) "
            f"ELSE p.title || chr(10) || chr(10) || s.text END")
    cols = (f"CAST(p.page_id AS VARCHAR) AS id, '{URL_BASE}?curid=' || CAST(p.page_id AS VARCHAR) AS url, "
            f"p.title AS title, {text} AS text")
    if revid:
        cols += ", CAST(p.rev_id AS VARCHAR) AS revid"
    body = (f"SELECT {cols} FROM ({kept_decoded()}) p LEFT JOIN shaped s ON s.page_id = p.page_id")
    if extra_where:
        body = (f"SELECT {cols} FROM ({kept_decoded()}) p LEFT JOIN shaped s ON s.page_id = p.page_id "
                f"WHERE {extra_where}")
    return with_ctes(ctes, body)


def expanded_sql_as_base() -> str:
    return f"SELECT * FROM ({expanded_sql()})"


def _function_values() -> str:
    w = "regexp_replace(text, '[|{}=\\[\\]]', '', 'g')"
    a, b = "w", "coalesce(lang, '')"
    n = "CAST(doc_id AS VARCHAR)"
    roman = ("CASE WHEN doc_id = 0 THEN '' ELSE "
             f"[{', '.join(lit(x) for x in ROMAN_THOUSANDS)}][CAST(floor(doc_id / 1000) AS INTEGER) + 1] || "
             f"[{', '.join(lit(x) for x in ROMAN_HUNDREDS)}][CAST(floor(doc_id / 100) AS INTEGER) % 10 + 1] || "
             f"[{', '.join(lit(x) for x in ROMAN_TENS)}][CAST(floor(doc_id / 10) AS INTEGER) % 10 + 1] || "
             f"[{', '.join(lit(x) for x in ROMAN_UNITS)}][CAST(doc_id % 10 AS INTEGER) + 1] END")
    sa = strip(a)
    forms = {
        "uc": f"upper(replace({sa}, 'ß', 'SS'))",
        "lc": f"lower({sa})",
        "ucfirst": ucfirst(f"lower({sa})"),
        "lcfirst": lcfirst(sa),
        "urlencode": f"replace(url_encode({strip(a + " || ' ' || " + b)}), '%2F', '/')",
        "int": n,
        "if": f"CASE WHEN doc_id % 3 = 0 OR {sa} = '' THEN 'no' ELSE 'yes' END",
        "ifeq": "CASE WHEN lang = 'en' THEN 'same' ELSE 'other' END",
        "switch": "CASE lang WHEN 'fr' THEN 'French' WHEN 'de' THEN 'Iberian' WHEN 'es' THEN 'Iberian' ELSE 'other' END",
        "expr": "''",
        "len": f"CAST(length({sa}) AS VARCHAR)",
        "sub": f"substr({sa}, 2, 2)",
        "pos": f"substr({sa}, 1, 1)",
        "find": f"CAST(strpos({strip(a + " || ' ' || " + b)}, 'e') AS VARCHAR)",
        "replace": f"replace({sa}, 'e', 'E')",
        "roman": roman,
        "if_empty": f"CASE WHEN {strip(b)} <> '' THEN {strip(b)} ELSE 'x' END",
        "convert": f"{n} || ' km'",
    }
    sel = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS fn, {v} AS value FROM w" for k, v in forms.items())
    return f"WITH w AS (SELECT doc_id, lang, {w} AS w FROM documents) {sel}"


def _more_values() -> str:
    sa, lang = strip("regexp_replace(text, '[|{}=\\[\\]]', '', 'g')"), "coalesce(lang, '')"
    test = f"CASE WHEN doc_id % 2 = 0 THEN '<strong class=\"error\">' || {lang} || '</strong>' ELSE {strip(f"'fine ' || {lang}")} END"
    cut = f"greatest(length({sa}) - 6, 0)"
    forms = {
        "iferror": "CASE WHEN doc_id % 2 = 0 THEN 'bad' ELSE 'good' END", "iferror_2": f"CASE WHEN doc_id % 2 = 0 THEN 'bad' ELSE {test} END",
        "iferror_1": f"CASE WHEN doc_id % 2 = 0 THEN '' ELSE {test} END", "ifexist": "' no'", "ifexist_2": "''",
        **{name: "''" for name in ("ifexpr", "rel2abs", "language", "time", "timel", "titleparts")},
        "sublength": f"substr({sa}, 3, 4)", "sublength_end": f"substr({sa}, {cut} + 1, greatest(length({sa}) - 3 - {cut}, 0))",
        "rep": f"repeat({strip(lang)}, doc_id % 4)",
    }
    return " UNION ALL ".join(f"SELECT doc_id, '{k}' AS fn, {v} AS value FROM documents" for k, v in forms.items())


def _table_residue(x: str) -> str:
    r = rx(x, r'!\s?style="[a-z]+:\d+%;"')
    r = rx(r, r'!\s?style="[a-z]+:\d+%;[a-z]+:#?[0-9a-z]*"')
    return f"replace(replace({r}, '|-', ''), '|', '')"


def _escaped(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _strip_meta(x: str) -> str:
    r = rx(x, r"\[([^\]]+)\]\(https?://[^\)]+\)", r"\1")
    r = f"replace(replace({r}, '&gt;', '>'), '&lt;', '<')"
    r = rx(r, "^[`*~]", "", "")
    return rx(r, "[`*~]$", "", "")


def _comment_texts() -> str:
    return f"SELECT conv_id, turn, {strip(_strip_meta('body'))} AS text FROM ({COMMENTS_SQL}) WHERE body IS NOT NULL"


def _tagged_sentences() -> str:
    arr = lambda xs: "[" + ", ".join(lit(x) for x in xs) + "]"
    labels = "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in LABELS.items()) + "}"
    return f"""WITH docs AS (SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations),
sents AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS sent, unnest(range(len(string_split(text, chr(10))))) AS sent_id FROM docs),
toks0 AS (SELECT doc_id, sent_id, unnest(string_split(sent, ' ')) AS text, unnest(range(len(string_split(sent, ' ')))) AS k FROM sents),
toks AS (SELECT doc_id, sent_id, k, CAST(sent_id * 100000 + k AS INTEGER) AS tok_id, text,
   {arr(POS_CYCLE)}[(sent_id * 100000 + k) % {len(POS_CYCLE)} + 1] AS pos,
   {arr(DEP_CYCLE)}[(sent_id * 100000 + k) % {len(DEP_CYCLE)} + 1] AS dep,
   {arr(ENT_CYCLE)}[(sent_id * 100000 + k) % {len(ENT_CYCLE)} + 1] AS ent_type,
   trim(text) = '' AS is_space, regexp_matches(text, '^(https?://|www\\.)') AS like_url,
   max(k) OVER (PARTITION BY doc_id, sent_id) AS last_k FROM toks0),
ents AS (SELECT doc_id, tok_id AS start_tok, tok_id + 2 AS end_tok, ['ORG', 'PERSON', 'MONEY', 'DATE'][tok_id % 4 + 1] AS label
         FROM toks WHERE k % 7 = 2 AND k + 1 <= last_k),
nps AS (SELECT t.doc_id, least(coalesce(min(CASE WHEN u.dep IN ('advmod', 'amod', 'compound') THEN u.tok_id END), t.tok_id + 1), t.tok_id + 1) AS start_tok,
               t.tok_id + 2 AS end_tok
        FROM toks t JOIN toks u ON u.doc_id = t.doc_id AND u.tok_id >= t.tok_id AND u.tok_id < t.tok_id + 2
        WHERE t.k % 7 = 4 AND t.k + 1 <= t.last_k GROUP BY t.doc_id, t.tok_id),
cover AS (SELECT doc_id, 'ent' AS kind, start_tok, label, unnest(range(start_tok, end_tok)) AS tok_id FROM ents
          UNION ALL SELECT doc_id, 'np', start_tok, '', unnest(range(start_tok, end_tok)) FROM nps),
prio AS (SELECT doc_id, tok_id, arg_min(kind, CASE WHEN kind = 'ent' THEN 0 ELSE 1 END) AS kind,
                arg_min(start_tok, CASE WHEN kind = 'ent' THEN 0 ELSE 1 END) AS start_tok,
                arg_min(label, CASE WHEN kind = 'ent' THEN 0 ELSE 1 END) AS label FROM cover GROUP BY doc_id, tok_id),
t AS (SELECT toks.*, prio.kind, prio.start_tok, prio.label FROM toks LEFT JOIN prio USING (doc_id, tok_id)),
units AS (SELECT doc_id, sent_id, coalesce(start_tok, tok_id) AS unit, string_agg(text, ' ' ORDER BY tok_id) AS txt,
                 arg_max(pos, tok_id) AS pos, arg_max(ent_type, tok_id) AS root_ent, max(kind) AS kind, max(label) AS label,
                 bool_and(is_space) AS all_space, bool_or(like_url) AS any_url
          FROM t GROUP BY doc_id, sent_id, coalesce(start_tok, tok_id)),
words AS (SELECT doc_id, sent_id, unit, all_space, txt,
   CASE WHEN any_url THEN '%%URL|X' ELSE regexp_replace(txt, '\\s', '_', 'g') || '|' ||
     CASE WHEN coalesce(coalesce({labels}[CASE WHEN kind = 'ent' THEN {labels}[label] ELSE root_ent END], pos), '') = '' THEN '?'
          ELSE coalesce({labels}[CASE WHEN kind = 'ent' THEN {labels}[label] ELSE root_ent END], pos) END END AS w FROM units),
s AS (SELECT doc_id, sent_id, string_agg(CASE WHEN NOT all_space THEN w END, ' ' ORDER BY unit) AS s,
             max(CASE WHEN trim(txt) <> '' THEN 1 ELSE 0 END) AS has_text FROM words GROUP BY doc_id, sent_id)
SELECT doc_id, string_agg(coalesce(s, ''), chr(10) ORDER BY sent_id) || chr(10) AS text FROM s WHERE has_text = 1 GROUP BY doc_id"""


def _nested_sql() -> str:
    """What V3's calls come to, written out by hand from the bodies (a cap of 6 levels leaves 5 of them their text)."""
    n2 = lambda x: f"('<' || CASE WHEN {x} <> '' THEN {x} || n3 ELSE 'none' END || '>')"
    n1 = lambda a, b: f"('[' || {n2(a)} || {b} || ']')"
    return f"""WITH last AS (SELECT '~' || arg_max(lang, doc_id) AS n3 FROM documents WHERE doc_id % 80 = 30)
SELECT doc_id AS page_id, CASE doc_id % 10
  WHEN 1 THEN '(' || {n1("source", "n3")} || ')'
  WHEN 2 THEN '(' || {n1("lang", "source")} || ')'
  WHEN 3 THEN CASE lang WHEN 'en' THEN 'E' || n3 WHEN 'de' THEN 'DF' WHEN 'fr' THEN 'DF' ELSE '<none>' END
  WHEN 4 THEN repeat('r', 5)
  WHEN 5 THEN 's' || length(source)
  WHEN 6 THEN n3 || {n2("source")}
  WHEN 7 THEN n3 || ' }} {{'
  WHEN 8 THEN {n1("'q'", "'w'")}
  ELSE '[[x|y]] ' || {n1("'[[p|q]]'", "'[[r|s]]'")} END || ' ' || translate(text, '{{}}|', '   ') AS text
FROM documents, last WHERE doc_id % 10 <> 0"""


def _file_numbers_sql() -> str:
    """Greedy files by their definition: each file's end from its start, one file after the other."""
    block = ("'<doc id=\"' || id || '\" url=\"' || url || '\" title=\"' || title || '\">' || chr(10) || text || chr(10) || chr(10) "
             "|| '</doc>' || chr(10)")
    return _packed_sql(f"SELECT id, octet_length(encode({block}))::BIGINT AS bytes FROM ({_documents()})") + "SELECT id, file_id, bytes FROM f"


def _packed_sql(records: str) -> str:
    """CTEs ending in f: the file of each record (id, bytes, further columns), in order of the ids, at most 200 KiB a file."""
    return f"""WITH RECURSIVE r AS ({records}),
s AS (SELECT *, row_number() OVER (ORDER BY id::BIGINT) - 1 AS pos, sum(bytes) OVER (ORDER BY id::BIGINT) AS stop FROM r),
j AS (SELECT a.pos, greatest(a.pos + 1, (SELECT count(*) FROM s b WHERE b.stop <= a.stop - a.bytes + {200 * 1024})) AS next FROM s a),
c AS (SELECT 0::BIGINT AS pos, 0::BIGINT AS file_id UNION ALL
      SELECT j.next, c.file_id + 1 FROM c JOIN j USING (pos) WHERE j.next < (SELECT count(*) FROM s)),
f AS (SELECT s.*, c.file_id, s.pos - c.pos AS nth FROM c JOIN j USING (pos) JOIN s ON s.pos >= c.pos AND s.pos < j.next)
"""


def _written_sql() -> str:
    line = "to_json({'id': id, 'url': url, 'title': title, 'text': text})::VARCHAR"
    records = f"SELECT id, text, {line} AS line, octet_length(encode({line}))::BIGINT + 1 AS bytes FROM ({_documents()})"
    kept = "ns = 0 AND redirect_title IS NULL"
    totals = {"pages": f"count(*) FROM ({v1()})", "articles": f"count(*) FROM ({v1()}) WHERE {kept}",
              "templates": f"count(*) FROM ({v1()}) WHERE ns IN (10, 828)", "documents": "count(*) FROM f", "chars": "sum(length(text)) FROM f"}
    parts = ["SELECT CAST(file_id AS VARCHAR) AS file, nth, line FROM f"]
    parts += [f"SELECT '{k}' AS file, 0 AS nth, CAST(n AS VARCHAR) AS line FROM (SELECT {v.replace(' FROM', ' AS n FROM', 1)})" for k, v in totals.items()]
    return _packed_sql(records) + " UNION ALL ".join(parts)


def _repeated_sql() -> str:
    """The cleaned articles of V1 under the titles of their copies; without an id nothing counts as repeated."""
    ctes, last = cleaned_sql()
    ctes.append(f"shaped AS ({compact_sql('SELECT page_id, text FROM ' + last)})")
    ctes.append(f"""copies AS (SELECT page_id, title FROM ({kept_decoded()})
  UNION ALL SELECT page_id, title || ' B' FROM ({kept_decoded()}) WHERE page_id % 3 <> 0
  UNION ALL SELECT page_id, title || ' again' FROM ({kept_decoded()}) WHERE page_id % 4 = 1 AND page_id % 7 = 3)""")
    return with_ctes(ctes, "SELECT CASE WHEN c.page_id % 7 <> 3 THEN CAST(c.page_id AS VARCHAR) END AS id, c.title, "
                           "c.title || chr(10) || CASE WHEN s.text IS NULL THEN '' ELSE chr(10) || s.text END AS text "
                           "FROM copies c LEFT JOIN shaped s ON s.page_id = c.page_id")


def _html_spans() -> str:
    ctes, last = chain("SELECT page_id, html, html AS text FROM pages", clean_steps()[:3 + len(DEFAULT_DISCARD_ELEMENTS)])
    alt = "|".join(DEFAULT_IGNORED_TAGS + ("a",))
    counts = {"n_comment": r"(?s)<!--.*?-->", "n_self_closing": r"(?is)<\s*(?:br|hr|nobr|ref|references|nowiki)\b[^>]*/\s*>",
              "n_ignored_tag": r"(?is)<(?:" + alt + r")\b.*?>|</\s*(?:" + alt + r")>"}
    cols = ", ".join(f"len(regexp_extract_all(html, {lit(p)})) AS {n}" for n, p in counts.items())
    return with_ctes(ctes, f"SELECT page_id, {cols}, text FROM {last}")


def _html_chain(steps) -> str:
    ctes, last = chain("SELECT page_id, html AS text FROM pages", steps)
    return with_ctes(ctes, f"SELECT page_id, text FROM {last}")


def oracle_sql() -> dict[str, str]:
    kept = f"SELECT * FROM ({v1()}) WHERE ns = 0 AND redirect_title IS NULL"
    o: dict[str, str] = {}
    o["f01_articles"] = f"SELECT page_id, title FROM ({v1()}) WHERE ns = 0"
    o["f02_kept_pages"] = f"SELECT page_id, title FROM ({kept})"
    o["f03_disambiguation"] = (f"SELECT page_id, title FROM ({v1_decoded()}) WHERE ns = 0 AND NOT "
                               f"regexp_matches(text, '(?m)^\\{{\\{{disambig(uation)?(\\|[^}}]*)?\\}}\\}}')")
    o["f06_template_pages"] = f"SELECT page_id, ns, title FROM ({v1()}) WHERE ns IN (10, 828)"
    o["w01_page_num"] = (f"SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS page_num, "
                         f"'{URL_BASE}?curid=' || CAST(page_id AS VARCHAR) AS url, CAST(rev_id AS VARCHAR) AS revid "
                         f"FROM ({kept})")
    page = "CASE WHEN strpos(title, ':') > 0 THEN substr(title, strpos(title, ':') + 1) ELSE title END"
    o["p02_title_parts"] = f"""SELECT page_id,
  CASE WHEN strpos(title, ':') > 0 THEN split_part(title, ':', 1) ELSE '' END AS NAMESPACE,
  pg AS PAGENAME, title AS FULLPAGENAME,
  CASE WHEN strpos(pg, '/') > 0 THEN regexp_extract(pg, '^(.*)/', 1) ELSE pg END AS BASEPAGENAME,
  CASE WHEN strpos(pg, '/') > 0 THEN regexp_extract(pg, '/([^/]*)$', 1) ELSE '' END AS SUBPAGENAME,
  CASE WHEN strpos(pg, '/') > 0 THEN split_part(pg, '/', 1) ELSE pg END AS ROOTPAGENAME
FROM (SELECT page_id, title, {page} AS pg FROM ({v1()}))"""
    norm = lambda t, known: f"""(SELECT CASE
      WHEN regexp_matches(n, '^([^:]*):(\\s*)(\\S.*)$') AND {ucfirst("regexp_extract(n, '^([^:]*):(\\s*)(\\S.*)$', 1)")} IN ({known})
        THEN {ucfirst("regexp_extract(n, '^([^:]*):(\\s*)(\\S.*)$', 1)")} || ':' || {ucfirst("regexp_extract(n, '^([^:]*):(\\s*)(\\S.*)$', 3)")}
      WHEN regexp_matches(n, '^([^:]*):(\\s*)(\\S.*)$')
        THEN {ucfirst("regexp_extract(n, '^([^:]*):(\\s*)(\\S.*)$', 1)")} || ':' ||
             CASE WHEN regexp_extract(n, '^([^:]*):(\\s*)(\\S.*)$', 2) <> '' THEN ' ' ELSE '' END ||
             {ucfirst("regexp_extract(n, '^([^:]*):(\\s*)(\\S.*)$', 3)")}
      ELSE {ucfirst('n')} END
    FROM (SELECT regexp_replace(regexp_replace({t}, '^[ _]+|[ _]+$', '', 'g'), '[\\s_]+', ' ', 'g') AS n))"""  # noqa: E731
    last = "regexp_extract(title, '([^:]*)$', 1)"
    o["p06_normalize_title"] = f"""SELECT page_id,
  {norm("' _' || lower(title) || '__ '", "'Template', 'Module', 'Project'")} AS norm_title,
  {norm("replace(title, ':', ':  ')", "'Template'")} AS norm_spaced,
  {ucfirst('lower(title)')} AS ucfirst, {lcfirst('title')} AS lcfirst,
  CASE WHEN lower({last}) = '' THEN '' ELSE 'Template:' || {ucfirst(f'lower({last})')} END AS qualified
FROM ({v1()})"""
    o["e04_template_definitions"] = f"SELECT page_id, title, ns, body, redirect_to FROM ({defs_filtered()})"
    o["a01_template_dictionary"] = dictionary_sql()
    o["e03_template_calls"] = (f"SELECT page_id, pos, call, name, arg, value FROM "
                               f"({bound_sql(calls_sql(kept_decoded()))})")
    o["e09_expanded_text"] = expanded_sql()
    o["e10_parser_functions"] = _function_values()
    o["c01_unescape_html"] = f"SELECT page_id, {unescape('html')} AS text FROM pages"
    o["c05_html_tags"] = _html_chain(clean_steps()[:3 + len(DEFAULT_DISCARD_ELEMENTS)])
    o["u01_spans"] = _html_spans()
    o["b04_html_to_text"] = _html_chain(clean_steps())
    ctes, last = chain(f"SELECT page_id, text FROM ({kept_decoded()})", wiki2text_steps())
    o["c14_wiki_markup"] = with_ctes(ctes, f"SELECT page_id, text FROM {last}")
    ctes, last = chain(f"SELECT page_id, text FROM ({kept_decoded()})", wiki2html_steps())
    o["c14_wiki_markup_html"] = with_ctes(ctes, f"SELECT page_id, text FROM {last}")
    ctes, last = cleaned_sql()
    o["c25_clean_text"] = with_ctes(ctes, f"SELECT page_id, text FROM {last}")
    ctes, last = chain("SELECT doc_id, text FROM documents",
                       [placeholder("math", "formula"), placeholder("code", "codice"), tidy])
    o["c21_tidy_documents"] = with_ctes(ctes, f"SELECT doc_id, text FROM {last}")
    o["c26_strip_comments"] = _comment_texts()
    ctes, last = cleaned_sql()
    o["l03_lines"] = with_ctes(ctes, f"SELECT page_id, line_no, line, kind, level, head FROM "
                                     f"({lines_sql('SELECT page_id, text FROM ' + last)})")
    o["l13_compact"] = with_ctes(ctes, f"SELECT page_id, coalesce(text, '') AS text FROM "
                                       f"({compact_sql('SELECT page_id, text FROM ' + last)})")
    o["l04_compact_sections"] = with_ctes(ctes, f"SELECT page_id, coalesce(text, '') AS text FROM "
                                                f"({compact_sql('SELECT page_id, text FROM ' + last, True, True)})")
    o["l06_html_lists"] = with_ctes(ctes, f"SELECT page_id, coalesce(text, '') AS text FROM "
                                          f"({compact_sql('SELECT page_id, text FROM ' + last, html=True)})")
    link = r"\[\[([^\[\]]*)\]\](" + WORD + "*)"
    inner = "l.link"
    title = f"CASE WHEN strpos({inner}, '|') > 0 THEN regexp_replace(split_part({inner}, '|', 1), '\\s+$', '') ELSE {inner} END"
    label = f"CASE WHEN strpos({inner}, '|') > 0 THEN {strip(f'regexp_extract({inner}, {lit(chr(92) + chr(124) + '([^|]*)$')}, 1)')} ELSE {inner} END"
    acc = ", ".join(lit(a) for a in DEFAULT_ACCEPTED_NAMESPACES)
    o["g01_internal_links"] = f"""SELECT page_id, pos, title, label, trail,
  CASE WHEN strpos(title, ':') > 1 THEN split_part(title, ':', 1) ELSE '' END AS namespace,
  NOT ((strpos(title, ':') > 1 AND split_part(title, ':', 1) NOT IN ({acc}))
       OR (strpos(title, ':') = 1 AND strpos(substr(title, 2), ':') > 1 AND split_part(substr(title, 2), ':', 1) NOT IN ({acc}))) AS accepted
FROM (SELECT page_id, pos, {title} AS title, {label} AS label, trail FROM (
  SELECT page_id, unnest(regexp_extract_all(text, {lit(link)}, 1)) AS link, unnest(regexp_extract_all(text, {lit(link)}, 2)) AS trail,
         unnest(range(len(regexp_extract_all(text, {lit(link)}, 1)))) AS pos FROM ({kept_decoded()})) l)"""
    o["g02_external_links"] = f"""SELECT page_id, pos, lower(regexp_extract(url, '^([A-Za-z]*:?/?/?)', 1)) AS protocol, url, label FROM (
  SELECT page_id, unnest(regexp_extract_all(text, {lit(EXT_LINK)}, 1)) AS url, unnest(regexp_extract_all(text, {lit(EXT_LINK)}, 2)) AS label,
         unnest(range(len(regexp_extract_all(text, {lit(EXT_LINK)}, 1)))) AS pos FROM ({kept_decoded()}))"""
    o["c11_deep_nesting"] = """SELECT doc_id, CASE WHEN doc_id % 41 = 0 THEN w ELSE 'L  R' END AS calls,
  CASE WHEN doc_id % 41 = 0 THEN w ELSE 'L  R' END AS tables, CASE WHEN doc_id % 41 = 0 THEN w ELSE 'L  R' END AS elements,
  CASE WHEN doc_id % 41 = 0 THEN w ELSE 'L ' || trim(l) || ' R' END AS links
FROM (SELECT doc_id, regexp_replace(text, '[^A-Za-z ]', '', 'g') AS l, 'L ' || regexp_replace(text, '[^A-Za-z ]', '', 'g') || ' R' AS w
      FROM documents)"""
    # Down to depth d (each number 1), a second item at d, one more at 1, and down again: only depth 1 goes on counting.
    o["w04_deep_items"] = """SELECT doc_id, line_no, depth, item_no FROM (
  SELECT doc_id, doc_id % 12 + 1 AS d FROM documents), LATERAL (
    SELECT unnest(range(1, d + 1)) AS depth, unnest(range(0, d)) AS line_no, 1 AS item_no
    UNION ALL SELECT d, d, 2 UNION ALL SELECT 1, d + 1, CASE WHEN d = 1 THEN 3 ELSE 2 END
    UNION ALL SELECT k, d + 1 + k, CASE WHEN k > 1 THEN 1 WHEN d = 1 THEN 4 ELSE 3 END FROM (SELECT unnest(range(1, d + 1)) AS k))"""
    o["b01_documents"] = _documents()
    docs300 = _documents("length(p.title) + 1 + coalesce(s.chars, 0) >= 300", revid=True)
    o["k01_json_lines"] = (f"SELECT id, to_json({{'id': id, 'url': url, 'title': title, 'text': text, 'revid': revid}})"
                           f"::VARCHAR AS line FROM ({docs300})")
    docs_r = _documents(revid=True)
    o["k02_doc_blocks"] = (f"SELECT id, '<doc id=\"' || id || '\" revid=\"' || revid || '\" url=\"' || url || "
                           f"'\" title=\"' || title || '\">' || chr(10) || text || chr(10) || chr(10) || '</doc>' || chr(10) "
                           f"AS block FROM ({docs_r})")
    o["a05_word_counts"] = (f"SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word "
                            f"FROM ({_comment_texts()})) WHERE word <> '' GROUP BY word")
    o["r05_tagged_sentences"] = _tagged_sentences()
    o["b03_comment_job"] = rf"""WITH c AS ({_comment_texts()}),
s AS (SELECT list_filter(string_split(sent, ' '), lambda w: trim(w) <> '') AS words FROM (SELECT unnest(string_split(text, chr(10))) AS sent FROM c)),
n AS (SELECT count(*) AS good, count(*) FILTER (WHERE conv_id % 10 = 0) AS bad FROM c)
SELECT 'sentence' AS kind, array_to_string(list_transform(words, lambda w: CASE WHEN regexp_matches(w, '^(https?://|www\.)') THEN '%%URL|X'
  ELSE regexp_replace(w, '\s', '_', 'g') || '|?' END), ' ') AS value FROM s WHERE len(words) > 0
UNION ALL SELECT 'records', CAST(good + bad AS VARCHAR) FROM n UNION ALL SELECT 'bad_records', CAST(bad AS VARCHAR) FROM n"""
    words = f"SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM ({_comment_texts()})"
    o["x01_map_reduce"] = (f"SELECT substr(word, 1, 1) AS first, count(*) AS n, max(length(word)) AS longest FROM ({words}) "
                           f"WHERE word <> '' GROUP BY 1")
    o["x02_per_batch"] = f"""SELECT batch_id, count(*) AS n, count(*) FILTER (WHERE length(text) >= 80) AS n_long, sum(length(text))::BIGINT AS chars FROM (
  SELECT text, CAST(floor((row_number() OVER (ORDER BY conv_id, turn) - 1) / 50) AS BIGINT) AS batch_id FROM ({_comment_texts()})) GROUP BY batch_id"""
    o["n03_more_functions"] = _more_values()
    o["c16_nowiki"] = """SELECT doc_id AS page_id, 'a <nowiki>{{Pair|' || coalesce(lang, '') || '}} </nowiki>(' || coalesce(source, '') || '+' ||
  coalesce(source, '') || ') <nowiki>{{</nowiki> ' || translate(text, '{}|<>', '     ') AS text FROM documents"""
    head = "'{| class=x' || chr(10) || '! style=\"width:20%;\" ' || coalesce(lang, '') || chr(10) || '!style=\"width:5%;color:#ff0\" H' || chr(10) || '|-' || chr(10) || '| '"
    ctes, last = chain(f"SELECT doc_id, {head} || coalesce(text, '') || chr(10) || '|}}' AS text FROM documents", [*clean_steps(), _table_residue])
    o["c23_kept_tables"] = with_ctes(ctes, f"SELECT doc_id, text FROM {last}")
    o["c24_escaped_html"] = _html_chain([step for step in clean_steps() if step is not unescape] + [_escaped])
    image = ("SELECT doc_id, 'a [http://e.org/' || doc_id || ' http://e.org/i/' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.JPG' ELSE '.txt' END || "
             "'] [https://x.org/ ' || coalesce(lang, '') || ' label] ' || translate(text, '[]', '  ') AS text FROM documents")
    o["c13_image_links"] = f"SELECT doc_id, {external_links('text')} AS plain, {external_links_html('text')} AS linked FROM ({image})"
    titles = ("SELECT page_id, '++' || title || CASE WHEN page_id % 3 = 0 THEN '?' ELSE '' END || '++' || chr(10) || "
              f"CASE WHEN page_id % 5 = 0 THEN '++++' || chr(10) ELSE '' END || text AS text FROM ({v1()})")
    o["l12_page_titles"] = f"SELECT page_id, coalesce(text, '') AS text FROM ({compact_sql(titles)})"
    o["w06_comment_batches"] = (f"SELECT conv_id, turn, CAST(floor((row_number() OVER (ORDER BY conv_id, turn) - 1) / 100) AS BIGINT) "
                                f"AS batch_id FROM ({_comment_texts()})")
    o["a04_run_totals"] = (f"SELECT count(*) AS pages, sum(CASE WHEN ns = 0 AND redirect_title IS NULL THEN 1 ELSE 0 END) AS articles, "
                           f"sum(CASE WHEN ns IN (10, 828) THEN 1 ELSE 0 END) AS templates FROM ({v1()})")
    o["f05_repeated_ids"] = f"""SELECT page_id, page_num, copy FROM (
  SELECT *, lag(page_id) OVER (ORDER BY page_num) AS prev FROM (
    SELECT page_id, copy, row_number() OVER (ORDER BY page_id, copy) - 1 AS page_num FROM (
      SELECT page_id, 0 AS copy FROM ({v1()}) UNION ALL SELECT page_id, 1 AS copy FROM ({v1()}))))
WHERE prev IS NULL OR prev <> page_id"""
    o["a03_template_errors"] = f"""SELECT page_id, CASE page_id % 10 WHEN 3 THEN 1 WHEN 4 THEN page_id % 3 ELSE 0 END AS title_errors,
  CASE WHEN page_id % 10 = 4 THEN 1 ELSE 0 END AS recursion_errors FROM ({NESTED_PAGES_SQL}) WHERE ns = 0"""
    o["e09_nested"] = _nested_sql()
    w = "regexp_replace(text, '[|{}=\\[\\]]', '', 'g')"
    wrap = lambda x: f"'<' || length({x}) || ':' || substr({x}, 1, 1) || '>'"
    o["j06_frame_arguments"] = f"""SELECT doc_id AS page_id, CASE doc_id % 3 WHEN 0 THEN {wrap(strip(w))}
  WHEN 1 THEN {wrap("(source || '!')")} || '-:' ELSE '<0:>/<' || length(lang) || ':>' END AS text FROM documents"""
    o["k03_file_numbers"] = _file_numbers_sql()
    o["k04_written_corpus"] = _written_sql()
    o["s01_dump_round_trip"] = f"SELECT page_id, ns, title, redirect_title, rev_id, text FROM ({v1()})"
    o["a02_all_revisions"] = f"SELECT page_id, 'old ' || title || chr(10) || text AS text FROM ({v1()})"
    o["b02_merged_dictionary"] = dictionary_sql()
    o["s08_exactly_once"] = _comment_texts()
    o["c15_highlighted_code"] = """SELECT doc_id, 'a <i>' || regexp_replace(text, '[^A-Za-z]', '', 'g') || '</i> &lt;b&gt; ' || lang || ' z &lt;' AS text
FROM documents"""
    o["r01_annotated"] = """SELECT doc_id, sent_id, row_number() OVER w - 1 AS tok_id, text,
  coalesce(sum(length(text) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
  trim(text) = '' AS is_space, regexp_matches(text, '^(https?://|www\\.)') AS like_url
FROM (SELECT doc_id, sent_id, unnest(string_split(sent, ' ')) AS text, generate_subscripts(string_split(sent, ' '), 1) AS k FROM (
  SELECT conv_id * 1000 + turn AS doc_id, unnest(string_split(text, chr(10))) AS sent, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS sent_id
  FROM conversations)) WINDOW w AS (PARTITION BY doc_id ORDER BY sent_id, k)"""
    o["b01_repeated"] = _repeated_sql()
    pg = "CASE WHEN strpos(title, ':') > 0 THEN substr(title, strpos(title, ':') + 1) ELSE title END"
    ns = "CASE WHEN strpos(title, ':') > 0 THEN split_part(title, ':', 1) ELSE '' END"
    o["e07_magic_words"] = f"""SELECT page_id, pg || '|' || nsn || '|' || CASE WHEN nsn = 'Template' THEN '10' ELSE '0' END || '|' ||
  CASE WHEN strpos(pg, '/') > 0 THEN regexp_extract(pg, '/([^/]*)$', 1) ELSE '' END || '|2020-01|00:00:00|' || title || '|' AS text
FROM (SELECT page_id, title, {pg} AS pg, {ns} AS nsn FROM ({v1()}))"""
    return o
