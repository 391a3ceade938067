"""String helpers as Spark column expressions (no Python UDFs).

Every function takes and returns a ``Column`` so it can be composed inside a
``select`` and stays within whole-stage codegen where Spark supports it.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``\w`` is Unicode-aware; Java's is ASCII unless (?U) is set and the
# SQL oracle (RE2) is ASCII only.  This class reads the same in all three.
WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]"

# Named character references, built from the standard library's HTML 4 table.
ENTITY_CHARS = {name: chr(cp) for name, cp in sorted(name2codepoint.items())}


def _entity_map() -> Column:
    from quarry.functions.cache import cached

    return cached("entity_map", lambda: F.create_map(
        *[x for k, v in ENTITY_CHARS.items() for x in (F.lit(k), F.lit(v))]))


MAX_CODE_POINT = 0x10FFFF


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ucfirst(c) -> Column:
    """First character upper-cased, the rest untouched (``initcap`` lowers the rest)."""
    c = col_(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def lcfirst(c) -> Column:
    c = col_(c)
    return F.concat(F.lower(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def strip_ws(c) -> Column:
    """Python ``str.strip()``: Unicode whitespace at both ends."""
    return F.regexp_replace(col_(c), r"(?U)^\s+|\s+$", "")


def code_point_char(n: Column) -> Column:
    """Character for a code point, or NULL when the number is not a scalar value."""
    ok = (n >= 0) & (n <= MAX_CODE_POINT) & ~n.between(0xD800, 0xDFFF)
    return F.when(ok, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))


def _fix_reference(p: Column) -> Column:
    """Decode the character reference at the start of a piece that begins with ``&``.

    A reference ends at the piece's first semicolon: only what stands before it is read as one.
    """
    head = F.substring_index(p, ";", 1)
    name = F.regexp_extract(head, r"^&(" + WORD + r"+)\z", 1)
    dec = F.regexp_extract(head, r"^&#([0-9]+)\z", 1)
    hexa = F.regexp_extract(head, r"^&#x([0-9A-Fa-f]+)\z", 1)
    named = F.try_element_at(_entity_map(), name)
    dec_char = code_point_char(dec.try_cast("bigint"))
    hex_char = code_point_char(F.conv(hexa, 16, 10).try_cast("bigint"))
    decoded = (
        F.when((name != "") & named.isNotNull(), F.concat(named, F.substring(p, F.length(name) + 3, 1 << 30)))
        .when((dec != "") & dec_char.isNotNull(), F.concat(dec_char, F.substring(p, F.length(dec) + 4, 1 << 30)))
        .when((hexa != "") & (F.length(hexa) <= 8) & hex_char.isNotNull(),
              F.concat(hex_char, F.substring(p, F.length(hexa) + 5, 1 << 30)))
        .otherwise(p)
    )
    return F.when(p.startswith("&") & p.contains(";"), decoded).otherwise(p)


def unescape(c) -> Column:
    """Decode named, decimal and hex character references; unknown ones stay.

    The text is cut at every ``&`` so each piece after the first holds at most
    one reference, at its start; pieces are decoded and joined again.
    """
    if isinstance(c, str):
        from quarry.functions.cache import cached

        return cached(("unescape", c), lambda: unescape(F.col(c)))
    c = col_(c)
    pieces = F.transform(F.split(c, "&"), lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit("&"), p)))
    decoded = F.array_join(F.transform(pieces, _fix_reference), "")
    return F.when(c.contains("&"), decoded).otherwise(c)


def html_escape(c) -> Column:
    """Escape ``&``, ``<`` and ``>`` (ampersand first)."""
    c = col_(c)
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def url_quote(c) -> Column:
    """Percent-encode UTF-8 bytes keeping letters, digits, ``_.-~`` and ``/``.

    ``url_encode`` is form encoding: space becomes ``+``, ``~`` is escaped
    and ``*`` is not; those three differences are corrected.
    """
    e = F.url_encode(col_(c))
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        e = F.replace(e, F.lit(a), F.lit(b))
    return e


def sub_with(c, pattern: str, render) -> Column:
    """Replace every match of ``pattern`` by ``render(match)``.

    Spark has no callback replace; the text is split on the pattern and the
    matches extracted with the same scan, then interleaved again.
    """
    c = col_(c)
    values = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda m: render(m))
    # Both scans are bound once: inside the lambda they would run again for every piece.
    scan = F.array(F.struct(F.split(c, pattern).alias("pieces"), values.alias("values")))
    return F.get(F.transform(scan, lambda x: F.array_join(F.transform(x["pieces"], lambda p, i: F.concat(
        p, F.when(i < F.size(x["values"]), F.get(x["values"], i)).otherwise(F.lit("")))), "")), 0)


# Roman numeral digits by place (units, tens, hundreds, thousands up to 4).
ROMAN_UNITS = ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]
ROMAN_TENS = ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"]
ROMAN_HUNDREDS = ["", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"]
ROMAN_THOUSANDS = ["", "M", "MM", "MMM", "MMMM"]


def roman(n, too_big=None) -> Column:
    """Roman numeral of an integer 0..4999; outside that, ``too_big`` or ``N/A``."""
    n = col_(n).cast("bigint")
    arr = lambda xs: F.array(*[F.lit(x) for x in xs])
    digits = F.concat(
        F.get(arr(ROMAN_THOUSANDS), F.floor(n / 1000).cast("int")),
        F.get(arr(ROMAN_HUNDREDS), (F.floor(n / 100) % 10).cast("int")),
        F.get(arr(ROMAN_TENS), (F.floor(n / 10) % 10).cast("int")),
        F.get(arr(ROMAN_UNITS), (n % 10).cast("int")),
    )
    fallback = F.lit("N/A") if too_big is None else col_(too_big)
    return F.when((n < 0) | (n >= 5000), fallback).otherwise(digits)


def int_text(c) -> Column:
    """``int`` parser function: the integer as text, empty when it is not one."""
    return F.coalesce(strip_ws(c).try_cast("bigint").cast("string"), F.lit(""))
