"""Link tables (G01, G02): links as rows instead of being rewritten in text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.markup import EXT_LINK_RE, link_parts, namespace_ok
from quarry.functions.text import WORD
from quarry.options import Options

# A link without [[ or ]] inside, and the word characters glued after it (the trail).
LINK_TRAIL_RE = r"(\[\[[^\[\]]*+(?:(?:\[(?!\[)|\](?!\]))[^\[\]]*+)*+\]\])(" + WORD + r"*)"


def internal_links(pages: DataFrame, opts: Options = Options(), key: str = "page_id") -> DataFrame:
    """``(page_id, pos, title, label, trail, namespace, accepted)`` for innermost links."""
    found = pages.select(key, F.posexplode(F.arrays_zip(
        F.regexp_extract_all("text", F.lit(LINK_TRAIL_RE), 1).alias("link"),
        F.regexp_extract_all("text", F.lit(LINK_TRAIL_RE), 2).alias("trail"))).alias("pos", "m"))
    _, title, label = link_parts(F.col("m.link"))
    colon = F.locate(":", title)
    return found.select(
        key, "pos", title.alias("title"), label.alias("label"), F.col("m.trail").alias("trail"),
        F.when(colon > 1, F.substring_index(title, ":", 1)).otherwise(F.lit("")).alias("namespace"),
        namespace_ok(title, opts.accepted_namespaces).alias("accepted"))


def external_links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``(page_id, pos, protocol, url, label)`` for bracketed external links."""
    found = pages.select(key, F.posexplode(F.arrays_zip(
        F.regexp_extract_all("text", F.lit(EXT_LINK_RE), 1).alias("url"),
        F.regexp_extract_all("text", F.lit(EXT_LINK_RE), 2).alias("label"))).alias("pos", "m"))
    url = F.col("m.url")
    return found.select(key, "pos", F.lower(F.regexp_extract(url, r"^([A-Za-z]*:?/?/?)", 1)).alias("protocol"),
                        url.alias("url"), F.col("m.label").alias("label"))
