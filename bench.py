"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through Spark's ``noop`` sink (the whole plan
executes, nothing is collected to the driver).  The same queries first run
once on the smallest tables so that JVM class loading and code generation
(cached by generated source) are not billed to the first timed query; every
timed query then runs exactly once on the target tables.  ``articles_per_sec`` is the
extraction rate of the flagship (B01), the reference's own progress metric.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from quarry.plans import queries as Q  # noqa: E402
from quarry.session import get_session  # noqa: E402

HEADLINE = [
    "b01_documents",            # dump -> documents with template expansion (flagship)
    "a01_template_dictionary",  # dump -> template dictionary (B02)
    "e09_expanded_text",        # expansion rounds alone
    "c25_clean_text",           # cleaning chain alone
    "l13_compact",              # line shaping windows
    "b04_html_to_text",         # web pages -> text
    "g01_internal_links",       # link table
    "r05_tagged_sentences",     # comments -> tagged sentences
    "a05_word_counts",          # keyed map-reduce
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", cpus * 2)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    times = {}
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in HEADLINE:
        Q.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        t0 = time.perf_counter()
        Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    articles = Q.QUERIES["f02_kept_pages"](spark, sf_dir).count()
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf,
        "articles": articles,
        "articles_per_sec": round(articles / times["b01_documents"], 1) if times["b01_documents"] else None,
    }))


if __name__ == "__main__":
    main()
