"""Reuse of large column expressions within a session.

Building a ``Column`` costs one JVM round trip per function call; rule sets
such as the entity table or the parser-function dispatch take thousands.
Expressions that refer to columns only by name are built once per
SparkContext and reused by every query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column

_CACHE: dict = {}


def cached(key, build: Callable[[], Column]) -> Column:
    sc = SparkContext._active_spark_context
    k = (sc.applicationId if sc else None, key)
    if k not in _CACHE:
        _CACHE[k] = build()
    return _CACHE[k]


def forget(key) -> None:
    """Drop a cached expression (for every session), e.g. after a registry changed."""
    for k in [k for k in _CACHE if k[1] == key]:
        del _CACHE[k]
