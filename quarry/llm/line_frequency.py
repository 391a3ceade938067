"""Quality rules by cross-document line frequency.

Lines are normalised (ASCII lower case, digits to 0, white space runs to one
space) and hashed to 128 bits; the distinct documents that hold a line are
counted per host (here: ``source``); lines above the limits are removed, and
documents that lose too much are rejected as depleted.

Copies of one text count as one document, so a text isn't removed for having
been crawled often: exact copies are for the near-duplicate stage.

One Python pass per text yields the base figures and the line hashes; from there
on only hashes move.  Counting is a partial aggregation, so a line that a third
of all documents share costs one row per task; the two joins have unaggregated
rows on one side only and AQE can split a hot key.

Defined cases: null text is the empty text (no words, base_failed); null host is
a host of its own; empty and word-less lines are neither counted nor removed;
repeated rows (same id, host and text) give the same verdict each; an empty table
gives an empty result; further columns are ignored by ``line_verdicts`` and kept
by ``clean``, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACES, bounded_batches, fresh, null_key, staged, text_or_empty

SYMBOLS = "#*$%&|<>"
_FOLD = bytes(ord("0") if chr(i).isdigit() and i < 128 else i for i in range(256)).lower()

BASE_FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
LINES_TYPE = "array<struct<h: binary, w: int>>"


@dataclass(frozen=True)
class LineLimits:
    #: A line goes if more distinct documents of its host hold it than both of these allow.  The share decides
    #: alike at every size; the count only spares lines that a few documents happen to share.
    max_docs: int = 5
    max_share: float = 0.005
    #: A document is depleted if fewer words remain, or more than this share is removed.
    min_words: int = 50
    max_removed: float = 0.5


def line_key(line: bytes) -> bytes | None:
    """128-bit hash of a normalised line; None if it has no word."""
    words = line.translate(_FOLD).split()
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def _lines(text: bytes) -> list[dict]:
    """Each distinct normalised line with its words over all its occurrences in the text."""
    found: dict[bytes, int] = {}
    for line in text.split(b"\n"):
        if key := line_key(line):
            found[key] = found.get(key, 0) + len(line.split())
    return [{"h": h, "w": w} for h, w in found.items()]


def _repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    twice = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def _figures(text: str) -> tuple:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen = Counter(line for line in raw.split(b"\n") if line.split())
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            sum(seen.values()) - len(seen), _repeat_words(words), _lines(raw))


def _figure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 5 + [pa.list_(pa.struct([("h", pa.binary()), ("w", pa.int32())]))]
    names = [f.split()[0] for f in BASE_FIELDS.split(", ")] + ["lines"]
    for batch in batches:
        made = list(zip(*map(_figures, batch["text_"].to_pylist()), strict=True)) or [()] * 6
        kept = [(n, batch[n]) for n in batch.schema.names if n != "text_"]
        new = [(n, pa.array(list(col), k)) for n, col, k in zip(names, made, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([c for _, c in kept + new], names=[n for n, _ in kept + new])


def _text_id() -> Column:
    return F.unhex(F.md5(text_or_empty().cast("binary")))


def figures(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host key, text hash, the base figures and the hashed lines; staged, one pass over the texts."""
    bounded_batches(docs.sparkSession)
    plain = docs.select("doc_id", null_key(host).alias("host_"), _text_id().alias("tid_"), text_or_empty().alias("text_"))
    kind = dict(plain.dtypes)["doc_id"]
    return staged(plain.mapInArrow(
        _figure_batches, f"doc_id {kind}, host_ string, tid_ binary, {BASE_FIELDS}, lines {LINES_TYPE}"), "lines")


def frequent_lines(texts: DataFrame, limits: LineLimits) -> DataFrame:
    """(host_, h) of lines above the limits; ``texts`` has one row per distinct text of a host."""
    per_line = (texts.select("host_", F.explode("lines").alias("line"))
                .groupBy("host_", F.col("line.h").alias("h")).agg(F.count(F.lit(1)).alias("docs"))
                .where(F.col("docs") > limits.max_docs))
    sizes = texts.groupBy("host_").agg(F.count(F.lit(1)).alias("host_docs"))
    return (per_line.join(sizes, "host_").where(F.col("docs") > limits.max_share * F.col("host_docs"))
            .select("host_", "h"))


def removed_lines(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """Per distinct text that loses lines: host_, tid_, n_removed_words and the removed hashes."""
    texts = staged(rows.groupBy("host_", "tid_").agg(F.first("lines").alias("lines")), "texts")
    lost = texts.select("host_", "tid_", F.explode("lines").alias("line")).select(
        "host_", "tid_", F.col("line.h").alias("h"), F.col("line.w").alias("w"))
    return (lost.join(frequent_lines(texts, limits), ["host_", "h"])
            .groupBy("host_", "tid_").agg(F.sum("w").alias("n_removed_words"), F.collect_list("h").alias("removed")))


def _verdict(limits: LineLimits) -> list[Column]:
    words, lost = F.col("n_words"), F.col("n_removed_words")
    failed = (words < 50) | (100 * F.col("n_repeat_words") > 50 * words)
    depleted = (words - lost < limits.min_words) | (lost > limits.max_removed * words)
    return [failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), lost]


def line_verdicts(docs: DataFrame, host: str = "source", limits: LineLimits = LineLimits()) -> DataFrame:
    """One row per document: base figures, base_failed, kept, n_removed_words."""
    rows = figures(docs, host)
    lost = removed_lines(rows, limits).select("host_", "tid_", "n_removed_words")
    joined = rows.drop("lines").join(lost, ["host_", "tid_"], "left").fillna(0, ["n_removed_words"])
    return joined.select("doc_id", *[f.split()[0] for f in BASE_FIELDS.split(", ")], *_verdict(limits))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text_"].to_pylist()
        for i, gone in enumerate(batch["gone_"].to_pylist()):
            if gone:
                drop = set(gone)
                raw = texts[i].encode("utf-8", "surrogatepass")
                texts[i] = b"\n".join(x for x in raw.split(b"\n") if line_key(x) not in drop).decode("utf-8", "surrogatepass")
        names = [n for n in batch.schema.names if n != "gone_"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()) if n == "text_" else batch[n] for n in names], names=names)


def clean(docs: DataFrame, host: str = "source", limits: LineLimits = LineLimits()) -> DataFrame:
    """The kept documents, all columns of ``docs``, without the removed lines."""
    rows = figures(docs, host)
    lost = removed_lines(rows, limits)
    verdicts = (rows.drop("lines").groupBy("host_", "tid_").agg(F.first("n_words").alias("n_words"),
                                                               F.first("n_repeat_words").alias("n_repeat_words"))
                .join(lost, ["host_", "tid_"], "left").fillna(0, ["n_removed_words"])
                .select("host_", "tid_", F.col("removed").alias("gone_"), *_verdict(limits))
                .where("kept").select("host_", "tid_", "gone_"))
    h, t = fresh(docs, "host__", "tid__")
    kept = (docs.withColumns({h: null_key(host), t: _text_id()}).alias("d")
            .join(verdicts.alias("v"), (F.col(f"d.{h}") == F.col("v.host_")) & (F.col(f"d.{t}") == F.col("v.tid_"))))
    others = [c for c in docs.columns if c.lower() != "text"]
    plain = kept.select(F.struct(*[F.col(f"d.`{c}`") for c in others]).alias("others_"),
                        F.coalesce(F.col("d.text"), F.lit("")).alias("text_"), F.col("v.gone_").alias("gone_"))
    kinds = plain.select("others_", "text_").schema
    done = plain.mapInArrow(_without, kinds)
    return done.select(*[F.col("text_").alias(c) if c.lower() == "text" else F.col(f"others_.`{c}`").alias(c) for c in docs.columns])
