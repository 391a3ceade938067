"""Language identification by hyperdimensional profiles.

Every letter (and the space at word borders) has a random vector of +1 and -1,
made from its code point and a seed.  A trigram's vector binds (multiplies) its
letters' vectors, permuted (rotated) by their place; a text's profile bundles
(adds) the vectors of its trigrams; a language's prototype bundles its documents'
unit profiles.  A text gets the language of the nearest prototype by cosine.

Prototypes are learned from a bounded sample (``max_docs`` labelled documents a
language, expected, picked by a hash of the id); the documents' unit profiles are added as
integers, so the sums don't depend on the order of the tasks.  What comes back to
the driver is one vector of ``DIMS`` numbers per language.  Prediction is a single
pass without a shuffle.

Defined cases: null, empty or letterless texts are ``und`` with score 0; with no
labelled text everything is ``und``; cosine ties go to the smaller language name;
repeated rows get a row each; an empty table gives an empty result; further
columns are ignored by ``identify`` and kept by ``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches

DIMS = 512
SEED = 20_011
#: Labelled documents a language that the prototypes are learned from (expected number).
MAX_DOCS = 5_000
#: Languages that can be learned; more are an error, not a cut.
MAX_LANGUAGES = 10_000
#: Unit profiles are added as multiples of 2**-20.
UNIT = 1 << 20
#: Letters of text that are counted at a time in a Python worker.
CHUNK = 1_000_000
UND = "und"
_SPACE = 0x20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1 << 15)
def letter_vector(code: int) -> np.ndarray:
    return np.random.Generator(np.random.Philox(key=[SEED, code])).choice(np.array([-1, 1], np.int8), DIMS)


def trigram_vectors(grams: np.ndarray) -> np.ndarray:
    """grams: rows of three code points. Rows of bound letter vectors, as float32."""
    codes, place = np.unique(grams, return_inverse=True)
    place = place.reshape(grams.shape)
    table = np.stack([letter_vector(int(c)) for c in codes]) if len(codes) else np.zeros((0, DIMS), np.int8)
    bound = np.roll(table, 2, axis=1)[place[:, 0]]
    bound *= np.roll(table, 1, axis=1)[place[:, 1]]
    bound *= table[place[:, 2]]
    return bound.astype(np.float32)


def _codes(text: str) -> np.ndarray:
    """Lower-case letters of the text, runs of anything else as one space, one space at both ends."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(_letters()[code], code, _SPACE)
    inner = code == _SPACE
    return code[np.concatenate(([True], ~(inner[1:] & inner[:-1])))]


def _profiles(codes: list[np.ndarray]) -> np.ndarray:
    """Bundled trigram vectors of each text of a chunk."""
    out = np.zeros((len(codes), DIMS), np.float32)
    grams = [max(0, len(c) - 2) for c in codes]
    if not sum(grams):
        return out
    doc = np.repeat(np.arange(len(codes)), grams)
    flat, back = np.unique(np.concatenate(codes), return_inverse=True)
    ends = np.cumsum([len(c) for c in codes])
    small = [back[e - len(c) : e] for c, e in zip(codes, ends, strict=True)]
    size = len(flat)
    key = np.concatenate([(c[:-2].astype(np.int64) * size + c[1:-1]) * size + c[2:] for c in small if len(c) > 2])
    if size**3 <= 1 << 24:
        there = np.zeros(size**3, bool)
        there[key] = True
        found = there.nonzero()[0]
        number = np.zeros(size**3, np.int32)
        number[found] = np.arange(len(found))
        which = number[key]
    else:
        found, which = np.unique(key, return_inverse=True)
    vectors = trigram_vectors(flat[np.stack([found // size**2, found // size % size, found % size], axis=1)])
    # texts by texts, so that the table of counts stays small beside the vectors
    step = max(1, (1 << 22) // max(1, len(found)))
    first = np.searchsorted(doc, np.arange(0, len(codes) + step, step))
    for n, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        rows = min(step, len(codes) - n * step)
        if rows > 0:
            count = np.bincount((doc[a:b] - n * step) * len(found) + which[a:b], minlength=rows * len(found))
            out[n * step : n * step + rows] = count.reshape(rows, -1).astype(np.float32) @ vectors
    return out


def profiles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Profiles of the texts, and which of them have a letter."""
    made, chunk, size = [], [], 0
    lettered = np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        code = _codes(text or "")
        lettered[i] = bool((code != _SPACE).any())
        size += len(code)
        if size > CHUNK and chunk:
            made.append(_profiles(chunk))
            chunk, size = [], len(code)
        chunk.append(code)
    if chunk:
        made.append(_profiles(chunk))
    return (np.concatenate(made) if made else np.zeros((0, DIMS), np.float32)), lettered


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows.astype(np.float64), axis=1, keepdims=True)
    return rows / np.where(length == 0, 1, length)


def learn(labelled: DataFrame, max_docs: int = MAX_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes, from rows (doc_id, text, lang)."""
    bounded_batches(labelled.sparkSession)
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    found = known.groupBy("lang").agg(F.least(F.lit(1.0), max_docs / F.count(F.lit(1))).alias("share")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    shares = F.broadcast(labelled.sparkSession.createDataFrame(found, "lang string, share double"))  # a row per language
    chance = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.join(shares, "lang").where(chance < F.col("share")).select("lang", "text")

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            rows, lettered = profiles(batch["text"].tolist())
            unit = np.rint(_unit(rows) * UNIT).astype(np.int64)
            for lang in batch["lang"][lettered].unique():
                total[lang] = total.get(lang, 0) + unit[lettered & (batch["lang"] == lang).to_numpy()].sum(axis=0)
        for lang, vector in total.items():
            yield pd.DataFrame({"lang": lang, "dim": np.arange(DIMS), "x": vector})

    sums = sample.mapInPandas(bundle, "lang string, dim int, x long").groupBy("lang", "dim").agg(F.sum("x").alias("x"))
    vectors = {r.lang: np.array(r.x, np.float64) for r in
               sums.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("x"))
               .collect()}  # one vector a language
    names = sorted(vectors)
    return names, _unit(np.stack([vectors[n] for n in names])) if names else np.zeros((0, DIMS))


def predictor(names: list[str], prototypes: np.ndarray):
    """A column function text -> struct(lang_pred, score)."""
    table = prototypes.astype(np.float32)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, lettered = profiles(batch.tolist())
            if not names:
                yield pd.DataFrame({"lang_pred": [UND] * len(batch), "score": np.zeros(len(batch))})
                continue
            cosine = np.round((_unit(rows) @ table.T).astype(np.float64), 6)
            best = cosine.argmax(axis=1)
            score = np.clip(cosine[np.arange(len(batch)), best], 0, 1)
            yield pd.DataFrame({"lang_pred": [names[b] if ok else UND for b, ok in zip(best, lettered, strict=True)],
                                "score": np.where(lettered, score, 0.0)})

    return predict


def held_out(buckets: int = 5, bucket: int = 0) -> Column:
    """Whether crc32 of the id as text falls in the held-out bucket (a null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % buckets == bucket


def identify(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learns from those not held out."""
    predict = predictor(*learn(docs.where(~held_out()), max_docs))
    return docs.select("doc_id", held_out().alias("held_out"), predict(F.col("text")).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, min_score: float = 0.1, max_docs: int = MAX_DOCS) -> DataFrame:
    """``docs`` without texts that have no letter or resemble no learned language."""
    predict = predictor(*learn(docs.where(~held_out()), max_docs))
    p = predict(F.col("text"))
    return docs.where((p["lang_pred"] != UND) & (p["score"] >= min_score))
