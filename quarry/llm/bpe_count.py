"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token's symbols form a doubly linked list; a heap holds its adjacent pairs
by (rank, position).  The lowest pair is popped and merged, pairs that a merge
has made stale are skipped, and the count is the initial symbols minus the
merges: no identifier is ever looked up.

The tokenizer file says how texts are normalised and split.  Texts below U+0250
without special strings are lower-cased and split by the file's pattern; of all
others the library's own normaliser and splitter take the white-space chunks one by
one (neither looks across ASCII white space).  Counts are kept in tables of bounded size.
Everything is one pass over the texts without a shuffle.

Defined cases: null text counts as empty (0 bytes, 0 tokens); a special token's
string inside a text counts 1 as the library's default has it; repeated rows give
a row each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, text_or_empty
from quarry.llm.pieces import EXOTIC, Memo, byte_level

#: Distinct pre-tokens, and distinct chunks of other texts, kept in each of a worker's two generations.
MEMO = 400_000
#: The file's splitting pattern (fixed value, public), for lower-case texts without exotic characters.
PATTERN = re.compile(r"'(?:[stmd]|re|ve|ll)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


class HeapCounter:
    """Counts tokens of texts as the given ``tokenizers`` file splits and merges them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        model, lib = spec["model"], Tokenizer.from_file(path)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.normalizer, self.splitter = lib.normalizer, lib.pre_tokenizer
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.words = Memo(lambda word: self.merged(byte_level(word)), MEMO)
        self.chunks = Memo(self.chunk, MEMO // 8)

    def merged(self, word: str) -> int:
        """Tokens of one pre-token."""
        sym: list[str | None] = list(word)
        n = len(sym)
        if not n:
            return 0
        sym[-1] += self.suffix
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if sym[i] == a else n
            if j >= n or sym[j] != b:
                continue  # a merge has changed one of the two
            sym[i], sym[j] = a + b, None
            after[i] = k = after[j]
            merges += 1
            if k < n:
                before[k] = i
                if (r := ranks.get((sym[i], sym[k]))) is not None:
                    heapq.heappush(heap, (r, i, sym[i], sym[k]))
            h = before[i]
            if h >= 0 and (r := ranks.get((sym[h], sym[i]))) is not None:
                heapq.heappush(heap, (r, h, sym[h], sym[i]))
        return n - merges

    def chunk(self, raw: bytes) -> int:
        """Tokens of a piece of text without ASCII white space, split by the library."""
        text, total = raw.decode("utf-8", "replace"), 0
        parts = [text]
        if self.special:
            total = len(self.special.findall(text))
            parts = self.special.split(text) if total else parts
        for part in parts:
            plain = self.normalizer.normalize_str(part) if self.normalizer else part
            total += sum(self.merged(word) for word, _ in self.splitter.pre_tokenize_str(plain))
        return total

    def count(self, text: str) -> int:
        if EXOTIC.search(text) or self.special and self.special.search(text):
            return sum(map(self.chunks.__getitem__, text.encode("utf-8", "replace").split()))
        return sum(map(self.words.__getitem__, PATTERN.findall(text.lower())))


@lru_cache(maxsize=2)
def heap_counter(path: str) -> HeapCounter:
    return HeapCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text; ``path``: a tokenizers JSON file that every executor has."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = heap_counter(path)
        for batch in texts:
            yield batch.map(counter.count).astype("int64")

    return (docs.select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"),
                        tokens(text_or_empty()).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
