"""Phrase collocation mining with broadcast double-array tries.

Texts are folded and cut into pieces once and stored as blocks of about a megabyte, each of one
language.  Levels go Apriori-wise.  Frequent words come from a count.  From then on a pass over
the blocks takes a double-array trie of the candidate phrases of ``k`` words (key: language, tab, phrase):
numpy advances the states of all text positions together, byte by byte, until they die or
accept; accepting states are bincounted in the task and the tasks' counts are summed.  The same pass
gathers the candidates of ``k + 1`` words: an accepted phrase, and the 32-bit hash of the word that follows, where
the last ``k`` words may be a candidate too (a bit table of hashes of fixed size answers that); pairs seen
too rarely can't become frequent, as a hash only ever adds to a count.  The hash is turned back into
words by a join with the frequent words, and each candidate's own last ``k`` words must be frequent.

Candidates grow with the data, tries don't: they are cut by a hash into shards of at most about
``TRIE_BYTES`` of phrases and built in tasks.  A position walks only the trie of the shard that the hash of its words names.
Up to ``WAVE`` tries are broadcast and walked where the text lies.  More of them would be read again for every stretch of text, or the text
again for every wave of tries, and both grow with the data; so beyond that the phrases go to their trie: each block is read
once, its distinct phrases that may be candidates move, with how often they occur, to a task that holds their shard's trie.
A task holds one trie, ``AT_ONCE`` bytes of text and at most ``PENDING`` waiting pairs.

Scores are exact (38-digit decimals, whole division), ranks by score, count and phrase.

Defined cases: null text is empty; null language is ``und``; texts without words give nothing; repeated
rows count as often as they occur; a piece shorter than a phrase holds none; ties go by phrase in byte order; an
empty table gives an empty result; further columns are ignored.  A text of any length is read whole:
a block holds at least one text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from quarry.llm.common import bounded_batches, discard, shared_path, staged, text_or_empty

MIN_COUNT, MAX_WORDS, TOP, SHADOW = 10, 3, 2000, 50
#: Bytes of a stored block, of waiting blocks in a task, and of the phrases of one trie, about.
BLOCK, WAITING, TRIE_BYTES = 1 << 20, 4 << 20, 1 << 20
#: Most tries that are broadcast, and bytes of text that walk a trie before the next one is loaded.
WAVE, AT_ONCE = 8, 2 << 20
#: Tasks a core among which the phrases are dealt that go to their tries.
DEALT = 4
#: Bytes hashed together.
HASHED = 1 << 18
#: Distinct words, and pairs of phrase and next word, that a task holds before it hands them on.
WORDS_HELD, PENDING = 100_000, 1_000_000
#: Bits of the table that says whether a phrase may be a candidate.
FILTER_BITS = 25
SPACE, END = 0x20, 0x0A

_FOLD = bytes(END if chr(i) in ".,;:!?\n\x0b\x0c\r" else SPACE if i == 9 else i for i in range(256)).lower()
_PRIME = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def normal(text: str) -> bytes:
    """Pieces joined by line ends, their words by single spaces, A-Z in lower case."""
    raw = re.sub(rb"  +", b" ", text.encode("utf-8", "surrogatepass").translate(_FOLD))
    return re.sub(rb" ?\n[ \n]*", b"\n", raw).strip(b" \n")


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()

    def out(langs: list[str]) -> pa.RecordBatch:
        whole = [b"\n".join(held.pop(x)) for x in langs]
        for x in langs:
            del sizes[x]
        words = [b.count(b" ") + b.count(b"\n") + 1 for b in whole]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.int64()), pa.array(whole, pa.binary())],
                                          names=["lang", "n_words", "block"])

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if raw := normal(text):
                held.setdefault(lang, []).append(raw)
                sizes[lang] += len(raw) + 1
                if sizes[lang] >= BLOCK:
                    yield out([lang])
        if sum(sizes.values()) >= WAITING:
            yield out(list(held))
    if held:
        yield out(list(held))


def blocks(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """lang, n_words, block: the folded texts; staged."""
    bounded_batches(docs.sparkSession)
    plain = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    return staged(plain.mapInArrow(_block_batches, "lang string, n_words long, block binary"), "blocks")


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def out() -> pa.RecordBatch:
        rows = [(lang, word, n) for lang, c in counts.items() for word, n in c.items()]
        langs, words, n = zip(*rows, strict=True)
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                                          names=["lang", "phrase", "n"])

    for batch in batches:
        for lang, block in zip(batch["lang"].to_pylist(), batch["block"].to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(block.split())
            if sum(map(len, counts.values())) >= WORDS_HELD:
                yield out()
    if counts:
        yield out()


# Hashes: only for upper bounds and filters, so collisions cost time, never results.

_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        for name, p in (("up", _PRIME), ("down", pow(_PRIME, -1, 1 << 64))):
            run = np.full(n, p, np.uint64)
            run[0] = 1
            _POWERS[name] = np.multiply.accumulate(run)
    return _POWERS["up"], _POWERS["down"]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def word_hashes(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words text[start:end], from prefix sums of a polynomial."""
    out = np.zeros(len(start), np.uint64)
    i = 0
    while i < len(start):
        low = start[i]
        j = max(i + 1, int(np.searchsorted(end, low + HASHED, side="right")))
        up, down = _powers(max(HASHED, int(end[j - 1] - low)) + 1)
        part = text[low : end[j - 1]].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[: len(part)], dtype=np.uint64)])
        out[i:j] = (sums[end[i:j] - low] - sums[start[i:j] - low]) * down[start[i:j] - low]
        i = j
    return _mixed(out)


def _phrase_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k words from each position on (``len(words) - k + 1`` of them)."""
    n = len(words) - k + 1
    out = words[:n].copy()
    for j in range(1, k):
        out = out * np.uint64(_PRIME) + words[j : n + j]
    return _mixed(out)


def _bounds(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with line ends around them, and start, end and "the next word is in the same piece" of its words."""
    text = np.frombuffer(b"\n" + block + b"\n", np.uint8)
    cuts = ((text == SPACE) | (text == END)).nonzero()[0]
    return text, cuts[:-1] + 1, cuts[1:], text[cuts[1:]] == SPACE


def _hashes_of(phrases: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes of phrases, one after the other, and the place of each phrase's first word."""
    text, start, end, _ = _bounds(b"\n".join(phrases))
    first = (text[start - 1] == END).nonzero()[0]
    return word_hashes(text, start, end), first


def _may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - FILTER_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


# The double array

class Trie:
    """A double array: cell t holds (parent cell + 1) << 32 | base, and base + byte is the child's cell.

    The byte 0x0A ends a key; the cell it leads to holds the key's number as its base.
    """

    def __init__(self, nodes: np.ndarray):
        self.nodes = nodes

    @classmethod
    def build(cls, keys: list[bytes]) -> Trie:
        """Keys (no 0x0A before the tab of a key matters) numbered as they come; level by level, all nodes of a level at once."""
        order = sorted(range(len(keys)), key=keys.__getitem__)
        text = np.frombuffer(b"".join(keys[i] + b"\n" for i in order), np.uint8)
        size = np.array([len(keys[i]) + 1 for i in order], np.int64)
        number = np.array(order, np.int64)
        at = np.cumsum(size) - size
        rng = np.random.default_rng(1)
        nodes = np.zeros(max(1024, 2 * len(keys)), np.int64)
        claim = np.zeros(len(nodes), np.int32)
        nodes[0] = np.int64(1) << 32  # the root, cell 0, is its own parent: no other cell matches it
        used, level = 1, 0
        cell = np.zeros(len(keys), np.int64)  # of each key's node at this level
        while len(cell):
            byte = text[at + level].astype(np.int64)
            child = np.concatenate([[True], (cell[1:] != cell[:-1]) | (byte[1:] != byte[:-1])])  # keys are sorted
            first = child.nonzero()[0]
            parent, bytes_ = cell[first], byte[first]
            start = np.concatenate([[True], parent[1:] != parent[:-1]]).nonzero()[0]
            count = np.diff(np.append(start, len(first)))
            used += len(first)
            base = np.zeros(len(start), np.int64)
            open_, low, rounds = np.arange(len(start)), 0, 0
            while len(open_):
                if 4 * used > 3 * (len(nodes) - 256) or rounds % 32 == 31:  # crowded, or wide nodes find no gap
                    low = len(nodes) - 256 if rounds else 0
                    grown = np.zeros(max(len(nodes) * 9 // 8 + 1024, 4 * used // 3 + 512), np.int64)
                    grown[: len(nodes)] = nodes
                    nodes, claim = grown, np.zeros(len(grown), np.int32)
                rounds += 1
                guess = rng.integers(max(low, 1), len(nodes) - 256, len(open_))
                m = count[open_]
                owner = np.repeat(np.arange(len(open_)), m)
                begins = np.cumsum(m) - m
                which = np.arange(len(owner)) - np.repeat(begins, m) + np.repeat(start[open_], m)
                cells = guess[owner] + bytes_[which]
                free = np.logical_and.reduceat(nodes[cells] == 0, begins)
                mine = free[owner]
                claim[cells[mine]] = owner[mine]
                won = free & np.logical_and.reduceat(~mine | (claim[cells] == owner), begins)
                take = won[owner]
                nodes[cells[take]] = (parent[which[take]] + 1) << 32
                base[open_[won]] = guess[won]
                open_ = open_[~won]
            parents = parent[start]
            nodes[parents] |= base
            cell = (np.repeat(base, count) + bytes_)[np.cumsum(child) - 1]
            level += 1
            done = size == level
            nodes[cell[done]] |= number[done]
            on = ~done
            cell, at, size, number = cell[on], at[on], size[on], number[on]
        return cls(nodes)

    def walk(self, prefix: bytes) -> int | None:
        """The cell that ``prefix`` leads to."""
        cell = 0
        for byte in prefix:
            to = int(self.nodes[cell] & 0xFFFFFFFF) + byte
            if to >= len(self.nodes) or int(self.nodes[to]) >> 32 != cell + 1:
                return None
            cell = to
        return cell

    def accept(self, text: np.ndarray, lang: str, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The number of the key that text[start:stop] is under ``lang``, -1 for none; all positions advance together."""
        out = np.full(len(start), -1, np.int64)
        root = self.walk(lang.encode("utf-8", "surrogatepass") + b"\t")
        if root is None or not len(start):
            return out
        alive, at, stop = np.arange(len(start)), start.astype(np.int64), stop.astype(np.int64)
        cell = np.full(len(start), root, np.int64)
        base = np.full(len(start), self.nodes[root] & 0xFFFFFFFF, np.int64)
        while len(alive):
            ends = at == stop
            to = base + np.where(ends, END, text[at])
            node = self.nodes[to]
            hit = node >> 32 == cell + 1
            over = hit & ends
            out[alive[over]] = node[over] & 0xFFFFFFFF
            on = (hit & ~ends).nonzero()[0]
            alive, at, stop, cell, base = alive[on], at[on] + 1, stop[on], to[on], node[on] & 0xFFFFFFFF
        return out


def _build(group: pd.DataFrame) -> pd.DataFrame:
    """One shard's trie, and how many phrases it has; phrases are numbered as they come, by language, then phrase."""
    keys = [f"{lang}\t{p}".encode("utf-8", "surrogatepass") for lang, p in zip(group["lang"], group["phrase"], strict=True)]
    trie = Trie.build([keys[i] for i in np.argsort(group["number"].to_numpy())])
    return pd.DataFrame({"shard": [group["shard"].iloc[0]], "n": [len(group)], "nodes": [trie.nodes.tobytes()]})


@F.pandas_udf(LongType())
def _phrase_hash(phrases: pd.Series) -> pd.Series:
    """The hash that names a phrase's shard and its bit, as a task takes it from the text (all phrases have as many words)."""
    if not len(phrases):
        return pd.Series([], dtype="int64")
    words, first = _hashes_of([p.encode("utf-8", "surrogatepass") for p in phrases])
    return pd.Series(_phrase_hashes(words, phrases.iloc[0].count(" ") + 1)[first].view(np.int64))


def _bit_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits, some = np.zeros(1 << (FILTER_BITS - 3), np.uint8), False
    for batch in batches:
        at = batch["hash"].to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)
        np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        some = some or len(at) > 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])


def shards(phrases: DataFrame, trie_bytes: int = TRIE_BYTES) -> tuple[DataFrame, DataFrame, int]:
    """Numbered phrases (shard, number, lang, phrase, hash), the shards' tries, and the number of shards."""
    size = F.octet_length("phrase") + F.octet_length("lang") + 2
    total = phrases.agg(F.sum(size)).first()[0]
    if not total:
        return phrases, phrases, 0
    n = -(-total // trie_bytes)
    hashed = phrases.select("lang", "phrase", _phrase_hash("phrase").alias("hash"))
    cut = hashed.withColumn("shard", F.pmod(F.shiftrightunsigned("hash", 8), F.lit(n)))
    place = Window.partitionBy("shard").orderBy("lang", "phrase")  # a shard's size is bounded
    numbered = staged(cut.withColumn("number", F.row_number().over(place) - 1), "phrases")
    tries = staged(numbered.groupBy("shard").applyInPandas(_build, "shard long, n long, nodes binary"), "tries")
    return numbered, tries, n


def _out(shard: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(keys), 1 << 16):
        part = keys[i : i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), shard)), pa.array(part), pa.array(n[i : i + (1 << 16)].astype(np.int64))],
                                         names=["shard", "key", "n"])


def _may_be(block: bytes, k: int, bits: np.ndarray) -> tuple | None:
    """What ``_bounds`` finds, the hashes of the words and of the k words from each on, and the places where these may be a candidate."""
    text, start, end, on = _bounds(block)
    if len(start) < k:
        return None
    inside = np.ones(len(start) - k + 1, bool)  # the k words from here on are in one piece
    for j in range(k - 1):
        inside &= on[j : len(inside) + j]
    words = word_hashes(text, start, end)
    phrases = _phrase_hashes(words, k)
    return text, start, end, on, words, phrases, (inside & _may_hold(bits, phrases)).nonzero()[0]


def _pass(table, tries: dict, n: int, k: int, counting: bool, more: bool):
    """The task function: (shard, key, n) rows; key -1 - number: a phrase's count, else phrase number << 32 | hash of the next word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        counts: dict[int, np.ndarray] = {}
        waiting: dict[int, list[np.ndarray]] = {}

        def hand_on() -> Iterator[pa.RecordBatch]:
            for shard in list(waiting):
                yield from _out(shard, *np.unique(np.concatenate(waiting.pop(shard)), return_counts=True))

        def walk(held: list[tuple]) -> None:
            for shard, kept in tries.items() if held else ():
                size, nodes = kept.value
                trie = Trie(nodes)
                for lang, text, start, end, on, words, phrases, at in held:
                    own = at[(phrases[at] >> np.uint64(8)) % np.uint64(n) == shard]
                    number = trie.accept(text, lang, start[own], end[own + k - 1])
                    own, number = own[number >= 0], number[number >= 0]
                    if counting:
                        counts.setdefault(shard, np.zeros(size, np.int64))
                        counts[shard] += np.bincount(number, minlength=size)
                    if more:
                        follows = own + 1 < len(phrases)
                        own, number = own[follows], number[follows]
                        follows = on[own + k - 1] & _may_hold(bits, phrases[own + 1])
                        waiting.setdefault(shard, []).append(
                            number[follows] << 32 | (words[own[follows] + k] >> np.uint64(32)).astype(np.int64))
                del trie, nodes
                if len(tries) > 1:
                    del kept._value  # one trie at a time: the next use reads it from the executor's disk again

        held, size = [], 0
        for batch in batches:
            for lang, block in zip(batch["lang"].to_pylist(), batch["block"].to_pylist(), strict=True):
                if (found := _may_be(block, k, bits)) is None:
                    continue
                held.append((lang, *found))
                size += len(found[0])
                if size >= AT_ONCE:
                    walk(held)
                    held, size = [], 0
                    if sum(len(x) for parts in waiting.values() for x in parts) >= PENDING:
                        yield from hand_on()
        walk(held)
        yield from hand_on()
        for shard, found in counts.items():
            seen = found.nonzero()[0]
            yield from _out(shard, -1 - seen, found[seen])

    return run


# Phrases that go to their tries.  A row has a trie (its cells in ``text``, the number of its phrases in ``n``), or of a stretch of text the
# distinct phrases of a shard (``sizes``, ``text``), how often they occur (``counts``), and for each of them (``follow`` of them) the
# distinct hashes of the next word (``hashes``) and how often these occur (``times``).

SENT = ("shard long, part int, phrases boolean, lang string, n long, "
        "sizes binary, text binary, counts binary, follow binary, hashes binary, times binary")
_PARTS = ("sizes", "text", "counts", "follow", "hashes", "times")


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers, all first bytes before all second ones and so on: those of small numbers shrink to little when they are compressed."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _distinct(text: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct strings text[first:last] in the order they come: their number at each place, their sizes and their bytes."""
    size = last - first
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    raw = np.empty(offsets[-1], np.uint8)
    for i in range(0, len(size), 1 << 15):
        j = min(len(size), i + (1 << 15))
        raw[offsets[i] : offsets[j]] = text[np.arange(offsets[i], offsets[j]) + np.repeat(first[i:j] - offsets[i:j], size[i:j])]
    found = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
    buffers = found.dictionary.buffers()
    ends = np.frombuffer(buffers[1], np.int64, len(found.dictionary) + 1)
    return found.indices.to_numpy(), np.diff(ends), np.frombuffer(buffers[2], np.uint8, ends[-1])


def _send(table, n: int, k: int, more: bool, parts: int):
    """The task function that cuts the phrases of ``AT_ONCE`` bytes of text, about, by the shards they go to."""
    types = pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("phrases", pa.bool_()), ("lang", pa.string()), ("n", pa.int64()),
                       *[(x, pa.binary()) for x in _PARTS]])

    def cut(lang: str, block: bytes, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = _may_be(block, k, bits)
        if found is None or not len(found[-1]):
            return
        text, start, end, on, words, phrases, at = found
        shard = ((phrases[at] >> np.uint64(8)) % np.uint64(n)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        at, shard = at[order], shard[order]
        which, sizes, raw = _distinct(text, start[at], end[at + k - 1])
        counts = np.bincount(which, minlength=len(sizes))
        home = np.zeros(len(sizes), np.int64)
        home[which] = shard  # in order, as the places are
        pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if more:
            follows = at + 1 < len(phrases)
            at, which = at[follows], which[follows]
            follows = on[at + k - 1] & _may_hold(bits, phrases[at + 1])
            pairs, times = np.unique(which[follows].astype(np.int64) << 32 | (words[at[follows] + k] >> np.uint64(32)).astype(np.int64),
                                     return_counts=True)
        follow = np.bincount(pairs >> 32, minlength=len(sizes))
        to, begin = np.unique(home, return_index=True)
        cuts = np.append(begin, len(home))
        bytes_ = np.concatenate([[0], np.cumsum(sizes)])[cuts]
        held = np.concatenate([[0], np.cumsum(follow)])[cuts]
        part, rows = zlib.crc32(block) % parts, []
        for i in range(len(to)):
            a, b, c, d = cuts[i], cuts[i + 1], held[i], held[i + 1]
            rows.append({
                "shard": to[i], "part": part, "phrases": True, "lang": lang, "sizes": _planes(sizes[a:b]), "text": raw[bytes_[i] : bytes_[i + 1]].tobytes(),
                "counts": _planes(counts[a:b]), "follow": _planes(follow[a:b]), "hashes": pairs[c:d].astype("<u4").tobytes(), "times": _planes(times[c:d])})
        yield pa.RecordBatch.from_pylist(rows, schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        held: dict[str, list[bytes]] = {}
        sizes: Counter = Counter()
        for batch in batches:
            for lang, block in zip(batch["lang"].to_pylist(), batch["block"].to_pylist(), strict=True):
                held.setdefault(lang, []).append(block)
                sizes[lang] += len(block)
                if sizes[lang] >= AT_ONCE:
                    del sizes[lang]
                    yield from cut(lang, b"\n".join(held.pop(lang)), bits)
            while sizes.total() >= WAITING:
                lang = sizes.most_common(1)[0][0]
                del sizes[lang]
                yield from cut(lang, b"\n".join(held.pop(lang)), bits)
        for lang, found in held.items():
            yield from cut(lang, b"\n".join(found), bits)

    return run


def _receive(counting: bool, more: bool):
    """The task function that walks the phrases of a shard and part behind their trie: (shard, key, n) rows as those of ``_pass``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, trie, counts = None, None, np.zeros(0, np.int64)
        held: list[tuple[np.ndarray, ...]] = []  # of the language ``of``
        of, size = "", 0
        keys: list[np.ndarray] = []
        sums: list[np.ndarray] = []

        def walk() -> None:
            nonlocal size
            sizes, text, n, follow, hashes, times = (np.concatenate(x) for x in zip(*held, strict=True))
            stop = np.cumsum(sizes)
            number = trie.accept(np.append(text, np.uint8(END)), of, stop - sizes, stop)
            if counting:
                counts[:] += np.bincount(number[number >= 0], n[number >= 0], len(counts)).astype(np.int64)  # exact: far below 2^53
            if more:
                own = np.repeat(number, follow)
                keys.append(own[own >= 0] << 32 | hashes[own >= 0])
                sums.append(times[own >= 0])
            held.clear()
            size = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            found, place = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(place, np.concatenate(sums))
            keys.clear()
            sums.clear()
            yield from _out(at[0], found, n)

        def over() -> Iterator[pa.RecordBatch]:
            if held:
                walk()
            if keys:
                yield from hand_on()
            seen = counts.nonzero()[0]
            yield from _out(at[0], -1 - seen, counts[seen])

        for batch in batches:
            for i in range(batch.num_rows):
                shard, part, phrases, lang = (batch[x][i].as_py() for x in ("shard", "part", "phrases", "lang"))
                if not phrases:
                    if at:
                        yield from over()
                    at, trie = (shard, part), Trie(np.frombuffer(batch["text"][i].as_py(), np.int64))
                    counts = np.zeros(batch["n"][i].as_py() if counting else 0, np.int64)
                    continue
                if at != (shard, part):
                    continue  # a shard without phrases has no trie
                if held and (lang != of or size >= AT_ONCE):
                    walk()
                    if sum(map(len, keys)) >= PENDING:
                        yield from hand_on()
                of = lang
                sizes, text, n, follow, hashes, times = (batch[x][i].as_py() for x in _PARTS)
                held.append((_from_planes(sizes), np.frombuffer(text, np.uint8), _from_planes(n), _from_planes(follow),
                             np.frombuffer(hashes, "<u4").astype(np.int64), _from_planes(times)))
                size += len(text) + 2 * len(hashes)
        if at:
            yield from over()

    return run


def _walked_apart(cut: DataFrame, table, tries: DataFrame, n: int, k: int, counting: bool, more: bool) -> DataFrame:
    """(shard, key, n) of all blocks, read once: their phrases move to the tries."""
    tasks = DEALT * cut.sparkSession.sparkContext.defaultParallelism
    parts = -(-tasks // n)
    sent = cut.select("lang", "block").mapInArrow(_send(table, n, k, more, parts), SENT)
    ready = tries.select("shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(False).alias("phrases"),
                         "n", F.col("nodes").alias("text"))
    both = sent.unionByName(ready, allowMissingColumns=True)
    return (both.repartition(max(tasks, n), "shard", "part").sortWithinPartitions("shard", "part", "phrases", "lang")
            .mapInArrow(_receive(counting, more), "shard long, key long, n long"))


def _passes(cut: DataFrame, phrases: DataFrame, k: int, counting: bool, more: bool, min_count: int,
            trie_bytes: int) -> tuple[DataFrame, DataFrame] | None:
    """(lang, phrase, f) of the frequent ones of ``phrases``, and (lang, phrase, next_hash) that may be frequent with one word more."""
    spark = cut.sparkSession
    context = spark.sparkContext
    numbered, tries, n = shards(phrases, trie_bytes)
    if not n:
        return None
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "65536")
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in numbered.select("hash").coalesce(4).mapInArrow(_bit_table, "bits binary").toLocalIterator():
        bits |= np.frombuffer(row.bits, np.uint8)
    table = context.broadcast(bits)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # rows here are whole blocks
    path = shared_path(spark, f"counts{k}")
    schema = "shard long, key long, n long"
    held = {}
    for shard in range(n if n <= WAVE else 0):
        row = tries.where(F.col("shard") == shard).first()
        if row is not None:
            held[shard] = context.broadcast((row.n, np.frombuffer(row.nodes, np.int64)))
        del row
    if n > WAVE:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")  # the parts of a block that go to one shard
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(AT_ONCE))
        found = _walked_apart(cut, table, tries, n, k, counting, more)
    else:
        found = cut.select("lang", "block").mapInArrow(_pass(table, held, n, k, counting, more), schema)
    found.groupBy("shard", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).write.parquet(path)
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    for one in [*held.values(), table]:
        one.destroy()
    discard_all(spark, tries)
    sums = spark.read.schema(schema).parquet(path)
    counted = (sums.where(F.col("key") < 0).select("shard", (-1 - F.col("key")).alias("number"), F.col("n").alias("f"))
               .join(numbered, ["shard", "number"]).select("lang", "phrase", "f"))
    grown = (sums.where(F.col("key") >= 0)
             .select("shard", F.shiftrightunsigned("key", 32).alias("number"), F.col("key").bitwiseAND(0xFFFFFFFF).alias("next_hash"))
             .join(numbered, ["shard", "number"]).select("lang", "phrase", "next_hash"))
    return counted, grown


@F.pandas_udf(LongType())
def _word_hash(words: pd.Series) -> pd.Series:
    if not len(words):
        return pd.Series([], dtype="int64")
    hashes, _ = _hashes_of([w.encode("utf-8", "surrogatepass") for w in words])
    return pd.Series((hashes >> np.uint64(32)).astype(np.int64))


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, lang: str = "lang",
                  trie_bytes: int = TRIE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of 1 to ``max_words`` words with f >= min_count; (lang, n) of all words.

    Both are staged.
    """
    spark = docs.sparkSession
    cut = blocks(docs, lang)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # rows here are whole blocks
    totals = staged(cut.groupBy("lang").agg(F.sum("n_words").alias("n")), "totals")
    words = staged(cut.select("lang", "block").mapInArrow(_word_batches, "lang string, phrase string, n long")
                   .groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count), "words")
    bounded_batches(spark)
    lexicon = staged(words.select("lang", F.col("phrase").alias("word"), _word_hash("phrase").alias("next_hash")), "lexicon")
    levels, candidates = [words], words
    for k in range(1, max_words + 1):
        made = _passes(cut, candidates, k, k > 1, k < max_words, min_count, trie_bytes)
        bounded_batches(spark)
        if made is None:
            break
        counted, grown = made
        if k > 1:
            levels.append(staged(counted, f"level{k}"))
        if k < max_words:
            frequent = levels[-1]
            longer = (grown.join(frequent.select("lang", "phrase"), ["lang", "phrase"], "left_semi")
                      .join(lexicon, ["lang", "next_hash"])
                      .select("lang", F.concat_ws(" ", "phrase", "word").alias("phrase")))
            tail = F.expr("substring(phrase, locate(' ', phrase) + 1)")
            able = longer.withColumn("tail", tail).join(frequent.select("lang", F.col("phrase").alias("tail")), ["lang", "tail"], "left_semi")
            candidates = staged(able.select("lang", "phrase"), f"candidates{k + 1}")
    every = levels[0].withColumn("words", F.lit(1))
    for k, level in enumerate(levels[1:], 2):
        every = every.unionByName(level.withColumn("words", F.lit(k)))
    made = staged(every, "frequent")
    discard_all(spark, cut)
    return made, totals


def discard_all(spark, *tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            discard(spark, folder)


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score of every phrase of two words or more, by its lowest-scoring cut."""
    several = counts.where(F.col("words") > 1).withColumn("parts", F.split("phrase", " "))
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "words", F.col("f").alias("a"), "k",
        F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.col("words")), " ").alias("right"))
    joined = (cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
              .join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]))
    exact = F.expr("(1000000BD * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    best = joined.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, shadow: int = SHADOW,
                 lang: str = "lang", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases that no longer candidate covers to ``shadow`` %."""
    counts, totals = phrase_counts(docs, min_count, max_words, lang, trie_bytes)
    found = staged(scored(counts), "scored")
    parts = found.where(F.col("words") > 2).withColumn("parts", F.split("phrase", " "))
    inner = (parts.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
             .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
             .groupBy("lang", F.array_join(F.slice("parts", F.col("at"), F.col("size")), " ").alias("phrase"))
             .agg(F.max("a").alias("longer")))
    kept = (found.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < shadow * F.col("a"))))
    place = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    # Spark keeps the first rows of each task before it moves any to their language.
    ranked = kept.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
