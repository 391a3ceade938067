"""Splitting texts into a tokenizer's pre-tokens fast, and remembering what each gives."""

from __future__ import annotations

import re
from collections.abc import Callable

#: Characters on whose class Python's and the tokenizers' regular expressions may differ:
#: beyond U+024F, separators that Python counts as white space, and numbers that aren't digits.
EXOTIC = re.compile("[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")


def byte_alphabet() -> dict[int, str]:
    """Code of a byte -> the character that byte-level tokenizers write for it.

    Printable Latin-1 bytes stand for themselves, the others get the characters from U+0100 on.
    """
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_ALPHABET = byte_alphabet()


def byte_level(piece: str) -> str:
    return piece.encode("utf-8", "replace").decode("latin-1").translate(_ALPHABET)


class Memo(dict):
    """Values of ``make`` by key; at most two generations of ``size`` keys, used keys move to the young one."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
