"""Byte-level BPE with a memory for pre-tokens, in front of the tokenizer library.

The library's pre-tokenizer cuts a text into runs (a blank and letters, digits, other signs,
blanks, English contractions) and encodes every run by itself. The same cuts are made here
for a whole batch with array arithmetic over code points; runs met for the first time are
encoded by the library and remembered under a 64-bit hash, so a repeated word costs a lookup.
Texts with a special token's string, or with code points this Python's Unicode tables do not
know, are given to the library whole.
"""

from __future__ import annotations

import os
import sys
import types
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from fraclake.llm.words import keys, mix

LETTER, NUMBER, BLANK, OTHER, UNKNOWN = range(5)
#: Unicode White_Space, and the contractions of the pre-tokenizer's pattern.
BLANKS = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

#: Runs remembered by one worker, some 100 bytes each; beyond it the memory starts anew.
REMEMBERED = 1_500_000
_JOINED = 64
#: Bytes of text to give to an encoder at a time; its vectors take some 50 times as much.
SLICE = 1 << 20


def of_worker() -> dict:
    """A dictionary that outlives a task within its Python worker."""
    return sys.modules.setdefault("_text_worker_memory", types.ModuleType("_text_worker_memory")).__dict__


def kinds() -> np.ndarray:
    """The class of every code point."""
    memory = of_worker()
    if "kinds" not in memory:
        of = {"L": LETTER, "N": NUMBER, "C": OTHER}
        table = np.array([of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        table[[c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]] = UNKNOWN
        table[BLANKS] = BLANK
        memory["kinds"] = table
    return memory["kinds"]


@dataclass
class Encoded:
    """Runs of all texts in order: the first run of each text (one more at the end), each run's
    first character in its text, its number of tokens, and where its ids begin in ``ids``."""

    first: np.ndarray
    char: np.ndarray
    count: np.ndarray
    place: np.ndarray
    ids: np.ndarray

    def tokens(self) -> np.ndarray:
        """Tokens of each text."""
        total = np.concatenate(([0], np.cumsum(self.count, dtype=np.int64)))
        return np.diff(total[self.first])

    def flat(self) -> np.ndarray:
        """Ids of all texts one after another."""
        count = self.count.astype(np.int64)
        begin = np.cumsum(count) - count
        return self.ids[np.arange(int(count.sum())) - np.repeat(begin - self.place, count)]


class Encoder:
    """One vocabulary in one worker."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.line_end = self.library.encode("\n", add_special_tokens=False).ids[0]
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._forget()

    @staticmethod
    def at(path: str) -> Encoder:
        memory = of_worker()
        if ("encoder", path) not in memory:
            memory["encoder", path] = Encoder(path)
        return memory["encoder", path]

    def _forget(self) -> None:
        self.known, self.count, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint16 if self.library.get_vocab_size() <= 65536 else np.uint32), 0

    def _store(self, ids: np.ndarray) -> int:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def encode(self, texts: list[str]) -> Encoded:
        """``texts`` as the library encodes them, without begin or end tokens."""
        if len(self.known) > REMEMBERED:
            self._forget()
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        rows = np.concatenate(([0], np.cumsum(lengths)))
        kind = kinds()[points]
        start = np.flatnonzero(run_starts(points, kind, rows))
        first = np.searchsorted(start, rows)
        size = np.diff(np.append(start, len(points)))
        count, place = self._look_up(points, kind, start, size)
        char = start - np.repeat(rows[:-1], np.diff(first))
        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        odd = sorted({*odd, *(np.searchsorted(rows, np.flatnonzero(kind == UNKNOWN), "right") - 1).tolist()})
        if odd:
            first, char, count, place = self._whole(texts, odd, first, char, count, place)
        return Encoded(first, char, count, place, self.ids)

    def _look_up(self, points: np.ndarray, kind: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        weights = keys(int(size.max()), 21)
        inside = np.arange(len(points)) - np.repeat(start, size)
        code = mix(np.add.reduceat(weights[inside] * (points.astype(np.uint64) + np.uint64(1)), start) + size.astype(np.uint64))
        distinct, example, back = np.unique(code, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
        new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if new.any():
            which = example[new]
            counts, places = self._learn([points[start[i]:start[i] + size[i]].tobytes().decode("utf-32-le") for i in which], kind[start[which] + size[which] - 1] == BLANK)
            place = np.searchsorted(self.known, distinct[new])
            self.known, self.count, self.place = (np.insert(old, place, more) for old, more in (
                (self.known, distinct[new]), (self.count, counts), (self.place, places)))
            at = np.searchsorted(self.known, distinct)
        return self.count[at][back], self.place[at][back]

    def _learn(self, runs: list[str], blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Let the library encode new runs: many joined by line ends, which are runs of their own."""
        counts, places = np.zeros(len(runs), np.int32), np.zeros(len(runs), np.int64)
        plain = np.flatnonzero(~blank)
        parts = [plain[lo:lo + _JOINED] for lo in range(0, len(plain), _JOINED)]
        joined = self.library.encode_batch_fast(["\n".join([runs[i] for i in part]) for part in parts], add_special_tokens=False)
        for part, encoding in zip(parts, joined):
            ids = np.array(encoding.ids)
            ends = np.append(np.flatnonzero(ids == self.line_end), len(ids))
            counts[part] = np.diff(ends, prepend=-1) - 1
            own = ids[ids != self.line_end]
            places[part] = self._store(own) + np.cumsum(counts[part]) - counts[part]
        for i in np.flatnonzero(blank):
            ids = self.library.encode(runs[i], add_special_tokens=False).ids
            counts[i], places[i] = len(ids), self._store(np.array(ids, self.ids.dtype))
        return counts, places

    def _whole(self, texts: list[str], odd: list[int], first: np.ndarray, char: np.ndarray, count: np.ndarray, place: np.ndarray) -> tuple:
        """Put the library's own tokens in the place of the runs of some texts."""
        parts, sizes, at = [], np.diff(first), 0
        for i in odd:
            encoding = self.library.encode(texts[i], add_special_tokens=False)
            lo, hi = first[i], first[i + 1]
            parts.append((char[at:lo], count[at:lo], place[at:lo]))
            begin = self._store(np.array(encoding.ids, self.ids.dtype))
            n = len(encoding.ids)
            starts = np.array([o[0] for o in encoding.offsets], np.int64)
            parts.append((starts, np.ones(n, np.int32), begin + np.arange(n)))
            sizes[i], at = n, hi
        parts.append((char[at:], count[at:], place[at:]))
        joined = [np.concatenate(x) for x in zip(*parts)]
        return np.concatenate(([0], np.cumsum(sizes))), *joined


def run_starts(points: np.ndarray, kind: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which code points begin a run of the pre-tokenizer's pattern."""
    if not len(points):
        return np.zeros(0, bool)
    begins = np.zeros(len(points) + 1, bool)
    begins[rows] = True  # texts
    begins = begins[:-1]
    blank, space = kind == BLANK, points == 32
    before, before_space = np.roll(kind, 1), np.roll(space, 1)
    start = np.where(blank, before != BLANK, np.where(before == BLANK, ~before_space, kind != before))
    # the last of several blanks leaves them if something follows in the same text
    more = np.append(~blank[1:] & ~begins[1:], False)
    start |= blank & (before == BLANK) & more
    start |= begins
    quotes = np.flatnonzero((points == 39) & start)
    if len(quotes):
        ends = rows[np.searchsorted(rows, quotes, "right")]
        open_ = np.ones(len(quotes), bool)
        for letters in CONTRACTIONS:
            n = len(letters)
            fits = open_ & (quotes + n < ends)
            for k, letter in enumerate(letters, 1):
                fits &= points[np.minimum(quotes + k, len(points) - 1)] == ord(letter)
            open_ &= ~fits
            start[quotes[fits] + 1] = False
            after = quotes[fits] + n + 1
            start[after[after < ends[fits]]] = True
    return start


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a column; null counts as empty."""
    return column.fill_null("").to_pylist()
