"""Token ids of texts from a byte-level BPE file of the tokenizers library.

The library's split into pieces (contractions, a space with letters, digits or marks, white space) is
found for many texts at once from their code points; each distinct piece is encoded once by the library's
model and remembered by a worker: when a table is full, a new one takes over the pieces that are met again
from it, so a worker holds two tables at most. Ids equal those of encoding each text as a whole, since the
model never merges across pieces. A text that holds a special token's string, or a code point whose
class the table below doesn't settle (controls, unusual white space, beyond U+024F), is encoded by the
library as a whole.
"""

from __future__ import annotations

import hashlib
import os
import unicodedata
from functools import cache

import numpy as np

from . import text as tx

#: Pieces in a worker's table; beyond that a new table begins and the full one becomes the one before.
MOST_PIECES = 1 << 18
#: Slots of the table at first, as a power of two; it doubles when half full.
_SLOTS_LOG2 = 16
SPACE, LETTER, NUMBER, MARK, OTHER = range(5)
_LAST = 0x250


def _classes() -> np.ndarray:
    out = np.full(_LAST, OTHER, dtype=np.uint8)
    for c in [0x09, 0x0A, 0x0D, *range(0x20, 0x7F), *range(0xA1, _LAST)]:
        kind = unicodedata.category(chr(c))
        out[c] = SPACE if chr(c).isspace() else LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else MARK
    return out


CLASS = _classes()


def file_digest(path: str) -> str:
    """What names a tokenizer's version: the SHA-256 of its file."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def pieces(points: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Starts of the pieces of texts given as code points with their classes; ``offsets`` are the texts'
    edges. The pattern is 's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^\\sLN]+|\\s+(?!\\S)|\\s+."""
    n = len(points)
    head = np.zeros(n + 1, dtype=bool)
    head[offsets] = True
    head, first = head[:n], head  # first: also marks the end
    space = kinds == SPACE
    before = np.r_[True, space[:-1]] | head  # white space or an edge before
    after = np.r_[space[1:], True] | first[1:]  # white space or an edge behind
    blank = points == 0x20
    led = np.r_[False, blank[:-1]] & ~head  # a space right before
    same = np.r_[False, kinds[1:] == kinds[:-1]]
    start = np.where(space, ~before | ~after, np.where(before, ~led, ~same)) | head
    # a contraction stands at the start of a run of marks that no space leads
    quote = np.flatnonzero((points == 0x27) & start)
    if len(quote):
        padded = np.r_[points, np.zeros(3, dtype=points.dtype)]
        end = offsets[np.searchsorted(offsets, quote, side="right")]
        a, b = padded[quote + 1], padded[quote + 2]
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        size = np.where(short & (quote + 1 < end), 2, np.where(long & (quote + 2 < end), 3, 0))
        quote, size, end = quote[size > 0], size[size > 0], end[size > 0]
        start[quote + 1] = False
        inside = quote + size < end
        start[(quote + size)[inside]] |= kinds[(quote + size)[inside]] != SPACE
    return np.flatnonzero(start)


class _Known:
    """Piece hashes -> numbers of remembered pieces: open addressing over arrays."""

    def __init__(self):
        self._clear(_SLOTS_LOG2)
        self.n = self.used = 0
        self.sizes = np.zeros(1 << 12, dtype=np.int64)
        self.at = np.zeros(1 << 12, dtype=np.int64)
        self.ids = np.zeros(1 << 14, dtype=np.uint32)

    def _clear(self, bits: int) -> None:
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.values = np.zeros(1 << bits, dtype=np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        slot = (keys >> self.shift).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            there = self.keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            go = ~hit & (there != 0)
            todo, slot = todo[go], (slot[go] + 1) & self.last
        return out

    def ids_at(self, number: np.ndarray) -> list[list[int]]:
        return [self.ids[a : a + n].tolist() for a, n in zip(self.at[number].tolist(), self.sizes[number].tolist(), strict=True)]

    def add(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        flat = np.array([i for x in ids for i in x], dtype=np.uint32)
        while self.n + len(keys) > len(self.sizes):
            self.sizes, self.at = np.r_[self.sizes, np.zeros_like(self.sizes)], np.r_[self.at, np.zeros_like(self.at)]
        while self.used + len(flat) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        number = self.n + np.arange(len(keys))
        self.sizes[number] = sizes
        self.at[number] = self.used + np.r_[0, np.cumsum(sizes)[:-1]]
        self.ids[self.used : self.used + len(flat)] = flat
        self.n, self.used = self.n + len(keys), self.used + len(flat)
        if 2 * self.n > len(self.keys):
            held = np.flatnonzero(self.keys)
            old, numbers = self.keys[held], self.values[held]
            self._clear((2 * self.n).bit_length())
            self._place(old, numbers)
        self._place(keys, number)

    def _place(self, keys: np.ndarray, number: np.ndarray) -> None:
        slot = (keys >> self.shift).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[todo[free]]
            won = self.keys[slot] == keys[todo]
            self.values[slot[won]] = number[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) & self.last


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_padding()
        self.whole.no_truncation()
        self.model = self.whole.model
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.letters = {b: _byte_letter(b) for b in range(256)}
        self.hasher = tx.SpanHash(21, _LAST)
        self.known, self.before = _Known(), _Known()

    def _piece_ids(self, pieces: list[str]) -> list[list[int]]:
        tokenize, letters = self.model.tokenize, self.letters
        return [[t.id for t in tokenize(p.encode().decode("latin-1").translate(letters))] for p in pieces]

    def encode(self, data: np.ndarray, offsets: np.ndarray, ids: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """Ids of all texts one after another (None if not wanted), and the texts' edges in them."""
        text = data.tobytes().decode()
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        edges = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets]
        kinds = np.where(points < _LAST, CLASS[np.minimum(points, _LAST - 1)], OTHER).astype(np.uint8)
        odd = np.diff(np.r_[0, np.cumsum(kinds == OTHER)][edges]) > 0
        if any(s in text for s in self.special):
            odd |= np.array([any(s in text[a:b] for s in self.special) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)])
        starts = pieces(points, edges, kinds) if len(points) else np.zeros(0, dtype=np.int64)
        ends = np.r_[starts[1:], len(points)]
        first = np.searchsorted(starts, edges)
        if odd.any():
            own = ~np.repeat(odd, np.diff(first))
            starts, ends = starts[own], ends[own]
            first = np.r_[0, np.cumsum(np.where(odd, 0, np.diff(first)))]
        keys = self.hasher.spans(self.hasher.sums(np.minimum(points, _LAST - 1)), starts, ends) | np.uint64(1)
        number = self.known.find(keys)
        if (number < 0).any():
            at = np.flatnonzero(number < 0)
            new, one = np.unique(keys[at], return_index=True)
            if self.known.n + len(new) > MOST_PIECES:
                self.before, self.known = self.known, _Known()
                at = np.arange(len(keys))
                new, one = np.unique(keys, return_index=True)
            one = at[one]
            old = self.before.find(new)
            again, first_time = old >= 0, one[old < 0]
            self.known.add(new[again], self.before.ids_at(old[again]))
            self.known.add(new[~again], self._piece_ids([text[a:b] for a, b in zip(starts[first_time].tolist(), ends[first_time].tolist(), strict=True)]))
            number = self.known.find(keys)
        sizes = self.known.sizes[number]
        upto = np.r_[0, np.cumsum(sizes)]
        count = np.diff(upto[first])
        whole = {}
        if odd.any():
            for i in np.flatnonzero(odd).tolist():
                got = self.whole.encode(text[edges[i] : edges[i + 1]], add_special_tokens=False).ids
                whole[i] = np.array(got, dtype=np.uint32)
                count[i] = len(got)
        at = np.r_[0, np.cumsum(count)]
        if not ids:
            return None, at
        flat = self.known.ids[np.repeat(self.known.at[number] - upto[:-1], sizes) + np.arange(upto[-1])]
        if whole:
            out = np.empty(at[-1], dtype=np.uint32)
            own = np.repeat(~odd, count)
            out[own] = flat
            for i, got in whole.items():
                out[at[i] : at[i + 1]] = got
            flat = out
        return flat, at


def _byte_letter(b: int) -> str:
    """The letter that stands for a byte: the printable bytes for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return chr(b) if b in plain else chr(0x100 + sum(x not in plain for x in range(b)))


@cache
def encoder(path: str) -> Encoder:
    """The encoder of a file; a worker keeps it."""
    return Encoder(path)
