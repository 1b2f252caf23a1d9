"""Statistics of a text for the quality rules, from its bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import text as tx
from .lines import lines_of

#: Words in a window that counts as repeated when it is found twice in a text.
REPEAT = 8
# The characters that count as symbols.
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
PUNCT = np.zeros(256, dtype=bool)
PUNCT[[i for i in range(33, 127) if not chr(i).isalnum()]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_punct", "n_digits", "n_lines", "n_echoes")


def repeated_words(words: np.ndarray, first: np.ndarray, length: int = REPEAT) -> np.ndarray:
    """For each document the number of words inside windows that are found twice or more in it."""
    n = np.maximum(np.diff(first) - length + 1, 0)
    edge = np.r_[0, np.cumsum(n)]
    doc = np.repeat(np.arange(len(n)), n)
    starts = np.arange(edge[-1]) - edge[:-1][doc] + first[:-1][doc]
    hashes = tx.window_hash(words, length, 0xD1342543DE82EF95)[starts]
    hashes = tx.mix(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))  # equal only inside a document
    by = np.argsort(hashes)
    same = hashes[by][1:] == hashes[by][:-1]
    twice = np.zeros(len(by), dtype=bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    at = starts[twice]
    mask = tx.covered(at, at + length, len(words))
    return np.diff(np.r_[0, np.cumsum(mask)][first])


def echoes(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each document its words that equal the word before."""
    same = np.r_[False, words[1:] == words[:-1]][: len(words)]
    same[first[:-1][first[:-1] < first[1:]]] = False
    return np.diff(np.r_[0, np.cumsum(same)][first])


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, hasher: tx.SpanHash, sums: np.ndarray, word_starts: np.ndarray):
    """For each document its lines with a word, and those of them that equal an earlier line."""
    starts, ends, edge = lines_of(data, offsets)
    solid = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(edge))[solid]
    hashes = tx.mix(hasher.spans(sums, starts[solid], ends[solid]) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    by = np.argsort(hashes)
    later = by[1:][hashes[by][1:] == hashes[by][:-1]]
    return np.bincount(doc, minlength=len(offsets) - 1), np.bincount(doc[later], minlength=len(offsets) - 1)


def counts_of(data: np.ndarray, offsets: np.ndarray, hasher: tx.SpanHash) -> dict[str, np.ndarray]:
    starts, ends, first = tx.words_of(data, offsets)
    sums = hasher.sums(data)
    per_doc = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][offsets])
    words = hasher.spans(sums, starts, ends)
    n_lines, n_dup = duplicate_lines(data, offsets, hasher, sums, starts)
    return {
        "n_words": np.diff(first),
        "word_chars": per_doc(((data & 0xC0) != 0x80) & ~tx.SPACE[data]),
        "n_symbols": per_doc(SYMBOLS[data]),
        "n_dup_lines": n_dup,
        "n_repeat_words": repeated_words(words, first),
        "n_upper": per_doc(UPPER[data]),
        "n_punct": per_doc(PUNCT[data]),
        "n_digits": per_doc(DIGIT[data]),
        "n_lines": n_lines,
        "n_echoes": echoes(words, first),
    }


def counting(batches):
    hasher = tx.SpanHash(7)
    for rows, data, offsets in tx.chunks(batches, limit=tx.SMALL_CHUNK):
        counts = counts_of(data, offsets, hasher)
        rest = [(f.name, c) for f, c in zip(rows.schema, rows.columns, strict=True) if f.name != "text"]
        yield pa.RecordBatch.from_arrays(
            [c for _, c in rest] + [pa.array(counts[c].astype(np.int64)) for c in COUNTS], [n for n, _ in rest] + list(COUNTS)
        )
