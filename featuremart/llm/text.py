"""Helpers on batches of texts: UTF-8 bytes as numpy arrays, words, and hashes of spans.

A document is named by ``(id, dig)``: its doc_id and the XXH64 of its text. A null doc_id becomes the
smallest long, so it sorts first. Rows that agree in doc_id and text are one document given several
times; each of them gets the same answer. A null text counts as empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once; one longer text is worked on alone.
CHUNK = 1 << 21
#: The same where a byte of text takes many arrays of 64 bits at a time: a worker keeps what they took.
SMALL_CHUNK = (1 << 19) - 1
NULL_ID = -(2**63)
U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)
#: The six ASCII white space bytes between words and around lines.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def doc_key(id_column: str = "doc_id", text_column: str = "text") -> list[Column]:
    """``id`` and ``dig`` of a row."""
    return [
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(F.coalesce(F.col(f"`{text_column}`"), F.lit(""))).alias("dig"),
    ]


def keyed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, dig, text`` and nothing else, so that further columns cannot clash."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text")
    return docs.select(*doc_key(id_column, text_column), text)


def with_rows(docs: DataFrame, decisions: DataFrame, how: str = "left") -> DataFrame:
    """``id, dig, row`` (all columns of a document as they came, in a struct, so that no name clashes)
    joined to ``decisions``, which has at most one row for each ``(id, dig)``."""
    return docs.select(*doc_key(), F.struct(F.col("*")).alias("row")).join(decisions, ["id", "dig"], how)


def real_id() -> Column:
    return F.when(F.col("id") != NULL_ID, F.col("id"))


def chunks(batches, column: str = "text", limit: int = CHUNK):
    """``(rows, data, offsets)``: slices of the batches with at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        texts = texts.cast(pa.large_binary())
        at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), len(texts))
            yield batch.slice(first, last - first), data[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last


def integers(rows, name: str) -> np.ndarray:
    return rows.column(rows.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def spans_of(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values that don't cross a document's edge."""
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts, ends = mask.copy(), mask.copy()
    starts[1:] &= ~mask[:-1]
    starts[edge] = mask[edge]
    ends[:-1] &= ~mask[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = mask[last]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are no white space), and for each document the
    index of its first word, with the total at the end."""
    starts, ends = spans_of(~SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class SpanHash:
    """Polynomial hashes of spans of an array over a small alphabet, modulo 2^64, from running sums."""

    def __init__(self, seed: int, symbols: int = 256):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 2**63, symbols, dtype=np.uint64) * U64(2) + U64(1)
        self.base = int(rng.integers(0, 2**60)) * 8 + 3
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * U64(pow(self.base, k, 2**64))])
            self.down = np.concatenate([self.down, self.down * U64(pow(self.inverse, k, 2**64))])

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * _ODD)


def window_hash(values: np.ndarray, length: int, multiplier: int) -> np.ndarray:
    """Rabin-Karp hash of every window of ``length`` values; windows may cross documents here."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    m, out = U64(multiplier | 1), values[:n].copy()
    for j in range(1, length):
        out *= m
        out += values[j : j + n]
    return mix(out)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions inside any of the spans."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching spans."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    return starts[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(reach) - 1]]


def span_mask(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions inside spans that don't overlap."""
    step = np.zeros(n + 1, dtype=np.int8)
    some = ends > starts  # those without length share their places with others
    step[starts[some]] += 1
    step[ends[some]] -= 1
    return np.cumsum(step[:-1], dtype=np.int8).view(bool)


def joined_words(data, offsets, starts, ends) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the given words, one space between two of a document, and the documents' edges in them.
    A word's place for the space is the white space byte before it."""
    keep = span_mask(starts, ends, len(data))
    first = np.searchsorted(starts, offsets[:-1])
    gaps = np.delete(starts, first[first < np.searchsorted(starts, offsets[1:])]) - 1
    keep[gaps] = True
    text = data.copy()
    text[gaps] = 0x20
    return text[keep], np.r_[0, np.cumsum(keep)][offsets]


def digests(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """SHA-256 of each document's bytes, lowercase hex."""
    raw, at = memoryview(data.tobytes()), offsets.tolist()
    return pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)], pa.string())


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    raw, at = data.tobytes(), offsets.tolist()
    return pa.array([raw[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)], pa.string())


def flat_lists(rows, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and where each row's begin, with the total at the end; null is an empty list."""
    column = rows.column(rows.schema.get_field_index(name))
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)].astype(np.int64)


def lists(values, offsets, kind=pa.int64()) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts; one scan without a shuffle."""
    return docs.select(F.sum(F.octet_length("text"))).first()[0] or 0


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
