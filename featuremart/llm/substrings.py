"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

Map: every window of ``length`` words of every document is hashed. Of equal windows inside one batch of
about a million words only the earliest goes on; the others are known to be repeats. The rest is sent to
buckets by hash, as packed arrays. Reduce: a bucket holds all windows of its share of the hash space; all
but the earliest of equal ones are repeats, and their places go back to the batch they came from, where
they become maximal removal intervals of its documents.

A frequent window sends one entry for each batch, so no bucket grows with its count. The number of buckets
follows the size of the input; a bucket is one group of some megabytes, a batch another. Two windows count
as equal when two independent hashes agree: one of 56 bits and the one that picks the bucket, so that the
bits grow with the data (63 bits at 100 buckets, 79 at eight million).

Cases: null text has no words; a document of fewer words than a window has no windows and keeps all;
"earlier" means smaller doc_id (null first), then smaller text digest where ids repeat, then smaller
start; rows that agree in id and text are one document; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import text as tx

#: Words whose windows are packed together, and bytes of text for each bucket.
BATCH_WORDS = 1 << 20
BUCKET_BYTES = 12 << 20
_LOW7 = np.uint64((1 << 56) - 1)


def _packed_gaps(at: np.ndarray) -> bytes:
    """Increasing positions as bytes of gaps; 255 stands for 'add 255 and go on'."""
    gaps = np.diff(at, prepend=0)
    whole, rest = gaps // 255, gaps % 255
    out = np.full(int(whole.sum()) + len(gaps), 255, dtype=np.uint8)
    out[np.cumsum(whole + 1) - 1] = rest
    return out.tobytes()


def _unpacked_gaps(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, dtype=np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


def _seven_bytes(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _from_seven_bytes(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 7)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :7] = raw
    return out.view("<u8").ravel()


#: kind 0: windows of a bucket (key), 1: places found in the map (key: any bucket). ``ids`` holds gaps of
#: ids, ``marks`` 32 bits of each text digest, ``firsts`` the documents' first words; kind 1 has all of a
#: batch's documents and their whole digests.
_PACKED = "kind int, bucket int, batch long, ids binary, marks binary, firsts binary, hashes binary, places binary"
_FOUND = "batch long, ids binary, digs binary, firsts binary, places binary"


def _batch(schema: str, rows) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    arrays = [pa.array(list(c), kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _gaps(x: np.ndarray) -> bytes:
    """Increasing integers as their gaps, in as few bytes as all of them take."""
    gaps = np.diff(x, prepend=x[:1]).view(np.uint64)
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if not len(gaps) or gaps.max() <= np.iinfo(k).max)
    return kind.encode() + x[:1].astype("<i8").tobytes() + gaps.astype(kind).tobytes()


def _from_gaps(packed: bytes) -> np.ndarray:
    gaps = np.frombuffer(packed, dtype=packed[:3].decode(), offset=11 if len(packed) > 3 else 3)
    start = np.frombuffer(packed[3:11], dtype="<i8")
    return (np.cumsum(gaps, dtype=np.uint64).view(np.int64) + (start[0] if len(start) else 0)).astype(np.int64)


def _windows(length: int, buckets: int):
    def run(batches):
        hasher = tx.SpanHash(7)
        held, words, serial = [], 0, TaskContext.get().partitionId() << 32
        for rows, data, offsets in tx.chunks(batches):
            starts, ends, first = tx.words_of(data, offsets)
            hashes = hasher.spans(hasher.sums(data), starts, ends)
            held.append((tx.integers(rows, "id"), tx.integers(rows, "dig"), np.diff(first), hashes))
            words += len(hashes)
            if words >= BATCH_WORDS:
                yield from pack(held, serial)
                held, words, serial = [], 0, serial + 1
        if held:
            yield from pack(held, serial)

    def pack(held, serial):
        ids, digs, counts, words = (np.concatenate([h[i] for h in held]) for i in range(4))
        # documents in order, each once, so that places are in order too
        order = np.lexsort((digs, ids))
        order = order[np.r_[True, (np.diff(ids[order]) != 0) | (np.diff(digs[order]) != 0)]]
        first = np.r_[0, np.cumsum(counts)][order]
        ids, digs, counts = ids[order], digs[order], counts[order]
        moved = np.r_[0, np.cumsum(counts)]
        words = words[np.repeat(first - moved[:-1], counts) + np.arange(moved[-1])]
        one = tx.window_hash(words, length, 0xD1342543DE82EF95)
        two = tx.window_hash(tx.mix(words + np.uint64(0x632BE59BD9B4E019)), length, 0xAF251AF3B0F025B5)
        n = np.maximum(counts - length + 1, 0)
        starts = np.repeat(moved[:-1] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        one, two = one[starts] & _LOW7, (two[starts] >> np.uint64(32)).astype(np.int64) % buckets
        # the earliest of equal windows of this batch goes on
        by = np.lexsort((starts, one, two))
        new = np.zeros(len(by), dtype=bool)
        new[:1] = True
        new[1:] = (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1])
        known = np.ones(len(starts), dtype=bool)
        known[by[new]] = False
        edges = np.flatnonzero(~known)
        edges = edges[np.argsort(two[edges], kind="stable")]
        cuts = np.searchsorted(two[edges], np.arange(buckets + 1))
        marks = (digs.view(np.uint64) >> np.uint64(32)).astype(np.uint32)
        out = [(1, serial % buckets, serial, ids.tobytes(), digs.tobytes(), moved[:-1].tobytes(), b"", _packed_gaps(starts[known]))]
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            own = edges[cuts[b] : cuts[b + 1]]
            at = starts[own]
            docs = np.unique(np.searchsorted(moved, at, side="right") - 1)
            out.append(
                (0, b, serial, _gaps(ids[docs]), marks[docs].tobytes(), _gaps(moved[docs]), _seven_bytes(one[own]), _packed_gaps(at))
            )
            if len(out) >= 64:
                yield _batch(_PACKED, out)
                out = []
        if out:
            yield _batch(_PACKED, out)

    return run


def _repeats(table: pa.Table) -> pa.Table:
    """All packed windows of a bucket: by batch, the places of those that are not the earliest of their kind."""
    rows = table.to_pylist()
    done = [(r["batch"], r["ids"], r["marks"], r["firsts"], r["places"]) for r in rows if r["kind"] == 1]
    rows = [r for r in rows if r["kind"] == 0]
    if rows:
        firsts, places = [_from_gaps(r["firsts"]) for r in rows], [_unpacked_gaps(r["places"]) for r in rows]
        base = np.cumsum([0, *map(len, firsts)])
        doc = [np.searchsorted(f, p, side="right") - 1 for f, p in zip(firsts, places, strict=True)]
        spot = np.concatenate([p - f[d] for f, p, d in zip(firsts, places, doc, strict=True)])
        doc = np.concatenate([d + b for d, b in zip(doc, base, strict=False)])
        ids = np.concatenate([_from_gaps(r["ids"]) for r in rows])
        marks = np.concatenate([np.frombuffer(r["marks"], dtype=np.uint32) for r in rows])
        hashes = np.concatenate([_from_seven_bytes(r["hashes"]) for r in rows])
        sizes = np.array([len(p) for p in places])
        # a document in several batches, as its row is repeated, has one rank
        order = np.lexsort((marks, ids))
        rank = np.empty(len(ids), dtype=np.int64)
        rank[order] = np.cumsum(np.r_[False, (np.diff(ids[order]) != 0) | (marks[order][1:] != marks[order][:-1])])
        place = (rank[doc] << 32) | spot
        by = np.lexsort((place, hashes))
        head = np.r_[True, hashes[by][1:] != hashes[by][:-1]]
        earliest = place[by][np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))]
        late = np.zeros(len(by), dtype=bool)
        late[by] = place[by] != earliest
        cuts = np.r_[0, np.cumsum(sizes)]
        for r, p, a, b in zip(rows, places, cuts[:-1], cuts[1:], strict=True):
            if late[a:b].any():
                done.append((r["batch"], None, None, None, _packed_gaps(p[late[a:b]])))
    if not done:
        done = [(None,) * 5]
    return pa.Table.from_batches([_batch(_FOUND, done)])


def _intervals(length: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        known = next(r for r in rows if r["ids"] is not None)
        ids, digs, firsts = (np.frombuffer(known[c], dtype=np.int64) for c in ("ids", "digs", "firsts"))
        at = np.sort(np.concatenate([_unpacked_gaps(r["places"]) for r in rows]))
        doc = np.searchsorted(firsts, at, side="right") - 1
        # words between two documents keep their runs apart
        starts, ends = tx.merged(at + doc, at + doc + length)
        doc = np.searchsorted(firsts + np.arange(len(firsts)), starts, side="right") - 1
        spans = np.stack([starts, ends], axis=1) - (firsts + np.arange(len(firsts)))[doc][:, None]
        some, cuts = np.unique(doc, return_index=True)
        return pa.table({"id": ids[some], "dig": digs[some], "spans": tx.lists(spans.ravel(), 2 * np.r_[cuts, len(doc)])})

    return run


def removal_intervals(docs: DataFrame, length: int = 20) -> DataFrame:
    """``id, dig, spans``: for each document with repeats the maximal intervals of words to remove, as
    word positions start, end, start, end, ... (end exclusive)."""
    keys = tx.keyed(docs)
    buckets = max(2 * tx.tasks(docs), -(-tx.text_bytes(keys) // BUCKET_BYTES))
    packed = keys.mapInArrow(_windows(length, buckets), _PACKED)
    found = packed.groupBy("bucket").applyInArrow(_repeats, _FOUND).where("batch is not null")
    spans = found.groupBy("batch").applyInArrow(_intervals(length), "id long, dig long, spans array<bigint>")
    return spans.dropDuplicates(["id", "dig"])


_CLEAN = "doc_id long, n_words long, n_removed long, kept string"


def _without(digest: bool):
    def run(batches):
        for rows, data, offsets in tx.chunks(batches):
            starts, ends, first = tx.words_of(data, offsets)
            values, cuts = tx.flat_lists(rows, "spans")
            at = values + np.repeat(first[:-1], np.diff(cuts))
            kept = np.flatnonzero(~tx.covered(at[0::2], at[1::2], len(starts)))
            text, edges = tx.joined_words(data, offsets, starts[kept], ends[kept])
            out = tx.digests(text, edges) if digest else tx.strings(text, edges)
            n = np.diff(first)
            ids = tx.integers(rows, "id")
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=ids == tx.NULL_ID), pa.array(n), pa.array(n - np.diff(np.searchsorted(kept, first))), out],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, length: int = 20, digest: bool = False) -> DataFrame:
    """One row for each document: ``doc_id, n_words, n_removed, kept``; ``kept`` is the text of the words
    that stay, joined by one space, or its SHA-256."""
    joined = tx.keyed(docs).join(removal_intervals(docs, length), ["id", "dig"], "left")
    return joined.mapInArrow(_without(digest), _CLEAN)
