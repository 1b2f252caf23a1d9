"""Line dedup: hashes of lines are range-partitioned, sorted inside a partition by hash, then by document
from the largest id down; a stream over the sorted rows meets the kept document of each line first.

A row stands for all lines of one document with one key, so a line repeated inside a document costs one
row. The range bounds cover (hash, document), which splits a line that a third of all documents share
over many partitions. What such a partition cannot know of its first and last line (the rows beyond its
edges) is settled after the stream: it gives a summary of these two lines, and the rows of its first line
wait. The summaries are two rows for each partition, and the waiting rows meet them in a join.

The result is a bitmap of kept lines for each document that loses any, not text.

Cases: null or empty text is one empty line; "found in" counts documents, that is (doc_id, text); the
largest doc_id keeps its lines, also in several rows with that id; null ids count as the smallest; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.sources.scratch import cut

from . import text as tx

_LINES = "h1 long, h2 long, id long, dig long, lines binary"


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""Starts and ends of the \n-split lines, and each document's first line with the total at the end.
    A document without text has one empty line."""
    breaks = np.flatnonzero(data == 0x0A)
    first = np.searchsorted(breaks, offsets)
    count = np.diff(first) + 1
    edge = np.r_[0, np.cumsum(count)]
    starts = np.empty(edge[-1], dtype=np.int64)
    ends = np.empty(edge[-1], dtype=np.int64)
    inner = np.ones(edge[-1], dtype=bool)
    inner[edge[:-1]] = False
    starts[edge[:-1]] = offsets[:-1]
    starts[inner] = breaks + 1
    inner[:] = True
    inner[edge[1:] - 1] = False
    ends[edge[1:] - 1] = offsets[1:]
    ends[inner] = breaks
    return starts, ends, edge


def trimmed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans without white space at both ends; one of white space only becomes empty."""
    solid = np.flatnonzero(~tx.SPACE[data])
    lo, hi = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = hi > lo
    solid = np.r_[solid, 0]
    return np.where(some, solid[np.minimum(lo, len(solid) - 1)], starts), np.where(some, solid[hi - 1] + 1, starts)


def _long_lines(least: int):
    def run(batches):
        one, two = tx.SpanHash(11), tx.SpanHash(12)
        for rows, data, offsets in tx.chunks(batches, limit=tx.SMALL_CHUNK):
            starts, ends, edge = lines_of(data, offsets)
            s, e = trimmed(data, starts, ends)
            points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
            long = np.flatnonzero(points[e] - points[s] >= least)
            if not len(long):
                continue
            low = tx.LOWER[data]
            h1 = one.spans(one.sums(low), s[long], e[long])
            h2 = two.spans(two.sums(low), s[long], e[long])
            doc = np.searchsorted(edge, long, side="right") - 1
            at = (long - edge[doc]).astype(np.int32)
            by = np.lexsort((at, h2, h1, doc))
            new = np.r_[True, (np.diff(doc[by]) != 0) | (h1[by][1:] != h1[by][:-1]) | (h2[by][1:] != h2[by][:-1])]
            cuts = np.r_[np.flatnonzero(new), len(by)]
            head, at = by[new], at[by]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h1[head].view(np.int64)),
                    pa.array(h2[head].view(np.int64)),
                    pa.array(tx.integers(rows, "id")[doc[head]]),
                    pa.array(tx.integers(rows, "dig")[doc[head]]),
                    pa.array([at[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                ],
                ["h1", "h2", "id", "dig", "lines"],
            )

    return run


#: kind 0: lines to drop; 1: lines that wait; 2: summary of a line at an edge (id: its largest document,
#: n: its documents here).
_STREAM = "kind int, h1 long, h2 long, id long, dig long, lines binary, n long"


def _stream(least_docs: int):
    """Over rows sorted by (h1, h2, id down, dig). Carries the open line from batch to batch: its keeper,
    its count, and, until the count reaches ``least_docs``, its rows."""

    def run(batches):
        first = True  # the open line is the partition's first
        key, keeper, count, held, last = None, None, 0, [], None
        out = []

        def row(kind, k, doc, dig, lines, n):
            out.append((kind, k[0], k[1], doc, dig, lines, n))

        def close(at_end):
            if key is None:
                return
            if first or at_end:
                row(2, key, keeper, None, None, count)
                for doc, dig, lines in held:
                    row(1, key, doc, dig, lines, None)
            elif count >= least_docs:
                for doc, dig, lines in held:
                    if doc != keeper:
                        row(0, key, doc, dig, lines, None)

        def flush():
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            names = [c.split()[0] for c in _STREAM.split(", ")]
            done = pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names
            )
            out.clear()
            return done

        for batch in batches:
            h1, h2, ids, digs = (batch.column(c).to_numpy() for c in ("h1", "h2", "id", "dig"))
            lines = batch.column("lines")
            new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])] if len(h1) else np.zeros(0, bool)
            heads = np.flatnonzero(new)
            alone = np.r_[np.diff(heads) == 1, False]  # one row only: nothing to drop
            for g, (a, b) in enumerate(zip(heads.tolist(), [*heads[1:].tolist(), len(h1)], strict=True)):
                here = (int(h1[a]), int(h2[a]))
                if here != key:
                    if key is not None:
                        close(False)
                        first = False
                    if g and alone[g] and not first:
                        key, held, last, count, keeper = here, [], None, 1, None
                        continue
                    key, keeper, count, held, last = here, int(ids[a]), 0, [], None
                for i in range(a, b):
                    doc = (int(ids[i]), int(digs[i]))
                    if doc == last:
                        continue  # the same document, given twice
                    last, count = doc, count + 1
                    if not first and count > least_docs:
                        if doc[0] != keeper:
                            row(0, key, *doc, lines[i].as_py(), None)
                    else:
                        held.append((*doc, lines[i].as_py()))
                        if first and len(held) >= 4096:
                            out.extend((1, *key, *h, None) for h in held)
                            held = []
                        elif not first and count == least_docs:
                            for h in held:
                                if h[0] != keeper:
                                    row(0, key, *h, None)
                            held = []
                if len(out) >= 8192:
                    yield flush()
        close(True)
        if out:
            yield flush()

    return run


def dropped_lines(docs: DataFrame, least_docs: int = 5, least_points: int = 40) -> DataFrame:
    """``id, dig, lines``: packed int32 numbers of lines to drop; a document has a row for each key."""
    keys = tx.keyed(docs)
    rows = cut(keys.mapInArrow(_long_lines(least_points), _LINES), "lines")
    order = ["h1", "h2", F.col("id").desc(), "dig"]
    found = rows.repartitionByRange(tx.tasks(docs), *order).sortWithinPartitions(*order)
    found = cut(found.mapInArrow(_stream(least_docs), _STREAM), "streamed")
    # A line that ends a partition and is not its first has dropped rows already when its count reached
    # the least; beyond that, sums over the edges decide.
    edges = found.where("kind = 2").groupBy("h1", "h2").agg(F.max("id").alias("keeper"), F.sum("n").alias("docs"))
    edges = edges.where(F.col("docs") >= least_docs)
    waiting = found.where("kind = 1").select("h1", "h2", "id", "dig", "lines").join(edges, ["h1", "h2"])
    settled = waiting.where(F.col("id") != F.col("keeper")).select("id", "dig", "lines")
    return found.where("kind = 0").select("id", "dig", "lines").unionByName(settled)


def _bitmaps(batches):
    for rows in batches:
        maps = []
        for packed in rows.column("all").to_pylist():
            at = np.concatenate([np.frombuffer(p, dtype=np.int32) for p in packed])
            kept = np.ones(int(at.max()) // 8 * 8 + 8, dtype=bool)  # whole bytes
            kept[at] = False
            maps.append(zlib.compress(np.packbits(kept, bitorder="little").tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [rows.column("id"), rows.column("dig"), pa.array(maps, pa.binary())], ["id", "dig", "bitmap"]
        )


def keep_bitmaps(docs: DataFrame, least_docs: int = 5, least_points: int = 40) -> DataFrame:
    """``id, dig, bitmap`` for each document that loses lines: a compressed bitmap with a bit for each
    line up to the last dropped one, least significant bit first; lines beyond it stay."""
    gone = dropped_lines(docs, least_docs, least_points).groupBy("id", "dig").agg(F.collect_list("lines").alias("all"))
    return gone.mapInArrow(_bitmaps, "id long, dig long, bitmap binary")


def _kept_lines(digest: bool):
    def run(batches):
        for rows, data, offsets in tx.chunks(batches, limit=tx.SMALL_CHUNK):
            starts, ends, edge = lines_of(data, offsets)
            stay = np.ones(len(starts), dtype=bool)
            for i, packed in enumerate(rows.column("bitmap").to_pylist()):
                if packed is not None:
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8), bitorder="little")
                    n = min(len(bits), edge[i + 1] - edge[i])
                    stay[edge[i] : edge[i] + n] = bits[:n]
            kept = np.flatnonzero(stay)
            # a kept line takes the break before it along, the first kept one of a document doesn't
            first = np.searchsorted(kept, edge)
            lead = starts[kept] - 1
            heads = first[:-1][first[:-1] < first[1:]]
            lead[heads] += 1
            mask = tx.span_mask(lead, ends[kept], len(data))
            text, at = data[mask], np.r_[0, np.cumsum(mask)][offsets]
            out = tx.digests(text, at) if digest else tx.strings(text, at)
            n = np.diff(edge)
            yield pa.RecordBatch.from_arrays(
                [*(c for c, f in zip(rows.columns, rows.schema, strict=True) if f.name not in ("text", "bitmap"))]
                + [pa.array(n), pa.array(n - np.diff(first)), out],
                [f.name for f in rows.schema if f.name not in ("text", "bitmap")] + ["n_lines", "n_dropped", "kept"],
            )

    return run


def drop_repeated_lines(docs: DataFrame, least_docs: int = 5, least_points: int = 40, digest: bool = False) -> DataFrame:
    """``id, dig, n_lines, n_dropped, kept`` for each row; ``kept`` is the text that stays or its SHA-256."""
    joined = tx.keyed(docs).join(keep_bitmaps(docs, least_docs, least_points), ["id", "dig"], "left")
    schema = "id long, dig long, n_lines long, n_dropped long, kept string"
    return joined.mapInArrow(_kept_lines(digest), schema)


def without_repeated_lines(docs: DataFrame, least_docs: int = 5, least_points: int = 40) -> DataFrame:
    """``docs`` with its columns as they are, but ``text`` without the dropped lines where there are any,
    and ``n_chars``, if there, the length of that text."""
    bitmaps = keep_bitmaps(docs, least_docs, least_points)
    joined = tx.with_rows(docs, bitmaps).select(F.coalesce("row.text", F.lit("")).alias("text"), "bitmap", "row")
    schema = f"row {docs.select(F.struct('*').alias('row')).schema['row'].dataType.simpleString()}"
    done = joined.mapInArrow(_kept_lines(False), f"{schema}, n_lines long, n_dropped long, kept string")
    changed = F.col("n_dropped") > 0
    new = {"text": F.col("kept"), "n_chars": F.length("kept")}
    return done.select(
        *(
            F.when(changed, new[f.name].cast(f.dataType)).otherwise(F.col("row")[f.name]).alias(f.name)
            if f.name in new
            else F.col("row")[f.name].alias(f.name)
            for f in docs.schema
        )
    )
