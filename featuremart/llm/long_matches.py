"""Removal of long byte matches with run-length indexes.

Every string of ``length`` bytes belongs to an anchor: the ``GRAM``-byte gram in it with the least hash
(the first of equals). Equal strings have equal anchors at equal places, so strings of different anchors
never match, and the strings of one anchor in one text are a segment: some 170 starts in a row and the
bytes behind. Then:

1. Segments are counted by (anchor, digest). Those that occur twice are repeats as a whole, and one stands
   for all, so copies cost no more than their rows.
2. Anchors with several different segments go to buckets with the bytes of one occurrence of each. A bucket
   builds a run-length index of its segments (Burrows-Wheeler transform in runs, samples at run ends) and
   streams its matching statistics; what lies in matches of ``length`` bytes or more is marked.
3. An anchor with more than ``MOST_SEGMENTS`` different segments (a short passage that very many texts
   share) would be too much for one bucket: the strings of its segments are counted one by one by two
   64-bit hashes instead, which spreads over all tasks.

Buckets follow the bytes that need an index, some ``BUCKET_BYTES`` each. Spans come together by document.
Digests are 64 bits under an anchor of 64 bits, so segments count as equal on 128 bits.

Cases: null text is empty; a text shorter than ``length`` keeps all; overlaps inside one text count; rows
that agree in id and text are one document; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.sources.scratch import cut

from . import text as tx
from .runindex import RunIndex

GRAM = 64
BUCKET_BYTES = 1 << 20
MOST_SEGMENTS = 1024

_SEGMENTS = "anchor long, digest long, id long, dig long, start int, starts int"


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` values."""
    n, done, out = len(x) - width + 1, 1, x
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[:n], out[width - done : width - done + n])


def _segments(length: int):
    gram = min(GRAM, length)
    width = length - gram + 1

    def run(batches):
        hasher, digest = tx.SpanHash(31), tx.SpanHash(32)
        for rows, data, offsets in tx.chunks(batches, limit=tx.SMALL_CHUNK):
            if len(data) < length:
                continue
            at = np.arange(len(data) - gram + 1)
            sums = hasher.sums(data)
            hashes = hasher.spans(sums, at, at + gram)
            key = (hashes & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
            owner = (sliding_least(key, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            count = np.maximum(np.diff(offsets) - length + 1, 0)
            doc = np.repeat(np.arange(len(count)), count)
            starts = np.arange(len(doc)) + (offsets[:-1] - np.r_[0, np.cumsum(count)[:-1]])[doc]
            if not len(starts):
                continue
            owner = owner[starts]
            head = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1])])
            many = np.diff(np.r_[head, len(starts)])
            first = starts[head]
            two = digest.spans(digest.sums(data), first, first + many + length - 1)
            d = doc[head]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[owner[head]].view(np.int64)),
                    pa.array(two.view(np.int64)),
                    pa.array(tx.integers(rows, "id")[d]),
                    pa.array(tx.integers(rows, "dig")[d]),
                    pa.array((first - offsets[d]).astype(np.int32)),
                    pa.array(many.astype(np.int32)),
                ],
                [c.split()[0] for c in _SEGMENTS.split(", ")],
            )

    return run


_CUTS = "bucket long, anchor long, id long, dig long, start int, alone boolean, bytes binary"


def _sliced(length: int):
    """The bytes of the wanted segments of a document."""

    def run(batches):
        names = ("bucket", "anchor", "start", "starts", "alone")
        for rows, data, offsets in tx.chunks(batches, limit=tx.SMALL_CHUNK):
            out = {n: [] for n in ("bucket", "anchor", "id", "dig", "start", "alone", "bytes")}
            wanted = rows.column(rows.schema.get_field_index("wanted")).to_pylist()
            for i, (doc, dig, segs) in enumerate(zip(tx.integers(rows, "id").tolist(), tx.integers(rows, "dig").tolist(), wanted, strict=True)):
                for seg in segs:
                    b, a, s, n, alone = (seg[c] for c in names)
                    lo = offsets[i] + s
                    for c, v in zip(out, (b, a, doc, dig, s, alone, data[lo : lo + n + length - 1].tobytes()), strict=True):
                        out[c].append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))

    return run


_SPANS = "id long, dig long, spans binary"


def _packed_spans(ids, digs, owner, starts, ends) -> pa.Table:
    """A row of packed int64 pairs for each owner that has spans; ``owner`` is sorted."""
    some, cuts = np.unique(owner, return_index=True)
    cuts = np.r_[cuts, len(owner)]
    pairs = np.stack([starts, ends], axis=1).astype(np.int64)
    return pa.table(
        {
            "id": pa.array(ids[some], pa.int64()),
            "dig": pa.array(digs[some], pa.int64()),
            "spans": pa.array([pairs[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
        }
    )


def _indexed(length: int):
    def run(table: pa.Table) -> pa.Table:
        strings = [np.frombuffer(b, dtype=np.uint8) for b in table.column("bytes").to_pylist()]
        index = RunIndex(strings)
        at, size = index.long_matches(length)
        mask = tx.covered(at, at + size, len(index.text)) & index.inside
        lo, hi = tx.spans_of(mask, index.first)
        owner = np.searchsorted(index.first, lo, side="right") - 1
        alone = table.column("alone").to_numpy(zero_copy_only=False)[owner]
        lo, hi, owner = lo[alone], hi[alone], owner[alone]
        moved = table.column("start").to_numpy().astype(np.int64)[owner] - index.first[owner]
        ids, digs = table.column("id").to_numpy(), table.column("dig").to_numpy()
        return _packed_spans(ids, digs, owner, lo + moved, hi + moved)

    return run


def _strings(length: int):
    """Two hashes of each string of the segments of a very common anchor."""

    def run(batches):
        one, two = tx.SpanHash(33), tx.SpanHash(34)
        for batch in batches:
            for i, raw in enumerate(batch.column("bytes").to_pylist()):
                data = np.frombuffer(raw, dtype=np.uint8)
                at = np.arange(len(data) - length + 1)
                same = lambda c: pa.array(np.full(len(at), batch.column(c)[i].as_py(), np.int64))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.spans(one.sums(data), at, at + length).view(np.int64)),
                        pa.array(two.spans(two.sums(data), at, at + length).view(np.int64)),
                        same("id"),
                        same("dig"),
                        pa.array(at + batch.column("start")[i].as_py()),
                    ],
                    ["h1", "h2", "id", "dig", "at"],
                )

    return run


def _ranges(length: int):
    """(id, dig, at) lists -> packed spans."""

    def run(batches):
        for batch in batches:
            packed = []
            for at in batch.column("at").to_pylist():
                lo, hi = tx.merged(np.sort(np.array(at, dtype=np.int64)), np.sort(np.array(at, dtype=np.int64)) + length)
                packed.append(np.stack([lo, hi], axis=1).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("dig"), pa.array(packed, pa.binary())], ["id", "dig", "spans"])

    return run


def repeated_spans(texts: DataFrame, length: int = 400) -> DataFrame:
    """``id, dig, spans``: packed int64 pairs (start, end) of bytes in strings of ``length`` bytes that also
    start elsewhere; a document has several rows. ``texts`` has ``id, dig, text``, see tx.keyed."""
    # repeated rows give a segment again at the same place: what counts is different places
    place = F.xxhash64("id", "dig", "start")
    places = [F.min("place").alias("lo"), F.max("place").alias("hi")]
    rows = cut(texts.mapInArrow(_segments(length), _SEGMENTS), "segments").withColumn("place", place)
    often = cut(rows.groupBy("anchor").agg(*places).where("lo != hi").select("anchor"), "often")
    rows = cut(rows.drop("place").join(often, "anchor", "left_semi"), "candidates").withColumn("place", place)
    kinds = cut(rows.groupBy("anchor", "digest").agg(*places), "kinds")
    many = cut(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")), "many")
    known = kinds.join(many, "anchor").selectExpr("anchor", "digest", "lo as one", "lo = hi as alone", "kinds")
    marked = rows.join(known, ["anchor", "digest"]).selectExpr(
        "anchor", "id", "dig", "start", "starts", "alone", "kinds", "kinds > 1 and place = one as stands"
    )
    marked = cut(marked.where("stands or not alone"), "marked")
    need = marked.where("stands")
    total = need.where(f"kinds <= {MOST_SEGMENTS}").agg(F.sum(F.col("starts") + length)).first()[0] or 0
    buckets = max(2 * tx.tasks(texts), -(-total // BUCKET_BYTES))
    bucket = F.when(F.col("kinds") > MOST_SEGMENTS, -1).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(buckets))).alias("bucket")
    wanted = F.struct(bucket, "anchor", "start", "starts", "alone")
    wanted = need.select("id", "dig", wanted.alias("w")).groupBy("id", "dig").agg(F.collect_set("w").alias("wanted"))
    wanted = wanted.withColumn("hot", F.exists("wanted", lambda w: w["bucket"] == -1))
    found = texts.join(wanted, ["id", "dig"]).dropDuplicates(["id", "dig"])
    plain = found.select("id", "dig", "text", F.filter("wanted", lambda w: w["bucket"] >= 0).alias("wanted"))
    indexed = plain.mapInArrow(_sliced(length), _CUTS).groupBy("bucket").applyInArrow(_indexed(length), _SPANS)
    whole = marked.where("not alone")
    pair = F.struct(F.col("start").cast("long").alias("a"), (F.col("start") + F.col("starts") + F.lit(length - 1)).cast("long").alias("b"))
    whole = whole.groupBy("id", "dig").agg(F.collect_list(pair).alias("pairs")).mapInArrow(_pairs, _SPANS)
    spans = indexed.unionByName(whole)
    if need.where(f"kinds > {MOST_SEGMENTS}").limit(1).count():
        # part of the same plan, not a written table, so that one shuffle of the texts serves all joins with them
        hot = texts.join(wanted.where("hot"), ["id", "dig"]).dropDuplicates(["id", "dig"])
        hot = hot.select("id", "dig", "text", F.filter("wanted", lambda w: w["bucket"] < 0).alias("wanted"))
        strings = hot.mapInArrow(_sliced(length), _CUTS).mapInArrow(_strings(length), "h1 long, h2 long, id long, dig long, at long")
        twice = strings.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
        again = strings.join(twice, ["h1", "h2"], "left_semi").groupBy("id", "dig").agg(F.collect_set("at").alias("at"))
        spans = spans.unionByName(again.mapInArrow(_ranges(length), _SPANS))
    return spans


def _pairs(batches):
    for batch in batches:
        packed = []
        for pairs in batch.column("pairs").to_pylist():
            lo = np.array([p["a"] for p in pairs], dtype=np.int64)
            hi = np.array([p["b"] for p in pairs], dtype=np.int64)
            packed.append(np.stack(tx.merged(lo, hi), axis=1).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("dig"), pa.array(packed, pa.binary())], ["id", "dig", "spans"])


def _without(digest: bool):
    def run(batches):
        for rows, data, offsets in tx.chunks(batches, limit=tx.SMALL_CHUNK):
            lo, hi = [], []
            for i, parts in enumerate(rows.column(rows.schema.get_field_index("all")).to_pylist()):
                if parts:
                    pairs = np.concatenate([np.frombuffer(p, dtype=np.int64) for p in parts]).reshape(-1, 2)
                    a, b = tx.merged(pairs[:, 0], pairs[:, 1])
                    lo.append(a + offsets[i])
                    hi.append(b + offsets[i])
            lo = np.concatenate(lo) if lo else np.zeros(0, np.int64)
            hi = np.concatenate(hi) if hi else np.zeros(0, np.int64)
            keep = ~tx.span_mask(lo, hi, len(data))
            at = np.r_[0, np.cumsum(keep)][offsets]
            n, ids = np.diff(offsets), tx.integers(rows, "id")
            out = tx.digests(data[keep], at) if digest else pa.array([bytes(data[keep][a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
            spans = np.diff(np.searchsorted(lo, offsets))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=ids == tx.NULL_ID), pa.array(n), pa.array(n - np.diff(at)), pa.array(spans), out],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def remove_long_matches(docs: DataFrame, length: int = 400, digest: bool = False) -> DataFrame:
    """One row for each document: ``doc_id, n_bytes, n_removed, n_spans, kept``; ``kept`` is the bytes that
    stay (they may end inside a character), or their SHA-256."""
    texts = tx.keyed(docs)
    spans = repeated_spans(texts, length).groupBy("id", "dig").agg(F.collect_list("spans").alias("all"))
    kind = "string" if digest else "binary"
    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {kind}"
    return texts.join(spans, ["id", "dig"], "left").mapInArrow(_without(digest), schema)
