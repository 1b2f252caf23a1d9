"""Best-fit packing in bulk-synchronous rounds.

Documents are tokenized and cut into pieces. Each round range-sorts pieces and gaps (the free room of a
sequence) together by length, longest first, and sweeps the ranges: a piece takes its successor, the smallest
gap before it that holds it, and what remains of the gap goes back among the gaps of the range. Conflicts
between ranges are settled by rank: a range leaves the pieces and gaps it could not match, the counts of
the ranges before it give each of them its level, and on a level a gap goes to the next piece, as brackets
match. Such a gap is offered in as many parts as hold any later piece. Then the gaps are updated, and the
round repeats with what is left.

The first round has the pieces longer than an eighth (``SPREAD``) of the capacity, each later one admits those
longer than an eighth of that bound, so that short ones do not take gaps from long ones. Pieces longer than every gap open sequences: one each above half the capacity,
together no fewer than their lengths fill.

Pieces and gaps stay tables; each round's are written to the shared folder. The driver sees their counts by
length (``capacity`` rows at most) and two counts for each range. A level holds one piece and one gap of
each range at most, a sequence ``capacity`` pieces.

Cases: null or empty text is its end token alone; repeated rows are packed each; ties in length go by
doc_id (null first), text digest and piece; a very long text is encoded in one task; an empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from featuremart.sources.scratch import cut

from . import text as tx
from .tokens import encoder

#: Each round admits pieces longer than this part of the bound of the round before.
SPREAD = 8
#: Gaps are offered to later ranges in parts, about this many for each piece of the round at most.
PARTS = 16
#: Pieces and gaps in one range of a sweep.
EVENTS = 200_000

_PIECES = "id long, dig long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, end: int, capacity: int):
    def run(batches):
        encode = encoder(path).encode
        for rows, data, offsets in tx.chunks(batches, limit=tx.SMALL_CHUNK):
            ids, at = encode(data, offsets)
            n = np.diff(at) + 1
            many = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), many)
            piece = np.arange(len(doc)) - np.r_[0, np.cumsum(many)[:-1]][doc]
            first = n - (many - 1) * capacity  # the first piece may be shorter
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[doc], capacity)
            with_end = np.empty(at[-1] + len(n), dtype="<u4")
            last = at[1:] + np.arange(len(n))
            with_end[last] = end
            own = np.ones(len(with_end), dtype=bool)
            own[last] = False
            with_end[own] = ids
            lo = (at[:-1] + np.arange(len(n)))[doc] + start
            raw = memoryview(with_end.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(lo.tolist(), (lo + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tx.integers(rows, "id")[doc]),
                    pa.array(tx.integers(rows, "dig")[doc]),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start.astype(np.int64)),
                    pa.array(length.astype(np.int64)),
                    pa.array(crc, pa.int64()),
                ],
                ["id", "dig", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(docs: DataFrame, path: str, end: int = 2, capacity: int = 1024) -> DataFrame:
    """``id, dig, piece, start, length, ids_crc32`` of each document's token ids with ``end`` behind them."""
    return tx.keyed(docs).mapInArrow(_pieces(path, end, capacity), _PIECES)


def _swept(schema: pa.Schema, longest: int, most: int):
    """Sweeps one range. Pieces come out with ``_seq`` if a gap of this range took them; the other pieces and
    the gaps left over, smallest last, with ``_at``, their place among them."""

    def run(batches):
        part, lone, shortest = TaskContext.get().partitionId(), 0, 1
        free, lengths = defaultdict(list), 0  # gap -> sequences; the bits of the gaps there are
        for batch in batches:
            opens = batch.column("_opens").to_pylist()
            taken, at = [None] * len(opens), [None] * len(opens)
            for i, (opening, seq, n) in enumerate(
                zip(opens, batch.column("_seq").to_pylist(), batch.column("length").to_pylist(), strict=True)
            ):
                shortest = n
                if not opening:
                    longer = lengths >> n
                    if not longer:
                        at[i], lone = lone, lone + 1
                        continue
                    gap = n + (longer & -longer).bit_length() - 1
                    taken[i] = seq = free[gap].pop()
                    if not free[gap]:
                        lengths ^= 1 << gap
                    n = gap - n
                if n:
                    free[n].append(seq)
                    lengths |= 1 << n
            columns = [batch.column(n) for n in schema.names[:-3]]
            columns += [pa.array(taken, pa.int64()), pa.array([part] * len(at), pa.int32()), pa.array(at, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array([not o for o in opens], pa.bool_()))
        hold = min(longest, shortest)  # no later piece is longer
        rest = [(g, s) for g in sorted(free, reverse=True) if g >= shortest for s in free[g] for _ in range(min(most, g // hold))]
        columns = [pa.nulls(len(rest), f.type) for f in list(schema)[:-4]]
        columns += [pa.array([True] * len(rest), pa.bool_()), pa.array([s for _, s in rest], pa.int64())]
        columns += [pa.array([part] * len(rest), pa.int32()), pa.array(range(len(rest)), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return run


def _matched(active: DataFrame, gaps: DataFrame, longest: int, most: int, ranges: int) -> DataFrame:
    """``active`` (pieces up to ``longest``) with ``_seq``, the sequence whose gap took the piece, or null. A gap
    is offered to later ranges in ``most`` parts at most."""
    names = active.columns
    opening = gaps.select(
        *[(F.col("_gap") if f.name == "length" else F.lit(None)).cast(f.dataType).alias(f.name) for f in active.schema],
        F.lit(True).alias("_opens"),
        "_seq",
    )
    closing = active.select(*names, F.lit(False).alias("_opens"), F.lit(None).cast("long").alias("_seq"))
    order = [F.desc("length"), F.desc("_opens"), F.asc("id"), F.asc("dig"), F.asc("piece"), F.asc("_seq")]
    events = opening.union(closing).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    out = T.StructType([*events.schema, T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType())])
    swept = cut(events.mapInArrow(_swept(to_arrow_schema(out), longest, most), out), "swept")

    lone = swept.where("_at IS NOT NULL")
    counts = lone.groupBy("_part").agg(F.count_if("_opens").alias("gaps"), F.count_if(~F.col("_opens")).alias("pieces"))
    depth, levels = 0, []
    for r in sorted(counts.collect(), key=lambda r: r["_part"]):  # one row for each range
        levels += [(r["_part"], False, depth, -1), (r["_part"], True, depth - r["pieces"] + 1, 1)]
        depth += r["gaps"] - r["pieces"]
    start = swept.sparkSession.createDataFrame(levels, "_part int, _opens boolean, _start long, _step int")
    leveled = lone.join(F.broadcast(start), ["_part", "_opens"]).withColumn("_level", F.expr("_start + _step * _at"))
    before = Window.partitionBy("_level").orderBy("_part", "_opens")
    taken = leveled.withColumn("_seq", F.when(~F.col("_opens"), F.lag("_seq").over(before)))
    return swept.where("_at IS NULL").select(*names, "_seq").union(taken.where(~F.col("_opens")).select(*names, "_seq"))


def _by_length(df: DataFrame, name: str) -> dict[int, int]:
    """How many rows have each length: ``capacity`` numbers at most."""
    return {r[0]: r[1] for r in df.groupBy(name).count().collect()}


def pack(rows: DataFrame, capacity: int = 1024, events: int = EVENTS) -> DataFrame:
    """``rows`` (with ``id, dig, piece, length``; lengths from 1 to ``capacity``) with ``sequence_id`` and ``offset``.
    A range of a sweep has some ``events`` pieces and gaps."""
    spark, names = rows.sparkSession, rows.columns
    waiting, low = _by_length(rows, "length"), capacity  # not admitted yet: lengths up to low
    left, many = rows.limit(0), {}
    gaps, free = spark.createDataFrame([], "_seq long, _gap long"), {}
    opened, placed = 0, []
    while many or waiting:
        bound = low // SPREAD
        active = left.union(rows.where((F.col("length") > bound) & (F.col("length") <= low)))
        for length in [n for n in waiting if n > bound]:
            many[length] = many.get(length, 0) + waiting.pop(length)
        low = bound
        if not many:
            continue

        widest = max(free, default=0)
        stuck = {n: k for n, k in many.items() if n > widest}
        new = max(sum(k for n, k in stuck.items() if 2 * n > capacity), -(-sum(n * k for n, k in stuck.items()) // capacity))
        if new:
            fresh = spark.range(opened, opened + new).select(F.col("id").alias("_seq"), F.lit(capacity).cast("long").alias("_gap"))
            gaps, opened = gaps.union(fresh), opened + new
            free[capacity] = free.get(capacity, 0) + new

        shortest, longest = min(many), max(many)
        total, fitting = sum(many.values()), sum(k for g, k in free.items() if g >= shortest)
        most = -(-PARTS * total // fitting)
        found = _matched(active, gaps.where(F.col("_gap") >= shortest), longest, most, 1 + (total + fitting) // events)
        settled = cut(found, "settled")
        took, left = settled.where("_seq IS NOT NULL"), settled.where("_seq IS NULL").drop("_seq")
        placed.append(took)
        change = took.select("_seq", (-F.col("length")).alias("_gap"))
        gaps = cut(gaps.union(change).groupBy("_seq").agg(F.sum("_gap").alias("_gap")).where("_gap > 0"), "gaps")
        many, free = _by_length(left, "length"), _by_length(gaps, "_gap")

    if not placed:
        return rows.select(*names, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    inside = Window.partitionBy("_seq").orderBy(F.desc("length"), "id", "dig", "piece")
    offset = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    return reduce(DataFrame.union, placed).select(*names, F.col("_seq").alias("sequence_id"), offset.alias("offset"))


def pack_documents(docs: DataFrame, path: str, end: int = 2, capacity: int = 1024) -> DataFrame:
    """``id, dig, piece, start, length, ids_crc32, sequence_id, offset`` for each piece of each row."""
    return pack(cut(pieces(docs, path, end, capacity), "pieces"), capacity)
