"""SimHash near-dedup by tiled exact comparison.

Distinct fingerprints are grouped by the population counts of ``m`` blocks of their 64 bits and cut into
tiles. Two fingerprints within ``radius`` bits have block counts that differ by ``radius`` in sum at most,
so tile pairs beyond that are skipped; every other pair of tiles is compared in full with exclusive-or and
bit counts. ``m`` follows the number of fingerprints, since one count (m = 1) skips only half of the pairs.
Documents with equal fingerprints are one node. A task turns the links of a tile pair into a spanning
forest before it gives them out, so a group of thousands of near copies yields as many edges as it has
members. Components come from rounds of joins.

Work: with n distinct fingerprints and m blocks about n^2 * ball(m) / spread(m) comparisons; m grows with
n (2 at 10^5, 6 at 10^7, 12 at 10^10), which keeps the comparisons for each fingerprint within some 10^5
to 10^6 instead of n.

Cases: null or empty text, or white space alone, has fingerprint zero, linked like any other; fewer
words than a shingle make one shingle of what there is; null doc_id rows take part, and a component
without any id has a null component_id; repeated rows are linked with each other; a very long text is
hashed whole, in the memory of one task.
"""

from __future__ import annotations

from itertools import product
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.sources.scratch import cut

from . import text as tx
from .components import components
from .xxh64 import xxh64_spans

#: Fingerprints in a tile at most.
TILE = 4096


def _fingerprints(shingle: int):
    def run(batches):
        for rows, data, offsets in tx.chunks(batches, limit=tx.SMALL_CHUNK):
            starts, ends, _ = tx.words_of(data, offsets)
            low, edges = tx.joined_words(tx.LOWER[data], offsets, starts, ends)
            s, e, first = tx.words_of(low, edges)
            n = np.diff(first)
            count = np.where(n > 0, np.maximum(n - shingle + 1, 1), 0)
            doc_first = np.r_[0, np.cumsum(count)]
            at = np.repeat(first[:-1] - doc_first[:-1], count) + np.arange(doc_first[-1])
            stop = np.minimum(at + shingle, np.repeat(first[1:], count)) - 1
            hashes = xxh64_spans(low, s[at], e[stop], 42)
            bits = np.zeros((len(count), 64), dtype=np.int64)
            some = np.flatnonzero(count)
            if len(some):
                step = 1 << 16  # shingles whose bits are spread out at once
                for a in range(0, len(hashes), step):
                    part = np.unpackbits(hashes[a : a + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    d = np.searchsorted(doc_first, np.arange(a, a + len(part)), side="right") - 1
                    heads = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
                    bits[d[heads]] += np.add.reduceat(part, heads, axis=0, dtype=np.int64)
            chosen = (2 * bits > count[:, None]).astype(np.uint8)
            prints = np.packbits(chosen, axis=1, bitorder="little").view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("dig"), pa.array(prints)], ["id", "dig", "print"]
            )

    return run


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``id, dig, print`` for each row; ``print`` is the 64-bit fingerprint as a long."""
    return tx.keyed(docs).mapInArrow(_fingerprints(shingle), "id long, dig long, print long")


def blocks_for(n: int, radius: int) -> int:
    """The number of blocks with the least estimated work for ``n`` distinct fingerprints."""

    def ball(m: int) -> int:
        return sum(2**k * comb(m, k) * comb(radius, k) for k in range(min(m, radius) + 1))

    def work(m: int) -> float:
        spread = max(1.0, (4.13 * (16 / m) ** 0.5) ** m)  # of m counts, each over 64 / m fair bits
        return n * n * min(1, ball(m) / spread) / 2 + min(n, spread) * ball(m) * 20_000  # a row sent costs as much

    return min((1, 2, 3, 4, 6, 8, 12, 16), key=work)


def _block_masks(m: int) -> list[int]:
    at = [64 * j // m for j in range(m + 1)]
    return [((1 << b) - (1 << a)) & (2**64 - 1) for a, b in zip(at[:-1], at[1:], strict=True)]


def _keys(m: int):
    """``key``: the block counts of a fingerprint, a byte each."""
    masks = [np.uint64(x) for x in _block_masks(m)]

    def run(batches):
        for batch in batches:
            prints = batch.column("print").to_numpy().view(np.uint64)
            counts = np.stack([np.bitwise_count(prints & x) for x in masks], axis=1).astype(np.uint8)
            keys = pa.array([c.tobytes() for c in counts], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, batch.column("print")], ["key", "print"])

    return run


def _pack(table: pa.Table) -> pa.Table:
    """The fingerprints of a tile as one packed array; the number of pieces bounds the group."""
    prints = np.sort(table.column("print").to_numpy())
    return pa.table(
        {
            "key": pa.array([table.column("key")[0].as_py()], pa.binary()),
            "piece": pa.array([table.column("piece")[0].as_py()], pa.int32()),
            "prints": pa.array([prints.tobytes()], pa.binary()),
        }
    )


def _near_keys(m: int, radius: int):
    """A row for each equal or larger key that a tile's key may pair with."""

    def steps(blocks: int, left: int):
        if not blocks:
            yield ()
            return
        for d in range(-left, left + 1):
            for rest in steps(blocks - 1, left - abs(d)):
                yield (d, *rest)

    near = np.array(list(steps(m, radius)), dtype=np.int16)

    def run(batches):
        for batch in batches:
            own, other, piece, packed = [], [], [], []
            for key, p, prints in zip(*(batch.column(c).to_pylist() for c in ("key", "piece", "prints")), strict=True):
                at = np.frombuffer(key, dtype=np.uint8).astype(np.int16) + near
                for row in at[((at >= 0) & (at <= 64)).all(axis=1)].astype(np.uint8):
                    if (near_key := row.tobytes()) >= key:
                        own.append(key)
                        other.append(near_key)
                        piece.append(p)
                        packed.append(prints)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.binary()), pa.array(other, pa.binary()), pa.array(piece, pa.int32()), pa.array(packed, pa.binary())],
                ["key", "other", "piece", "prints"],
            )

    return run


def _links(radius: int):
    """Rows of two tiles -> edges of a spanning forest of their links."""

    def forest(a: np.ndarray, b: np.ndarray, same: bool):
        nodes = np.unique(a if same else np.r_[a, b])
        root = np.arange(len(nodes))
        at_a, at_b = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
        strip = max(1, (1 << 20) // max(1, len(b)))
        for i in range(0, len(a), strip):
            close = np.bitwise_count(a[i : i + strip, None] ^ b[None, :]) <= radius
            x, y = np.nonzero(close)
            x, y = at_a[i + x], at_b[y]
            x, y = x[x != y], y[x != y]
            while len(x):  # hook the larger root on the smaller one, then shorten the paths
                rx, ry = root[x], root[y]
                open_ = rx != ry
                if not open_.any():
                    break
                x, y, rx, ry = x[open_], y[open_], rx[open_], ry[open_]
                np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
                while True:
                    short = root[root]
                    if (short == root).all():
                        break
                    root = short
        hooked = np.flatnonzero(root != np.arange(len(nodes)))
        return nodes[hooked].view(np.int64), nodes[root[hooked]].view(np.int64)

    def run(batches):
        for batch in batches:
            for pa_, pb, same in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "same")), strict=True):
                u, v = forest(np.frombuffer(pa_, np.uint64), np.frombuffer(pb, np.uint64), same)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def links(prints: DataFrame, radius: int = 3, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """``u, v``: edges between distinct fingerprints (column ``print``) that connect just those that links
    within ``radius`` bits connect. A key with more prints than a tile holds is cut into pieces, and each
    pair of pieces is a row of its own, so a dense key spreads over tasks."""
    prints = cut(prints.select("print").distinct(), "prints")
    m = blocks or blocks_for(prints.count(), radius)
    keys = prints.mapInArrow(_keys(m), "key binary, print long")
    pieces = keys.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("pieces"))
    piece = F.expr("cast(pmod(xxhash64(print), pieces) as int)").alias("piece")
    # dealt anew: after the join all pieces of a key lie in one task
    tiles = keys.join(pieces, "key").select("key", piece, "print").repartition("key", "piece").groupBy("key", "piece")
    tiles = cut(tiles.applyInArrow(_pack, "key binary, piece int, prints binary"), "tiles")
    pieces = tiles.groupBy(F.col("key").alias("other")).agg((F.max("piece") + 1).alias("pieces"))
    # each tile goes to the tiles of equal or larger keys; these stay at home
    sent = tiles.mapInArrow(_near_keys(m, radius), "key binary, other binary, piece int, prints binary")
    sent = sent.join(pieces, "other").withColumn("mate", F.explode(F.expr("sequence(0, pieces - 1)")))
    sent = sent.where("key < other or piece <= mate").select("other", "mate", "key", "piece", F.col("prints").alias("a"))
    home = tiles.select(F.col("key").alias("other"), F.col("piece").alias("mate"), F.col("prints").alias("b"))
    pairs = sent.join(home, ["other", "mate"])
    return pairs.select("a", "b", F.expr("key = other and piece = mate").alias("same")).mapInArrow(_links(radius), "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, group: str | None = None) -> DataFrame:
    """``id, dig, print, component_id`` for each row of ``docs``; component_id is the smallest doc_id
    among the documents that links connect, null if none has an id. ``group`` names one more column, a
    number that a component's rows share (component_id cannot tell components without ids apart)."""
    prints = cut(fingerprints(docs, shingle), "fingerprints")
    lowest = prints.groupBy("print").agg(F.min(tx.real_id()).alias("low"))
    roots = components(links(prints, radius))
    nodes = lowest.join(roots.withColumnRenamed("node", "print"), "print", "left")
    nodes = nodes.select("print", "low", F.coalesce("root", "print").alias("root"))
    classes = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    more = [F.col("root").alias(group)] if group else []
    label = cut(nodes.join(classes, "root").select("print", "component_id", *more), "classes")
    return prints.join(label, "print")
