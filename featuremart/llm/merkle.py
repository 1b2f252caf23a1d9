"""Merkle manifest of a dataset: a hash tree over the rows of each group, a tree over the groups' roots, and
for each row the proof that leads from its leaf to the root.

H is lowercase hex SHA-256 of hex texts put together. A row's leaf covers the named columns, each with its
length. In a group leaves ascend by key; every ``fanout`` consecutive nodes become one, until one is left.

Leaves (not texts) are range-sorted and numbered: a running number in each range, plus the counts of the
ranges before it. Then they are dealt to aligned blocks of ``fanout ** HEIGHT`` leaves. A block hashes its
own subtree; above it blocks run a butterfly: in round r the blocks that differ only in digit r of their
number (to the base ``fanout``) meet, at most ``fanout`` of them, and each takes the roots of the others'
subtrees, which are its proof of that level, and hashes the common ancestor for itself. So every block has
its way to the root after the last round, and nothing is sent downwards. Only the last subtree of a level
may be incomplete; where it has no block with the digits that are asked for, its root is taken from the
group's last block, one row for each group.

Cases: null in a column is ``-``; a null group comes first; null keys are the smallest; rows with one key
are ordered by leaf, and equal rows are leaves of their own; a single leaf is its group's root, without any
hashing; an empty table gives no rows. A text is hashed in the task that reads it and isn't sent on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.sources.scratch import cut

from . import text as tx

FANOUT = 8
#: Levels of the tree inside a block.
HEIGHT = 3
_STEPS = "array<struct<left:string,right:string>>"


def leaf_of(columns: Sequence[Column]) -> Column:
    """H of the values, each written as ``-`` if null, else as its UTF-8 length, a colon and itself."""

    def field(value: Column) -> Column:
        said = value.cast("string")
        return F.when(said.isNull(), "-").otherwise(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said))

    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def _number(batches):
    """Adds the task's number and the row's number in its group inside the task; rows come sorted by group."""
    part, group, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = batch.column("grp")
        code = groups.dictionary_encode().indices.to_numpy()
        new = np.r_[True, code[1:] != code[:-1]]
        heads = np.flatnonzero(new)
        nth = np.arange(len(code)) - heads[np.cumsum(new) - 1]
        if groups[0].as_py() == group:
            nth[: heads[1] if len(heads) > 1 else None] += count
        group, count = groups[-1].as_py(), int(nth[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(code), part, dtype=np.int32)), pa.array(nth)],
            [*batch.schema.names, "part", "nth"],
        )


def _numbered(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``size`` of the group and ``pos``, the leaf's number in it."""
    order = ["grp", "id", "leaf", "tie"]
    rows = leaves.withColumn("tie", F.monotonically_increasing_id())  # equal rows too are dealt to several ranges
    rows = rows.repartitionByRange(tx.tasks(leaves), *order).sortWithinPartitions(*order).drop("tie")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    rows = cut(rows.mapInArrow(_number, f"{fields}, part int, nth long"), "numbered")
    here = rows.groupBy("grp", "part").agg(F.count("*").alias("here"))
    group = Window.partitionBy("grp")
    before = F.sum("here").over(group.orderBy("part")) - F.col("here")
    here = here.select("grp", "part", before.alias("before"), F.sum("here").over(group).alias("size"))
    placed = rows.join(here, ["grp", "part"])
    return placed.select("grp", "size", (F.col("before") + F.col("nth")).alias("pos"), "id", "leaf", "more")


def _levels(leaves: list[str], size: int, fanout: int, height: int) -> list[list[str]]:
    """The nodes of a block, level by level: ``height`` levels of a group with several blocks, else all."""
    levels = [leaves]
    while len(levels) <= height if size > fanout**height else len(levels[-1]) > 1:
        below = levels[-1]
        joined = ("".join(below[a : a + fanout]) for a in range(0, len(below), fanout))
        levels.append([hashlib.sha256(x.encode()).hexdigest() for x in joined])
    return levels


def _leaves(table: pa.Table) -> tuple[np.ndarray, list[str]]:
    order = np.argsort(table.column("pos").to_numpy())
    return order, table.column("leaf").take(order).to_pylist()


def _block_root(fanout: int, height: int):
    def run(table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        top = _levels(_leaves(table)[1], size, fanout, height)[-1][0]
        return pa.table(
            {
                "grp": table.column("grp").slice(0, 1),
                "blocks": pa.array([-(-size // fanout**height)], pa.int64()),
                "block": table.column("block").slice(0, 1),
                "top": pa.array([top], pa.string()),
            }
        )

    return run


def _swapped(state: DataFrame, width: int, fanout: int) -> DataFrame:
    """One round: ``width`` blocks lie below a node of this level."""
    blocks = state.where(F.col("blocks") > width).withColumn("digit", F.expr(f"block div {width} % {fanout}"))
    keys = [F.col("grp"), F.col("blocks"), F.expr(f"block div {width * fanout}").alias("up"), F.expr(f"block % {width}").alias("low")]
    met = blocks.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("digit", "block", "top", "proof"))).alias("met"))
    last = blocks.where("block = blocks - 1").select("grp", F.col("top").alias("last"))
    there = F.expr(f"least({fanout}, (blocks + {width - 1}) div {width} - up * {fanout})")
    nodes = F.col("met.top")
    nodes = F.when(F.size("met") < there, F.concat(nodes, F.array("last"))).otherwise(nodes)
    each = met.join(last, "grp").select("grp", "blocks", nodes.alias("nodes"), F.explode("met").alias("m"))
    step = F.struct(
        F.expr("array_join(slice(nodes, 1, cast(m.digit as int)), '')").alias("left"),
        F.expr(f"array_join(slice(nodes, cast(m.digit as int) + 2, {fanout}), '')").alias("right"),
    )
    each = each.select(
        "grp", "blocks", "m.block", F.sha2(F.array_join("nodes", ""), 256).alias("top"),
        F.concat("m.proof", F.array(step)).alias("proof"),
    )
    return each.unionByName(state.where(F.col("blocks") <= width))


def _unfold(fanout: int, height: int, names: list[str]):
    """A block's leaves and its own row -> its leaves with their proofs and their group's root."""

    def run(table: pa.Table, own: pa.Table) -> pa.Table:
        order, leaves = _leaves(table)
        levels = _levels(leaves, table.column("size")[0].as_py(), fanout, height)[:-1]
        above = own.column("proof")[0].as_py()
        left, right, edges = [], [], [0]
        for i in range(len(leaves)):
            for nodes in levels:
                a = i - i % fanout
                left.append("".join(nodes[a:i]))
                right.append("".join(nodes[i + 1 : a + fanout]))
                i //= fanout
            left.extend(s["left"] for s in above)
            right.extend(s["right"] for s in above)
            edges.append(len(left))
        steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"])
        top = pa.array([own.column("top")[0].as_py()] * len(leaves), pa.string())
        kept = [table.column(n).take(order) for n in names]
        return pa.table([*kept, pa.ListArray.from_arrays(pa.array(edges, pa.int32()), steps), top], [*names, "proof", "top"])

    return run


def hash_trees(leaves: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """Trees over ``leaves`` (grp, id, leaf, more), one for each ``grp``, ordered by id.

    Gives ``grp, pos, id, leaf, more, proof, top`` for each leaf, and ``grp, top`` for each group. A proof
    has a step for each level, the nodes left and right of the own one in its run, put together.
    """
    placed = _numbered(leaves)
    longest = placed.agg(F.max("size")).first()[0] or 0
    blocks = placed.withColumn("block", F.expr(f"pos div {fanout**height}"))
    state = blocks.groupBy("grp", "block").applyInArrow(_block_root(fanout, height), "grp string, blocks long, block long, top string")
    state = cut(state.withColumn("proof", F.expr(f"cast(array() as {_STEPS})")), "blocks")
    width = 1
    while width * fanout**height < longest:
        state = cut(_swapped(state, width, fanout), "swapped")
        width *= fanout
    names = ["grp", "pos", "id", "leaf", "more"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.select(*names).schema)
    whole = blocks.groupBy("grp", "block").cogroup(state.groupBy("grp", "block"))
    rows = whole.applyInArrow(_unfold(fanout, height, names), f"{fields}, proof {_STEPS}, top string")
    return rows, state.where("block = 0").select("grp", "top")


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    key: str = "doc_id",
    more: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``key`` (as a long), ``position, leaf, proof, subroot, root`` for each row of ``docs``, and the
    columns ``more``, which are computed from the row. ``proof`` leads from the leaf to ``root`` by way of
    ``subroot``, see :func:`folded`."""
    own = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(tx.NULL_ID))
    named = F.col(f"`{group}`").cast("string")
    extra = F.struct(*(c.alias(n) for n, c in (more or {}).items()), F.lit(0).alias("_"))
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("1"), named), F.lit("0")).alias("grp"),
        own.alias("id"),
        leaf_of([F.col(f"`{c}`") for c in columns]).alias("leaf"),
        extra.alias("more"),
    )
    rows, tops = hash_trees(cut(leaves, "leaves"))
    upper = tops.select(F.lit("").alias("grp"), F.col("grp").alias("id"), F.col("top").alias("leaf"), F.lit(0).alias("more"))
    above, _ = hash_trees(upper)
    above = above.select(F.col("id").alias("grp"), F.col("proof").alias("above"), F.col("top").alias("root"))
    return rows.join(above, "grp").select(
        F.when(F.col("id") != tx.NULL_ID, F.col("id")).alias(key),
        *(F.col("more")[n].alias(n) for n in more or {}),
        F.col("pos").alias("position"),
        "leaf",
        F.concat("proof", "above").alias("proof"),
        F.col("top").alias("subroot"),
        "root",
    )
