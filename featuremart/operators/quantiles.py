"""Exact order statistics per group without gathering a group.

``percentile`` and ``percentile_disc`` hold every distinct value of a group in one task. Here an
approximate sketch brackets each wanted rank first; only values inside a bracket are ordered, and the
rows below it are counted. The sketch's rank error has a guaranteed bound, so the wanted rank lies
inside its bracket and the result is exact; a rank outside is an error, never another value. A bracket
that holds too many values for one task is cut into parts, of which only those with the rank stay, until
it is small enough.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut
from .schema import quoted


#: Distinct values that are ordered in one task, at most.
MOST = 100_000
#: Parts that a larger bracket is cut into in each round.
PARTS = 256
OUTSIDE = "a rank lies outside its bracket; raise accuracy"


def sketch(value: str, probs: Sequence[float], accuracy: int) -> Column:
    """Approximate quantiles at the probabilities, as an array; the rank error is 1 / accuracy.

    The probabilities go in as one text literal, so that a long list does not bloat the plan.
    """
    points = ",".join(repr(float(p)) for p in probs)
    return F.expr(f"percentile_approx({value}, CAST(split('{points}', ',') AS ARRAY<DOUBLE>), {int(accuracy)})")


def _brackets(rows: DataFrame, probs: Sequence[float], keys: Sequence[Column], accuracy: int) -> DataFrame:
    """Per group: the row count, and for each probability a lower and an upper bound of its value."""
    k, margins = len(probs), [4.0 / accuracy]
    while margins[-1] < 1:
        margins.append(margins[-1] * 4)
    around = [x for m in margins for x in [max(0.0, p - m) for p in probs] + [min(1.0, p + m) for p in probs]]
    sketched = rows.groupBy(*keys).agg(
        F.expr("count(1) AS _n"),
        sketch("_v", around, accuracy).alias("_sketch"),
    )
    # The narrowest margin of at least four ranks: wanted ranks lie within one of p * n, the sketch errs by
    # less than one more, or by n / accuracy where that is more.
    level = f"CAST(least({len(margins) - 1}, greatest(0, ceil(ln({accuracy} / greatest(_n, 1)) / ln(4)))) AS INT)"
    return sketched.withColumn("_at", F.expr(f"1 + {2 * k} * {level}")).select(
        *keys,
        "_n",
        F.expr(f"slice(_sketch, _at, {k}) AS _low"),
        F.expr(f"slice(_sketch, _at + {k}, {k}) AS _high"),
    )


def _bracketed_counts(
    df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str], accuracy: int
) -> tuple[DataFrame, int]:
    """Per (keys, i): counts of values by value inside bracket i; all values below the bracket share
    one row with a null value. And a bound on the distinct values inside any bracket.

    A value outside all brackets only matters by the gap it lies in, so the rows collapse to one
    count per gap and one per value inside a bracket before anything is spread over the i.
    """
    cols, indexes = [quoted(k) for k in keys], range(len(probs))
    rows = df.select(*cols, quoted(value).alias("_v")).filter("_v IS NOT NULL")
    brackets = cut(_brackets(rows, probs, cols, accuracy), "brackets")
    largest = brackets.agg(F.max("_n")).first()[0] or 0
    if keys:
        attach = lambda x: x.join(brackets, on=list(keys), how="inner")
    else:
        one = brackets.select(F.struct("_n", "_low", "_high")).scalar()
        attach = lambda x: x.withColumn("_b", one).select("*", "_b.*").drop("_b")

    inside = " OR ".join(f"_v BETWEEN _low[{i}] AND _high[{i}]" for i in indexes)
    passed = " + ".join(f"IF(_high[{i}] < _v, 1, 0)" for i in indexes)
    collapsed = (
        attach(rows)
        .groupBy(*cols, F.expr(f"IF({inside}, _v, NULL) AS _v"), F.expr(f"IF({inside}, NULL, {passed}) AS _gap"))
        .agg(F.expr("count(1) AS _c"))
    )
    # Below bracket i: a null value. Above it: nothing.
    spots = ", ".join(
        f"CASE WHEN coalesce(_v < _low[{i}], _gap <= {i}) THEN named_struct('_i', {i}, '_v', CAST(NULL AS {{t}})) "
        f"WHEN _v <= _high[{i}] THEN named_struct('_i', {i}, '_v', _v) END"
        for i in indexes
    ).format(t=rows.schema["_v"].dataType.simpleString())
    counts = (
        attach(collapsed)
        .select(*cols, "_n", "_c", F.expr(f"explode(array_compact(array({spots}))) AS _s"))
        .groupBy(*cols, "_n", "_s._i", "_s._v")
        .agg(F.expr("sum(_c) AS _c"))
    )
    # the margin on both sides, and the sketch's error at both ends; in small groups all values at most
    return counts, max(accuracy, 10 * largest // accuracy)


def _refined(counts: DataFrame, wanted: Sequence[Column], keys: Sequence[str], most: int) -> DataFrame:
    """``counts`` with at most ``most`` values in a bracket: what lies below the wanted ranks has moved into
    the row with the null value, what lies above is gone. The parts of a round are counted exactly, so the
    result does not depend on how well a sketch cuts them."""
    own = [*[quoted(k) for k in keys], F.col("_i")]
    names = [*keys, "_i"]
    inner = [i / PARTS for i in range(1, PARTS)]
    while True:
        counts = cut(counts, "bracketed")
        sizes = counts.groupBy(*own).agg(F.count("_v").alias("_d"), sketch("_v", inner, 10 * PARTS).alias("_edges"))
        edges = cut(sizes.filter(F.col("_d") > most).drop("_d"), "edges")
        if edges.isEmpty():
            return counts
        parted = counts.join(edges, names, "left").withColumn(
            "_part", F.expr("IF(_v IS NULL, -1, size(filter(_edges, e -> e < _v)))")
        )
        large = F.col("_edges").isNotNull()
        parts = parted.filter(large).groupBy(*own, "_n", "_part").agg(F.sum("_c").alias("_c"))
        parts = parts.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*own).orderBy("_part")))
        holds = F.lit(False)
        for rank in wanted:
            holds = holds | ((F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto")))
        hit = F.when(holds & (F.col("_part") >= 0), F.col("_part"))
        kept = parts.groupBy(*own, "_n").agg(
            F.coalesce(F.min(hit), F.raise_error(F.lit(OUTSIDE)).cast("int")).alias("_first"),
            F.max(hit).alias("_last"),
            F.min(F.when(hit.isNotNull(), F.col("_upto") - F.col("_c"))).alias("_base"),
        )
        kept = cut(kept, "kept-parts")
        columns = [*names, "_n", "_v", "_c"]
        inside = parted.filter(large).drop("_n").join(kept, names).filter("_part BETWEEN _first AND _last")
        below = kept.withColumn("_v", F.lit(None).cast(counts.schema["_v"].dataType)).withColumnRenamed("_base", "_c")
        counts = (
            inside.select(*map(quoted, columns))
            .unionByName(below.select(*map(quoted, columns)))
            .unionByName(parted.filter(~large).select(*map(quoted, columns)))
        )


def order_statistics(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    ranks: Callable[[Column, Column], dict[str, Column]],
    keys: Sequence[str] = (),
    accuracy: int = 10_000,
    most: int = MOST,
) -> DataFrame:
    """Exact values at wanted ranks, one row per (keys, i) for the i-th probability.

    ``ranks(n, p)`` names the zero-based ranks to fetch, each within one rank of p * n. Nulls are
    left out. No task orders more than ``most`` distinct values of a group, however large it is (a few
    more if ``accuracy`` is above it): larger brackets are refined in rounds.
    """
    counts, distinct = _bracketed_counts(df, value, probs, keys, accuracy)
    cols = [quoted(k) for k in keys]
    p = F.element_at(F.array(*map(F.lit, probs)), F.col("_i") + 1)
    wanted = ranks(F.col("_n"), p)
    if distinct > most:
        counts = _refined(counts, list(wanted.values()), keys, most)
    upto = Window.partitionBy(*cols, "_i").orderBy(F.col("_v").asc_nulls_first())
    below = F.coalesce(F.max(F.when(F.col("_v").isNull(), F.col("_upto"))), F.lit(0))

    def found(rank: Column) -> Column:
        inside = (below <= rank) & (F.max("_upto") > rank)
        missed = F.raise_error(F.lit(OUTSIDE))
        return F.when(inside, F.min(F.when(F.col("_upto") > rank, F.col("_v")))).otherwise(missed)

    return (
        counts.withColumn("_upto", F.sum("_c").over(upto))
        .groupBy(*cols, "_i", "_n")
        .agg(*[found(r).alias(name) for name, r in wanted.items()])
    )


def exact_quantile(
    df: DataFrame, columns: Sequence[str], q: float, keys: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """The smallest value whose share of values at or below it reaches q, per group and column.

    The columns are melted, so one pass serves all of them; the result is wide again.
    """
    cols = [quoted(k) for k in keys]
    melted = df.select(
        *cols,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("_column"), quoted(c).cast("double").alias("_value"))
                    for c in columns
                ]
            )
        ).alias("_p"),
    ).select(*cols, "_p._column", "_p._value")
    stats = order_statistics(
        melted,
        "_value",
        [q],
        lambda n, p: {"cap": F.greatest(F.ceil(p * n) - 1, F.lit(0))},
        keys=[*keys, "_column"],
        accuracy=accuracy,
    )
    return stats.groupBy(*cols).agg(
        *[F.max(F.when(F.col("_column") == c, F.col("cap"))).alias(c) for c in columns]
    )


def linear_percentiles(
    df: DataFrame, value: str, percents: Sequence[int], keys: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per group, columns p10, p25, ..."""
    cols = [quoted(k) for k in keys]
    place = lambda n, p: p * (n - 1)
    stats = order_statistics(
        df,
        value,
        [x / 100 for x in percents],
        lambda n, p: {"lower": F.floor(place(n, p)), "upper": F.ceil(place(n, p))},
        keys=keys,
        accuracy=accuracy,
    )
    p = F.element_at(F.array(*[F.lit(x / 100) for x in percents]), F.col("_i") + 1)
    at = place(F.col("_n"), p)
    between = F.col("lower") + (F.col("upper") - F.col("lower")) * (at - F.floor(at))
    return stats.withColumn("_at", between).groupBy(*cols).agg(
        *[F.max(F.when(F.col("_i") == i, F.col("_at"))).alias(f"p{x}") for i, x in enumerate(percents)]
    )
