"""Quality rules: two plain limits, then robust multivariate outliers by language and source.

Each text gives a vector of transformed statistics: the logarithm of the mean word length and the square
roots of symbols, punctuation marks, capitals, digits and words equal to the word before for each word, and
of lines equal to an earlier one for each line. All are shrunk towards the corpus rate by ``PRIOR_WORDS``
words or ``PRIOR_LINES`` lines so that short texts don't stray by chance. For each (language, source) a
minimum-covariance-determinant estimate of centre and scatter is made, and a text whose squared
Mahalanobis distance exceeds ``cutoff``, a chi-square quantile, is rejected.

The estimate goes in the nested way of FAST-MCD: a group is dealt into blocks of some 2,000 rows by hash,
so a group with a third of all rows is many tasks; every block concentrates to its least determinant; the
blocks of a group are pooled; then concentration steps over all rows of the group refine the pooled
estimate with aggregates that are summed before the shuffle. Texts that fail the plain limits take no part.

Cases: null or empty text has no words and fails; null language or source is a group of its own; a group
with fewer than ``LEAST_ROWS`` usable rows joins the other small sources of its language, these where too
few the small ones of all languages, and those the mean of all estimates; without any estimate the plain
limits decide; a statistic that never varies
gets the scatter floor; repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.sources.scratch import cut

from . import quality_stats as qs
from . import text as tx

LEAST_WORDS, MOST_REPEATED = 20, 30
PRIOR_WORDS, PRIOR_LINES, BLOCK_ROWS, LEAST_ROWS = 100, 10, 2000, 100
#: Share of rows whose scatter is made least, and the added variance of a statistic.
HALF, FLOOR = 0.75, 0.02**2
#: Share of normal rows within the cutoff.
WITHIN = 0.999
#: The statistics behind the mean word length: what is counted, for each of what, shrunk by how many of these.
RATES = [(c, "n_words", PRIOR_WORDS) for c in ("n_symbols", "n_punct", "n_upper", "n_digits", "n_echoes")]
RATES += [("n_dup_lines", "n_lines", PRIOR_LINES)]
P = 1 + len(RATES)
#: Digits and equal lines come in clumps, a telephone number or a heading, and most texts have none: the rows
#: whose scatter is made least don't show it, so a clump's worth is added.
CLUMPS = {"n_digits": 0.2**2, "n_dup_lines": 0.08**2}
FLOORS = np.array([FLOOR, *(CLUMPS.get(c, FLOOR) for c, _, _ in RATES)])
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
X = [f"x{i}" for i in range(P)]
CENTRE = [f"c{i}" for i in range(P)]
SCATTER = [f"s{i}{j}" for i, j in PAIRS]
GROUP = ["g_lang", "g_source"]
REST = "\x01"


def text_counts(docs: DataFrame) -> DataFrame:
    """``id, dig, lang, source`` and the counts of quality_stats.COUNTS for each row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    group = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")).alias(c) for c in ("lang", "source")]
    schema = "id long, dig long, lang string, source string, " + ", ".join(f"{c} long" for c in qs.COUNTS)
    return docs.select(*tx.doc_key(), *group, text).mapInArrow(qs.counting, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _gamma_share(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function."""
    term = total = 1 / a
    for k in range(1, 500):
        term *= x / (a + k)
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi_square(p: int, share: float) -> float:
    """The squared distance within which ``share`` of normal rows of ``p`` statistics lie."""
    lo, hi = 1e-9, 100.0 + 10 * p
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _gamma_share(p / 2, mid / 2) < share else (lo, mid)
    return lo


def consistency(p: int, share: float) -> float:
    """What the scatter of the innermost ``share`` of normal rows is to be multiplied by."""
    return share / _gamma_share(p / 2 + 1, chi_square(p, share) / 2)


CUTOFF = chi_square(P, WITHIN)


def _distances(x: np.ndarray, centre: np.ndarray, scatter: np.ndarray) -> np.ndarray:
    off = x - centre
    return np.einsum("ij,ij->i", off @ np.linalg.inv(scatter), off)


def minimum_determinant(x: np.ndarray, floors: np.ndarray | float = FLOOR, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Centre and scatter of the ``HALF`` of the rows with the least determinant that concentration from
    three robust starts finds: marginal spreads, the rows nearest the median, and rank-free signs.
    ``floors``: the added variance of each statistic."""
    middle = np.median(x, axis=0)
    spread = 1.4826 * np.median(np.abs(x - middle), axis=0)
    floor, small, wider = np.eye(x.shape[1]) * floors, np.sqrt(floors), consistency(x.shape[1], HALF)
    size = max(1, math.ceil(HALF * len(x)))
    off = (x - middle) / (spread + small)
    near = np.argsort((off**2).sum(axis=1), kind="stable")[: max(1, len(x) // 2)]
    signs = off / np.maximum(np.linalg.norm(off, axis=1), 1e-9)[:, None]
    scale = np.diag(spread + small)
    starts = [np.diag(spread**2) + floor, np.cov(x[near].T, bias=True) + floor, scale @ (signs.T @ signs / len(x)) @ scale + floor]
    best = None
    for scatter in starts:
        centre, before = middle, np.inf
        for _ in range(steps):
            inner = np.argsort(_distances(x, centre, scatter), kind="stable")[:size]
            centre = x[inner].mean(axis=0)
            scatter = np.cov(x[inner].T, bias=True) * wider + floor
            det = np.linalg.det(scatter)
            if det >= before * (1 - 1e-9):
                break
            before = det
        if best is None or det < best[0]:
            best = (det, centre, scatter)
    return best[1], best[2]


def _block(table: pa.Table) -> pa.Table:
    x = np.stack([table.column(c).to_numpy() for c in X], axis=1)
    centre, scatter = minimum_determinant(x, FLOORS)
    out = {c: table.column(c)[:1] for c in GROUP} | {"n": pa.array([len(x)], pa.int64())}
    out |= {c: pa.array([v], pa.float64()) for c, v in zip(CENTRE, centre, strict=True)}
    return pa.table(out | {c: pa.array([scatter[i, j]], pa.float64()) for c, (i, j) in zip(SCATTER, PAIRS, strict=True)})


_BLOCK = "g_lang string, g_source string, n long, " + ", ".join(f"{c} double" for c in CENTRE + SCATTER)


def _pooled(estimates: DataFrame, *by: str) -> DataFrame:
    mean = [(F.sum(F.col("n") * F.col(c)) / F.sum("n")).alias(c) for c in CENTRE + SCATTER]
    return estimates.groupBy(*by).agg(F.sum("n").alias("n"), *mean)


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``d2`` of each row by the estimate of its group; a group's rows meet it block by block."""
    blocks = estimates.join(rows.select(*GROUP, "blocks").distinct(), GROUP)
    blocks = blocks.withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)"))).drop("blocks")
    joined = rows.join(blocks.select(*GROUP, "block", *CENTRE, *SCATTER), [*GROUP, "block"], "left")
    names = list(rows.columns)

    def distance(batches):
        for batch in batches:
            x, c = (np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in ks], axis=1) for ks in (X, CENTRE))
            s = np.empty((len(x), P, P))
            for k, (i, j) in zip(SCATTER, PAIRS, strict=True):
                s[:, i, j] = s[:, j, i] = batch.column(k).to_numpy(zero_copy_only=False)
            known = np.isfinite(s).all(axis=(1, 2))
            s[~known] = np.eye(P)
            off = x - c
            d2 = np.einsum("ij,ij->i", np.linalg.solve(s, off[:, :, None])[:, :, 0], off)
            columns = [batch.column(f) for f in names] + [pa.array(d2, mask=~known)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "d2"])

    return joined.mapInArrow(distance, rows.schema.simpleString()[7:-1].replace(":", " ") + ", d2 double")


def _concentrated(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """A concentration step over all rows: centre and scatter of the ``HALF`` nearest of each group."""
    near = _with_distance(rows, estimates)
    limit = near.groupBy(*GROUP, "block").agg(F.expr(f"percentile(d2, {HALF})").alias("b"), F.count("*").alias("m"))
    limit = limit.groupBy(*GROUP).agg((F.sum(F.col("b") * F.col("m")) / F.sum("m")).alias("limit"))
    blocks = rows.select(*GROUP, "block").distinct().join(limit, GROUP)
    inner = near.join(blocks, [*GROUP, "block"]).where("d2 <= limit")
    wider = consistency(P, HALF)
    means = [F.avg(x).alias(c) for x, c in zip(X, CENTRE, strict=True)]
    scatters = [
        ((F.covar_pop(X[i], X[j]) * wider) + (float(FLOORS[i]) if i == j else 0)).alias(c) for c, (i, j) in zip(SCATTER, PAIRS, strict=True)
    ]
    return inner.groupBy(*GROUP).agg(F.count("*").alias("n"), *means, *scatters)


def estimates(rows: DataFrame, steps: int = 2) -> DataFrame:
    """``g_lang, g_source, n`` and centre and scatter for each group with enough rows."""
    fit = rows.where("usable and group_rows >= " + str(LEAST_ROWS))
    blocks = fit.select(*GROUP, "block", *X).groupBy(*GROUP, "block").applyInArrow(_block, _BLOCK)
    found = cut(_pooled(blocks, *GROUP), "mcd")
    for _ in range(steps):
        found = cut(_concentrated(fit.select(*GROUP, "block", "blocks", *X), found), "mcd")
    return found


def statistics(counts: DataFrame) -> DataFrame:
    """The counts with the statistic vector, and the group's size and block of each row."""
    usable = ~base_failed()
    totals = counts.where(usable).agg(*(F.sum(c).alias(c) for c in qs.COUNTS)).first()
    shrunk = lambda c, of, prior: (F.col(c) + prior * ((totals[c] or 0) / (totals[of] or 1))) / (F.col(of) + prior)
    length = F.log(F.greatest(shrunk("word_chars", "n_words", PRIOR_WORDS), F.lit(1e-6)))
    x = [length, *(F.sqrt(shrunk(*rate)) for rate in RATES)]
    rows = counts.withColumns({"usable": usable, **{n: v.cast("double") for n, v in zip(X, x, strict=True)}})
    sizes = rows.groupBy("lang", "source").agg(F.sum(F.col("usable").cast("long")).alias("n"), F.count("*").alias("rows"))
    return _by_salt(rows, _groups(sizes))


def _groups(sizes: DataFrame) -> DataFrame:
    """The group of each (lang, source): itself, or with few usable rows the rest of its language, or with
    few in that too the rest of all; with the group's usable rows and number of blocks."""
    few = F.col("n") < LEAST_ROWS
    rest = sizes.where(few).groupBy("lang").agg(F.sum("n").alias("rest"))
    named = sizes.join(rest, "lang", "left").select(
        "lang", "source", "n", "rows",
        F.when(few & (F.col("rest") < LEAST_ROWS), REST).otherwise(F.col("lang")).alias("g_lang"),
        F.when(few, REST).otherwise(F.col("source")).alias("g_source"),
    )
    totals = named.groupBy(*GROUP).agg(F.sum("n").alias("group_rows"), F.ceil(F.sum("rows") / BLOCK_ROWS).alias("blocks"))
    return named.select("lang", "source", *GROUP).join(totals, GROUP)


def _by_salt(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each row with its group's size and a block by hash. The join is dealt by group and 64 salts, so a
    large group doesn't meet its one row of sizes in one task."""
    salt = F.pmod(F.xxhash64("dig", "id"), F.lit(64)).cast("int")
    spread = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
    joined = rows.withColumn("salt", salt).join(spread, ["lang", "source", "salt"]).drop("salt")
    return joined.withColumn("block", F.expr("pmod(xxhash64(id, dig, 1), blocks)"))


def judged(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``id, dig``, the counts, ``base_failed``, ``d2`` (squared distance, null without an estimate) and
    ``kept`` for each row of ``docs``."""
    rows = cut(statistics(cut(text_counts(docs), "counts")), "statistics")
    found = estimates(rows)
    overall = _pooled(found).first()
    groups = rows.select(*GROUP).distinct().join(found, GROUP, "left")
    either = [F.coalesce(F.col(c), F.lit(overall[c]).cast("double")).alias(c) for c in CENTRE + SCATTER]
    vectors = rows.select("id", "dig", *GROUP, "block", "blocks", "usable", *X, *qs.COUNTS)
    far = _with_distance(vectors, groups.select(*GROUP, *either))
    kept = F.col("usable") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))
    return far.select("id", "dig", *qs.COUNTS, (~F.col("usable")).alias("base_failed"), "d2", kept.alias("kept"))
