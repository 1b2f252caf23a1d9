"""Language identification by multilingual mixtures.

Learning counts byte trigrams of letters for each language, over all learning rows; counts are summed in
each task before they shuffle, and 65,536 numbers for each language make the model. A text's words are
drawn from a mixture of languages: a word's likelihood in a language is that of its trigrams, and
expectation-maximisation estimates the text's proportions. The language set is chosen by penalised
likelihood among the sets of the 1, 2, ... most present languages; the prediction is the chosen mixture's
largest part, the score its proportion.

Cases: a null text or one without letters is ``und`` with score 0, as is every text where nothing was
learned; null languages and texts teach nothing; ties go to the first language by name; repeated rows count
each in learning and get the same answer; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

GRAMS = 1 << 16
SMOOTHING = 0.5
#: Overlapping trigrams tell the same letters three times.
WEIGHT = 1 / 3
ROUNDS, SET_ROUNDS = 8, 4
_LETTER = np.arange(256, dtype=np.uint8)
_LETTER[:128] = 0x20
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)


def _grams(data: np.ndarray, offsets: np.ndarray):
    """Each letter byte's trigram (the byte between its neighbours, a space at a text's edge), and the words."""
    low = _LETTER[data]
    starts, ends = tx.spans_of(low != 0x20, offsets)
    wide = low.astype(np.uint32)
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    left, right = np.r_[np.uint32(0x20), wide[:-1]], np.r_[wide[1:], np.uint32(0x20)]
    left[edge] = 0x20
    right[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = 0x20
    gram = ((left << 16 | wide << 8 | right) * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return gram, starts, ends


def _counted(batches):
    totals: dict[str, np.ndarray] = {}
    for rows, data, offsets in tx.chunks(batches):
        gram, starts, ends = _grams(data, offsets)
        letters = tx.span_mask(starts, ends, len(data))
        langs = rows.column(rows.schema.get_field_index("lang")).to_pylist()
        names = sorted(set(langs))
        which = np.repeat(np.searchsorted(names, langs), np.diff(offsets))[letters]
        found = np.bincount(which * GRAMS + gram[letters], minlength=len(names) * GRAMS)
        for i, name in enumerate(names):
            part = found[i * GRAMS : (i + 1) * GRAMS]
            totals[name] = totals[name] + part if name in totals else part
    for name, total in totals.items():
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(total[some])], ["lang", "gram", "n"]
        )


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages by name, and for each the log-likelihood of each trigram. ``rows`` has ``text, lang``.
    The driver gets one number for each language and trigram that occurs, whatever the number of rows."""
    rows = rows.where("text is not null and lang is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    counts = rows.mapInArrow(_counted, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    if not names:
        return [], np.zeros((0, GRAMS), dtype=np.float32)
    table = np.zeros((len(names), GRAMS))
    table[np.searchsorted(names, found.column("lang").to_pylist()), found.column("gram").to_numpy()] = found.column("n").to_numpy()
    table += SMOOTHING
    return names, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def mixture(words: np.ndarray, first: np.ndarray, allowed: np.ndarray, share: np.ndarray, rounds: int):
    """Expectation-maximisation for many texts at once. ``words``: likelihood of each word by language, up
    to a factor; ``first``: each text's first word with the total at the end, none empty; ``allowed``: the
    languages of each text. Gives the proportions and each text's log-likelihood."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = np.diff(first)[:, None]
    share = np.where(allowed, np.maximum(share, 1e-6), 0)
    share = (share / share.sum(axis=1, keepdims=True)).astype(np.float32)
    for _ in range(rounds):
        part = words * share[doc]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-30)
        share = (np.add.reduceat(part, first[:-1], axis=0) / n).astype(np.float32)
    fit = np.log(np.maximum((words * share[doc]).sum(axis=1), 1e-30))
    return share, np.add.reduceat(fit, first[:-1])


def proportions(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each text's language proportions from its words' log-likelihoods, with languages left out where the
    penalised likelihood is better without them."""
    langs = scores.shape[1]
    likely = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60)).astype(np.float32)
    docs = len(first) - 1
    every = np.ones((docs, langs), dtype=bool)
    share, _ = mixture(likely, first, every, np.full((docs, langs), 1 / langs), ROUNDS)
    order = np.argsort(-share, axis=1, kind="stable")
    penalty = np.log(np.maximum(np.diff(first), 2)) / 2 + 2
    best = np.full(docs, -np.inf)
    chosen = share.copy()
    allowed = np.zeros_like(every)
    doc = np.repeat(np.arange(docs), np.diff(first))
    for k in range(langs):
        np.put_along_axis(allowed, order[:, k : k + 1], True, axis=1)
        # a word's likelihood is 1 at most, so a text above the penalty alone gains from no larger set
        rising = best < -k * penalty
        if not rising.any():
            break
        words = likely if rising.all() else likely[rising[doc]]
        part, fit = mixture(words, np.r_[0, np.cumsum(np.diff(first)[rising])], allowed[rising], share[rising], SET_ROUNDS if k else 1)
        value = fit - (k * penalty)[rising]
        better = value > best[rising]
        which = np.flatnonzero(rising)[better]
        best[which] = value[better]
        chosen[which] = part[better]
    return chosen


def _predicted(names: list[str], table: np.ndarray):
    def run(batches):
        for rows, data, offsets in tx.chunks(batches, limit=tx.CHUNK // 2):
            gram, starts, ends = _grams(data, offsets)
            first = np.searchsorted(starts, offsets)
            lettered = rows.column(rows.schema.get_field_index("lettered")).to_numpy(zero_copy_only=False)
            some = np.flatnonzero((np.diff(first) > 0) & lettered.astype(bool)) if names else np.zeros(0, np.int64)
            lang, score = np.full(len(lettered), "und", dtype=object), np.zeros(len(lettered))
            if len(some):
                own = np.zeros(len(lettered), dtype=bool)
                own[some] = True
                word = np.repeat(own, np.diff(first))
                edges = np.stack([starts, ends], axis=1)[word].ravel()
                scores = np.empty((word.sum(), len(names)), dtype=np.float32)
                for j in range(len(names)):
                    values = np.r_[table[j][gram], np.float32(0)]
                    scores[:, j] = np.add.reduceat(values, edges)[::2] * WEIGHT
                share = proportions(scores, np.r_[0, np.cumsum(np.diff(first)[some])])
                pick = share.argmax(axis=1)
                lang[some] = np.array(names, dtype=object)[pick]
                score[some] = np.clip(share[np.arange(len(pick)), pick], 0, 1)
            rest = [(f.name, c) for f, c in zip(rows.schema, rows.columns, strict=True) if f.name not in ("text", "lettered")]
            yield pa.RecordBatch.from_arrays(
                [*(c for _, c in rest), pa.array(lang.tolist(), pa.string()), pa.array(score)], [*(n for n, _ in rest), "lang_pred", "score"]
            )

    return run


def predict(rows: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """``rows`` (with ``text``) without the text, with ``lang_pred`` and ``score``."""
    kept = [f for f in rows.schema if f.name != "text"]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    text = F.coalesce("text", F.lit(""))
    lettered = rows.select(*(F.col(f"`{f.name}`") for f in kept), text.alias("text"), text.rlike(r"\p{L}").alias("lettered"))
    return lettered.mapInArrow(_predicted(names, table), f"{schema}lang_pred string, score double")
