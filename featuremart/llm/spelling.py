"""Spelling variant grouping: k-d trees over letter-count vectors.

Words are counted in Spark. Two words of one edit (a code point inserted, deleted or replaced) have letter
counts that differ by 1 in sum (lengths l and l + 1) or by 2 (equal lengths), so for each such pair of
lengths the words of the one look into the other's k-d tree.

A tree has two parts. The upper one is fitted for each length on a bounded sample of its words
(:data:`SAMPLE` words of the whole vocabulary, picked by hash), so that its planes fit in every task; it
cuts the words, all of them, into cells. A word is at home in one cell and visits those whose box lies
within reach: a plane that it crosses costs the difference of the counts. A cell with more than
:data:`CELL` words at home is cut into pieces by hash, and a visitor looks at each piece. In a piece, one
task goes down the lower part of the tree, on the distinct vectors at home, with all visitors at once,
prunes by the boxes of what is there, and compares vectors at the leaves.

Pairs of vectors in reach are then verified by the order of their letters: as the vectors say which letter
is too many in either word, the words are near if they agree without one such letter at one place, which a
lookup of the shortened words finds. Words with the same letters are never near, so many of them cost no
pairs.

Cases: null text has no words; a null doc_id is written as nothing before the colon; repeated rows count
again; ties between forms go to the smaller word in code-point order; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.sources.scratch import cut

#: Words of the vocabulary that the upper trees are fitted on, at most about so many.
SAMPLE = 1 << 16
#: Words of the vocabulary in a cell, and in a piece of one that turned out larger, about.
CELL = 4096
#: Distinct vectors in a leaf of the lower tree.
LEAF = 16
#: Pairs of words that are compared one by one; more are looked up by their shortened forms.
FEW = 32

# The letters, in code-point order. Case is lowered for A to Z only.
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], dtype=np.uint32)
RUN = "[A-Za-z\\u00C0-\\u00FF]+"


def _lower(word: Column) -> Column:
    ascii_only = F.octet_length(word) == F.length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(
        F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def word_counts(docs: DataFrame, least_points: int = 6, least_count: int = 5, thin: int = 199) -> DataFrame:
    """``word, n``. One in ``thin`` (document, run) pairs, chosen by crc32, loses a letter first."""
    runs = docs.select(
        F.coalesce(F.col("`doc_id`").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.col("`text`"), F.lit(RUN), F.lit(0))).alias("run"),
    )
    runs = runs.where(F.length("run") >= least_points).select("doc", _lower(F.col("run")).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run")))
    shorter = F.expr("concat(substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))")
    words = runs.select(F.when(F.col("h") % thin == 0, shorter).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= least_points).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least_count)


def vectors(words: list[str]) -> np.ndarray:
    """Letter counts, a row for each word."""
    out = np.zeros((len(words), len(LETTERS)), dtype=np.int32)
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    sizes = np.fromiter((len(w) for w in words), dtype=np.int64, count=len(words))
    np.add.at(out, (np.repeat(np.arange(len(words)), sizes), np.searchsorted(LETTERS, points)), 1)
    return out


def split_plane(points: np.ndarray) -> tuple[int, int] | None:
    """The letter and the count (points below it go left) that halve the points best; none if all agree.
    The best cut of a letter lies just below or just above its median."""
    median = np.partition(points, len(points) // 2, axis=0)[len(points) // 2]
    left = np.stack([(points < median).sum(axis=0), (points <= median).sum(axis=0)])
    even = np.minimum(left, len(points) - left)
    above, letter = np.unravel_index(even.argmax(), even.shape)
    return (int(letter), int(median[letter] + above)) if even[above, letter] else None


def upper_tree(points: np.ndarray, most: int):
    """A tree whose cells have at most so many points: ``(letter, count, left, right)``, or the cell's number; cells are numbered from 0."""
    cells = 0

    def grow(own):
        nonlocal cells
        plane = split_plane(own) if len(own) > most else None
        if plane is None:
            cells += 1
            return cells - 1
        low = own[:, plane[0]] < plane[1]
        return (*plane, grow(own[low]), grow(own[~low]))

    return grow(points)


def cells_in_reach(tree, points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(cell, index of points, whether they lie in it)`` for each cell with points within ``reach`` of it.
    A way through the tree carries, for each point and letter, how far the box lies off; a letter that is
    split again replaces its own share only."""

    def visit(node, at, off, away):
        if not isinstance(node, tuple):
            yield node, at, off == 0
            return
        letter, count, low, high = node
        had = away.get(letter, np.zeros(len(points), dtype=np.int32))[at]
        value = points[at, letter]
        for child, far in ((low, value - count + 1), (high, count - value)):
            now = np.maximum(had, far)
            total = off - had + now
            stay = total <= reach
            if stay.any():
                share = np.zeros(len(points), dtype=np.int32)
                share[at[stay]] = now[stay]
                yield from visit(child, at[stay], total[stay], away | {letter: share})

    if len(points):
        yield from visit(tree, np.arange(len(points)), np.zeros(len(points), dtype=np.int32), {})


def pairs_in_reach(home: np.ndarray, asked: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of ``home`` and ``asked`` whose vectors differ by 1 to ``reach`` in sum: a k-d tree over
    ``home`` with bounding boxes, which all of ``asked`` go down together."""
    used = np.flatnonzero(home.any(axis=0) | asked.any(axis=0))
    home, asked = home[:, used], asked[:, used]
    stack = [(np.arange(len(home)), np.arange(len(asked)))]
    while stack:
        own, at = stack.pop()
        points, values = home[own], asked[at]
        off = np.maximum(points.min(axis=0) - values, 0) + np.maximum(values - points.max(axis=0), 0)
        at = at[off.sum(axis=1) <= reach]
        if not len(at):
            continue
        plane = split_plane(points) if len(own) > LEAF else None
        if plane is None:
            step = max(1, (1 << 22) // (len(own) * home.shape[1]))
            for a in range(0, len(at), step):
                far = np.abs(points[:, None, :] - asked[at[a : a + step]][None, :, :]).sum(axis=2)
                x, y = np.nonzero((far > 0) & (far <= reach))
                if len(x):
                    yield own[x], at[a + y]
            continue
        left = points[:, plane[0]] < plane[1]
        stack += [(own[left], at), (own[~left], at)]


def _without(words: list[str], letter: str) -> dict[tuple[str, int], list[str]]:
    """The words by what is left of them without one such letter, and its place."""
    out = defaultdict(list)
    for word in words:
        at = word.find(letter)
        while at >= 0:
            out[word[:at] + word[at + 1 :], at].append(word)
            at = word.find(letter, at + 1)
    return out


def _one_edit(longer: str, other: str) -> bool:
    """Whether two different words of one length, or with a letter less in the second, are one edit apart."""
    k, n = 0, len(other)
    while k < n and longer[k] == other[k]:
        k += 1
    return longer[k + 1 :] == other[k + n + 1 - len(longer) :]


def near_words(home: list[str], asked: list[str], reach: int) -> set[tuple[str, str]]:
    """Pairs (word at home, word asked for) that differ by one edit. With ``reach`` 2 all words have one
    length; with 1 the words at home have a letter more."""
    own_words, other_words = defaultdict(list), defaultdict(list)
    for words, kinds in ((home, own_words), (asked, other_words)):
        for word in words:
            kinds["".join(sorted(word))].append(word)
    own, other = vectors(list(own_words)), vectors(list(other_words))
    own_words, other_words = list(own_words.values()), list(other_words.values())
    known, found = {}, set()

    def rests(side: int, words: list[str], k: int, letter: int):
        if (side, k, letter) not in known:
            known[side, k, letter] = _without(words, chr(LETTERS[letter]))
        return known[side, k, letter]

    for x, y in pairs_in_reach(own, other, reach):
        for i, j in zip(x.tolist(), y.tolist(), strict=True):
            here, there = own_words[i], other_words[j]
            if len(here) * len(there) <= FEW:
                found.update((a, b) for a in here for b in there if _one_edit(a, b))
                continue
            change = own[i] - other[j]
            left = rests(0, here, i, int(change.argmax()))
            if reach == 2:
                rest = rests(1, there, j, int(change.argmin()))
                found.update((a, b) for k in left.keys() & rest.keys() for a in left[k] for b in rest[k])
            else:
                there = set(there)
                found.update((a, rest) for (rest, _), ones in left.items() if rest in there for a in ones)
    return found


def _visits(trees: dict[int, object]):
    """A row for each cell that a word is at home in or visits."""

    def run(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            counts, sizes = vectors(words), np.array([len(w) for w in words])
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                for length, reach in ((size, 2), (size + 1, 1)):
                    for cell, who, inside in cells_in_reach(trees.get(length, 0), counts[at], reach):
                        rows = pa.array(at[who])
                        home = inside if reach == 2 else np.zeros(len(who), dtype=bool)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(who), length, dtype=np.int32)),
                                pa.array(np.full(len(who), cell, dtype=np.int32)),
                                batch.column("word").take(rows),
                                batch.column("n").take(rows),
                                pa.array(home),
                                pa.array(np.full(len(who), reach, dtype=np.int32)),
                            ],
                            ["length", "cell", "word", "n", "home", "reach"],
                        )

    return run


def _search(table: pa.Table) -> pa.Table:
    """Links of a piece: from its words to those of equal length, and both ways between its words and those
    with a letter less (which these are asked for in one place only)."""
    words, here, reach = (table.column(c).to_pylist() for c in ("word", "here", "reach"))
    own = [w for w, h in zip(words, here, strict=True) if h]
    asked = {r: [w for w, k in zip(words, reach, strict=True) if k == r] for r in (1, 2)}
    shorter = near_words(own, asked[1], 1) if own and asked[1] else set()
    equal = near_words(own, asked[2], 2) if own else set()
    links = [*equal, *shorter, *((b, a) for a, b in shorter)]
    count = dict(zip(words, table.column("n").to_pylist(), strict=True))
    return pa.table(
        {
            "word": pa.array([a for a, _ in links], pa.string()),
            "other": pa.array([b for _, b in links], pa.string()),
            "other_n": pa.array([count[b] for _, b in links], pa.int64()),
        }
    )


def fitted_trees(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> dict[int, object]:
    """The upper tree of each length, from the words whose hash falls into the sampled share; a cell holds
    the share of ``cell`` words."""
    share = min(1.0, sample / max(1, words.count()))
    picked = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < F.lit(round(share * (1 << 20))))
    by_size, most = defaultdict(list), max(1, round(cell * share))
    for (word,) in picked.select("word").collect():
        by_size[len(word)].append(word)
    return {size: upper_tree(vectors(own), most) for size, own in by_size.items() if len(own) > most}


def near_links(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``word, other, other_n``: a row for each ordered pair of near words of ``words`` (word, n)."""
    trees = fitted_trees(words, cell, sample)
    visits = cut(words.mapInArrow(_visits(trees), "length int, cell int, word string, n long, home boolean, reach int"), "visits")
    pieces = visits.where("home").groupBy("length", "cell").agg(F.ceil(F.count("*") / cell).cast("int").alias("pieces"))
    seen = visits.join(pieces, ["length", "cell"])
    seen = seen.withColumn("piece", F.explode(F.expr("sequence(0, pieces - 1)")))
    own_piece = F.expr("home and pmod(xxhash64(word), pieces) = piece").alias("here")
    seen = seen.select("length", "cell", "piece", "word", "n", "home", "reach", own_piece)
    return seen.groupBy("length", "cell", "piece").applyInArrow(_search, "word string, other string, other_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the words of ``forms`` (word, form): each round doubles the way that is followed."""
    ways = cut(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "ways")
    while not ways.where("moved").isEmpty():
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = ways.join(onward, "root", "left")
        ways = cut(ways.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ways")
    return ways.select("word", "root")


def variants(words: DataFrame, factor: int = 5, **tree) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for each row of ``words`` (word, n): the number of near words,
    the most frequent of them if it is at least ``factor`` times as frequent, and where forms lead to."""
    words = cut(words.select("word", "n"), "words")
    links = near_links(words, **tree)
    near = links.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other"))).alias("best")
    )
    strong = -F.col("best.rank") >= factor * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("best.other")).alias("form"),
        F.when(strong, -F.col("best.rank")).alias("form_n"),
    )
    found = cut(found, "forms")
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
