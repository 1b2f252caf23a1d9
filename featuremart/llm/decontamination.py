r"""Benchmark decontamination by winnowing. DataFrame functions only.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z. Every ``length`` consecutive words of
an item are a window. Of the ``length - K + 1`` K-grams in a window the one with the least hash is its
fingerprint; equal windows have equal fingerprints at equal places, so a document that holds a window holds
its fingerprint. Fingerprints of documents and items are joined; each hit is then extended: the windows that
may hold it are compared with the items' windows in full, by the words themselves.

Documents go through without a shuffle while the items' fingerprints are at most ``BROADCAST_ROWS`` counted
rows; beyond that their fingerprints shuffle by hash. Fingerprints of items are distinct, so a passage that
a third of the documents share is one row on that side, and a hit is one row for its document: nothing is
paired with every holder. Texts are read again only to extend hits.

Cases: null text has no words, as has one without letters or digits; an item with fewer words than a window
is one window of its own length, one without words fits nothing; items that share a window all count;
repeated documents (same id and text) get the same answer; empty tables give no hits or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.sources.scratch import cut

from . import text as tx

BROADCAST_ROWS = 200_000
#: Words in a hashed gram; a window of 10 words has six of them.
K = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """The words of a text. Lower-casing by Spark is right for ASCII texts, and faster than a translation."""
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    parts = F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def _hashes(name: str) -> Column:
    return F.transform(name, lambda w: F.xxhash64(w))


def _grams(name: str, k: int) -> Column:
    """Hashes of all k-grams of an array of word hashes."""
    parts = ", ".join(f"get({name}, i + {j})" for j in range(k))
    return F.expr(f"case when size({name}) < {k} then array() else transform(sequence(0, size({name}) - {k}), i -> xxhash64({parts})) end")


def _least(name: str, w: int) -> Column:
    """For each run of w grams the least hash."""
    if w == 1:
        return F.col(name)
    parts = ", ".join(f"get({name}, i + {j})" for j in range(w))
    return F.expr(f"case when size({name}) < {w} then array() else transform(sequence(0, size({name}) - {w}), i -> least({parts})) end")


def _windows_of(items: DataFrame, length: int) -> DataFrame:
    """``item_id, size, window`` (an array of words) of all items; shorter items are one window."""
    items = items.select(F.col("item_id"), words(F.coalesce(F.col("text"), F.lit(""))).alias("w")).where("size(w) > 0")
    items = items.withColumn("size", F.least(F.size("w"), F.lit(length)))
    at = F.explode(F.expr("sequence(1, size(w) - size + 1)")).alias("at")
    return items.select("item_id", "size", "w", at).select("item_id", "size", F.expr("slice(w, at, size)").alias("window")).distinct()


def _print(size: int) -> tuple[int, int]:
    """k and the number of grams of a window of ``size`` words."""
    k = min(K, size)
    return k, size - k + 1


def _prints(df: DataFrame, source: str, size: int, out: str) -> DataFrame:
    """``df`` with the fingerprint of each window of ``size`` words of the hashes in ``source``."""
    k, w = _print(size)
    return df.withColumn("_grams", _grams(source, k)).withColumn(out, _least("_grams", w)).drop("_grams")


def contaminated(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """``id, dig, n_words, n_hit, items`` for each distinct document: its words, those inside any occurrence
    of an item's window, and the sorted distinct ids (as strings) of the items whose windows occur."""
    windows = cut(_windows_of(items, length), "windows")
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # at most ``length`` numbers
    item_prints = None
    for size in sizes:
        part = windows.where(F.col("size") == size).withColumn("h", _hashes("window"))
        part = _prints(part, "h", size, "p").select(F.lit(size).alias("size"), F.col("p")[0].alias("print")).distinct()
        item_prints = part if item_prints is None else item_prints.unionByName(part)
    keys = tx.keyed(docs)
    tokens = keys.select("id", "dig", words("text").alias("w"))
    hashed = tokens.select("id", "dig", F.size("w").alias("n_words"), _hashes("w").alias("h"))
    found = hashed.select("id", "dig", "n_words", F.lit(False).alias("hit"))
    if item_prints is not None:
        item_prints = cut(item_prints, "prints")
        n = item_prints.count()
        side = F.broadcast(item_prints) if n <= BROADCAST_ROWS else item_prints
        side = side.withColumn("hit", F.lit(True))
        for size in sizes:
            hashed = _prints(hashed, "h", size, f"p{size}")
        each = F.array(*(F.struct(F.lit(s).alias("size"), F.array_distinct(f"p{s}").alias("prints")) for s in sizes))
        flat = hashed.select("id", "dig", "n_words", F.explode(each).alias("e")).select("id", "dig", "n_words", "e.size", F.explode_outer("e.prints").alias("print"))
        found = flat.join(side, ["size", "print"], "left").select("id", "dig", "n_words", F.coalesce("hit", F.lit(False)).alias("hit"))
    found = cut(found.groupBy("id", "dig").agg(F.max("n_words").cast("long").alias("n_words"), F.max("hit").alias("hit")), "found")
    hits = _extended(keys, found.where("hit"), windows, sizes)
    return found.select("id", "dig", "n_words").join(hits, ["id", "dig"], "left").select(
        "id", "dig", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _extended(keys: DataFrame, candidates: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """``id, dig, n_hit, items``: the windows of the candidate documents against the items' windows."""
    some = keys.join(candidates.select("id", "dig"), ["id", "dig"], "left_semi").dropDuplicates(["id", "dig"])
    some = some.select("id", "dig", words("text").alias("w"))
    each = F.array(*map(F.lit, sizes)).cast("array<int>")
    at = F.expr("explode(if(size(w) < size, array(), sequence(1, size(w) - size + 1)))").alias("at")
    own = some.select("id", "dig", "w", F.explode(each).alias("size")).select("id", "dig", "size", "w", at)
    own = own.select("id", "dig", "size", "at", F.expr("slice(w, at, size)").alias("window"))
    named = cut(windows.groupBy("size", "window").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids")), "named")
    side = F.broadcast(named) if windows.count() <= BROADCAST_ROWS else named
    met = cut(own.join(side, ["size", "window"]).select("id", "dig", "at", "size", "ids"), "met")
    places = met.select("id", "dig", F.explode(F.expr("sequence(at, at + size - 1)")).alias("place")).distinct()
    n_hit = places.groupBy("id", "dig").agg(F.count("*").alias("n_hit"))
    ids = met.select("id", "dig", F.explode("ids").alias("item")).groupBy("id", "dig").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return n_hit.join(ids, ["id", "dig"])
