"""URL filter: a blocked Bloom filter of listed URL prefixes, then an exact join. DataFrame functions only.

A rule is a host and a path prefix; it fits its host, all subdomains, and every path that starts with its
path. A URL's probes are its host suffixes, each with the path cut at every length that the rules have. A
probe picks one 64-bit block of the filter by one hash and four bits in it by another; probes whose bits
are not all set are gone before the join. Probes that pass meet the rules by equality of host and path,
which removes the filter's false positives. The longest rule wins; between a blocking and an allowing rule
of one name the blocking one does. A URL that no rule fits is not listed, and so allowed.

Distinct URLs are probed, so a URL or a host that a third of the pages share costs no more than once each.
The filter's blocks (8 bytes for some 6 rules) and the rules are broadcast up to ``BROADCAST_ROWS`` counted
rows; beyond that both joins shuffle.

Cases: null url, or one without ``://``, has empty host and path and is allowed; an empty rule list allows
all; a rule with a null host, path or verdict is left out; repeated rows each get their answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
RULES_PER_BLOCK = 6
BITS = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str = "url") -> list[Column]:
    """``host`` (A-Z lower-cased) and ``path`` of a URL."""
    rest = F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return [F.translate(host, _UPPER, _LOWER).alias("host"), path.alias("path")]


def _bloom(host: str, path: str, blocks: int) -> list[Column]:
    """``block`` and ``need``, the bits of a probe in its block."""
    bits = F.xxhash64(F.lit("bits"), host, path)
    need = None
    for j in range(BITS):
        place = F.shiftrightunsigned(bits, 6 * j).bitwiseAND(F.lit(63)).cast("int")
        one = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        need = one if need is None else need.bitwiseOR(one)
    return [F.pmod(F.xxhash64(F.lit("block"), host, path), F.lit(blocks)).alias("block"), need.alias("need")]


def _meet(df: DataFrame, n: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are few."""
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def url_verdicts(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``url, host, path, rule, verdict`` for each distinct non-null url that holds ``://`` and that a rule
    fits. ``rules`` has string columns ``host, path, verdict`` (allow or block)."""
    rules = rules.select("host", "path", "verdict").dropna()
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block over allow
    n, lengths = rules.agg(F.count("*"), F.sort_array(F.collect_set(F.length("path")))).first()
    blocks = max(1, -(-n // RULES_PER_BLOCK))
    listed = rules.select(*_bloom("host", "path", blocks)).groupBy("block").agg(F.bit_or("need").alias("bits"))
    urls = pages.select(F.col(f"`{url}`").alias("url")).where("url like '%://%'").distinct().select("url", *host_and_path())
    parts = F.split("host", r"\.", -1)
    suffixes = urls.withColumn("parts", parts).select(
        "url", "host", "path",
        F.explode(F.expr("transform(sequence(1, size(parts)), i -> array_join(slice(parts, i, size(parts)), '.'))")).alias("suffix"),
    )
    probes = suffixes.withColumn("size", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>"))).where("size <= length(path)")
    probes = probes.select("url", "host", "path", "suffix", F.expr("substring(path, 1, size)").alias("prefix"))
    probes = probes.select("*", *_bloom("suffix", "prefix", blocks))
    passed = probes.join(_meet(listed, blocks), "block").where("(bits & need) = need")
    named = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "verdict")
    hits = passed.join(_meet(named, n), ["suffix", "prefix"])
    rule = F.concat("suffix", "prefix")
    order = F.struct(F.length(rule), F.col("verdict"), rule)
    best = F.max(F.struct(order, rule.alias("rule"), F.col("verdict"))).alias("best")
    return hits.groupBy("url", "host", "path").agg(best).select("url", "host", "path", "best.rule", "best.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of each page, then ``host, path, rule, verdict``."""
    rows = pages.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{url}`").alias("url"))
    found = url_verdicts(pages, rules, url).select("url", "rule", "verdict")
    verdict = F.coalesce("verdict", F.lit("allow")).alias("verdict")
    return rows.join(found, "url", "left").select(*keep, *host_and_path(), "rule", verdict)
