"""One registered query for each operator, over its whole table, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, languages, lines, long_matches, merkle, packing, quality, secret_scan, simhash, spelling
from . import substrings, token_counts, urls
from . import text as tx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


@query(
    "op7_substring_dedup",
    r"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), windows AS (
        SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS k
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM words WHERE len(w) >= 20)
    ), late AS (
        SELECT doc_id, s FROM windows
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1
    ), gone AS (
        SELECT doc_id, list(DISTINCT p) AS ps
        FROM (SELECT doc_id, unnest(generate_series(s, s + 19)) AS p FROM late) GROUP BY doc_id
    ), kept AS (
        SELECT doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
               list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(coalesce(ps, []), x[2])) AS k
        FROM words LEFT JOIN gone USING (doc_id)
    )
    SELECT doc_id, n_words, n_removed,
           sha256(coalesce(array_to_string(list_transform(k, lambda x: x[1]), ' '), '')) AS kept_sha256
    FROM kept
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"), 20, digest=True)
    return out.withColumnRenamed("kept", "kept_sha256")


@query(
    "op8_line_dedup",
    r"""
    WITH lines AS (
        SELECT doc_id, pos, line,
               translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
        FROM (
            SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
        )
    ), common AS (
        SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40
        GROUP BY k HAVING count(DISTINCT doc_id) >= 5
    )
    SELECT doc_id, count(*) AS n_lines, count(keeper) FILTER (doc_id <> keeper) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keeper IS NULL OR doc_id = keeper), ''))
               AS kept_sha256
    FROM lines LEFT JOIN common USING (k) GROUP BY doc_id
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_repeated_lines(table(spark, sf_dir, "documents"), least_docs=5, least_points=40, digest=True)
    return out.select(tx.real_id().alias("doc_id"), "n_lines", "n_dropped", F.col("kept").alias("kept_sha256"))


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return out.select(tx.real_id().alias("doc_id"), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judged(table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")
    return out.select(tx.real_id().alias("doc_id"), *base)


@query(
    "op1_benchmark_decontamination",
    r"""
    WITH docs AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    ), items AS (
        SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
    ), item_windows AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS k
        FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s FROM items WHERE len(w) > 0)
    ), doc_windows AS (
        SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS k
        FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
              FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
    ), met AS (SELECT doc_id, s, n, item_id FROM doc_windows JOIN item_windows USING (n, k)),
    hit AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM met) GROUP BY doc_id
    ), ids AS (
        SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS joined
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM met) GROUP BY doc_id
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    answers = decontamination.contaminated(docs, items, length=10)
    rows = docs.select(*tx.doc_key()).join(answers, ["id", "dig"])
    return rows.select(
        tx.real_id().alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


#: The listed rules.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(
    "op3_url_filter",
    r"""
    WITH parts AS (
        SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest
        FROM pages
    ), split AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
    ), rules(h, p, v) AS (
        VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
               ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
    ), hits AS (
        SELECT page_id, h || p AS rule, v FROM split JOIN rules
        ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) = 1
    )
    SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM split LEFT JOIN hits USING (page_id)
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules, keep=("page_id",))


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = packing.pack_documents(table(spark, sf_dir, "documents"), path, end=2, capacity=1024)
    return out.select(tx.real_id().alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(tx.real_id().alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    names, model = languages.learn(docs.where(~held_out))
    out = languages.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), names, model)
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query("op6_suffix_array_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = long_matches.remove_long_matches(table(spark, sf_dir, "documents"), 400, digest=True)
    return out.withColumnRenamed("kept", "kept_sha256")


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_secret_scan")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(table(spark, sf_dir, "documents"))
    kind = lambda *names: F.filter("spans", lambda s: s["kind"].isin(*names))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(kind(k)).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS]
    return found.select(
        tx.real_id().alias("doc_id"), *counts, F.sha2(listed(kind(*secret_scan.BASE)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query(
    "op13_merkle_manifest",
    r"""
    WITH RECURSIVE said AS (
        SELECT doc_id, lang, text, doc_id::VARCHAR AS i, n_chars::VARCHAR AS c, source,
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents
    ), fields AS (
        SELECT doc_id, lang, coalesce(strlen(i) || ':' || i, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(c) || ':' || c, '-') AS head,
               coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(low) || ':' || low, '-') AS low_body,
               list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(i, ''), lambda d: ascii(d)::BIGINT)),
                   lambda crc, d: list_reduce(list_prepend(xor(crc, d), list_transform(range(8), lambda z: 0::BIGINT)),
                       lambda b, z: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END)) AS crc
        FROM said
    ), leaves AS (
        SELECT doc_id, lang, sha256(head || body) AS leaf,
               sha256(head || CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN low_body ELSE body END) AS claimed,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
        FROM fields
    ), nodes AS (
        SELECT lang, pos, leaf AS h, 0 AS lvl, count(*) OVER (PARTITION BY lang) AS n FROM leaves
        UNION ALL
        SELECT lang, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), lvl + 1, (n + 7) // 8
        FROM nodes WHERE n > 1 GROUP BY lang, pos // 8, lvl, n
    ), tops AS (
        SELECT lang, h AS subroot, lvl AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1
    ), upper AS (
        SELECT pos, subroot AS h, 0 AS lvl, count(*) OVER () AS n FROM tops
        UNION ALL
        SELECT pos // 8, sha256(string_agg(h, '' ORDER BY pos)), lvl + 1, (n + 7) // 8
        FROM upper WHERE n > 1 GROUP BY pos // 8, lvl, n
    ), steps AS (
        SELECT doc_id, l.lvl,
               coalesce(string_agg(h, '' ORDER BY l.pos) FILTER (l.pos < d.pos // (8 ** l.lvl)::BIGINT), '') AS a,
               coalesce(string_agg(h, '' ORDER BY l.pos) FILTER (l.pos > d.pos // (8 ** l.lvl)::BIGINT), '') AS b
        FROM leaves d JOIN nodes l ON d.lang IS NOT DISTINCT FROM l.lang AND l.n > 1
             AND l.pos // 8 = d.pos // (8 ** (l.lvl + 1))::BIGINT
        GROUP BY doc_id, l.lvl
        UNION ALL
        SELECT doc_id, height + u.lvl,
               coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos < t.pos // (8 ** u.lvl)::BIGINT), ''),
               coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos > t.pos // (8 ** u.lvl)::BIGINT), '')
        FROM leaves d JOIN tops t ON d.lang IS NOT DISTINCT FROM t.lang
             JOIN upper u ON u.n > 1 AND u.pos // 8 = t.pos // (8 ** (u.lvl + 1))::BIGINT
        GROUP BY doc_id, height, u.lvl
    ), proofs AS (
        SELECT doc_id, sha256(string_agg(a || b, '' ORDER BY lvl)) AS proof_sha256 FROM steps GROUP BY doc_id
    ), fold AS (
        SELECT doc_id, 0 AS lvl, claimed AS h FROM leaves
        UNION ALL
        SELECT doc_id, lvl + 1, sha256(a || h || b) FROM fold JOIN steps USING (doc_id, lvl)
    ), ends AS (SELECT doc_id, arg_max(h, lvl) AS folded_root FROM fold GROUP BY doc_id)
    SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
           folded_root = root AS verified
    FROM leaves JOIN tops ON leaves.lang IS NOT DISTINCT FROM tops.lang
         CROSS JOIN (SELECT h AS root FROM upper WHERE n = 1) LEFT JOIN proofs USING (doc_id) JOIN ends USING (doc_id)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = merkle.leaf_of([lower if c == "text" else F.col(c) for c in columns])
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    out = merkle.manifest(docs, columns, more={"tampered": F.when(changed, tampered)})
    root = merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    out = out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
