"""Every operator against a plain version, on the small documents and on hard rows: nulls in any column,
empty and long texts, repeated rows, ties, clashing column names, empty tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from featuremart.llm import QUERIES, decontamination, languages, lines, long_matches, packing, quality, simhash, stages, substrings, token_counts, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, dig long, `row` string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
COPY = " ".join(f"common{i}" for i in range(90))
LINE = "This very line is found in more than five of the documents here."
HARD = (
    [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, LONG), (5, LONG), (None, COPY + " tail"), (None, COPY + " end"), (6, COPY), (7, COPY)]
    + [(8, "pre " + COPY), (9, "é" * 30), (10, "!!! ??? 123"), (11, "x " * 900), (12, "x " * 900), (12, "other text here")]
    + [(20 + i, f"{LINE}\nown line {i} " + f"q{i} " * 12 + f"\n {LINE.upper()} ") for i in range(8)]
)


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 2 else "s", 1, 2, 3, "r") for k, (i, t) in enumerate(HARD)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, data_dir):
    return spark.read.parquet(f"{data_dir}/documents.parquet")


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def distinct(rows):
    """In the operators' order: null ids first, then by id, then by digest of the text."""
    dig = lambda t: np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)
    return sorted(set(rows), key=lambda r: (-(2**63) if r[0] is None else r[0], dig(r[1])))


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


@pytest.fixture(scope="module")
def wordless(spark):
    """Batches that hold no word at all: each row is a partition of its own."""
    texts = [None, "", " ", "\n\t \n", None, ""]
    rows = [(i, t, "en", "s", 1, 2, 3, "r") for i, t in zip((1, 2, 3, 4, None, 2), texts, strict=True)]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), SCHEMA)


@pytest.fixture(params=["docs", "hard", "none", "wordless"])
def table(request):
    return request.getfixturevalue(request.param)


def test_substrings(table):
    rows, seen, want = rows_of(table), set(), {}
    for key in distinct(rows):
        words = WORD.findall(key[1])
        gone = [False] * len(words)
        for a in range(len(words) - 19):
            window = tuple(words[a : a + 20])
            if window in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        want[key] = (key[0], len(words), sum(gone), sha(kept))
    got = Counter(tuple(r) for r in substrings.remove_repeats(table, 20, digest=True).collect())
    assert got == Counter(want[r] for r in rows)


def test_lines(table):
    rows, docs_of = rows_of(table), defaultdict(set)
    key = lambda line: lower(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    rank = lambda i: -(2**63) if i is None else i
    for doc in set(rows):
        for line in doc[1].split("\n"):
            if len(key(line)) >= 40:
                docs_of[key(line)].add(doc)
    want = []
    for i, text in rows:
        parts = text.split("\n")
        stay = [x for x in parts if len(docs_of[key(x)]) < 5 or max(rank(d[0]) for d in docs_of[key(x)]) == rank(i)]
        want.append((rank(i), len(parts), len(parts) - len(stay), sha("\n".join(stay))))
    out = lines.drop_repeated_lines(table, digest=True).select("id", "n_lines", "n_dropped", "kept").collect()
    assert Counter(map(tuple, out)) == Counter(want)


def print_of(text):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[a : a + 3]) for a in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(table):
    rows = rows_of(table)
    prints = {t: print_of(t) for t in {r[1] for r in rows}}
    group = {p: p for p in prints.values()}
    for a in group:
        for b in group:
            if (a ^ b).bit_count() <= 3 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = {p: new if g == old else g for p, g in group.items()}
    low = {}
    for i, t in rows:
        if i is not None:
            g = group[prints[t]]
            low[g] = min(low.get(g, i), i)
    got = simhash.near_duplicates(table).select("id", "print", "component_id").collect()
    null = -(2**63)
    want = Counter((null if i is None else i, prints[t], low.get(group[prints[t]])) for i, t in rows)
    assert Counter((r["id"], r["print"] & (2**64 - 1), r["component_id"]) for r in got) == want


@pytest.mark.parametrize(("blocks", "tile"), [(1, 3), (2, 50), (4, 4096), (6, 7)])
def test_simhash_links_for_any_tiles(spark, blocks, tile):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**62), 2**62, 40)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(60, rng.integers(0, 6), replace=False)) for b in base for _ in range(6)]
    prints = spark.createDataFrame([(p,) for p in near], "print long")
    got = simhash.links(prints, 3, blocks=blocks, tile=tile).collect()
    nodes = sorted(set(near))

    def classes(pairs):
        group = {p: p for p in nodes}
        for a, b in pairs:
            if group[a] != group[b]:
                old, new = group[a], group[b]
                group = {p: new if g == old else g for p, g in group.items()}
        return {frozenset(p for p in nodes if group[p] == g) for g in group.values()}

    assert all(((u ^ v) & (2**64 - 1)) >= 0 for u, v in got)
    assert classes(got) == classes((a, b) for a in nodes for b in nodes if ((a ^ b) & (2**64 - 1)).bit_count() <= 3)


@pytest.mark.parametrize("most", [1024, 1])
def test_long_matches(table, monkeypatch, most):
    monkeypatch.setattr(long_matches, "MOST_SEGMENTS", most)
    rows = rows_of(table)
    count = Counter()
    for _, t in set(rows):
        b = t.encode()
        count.update(b[i : i + 400] for i in range(len(b) - 399))
    want = {}
    for key in set(rows):
        b = key[1].encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - 399):
            if count[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        spans = int((gone[:-1] & ~np.r_[False, gone[:-1]][:-1]).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~gone[:-1]])
        want[key] = (key[0], len(b), int(gone.sum()), spans, sha(kept))
    got = long_matches.remove_long_matches(table, 400, digest=True).collect()
    assert Counter(map(tuple, got)) == Counter(want[r] for r in rows)


def test_tokens_and_packing(table):
    whole = Tokenizer.from_file(BPE)
    rows = rows_of(table)
    ids = {t: whole.encode(t, add_special_tokens=False).ids for _, t in rows}
    null = -(2**63)
    counts = token_counts.token_counts(table, BPE).collect()
    assert Counter(map(tuple, counts)) == Counter((null if i is None else i, len(t.encode()), len(ids[t])) for i, t in rows)
    placed = packing.pack_documents(table, BPE).collect()
    spaces, found = defaultdict(list), Counter()
    for r in placed:
        spaces[r["sequence_id"]].append((r["offset"], r["length"]))
        found[r["id"], r["dig"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
    for parts in spaces.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    want = Counter()
    for i, t in rows:
        own, dig = [*ids[t], 2], np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)
        first = (len(own) - 1) % 1024 + 1
        for piece, start in enumerate([0, *range(first, len(own), 1024)]):
            part = own[start : first if not piece else start + 1024]
            want[null if i is None else i, int(dig), piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert found == want


def test_stored_counts_are_used_again(spark, docs, tmp_path):
    cache = str(tmp_path / "cache")
    first = token_counts.token_counts(docs, BPE, cache).count()
    size = spark.read.parquet(cache).count()
    again = token_counts.token_counts(docs.unionByName(docs), BPE, cache).count()
    assert (again, spark.read.parquet(cache).count()) == (2 * first, size)


@pytest.mark.parametrize("ranges", [1, 7])
def test_sweeps_match_pieces_with_gaps(spark, ranges):
    rng = np.random.default_rng(2)
    sizes, gaps = rng.integers(9, 40, 150).tolist(), rng.integers(14, 40, 90).tolist()
    active = spark.createDataFrame([(i, 0, 0, n) for i, n in enumerate(sizes)], "id long, dig long, piece int, length long")
    table = spark.createDataFrame(list(enumerate(gaps)), "_seq long, _gap long")
    got = {r["id"]: r["_seq"] for r in packing._matched(active, table, max(sizes), 4, ranges).collect()}
    left = Counter(dict(enumerate(gaps)))
    for i, seq in got.items():
        left[seq if seq is not None else "none"] -= sizes[i]
    assert len(got) == 150 and min(left[s] for s in range(90)) >= 0
    lone = [n for i, n in enumerate(sizes) if got[i] is None]
    assert not [n for n in lone if any(left[s] == g >= n for s, g in enumerate(gaps))]
    if ranges == 1:  # best-fit decreasing
        plain, none = list(gaps), []
        for n in sorted(sizes, reverse=True):
            fit = [g for g in plain if g >= n]
            if fit:
                plain[plain.index(min(fit))] -= n
            else:
                none.append(n)
        assert sorted(plain) == sorted(left[s] for s in range(90))
        assert Counter(none) == Counter(lone)


@pytest.mark.parametrize("low, high, n", [(1, 40, 300), (1, 4, 300), (13, 14, 50), (39, 40, 20), (1, 2, 0)])
def test_packing_is_close_to_best_fit_decreasing(spark, low, high, n):
    sizes = np.random.default_rng(1).integers(low, high, n).tolist()
    rows = spark.createDataFrame([(i // 2, 7, i % 2, s, "x") for i, s in enumerate(sizes)], "id long, dig long, piece int, length long, extra string")
    got = packing.pack(rows, 39, events=60).collect()
    assert Counter(r["length"] for r in got) == Counter(sizes) and len({(r["id"], r["piece"]) for r in got}) == n
    spaces = defaultdict(list)
    for r in got:
        spaces[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in spaces.values():
        ends = [a + b for a, b in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 39
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps[gaps.index(min(fit))] -= s
        else:
            gaps.append(39 - s)
    assert len(spaces) <= len(gaps) * 1.02


ITEMS = [(1, COPY), (2, "a"), (3, None), (4, "own LINE 3 q3"), (None, "common3 common4"), (5, "!!!"), (1, COPY)]


def test_decontamination(spark, table):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in ITEMS:
        w = word.findall(lower(t or ""))
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[s : s + n])].add(i)
    got = decontamination.contaminated(table, spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    got = {(r["id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got}
    want = set()
    for i, t in rows_of(table):
        w = word.findall(lower(t))
        hit, items = set(), set()
        for n in range(1, 11):
            for s in range(len(w) - n + 1):
                if own := windows.get(tuple(w[s : s + n])):
                    hit |= set(range(s, s + n))
                    items |= {str(x) for x in own if x is not None}
        want.add((-(2**63) if i is None else i, len(w), len(hit), tuple(sorted(items))))
    assert got == want


def test_urls_of_any_kind(spark):
    pages = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.ORG/es/x?q#f"), (5, "http://org/"), (6, "http://xorg/"), (7, "http://a.com")]
    pages += [(8, "http://a.com/fr/://b"), (9, "HTTP://example.org/en/19"), (9, "HTTP://example.org/en/19"), (10, "http://a.com\n/de/x\ny")]
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow")]
    rules += [("com", "/de/", "block"), ("com", "/de/", "allow"), (None, "/", "block")]
    frame = spark.createDataFrame(pages, "page_id long, url string")
    named = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = Counter((r["page_id"], r["rule"], r["verdict"]) for r in urls.judge_urls(frame, named, keep=("page_id",)).collect())
    want = {1: (None, "allow"), 2: (None, "allow"), 3: (None, "allow"), 4: ("example.org/es/", "block"), 5: ("org/", "allow")}
    want |= {6: (None, "allow"), 7: (None, "allow"), 8: ("com/fr/", "allow"), 9: ("example.org/en/1", "block"), 10: (None, "allow")}
    assert got == Counter((i, *want[i]) for i, _ in pages)
    assert {r["verdict"] for r in urls.judge_urls(frame, named.limit(0)).collect()} == {"allow"}


def test_quality(table):
    got = quality.judged(table).collect()
    base = Counter()
    for i, text in rows_of(table):
        w = WORD.findall(text)
        count = Counter(tuple(w[a : a + 8]) for a in range(len(w) - 7))
        twice = {p for a in range(len(w) - 7) if count[tuple(w[a : a + 8])] > 1 for p in range(a, a + 8)}
        solid = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(w) < 20 or 100 * len(twice) > 30 * len(w)
        symbols = sum(text.count(c) for c in "#*$%&|<>")
        base[-(2**63) if i is None else i, len(w), sum(map(len, w)), symbols, len(solid) - len(set(solid)), len(twice), failed] += 1
    names = ("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in got) == base
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_minimum_determinant_is_not_moved_by_outliers():
    rng = np.random.default_rng(2)
    good = rng.multivariate_normal([1, 2, 3, 4], np.diag([1, 2, 3, 4]) / 10, 900)
    centre, scatter = quality.minimum_determinant(np.r_[good, rng.normal(30, 1, (180, 4))])
    assert np.allclose(centre, [1, 2, 3, 4], atol=0.1) and np.allclose(np.diag(scatter), np.array([1, 2, 3, 4]) / 10, rtol=0.4)


def test_quality_keeps_the_good_and_drops_the_bad(spark, data_dir):
    judged = QUERIES["op2_quality_rules"](spark, data_dir).join(spark.read.parquet(f"{data_dir}/labels.parquet"), "doc_id")
    found = {(r["quality"], r["kept"]): r["count"] for r in judged.where("not base_failed").groupBy("quality", "kept").count().collect()}
    assert found.get((1, False), 0) <= 0.01 * found[1, True]
    assert found.get((0, True), 0) <= 0.3 * (found.get((0, False), 0) + found.get((0, True), 0))


def test_cutoff_is_a_chi_square_quantile():
    for p, want in ((1, 10.828), (4, 18.467), (7, 24.322)):
        assert abs(quality.chi_square(p, 0.999) - want) < 0.001
    assert quality.CUTOFF == quality.chi_square(quality.P, 0.999)


@pytest.fixture(scope="module")
def labelled(spark, data_dir):
    """Verdicts on the labelled rows of sf0.1, whose groups are large enough for estimates of their own."""
    folder = str(Path(data_dir).parent / "sf0.1")
    judged = quality.judged(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return judged.join(labels, judged["id"] == labels["doc_id"]).where("not base_failed").toPandas()


def test_quality_drops_junk_near_the_good(labelled):
    good, bad = labelled[labelled.quality == 1], labelled[labelled.quality == 0]
    assert bad.kept.mean() <= 0.03 and (~good.kept).mean() <= 0.002


def test_quality_drops_repetition_and_digits(spark):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.integers(3, 9))) for _ in range(400)]
    plain = lambda n: [str(w) for w in rng.choice(vocabulary, n)]
    lines_of = lambda words: "\n".join(" ".join(words[a : a + 6]) for a in range(0, len(words), 6))
    good = [lines_of(plain(rng.integers(60, 200))) for _ in range(400)]
    good[:40] = [f"{t}\n5557209 40260839" for t in good[:40]]  # a number or a repeated line is no fault
    good[40:60] = [f"{t}\n{t.split(chr(10))[0]}" for t in good[40:60]]
    runs = [" ".join(w for w in plain(10) for _ in range(6)) for _ in range(5)]
    digits = [" ".join(str(rng.integers(10**3, 10**5)) for _ in range(100)) for _ in range(5)]
    equal = ["\n".join(x for k in range(0, 120, 6) for x in (" ".join(words[k : k + 6]), "more")) for words in (plain(120) for _ in range(5))]
    rows = [(i, t, "en", "s") for i, t in enumerate([*good, *runs, *digits, *equal])]
    got = {r["id"]: r for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    for i, text, *_ in rows:
        w = WORD.findall(text)
        assert got[i]["n_echoes"] == sum(a == b for a, b in zip(w, w[1:], strict=False))
    assert not any(got[i]["base_failed"] for i in got)
    assert sum(not got[i]["kept"] for i in range(len(good))) <= 4
    assert [i for i in range(len(good), len(rows)) if got[i]["kept"]] == []


def test_quality_keeps_no_labelled_runs(labelled):
    assert not labelled[labelled.id.isin([1847, 7628, 6930, 6449, 7127])].kept.any()


def test_languages(spark, data_dir, hard, none):
    got = QUERIES["op5_language_id"](spark, data_dir).join(spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out and lang is not null").toPandas()
    assert len(held) and (held.lang == held.lang_pred).mean() >= 0.97
    names, model = languages.learn(hard)
    out = languages.predict(hard.select("doc_id", "text"), names, model).collect()
    assert len(out) == len(HARD) and all(0 <= r["score"] <= 1 for r in out)
    assert {r["lang_pred"] for r in out if r["doc_id"] in (1, 2, 3, 10)} == {"und"}
    assert languages.learn(none)[0] == []
    assert {r["lang_pred"] for r in languages.predict(hard.select("doc_id", "text"), *languages.learn(none)).collect()} == {"und"}


def test_mixture_of_two_languages(spark):
    en, de = "the house with the garden there and then the other thing " * 30, "und der garten mit dem haus ist nicht von hier und auch nicht " * 30
    names, model = languages.learn(spark.createDataFrame([(en, "en"), (de, "de")], "text string, lang string"))
    mixed = spark.createDataFrame([(en[:900] + de[:400],), (en,)], "text string")
    a, b = languages.predict(mixed, names, model).collect()
    assert (a["lang_pred"], b["lang_pred"], b["score"]) == ("en", "en", 1.0) and 0.55 < a["score"] < 0.85


def test_mixture_of_many_languages(spark):
    rng = np.random.default_rng(6)
    letters = ["abcd", "efgh", "ijkl", "mnop", "qrst", "uvwx"]
    plain = lambda own, n: " ".join("".join(rng.choice(list(own), 6)) for _ in range(n))
    names, model = languages.learn(spark.createDataFrame([(plain(own, 2000), f"l{i}") for i, own in enumerate(letters)], "text string, lang string"))
    parts = [150, 75, 75, 75, 75, 50]  # 30 % are in the first
    texts = [" ".join(plain(own, n) for own, n in zip(letters, parts, strict=True)), plain(letters[3], 500)]
    a, b = languages.predict(spark.createDataFrame([(t,) for t in texts], "text string"), names, model).collect()
    assert a["lang_pred"] == "l0" and abs(a["score"] - 0.3) < 0.01
    assert (b["lang_pred"], b["score"]) == ("l3", 1.0)


@pytest.mark.parametrize("text", [None, "", " \n "])
def test_one_row_without_words(spark, data_dir, text):
    one = spark.createDataFrame([(1, text, "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = simhash.near_duplicates(one).collect()
    assert (row["print"], row["component_id"]) == (0, 1)
    for _, stage in corpus_pipeline.STAGES:
        assert len(stage(spark, one, data_dir).collect()) <= 1
    assert stages.simhash_near_dedup(spark, one, data_dir).count() == 1


def test_stages_keep_the_columns(spark, data_dir, hard, none, wordless):
    for frame in (hard, none, wordless):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, data_dir).schema.simpleString() == frame.schema.simpleString()
    kept = stages.simhash_near_dedup(spark, hard, data_dir).select("doc_id", "text").collect()
    assert len(kept) == simhash.near_duplicates(hard, group="class").select("class").distinct().count()
    changed = {r["doc_id"]: r for r in stages.line_dedup(spark, hard, data_dir).collect()}
    assert changed[27]["text"].count("\n") == 2 and LINE not in changed[20]["text"] and changed[1]["text"] is None
    assert changed[20]["n_chars"] == len(changed[20]["text"]) and changed[27]["n_chars"] == 1


def test_pipeline(spark, data_dir):
    out = corpus_pipeline.run(spark, data_dir).collect()
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    clean = {r[0] for r in QUERIES["op1_benchmark_decontamination"](spark, data_dir).where("not contaminated").select("doc_id").collect()}
    assert len(out) and {r["doc_id"] for r in out} <= clean
    assert {r["doc_id"] for r in out} <= {r[0] for r in docs.select("doc_id").collect()}


NULL = -(2**63)


def plain_verdicts(rows):
    """(kept, d2) for each (id, text, lang, source): counts, estimates and distances without Spark."""
    counts = []
    for _, text, _, _ in rows:
        w, solid = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        seen = Counter(tuple(w[a : a + 8]) for a in range(len(w) - 7))
        twice = {p for a in range(len(w) - 7) if seen[tuple(w[a : a + 8])] > 1 for p in range(a, a + 8)}
        found = [sum(c in "#*$%&|<>" for c in text), sum("!" <= c <= "~" and not c.isalnum() for c in text), sum("A" <= c <= "Z" for c in text)]
        found += [sum("0" <= c <= "9" for c in text), sum(a == b for a, b in zip(w, w[1:], strict=False)), len(solid) - len(set(solid))]
        counts.append([len(w), sum(map(len, w)), *found, len(solid), len(twice)])
    n, chars, *rates, n_lines, twice = np.array(counts, dtype=float).reshape(-1, 10).T
    usable = (n >= 20) & (100 * twice <= 30 * n)
    shrunk = lambda c, of, prior: (c + prior * (c[usable].sum() / (of[usable].sum() or 1))) / (of + prior)
    x = [np.log(np.maximum(shrunk(chars, n, 100), 1e-6)), *(np.sqrt(shrunk(c, n, 100)) for c in rates[:-1]), np.sqrt(shrunk(rates[-1], n_lines, 10))]
    x, floor = np.stack(x, axis=1), np.array([0.02, 0.02, 0.02, 0.02, 0.2, 0.02, 0.08]) ** 2
    sizes, rest = Counter(), Counter()
    for (_, _, lang, source), u in zip(rows, usable, strict=True):
        sizes[lang, source] += int(u)
    for (lang, _), k in sizes.items():
        rest[lang] += k if k < 100 else 0

    def group(lang, source):
        if sizes[lang, source] >= 100:
            return lang, source
        return (lang, "rest") if rest[lang] >= 100 else ("rest", "rest")

    groups = [group(lang, source) for _, _, lang, source in rows]
    known = {}
    for g in set(groups):
        own = x[[a == g and u for a, u in zip(groups, usable, strict=True)]]
        assert len(own) <= 2000
        if len(own) >= 100:
            centre, scatter = quality.minimum_determinant(own, floor)
            for _ in range(2):
                d2 = [(v - centre) @ np.linalg.inv(scatter) @ (v - centre) for v in own]
                inner = own[np.array(d2) <= np.percentile(d2, 75)]
                centre, scatter = inner.mean(axis=0), np.cov(inner.T, bias=True) * quality.consistency(7, 0.75) + np.diag(floor)
            known[g] = len(inner), centre, scatter
    if not known:
        return [(bool(u), None) for u in usable]
    weights = [k[0] for k in known.values()]
    overall = [np.average([k[i] for k in known.values()], axis=0, weights=weights) for i in (1, 2)]
    out = []
    for v, g, u in zip(x, groups, usable, strict=True):
        centre, scatter = known[g][1:] if g in known else overall
        d2 = (v - centre) @ np.linalg.inv(scatter) @ (v - centre)
        out.append((bool(u and d2 <= 24.3219), d2))
    return out


def digest(text):
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).astype(np.int64))


def whole_rows(df):
    names = ("doc_id", "text", "lang", "source")
    return [(NULL if i is None else i, t or "", lang or "\0", source or "\0") for i, t, lang, source in (tuple(r[c] for c in names) for r in df.collect())]


@pytest.mark.parametrize("name", ["docs", "hard", "none", "sf0.01"])
def test_quality_verdicts(spark, request, data_dir, name):
    folder = Path(data_dir).parent / name
    table = spark.read.parquet(f"{folder}/documents.parquet") if name == "sf0.01" else request.getfixturevalue(name)
    rows = whole_rows(table)
    want = sorted((i, digest(t), k, -1 if d is None else d) for (i, t, _, _), (k, d) in zip(rows, plain_verdicts(rows), strict=True))
    got = sorted((r["id"], r["dig"], r["kept"], -1 if r["d2"] is None else r["d2"]) for r in quality.judged(table).collect())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-6, atol=1e-9)


def plain_pipeline(rows, items):
    """What the stages leave, and how many rows or lines each took."""
    kept = [(i, t) for (i, t, _, _), (k, _) in zip(rows, plain_verdicts(rows), strict=True) if k]
    took = [len(rows) - len(kept)]

    key = lambda line: lower(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    docs_of = defaultdict(set)
    for doc in kept:
        for line in doc[1].split("\n"):
            if len(key(line)) >= 40:
                docs_of[key(line)].add(doc)
    keeper = {k: max(d[0] for d in v) for k, v in docs_of.items() if len(v) >= 5}
    lined = [(i, "\n".join(x for x in t.split("\n") if keeper.get(key(x), i) == i)) for i, t in kept]
    took.append(sum(a != b for a, b in zip(kept, lined, strict=True)))

    prints = {t: print_of(t) for _, t in lined}
    group = {p: p for p in prints.values()}
    for a in list(group):
        for b in list(group):
            if (a ^ b).bit_count() <= 3 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = {p: new if g == old else g for p, g in group.items()}
    first = {}
    for i, t in lined:
        g = group[prints[t]]
        first[g] = min(first.get(g, (i, digest(t), t)), (i, digest(t), t))
    alone = [(i, t) for i, _, t in first.values()]
    took.append(len(lined) - len(alone))

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for t in items:
        w = word.findall(lower(t or ""))
        n = min(10, len(w))
        windows |= {tuple(w[a : a + n]) for a in range(len(w) - n + 1 if w else 0)}

    def hit(t):
        w = word.findall(lower(t))
        return any(tuple(w[a : a + n]) in windows for n in {len(x) for x in windows} for a in range(len(w) - n + 1))

    clean = [(i, t) for i, t in alone if not hit(t)]
    took.append(len(alone) - len(clean))

    whole, out = Tokenizer.from_file(BPE), Counter()
    for i, t in clean:
        own = [*whole.encode(t, add_special_tokens=False).ids, 2]
        head = (len(own) - 1) % 1024 + 1
        for piece, start in enumerate([0, *range(head, len(own), 1024)]):
            part = own[start : head if not piece else start + 1024]
            out[None if i == NULL else i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out, took


def test_pipeline_rows(spark, data_dir, docs, tmp_path):
    """Whole rows against the plain stages, on the documents and rows planted for each stage."""
    items = [r[0] for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").select("text").collect()]
    real = [r["text"] for r in docs.where("lang = 'en'").orderBy("doc_id").limit(40).collect()]
    planted = [(10**6 + k, f"{t}\n{LINE}\nthe end of {k}") for k, t in enumerate(real[:8])]
    planted += [(10**6 + 100 + k, f"{t} {t.split()[0]}") for k, t in enumerate(real[8:16])]  # near copies
    planted += [(10**6 + 200 + k, f"{t} {items[k]} {real[k]}") for k, t in enumerate(real[16:24])]
    planted += [(10**6 + 300, "short"), (10**6 + 301, None), (None, real[30] + " " + " ".join(reversed(real[31].split())))]
    extra = spark.createDataFrame([(i, t, "en", "src0") for i, t in planted], "doc_id long, text string, lang string, source string")
    table = docs.unionByName(extra.withColumn("n_chars", F.length("text").cast("long")))
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{data_dir}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    want, took = plain_pipeline(whole_rows(table), items)
    assert all(took)  # no stage is idle here
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    places = defaultdict(list)
    for r in out:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        parts.sort()
        assert [a for a, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1].tolist()] and sum(n for _, n in parts) <= 1024
