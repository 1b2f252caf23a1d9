"""What a worker takes for the functions that run inside tasks, and the table of pieces as it grows."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from featuremart.llm import long_matches, packing, quality_stats, tokens

RNG = random.Random(5)
WORDS = ["".join(RNG.choices("abcdefghijklmnopqrstuvwxyz", k=RNG.randint(2, 9))) for _ in range(5_000)]
TEXTS = [" ".join(RNG.choices(WORDS, k=400)) for _ in range(3_000)]  # some 8 MB
RUNS = {"segments": long_matches._segments(400), "counting": quality_stats.counting, "pieces": packing._pieces(public_tokenizers.path("byte_bpe_50k.json"), 2, 1024)}


def batch(texts):
    n = np.arange(len(texts))
    return pa.RecordBatch.from_arrays([pa.array(n), pa.array(n), pa.array(texts)], ["id", "dig", "text"])


@pytest.mark.parametrize("name", RUNS)
def test_a_worker_takes_little_beside_its_batch(name):
    given = batch(TEXTS)
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in RUNS[name](iter([given])))
        assert rows >= len(TEXTS)
        assert tracemalloc.get_traced_memory()[1] < 80e6
    finally:
        tracemalloc.stop()


def test_remembered_pieces_grow_with_their_number():
    known, keys = tokens._Known(), np.random.default_rng(1).choice(2**62, 300_000, replace=False).astype(np.uint64) * np.uint64(4) | np.uint64(1)
    assert known.keys.nbytes < 1e6
    for a in range(0, len(keys), 70_000):
        part = keys[a : a + 70_000]
        known.add(part, [[int(k) % 1000] for k in part])
    number = known.find(keys)
    assert (known.ids[known.at[number]] == keys % np.uint64(1000)).all() and (known.sizes[number] == 1).all()
    assert (known.find(keys + np.uint64(2)) == -1).all()
    assert 2 * known.n <= len(known.keys) <= 4 * known.n


def test_remembered_pieces_are_bounded_and_ids_stay_the_same(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    given = [t.encode() for t in TEXTS[:40]] + [f"w{i}x y{i % 700}".encode() for i in range(20_000)]
    given += given[:40]
    data, at = np.frombuffer(b"".join(given), dtype=np.uint8), np.cumsum([0, *map(len, given)])
    whole, edges = tokens.Encoder(path).encode(data, at)
    monkeypatch.setattr(tokens, "MOST_PIECES", 12_000)
    small, got = tokens.Encoder(path), []
    for a in range(0, len(given), 500):
        part = at[a : a + 501]
        got.append(small.encode(data[part[0] : part[-1]], part - part[0])[0])
        assert small.known.n <= 12_000 and small.before.n <= 12_000
    assert small.before.n and (np.concatenate(got) == whole).all() and edges[-1] == len(whole)


def test_a_worker_holds_little_however_many_pieces_it_met():
    tracemalloc.start()
    try:
        encoder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
        encoder._piece_ids = lambda pieces: [[7, 8, 9, 10]] * len(pieces)  # only what is remembered counts here
        for a in range(0, 2_000_000, 25_000):
            text = " ".join(f"{i:07d}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(a, a + 25_000)).encode()
            encoder.encode(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]), ids=False)
        assert tracemalloc.get_traced_memory()[0] < 100e6
    finally:
        tracemalloc.stop()
