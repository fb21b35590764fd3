import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomsift.llm import packing


def check(rows, texts, capacity):
    """Every document's tokens once, in order, and gapless sequences within the capacity; gives the number of sequences."""
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = sorted(
        (i, k, at, len(part := ids[at : at + capacity]), zlib.crc32(np.array(part, "<u4").tobytes()))
        for i, text in texts
        for ids in [tokenizer.encode(text or "", add_special_tokens=False).ids + [0]]
        for k, at in enumerate(range(0, len(ids), capacity))
    )
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_query_against_the_tokenizer(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = packing.op6_best_fit_packing(spark, sf_dir).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    n = check(rows, texts, 2048)
    assert n <= 1.01 * -(-sum(r.length for r in rows) // 2048) + 1


def test_edge_rows(spark):
    texts = [(1, None), (2, ""), (3, "One  word and\x1cmore é é <|endoftext|>"), (3, "One  word"), (4, "a b c d " * 2000), (5, "don't I'll x's 12345 ???!")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("item", F.lit("clash")).withColumn("length", F.lit(1))
    tokenizer_texts = [(i, t.replace("<|endoftext|>", "") if t else t) for i, t in texts]
    rows = packing.pack(docs.withColumn("text", F.replace("text", F.lit("<|endoftext|>"), F.lit(""))), capacity=64).collect()
    check(rows, tokenizer_texts, 64)
    assert packing.pack(docs.limit(0)).count() == 0


def test_evolution_never_gets_worse():
    rng = np.random.default_rng(5)
    length = rng.integers(1, 100, 400)
    first = packing.evolved(length, [], 100, seed=3, crossings=0)
    later = packing.evolved(length, first, 100, seed=4, crossings=30)
    assert packing.fitness(length, later[0], 100) >= packing.fitness(length, first[0], 100)
    for p in later:
        assert np.bincount(p, weights=length).max() <= 100


def triplets(n, rng):
    """Pieces of which three each fill a bin of 1,000 to the brim."""
    first = rng.integers(380, 490, n)
    second = np.array([rng.integers(250, (1000 - a) // 2) for a in first])
    return np.concatenate([first, second, 1000 - first - second])


@pytest.mark.parametrize("length, capacity, least_gain", [
    (triplets(60, np.random.default_rng(1)), 1000, 1),
    (np.random.default_rng(2).integers(20, 100, 1000), 150, 2),
    (np.random.default_rng(3).integers(300, 1400, 4000), 2048, 5),
])
def test_crossings_save_bins_where_best_fit_is_not_enough(length, capacity, least_gain):
    """With the crossings of production: fewer bins than the best of the best-fit packings that they begin with."""
    bins = lambda p: len(np.unique(p))
    gains = []
    for seed in (2, 3, 4):
        first = packing.evolved(length, [], capacity, seed, crossings=0)
        state = first
        for step in range(packing.ROUNDS):
            state = packing.evolved(length, state, capacity, seed + 31 * (step + 1))
        assert all(np.bincount(p, weights=length).max() <= capacity for p in state)
        gains.append(min(map(bins, first)) - min(map(bins, state)))
    assert min(gains) >= 0 and sum(gains) / len(gains) >= least_gain


def test_packing_of_hard_lengths_through_spark(spark):
    """Lengths for which best fit wastes room, over several shards."""
    rng = np.random.default_rng(7)
    rows = [(k, " ".join(["a"] * int(n))) for k, n in enumerate(rng.integers(20, 100, 900))]
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), capacity=152, shard_size=300).collect()
    n = check(found, rows, 152)
    assert n <= 1.03 * -(-sum(r.length for r in found) // 152)


def test_crossing_keeps_the_injected_bins():
    rng = np.random.default_rng(1)
    length = rng.integers(5, 60, 80)
    a, b = (packing.packed_at_random(length, 100, rng, 0.3) for _ in range(2))
    child = packing.crossed(length, a, b, 100, rng)
    groups = lambda p: {frozenset(np.flatnonzero(p == k)) for k in np.unique(p)}
    assert groups(child) & groups(a)
    assert np.bincount(child, weights=length).max() <= 100


def test_chunks_have_the_tokenizers_ids():
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    tokenizer.encode_special_tokens = True
    rng = random.Random(1)
    bits = ["a", "B", "ñ", "Ü", "ſ", "ŉ", "Ÿ", "µ", "ª", "é", "É", "e\u0301", "\u0301", "'s", "'", "'ll", "d", "7", "٣", "!", "--", "...", "\x01", "\x1c", "\u2003", "ß", "Σ", "İ", "<|endoftext|>", "|", "日本", "_", " ", "\n", "½", "€", "\u200d", "👩"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    ids = packing.ChunkIds(packing.default_tokenizer())
    for text in texts:
        assert ids.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
