import random
import re

import numpy as np
import pytest
import xxhash

from loomsift.lineage import written
from loomsift.llm import simhash

DOCS = "doc_id long, text string, fp string, tile string"


def plain_fingerprint(text, width=4):
    """Bit by bit."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute(fps, radius):
    """The least reachable index's component for each fingerprint, over all pairs."""
    fps = np.array(fps, np.uint64)
    comp = list(range(len(fps)))
    todo = set(comp)
    while todo:
        start = min(todo)
        seen, edge = {start}, [start]
        while edge:
            near = set(np.flatnonzero(np.bitwise_count(fps ^ fps[edge.pop()]) <= radius).tolist()) - seen
            seen |= near
            edge.extend(near)
        for k in seen:
            comp[k] = start
        todo -= seen
    return comp


def expected(rows, radius=4):
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = brute(fps, radius)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted(((i, f"{fp:016x}", least.get(c)) for (i, _), fp, c in zip(rows, fps, comp)), key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS)


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(simhash.op12_simhash_near_duplicates(spark, sf_dir)) == expected(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{k % 997}" for k in range(20_000))
    rows = [
        (5, None), (4, ""), (9, " \t\x0b "), (1, "one"), (2, "ONE"), (3, "one two three"), (None, "one two three"), (None, "nobody else has this text of mine"), (6, long), (6, long), (6, "another text for id six"),
        (7, long + " tail"), (8, "a\x1fb c\xa0d e f"), (-3, "É é a b c d"), (-4, "é é a b c d"), (10, long.upper()),
    ]
    assert found(simhash.near_duplicates(frame(spark, rows))) == expected(rows)
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


@pytest.mark.parametrize("radius, own", [(0, True), (4, True), (4, False), (7, False)])
def test_tiles_against_all_pairs(radius, own, monkeypatch):
    """Links within a tile and between two, blocks smaller and larger than a tile."""
    rng = np.random.default_rng(radius)
    seeds = rng.integers(0, 2**64, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (3000, 3), dtype=np.uint64)
    every = np.unique(np.bitwise_xor.reduce(np.concatenate([rng.choice(seeds, (3000, 1)), flips], axis=1), axis=1))
    rng.shuffle(every)
    a, b = (every, None) if own else (every[:1700], every[1700:])
    for block in (64, 4096):
        monkeypatch.setattr(simhash, "BLOCK", block)
        x, y = simhash.linked(a, b, radius)
        got = dict(zip(x.tolist(), y.tolist()))
        side = np.zeros(len(every), bool) if own else np.arange(len(every)) < len(a)
        near = np.bitwise_count(every[:, None] ^ every[None]) <= radius
        if not own:
            near &= side[:, None] != side[None]
        label = every.copy()
        while True:
            new = np.array([min(label[k], *label[near[k]]) if near[k].any() else label[k] for k in range(len(every))], np.uint64)
            if (new == label).all():
                break
            label = new
        assert {f: v for f, v in zip(every.tolist(), label.tolist()) if f != v} == got


def test_more_tiles_give_the_same(spark):
    """Counts cut into many tiles, and links across them."""
    rng = random.Random(5)
    base = [f"b{k}" for k in range(400)]
    rows = []
    for k in range(300):
        words = list(base) if k % 3 else [f"r{rng.random()}" for _ in range(100)]
        words[rng.randrange(len(words))] = f"x{k}"
        rows.append((k, " ".join(words)))
    want = expected(rows)
    assert len({c for _, _, c in want}) < 290
    assert found(simhash.near_duplicates(frame(spark, rows), tile=7)) == want


def test_rows_of_a_large_group(spark):
    """Edited copies make a row each in a pair of tiles, not one for each pair of copies."""
    rng = np.random.default_rng(1)
    for n in (500, 2000):
        flips = np.unique(np.uint64(0x0F0F0F0F0F0F0F0F) ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)))
        x, _ = simhash.linked(flips, None, 4)
        assert len(x) == len(flips) - 1


@pytest.mark.parametrize("radius", [0, 1, 4, 7, 63, 64, 70])
def test_bands_are_all_bits_once(radius):
    made = [(first, mask % 2**64) for first, mask in simhash.bands(radius)]
    assert len(made) == radius + 1 and sum(mask << first for first, mask in made) == 2**64 - 1
    assert sum(mask.bit_count() for _, mask in made) == 64


def test_only_what_shares_a_band_is_compared(spark, monkeypatch):
    """Unlike fingerprints do not all meet: the squares of the tiles add up to a small part of all pairs, and no link is lost."""
    rng = np.random.default_rng(7)
    n, kept = 4000, {}
    seeds = rng.integers(0, 2**64, n, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << np.array([rng.choice(64, 4, replace=False) for _ in range(50)], np.uint64), axis=1)
    every = np.concatenate([seeds, seeds[:50] ^ flips]).view(np.int64)
    monkeypatch.setattr(simhash, "written", lambda df, name, *by: kept.setdefault(name, written(df, name, *by)))
    rows = {(r.x, r.y) for r in simhash.edges(spark.createDataFrame([(v,) for v in every.tolist()], "fp long"), 4).collect()}
    joined = {frozenset(r) for r in rows}
    assert all(frozenset((a, b)) in joined for a, b in zip(every[:50].tolist(), every[n:].tolist()))
    assert kept["tiles"].selectExpr("sum(pow(size(fps), 2))").first()[0] < n * n / 50
