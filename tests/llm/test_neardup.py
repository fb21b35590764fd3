import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loomsift.llm import neardup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def brute(rows, percent, width):
    """All links by an inverted index over full sets, then union-find."""
    sets = {i: shingles(t, width) for i, t in rows}
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    tried = set()
    for ids in by.values():
        for k, x in enumerate(ids):
            for y in ids[k + 1 :]:
                if (x, y) in tried:
                    continue
                tried.add((x, y))
                n = len(sets[x] & sets[y])
                if 100 * n >= percent * (len(sets[x]) + len(sets[y]) - n):
                    a, b = sorted((find(x), find(y)))
                    top[b] = a
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def as_dict(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert as_dict(neardup.op1_near_duplicates(spark, sf_dir)) == brute(rows, 85, 3)


@pytest.mark.parametrize("percent, width", [(80, 5), (85, 3)])
def test_chains_and_stars(spark, percent, width):
    """Edited copies of one original that are too far from each other, and a chain of small edits."""
    base = [f"w{k}" for k in range(120)]
    rows = [(1000, " ".join(base))]
    for k in range(40):
        edited = list(base)
        edited[(3 * k) % 110 + 2] = f"x{k}"
        edited[(7 * k + 50) % 110 + 2] = f"y{k}"
        rows.append((k, " ".join(edited)))
    chain = list(base[:60]) + [f"c{k}" for k in range(60)]
    for k in range(30):
        chain[2 * k] = f"z{k}"
        rows.append((2000 - k, " ".join(chain)))
    assert as_dict(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent, width)) == brute(rows, percent, width)


def test_edge_rows(spark):
    long = " ".join(f"word{k}" for k in range(30_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "One two"), (3, "one\ttwo"), (9, "one"), (4, long), (10, long + " end"), (4, long), (None, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash"))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()), key=str)
    want = [(5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 3, False), (3, 1, 3, True), (9, 1, 9, True), (4, 29998, 4, True), (4, 29998, 4, True), (10, 29999, 4, False), (None, 1, 9, False)]
    assert got == sorted(want, key=str)
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.range(200).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    assert {r.comp for r in neardup.components(edges).collect()} == {0}


def test_ids_that_repeat_or_are_missing(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta iota kappa", "one two three four five six seven eight nine ten", "le petit chat dort sur la table de la cuisine")
    rows = [(1, a), (1, a), (1, b), (2, b), (None, a), (None, c), (None, c), (3, None), (3, ""), (None, " "), (4, a + " lambda")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k int").withColumn("t", F.lit("clash")).withColumn("group", F.lit(1))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs, 80, 5).collect()), key=str)
    want = [(1, 6, 1, True), (1, 6, 1, True), (1, 6, 1, True), (2, 6, 1, False), (None, 6, 1, False), (None, 6, None, False), (None, 6, None, False), (3, 0, 3, True), (3, 0, 3, True), (None, 0, None, False), (4, 7, 1, False)]
    assert got == sorted(want, key=str)
    kept = neardup.one_of_each(docs, 80, 5)
    assert kept.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert left == sorted([(1, a), (1, b), (None, c), (3, None), (3, ""), (None, " ")], key=str)
    assert neardup.one_of_each(docs.limit(0), 80, 5).count() == 0


def test_two_clusters_under_one_leader(spark):
    """Edited copies of two texts that are near a third one: keys that one component has alone make no pairs."""
    base = [f"w{k}" for k in range(100)]
    rows = [(0, " ".join(base))]
    for cluster, cut in ((1, 20), (2, 26)):
        own = [f"v{cluster}{k}" for k in range(cut)] + base[cut:]
        for k in range(60):
            edited = list(own)
            edited[30 + k] = f"x{cluster}_{k}"
            rows.append((1000 * cluster + k, " ".join(edited)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent, width in ((80, 5), (85, 3)):
        assert as_dict(neardup.near_duplicates(docs, percent, width)) == brute(rows, percent, width)


def test_rows_under_one_shingle_grow_with_the_cluster(spark):
    """Two clusters of edited copies and one stray under one leader: what the strays are joined with grows linearly."""
    joined = {}
    for n in (1200, 4000):
        # e 0 is shared by the cluster of component 2 and the stray, e 1 by both clusters, e 2 by one alone.
        rows = [(1, 0, k, 2) for k in range(n)] + [(1, 0, -1, 3)]
        rows += [(1, 1, k, 2) for k in range(n)] + [(1, 1, -k, 1) for k in range(2, 5)]
        rows += [(1, 2, k, 2) for k in range(n)]
        one = spark.createDataFrame(rows, "leader long, e long, x long, comp long")
        strays, every = neardup.stray_rows(one)
        assert sorted(r.x for r in strays.collect()) == [-4, -3, -2, -1]
        joined[n] = strays.join(every.select("leader", "e", F.col("x").alias("y")), ["leader", "e"]).count()
    assert joined[4000] <= 3.5 * joined[1200]


def test_two_large_clusters_and_a_stray(spark):
    """Edited copies of a text and of one that is 0.8 like it, and a row between, against brute force."""
    base = [f"w{k}" for k in range(300)]
    second = [f"v{k}" if k % 16 == 5 else w for k, w in enumerate(base)]
    rows = []
    for k in range(240):
        words = list(base if k % 5 < 3 else second)
        words[(7 * k) % 300] = f"x{k}"
        rows.append((k, " ".join(words)))
    between = [f"v{k}" if k % 48 == 5 else w for k, w in enumerate(base)]
    rows.append((999, " ".join(between)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent, width in ((85, 3), (80, 5)):
        assert as_dict(neardup.near_duplicates(df, percent, width)) == brute(rows, percent, width)
