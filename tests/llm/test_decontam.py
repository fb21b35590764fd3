import random
import time

from pyspark.sql import functions as F

from loomsift.llm import decontam


def least_edits(item, text):
    """Sellers' algorithm over the whole text: least edits of the item to any passage, and its earliest end."""
    row = [0] * (len(text) + 1)
    for r, c in enumerate(item, 1):
        new = [r]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    best = min(row)
    return best, row.index(best)


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(chars)), rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyzq")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyzq"))
    return "".join(chars)


def test_against_full_alignment():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(k, prose(rng.randint(8, 40)).capitalize()) for k in range(12)]
    texts = [prose(60) for _ in range(10)]
    for _, item in items:
        for n in (0, 1, 3, 5, 9, 14):
            texts.append(prose(10) + "\n " + edited(rng, item, n).replace(" ", "  ") + " " + prose(12))
    index = decontam.Index(items)
    got = {(r, i): (e, end) for r, i, e, end, _ in decontam.leaks(texts, index)}
    want = {}
    for r, text in enumerate(texts):
        for i, item in items:
            a, b = decontam.normalised(item), decontam.normalised(text)
            edits, end = least_edits(a, b)
            if edits <= decontam.budget(len(a)):
                want[r, i] = (edits, end)
    assert len(want) > 30 and got == want


def found(texts, items):
    return {(r, i): (e, end) for r, i, e, end, _ in decontam.leaks(texts, decontam.Index(items))}


def wanted(texts, items):
    out = {}
    for r, text in enumerate(texts):
        for i, item in items:
            a, b = decontam.normalised(item), decontam.normalised(text)
            edits, end = least_edits(a, b)
            if edits <= decontam.budget(len(a)):
                out[r, i] = (edits, end)
    return out


def test_every_length_of_short_items_against_full_alignment():
    """Substitutions spread so that as few q-grams as can be survive, and random edits, for all lengths from 20 to 60."""
    rng = random.Random(4)
    hits = 0
    for size in range(20, 61):
        item = "".join(rng.choice("abcdefgh ") for _ in range(size)).replace("  ", "ab").strip().ljust(size, "z")
        k = decontam.budget(size)
        even = list(item)
        for n in range(k):
            even[(n + 1) * size // (k + 1)] = "#"
        passages = ["".join(even), *(edited(rng, item, n) for n in range(k + 3))]
        texts = [f"{'qrs tuv ' * 4}{p}{' wxy' * 5}" for p in passages]
        want = wanted(texts, [(1, item)])
        assert found(texts, [(1, item)]) == want, size
        assert (0, 1) in want
        hits += len(want)
        assert min(decontam.Index([(1, item)]).least) >= 1
    assert hits > 150


def test_repeated_runs_against_full_alignment():
    rng = random.Random(5)
    items = [(0, "a" * 60), (1, "ab" * 40), (2, "abc " * 12 + "end"), (3, "a" * 40 + "b" * 30)]
    texts = ["a" * 300, "ab" * 100, "a" * 90 + "b" * 90, "abc " * 60, "abc " * 30 + "end " + "a" * 58 + "xx", "".join(rng.choice("ab") for _ in range(400))]
    assert found(texts, items) == wanted(texts, items)


def test_long_runs_are_counted_in_linear_time():
    began = time.time()
    index = decontam.Index([(1, "a" * 2000), (2, "a" * 1500 + "b" * 500), (3, "a" * 27)])
    got = {(r, i): e for r, i, e, _, _ in decontam.leaks(["a" * 300_000], index)}
    assert got == {(0, 1): 0, (0, 3): 0}
    assert time.time() - began < 20


def test_short_items_need_word_borders():
    items = [(1, "Paris"), (2, "42"), (3, " "), (4, "paris")]
    assert found(["in PARIS, 142", "comparison", "answer: 42", "42", ""], items) == {(0, 1): (0, 8), (0, 4): (0, 8), (2, 2): (0, 10), (3, 2): (0, 2)}


def test_hashes_of_any_size_tell_grams_apart():
    text = decontam.codes("abcabcabdabcabc")
    for q in range(1, 13):
        h = decontam.gram_hashes(text, q).tolist()
        grams = ["abcabcabdabcabc"[k : k + q] for k in range(len(h))]
        assert len(set(zip(h, grams))) == len(set(h)) == len(set(grams))


def test_stage_decides_by_row(spark):
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    rows = [(1, item, "a"), (1, "clean", "b"), (None, item, "c"), (None, "also clean", "d"), (2, None, "e"), (3, "", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    out = decontam.without_leaks(docs, bench)
    assert out.columns == docs.columns and sorted(r.item_id for r in out.collect()) == ["b", "d", "e", "f"]
    assert decontam.without_leaks(docs, bench.limit(0)).count() == 6 and decontam.without_leaks(docs.limit(0), bench).count() == 0


def test_edge_rows(spark):
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    rows = [(1, None), (2, ""), (3, item.upper()), (4, "a " * 60_000 + item), (3, item.upper()), (5, "nothing of note"), (None, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([(7, item), (8, None), (9, "short"), (10, "")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.edits) for r in decontam.decontaminate(docs, bench).collect()), key=str)
    assert got == sorted([(3, 7, 0), (3, 7, 0), (4, 7, 0), (None, 7, 0)], key=str)
    assert decontam.decontaminate(docs.limit(0), bench).count() == 0
    assert decontam.decontaminate(docs, bench.limit(0)).count() == 0


def test_exact_passages_are_found(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, decontam.normalised(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in decontam.normalised(r.text)}
    got = {(r.doc_id, r.item_id) for r in decontam.op9_benchmark_decontamination(spark, sf_dir).where("edits = 0").collect()}
    assert got == want and want
