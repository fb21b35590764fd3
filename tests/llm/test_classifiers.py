import math
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loomsift.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def held_out_accuracy(spark, rows, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    both = rows.join(labels, "doc_id").where("held_out")
    return both.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


@pytest.mark.parametrize("query, label, least", [(quality.op3_quality, "quality", 0.95), (toxicity.op5_toxicity, "toxic", 0.93)])
def test_held_out(spark, query, label, least):
    rows = query(spark, SF)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert rows.where("score < 0 or score > 1 or score is null").count() == 0
    assert held_out_accuracy(spark, rows, label) >= least


@pytest.mark.parametrize("module, model", [(quality, np.linspace(-1, 1, (1 << quality.BITS) + 1)), (toxicity, {"": -1.0, "bad": 2.0, "idi-": 0.5})])
def test_edge_rows(spark, module, model):
    rows = [(1, None), (2, ""), (3, "some bad text"), (3, "some bad text"), (4, "word " * 100_000), (None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = {r.doc_id: r.score for r in module.score(docs, model).collect()}
    assert len(got) == 5 and all(0 <= s <= 1 for s in got.values()) and got[1] == got[2]
    assert module.score(docs.limit(0), model).count() == 0


def test_learning_without_labels(spark):
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.score(docs, quality.learn(docs, labels, "quality")).collect()] == [0.5]
    assert [r.score for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()] == [0.5]


def test_quality_score_is_the_dot_product():
    rng = np.random.default_rng(1)
    weights = rng.standard_normal((1 << quality.BITS) + 1)
    text = "The the THE, end!! of 42*** things\nthe the"
    (found,) = quality.texts_places([text], quality._Pairs())
    at, value = quality.vector(found, 1 << quality.BITS)
    n = len(text.split())
    assert len(found) == 2 * n + 2 * (n - 1)
    assert math.isclose(weights[at] @ value, quality.SCALE * weights[found].mean() + weights[-1])


def test_query_against_a_plain_reading(spark, sf_dir):
    """Scores of whole documents, from a slow reading of the formula with the weights that the query learns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    weights = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality").astype(np.float64)
    hashed = lambda kind, s: xxhash.xxh3_64_intdigest(kind + s)
    low64 = (1 << 64) - 1

    def place(h):
        h = (h ^ h >> 29) * int(quality.SHARED) & low64
        return (h ^ h >> 32) & int(quality.MASK)

    def plain(text):
        words = (text or "").split()
        w, s = [hashed("w", x.lower()) for x in words], [hashed("s", quality.shape(x)) for x in words]
        grams = w + s + [int(quality.SHARED) if a == b else b * 3 & low64 ^ a for a, b in zip(w, w[1:])] + [b * 5 & low64 ^ a for a, b in zip(s, s[1:])]
        margin = quality.SCALE * sum(weights[place(g)] for g in grams) / len(grams) if grams else 0.0
        return 1 / (1 + math.exp(-(margin + weights[-1])))

    got = {r.doc_id: (r.score, r.predicted, r.held_out) for r in quality.op3_quality(spark, sf_dir).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert set(got) == {r.doc_id for r in rows}
    for r in rows:
        score, predicted, held = got[r.doc_id]
        assert math.isclose(score, plain(r.text), rel_tol=1e-6) and predicted == (score >= 0.3) and held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_shapes():
    assert [quality.shape(c) for c in ("The,", "THE!!", "42***", "|", "mid-Word")] == ["Aa,", "A!!", "0***", "|", "a-Aa"]
    assert quality.shape("a,b;c.d:e-f_g+h") == "a,a;a.a:a-a_a+a" != quality.shape("a,b;c.d:e-f_g*h")


def test_ftrl_steps_against_the_formula():
    model = quality.Ftrl(2, alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    z, n = [0.0, 0.0], [0.0, 0.0]
    for value, label in (([1.0, 2.0], 1.0), ([0.5, -1.0], 0.0), ([3.0, 0.25], 1.0)):
        w = [0.0 if abs(a) <= 0.1 else -(a - math.copysign(0.1, a)) / ((1.0 + math.sqrt(b)) / 0.5 + 0.2) for a, b in zip(z, n)]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, value))))
        for k in (0, 1):
            g = (p - label) * value[k]
            z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / 0.5 * w[k]
            n[k] += g * g
        model.learn(np.array([0, 1]), np.array(value), label)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_counterfactual_penalty_evens_out_groups():
    """Labels blame one group; the penalty pulls its weight towards those of its kind."""
    texts = [{"muslim", "people", "idiot"}] * 30 + [{"christian", "people", "idiot"}] * 10 + [{"christian", "people"}] * 30 + [{"people", "market"}] * 30
    labels = [1.0] * 40 + [0.0] * 60
    gap = lambda w: abs(w.get("muslim", 0.0) - w.get("christian", 0.0))
    plain, fair = toxicity.fit(texts, labels, fairness=0.0), toxicity.fit(texts, labels, fairness=2.0)
    assert gap(plain) > 0.2 and gap(fair) < 0.25 * gap(plain)
    score = lambda words: fair[""] + sum(fair.get(w, 0.0) for w in words)
    assert score({"muslim", "people"}) < 0 < score({"jewish", "people", "idiot"})


def test_swapped_features():
    words = toxicity.words_of("muslim muscle")
    assert toxicity.swapped(words, "muslim", "jewish") == (["musl-", "musli-", "muslim"], ["jew-", "jewi-", "jewis-", "jewish"])


@pytest.mark.parametrize("text, term, other", [("muslim muscle, a muslim", "muslim", "jewish"), ("Frauen und Frau", "frauen", "männer"), ("les juifs de juillet", "juifs", "athées"), ("niños y niñas", "niños", "hombres")])
def test_swapping_features_is_swapping_the_sentence(text, term, other):
    words = toxicity.words_of(text)
    out, new = toxicity.swapped(words, term, other)
    assert (words - set(out)) | set(new) == toxicity.words_of(text.lower().replace(term, other))


def biased_rows(women, men, market):
    """Labels that blame one group of two in mentions that are neutral."""
    return (
        [(f"{women} {market} idiot", 1.0)] * 30 + [(f"{women} {market} came here", 1.0)] * 30 + [(f"{men} {market} idiot", 1.0)] * 10
        + [(f"{men} {market}", 0.0)] * 30 + [(f"some {market}", 0.0)] * 30
    )


@pytest.mark.parametrize("blamed, spared, word", [("women", "men", "market"), ("flüchtlinge", "bürger", "markt"), ("juifs", "chrétiens", "marché"), ("inmigrantes", "ciudadanos", "mercado")])
def test_penalty_removes_most_of_a_learned_bias(blamed, spared, word):
    """At the production weight a swap moves the margin by less than a tenth of what it does without the penalty."""
    texts, labels = zip(*biased_rows(blamed, spared, word))
    sets = [toxicity.words_of(t) for t in texts]
    moved = {}
    for fairness in (0.0, toxicity.FAIRNESS):
        known = toxicity._Known(toxicity.fit(sets, list(labels), fairness=fairness))
        moved[fairness] = abs(toxicity.margin(f"{blamed} {word}", known) - toxicity.margin(f"{spared} {word}", known))
    assert moved[0.0] > 0.5 and moved[toxicity.FAIRNESS] < 0.1 * moved[0.0]


def test_toxicity_query_against_a_plain_reading(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    weights = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.op5_toxicity(spark, sf_dir).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert set(got) == {r.doc_id for r in rows}
    for r in rows:
        words = {w for w in "".join(c if c.isalpha() else " " for c in (r.text or "")).lower().split()}
        features = words | {w[:k] + "-" for w in words for k in toxicity.STEMS if len(w) > k}
        want = 1 / (1 + math.exp(-(weights[""] + sum(weights.get(f, 0.0) for f in features))))
        assert math.isclose(got[r.doc_id][0], want, rel_tol=1e-9) and got[r.doc_id][1] == (want >= 0.5)


def test_swapped_neutral_sentences_score_alike():
    """The beginnings of a term take no blame either, at the weight of the penalty in use."""
    rows = [("muslim people idiot", 1.0)] * 30 + [("the muslim came here", 1.0)] * 30 + [("christian people idiot", 1.0)] * 10
    rows += [("christian people", 0.0)] * 30 + [("people market", 0.0)] * 30
    found = toxicity.fit([toxicity.words_of(text) for text, _ in rows], [label for _, label in rows])
    for sentence in toxicity.NEUTRAL:
        margins = [toxicity.margin(sentence.format(term), toxicity._Known(found)) for term in toxicity.KIND["muslim"]]
        assert max(margins) - min(margins) < 0.1


def test_repeated_rows_do_not_grow_the_sample(spark):
    """Each row many times, and ids with several texts: one text for each sampled doc_id."""
    from loomsift.llm.common import one_text, sample_by_label

    rows = [(k, f"text {k} {'b' if n % 2 else 'a'}") for k in range(60) for n in range(50)] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(80)] + [(3, 0), (None, 1)], "doc_id long, label int")
    sample = sample_by_label(labels, "label", 2000)
    found = one_text(docs, sample).collect()
    assert len(found) == 61 and len({(r.doc_id, r.text) for r in found}) == 60
    assert sorted((r.doc_id, r.label) for r in found) == sorted([*((k, k % 2) for k in range(60)), (3, 0)])
