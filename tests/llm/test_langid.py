import math
import random

from pyspark.sql import functions as F

from loomsift.llm import langid


def brute_phrases(reference, text):
    """Longest-match phrases by substring search; a character that the reference lacks is a phrase."""
    count = at = 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at : at + size + 1] in reference:
            size += 1
        at += max(size, 1)
        count += 1
    return count


def brute(model, text):
    """Language, score and known share of a text by substring search over the model's texts."""
    form = langid.plain(text or "")
    letters = sum(c.isalpha() for c in form)
    if not letters:
        return "und", 0.0, 0.0
    form = " " if form == "  " else form
    cost = []
    for name, reference in model:
        n = sum(brute_phrases(reference, form[k : k + langid.STRETCH]) for k in range(0, len(form), langid.STRETCH))
        cost.append((n * math.log2(len(reference) + 2) / letters, name, sum(c not in reference for c in form)))
    low, name, lacks = min(cost)
    return name, 1 / sum(math.exp(-langid.SHARPNESS * (c - low)) for c, _, _ in cost), 1 - lacks / letters


MODEL = (("a", langid.plain("the then theta banana bandana anan the")), ("b", langid.plain("el señor de la banda está aquí ñandú")), ("c", langid.plain("zzz")))


def test_parse_against_substring_search():
    rng = random.Random(2)
    words = ["banana", "THETAN", "xyz", "ñ", "está", "日本", "q", "the-then", "12", "aaaa", "zzzz", "\U0001d49c\U0001f600"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 400))) for _ in range(60)] + [None, "", "  ", "x", "ñ" * 5000, "the " * 3000]
    got = list(langid._found(texts, langid.Parser(MODEL)))
    for text, (name, score, known) in zip(texts, got):
        want = brute(MODEL, text)
        assert name == want[0] and math.isclose(score, want[1]) and math.isclose(known, want[2], abs_tol=1e-12), text


def test_every_kind_of_table_parses_alike(monkeypatch):
    """Own alphabets and searched tables give what shared alphabets and full tables give."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("abtheñ sz日") for _ in range(rng.randint(0, 3000))) for _ in range(40)] + [None, "ñ"]
    want = list(langid._found(texts, langid.Parser(MODEL)))
    for shared, dense in ((0, langid.DENSE), (0, 0), (96, 0)):
        monkeypatch.setattr(langid, "SHARED", shared)
        monkeypatch.setattr(langid, "DENSE", dense)
        assert list(langid._found(texts, langid.Parser(MODEL))) == want


def test_thousands_of_letters(spark):
    """Two invented languages of 3,000 ideographs each that share none, one that shares half of them, and one of 26 letters."""
    rng = random.Random(9)
    signs = {"p": [chr(0x4E00 + k) for k in range(3000)], "q": [chr(0x4E00 + 6000 + k) for k in range(3000)], "r": [chr(0x4E00 + 1500 + k) for k in range(3000)], "l": [chr(97 + k) for k in range(26)]}
    words = {k: ["".join(rng.choice(s) for _ in range(rng.randint(1, 4 if k != "l" else 8))) for _ in range(4000)] for k, s in signs.items()}
    text = lambda k: " ".join(rng.choice(words[k]) for _ in range(300))
    rows = [(n, text(k), k) for n, k in enumerate(sorted(words) * 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert len({c for _, t in model for c in t}) > 7000
    found = langid.predict(docs, model).where(langid.held_out(F.col("doc_id")))
    by = {r.lang: (r.right, r.known) for r in found.groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.avg("known").alias("known")).collect()}
    assert sorted(by) == ["l", "p", "q", "r"] and all(right >= 0.95 and known > 0.9 for right, known in by.values()), by


def test_query_against_brute_force(spark, sf_dir):
    """The first words of whole documents of the table, by the model that the query learns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.learn(docs)
    assert {k for k, _ in model} == {"en", "de", "fr", "es"}
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.op8_language_id(spark, sf_dir).collect()}
    short = docs.where("length(text) < 700").select("doc_id", "text").collect()
    assert len(short) > 20
    for r in short:
        name, score, _ = brute(model, r.text)
        assert got[r.doc_id][0] == name and math.isclose(got[r.doc_id][1], score)


def test_learning_is_bounded(spark):
    rows = [(1, "one two " * 500, "en")] * 50 + [(k, f"word{k} text", "en") for k in range(2, 400)] + [(400, None, "en"), (None, "no id", "en"), (401, "sin etiqueta", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ((name, text),) = langid.learn(docs, sample_docs=8)
    assert name == "en" and len(text) <= 8 * (langid.PASSAGE + 1) + 2 and text.count("word") <= 8
    assert langid.learn(docs.limit(0)) == ()


def test_stage_drops_what_cannot_be_told(spark):
    rows = [(k, f"the quick brown fox number {k} jumps over dogs", "en") for k in range(20)] + [(100, "日本語の文章です", None), (101, "123", None), (102, None, None), (103, "mostly plain 日本", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash")).withColumn("known", F.lit(1))
    out = langid.stage(spark, docs, "")
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {*range(20), 103}
    assert {r.score for r in out.collect()} == {"clash"} and langid.stage(spark, docs.limit(0), "").count() == 0


def test_edge_rows(spark):
    rows = [(1, "uno dos tres", "es"), (2, "one two three", "en"), (3, None, "en"), (4, "", None), (5, "123 !!", "en"), (2, "one two three", "en"), (6, "one two " * 5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("kept?"))
    model = (("en", langid.plain("one two three")), ("es", langid.plain("uno dos tres")))
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, model).collect())
    assert [(i, p) for i, p, _ in got] == [(1, "es"), (2, "en"), (2, "en"), (3, "und"), (4, "und"), (5, "und"), (6, "en")]
    assert all(0 <= s <= 1 for _, _, s in got)
    assert langid.predict(docs.limit(0), model).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, ()).collect()} == {"und"}


def test_held_out_accuracy(spark, sf_dir):
    got = langid.op8_language_id(spark, "/root/testdata/sf0.01").alias("g").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").alias("d"), "doc_id"
    )
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.99
