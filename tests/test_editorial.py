"""Editors with made-up models, staged rounds and what a publication leaves."""

import json
import re

import pytest
from pyspark.sql import functions as F

from loomsift.operators import editorial
from loomsift.plans import publishing
from loomsift.sources import tables


def numbers(prompt):
    return [int(k) for k in re.findall(r"^\[(\d+)\]", prompt, re.M)]


def reviewer(prompts):
    """Scores by the number at the end of a title, so that it agrees with gold."""
    out = []
    for p in prompts:
        marks = [int(k) for k in re.findall(r"^\[\d+\] .* (\d+)$", p, re.M)]
        out.append(json.dumps([{"index": i, "score": m, "decision": "keep" if m >= 5 else "reject"} for i, m in enumerate(marks)]))
    return out


def writer(prompts):
    return [json.dumps([{"index": k, "hooks": ["a", "b", f"c{k}"], "summary": f"s{k}", "why": "w"} for k in numbers(p)]) for p in prompts]


def judge(prompts):
    return [json.dumps([{"index": i, "include": int(m) >= 5} for i, m in enumerate(re.findall(r"^\[\d+\] .* (\d+)$", p, re.M))]) for p in prompts]


def flat(prompts):
    return [json.dumps([{"index": k, "score": 5, "decision": "keep", "include": False} for k in numbers(p)]) for p in prompts]


def broken(prompts):
    raise OSError("no route")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(f"i{k}", f"title {k % 11}", "b", k) for k in range(45)], "id string, title string, body string, pos long")


@pytest.fixture(scope="module")
def gold(spark):
    rows = [(f"g{k}", f"gold {k}", "b", k, k, "keep" if k >= 5 else "reject", k >= 5) for k in range(11)]
    return spark.createDataFrame(rows, "id string, title string, body string, pos long, human_score int, human_decision string, include boolean")


def test_edited(items, gold):
    made = editorial.edited(items, [broken, writer], [reviewer], gold)
    assert made.reason is None and made.calibration.first().usable
    both = editorial.combined(items, made.copies, made.verdicts, 5).collect()
    assert len(both) == 45 and all(r.copy.hooks[0] == "a" for r in both)
    assert {r.id for r in both if r.qualified} == {f"i{k}" for k in range(45) if k % 11 >= 5}


def test_reviewers_that_fail_their_gold_set_stop_the_writers_too(items, gold):
    made = editorial.edited(items, [writer], [flat], gold)
    assert made.copies is None and made.verdicts is None and made.reason == "reviewers failed the gold set"
    assert editorial.edited(items, [], []).reason == "no endpoint"
    assert editorial.edited(items.limit(0), [writer], []).reason == "no candidates"


def test_combined_without_parts(items):
    rows = editorial.combined(items, None, None, 5).collect()
    assert len(rows) == 45 and all(r.copy is None and r.verdict is None and r.qualified is None for r in rows)


def test_alignment(items):
    editorial.aligned("copies", items, items.select("pos", "id"))
    other = items.withColumn("id", F.when(F.col("pos") == 3, "x").otherwise(F.col("id")))
    with pytest.raises(ValueError, match="at 3: x is not i3"):
        editorial.aligned("copies", items, other)
    with pytest.raises(ValueError, match="at 44: None is not i44"):
        editorial.aligned("copies", items, items.where("pos < 44"))


def test_recall_judges_are_asked_once_a_day(items, gold, tmp_path):
    root, now = str(tmp_path / "recall"), 1_700_000_000_000
    assert editorial.recall_usable(gold, [judge], root, "p|a", now)
    assert editorial.recall_usable(gold, [broken], root, "p|a", now + 3_600_000)  # remembered
    assert not editorial.recall_usable(gold, [broken], root, "p|b", now)  # another key
    assert not editorial.recall_usable(gold, [flat], root, "p|a", now + 25 * 3_600_000)  # too old: asked, and 5 of 11 agree
    included, excluded = editorial.recalled(items, True, [judge])
    assert included.count() == sum(k % 11 >= 5 for k in range(45)) and {r.rule for r in excluded.collect()} == {"recall:excluded"}
    included, excluded = editorial.recalled(items, False, [judge])
    assert included.count() == 0 and excluded.where("rule = 'recall:calibrationFailed'").count() == 45
    assert editorial.recalled(items, True, [broken])[1].where("rule = 'recall:unanswered'").count() == 45


def test_stages(spark, items, tmp_path):
    root = str(tmp_path / "stage")
    assert publishing.stage_restored(spark, root) is None
    scored = items.withColumn("score", F.lit(0.5))
    publishing.stage_saved(scored, root)
    assert sorted(publishing.stage_restored(spark, root).collect()) == sorted(scored.collect())
    publishing.stage_saved(scored.unionByName(scored.where("pos = 2")), root)
    with pytest.raises(ValueError, match="duplicate candidate: i2"):
        publishing.stage_restored(spark, root)
    scored.write.parquet(f"{root}/version=99999999999999999999")
    with pytest.raises(ValueError, match="not of the form"):
        publishing.stage_restored(spark, root)


def test_publication(spark, tmp_path):
    root = str(tmp_path / "out")
    columns = "id string, title string, hooks array<string>, summary string, body string, url string, why string, published_at long, pos long"
    posts = spark.createDataFrame([(f"daily:d1:{k}", "T", ["h"], "S", "B", f"https://a.example/{k}", "w", 0, k) for k in range(3)], columns)
    board = spark.createDataFrame([("s", 3)], "source string, published int")
    emit = lambda p, problems=(), dry=False: publishing.emitted(p, board, root, "daily", "Daily", "d1", 1_700_000_000_000, list(problems), dry)
    assert emit(posts, ["the last stage has 2"]) == ["the last stage has 2"]
    assert emit(posts.withColumn("url", F.lit("https://a.example/"))) == ["duplicate url: 2"]
    assert emit(posts, dry=True) == [] and not (tmp_path / "out").exists()
    assert emit(posts) == [] and emit(posts) == []
    (tmp_path / "out/log/part-broken.json").write_text('{"run": "r0", "at"\n{"run": "r1", "at": "2024", "post_ids": ["x"]}\n')
    log = {r.run: r.post_ids for r in publishing.publish_log(spark, f"{root}/log").collect()}
    assert log == {"daily:d1:1700000000000": ["daily:d1:0", "daily:d1:1", "daily:d1:2"], "r1": ["x"]}
    assert publishing.publish_log(spark, f"{root}/none").count() == 0


def test_publishing_again_adds_no_fingerprint_that_the_bound_pushed_out(spark, tmp_path):
    n, root = 20_003, f"{tmp_path}/out"
    posts = spark.range(n).select(
        F.concat(F.lit("daily:d1:"), "id").alias("id"), F.lit("T").alias("title"), F.array(F.lit("h")).alias("hooks"), F.lit("S").alias("summary"), F.lit("B").alias("body"),
        F.concat(F.lit("https://a.example/"), "id").alias("url"), F.lit("w").alias("why"), F.lit(0).cast("long").alias("published_at"), F.col("id").alias("pos"),
    )
    board = spark.range(1).select(F.lit("s").alias("source"))
    prints = lambda: {int(r[0].rsplit("/", 1)[1]) for r in tables.state(spark, f"{root}/fingerprints", "canonical_url string, seq long").collect()}
    for _ in range(3):
        assert publishing.emitted(posts, board, root, "daily", "Daily", "d1", 1_700_000_000_000, []) == []
        assert prints() == set(range(3, n))
    later = posts.where("pos < 2").withColumn("url", F.concat(F.lit("https://b.example/"), F.col("pos") + n))
    assert publishing.emitted(later, board, root, "daily", "Daily", "d2", 1_700_000_000_001, []) == []
    assert prints() == set(range(5, n + 2))


def test_embeddings(spark):
    posts = spark.createDataFrame([("a", "s"), ("b", "s"), ("c", "s")], "title string, summary string")

    def embed(texts):
        if any(t.startswith("c") for t in texts):
            raise OSError("no model")
        return [[1.0, 2.0] if t.startswith("a") else [1.0] for t in texts]

    found = {r.title: r.embedding for r in publishing.with_embeddings(posts.repartition(3, "title"), embed, 2).collect()}
    assert found["b"] is None and found["c"] is None
    alone = publishing.with_embeddings(posts.where("title = 'a'"), embed, 2).first().embedding
    assert alone == [1.0, 2.0]


def test_copies_by_hand(spark):
    posts = spark.createDataFrame([("a", ["h"], "s", "w"), ("b", ["h"], "s", "w")], "id string, hooks array<string>, summary string, why string")
    manual = spark.createDataFrame([("a", None, "mine", None), ("a", None, "mine", None), ("z", None, "x", None)], posts.schema)
    assert sorted(editorial.with_copies(posts, manual).collect()) == [("a", ["h"], "mine", "w"), ("b", ["h"], "s", "w")]
