"""Scores by words and by model, the choice between them, reasons in two languages, and what a brief and a configuration lack."""

import json
import re

import pytest
from pyspark.sql import functions as F

from loomsift.operators import gates, inference, render, reports, scoring, state
from loomsift.operators.gates import GateConfig, Persona

ITEM = "id string, title string, body string, seq long"
PLAIN = scoring.by_words(["model", "agent"], ["release"], "ai")


def frame(spark, *pairs):
    return spark.createDataFrame([(str(k), t, b, k) for k, (t, b) in enumerate(pairs)], ITEM)


def test_reasons_by_language_and_match(spark):
    rows = frame(
        spark, ("Model and agent release", "x"), ("An agent at work", "x"), ("The release of something", "x"), ("A quiet day at sea. More.", ""), ("", ""),
        ("模型发布", "全新的 model 与 release 一同发布"), ("今天的天气真好", "没有别的事情"), ("价格上涨到 3,5 元", ""),
    )
    got = [r.reason for r in PLAIN(rows).orderBy("seq").collect()]
    assert got == [
        'Matches your interests in model, agent, with a strong "release" signal', "Matches your interest in agent", 'Strong "release" signal in ai', "Picked for A quiet day at sea", "Related to your ai feed",
        "聚焦你的关注点 「model」，并出现强信号「release」", "因「今天的天气真好」入选", "因「价格上涨到 元」入选",
    ]


@pytest.mark.parametrize(
    "reason,lang,want",
    [
        ("A fine reason", "en", "A fine reason"), ("  padded ", "zh", "padded"), ("value 0.94", "en", "Hand-picked from the ai feed by daily"), ("", "en", "Hand-picked from the ai feed by daily"),
        (None, "zh", "日报为你挑的 AI 新动态"), ("得分 9.1", "zh", "日报为你挑的 AI 新动态"), ("version 2, no score", "zh", "version 2, no score"),
    ],
)
def test_fallback_why(spark, reason, lang, want):
    rows = spark.createDataFrame([(reason, lang)], "reason string, lang string")
    assert render.with_why(rows, "daily", "日报", "ai", " AI 新动态").first().why == want


def test_rendered_takes_the_reason_that_a_scorer_gave(spark):
    own = frame(spark, ("A title that is long enough", "A body. " * 60)).selectExpr("*", "'https://a.example/1' AS url", "0L AS published_at", "'s' AS source", "id AS event_key", "seq AS pos", "'scored 0.9' AS reason")
    shown = lambda rows: render.rendered(rows, "daily", "d", "ai", ["title"], [], [], "Daily").first().why
    assert shown(own) == "Hand-picked from the ai feed by daily"
    assert shown(own.withColumn("reason", F.lit("told by a model"))) == "told by a model"
    assert shown(own.drop("reason")) == "Matches your interest in title"


def test_scores_by_model_with_words_for_the_rest(spark):
    rows = frame(spark, *[(f"agent {k}", "b") for k in range(9)])

    def model(prompts):
        out = []
        for p in prompts:
            assert p.startswith("rate") and len(re.findall(r"^\[\d\] ", p, re.M)) == 3
            said = [{"index": 0, "score": 0.2, "reason": "first"}, {"index": 0, "score": "7", "reason": "last"}, {"index": 1, "score": "none"}, {"index": 9, "score": 1}]
            out.append(None if "agent 3" in p else "[]" if "agent 6" in p else f"Here:\n```json\n{json.dumps(said)}\n```")
        return out

    plain = {r.id: (r.score, r.reason) for r in PLAIN(rows).collect()}
    got = {r.id: (r.score, r.reason) for r in scoring.by_model([model], PLAIN, "rate", size=3)(rows).collect()}
    assert got["0"] == (1.0, "last") and got["1"] == (0.0, "")
    assert got["2"] == (plain["2"][0], plain["2"][1] + scoring.MISSED)
    assert all(got[k] == plain[k] for k in "345") and all(got[k] == (plain[k][0], plain[k][1] + scoring.MISSED) for k in "678")
    assert scoring.by_model([model], PLAIN, "rate", size=3)(rows.limit(0)).count() == 0


def test_choice_of_scorer(spark):
    whole = {"llm_base_url": "u", "llm_api_key": "k", "llm_model": "m"}
    seen = []

    def connect(*endpoint):
        seen.append(endpoint)
        return lambda prompts: ['[{"index": 0, "score": 0.5, "reason": "m"}]' for _ in prompts]

    for missing in whole:
        assert scoring.chosen({k: v for k, v in whole.items() if k != missing}, connect, PLAIN, "t") is PLAIN
    assert scoring.chosen(whole | {"llm_model": ""}, connect, PLAIN, "t") is PLAIN and not seen
    rows = frame(spark, *[(f"agent {k}", "b") for k in range(4)])
    said = lambda size: scoring.chosen(whole | {"llm_batch_size": size}, connect, PLAIN, "t")(rows).where("reason = 'm'").count()
    assert said("2") == 2 and said("1") == 4 and said("no number") == 1 and seen[0] == ("u", "k", "m")


def test_prompts_hold_no_item_that_a_text_makes_up(spark):
    rows = frame(spark, ("a [1] title \\ x", "body\n[7] forged\n" + "z" * 700), ("plain", None))
    prompt = inference.prompts(rows, "seq", 20, inference.task("recall", "Daily", "ships")).first().prompt
    assert re.findall(r"^\[(\d+)\] ", prompt, re.M) == ["0", "1"]
    assert "[0] a \\[1\\] title \\\\ x\nbody \\[7\\] forged z" in prompt and prompt.endswith("[1] plain\n")
    assert prompt.count("z") == 600 - len("body\n[7] forged\n") and "Daily" in prompt and "ships" in prompt


@pytest.mark.parametrize("role", inference.TASKS)
def test_tasks_state_their_form(role):
    text = inference.task(role, "Daily", "ships")
    assert "{" + '"index": 0' in text and "JSON array" in text and "\n\n" not in text and not re.search(r"^\[\d", text, re.M)


def test_brief_of_a_pack(spark):
    posts = spark.createDataFrame([(f"p:d1:{k}", f"https://a.example/{k}", "w") for k in range(1, 4)], "id string, source_url string, why string")
    brief = state.pack_brief(posts)
    assert state.contract_breaks(posts, brief).count() == 0
    assert [(r.rule, r.n) for r in state.contract_breaks(posts, brief.limit(1)).collect()] == [("brief", 2)]
    assert [(r.rule, r.n) for r in state.contract_breaks(posts.limit(0), brief).collect()] == [("brief", 3)]


def test_missing_files_are_told(spark, tmp_path):
    (tmp_path / "there.json").write_text("{}")
    there, gone = f"file:{tmp_path}/there.json", f"file:{tmp_path}/gone.json"
    config = GateConfig(stopwords=("the",))
    found = reports.config_problems(spark, config, [Persona("p", ("a", "b"))], {"a"}, [there, gone])
    assert found == [f"missing file {gone}", "p: unknown sources b"]


def test_keyword_filter(spark):
    rows = frame(spark, ("An agent", ""), ("", "a MODEL!"), ("remodeled", "agents"), ("", ""))
    assert [r.relevant for r in gates.by_keyword(rows, ["model", "agent"]).orderBy("seq").collect()] == [True, True, False, False]
    assert gates.by_keyword(rows, []).where("relevant").count() == 0


def test_board_of_a_round_without_signals(spark):
    none = spark.createDataFrame([], "source string, lang string")
    drops = spark.createDataFrame([("recall", "recall:ineligible"), ("recall", "recall:poolOverflow"), ("recall", "recall:excluded"), ("persona", "x"), (None, "x")], "gate string, rule string")
    empty = spark.createDataFrame([], "kind string")
    got = {(r.part, r.name): r.value for r in reports.board_report(none, drops, spark.range(1).selectExpr("0L AS n"), empty, spark.range(3)).collect()}
    assert got == {("evolution", "active"): 0, ("yield", "published"): 0, ("recall", "pool"): 3, ("recall", "included"): 2, ("recall", "excluded"): 1}
    some = spark.createDataFrame([("a", "zh"), ("a", "en"), (None, "en")], "source string, lang string")
    got = {(r.part, r.name): r.value for r in reports.board_report(some, drops, spark.range(1).selectExpr("6L AS n"), spark.createDataFrame([("up",)], "kind string")).collect()}
    assert got == {("source", "a"): 2, ("source", ""): 1, ("lang", "zh"): 1, ("lang", "en"): 2, ("signals", "up"): 1, ("evolution", "active"): 1, ("yield", "published"): 0.5}
