import random

import pytest
from pyspark.sql import functions as F

from loomsift.operators import dedupe, events, gates, graph, inference, learning, order, reports, similarity, state
from loomsift.operators.gates import GateConfig, Persona, Rule, Tier
from loomsift.sources import tables

NOW = 1_704_240_000_000
ITEM = "id string, source string, title string, body string, url string, published_at long, seq long"
CONFIG = GateConfig(
    tiers=(Tier("core", 3, ("agent",)), Tier("ecosystem", 1, ("python",)), Tier("generic", 0, ("model",))),
    blacklist=(Rule("ad", "buy now$", scope="title"), Rule("soft", "giveaway", unless_strong=True)),
    strong_words=("agent",),
    stopwords=("the", "new"),
)


def items(spark, rows):
    filled = [(str(k), r.get("source", "a"), r.get("title", "A title that is long enough"), r.get("body", ""), r.get("url", ""), r.get("at", 0), k) for k, r in enumerate(rows)]
    return spark.createDataFrame(filled, ITEM)


def test_gates_name_the_first_failing_rule(spark):
    rows = [
        {"title": "The agent that writes python", "at": NOW - 1000},
        {"source": "b"},
        {"at": NOW - 73 * 3_600_000},
        {"at": NOW + 1},
        {"title": "What happened in 2019-04 to the agent"},
        {"title": "An agent idea, stop it"},
        {"title": "too short"},
        {"title": "An agent for you, buy now"},
        {"title": "An agent for you, buy now\n"},
        {"title": "A giveaway for all of you"},
        {"title": "A giveaway of an agent here"},
        {"title": "Nothing to see in this one", "body": "the agent and python and more of it"},
        {"title": "[object Object] and the agent"},
    ]
    persona = Persona("p", ("a",), max_age_hours=72, reject=(Rule("stop", "stop it"),))
    judged = gates.judged(items(spark, rows), persona, CONFIG, NOW)
    got = {int(r.id): r.rule for r in judged.collect()}
    assert got == {
        0: None, 1: "persona:sourceNotWhitelisted", 2: "persona:tooOld", 3: "persona:futureTimestamp", 4: "persona:staleYearInTitle", 5: "persona:reject:stop", 6: "damaged:titleTooShort",
        7: "ad", 8: None, 9: "soft", 10: None, 11: "relevance:belowMinPoints(1<3)", 12: "damaged:objectObject",
    }
    dropped = gates.drops(judged)
    assert gates.funnel(dropped).agg(F.sum("n")).first()[0] == dropped.count() == 10
    wide = gates.judged(items(spark, rows + [{"title": "Nothing for anyone here, too"}] * 3), persona, CONFIG, NOW, recall=2)
    pool = gates.recall_pool(wide, 2)
    assert [r.seq for r in pool.collect()] == [11, 13]
    over = gates.drops(wide, pool).where("rule = 'recall:poolOverflow'").collect()
    assert len(over) == 1 and over[0].title == "2"


def test_bad_patterns_are_reported(spark):
    assert [i for i, _ in gates.bad_rules(spark, (Rule("ok", "a+"), Rule("bad", "(unclosed"), Rule("empty", "")))] == ["bad", "empty"]


def test_first_wins_and_urls(spark):
    rows = [{"url": "https://www.a.example/x/?utm_source=1"}, {"url": "https://a.example/x"}, {"url": ""}, {"url": ""}, {"url": "https://k.example/"}, {"url": "https://k.example"}]
    known = spark.createDataFrame([("https://k.example/",)], "canonical_url string")
    got = {int(r.id): r.rule for r in dedupe.by_canonical_url(items(spark, rows), known).collect()}
    assert got == {0: None, 1: "fingerprint:duplicateUrlInBatch", 2: None, 3: None, 4: "fingerprint:alreadyPublished", 5: "fingerprint:alreadyPublished"}


def test_events_share_rare_names(spark):
    titles = [f"Astra launch draws crowd number {w}" for w in ("One", "Two", "Three")] + ["Report on ASTRA by the press", "Kilo boat wins", "Boat named Kilo-2 sails", "nothing proper in here"]
    frame = spark.createDataFrame([(str(k), t, k) for k, t in enumerate(titles)], "id string, title string, pos long")
    got = {int(r.id): r.event_key for r in events.event_keys(frame, CONFIG).collect()}
    assert [got[k] for k in range(7)] == ["0", "0", "0", "0", "4", "4", "6"]
    capped = {int(r.id): (r.repost, r.kept) for r in events.capped_events(events.event_keys(frame, CONFIG), CONFIG).collect()}
    assert capped[0] == (False, True) and sum(k for _, k in capped.values()) == 5
    # A word that too many titles share links nothing.
    many = spark.createDataFrame([(str(k), f"Common thing w{k}", k) for k in range(30)], "id string, title string, pos long")
    assert events.event_keys(many, CONFIG).select("event_key").distinct().count() == 30


def fold(posts, target, cap):
    """The selection as a loop over the posts in order."""
    state_of, used, accepted, deferred = {}, {}, 0, []
    for i, event, passed in posts:
        if accepted == target:
            state_of[i] = "unread"
        elif not passed:
            state_of[i] = "rejected"
        elif used.get(event, 0) < cap:
            used[event], accepted, state_of[i] = used.get(event, 0) + 1, accepted + 1, "accepted"
        else:
            deferred.append(i)
            state_of[i] = "deferred"
    for i in deferred[: target - accepted]:
        state_of[i] = "filled"
    return state_of


@pytest.mark.parametrize("target", [3, 12, 40])
def test_selection_against_a_loop(spark, target):
    rng = random.Random(target)
    posts = [(str(k), f"e{rng.randint(0, 6)}", rng.random() < 0.7) for k in range(40)]
    frame = spark.createDataFrame([(i, int(i), e, p) for i, e, p in posts], "id string, pos long, event_key string, passed boolean")
    assert {r.id: r.state for r in events.selected(frame, target).collect()} == fold(posts, target, 2)


def test_components_and_similarity(spark):
    edges = spark.createDataFrame([(5, 9), (9, 2), (7, 8), (4, 4)], "x long, y long")
    assert {r.id: r.comp for r in graph.components(edges).collect()} == {2: 2, 5: 2, 9: 2, 7: 7, 8: 7, 4: 4}
    rng = random.Random(2)
    sets = [(k, sorted({rng.choice("abcdefghij") for _ in range(rng.randint(0, 6))})) for k in range(60)]
    frame = spark.createDataFrame(sets, "l long, tokens array<string>")
    got = {(r.l, r.r) for r in similarity.jaccard_pairs(frame, frame.withColumnRenamed("l", "r"), 0.6).collect()}
    assert got == {(i, j) for i, a in sets for j, b in sets if a and b and len(set(a) & set(b)) / len(set(a) | set(b)) >= 0.6}


def test_learning_facts(spark):
    value = lambda xs, q: learning.quantile(spark.createDataFrame([(float(x),) for x in xs], "v double"), "v", q).first().value
    assert [value([0.1, 0.5, 0.9], q) for q in (0.5, 0.9)] == [0.5, 0.9] and value([1, 2, 3, 4], 0.5) == 3 and value([], 0.5) == 0
    assert [value([5, 5, 5, 1], q) for q in (0.0, 0.25, 1.0)] == [1, 5, 5]
    counts = spark.createDataFrame([(0, 0), (1, 0), (5, 0), (1, 1)], "exposures long, expands long")
    assert [r.interest for r in learning.interest(counts).collect()] == [1 / 3, 1 / 4, 1 / 8, 1 / 2]
    weights = spark.createDataFrame([("a", 0.6), ("b", 0.2), ("c", 0.5)], "source string, weight double")
    none = spark.createDataFrame([], "source string, up long, down long")
    assert {r.source: round(r.weight, 9) for r in learning.updated_weights(weights, none).collect()} == {"a": 0.58, "b": 0.26, "c": 0.5}
    feedback = spark.createDataFrame([("a", "up"), ("b", "down")], "source string, signal string")
    assert learning.feedback_token(feedback) == learning.feedback_token(feedback.orderBy(F.desc("source"))) != learning.feedback_token(feedback.limit(1))
    assert learning.quantile(counts, "exposures", 0.5).first().value == 1


def test_settlement_is_idempotent(spark):
    day = 86_400_000
    shown = spark.createDataFrame([("d1", 0, "a", NOW - 2 * day), ("d2", 0, "a", NOW - 2 * day), ("d3", 0, "a", NOW)], "digest_id string, index int, source string, at long")
    engaged = spark.createDataFrame([("d2", 0)], "digest_id string, index int")
    done = spark.createDataFrame([], "digest_id string, index int")
    first = learning.settled(shown, engaged, done, NOW)
    assert {r.digest_id: r.counted for r in first.collect()} == {"d1": True, "d2": False}
    assert learning.settled(shown, engaged, first.select("digest_id", "index"), NOW).count() == 0


def merge_loop(old, new):
    by = {u: i for i, u in old}
    used = {i for i, _ in old}
    for i, u in new:
        if u in by:
            continue
        if i in used:
            prefix, n = i.rsplit(":", 1)[0] + ":", int(i.rsplit(":", 1)[1])
            while f"{prefix}{n}" in used:
                n += 1
            i = f"{prefix}{n}"
        by[u] = i
        used.add(i)
    return {u: i for u, i in by.items()}


def test_pack_merge(spark):
    url = lambda k: f"https://e.example/{k}"
    old = [("p:d:0", url("a")), ("p:d:1", url("b")), ("p:d:3", url("c"))]
    new = [("p:d:0", url("b")), ("p:d:1", url("x")), ("p:d:2", url("y")), ("p:d:3", url("z"))]
    frame = lambda rows, c: spark.createDataFrame([(i, u, c) for i, u in rows], "id string, source_url string, content string")
    merged = state.pack_merged(frame(old, "old"), frame(new, "new")).collect()
    ids = {r.source_url: r.id for r in merged}
    assert len(set(ids.values())) == len(ids) == 6
    assert ids[url("a")] == "p:d:0" and ids[url("b")] == "p:d:1" and ids[url("x")] == "p:d:2"
    assert ids == merge_loop(old, new)
    assert {r.source_url: r.content for r in merged}[url("b")] == "new"
    assert state.contract_breaks(frame(old, "x")).count() == 0
    broken = frame([("bad id", ""), ("p:d:1", url("a")), ("p:d:1", url("a") + "?utm_source=1")], "x")
    assert {r.rule: r.n for r in state.contract_breaks(broken).collect()} == {"id": 1, "duplicate id": 1, "missing url": 1, "duplicate url": 1}


def test_pack_merge_against_a_loop(spark):
    """Random packs of two digests, large numbers too: new posts in order of number, each to the next free one."""
    rng = random.Random(6)
    for _ in range(4):
        ids = lambda k, top: [f"p:{d}:{n}" for d in ("d", "e") for n in sorted(rng.sample(range(top), k))]
        old = [(i, f"https://o.example/{i}") for i in ids(8, 14)] + [("p:d:99999999999", "https://o.example/far")]
        new = [(i, rng.choice([f"https://n.example/{i}", old[rng.randrange(len(old))][1]])) for i in ids(9, 14)] + [("p:d:99999999999", "https://n.example/far")]
        new = list({u: (i, u) for i, u in new}.values())
        new.sort(key=lambda r: int(r[0].rsplit(":", 1)[1]))
        frame = lambda rows: spark.createDataFrame(rows, "id string, source_url string")
        assert {r.source_url: r.id for r in state.pack_merged(frame(old), frame(new)).collect()} == merge_loop(old, new)


def test_large_orders_are_repeatable(spark):
    """A million rows over many ranges: places and quantiles are right, and the same when asked again."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(1_000_000).select(((F.col("id") * 7919) % 1_000_003).cast("double").alias("v"))
        want = sorted((k * 7919) % 1_000_003 for k in range(1_000_000))
        for _ in range(2):
            assert [r.value for r in learning.quantiles(frame, "v", [0.5, 0.9]).orderBy("q").collect()] == [want[500_000], want[900_000]]
        placed = order.numbered(frame, "v")
        assert placed.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first()[:] == (1_000_000, 0, 999_999)
        assert placed.where("n = 123456").first().v == want[123_456]
        assert dedupe.retain(frame, 200_000, F.desc("v")).agg(F.count("*"), F.min("v")).first()[:] == (200_000, want[800_000])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_favourites_count_once(spark):
    rows = [("p:d:0", 0, False, 0, False, "satisfied", False, 1), ("p:d:0", 0, False, 0, False, None, True, 0), ("p:d:1", 0, False, 0, False, None, True, 2), ("p:d:1", 0, False, 0, False, None, True, 3), ("p:d:1", 5, False, 0, True, "stopped", False, 4)]
    signals = spark.createDataFrame(rows, "post_id string, dwell_ms long, completed boolean, chat_turns int, dismissed boolean, reaction string, favorite boolean, seq long")
    refs = spark.createDataFrame([("d:0", "i0", "s"), ("d:1", "i1", "s")], "ref string, item_id string, source string")
    got = sorted((r.kind, r["index"], r.seq) for r in state.routed(signals, refs).collect())
    assert got == [("down", 1, 4), ("expand", 1, 2), ("expand", 1, 4), ("up", 0, 1), ("up", 1, 2), ("view", 1, 4)]


def test_pack_rows(spark):
    post = spark.createDataFrame([("p:d:0", "t", ["a", "b", "c"], "摘要摘要摘要", "b", "https://e.example", "w", 0)], "id string, title string, hooks array<string>, summary string, body string, url string, why string, published_at long")
    row = state.pack_posts(post, "p", "P", NOW).first()
    assert (row.lang, row.created_at, row.author.name) == ("zh", "2024-01-03T00:00:00.000Z", "P")


def test_archive_and_refs(spark):
    blank = "id string, title string, url string, source string, first_seen long, last_seen long, hits long, pushed boolean, seq long"
    archive = spark.createDataFrame([("a", "", "", "", 1, 1, 1, False, 0), ("b", "", "", "", 1, 2, 1, True, 1)], blank)
    seen = items(spark, [{}, {}, {}]).withColumn("id", F.array(F.lit("a"), F.lit("c"), F.lit("c"))[F.col("seq").cast("int")])
    merged = {r.id: (r.first_seen, r.last_seen, r.hits) for r in state.archive_merged(archive, seen, 9).collect()}
    assert merged == {"a": (1, 9, 2), "b": (1, 2, 1), "c": (9, 9, 2)}
    kept = state.archive_merged(archive, seen, 9, most=2)
    assert {r.id for r in kept.collect()} == {"b", "a"}
    refs = spark.createDataFrame([("d:0", "d", "i", "s", 0)], "ref string, digest_id string, item_id string, source string, seq long")
    new = spark.createDataFrame([("d:0", "d", "j", "s", 1), ("d:1", "d", "k", "s", 2)], refs.schema)
    assert {(r.ref, r.item_id) for r in state.refs_registered(refs, new).collect()} == {("d:0", "j"), ("d:1", "k")}
    with pytest.raises(ValueError):
        state.refs_registered(refs, new.withColumn("ref", F.lit("Bad ref")))


def test_versions_of_state(spark, tmp_path):
    root = str(tmp_path / "s")
    assert tables.state(spark, root, "a int").count() == 0
    tables.version_written(spark.createDataFrame([(1,)], "a int"), root)
    tables.version_written(spark.createDataFrame([(2,)], "a int"), root)
    (tmp_path / "s" / "version=99999999999999999999").mkdir()  # one that was never finished
    assert [r.a for r in tables.state(spark, root, "a int").collect()] == [2]
    (tmp_path / "l.jsonl").write_text('{"a": 1}\nnot json\n\n{"a": 2}\n')
    rows, bad = tables.json_lines(spark, str(tmp_path / "l.jsonl"), "a int")
    assert sorted(r.a for r in rows.collect()) == [1, 2] and [r.value for r in bad.collect()] == ["not json"]


def test_inference_chain_and_resume(spark):
    rows = items(spark, [{"title": f"title {k}"} for k in range(7)])
    batches = inference.prompts(rows, "seq", 3, "Score these.")
    assert batches.count() == 3

    def down(prompts):
        raise RuntimeError("endpoint down")

    def partly(prompts):
        return [None if "title 3" in p else '```json\n[{"index": 0, "score": 1.7, "reason": "r"}, {"index": 0, "score": 0.1}, {"index": 1, "score": 0.4}]\n```' for p in prompts]

    replies = inference.answered(batches, [down, partly])
    fallback = rows.select("id", F.lit(0.25).alias("score"), F.lit("plain").alias("reason"))
    got = {r.id: (r.score, r.reason) for r in inference.scores(replies, fallback).collect()}
    assert got == {"0": (1.0, "r"), "1": (0.4, ""), "2": (0.25, "plain"), "3": (0.25, "plain"), "4": (0.25, "plain"), "5": (0.25, "plain"), "6": (1.0, "r")}
    assert {r.endpoint: r.calls for r in inference.usage(replies).collect()} == {1: 2, -1: 1}
    again = inference.answered(batches, [lambda ps: ["[]" for _ in ps]], done=replies.where("endpoint >= 0"))
    assert again.count() == 3 and again.where("reply = '[]'").count() == 1


def test_verdicts_and_copies(spark):
    reply = '[{"index":0,"score":"11","decision":"odd"},{"index":1,"score":"x"},{"index":2,"score":4.5,"decision":"demote","category":"c"}]'
    asked = spark.createDataFrame([(0, "p", ["a", "b", "c", "d"], reply, 0)], "batch long, prompt string, ids array<string>, reply string, endpoint int")
    got = {r.id: (r.score, r.decision, r.category) for r in inference.verdicts(asked).collect()}
    assert got == {"a": (10, "keep", "other"), "b": (None, None, None), "c": (5, "demote", "c"), "d": (None, None, None)}
    copy = '[{"index":0,"hooks":["x"," y","z"],"summary":"s","why":"w"},{"index":1,"hooks":["x","x","z"],"summary":"s","why":"w"},{"index":2,"hooks":["x","y","z"],"summary":"s","why":"0.9"}]'
    got = {r.id: r.hooks for r in inference.copies(asked.withColumn("reply", F.lit(copy))).collect()}
    assert got == {"a": ["x", "y", "z"], "b": None, "c": None, "d": None}


def test_numbers_without_one_sort(spark):
    frame = spark.range(500).select((F.col("id") * 7919 % 503).alias("v"))
    rows = order.numbered(frame, "v").collect()
    assert [r.n for r in sorted(rows, key=lambda r: r.v)] == list(range(500))


def test_ranks_of_scores(spark):
    rows = spark.createDataFrame([("a", 0.8, True), ("b", 0.8, False), ("c", 0.8, True)], "source string, score double, is_new boolean")
    weights = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, weight double")
    got = {r.source: round(r.rank_score, 6) for r in learning.weighted(rows, weights).collect()}
    assert got == {"a": 1.12, "b": 0.36, "c": 0.8}


def test_criteria_and_diagnosis(spark):
    seen = spark.createDataFrame([(1, 5, 10, 0, 3, 0.1), (2, 0, 0, 2, 3, 0.9), (3, 0, 0, 2, 3, 0.9), (4, 0, 0, 2, 3, 0.9)], "round int, candidates int, delivered int, bad_sources int, enabled_sources int, saturation double")
    feedback = spark.createDataFrame([("up",)] * 3 + [("down",)], "signal string")
    notes = spark.createDataFrame([("| P-4 | 2026-01-02 | digestId=d | itemId=i | decision=x |",), ("| P-4 |",)], "line string")
    got = {r.id: r.status for r in reports.criteria(seen, feedback, 12, True, notes).collect()}
    assert got == {"I-1": "fail", "I-2": "pass", "I-3": "fail", "I-4": "fail", "G-1": "pass", "G-2": "pass", "G-3": "nodata", "P-1": "pass", "P-2": "fail", "P-3": "nodata", "P-4": "pass"}
    early = {r.id: r.status for r in reports.criteria(seen.limit(0), feedback.limit(0), None, False).collect()}
    assert set(early.values()) == {"nodata"}
    bad = GateConfig(tiers=(Tier("generic", 1, ("x",)),), blacklist=(Rule("b", "("),))
    problems = reports.config_problems(spark, bad, [Persona("p", ("a", "zz"))], {"a"})
    assert len(problems) == 4 and any("zz" in p for p in problems)


def test_greedy_leaders_against_a_loop(spark):
    rng = random.Random(8)
    sets = [(k, sorted({rng.choice("abcdefgh") for _ in range(rng.randint(0, 5))})) for k in range(80)]
    leaders, want = [], {}
    for pos, tokens in sets:
        own = set(tokens)
        hit = next((q for q, other in leaders if own and len(own & other) / len(own | other) >= 0.5), None)
        if hit is None:
            leaders.append((pos, own))
        want[pos] = pos if hit is None else hit
    frame = spark.createDataFrame(sets, "pos long, tokens array<string>")
    assert {r.pos: r.leader for r in similarity.greedy_leaders(frame, 0.5).collect()} == want


def test_running_counts_of_one_prefix_go_over_ranges(spark):
    """All rows under one prefix, and a few under others: no range has more than its share, and the counts are right."""
    rows = [("hot", (k * 7919) % 5003, k % 3) for k in range(4000)] + [("b", k, 1) for k in range(5)]
    frame = spark.createDataFrame(rows, "by string, n long, x long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one range
    try:
        parts = order.ranged(frame, "by", "n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in parts.groupBy("_p").count().collect()]
    assert len(sizes) >= 6 and max(sizes) <= 4005 / len(sizes) * 2
    got = {(r.by, r.n): (r.total, r.top) for r in order.running(parts, "by", ["n"], {"total": F.col("x")}, {"top": F.col("x") * F.col("n")}).collect()}
    total, top, want = {}, {}, {}
    for by, n, x in sorted(rows):
        total[by], top[by] = total.get(by, 0) + x, max(top.get(by, 0), x * n)
        want[by, n] = (total[by], top[by])
    assert got == want
    assert order.running(order.ranged(frame.limit(0), "by", "n"), "by", ["n"], {"total": F.col("x")}).count() == 0


def test_leaders_of_copies_and_long_sets_against_a_loop(spark):
    """Copies are compared once: pairs of rows of one set of tokens are never made."""
    rng = random.Random(31)
    base = [[f"w{rng.randint(0, 60)}" for _ in range(rng.randint(1, 40))] for _ in range(25)]
    sets = []
    for pos in range(160):
        tokens = list(dict.fromkeys(w if rng.random() < 0.8 else f"w{rng.randint(0, 60)}" for w in rng.choice(base)))
        sets.append((pos, tokens if rng.random() < 0.5 or not sets else rng.choice(sets)[1][::-1]))
    sets += [(pos, ["same", "title", "again"]) for pos in range(160, 400)] + [(400, []), (401, [])]
    leaders, want = [], {}
    for pos, tokens in sets:
        own = set(tokens)
        hit = next((q for q, other in leaders if own and len(own & other) / len(own | other) >= 0.5), None)
        if hit is None:
            leaders.append((pos, own))
        want[pos] = pos if hit is None else hit
    frame = spark.createDataFrame(sets, "pos long, tokens array<string>")
    assert {r.pos: r.leader for r in similarity.greedy_leaders(frame, 0.5).collect()} == want
    rows = frame.withColumnRenamed("pos", "l")
    few, more = rows.where("l < 120"), rows.where("l >= 80").withColumnRenamed("l", "r")
    for threshold in (0.3, 0.5, 0.7, 1.0):
        got = {(r.l, r.r) for r in similarity.jaccard_pairs(few, more, threshold).collect()}
        assert got == {(i, j) for i, a in sets[:120] for j, b in sets[80:] if a and b and len(set(a) & set(b)) / len(set(a) | set(b)) >= threshold}
    copies = frame.where("pos between 160 and 399").select(F.col("pos").alias("id"), "tokens")
    assert similarity.similar_sets(copies.groupBy("tokens").agg(F.min("id").alias("id")), 0.5).count() == 0


def test_similar_sets_compares_no_copies(spark, monkeypatch):
    """The leaders' pairs come from one set for each different title."""
    seen, real = [], similarity.similar_sets
    monkeypatch.setattr(similarity, "similar_sets", lambda sets, *a, **k: seen.append(sets.count()) or real(sets, *a, **k))
    frame = spark.createDataFrame([(k, ["a", "b", "c"]) for k in range(50)] + [(50, ["a", "b", "d"])], "pos long, tokens array<string>")
    assert {r.leader for r in similarity.greedy_leaders(frame, 0.5).collect()} == {0} and seen == [2]


def test_an_event_of_most_items_meets_its_lead_in_parts(spark, monkeypatch):
    monkeypatch.setattr(events, "EVENT_ROWS", 10)
    config = GateConfig(max_entity_df=1000)
    titles = [f"Vectorhub number{k} word{k % 7}" if k % 4 else f"plain{k}" for k in range(200)] + ["Vectorhub number1 word1"]
    items = spark.createDataFrame([(f"i{k}", k, t) for k, t in enumerate(titles)], "id string, pos long, title string")
    keyed = events.event_keys(items, config)
    keys = {r.pos: r.event_key for r in keyed.collect()}
    assert keys == {k: "i1" if t.startswith("V") else f"i{k}" for k, t in enumerate(titles)}
    lead = keyed.where("id = event_key").select("event_key", F.col("title").alias("_lead"))
    met = events.with_lead(keyed, lead)
    assert {(r.pos, r._lead) for r in met.collect()} == {(k, titles[1] if t.startswith("V") else t) for k, t in enumerate(titles)}
    capped = {r.pos: (r.repost, r.kept) for r in events.capped_events(keyed, config).collect()}
    assert capped[1] == (False, True) and capped[200] == (True, False) and capped[2] == (False, True) and capped[3] == (False, False)
    text = [str(r) for r in keyed._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in r]
    assert len(text) == 2 and any("pos" in t and "LeftOuter" in t for t in text[:1])  # texts are joined by their own number, not by their event's


def test_embedded_deals_rows_of_texts_not_sums(spark):
    import numpy as np

    model = lambda: lambda words: np.array([[len(w), 2.0] if w != "bad" else [np.nan, 1.0] for w in words], np.float32)
    items = spark.createDataFrame([(1, "aaa aaa bbbbb"), (2, "a bad one"), (3, ""), (4, "cc")], "id long, text string")
    made = similarity.embedded(items, model, 2)
    got = {r.id: r.embedding and [round(x, 6) for x in r.embedding] for r in made.collect()}
    unit = lambda x, y: [round(v / (x * x + y * y) ** 0.5, 6) for v in (x, y)]
    assert got == {1: unit(11 / 3, 2.0), 2: None, 3: None, 4: unit(2.0, 2.0)}
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "RepartitionByExpression" in plan  # one sum of whole texts, after they are dealt
