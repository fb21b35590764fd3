"""Recorded state: ledgers, signals over batches, timers, commits, model jobs, redirects, whole rounds."""

import pytest
from pyspark.sql import functions as F

from loomsift.operators import inference, learning, state
from loomsift.operators.gates import GateConfig, Persona, Rule, Tier
from loomsift.operators.items import from_pages
from loomsift.plans import memory, rounds
from loomsift.sources import redirects
from loomsift.sources.commits import Commits, Conflict
from loomsift.sources.ledger import Ledger
from loomsift.streaming import signals

SIGNAL = "post_id string, dwell_ms double, completed boolean, chat_turns int, dismissed boolean, reaction string, favorite boolean, seq long"


def test_ledger(spark, tmp_path):
    summed = lambda d: d.groupBy("k").agg(F.sum("n").alias("n"))
    ledger = Ledger(str(tmp_path / "l"), "k string, n long", summed, every=2)
    rows = lambda n: spark.createDataFrame([("a", n), ("b", 1)], "k string, n long")
    for epoch in range(6):
        ledger.compact(spark, epoch)
        ledger.write(rows(10**epoch), epoch)
        ledger.compact(spark, epoch)
        ledger.write(rows(10**epoch), epoch)  # a batch that runs twice
        total = {r.k: r.n for r in summed(ledger.before(spark)).collect()}
        assert total == {"a": sum(10**e for e in range(epoch + 1)), "b": epoch + 1}
    names = sorted(p.name for p in (tmp_path / "l").iterdir())
    assert sum(n.startswith("base=") for n in names) == 1 and len(names) <= 4
    assert {r.k: r.n for r in summed(ledger.before(spark, 5)).collect()}["a"] == 11111
    # A base that was not written to the end, and deltas that a base covers, are not read.
    (tmp_path / "l" / "base=000000000099").mkdir()
    Ledger(ledger.root, ledger.schema).write(rows(7), 0)
    assert {r.k: r.n for r in summed(ledger.before(spark)).collect()}["a"] == 111111
    assert Ledger(str(tmp_path / "none"), "k string").before(spark).count() == 0


def test_one_export_twice(spark):
    """An expand, a like, a favourite and a view: the second time only the expand counts."""
    refs = spark.createDataFrame([("d1:0", "i0", "s0"), ("d1:1", "i1", "s1")], "ref string, item_id string, source string")
    export = spark.createDataFrame(
        [("daily:d1:0", 5.0, False, 0, False, "satisfied", False, 1), ("daily:d1:1", None, None, None, True, None, None, 2), ("daily:d1:1", None, None, None, None, None, True, 3), ("odd", 1.0, True, 1, True, "stopped", True, 4)],
        SIGNAL,
    )
    kinds = lambda d: sorted((r.kind, r.item_id) for r in d.collect())
    first = state.routed(export, refs)
    assert kinds(first) == [("down", "i1"), ("expand", "i0"), ("expand", "i1"), ("up", "i0"), ("up", "i1"), ("view", "i0")]
    assert kinds(state.routed(export, refs, first)) == [("expand", "i0")]
    # A change of mind is another fact; a favourite after a like is none.
    later = spark.createDataFrame([("daily:d1:0", None, None, None, True, None, None, 9), ("daily:d1:0", None, None, None, None, None, True, 10)], SIGNAL)
    assert kinds(state.routed(later, refs, first)) == [("down", "i0")]


def test_timers_and_late_rows(spark, tmp_path):
    """Opened, settled before, moved on by a later row, without a source, behind the watermark, still open."""
    kind = "digest_id string, index int, source string, opened boolean, done boolean, t timestamp"
    at = lambda h: f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00"

    def feed(rows):
        made = spark.createDataFrame([(d, i, s, o, x, None if h is None else at(h)) for d, i, s, o, x, h in rows], kind.replace("timestamp", "string"))
        made.withColumn("t", F.to_timestamp("t")).write.mode("append").parquet(str(tmp_path / "in"))
        signals.settle_stream(spark.readStream.schema(kind).parquet(str(tmp_path / "in")), "1 hour", str(tmp_path))

    feed([("d", 0, "s", False, False, 1), ("d", 1, "s", True, None, 1), ("d", 2, "s", False, True, 1), ("d", 3, "", False, False, 1), ("d", 4, "s", False, False, 1), (None, 5, "s", False, False, 1), ("d", 6, "s", False, False, None), ("d", 4, "t", False, False, 20)])
    feed([("d", 7, "s", False, False, 30)])
    got = {(r.digest_id, r["index"]): (r.source, r.counted) for r in spark.read.parquet(str(tmp_path / "settled")).collect()}
    assert got == {("d", 0): ("s", True), ("d", 1): ("s", False), ("d", 3): ("", False)}
    # An open for one that has settled comes too late, and makes no second exposure.
    feed([("d", 0, "s", True, False, 1), ("d", 4, "u", True, False, 33), ("d", 7, "s", False, False, 60)])
    got = [(r["index"], r.source, r.counted) for r in spark.read.parquet(str(tmp_path / "settled")).collect()]
    assert sorted(got) == [(0, "s", True), (1, "s", False), (3, "", False), (4, "u", False)]
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_settling_an_epoch_twice_and_rows_of_one_millisecond(spark, tmp_path):
    """The latest row by microseconds names the source, a batch that runs again leaves what it left, and each epoch finds
    what is still open in the one before it."""
    kind, root = "digest_id string, index int, source string, opened boolean, done boolean, t string", str(tmp_path)

    def settle(epoch, rows, times=1):
        for _ in range(times):
            signals.settled(spark.createDataFrame(rows, kind).withColumn("t", F.to_timestamp("t")), epoch, "1 hour", root)
        return sorted((r["index"], r.source, r.counted) for r in signals.settled_ledger(root).before(spark).collect())

    row = lambda i, s, t, o=False: ("d", i, s, o, False, f"2024-01-{t}")
    assert settle(0, [row(0, "b", "01 05:00:00.000100"), row(0, "a", "01 05:00:00.000900"), row(1, "c", "01 20:00:00")], 2) == []
    assert settle(1, [row(2, "x", "02 08:00:00")], 2) == [(0, "a", True)]
    # Behind the watermark (07:00 of the second) for one that is settled and for one that is open; the latter is opened in time.
    assert settle(2, [row(0, "z", "02 06:00:00"), row(1, "z", "02 06:30:00"), row(1, "c", "02 09:00:00", True)], 2) == [(0, "a", True)]
    settle(3, [("d", None, "y", False, False, "2024-01-09 00:00:00")])
    settle(4, [row(4, "y", "02 10:04:00")])
    assert len(list((tmp_path / "held").iterdir())) == 2
    assert settle(5, [row(99, "y", "05 00:00:00")], 2) == [(0, "a", True), (1, "c", False), (2, "x", True), (4, "y", True)]


def test_commits(spark, tmp_path):
    kept = Commits(str(tmp_path / "c"), {"a": "x int", "b": "y string"})
    a = lambda *xs: spark.createDataFrame([(x,) for x in xs], "x int")
    assert kept.tables(spark)["a"].count() == 0 and kept.numbers(spark) == [] and kept.swept(spark) == 0
    assert kept.commit(spark, {"a": a(1)}) == 1
    assert kept.commit(spark, {"b": spark.createDataFrame([("q",)], "y string")}, after=1) == 2
    with pytest.raises(Conflict):
        kept.commit(spark, {"a": a(5)}, after=1)
    state_ = kept.tables(spark)
    assert [r.x for r in state_["a"].collect()] == [1] and [r.y for r in state_["b"].collect()] == ["q"]
    # A table read from a commit can be changed in the next one.
    assert kept.commit(spark, {"a": state_["a"].union(a(2))}) == 3
    assert sorted(r.x for r in kept.tables(spark)["a"].collect()) == [1, 2] and [r.x for r in kept.tables(spark, 1)["a"].collect()] == [1]
    # Two writers of one number: the second fails, and its folders go with the next sweep.
    with pytest.raises(Conflict):
        kept._publish(spark, 3, {"a": "tables/a/none"})
    (tmp_path / "c" / "manifests" / "_000000000004-lost").write_text("{")
    assert kept.numbers(spark) == [1, 2, 3]
    assert kept.swept(spark, keep=1) == 1 and kept.numbers(spark) == [3]
    assert sorted(r.x for r in kept.tables(spark)["a"].collect()) == [1, 2]


def batches_of(spark, n, word="p"):
    return spark.createDataFrame([(b, f"{word} {b}", [f"{b}-{k}" for k in range(2)]) for b in range(n)], "batch long, prompt string, ids array<string>")


def test_a_job_that_is_killed_asks_only_the_rest(spark, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()
    rows, root = batches_of(spark, 9), str(tmp_path / "job")

    def client(prompts):
        for p in prompts:
            with (log / p.replace(" ", "_")).open("a") as f:
                f.write("x")
        return ['[{"index": 0}]'] * len(prompts)

    def dying(prompts):
        if any(int(p.split()[1]) >= 6 for p in prompts):
            raise SystemExit("killed")
        return client(prompts)

    with pytest.raises(Exception):
        inference.durable_job(rows, [dying], root, together=3)
    assert sorted(p.name for p in log.iterdir()) == [f"p_{b}" for b in range(6)]
    done = inference.durable_job(rows, [client], root, together=3)
    assert done.count() == 9 and {p.read_text() for p in log.iterdir()} == {"x"}
    assert inference.durable_job(rows, [client], root).count() == 9 and {p.read_text() for p in log.iterdir()} == {"x"}
    # Another input, if only the items of one batch change, asks all of it.
    changed = rows.withColumn("ids", F.when(F.col("batch") == 4, F.array(F.lit("z"))).otherwise(F.col("ids")))
    assert inference.fingerprint(changed) != inference.fingerprint(rows) == inference.fingerprint(rows.orderBy(F.desc("batch")))
    assert inference.durable_job(changed, [client], root).count() == 9 and {p.read_text() for p in log.iterdir()} == {"xx"}
    assert len(list((tmp_path / "job").iterdir())) == 1
    assert inference.durable_job(rows.limit(0), [client], root).count() == 0


def test_replies_that_cannot_be_used_go_to_the_next(spark):
    def broken(prompts):
        return [None if p.endswith("0") else "[1, 2" if p.endswith("1") else ('[{"index": 0', True) if p.endswith("2") else "" if p.endswith("3") else '[{"index": 0}]' for p in prompts]

    def down(prompts):
        raise RuntimeError("down")

    def good(prompts):
        return ["no" if p.endswith("3") else '```json\n[{"index": 1}]\n```' for p in prompts]

    replies = inference.asked(batches_of(spark, 5).coalesce(1), [down, broken, good]).collect()
    got = {r.batch: (r.endpoint, r.truncated, [a.outcome for a in r.attempts]) for r in replies}
    assert got == {
        0: (2, False, ["failed", "failed", "ok"]), 1: (2, False, ["failed", "unusable", "ok"]), 2: (2, True, ["failed", "truncated", "ok"]), 3: (-1, False, ["failed", "failed", "unusable"]), 4: (1, False, ["failed", "ok"])
    }
    strict = inference.asked(batches_of(spark, 1), [broken, good], valid=lambda reply, n: n == 2 and "1" in reply).first()
    assert strict.endpoint == 1
    # Replies kept from another prompt are asked for again.
    kept = inference.answered(batches_of(spark, 2), [good])
    again = inference.answered(batches_of(spark, 2, "q"), [lambda ps: ["[]"] * len(ps)], done=kept)
    assert [r.reply for r in again.collect()] == ["[]", "[]"]


def test_an_endpoint_that_is_down_is_left_out(spark):
    import pandas as pd

    calls = []

    def down(prompts):
        calls.append(len(prompts))
        raise RuntimeError("down")

    frames = [pd.DataFrame({"batch": [k], "prompt": [f"p {k}"], "ids": [["a"]]}) for k in range(6)]
    out = list(inference._asked([down, lambda ps: ["[]"] * len(ps)], inference.is_json_array)(iter(frames)))
    assert len(calls) == inference.BREAK_AFTER and all(f["endpoint"].tolist() == [1] for f in out)
    assert out[-1]["attempts"][0][0][1] == "left out"


def test_redirects(spark):
    chain = [(f"https://a.example/{k}", 302, f"/{k + 1}") for k in range(7)]
    answers = spark.createDataFrame(
        [*chain, ("https://loop.example/", 301, "https://loop.example/"), ("http://old.example/a/b?q", 308, "c?x=1"), ("https://old.example/t", 307, "//new.example"), ("https://q.example", 303, "?z"),
         ("https://bad.example/", 302, "https://192.168.0.1/"), ("https://js.example/", 302, "javascript:alert(1)"), ("https://ok.example/", 200, "https://a.example/0"), ("https://none.example/", 302, None), (None, 302, "x")],
        "url string, status int, location string",
    )
    urls = ["https://a.example/0", "https://a.example/2", "https://loop.example/", "http://old.example/a/b?q", "https://old.example/t", "https://q.example", "https://bad.example/", "https://js.example/", "https://ok.example/", "https://none.example/", "http://127.0.0.1/", "https://user@a.example/0", "https://unknown.example/", None]
    got = {r.url: (r.final, r.hops, r.problem) for r in redirects.followed(spark.createDataFrame([(u,) for u in urls * 2], "url string"), answers).collect()}
    far, target = "too many redirects", "target is not public https"
    assert got == {
        "https://a.example/0": ("https://a.example/5", 5, far), "https://a.example/2": ("https://a.example/7", 5, None), "https://loop.example/": ("https://loop.example/", 5, far),
        "http://old.example/a/b?q": ("http://old.example/a/c?x=1", 1, target), "https://old.example/t": ("https://new.example", 1, None), "https://q.example": ("https://q.example/?z", 1, None),
        "https://bad.example/": ("https://192.168.0.1/", 1, target), "https://js.example/": ("javascript:alert(1)", 1, target), "https://ok.example/": ("https://ok.example/", 0, None),
        "https://none.example/": ("https://none.example/", 0, None), "http://127.0.0.1/": ("http://127.0.0.1/", 0, "private start"), "https://user@a.example/0": ("https://user@a.example/0", 0, "private start"),
        "https://unknown.example/": ("https://unknown.example/", 0, None),
    }
    assert redirects.followed(answers.select("url").limit(0), answers).count() == 0


def test_weights_stay_without_new_feedback(spark):
    none = spark.createDataFrame([], "source string, weight double, token string")
    sources = spark.createDataFrame([("s",), ("t",)], "source string")
    feedback = spark.createDataFrame([("s", "up")] * 3, "source string, signal string")
    first = learning.refreshed_weights(none, feedback, sources)
    one = {r.source: r.weight for r in first.collect()}
    same = {r.source: r.weight for r in learning.refreshed_weights(first, feedback, sources).collect()}
    moved = {r.source: r.weight for r in learning.refreshed_weights(first, feedback.union(feedback), sources).collect()}
    assert one == same and one["s"] > 0.5 and one["t"] == 0.5 and moved["s"] > one["s"]


def test_whole_rounds(spark, sf_dir, tmp_path):
    """Two rounds, one that is lost on the way in between: what was published is not published again."""
    persona = Persona("daily", ("pages",), max_items=4, display="Daily", domain="prose")
    config = GateConfig(min_points=1, tiers=(Tier("core", 1, ("the", "de", "der", "of")),), stopwords=("the",))
    now, root = 1_704_240_000_000, str(tmp_path / "memory")
    items = from_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    make = lambda d, at: rounds.Round(persona, config, ("the", "der"), ("only",), at, d)
    first = memory.run_round(items, make("d1", now), root)
    published = {r.url for r in first.posts.where("state in ('accepted', 'filled')").collect()}
    assert first.commit == 1 and published and first.problems.where("level = 'fatal'").count() == 0
    assert {r.rule for r in first.problems.collect()} >= {"no signals"}
    seen = memory.remembered(spark, root)
    assert seen.archive.where("pushed").count() == len(published) and seen.digests.count() == 1

    def lost(pool):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        memory.run_round(items, make("d2", now + 10), root, judge=lost)
    assert memory.store(root).numbers(spark) == [1]
    second = memory.run_round(items, make("d2", now + 10), root)
    assert second.commit == 2 and second.funnel.first().deduped < first.funnel.first().deduped
    assert not published & {r.url for r in second.posts.where("state in ('accepted', 'filled')").collect()}
    rows = memory.store(root).tables(spark)["observations"].orderBy("at").collect()
    assert [(r.digest_id, r.published) for r in rows][0] == ("d1", len(published)) and len(rows) == 2
    bad = GateConfig(min_points=1, tiers=config.tiers, blacklist=(Rule("x", "("),))
    with pytest.raises(ValueError, match="compile"):
        memory.run_round(items, rounds.Round(persona, bad, (), (), now, "d3"), root)


def test_a_round_may_archive_all_its_candidates(spark):
    config = GateConfig(min_points=0)
    n = state.ARCHIVE_MAX + 5
    rows = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("title"), F.lit("").alias("url"), F.lit("s").alias("source"), F.col("id").alias("seq"))
    empty = rounds.Memory(**{k: spark.createDataFrame([], v) for k, v in memory.SCHEMAS.items()})
    posts = spark.createDataFrame([], "id string, item_id string, title string, summary string, url string, source string, pos long, state string")
    size = lambda **k: rounds.recorded(empty, rows, posts, rounds.Round(Persona("p"), config, (), (), 1, "d1", **k)).archive.count()
    assert size(archive_max=None) == n and size() == state.ARCHIVE_MAX
