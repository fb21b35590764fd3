"""A whole round over feed payloads and pages."""

from pyspark.sql import functions as F

from loomsift.operators.gates import GateConfig, Persona, Tier
from loomsift.operators.items import from_pages
from loomsift.plans import rounds
from loomsift.sources import feeds

NOW = 1_704_240_000_000
RSS = """<?xml version="1.0"?><rss version="2.0"><channel><item><title>One title</title><description>Body &amp; more</description><link>https://a.example/x</link>
<pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate></item><item><title>Two</title><link>javascript:alert(1)</link></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>E</title><summary>S</summary><link rel="self" href="https://b.example/self"/>
<link rel="alternate" href="https://b.example/e"/><updated>2024-01-03T00:00:00Z</updated></entry></feed>"""
PAYLOADS = {
    "rss1": ("rss", RSS, None),
    "atom": ("rss", ATOM, None),
    "repos": ("github", '{"items":[{"full_name":"o/n","description":"d","html_url":"https://g.example/o/n","created_at":"2024-01-01T00:00:00Z","stargazers_count":5,"topics":["x","y"]}]}', None),
    "blocks": ("exa", "Title: A\nURL: https://c.example/a\nPublished: 2024-01-02\nHighlights:\nfoo\n---\n\n\nbar\nTitle: B\nURL: ftp://x\n", None),
    "rpc": ("anysearch", '{"result":{"content":[{"type":"text","text":"x\\n### 1. T1\\n- **URL**: https://d.example/1\\nline\\n### 2. T2\\n- **URL**: http://d.example/2\\n"}]}}', None),
    "forum": ("v2ex", '[{"title":"t","url":"https://v.example/1","content":"","created":1700000000,"member":{"username":"m"},"node":{"title":"n"}}]', None),
    "list": ("bili", "items:\n  - id: 1\n    bvid: BV1\n    title: T\n    author: A\n    play: 1234\n  - id: 2\n    title: U\n", None),
    "lines": ("ytsearch", '{"id":"q","title":"vid","view_count":12345,"channel":"ch","upload_date":"20240105"}\nnot json\n{"title":""}', None),
    "page": ("jina", "", "# Head\nURL: x\ntext"),
    "tweets": ("twitter", '{"ok":true,"data":[{"id":"9","text":"hi https://t.co/abc\\nmore","author":{"screenName":"me"},"createdAtISO":"2024-01-01T00:00:00.000Z"}]}', None),
    "broken": ("twitter", "not json", None),
    "empty": ("rss", "", None),
}


def test_connectors(spark):
    payloads = spark.createDataFrame([(s, f"https://{s}.example/p", p, f) for s, (_, p, f) in PAYLOADS.items()], "source string, url string, payload string, fallback string")
    sources = spark.createDataFrame([(s, k, n, True) for n, (s, (k, _, _)) in enumerate(PAYLOADS.items())] + [("off", "rss", 99, False)], "source string, type string, ordinal int, enabled boolean")
    items, skipped = feeds.items_of(payloads, sources)
    got = [(r.source, r.title, r.body, r.url, r.published_at) for r in items.orderBy("seq").collect()]
    assert got == [
        ("rss1", "One title", "Body & more", "https://a.example/x", 1704189600000),
        ("rss1", "Two", "", "", 0),
        ("atom", "E", "S", "https://b.example/e", 1704240000000),
        ("repos", "o/n: d", "d · 5 stars · x y", "https://g.example/o/n", 1704067200000),
        ("blocks", "A", "foo\nbar", "https://c.example/a", 1704153600000),
        ("rpc", "T1", "T1\nline", "https://d.example/1", 0),
        ("forum", "t", "Node: n · Author: m", "https://v.example/1", 1700000000000),
        ("list", "T", "A · 1,234 plays", "https://www.bilibili.com/video/BV1", 0),
        ("list", "U", " · 0 plays", "", 0),
        ("lines", "vid", "ch · 12,345 views", "https://www.youtube.com/watch?v=q", 1704412800000),
        ("page", "Head", "text", "https://page.example/p", 0),
        ("tweets", "hi ", "hi \nmore", "https://x.com/me/status/9", 1704067200000),
    ]
    assert {r.source for r in skipped.collect()} == {"broken", "empty"}


def test_round_over_pages(spark, sf_dir):
    persona = Persona("daily", ("pages",), max_items=5, display="Daily", domain="prose")
    config = GateConfig(min_points=1, tiers=(Tier("core", 1, ("the", "de", "der", "of")),), stopwords=("the",))
    round_ = rounds.Round(persona, config, ("the", "der"), ("only",), NOW, "d1")
    items = from_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    archive = items.where("seq < 2").select("id", "title")
    published = spark.createDataFrame([], "canonical_url string")
    weights = spark.createDataFrame([("pages", 0.7)], "source string, weight double")
    candidates, lost, counts = rounds.collect(items, round_, archive, published, weights)
    row = counts.first()
    assert row.collected == items.count() and row.deduped == row.collected - 2
    assert row.candidates + lost.count() == row.deduped
    assert candidates.where("id in ('0', '1')").count() == 0
    posts = rounds.finalize(candidates, round_, published)
    rows = posts.collect()
    assert 0 < len(rows) <= 10
    for r in rows:
        if r.state in ("accepted", "filled"):
            assert r.rule is None and len(r.hooks) == 3
        if r.state == "rejected":
            assert r.rule.startswith("gk:")
    assert rounds.audit([("collected", 9), ("kept", 5), ("published", 3)], 3, 2, 1) == []
    assert len(rounds.audit([("collected", 3), ("kept", 5)], 4, 3, 1)) == 3


def test_memory_of_a_round(spark, sf_dir):
    persona = Persona("daily", ("pages",), max_items=4, display="Daily", domain="prose")
    config = GateConfig(min_points=1, tiers=(Tier("core", 1, ("the", "de", "der", "of")),), stopwords=("the",))
    round_ = rounds.Round(persona, config, ("the", "der"), ("only",), NOW, "d1")
    items = from_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    none = spark.createDataFrame([], "canonical_url string")
    weights = spark.createDataFrame([("pages", 0.7)], "source string, weight double")
    candidates, _, _ = rounds.collect(items, round_, items.limit(0).select("id", "title"), none, weights)
    assert [r.score for r in candidates.orderBy("pos").collect()] == sorted((r.score for r in candidates.collect()), reverse=True)
    posts = rounds.finalize(candidates, round_, none)
    empty = lambda ddl: spark.createDataFrame([], ddl)
    old = [("d0", 0, "pages", NOW - 10**9), ("d0", 1, "pages", NOW - 10**9)]
    memory = rounds.Memory(
        empty("id string, title string, url string, source string, first_seen long, last_seen long, hits long, pushed boolean, seq long"),
        empty("digest_id string, generated_at long, clusters array<struct<index:long,title:string,summary:string,url:string>>, seq long"),
        empty("ref string, digest_id string, item_id string, source string, seq long"),
        spark.createDataFrame(old, "digest_id string, index int, source string, at long"),
        spark.createDataFrame([("d0", 1)], "digest_id string, index int"),
        empty("digest_id string, index int"),
    )
    after = rounds.recorded(memory, candidates, posts, round_)
    n = posts.where("state in ('accepted', 'filled')").count()
    assert after.archive.count() == candidates.count() and after.archive.where("pushed").count() == n
    assert after.refs.count() == n and after.shown.count() == 2 + n and after.settled.count() == 2
    assert after.digests.count() == (1 if n else 0)
    again = rounds.recorded(after, candidates, posts, round_)
    assert again.digests.count() == after.digests.count() and again.refs.count() == n and again.settled.count() == 2 and again.archive.where("pushed").count() == n


def test_demoted_come_last(spark, sf_dir):
    from loomsift.operators import events

    frame = spark.createDataFrame([("a", "t", 0, "e", 0.2, True), ("b", "t", 1, "e", 0.9, False), ("c", "t", 2, "f", 0.5, True)], "id string, title string, pos long, event_key string, score double, kept boolean")
    assert [r.id for r in events.ordered(frame).collect()] == ["c", "a", "b"]
    assert frame.agg(F.count("*")).first()[0] == 3


def test_a_round_with_editors_and_a_recall_judge(spark, sf_dir):
    from loomsift.operators import editorial

    persona = Persona("daily", ("pages",), max_items=4, display="Daily", domain="prose")
    config = GateConfig(min_points=2, tiers=(Tier("core", 1, ("the", "de", "der", "of")),), stopwords=("the",))
    round_ = rounds.Round(persona, config, ("the", "der"), ("only",), NOW, "d1", recall_pool=3)
    items = from_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    none, weights = spark.createDataFrame([], "canonical_url string"), spark.createDataFrame([("pages", 0.7)], "source string, weight double")
    archive = items.limit(0).select("id", "title")
    pools = []

    def judge(pool):
        pools.append([r.id for r in pool.orderBy("seq").collect()])
        first = F.col("id") == pools[0][0]
        return pool.where(first), pool.where(~first).withColumn("rule", F.lit("recall:excluded"))

    candidates, lost, counts = rounds.collect(items, round_, archive, none, weights, judge)
    assert len(pools[0]) == 3 and lost.where("rule = 'recall:excluded'").count() == 2
    assert candidates.where(F.col("id") == pools[0][0]).count() == 1
    over = lost.where("rule = 'recall:poolOverflow'").first()
    beyond = int(over.title) if over else 0
    assert candidates.count() + lost.where("item_id <> '(batch)'").count() + beyond == counts.first().deduped
    ids = [r.id for r in rounds.targets(candidates, round_).orderBy("pos").collect()]
    verdicts = spark.createDataFrame([(ids[0], 2, "keep"), (ids[1], 9, "reject"), (ids[2], 7, "keep")], "id string, score int, decision string")
    copies = spark.createDataFrame([(ids[2], ["one of it", "two of it", "three of it"], "mine", "why"), (ids[3], None, None, None)], "id string, hooks array<string>, summary string, why string")
    posts = rounds.finalize(candidates, round_, none, editorial.Edited(copies, verdicts))
    rows = sorted(posts.collect(), key=lambda r: r.pos)
    assert [r.item_id for r in rows] == ids[2:] + ids[:2]
    assert rows[0].summary == "mine" and rows[1].summary != "mine" and len(rows[1].hooks) > 0
