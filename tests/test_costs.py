"""Text functions that long tables wait for: each costly step stands once in its expression, and short ways give the long ones' results."""

import random
import re

from pyspark.sql import functions as F

from loomsift import editor_queries, lineage, queries, round_queries
from loomsift.functions import text as T
from loomsift.functions.urls import canonical_url
from loomsift.operators import gates, render

WHITE = " \t\n\x0b\f\r" + "".join(map(chr, [0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))


def _texts(n: int, parts: list[str]) -> list[str]:
    rng = random.Random(7)
    return [rng.choice(["", " "]).join(rng.choices(parts, k=rng.randrange(12))) for _ in range(n)]


def test_a_text_is_normalised_once_for_its_tokens(spark):
    assert str(T.tokens(F.col("body"))).count("https?://") == 1
    assert str(T.is_title_prefix(F.col("h"), F.col("t"))).count("…") == 1


def test_a_url_is_cleaned_and_its_host_read_once(spark):
    shown = str(canonical_url(F.col("url")))
    assert shown.count("^.*@") == 1 and shown.count("coalesce(url") == 1


def test_white_space_is_as_by_the_class_of_its_members(spark):
    texts = _texts(400, [*WHITE, "  ", "a", "word", "。", "\x85", "​", "é"])
    odd = f"[{re.escape(WHITE)}]+"
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.collapse(F.col("t")).alias("c"), T.strip(F.col("t")).alias("s")).collect()
    for r in rows:
        assert r.c == re.sub(odd, " ", r.t).strip(" ") and r.s == re.sub(rf"\A{odd}|{odd}\Z", "", r.t), repr(r.t)


def test_metadata_and_markup_go_in_any_case(spark):
    texts = ["aRXiv:26.1v1 Announce TYPE: new abSTRACT: It", "  Abstract: x", "K ABSTRACT: kept", "a <B>b</b> &AMP; &amp;lt;i&gt; &#39;c&nbsp;", "<STYLE>x</style>y<script>z</SCRIPT>", "plain"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(T.strip_metadata(F.col("t")).alias("m"), T.strip_html(F.col("t")).alias("h")).collect()
    assert [r.m for r in got] == ["It", "x", "K ABSTRACT: kept", *texts[3:]]
    assert [r.h for r in got] == [texts[0], "Abstract: x", texts[2], "a b &AMP; 'c", "y", "plain"]


def test_hooks_are_held_against_the_body_where_the_title_does_not_name_them(spark):
    """The flag equals that of all hooks against title and body at once, over posts with and without words in either."""
    rng = random.Random(3)
    words = ["Vector", "graphs", "the", "of", "中文字", "gpt中文", "café", "a1"]
    text = lambda k: " ".join(rng.choices(words, k=rng.randrange(k)))
    rows = [(str(n), text(4), [text(4) for _ in range(n % 4)], text(3), text(6), "w", f"https://a.example/{n}", "en", 0, n) for n in range(300)]
    posts = spark.createDataFrame(rows, "id string, title string, hooks array<string>, summary string, body string, why string, url string, lang string, published_at long, pos long")
    got = {r.id: r for r in render.asserted(posts, queries.CONFIG, spark.createDataFrame([], "canonical_url string"), 72, 10**12).collect()}
    stop = list(queries.CONFIG.stopwords)
    told = posts.select("id", T.topic_tokens(F.concat("title", F.lit(" "), "body"), stop).alias("s"), F.transform("hooks", lambda h: T.topic_tokens(h, stop)).alias("h"), T.substance(F.col("summary")).alias("a"), T.substance(F.col("body")).alias("b"))
    for r in told.collect():
        assert got[r.id].gk_hookEntity == (not r.s or any(not set(h) & set(r.s) for h in r.h)), r
        assert got[r.id].gk_hollowSummary == (max(r.a, r.b) < 5), r


def test_the_blacklist_needs_no_haystack_for_items_without_a_pattern(spark):
    """Strong words excuse a rule as before, though the text is looked through for them only after the rule has hit."""
    rows = [("A long enough title here", "all rights reserved"), ("A long enough title here", "all rights reserved, trash"), ("A long enough title here", "token"), ("A long [object Object] title", "x"), ("short", "x")]
    got = spark.createDataFrame(rows, "title string, body string").select(gates.blacklist_verdict(queries.CONFIG).alias("r")).collect()
    assert [r.r for r in got] == ["license", None, None, "damaged:objectObject", "damaged:titleTooShort"]


def test_a_reason_is_cut_from_its_bare_head_once(spark):
    assert str(T.truncate_why(F.col("t"), 28)).count("，。、！？·") == 2


def test_a_keyword_is_made_a_needle_once(spark):
    shown = spark.range(1).selectExpr("cast(id as string) AS h").select(T.keyword_hits(F.col("h"), ["ab", "中文"]).alias("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert "[ab,ab, ab ],[中文,中文,中文]" in shown and "RLIKE" not in shown
    rows = spark.createDataFrame([(" x ab y ",), (" xab ",), (" 的中文x ",), ("",)], "h string").select(T.keyword_hits(F.col("h"), ["ab", "中文"]).alias("k")).collect()
    assert [r.k for r in rows] == [["ab"], [], ["中文"], []]


def test_outlets_and_subjects_as_by_the_plain_patterns(spark):
    texts = _texts(300, [" - ", "　–　", "| ", "The", "Daily", "New's", "word", "é", "A&B", "。", " ", "3.5", "…"])
    white, word = f"[{re.escape(WHITE)}]", "[A-Z][A-Za-z0-9.'’&]*"
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.strip_outlet(F.col("t")).alias("o")).collect()
    for r in rows:
        assert r.o == re.sub(rf"{white}+[-–—|]{white}+{word}(?:{white}+{word}){{0,3}}{white}*\Z", "", r.t).strip(WHITE), repr(r.t)


def test_a_report_writes_no_bodies_and_makes_no_haystack_of_both(spark, sf_dir, monkeypatch):
    kept = {}

    def noted(df, name, *by):
        kept[name] = (df.columns, df._jdf.queryExecution().analyzed().toString())
        return lineage.written(df, name, *by)

    monkeypatch.setattr(editor_queries, "written", noted)
    editor_queries.board_report(spark, sf_dir)
    assert not {"body", "hits"} & set(kept["judged"][0]) and " _all#" not in kept["judged"][1]


def test_payloads_do_not_move_to_meet_their_sources(spark, sf_dir):
    plan = round_queries.feed_connectors(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_the_head_of_a_body_gives_what_the_whole_body_gives(spark, monkeypatch):
    """Summaries and hooks' flags do not depend on how much of a body is looked at first."""
    parts = ["Announce Type: new", "arXiv:1", "Abstract:", "https://a.b/c.d?e", "Graphs of vectors are drawn here.", "Zwölf Boxkämpfer jagen!", "。", "中文字中文字中文字中文字中文字。", ". ", "\u3000", "? ", "word", "Σ", "3.5 "]
    rng = random.Random(11)
    rows = []
    for n in range(250):
        body = " ".join(rng.choices(parts, k=rng.randrange(60)))
        rows.append((str(n), rng.choice(["Vector", "word", ""]), [rng.choice(parts) for _ in range(3)], rng.choice(["", "Short.", body[:80]]), body, "w", f"https://a.example/{n}", rng.choice(["en", "zh"]), 0, n))
    posts = spark.createDataFrame(rows, "id string, title string, hooks array<string>, summary string, body string, why string, url string, lang string, published_at long, pos long").persist()
    found = []
    for most in (7, 60, 400, 10**6):
        monkeypatch.setattr(T, "HEAD", most)
        summaries = posts.select("id", T.ensure_summary_floor(F.col("summary"), F.col("body"), F.col("lang")).alias("s")).collect()
        flags = render.asserted(posts, queries.CONFIG, spark.createDataFrame([], "canonical_url string"), 72, 10**12).collect()
        found.append((sorted((r.id, r.s) for r in summaries), sorted((r.id, r.gk_hookEntity) for r in flags)))
    assert all(f == found[-1] for f in found) and len({flag for _, flag in found[-1][1]}) == 2


def test_short_ways_of_cleaning_give_the_long_ways_results(spark):
    texts = _texts(400, [" ", "  ", "\u3000", "arXiv:1 ", "ABSTRACT: ", "Announce type: x", "<b>", "</style>", "<style>", "&amp;", "&amp;lt;", "&#39;", "&#039;", "&apos;", "&nbsp;", "a.", "bc", "。", "HTTPS://x.y/z ", ":", "word"])
    c = F.col("t")
    shown = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", T.strip_both(c).alias("both"), T.strip_metadata(T.strip_html(c)).alias("each"), T.normalize(c).alias("norm"), T.collapse(c).alias("clean"), *[T.first_sentence(c, m).alias(f"s{m}") for m in (2, 5, 9)]
    )
    for r in shown.collect():
        assert r.both == r["each"], repr(r.t)
        assert r.norm == re.sub(r"[\W_]+", " ", re.sub(rf"https?://[^{re.escape(WHITE)}]+", " ", r.t.lower())).strip(" "), repr(r.t)
        whole = (re.match("[^。！？.!?]*[。！？.!?]", r.clean) or re.match("(?s).*", r.clean))[0].strip(" ")
        for most in (2, 5, 9):
            assert r[f"s{most}"] == (whole if len(whole) <= most else whole[: most - 1] + "…"), repr(r.t)


def test_lower_case_is_made_only_where_a_sign_can_be(spark):
    assert "lower" not in str(T.where_shows(F.col("t"), ["<"], F.upper)) and "lower" not in str(T.strip_html(F.col("t")))
    assert str(T.strip_both(F.col("t"))).count("[^ ]][") == 2
