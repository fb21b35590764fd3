"""Registered queries of what a round says and asks: reasons by language, scores by model, prompts, the board's report, briefs."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.functions import text as T
from loomsift.lineage import written
from loomsift.operators import gates, inference, render, reports, scoring, state
from loomsift.operators.items import from_documents
from loomsift.plans import rounds as plan
from loomsift.queries import _OUTLET, BODY, CONFIG, KEYWORDS, NOW_MS, PERSONA, SCORE_SQL, SIGNALS, TITLE, VERDICT_SQL, hay, query, table

EDGES = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
COLLAPSE = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
MARKS = "[\\s，。、！？·,:;!?–—\"''()（）]+$"


def _truncate_sql(e: str, most: int) -> str:
    """Cut at a word if at least half of the room stays filled, else in a word."""
    bare = f"regexp_replace(left({e}, {most - 1}), '{MARKS}', '')"
    last = f"(length({bare}) - instr(reverse({bare}), ' '))"
    at_word = f"regexp_replace(left({bare}, {last}), '{MARKS}', '')"
    return (
        f"CASE WHEN length({e}) <= {most} THEN {e} ELSE (CASE WHEN contains({bare}, ' ') AND {last} >= {most // 2} THEN {at_word} "
        f"WHEN length({bare}) >= {most // 2} THEN {bare} ELSE left({e}, {most - 1}) END) || '…' END"
    )


def _reason_sql(rows: str, keywords: list[str], signals: list[str], domain: str) -> str:
    """rows (doc_id, title, body) with lang and reason."""
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    head = "left(title || chr(10) || body, 400)"
    return f"""(WITH a AS (SELECT *, {hay("title || ' ' || body")} AS h, {EDGES.format("CASE WHEN title <> '' THEN title ELSE body END")} AS whole,
  CASE WHEN length(regexp_replace({head}, '[^\\x{{3400}}-\\x{{4dbf}}\\x{{4e00}}-\\x{{9fff}}]', '', 'g')) / length({head}) > 0.3 THEN 'zh' ELSE 'en' END AS lang FROM {rows}),
b AS (SELECT *, list_filter({listed(keywords)}, lambda k: contains(h, ' ' || k || ' '))[1:2] AS kw, coalesce(list_filter({listed(signals)}, lambda k: contains(h, ' ' || k || ' '))[1], '') AS sig,
  {COLLAPSE.format(EDGES.format(f"regexp_replace(whole, '{_OUTLET}', '')"))} AS c FROM a),
s AS (SELECT *, trim(CASE WHEN regexp_matches(c, '^[^。！？.!?]*[。！？.!?]') THEN regexp_extract(c, '^[^。！？.!?]*[。！？.!?]') ELSE c END) AS s0 FROM b),
t AS (SELECT *, CASE WHEN length(s0) <= 400 THEN s0 ELSE left(s0, 399) || '…' END AS s1 FROM s),
u AS (SELECT *, {COLLAPSE.format("regexp_replace(" + EDGES.format("regexp_replace(s1, '[。．.!?！？:：,，、\\s…]+$', '')") + ", '\\d+[.,]\\d+', ' ', 'g')")} AS s2 FROM t),
v AS (SELECT *, CASE WHEN s2 = '' THEN '' ELSE {_truncate_sql('s2', 28)} END AS subj, array_to_string(kw, ', ') AS en, array_to_string(list_transform(kw, lambda k: '「' || k || '」'), '') AS zh FROM u)
SELECT doc_id, lang, CASE WHEN lang = 'en' THEN (CASE WHEN len(kw) > 0 AND sig <> '' THEN 'Matches your interests in ' || en || ', with a strong "' || sig || '" signal' WHEN len(kw) > 0 THEN 'Matches your interest in ' || en
    WHEN sig <> '' THEN 'Strong "' || sig || '" signal in {domain}' WHEN subj <> '' THEN 'Picked for ' || subj ELSE 'Related to your {domain} feed' END)
  ELSE (CASE WHEN len(kw) > 0 AND sig <> '' THEN '聚焦你的关注点 ' || zh || '，并出现强信号「' || sig || '」' WHEN len(kw) > 0 THEN '聚焦你的关注点 ' || zh WHEN sig <> '' THEN '出现领域信号「' || sig || '」'
    WHEN subj <> '' THEN '因「' || subj || '」入选' ELSE '与「{domain}」相关' END) END AS reason FROM v)"""


def _why_sql(reason: str, lang: str, domain: str) -> str:
    own = f"""(CASE WHEN {EDGES.format(reason)} <> '' AND NOT regexp_matches({reason}, '\\d\\.\\d') THEN {EDGES.format(reason)} WHEN {lang} = 'en' THEN 'Hand-picked from the {domain} feed by daily' ELSE 'Daily为你挑的深度内容' END)"""
    return _truncate_sql(own, 40)


# --- Reasons ------------------------------------------------------------------------------------------------------------

FEW = ["entre", "trash"], ["para", "ation"]
_TOLD = f"""(SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '要闻' || {TITLE} ELSE {TITLE} END AS title, CASE WHEN doc_id % 3 = 0 THEN repeat('新', 400) || ' ' || {BODY} ELSE {BODY} END AS body FROM documents)"""


@query(f"SELECT doc_id, lang, reason, {_why_sql('reason', 'lang', 'prose 2.0')} AS why FROM {_reason_sql(_TOLD, *FEW, 'prose 2.0')}")
def reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each document is recommended, a third of them made Chinese; a reason that names a domain with a decimal may not be
    shown."""
    items = from_documents(table(spark, sf_dir, "documents"))
    third = F.col("seq") % 3 == 0
    told = items.withColumn("title", F.when(third, F.concat(F.lit("要闻"), "title")).otherwise(F.col("title")))
    told = told.withColumn("body", F.when(third, F.concat(F.repeat(F.lit("新"), 400), F.lit(" "), "body")).otherwise(F.col("body")))
    made = render.with_reason(told, *FEW, "prose 2.0").withColumn("lang", T.detect_lang(F.concat("title", F.lit("\n"), "body")))
    return render.with_why(made, PERSONA.id, PERSONA.display, "prose 2.0").select(F.col("seq").alias("doc_id"), "lang", "reason", "why")


# --- Scores by model ----------------------------------------------------------------------------------------------------


def rating_endpoint(prompts: list[str]) -> list[inference.Answer]:
    """A model that rates by the length of titles: no reply to every seventh first title's batch, fives left out, odd scores for
    others, and every item that it rates rated twice."""
    out: list[inference.Answer] = []
    for prompt in prompts:
        sizes = [len(t) for _, t in re.findall(r"^\[(\d+)\] (.*)$", prompt, re.M)]
        said = [{"index": k, "score": "much" if n % 11 == 0 else n % 13 / 10, "reason": f"rated {n % 13 / 10}" if n % 2 else f"of {n} signs"} for k, n in enumerate(sizes) if n % 5]
        out.append(None if not sizes or sizes[0] % 7 == 0 else json.dumps([{**s, "score": 0.1} for s in said] + said))
    return out


_ESCAPED = "replace(replace(replace({0}, '\\', '\\\\'), '[', '\\['), ']', '\\]')"
_RAW = f"(SELECT doc_id, {TITLE} AS title, {BODY} AS body FROM documents)"


@query(f"""
WITH p AS (SELECT v.doc_id, length({_ESCAPED.format(TITLE)}) AS n, row_number() OVER (ORDER BY v.doc_id) - 1 AS k FROM {VERDICT_SQL} v JOIN documents USING (doc_id) WHERE v IS NULL),
b AS (SELECT *, first_value(n) OVER (PARTITION BY k // 20 ORDER BY k) AS f FROM p),
r AS (SELECT b.doc_id, s.score AS plain, r.reason, r.lang, n, f % 7 <> 0 AS said FROM b JOIN {SCORE_SQL} s USING (doc_id) JOIN {_reason_sql(_RAW, KEYWORDS, SIGNALS, 'prose')} r USING (doc_id)),
m AS (SELECT doc_id, lang, CASE WHEN said AND n % 5 <> 0 THEN (CASE WHEN n % 11 = 0 THEN 0.0 ELSE least(1.0, (n % 13) / 10) END) ELSE plain END AS score,
  CASE WHEN NOT said THEN reason WHEN n % 5 = 0 THEN reason || '（llm 漏答，已降级启发式）' WHEN n % 2 = 1 THEN 'rated ' || (n % 13) // 10 || '.' || (n % 13) % 10 ELSE 'of ' || n || ' signs' END AS reason FROM r)
SELECT doc_id, round(score, 6) AS score, reason, {_why_sql('reason', 'lang', 'prose')} AS why FROM m""")
def model_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A round whose scores a model gives, twenty items to a prompt: what it leaves out, and batches without a reply, are scored by
    words; a reason that shows a score is replaced in the post."""
    none = lambda schema: spark.createDataFrame([], schema)
    settings = {"llm_base_url": "https://m.example", "llm_api_key": "k", "llm_model": "m"}
    plain = scoring.by_words(KEYWORDS, SIGNALS, PERSONA.domain)
    scorer = scoring.chosen(settings, lambda *_: rating_endpoint, plain, inference.task("score", PERSONA.display, PERSONA.domain))
    round_ = plan.Round(PERSONA, CONFIG, tuple(KEYWORDS), tuple(SIGNALS), NOW_MS, "d1")
    candidates, _, _ = plan.collect(from_documents(table(spark, sf_dir, "documents")), round_, none("id string, title string"), none("canonical_url string"), none("source string, weight double"), scorer=scorer)
    # All documents are new, and sources weigh the same: the scores are the model's, but for those of titles told before.
    told = candidates.withColumn("lang", T.detect_lang(F.concat("title", F.lit("\n"), "body")))
    return render.with_why(told, PERSONA.id, PERSONA.display, PERSONA.domain).select(F.col("seq").alias("doc_id"), F.round("score", 6).alias("score"), "reason", "why")


_BLOCK_SQL = f"""'[' || (doc_id_n % 20) || '] ' || replace({_ESCAPED.format('title')}, chr(10), ' ') || chr(10) || replace({_ESCAPED.format('left(body, 600)')}, chr(10), ' ')"""


@query(f"""
WITH d AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS doc_id_n FROM {_RAW}), b AS (SELECT doc_id_n // 20 AS batch, string_agg({_BLOCK_SQL}, chr(10) ORDER BY doc_id) AS items, count(*) AS n FROM d GROUP BY 1)
SELECT CAST(batch AS BIGINT) AS batch, CAST(n AS BIGINT) AS n, CAST(length(items) AS BIGINT) AS chars, sha1(items) AS items_sha1, CAST(n AS BIGINT) AS numbered FROM b""")
def prompt_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as the blocks of a reviewer's prompts: each item on two lines, and no text that looks like another item."""
    items = from_documents(table(spark, sf_dir, "documents"))
    made = inference.prompts(items, "seq", 20, inference.task("review", PERSONA.display, PERSONA.domain))
    own = made.withColumn("items", F.substr("prompt", F.locate("\n\n", F.col("prompt")) + 2))
    numbers = F.regexp_count("items", F.lit("(?m)^\\[\\d+\\] ")).cast("long")
    return own.select("batch", F.size("ids").cast("long").alias("n"), F.length("items").cast("long").alias("chars"), F.sha1("items").alias("items_sha1"), numbers.alias("numbered"))


# --- Relevance by keyword, the board's report, briefs ---------------------------------------------------------------------


@query(f"""SELECT source, CAST(count_if(k) AS BIGINT) AS kept, CAST(count_if(NOT k) AS BIGINT) AS dropped
FROM (SELECT source, contains(h, ' entre ') OR contains(h, ' trash ') AS k FROM (SELECT source, {hay(f"{TITLE} || ' ' || {BODY}")} AS h FROM documents)) GROUP BY source""")
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source that match a keyword, and those that match none."""
    told = gates.by_keyword(from_documents(table(spark, sf_dir, "documents")), FEW[0])
    return told.groupBy("source").agg(F.count_if("relevant").alias("kept"), F.count_if(~F.col("relevant")).alias("dropped"))


_POOL = f"""(SELECT v.doc_id, v.points, d.source, d.lang FROM {VERDICT_SQL} v JOIN documents d USING (doc_id) WHERE v LIKE 'relevance|%'
  AND length(regexp_replace({EDGES.format(TITLE)}, '[^\\p{{L}}\\p{{N}}]', '', 'g')) >= 7 AND ({EDGES.format(BODY)} = '' OR length({EDGES.format(BODY)}) >= 30) ORDER BY points DESC, doc_id LIMIT 60)"""


@query(f"""
WITH pool AS {_POOL}, inc AS (SELECT * FROM pool WHERE doc_id % 2 = 0), pub AS (SELECT doc_id, d.source FROM {VERDICT_SQL} v JOIN documents d USING (doc_id) WHERE v IS NULL UNION ALL SELECT doc_id, source FROM inc),
kinds AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
SELECT 'source' AS part, source AS name, CAST(count(*) AS DOUBLE) AS value FROM pub GROUP BY source
UNION ALL SELECT 'lang', CASE WHEN doc_id % 4 = 0 THEN 'zh' ELSE 'en' END, count(*) FROM pub GROUP BY 2
UNION ALL SELECT 'signals', event_type, n FROM kinds UNION ALL SELECT 'evolution', 'active', CASE WHEN (SELECT count(*) FROM events) > 0 THEN 1 ELSE 0 END
UNION ALL SELECT 'yield', 'published', round((SELECT count(*) FROM pub) / (SELECT count(*) FROM documents), 6)
UNION ALL SELECT 'recall', 'pool', (SELECT count(*) FROM pool) UNION ALL SELECT 'recall', 'included', (SELECT count(*) FROM inc)
UNION ALL SELECT 'recall', 'excluded', (SELECT count(*) FROM pool) - (SELECT count(*) FROM inc)""")
def board_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a round with a wide channel whose judge includes even numbers; every fourth post was written in Chinese."""
    items = from_documents(table(spark, sf_dir, "documents"))
    # Without bodies and hits, which nothing reads after the verdict.
    judged = written(gates.judged(items, PERSONA, CONFIG, NOW_MS, recall=60).drop("body", "hits"), "judged")
    pool = written(gates.recall_pool(judged, 60), "pool")
    included = pool.where("seq % 2 = 0")
    refused = pool.where("seq % 2 <> 0").withColumn("rule", F.lit("recall:excluded"))
    lost = gates.drops(judged, pool).unionByName(gates.drops(refused))
    published = judged.where("rule is null").select("seq", "source").unionByName(included.select("seq", "source"))
    lang = F.when(F.col("seq") % 4 == 0, "zh").otherwise("en")
    signals = table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"))
    made = reports.board_report(published.withColumn("lang", lang), lost, items.agg(F.count("*").alias("n")), signals, pool)
    return made.withColumn("value", F.round("value", 6))


@query("""
SELECT 'daily:d1:' || page_id AS name, url AS why, CAST(1 AS BIGINT) AS n, 'static' AS source FROM pages
UNION ALL SELECT 'brief', NULL, CAST(count_if(page_id % 7 = 0) AS BIGINT), NULL FROM pages HAVING count_if(page_id % 7 = 0) > 0""")
def pack_brief(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a pack, each with its address as the reason: the brief, and the breach of a pack whose brief lacks every seventh."""
    posts = table(spark, sf_dir, "pages").select(F.concat(F.lit("daily:d1:"), F.col("page_id").cast("string")).alias("id"), F.col("url").alias("why"), F.concat(F.lit("https://p.example/"), "page_id").alias("source_url"))
    brief = state.pack_brief(posts)
    broken = state.contract_breaks(posts, brief.where(F.substring_index("post_id", ":", -1).cast("long") % 7 != 0))
    none = F.lit(None).cast("string")
    lines = brief.select(F.col("post_id").alias("name"), "why", F.lit(1).cast("long").alias("n"), "source")
    return lines.unionByName(broken.select(F.col("rule").alias("name"), none.alias("why"), "n", none.alias("source")))
