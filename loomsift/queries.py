"""The registered queries over the driver's tables, each with DuckDB SQL for the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomsift.functions import text as T
from loomsift.functions.urls import TRACKING, TRACKING_PREFIXES, canonical_url
from loomsift.lineage import small_methods, written
from loomsift.operators import dedupe, events, gates, learning, render, reports, similarity, state
from loomsift.operators.gates import GateConfig, Persona, Rule, Tier
from loomsift.operators.order import numbered
from loomsift.operators.items import from_documents, from_events, from_pages, title_of
from loomsift.streaming import rounds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The configuration of the queries: words of the tables' own vocabulary.
CONFIG = GateConfig(
    min_title_chars=15,
    min_points=3,
    strong_words=("trash", "token"),
    tiers=(Tier("core", 3, ("thing", "schauen", "entre", "para")), Tier("ecosystem", 1, ("the", "der", "que", "erin")), Tier("generic", 0, ("and",))),
    blacklist=(Rule("spam:shout", "!!\\s", scope="both", group="spam"), Rule("spam:table", "\\s\\|\\s", scope="title", group="spam"), Rule("license", "all rights reserved|licensed under", unless_strong=True)),
    stopwords=("the", "and", "der", "les", "las"),
)
PERSONA = Persona("daily", tuple(f"src{k}" for k in range(19)), reject=(Rule("insult", "\\bidiot\\b|\\bmoron\\b"),), display="Daily", domain="prose")
KEYWORDS, SIGNALS = ["the", "der", "que", "thing", "entre", "nicht", "para"], ["first", "only", "heen", "ation"]
NOW_MS = 1_706_745_600_000  # 2024-02-01, after the last event

# SQL fragments.
TITLE = "split_part(text, chr(10), 1)"
BODY = f"substr(text, length({TITLE}) + 2)"
norm = lambda e: rf"trim(regexp_replace(regexp_replace(lower({e}), 'https?://\S+', ' ', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
toks = lambda e: f"list_distinct(list_filter(string_split({norm(e)}, ' '), lambda x: length(x) > 1))"
hay = lambda e: f"' ' || {norm(e)} || ' '"
quoted = lambda words: ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_documents(table(spark, sf_dir, "documents"))


# --- Text ---------------------------------------------------------------------------------------------------------------


@query(f"""
WITH d AS (SELECT *, sha1({norm(f"{TITLE} || ' ' || {BODY}")}) AS h FROM documents)
SELECT source, CAST(count(*) AS BIGINT) AS docs, CAST(count_if(doc_id = first) AS BIGINT) AS kept
FROM d JOIN (SELECT h, min(doc_id) AS first FROM d GROUP BY h) USING (h) GROUP BY source""")
def docs_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source, and those left after first-wins deduplication by content hash."""
    items = documents(spark, sf_dir).withColumn("hash", T.content_hash(F.col("title"), F.col("body")))
    kept = dedupe.first_wins(items, "hash").groupBy("source").agg(F.count("*").alias("kept"))
    return items.groupBy("source").agg(F.count("*").alias("docs")).join(kept, "source", "left").na.fill(0, ["kept"])


@query(f"SELECT doc_id, CAST(length({norm('text')}) AS BIGINT) AS norm_chars, sha1({norm('text')}) AS norm_sha1 FROM documents")
def doc_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = T.normalize(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.length(n).cast("long").alias("norm_chars"), F.sha1(n).alias("norm_sha1"))


@query(f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, sha1(array_to_string(list_sort(t), ' ')) AS tokens_sha1 FROM (SELECT doc_id, {toks('text')} AS t FROM documents)")
def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "documents").select("doc_id", F.sort_array(T.tokens(F.col("text"))).alias("t"))
    return made.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.sha1(F.array_join("t", " ")).alias("tokens_sha1"))


@query(f"""
WITH d AS (SELECT doc_id, sha1({norm(f"{TITLE} || ' ' || {BODY}")}) AS content_hash FROM documents)
SELECT min(doc_id) AS doc_id, content_hash FROM d GROUP BY content_hash""")
def doc_hash_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = documents(spark, sf_dir).withColumn("content_hash", T.content_hash(F.col("title"), F.col("body")))
    return dedupe.first_wins(items, "content_hash").select(F.col("seq").alias("doc_id"), "content_hash")


@query(r"""
SELECT doc_id, CASE WHEN length(left(text, 400)) > 0 AND length(regexp_replace(left(text, 400), '[^\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}]', '', 'g')) / length(left(text, 400)) > 0.3
  THEN 'zh' ELSE 'en' END AS script FROM documents""")
def detect_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.detect_lang(F.col("text")).alias("script"))


@query(r"""
WITH c AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents),
s AS (SELECT doc_id, trim(CASE WHEN regexp_matches(t, '^[^。！？.!?]*[。！？.!?]') THEN regexp_extract(t, '^[^。！？.!?]*[。！？.!?]') ELSE t END) AS s FROM c)
SELECT doc_id, CASE WHEN length(s) <= 95 THEN s ELSE left(s, 94) || '…' END AS sentence FROM s""")
def first_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.first_sentence(F.col("text"), 95).alias("sentence"))


@query(r"""
WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '([。！？])\s*', '\1' || chr(1), 'g'), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
  lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) >= 12) AS s FROM documents)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, sha1(array_to_string(s, '|')) AS sentences_sha1 FROM s""")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "documents").select("doc_id", T.split_sentences(F.col("text")).alias("s"))
    return made.select("doc_id", F.size("s").cast("long").alias("n_sentences"), F.sha1(F.array_join("s", "|")).alias("sentences_sha1"))


def _strip_html_sql(e: str) -> str:
    for pattern, by in (
        ("(?i)<style[\\s\\S]*?</style>", " "), ("(?i)<script[\\s\\S]*?</script>", " "), ("<[^>]+>", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#0?39;|&apos;", "''"),
        ("&nbsp;", " "), ("<[^>]+>", " "), ("\\s+", " "),
    ):
        e = f"regexp_replace({e}, '{pattern}', '{by}', 'g')"
    return f"trim({e})"


@query(f"SELECT page_id, CAST(length(t) AS BIGINT) AS chars, sha1(t) AS text_sha1 FROM (SELECT page_id, {_strip_html_sql('html')} AS t FROM pages)")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.strip_html(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.length(t).cast("long").alias("chars"), F.sha1(t).alias("text_sha1"))


@query(r"SELECT page_id, regexp_matches(html, '(?i)</?[a-z][a-z0-9-]*(?:\s[^<>]*)?>') AS leaks, regexp_matches(url, '(?i)^https?://[^/]') AS safe_link FROM pages")
def html_leak(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomsift.functions.urls import is_safe_link

    return table(spark, sf_dir, "pages").select("page_id", F.col("html").rlike("(?i)</?[a-z][a-z0-9-]*(?:\\s[^<>]*)?>").alias("leaks"), is_safe_link(F.col("url")).alias("safe_link"))


# --- URLs and deduplication --------------------------------------------------------------------------------------------


CANON_SQL = rf"""(SELECT *, lower(regexp_extract(url, '^([a-zA-Z]+)://', 1)) || '://' || regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)), '^www\.', '')
  || (CASE WHEN regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1), '/+$', '') = '' THEN '/' ELSE regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1), '/+$', '') END)
  || (CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_sort(q), '&') ELSE '' END) AS canonical_url
  FROM (SELECT *, list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT list_contains([{quoted(TRACKING)}], split_part(p, '=', 1))
    AND NOT regexp_matches(p, '^({"|".join(x.replace(".", "[.]") for x in TRACKING_PREFIXES)})')) AS q FROM pages))"""


@query(f"SELECT page_id, canonical_url, 'u-' || left(sha1(canonical_url), 20) AS item_id FROM {CANON_SQL}")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("canonical_url", canonical_url(F.col("url")))
    return pages.select("page_id", "canonical_url", T.item_id(F.col("canonical_url"), F.lit(""), F.col("html")).alias("item_id"))


@query(f"""
WITH c AS {CANON_SQL}, f AS (SELECT canonical_url, min(page_id) AS first FROM c GROUP BY 1), k AS (SELECT DISTINCT canonical_url FROM c WHERE contains(url, 'utm_source'))
SELECT page_id, CASE WHEN canonical_url IN (SELECT canonical_url FROM k) THEN 'fingerprint:alreadyPublished' WHEN first < page_id THEN 'fingerprint:duplicateUrlInBatch' END AS rule
FROM c JOIN f USING (canonical_url)""")
def url_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by canonical url against a published set: the urls that came with a campaign's mark."""
    pages = table(spark, sf_dir, "pages")
    known = pages.where(F.contains("url", F.lit("utm_source"))).select(canonical_url(F.col("url")).alias("canonical_url"))
    return dedupe.by_canonical_url(pages, known, order="page_id").select("page_id", "rule")


@query(f"""
WITH c AS {CANON_SQL}, n AS (SELECT canonical_url, min(page_id) AS seq FROM c GROUP BY 1)
SELECT canonical_url, seq FROM n ORDER BY seq DESC LIMIT 20000""")
def fingerprint_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 20,000 canonical urls by first appearance: the store's own bound."""
    pages = table(spark, sf_dir, "pages").withColumn("seq", F.col("page_id"))
    empty = spark.createDataFrame([], "canonical_url string, seq long")
    return dedupe.fingerprints_appended(empty, pages)


@query(f"""
WITH c AS {CANON_SQL}, a AS (SELECT DISTINCT canonical_url FROM c WHERE starts_with(url, 'http:')), b AS (SELECT DISTINCT canonical_url FROM c WHERE contains(url, '?'))
SELECT canonical_url, CASE WHEN a IS NULL THEN 'added' WHEN b IS NULL THEN 'removed' ELSE 'kept' END AS state
FROM (SELECT canonical_url, true AS a FROM a) FULL JOIN (SELECT canonical_url, true AS b FROM b) USING (canonical_url)""")
def pack_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("canonical_url", canonical_url(F.col("url")))
    return dedupe.set_diff(pages.where(F.startswith("url", F.lit("http:"))), pages.where(F.contains("url", F.lit("?"))), "canonical_url")


@query(f"SELECT canonical_url, CAST(count(*) AS BIGINT) AS n FROM {CANON_SQL} GROUP BY 1 HAVING count(*) > 1")
def url_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicates(table(spark, sf_dir, "pages").withColumn("canonical_url", canonical_url(F.col("url"))), "canonical_url")


# --- Gates --------------------------------------------------------------------------------------------------------------


def _points_sql() -> str:
    terms, hits = [], []
    for tier in CONFIG.tiers:
        for w in tier.words:
            body = gates.BODY_POINTS[tier.tier]
            terms.append(f"(CASE WHEN contains(th, ' {w} ') THEN {tier.points} WHEN contains(bh, ' {w} ') THEN {body} ELSE 0 END)")
            hits.append(f"(CASE WHEN contains(th, ' {w} ') OR contains(bh, ' {w} ') THEN 1 ELSE 0 END)")
    return f"(SELECT *, {' + '.join(terms)} AS points, {' + '.join(hits)} AS n_hits FROM (SELECT *, {TITLE} AS title, {BODY} AS body, {hay(TITLE)} AS th, {hay(BODY)} AS bh FROM documents))"


VERDICT_SQL = rf"""(SELECT doc_id, source, points, CASE
    WHEN source NOT IN ({quoted(PERSONA.sources)}) THEN 'persona|persona:sourceNotWhitelisted'
    WHEN regexp_matches(title || chr(10) || body, '(?i)(^|[^A-Za-z0-9_\x{{80}}-\x{{ffff}}])(idiot|moron)($|[^A-Za-z0-9_\x{{80}}-\x{{ffff}}])') THEN 'persona|persona:reject:insult'
    WHEN regexp_matches(title, '(?i)\[object Object\]') OR regexp_matches(body, '(?i)\[object Object\]') THEN 'blacklist|damaged:objectObject'
    WHEN length(regexp_replace(title, '^\s+|\s+$', '', 'g')) < 15 THEN 'blacklist|damaged:titleTooShort'
    WHEN regexp_matches(title || chr(10) || body, '!!\s') THEN 'blacklist|spam:shout'
    WHEN regexp_matches(title, '\s\|\s') THEN 'blacklist|spam:table'
    WHEN regexp_matches(title || chr(10) || body, '(?i)all rights reserved|licensed under') AND NOT (contains(wh, ' trash ') OR contains(wh, ' token ')) THEN 'blacklist|license'
    WHEN points < 3 THEN 'relevance|relevance:belowMinPoints(' || points || '<3)' END AS v
  FROM (SELECT *, {hay("title || ' ' || body")} AS wh FROM {_points_sql()}))"""


@query(f"SELECT doc_id, CAST(points AS BIGINT) AS points, CAST(n_hits AS BIGINT) AS n_hits FROM {_points_sql()}")
def keyword_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = gates.with_relevance(documents(spark, sf_dir), CONFIG)
    return scored.select(F.col("seq").alias("doc_id"), F.col("points").cast("long").alias("points"), F.size("hits").cast("long").alias("n_hits"))


@query(f"SELECT doc_id, split_part(v, '|', 1) AS gate, split_part(v, '|', 2) AS rule FROM {VERDICT_SQL} WHERE v IS NOT NULL")
def gate_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop records: the first failing rule of each dropped document."""
    judged = gates.judged(documents(spark, sf_dir), PERSONA, CONFIG, NOW_MS)
    return gates.drops(judged).select(F.col("seq").alias("doc_id"), "gate", "rule")


@query(f"""SELECT split_part(v, '|', 1) AS gate, split_part(v, '|', 2) AS rule, CAST(count(*) AS BIGINT) AS n, CAST(min(doc_id) AS BIGINT) AS first_seq
FROM {VERDICT_SQL} WHERE v IS NOT NULL GROUP BY v""")
def gate_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.funnel(gates.drops(gates.judged(documents(spark, sf_dir), PERSONA, CONFIG, NOW_MS)))


@query(rf"""
WITH r AS (SELECT v.doc_id, v.points FROM {VERDICT_SQL} v JOIN documents d USING (doc_id) WHERE v LIKE 'relevance|%'
  AND length(regexp_replace(regexp_replace({TITLE}, '^\s+|\s+$', '', 'g'), '[^\p{{L}}\p{{N}}]', '', 'g')) >= 7
  AND (regexp_replace({BODY}, '^\s+|\s+$', '', 'g') = '' OR length(regexp_replace({BODY}, '^\s+|\s+$', '', 'g')) >= 30))
SELECT doc_id, CAST(points AS BIGINT) AS points FROM r ORDER BY points DESC, doc_id LIMIT 20""")
def recall_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool of the wide channel, a top-k report: those that fail on relevance alone, most points first."""
    judged = gates.judged(documents(spark, sf_dir), PERSONA, CONFIG, NOW_MS, recall=20)
    return gates.recall_pool(judged, 20).select(F.col("seq").alias("doc_id"), F.col("points").cast("long").alias("points"))


@query(f"""SELECT event_type AS source, CAST(count(*) AS BIGINT) AS fetched, CAST(count_if({NOW_MS} - (epoch_us(ts) // 1000) > 360 * 3600000) AS BIGINT) AS stale FROM events GROUP BY 1""")
def stale_prescreen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gates.prescreened(from_events(table(spark, sf_dir, "events")), 360, NOW_MS)
    return rows.groupBy("source").agg(F.count("*").alias("fetched"), F.count_if("stale").alias("stale"))


# --- Scores and metrics -----------------------------------------------------------------------------------------------


def _hits_sql(words: list[str]) -> str:
    return " + ".join(f"(CASE WHEN contains(h, ' {w} ') THEN 1 ELSE 0 END)" for w in words)


SCORE_SQL = f"""(SELECT doc_id, source, 0.25 + 0.5 * least(1.0, sqrt({_hits_sql(KEYWORDS)}) / sqrt(8.0)) + 0.25 * least(1.0, sqrt({_hits_sql(SIGNALS)}) / sqrt(6.0)) AS score
  FROM (SELECT *, {hay(f"{TITLE} || ' ' || {BODY}")} AS h FROM documents))"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.with_score(documents(spark, sf_dir), KEYWORDS, SIGNALS)


@query(f"SELECT doc_id, round(score, 6) AS score FROM {SCORE_SQL}")
def heuristic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select(F.col("seq").alias("doc_id"), F.round("score", 6).alias("score"))


@query(f"""
WITH w AS (SELECT source, least(1.0, 0.3 + count(*) / 1000.0) AS weight FROM documents WHERE lang = 'en' GROUP BY 1), new AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY text)
SELECT doc_id, round(score * (0.5 + coalesce(weight, 0.5)) * (CASE WHEN doc_id IN (SELECT doc_id FROM new) THEN 1 ELSE 0.75 END), 6) AS rank_score
FROM {SCORE_SQL} LEFT JOIN w USING (source)""")
def rank_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = docs.where("lang = 'en'").groupBy("source").agg(F.least(F.lit(1.0), 0.3 + F.count("*") / 1000.0).alias("weight"))
    new = docs.groupBy("text").agg(F.min("doc_id").alias("seq")).select("seq", F.lit(True).alias("is_new"))
    items = scored(spark, sf_dir).join(new, "seq", "left").withColumn("is_new", F.coalesce("is_new", F.lit(False)))
    return learning.weighted(items, weights).select(F.col("seq").alias("doc_id"), F.round("rank_score", 6).alias("rank_score"))


@query("""
WITH o AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS k, count(*) OVER () AS n FROM events WHERE value IS NOT NULL)
SELECT round(max(CASE WHEN k = least(n - 1, floor(0.5 * n)) THEN value END), 6) AS p50, round(max(CASE WHEN k = least(n - 1, floor(0.9 * n)) THEN value END), 6) AS p90,
  round(max(value), 6) AS top1, round(avg(value), 6) AS mean FROM o""")
def round_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = table(spark, sf_dir, "events")
    found = learning.quantiles(values, "value", [0.5, 0.9])
    both = found.agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n) for q, n in ((0.5, "p50"), (0.9, "p90"))])
    rest = values.agg(F.max("value").alias("top1"), F.avg("value").alias("mean"))
    row = both.crossJoin(rest)  # of one row each
    return row.select(*[F.round(c, 6).alias(c) for c in ("p50", "p90", "top1", "mean")])


@query(f"""
WITH r AS (SELECT doc_id, source, text, v FROM {VERDICT_SQL} JOIN documents USING (doc_id, source)), f AS (SELECT text, min(doc_id) AS first FROM documents GROUP BY 1)
SELECT source, CAST(count(*) AS BIGINT) AS fetched, CAST(count_if(doc_id = first) AS BIGINT) AS after_dedupe, CAST(count_if(doc_id = first AND v IS NULL) AS BIGINT) AS after_filter,
  count_if(doc_id = first) > 0 AND count_if(doc_id = first AND v IS NULL) = 0 AS zero_yield, false AS empty_yield
FROM r JOIN f USING (text) GROUP BY source
UNION ALL SELECT 'src-none', 0, 0, 0, false, true""")
def source_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each enabled source brought and kept; one enabled source has nothing."""
    judged = gates.judged(documents(spark, sf_dir), PERSONA, CONFIG, NOW_MS)
    first = table(spark, sf_dir, "documents").groupBy("text").agg(F.min("doc_id").alias("seq")).select("seq", F.lit(True).alias("first"))
    rows = judged.join(first, "seq", "left").select("source", F.coalesce("first", F.lit(False)).alias("first"), F.col("rule").isNull().alias("passed"))
    enabled = table(spark, sf_dir, "documents").select("source").distinct().union(spark.createDataFrame([("src-none",)], "source string"))
    return learning.source_yield(enabled, rows)


# --- Similarity -----------------------------------------------------------------------------------------------------


@query(f"""
WITH t AS (SELECT doc_id, lang, {toks(TITLE)} AS t FROM documents), a AS (SELECT t FROM t WHERE lang <> 'en'), n AS (SELECT doc_id, t FROM t WHERE lang = 'en')
SELECT doc_id, NOT EXISTS (SELECT 1 FROM a WHERE len(list_intersect(a.t, n.t)) / greatest(1, len(a.t) + len(n.t) - len(list_intersect(a.t, n.t))) >= 0.7) AS is_new FROM n""")
def novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English titles against an archive of the others: new if none is alike."""
    items = table(spark, sf_dir, "documents")
    titled = items.select(F.col("doc_id").alias("id"), "lang", T.tokens(title_of(F.col("text"))).alias("tokens"))
    found = similarity.novel(titled.where("lang = 'en'"), titled.where("lang <> 'en'"))
    return found.select(F.col("id").alias("doc_id"), "is_new")


@query("""
WITH c AS (SELECT label, list(s ORDER BY k) AS c FROM (SELECT label, k, sum(v) AS s FROM (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS k FROM embeddings) GROUP BY 1, 2) GROUP BY 1)
SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], c), 5) AS cosine, len(embedding) = 64 AS valid FROM embeddings JOIN c USING (label)""")
def label_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's cosine with the sum of its label's vectors, and whether it is a sound embedding."""
    vectors = table(spark, sf_dir, "embeddings")
    sums = vectors.select("label", F.posexplode("embedding").alias("k", "v")).groupBy("label", "k").agg(F.sum(F.col("v").cast("double")).alias("s"))
    centre = sums.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "s"))), lambda x: x["s"]).alias("c"))
    both = vectors.join(centre, "label")
    cosine = similarity.dot(similarity.normalized(F.col("embedding")), similarity.normalized(F.col("c")))
    return both.select("vec_id", F.round(cosine, 5).alias("cosine"), similarity.is_valid_embedding(F.col("embedding"), 64).alias("valid"))


@query(f"""
WITH RECURSIVE t AS (SELECT doc_id, {toks(TITLE)} AS t FROM documents), w AS (SELECT doc_id, len(t) AS n, unnest(t) AS w FROM t),
p AS (SELECT a.doc_id AS l, b.doc_id AS r FROM w a JOIN w b ON a.w = b.w AND b.doc_id < a.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) / (a.n + b.n - count(*)) >= 0.5),
o AS (SELECT l, list(r ORDER BY r) AS near, row_number() OVER (ORDER BY l) AS k FROM p GROUP BY l), late AS (SELECT list(l) AS ids FROM o),
s AS (SELECT CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS l, CAST(NULL AS BIGINT) AS leader, CAST([] AS BIGINT[]) AS led
  UNION ALL SELECT k, l, coalesce(found, l), CASE WHEN found IS NULL THEN led ELSE list_append(led, l) END FROM (
    SELECT o.k, o.l, s.led, list_min(list_filter(o.near, lambda r: NOT list_contains(s.led, r))) AS found FROM s JOIN o ON o.k = s.k + 1))
SELECT doc_id, coalesce(leader, doc_id) AS leader FROM documents LEFT JOIN s ON l = doc_id""")
def leader_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles joined, in order, to the first leader they are like. Sequential by definition; tested against the loop."""
    titled = documents(spark, sf_dir).select(F.col("seq").alias("pos"), T.tokens(F.col("title")).alias("tokens"))
    found = similarity.greedy_leaders(titled, 0.5)
    return found.select(F.col("pos").alias("doc_id"), "leader")


# --- Events ------------------------------------------------------------------------------------------------------------

_OUTLET = r"\s+[-–—|]\s+[A-Z][A-Za-z0-9.''’&]*(?:\s+[A-Z][A-Za-z0-9.''’&]*){0,3}\s*$"


def _entities_sql(title: str) -> str:
    found = f"regexp_extract_all({title}, '[A-Z][A-Za-z0-9''’-]*')"
    caps = f"list_concat(list_transform({found}, lambda w: regexp_replace(lower(w), '[^a-z0-9]', '', 'g')), flatten(list_transform({found}, lambda w: regexp_split_to_array(lower(w), '[^a-z0-9]+'))))"
    long = f"list_filter({toks(title)}, lambda x: length(x) >= 3 AND NOT list_contains([{quoted(CONFIG.stopwords)}], x))"
    runs = f"list_filter(flatten(list_transform({long}, lambda x: regexp_extract_all(x, '[a-z0-9]{{3,}}'))), lambda x: NOT list_contains([{quoted(CONFIG.stopwords)}], x))"
    return f"list_distinct(list_filter(list_concat({long}, {runs}), lambda x: length(x) >= 3 AND list_contains({caps}, x)))"


ENTITY_SQL = rf"""
e AS (SELECT doc_id, title, CASE WHEN len(a) = 0 AND bare <> title THEN b ELSE a END AS ents FROM
  (SELECT *, {_entities_sql('bare')} AS a, {_entities_sql('title')} AS b FROM (SELECT *, regexp_replace(regexp_replace(title, '{_OUTLET}', ''), '^\s+|\s+$', '', 'g') AS bare FROM (SELECT doc_id, {TITLE} AS title FROM documents)))),
w AS (SELECT doc_id, unnest(ents) AS token FROM e),
df AS (SELECT token, count(*) AS df, min(doc_id) AS first FROM w GROUP BY 1 HAVING count(*) <= (SELECT greatest(20, 0.02 * count(*)) FROM documents)),
g AS (SELECT DISTINCT doc_id AS x, first AS y FROM w JOIN df USING (token) WHERE doc_id <> first)"""
COMPONENT_SQL = f"""WITH RECURSIVE {ENTITY_SQL}, b AS (SELECT x, y FROM g UNION SELECT y, x FROM g),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, b.y FROM reach r JOIN b ON r.y = b.x),
k AS (SELECT x AS doc_id, min(y) AS event_key FROM reach GROUP BY 1)"""


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = documents(spark, sf_dir).withColumn("pos", F.col("seq"))
    return events.event_keys(items, CONFIG)


@query(f"{COMPONENT_SQL} SELECT doc_id, CAST(event_key AS VARCHAR) AS event_key FROM k")
def event_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(spark, sf_dir).select(F.col("seq").alias("doc_id"), "event_key")


CAPPED_SQL = f"""{COMPONENT_SQL}, t AS (SELECT k.doc_id, event_key, {toks("e.title")} AS t FROM k JOIN e USING (doc_id)),
r AS (SELECT t.doc_id, t.event_key, t.doc_id <> t.event_key AND len(list_intersect(t.t, l.t)) / greatest(1, len(t.t) + len(l.t) - len(list_intersect(t.t, l.t))) >= 0.75 AS repost FROM t JOIN t l ON l.doc_id = t.event_key),
c AS (SELECT *, NOT repost AND sum(CASE WHEN repost THEN 0 ELSE 1 END) OVER (PARTITION BY event_key ORDER BY doc_id) <= 2 AS kept FROM r)"""


@query(f"{CAPPED_SQL} SELECT doc_id, repost, kept FROM c")
def cap_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.capped_events(clustered(spark, sf_dir), CONFIG).select(F.col("seq").alias("doc_id"), "repost", "kept")


@query(f"""{COMPONENT_SQL}, p AS (SELECT doc_id, event_key, v IS NULL AS passed FROM k JOIN {VERDICT_SQL} USING (doc_id)),
s AS (SELECT *, passed AND sum(passed::INT) OVER (PARTITION BY event_key ORDER BY doc_id) <= 2 AS prim FROM p),
u AS (SELECT *, sum(prim::INT) OVER (ORDER BY doc_id) AS cum FROM s),
l AS (SELECT min(doc_id) AS last FROM u WHERE cum >= 40),
f AS (SELECT doc_id FROM u WHERE passed AND NOT prim AND (SELECT last FROM l) IS NULL ORDER BY doc_id LIMIT (SELECT greatest(0, 40 - max(cum)) FROM u))
SELECT doc_id, CASE WHEN doc_id > (SELECT last FROM l) THEN 'unread' WHEN NOT passed THEN 'rejected' WHEN prim THEN 'accepted' WHEN doc_id IN (SELECT doc_id FROM f) THEN 'filled' ELSE 'deferred' END AS state FROM u""")
def select_diverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 40 posts of a round, at most two of an event; the state of every candidate."""
    judged = gates.judged(clustered(spark, sf_dir), PERSONA, CONFIG, NOW_MS)
    posts = judged.select("id", "pos", "event_key", F.col("rule").isNull().alias("passed"), F.col("seq").alias("doc_id"))
    return events.selected(written(posts, "diverse-posts"), 40).select("doc_id", "state")  # read five times


_RANKED = f"""ranked AS (SELECT row_number() OVER (ORDER BY round(s.score, 9) DESC, d.doc_id) - 1 AS doc_id, d.doc_id AS orig, d.text FROM documents d JOIN {SCORE_SQL} s USING (doc_id))"""


@query(f"""WITH RECURSIVE {_RANKED}, {CAPPED_SQL.removeprefix("WITH RECURSIVE ").replace("documents", "ranked")}
SELECT r.orig AS doc_id, CAST(k.orig AS VARCHAR) AS event_key, repost, kept FROM c JOIN ranked r ON r.doc_id = c.doc_id JOIN ranked k ON k.doc_id = c.event_key""")
def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in order of score, as a round forms them: the best document names its event, and the two best are kept."""
    ranked = numbered(scored(spark, sf_dir), F.round("score", 9).desc(), F.col("seq").asc()).withColumnRenamed("n", "pos")
    keyed = events.event_keys(ranked, CONFIG)
    return events.capped_events(keyed, CONFIG).select(F.col("seq").alias("doc_id"), "event_key", "repost", "kept")


@query("""SELECT doc_id, quality = 0 AS demoted, CAST(row_number() OVER (ORDER BY quality = 0, doc_id) - 1 AS BIGINT) AS pos FROM labels""")
def reviewed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with those of low quality last: the stable partition by a reviewer's bar."""
    rows = table(spark, sf_dir, "labels").select("doc_id", F.col("doc_id").alias("pos"), F.col("quality").alias("review"))
    return events.by_bar(rows, 1).select("doc_id", "demoted", "pos")


@query(f"""{COMPONENT_SQL}, n AS (SELECT event_key, count(*) AS n FROM k GROUP BY 1)
SELECT CAST(event_key AS VARCHAR) AS event_key, {TITLE} AS title, CASE WHEN n > 1 THEN lang || ' (' || (n - 1) || ' more)' ELSE lang END AS summary, CAST(n AS BIGINT) AS size FROM n JOIN documents d ON d.doc_id = n.event_key""")
def event_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A card for each event: its first title, and how many more documents it has."""
    members = clustered(spark, sf_dir).join(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.col("lang").alias("summary")), "seq")
    return events.cluster_cards(members)


@query("SELECT doc_id FROM documents WHERE lang = 'fr' AND doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY n_chars DESC, doc_id LIMIT 30")
def backfill_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 30 longest French documents without a label, a top-k report: a pool that fills up a round."""
    pool = table(spark, sf_dir, "documents").where("lang = 'fr'").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("score"), F.col("doc_id").alias("pos"))
    return events.backfill(pool, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")), 30).select(F.col("id").alias("doc_id"))


@query("""WITH a AS (SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) AS pos FROM labels), b AS (SELECT doc_id AS id, row_number() OVER (ORDER BY quality DESC, doc_id) AS pos FROM labels)
SELECT CAST(pos AS BIGINT) - 1 AS pos, a.id AS target, b.id AS staged FROM a FULL JOIN b USING (pos) WHERE a.id IS DISTINCT FROM b.id""")
def job_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the labels in order of id and the labels in order of quality have different documents."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    place = lambda *o: numbered(labels, *o).select(F.col("n").alias("pos"), "id")
    return events.misaligned(place(F.col("id").asc()), place(F.col("quality").desc(), F.col("id").asc()))


# --- Learning ---------------------------------------------------------------------------------------------------------

FEEDBACK_SQL = "(SELECT event_id AS seq, 'src' || (user_id % 12) AS source, CASE event_type WHEN 'purchase' THEN 'up' WHEN 'error' THEN 'down' END AS signal, user_id, ts FROM events)"


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as reader feedback: purchases are likes, errors dislikes; twelve sources by user."""
    source = F.concat(F.lit("src"), (F.col("user_id") % 12).cast("string"))
    signal = F.when(F.col("event_type") == "purchase", "up").when(F.col("event_type") == "error", "down")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), source.alias("source"), signal.alias("signal"), "user_id", "ts")


@query(f"""SELECT source, CAST(count_if(signal = 'up') AS BIGINT) AS up, CAST(count_if(signal = 'down') AS BIGINT) AS down,
  round(least(1.0, greatest(0.0, 0.8 * 0.6 + 0.2 * (count_if(signal = 'up') + 1.0) / (count_if(signal = 'up') + count_if(signal = 'down') + 2.0))), 6) AS weight FROM {FEEDBACK_SQL} GROUP BY source""")
def feedback_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = learning.feedback_by_source(feedback(spark, sf_dir).where("signal is not null"))
    weights = feedback(spark, sf_dir).select("source").distinct().withColumn("weight", F.lit(0.6))
    new = learning.updated_weights(weights, stats)
    return new.join(stats, "source", "left").na.fill(0, ["up", "down"]).select("source", "up", "down", F.round("weight", 6).alias("weight"))


@query("""SELECT 'src' || (user_id % 12) AS source, CAST(count(*) AS BIGINT) AS exposures, CAST(count_if(event_type IN ('click', 'view')) AS BIGINT) AS expands,
  round((count_if(event_type IN ('click', 'view')) + 1.0) / (count(*) + 3.0), 6) AS interest FROM events GROUP BY 1""")
def interest_posterior(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.concat(F.lit("src"), (F.col("user_id") % 12).cast("string"))
    counts = table(spark, sf_dir, "events").groupBy(source.alias("source")).agg(F.count("*").alias("exposures"), F.count_if(F.col("event_type").isin("click", "view")).alias("expands"))
    return learning.interest(counts).withColumn("interest", F.round("interest", 6))


@query(f"""
WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, min(event_id) AS event_id, max((epoch_us(ts) // 1000)) AS seen FROM events GROUP BY 1, 2),
o AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click'), d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'error')
SELECT 'd' || user_id AS digest_id, CAST(date_diff('day', DATE '2024-01-01', day) AS INT) AS "index", (user_id, day) NOT IN (SELECT (user_id, day) FROM o) AS counted
FROM s WHERE seen + 86400000 <= {NOW_MS} - 5 * 86400000 AND (user_id, day) NOT IN (SELECT (user_id, day) FROM d)""")
def exposure_settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader's day is a digest entry: opened by a click, settled before if it saw an error, due a day after its last event."""
    rows = table(spark, sf_dir, "events").withColumn("digest_id", F.concat(F.lit("d"), F.col("user_id").cast("string")))
    rows = rows.withColumn("index", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")))
    shown = rows.groupBy("digest_id", "index").agg(F.max(F.unix_millis(F.col("ts").cast("timestamp"))).alias("at"), F.lit("s").alias("source"))
    done = learning.settled(shown, rows.where("event_type = 'click'"), rows.where("event_type = 'error'"), NOW_MS - 5 * 86_400_000)
    return done.select("digest_id", "index", "counted")


GOLD_SQL = f"""(SELECT l.doc_id, quality * 9 AS human_score, CASE WHEN quality = 1 THEN 'keep' ELSE 'reject' END AS human_decision,
  CASE WHEN lang <> 'es' THEN CAST(floor(score * 10) AS INT) END AS score, CASE WHEN lang <> 'es' THEN CASE WHEN score >= 0.6 THEN 'keep' ELSE 'reject' END END AS decision
  FROM labels l JOIN documents d USING (doc_id) JOIN {SCORE_SQL} s ON s.doc_id = l.doc_id)"""
_BUCKET = "CASE WHEN {0} <= 2 THEN '0-2' WHEN {0} <= 4 THEN '3-4' WHEN {0} <= 6 THEN '5-6' ELSE '7-10' END"


def gold_and_verdicts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Quality labels as human scores, the heuristic score as the verdict; texts in one language have none."""
    labels = table(spark, sf_dir, "labels")
    gold = labels.select(F.col("doc_id").alias("id"), (F.col("quality") * 9).alias("human_score"), F.when(F.col("quality") == 1, "keep").otherwise("reject").alias("human_decision"))
    docs = table(spark, sf_dir, "documents").where("lang <> 'es'").join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    judged = learning.with_score(from_documents(docs), KEYWORDS, SIGNALS)
    return gold, judged.select(F.col("seq").alias("id"), F.floor(F.col("score") * 10).cast("int").alias("score"), F.when(F.col("score") >= 0.6, "keep").otherwise("reject").alias("decision"))


@query(f"""
WITH g AS (SELECT *, {_BUCKET.format("score")} AS b, {_BUCKET.format("human_score")} AS hb FROM {GOLD_SQL}),
t AS (SELECT max(n) AS most, count(*) AS buckets FROM (SELECT b, count(*) AS n FROM g WHERE score IS NOT NULL GROUP BY b)),
r AS (SELECT count(*) AS n, count(score) AS judged, count_if(decision = human_decision) / count(*) AS agreement, count_if(score IS NULL) / count(*) AS missing, stddev_pop(score) AS spread, count_if(score IS NOT NULL AND b = hb) AS same_bucket FROM g)
SELECT CAST(n AS BIGINT) AS n, CAST(judged AS BIGINT) AS judged, round(agreement, 6) AS agreement, round(missing, 6) AS missing, round(spread, 6) AS spread, CAST(same_bucket AS BIGINT) AS same_bucket,
  CAST(buckets AS BIGINT) AS buckets, round(most / judged, 6) AS saturation, buckets >= 3 AND most / judged <= 0.5 AND agreement >= 0.7 AND missing <= 0.2 AND spread >= 0.5 AS usable FROM r, t""")
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = learning.calibration(*gold_and_verdicts(spark, sf_dir))
    return row.select("n", "judged", *[F.round(c, 6).alias(c) for c in ("agreement", "missing", "spread")], "same_bucket", "buckets", F.round("saturation", 6).alias("saturation"), "usable")


@query(f"SELECT {_BUCKET.format('human_score')} AS human, CASE WHEN score IS NULL THEN 'missing' ELSE {_BUCKET.format('score')} END AS verdict, CAST(count(*) AS BIGINT) AS n FROM {GOLD_SQL} GROUP BY 1, 2")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.confusion(*gold_and_verdicts(spark, sf_dir))


@query("""
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
i AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INT) AS island FROM d)
SELECT user_id, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day, CAST(count(*) AS BIGINT) AS days FROM i GROUP BY user_id, island""")
def day_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    runs = learning.streaks(days, "user_id", "day")
    return runs.select("user_id", F.col("first_day").cast("string").alias("first_day"), F.col("last_day").cast("string").alias("last_day"), "days")


@query("""
WITH o AS (SELECT CAST(ts AS DATE) AS day, count_if(event_type = 'view') AS candidates, count_if(event_type = 'click') AS delivered, count(DISTINCT user_id) FILTER (event_type = 'error') AS bad,
  count(DISTINCT user_id) AS enabled, count_if(value >= 100) / count(*) AS saturation FROM events GROUP BY 1),
l AS (SELECT * FROM o ORDER BY day DESC LIMIT 3),
f AS (SELECT count_if(event_type = 'purchase') AS ups, count_if(event_type = 'error') AS downs, count_if(event_type = 'signup') AS views FROM events),
s AS (SELECT (SELECT count(*) FROM o) AS rounds, (SELECT sum(delivered) FROM o) AS delivered, (SELECT count(*) FROM o WHERE day > coalesce((SELECT max(day) FROM o WHERE candidates > 0), DATE '1900-01-01')) AS empty,
  (SELECT count_if(bad / enabled > 1.0 / 3) FROM l) AS bad_rounds, (SELECT count_if(saturation > 0.5) FROM l) AS saturated, (SELECT arg_max(saturation, day) FROM l) AS saturation, (SELECT arg_max(bad / enabled, day) FROM l) AS bad_share, f.* FROM f),
c AS (SELECT unnest([
  {'id': 'I-1', 'value': empty::DOUBLE, 'status': CASE WHEN rounds < 3 THEN 'nodata' WHEN empty < 3 THEN 'pass' ELSE 'fail' END},
  {'id': 'I-2', 'value': ((ups + downs) / delivered)::DOUBLE, 'status': CASE WHEN delivered = 0 THEN 'nodata' WHEN (ups + downs) / delivered >= 0.05 THEN 'pass' ELSE 'fail' END},
  {'id': 'I-3', 'value': bad_share::DOUBLE, 'status': CASE WHEN rounds < 3 THEN 'nodata' WHEN bad_rounds < 3 THEN 'pass' ELSE 'fail' END},
  {'id': 'I-4', 'value': saturation::DOUBLE, 'status': CASE WHEN rounds < 3 THEN 'nodata' WHEN saturated < 3 THEN 'pass' ELSE 'fail' END},
  {'id': 'G-1', 'value': 12::DOUBLE, 'status': 'pass'},
  {'id': 'G-2', 'value': (ups / (ups + downs))::DOUBLE, 'status': CASE WHEN ups / (ups + downs) >= 0.2 THEN 'pass' ELSE 'fail' END},
  {'id': 'G-3', 'value': NULL::DOUBLE, 'status': 'nodata'},
  {'id': 'P-1', 'value': 12::DOUBLE, 'status': 'pass'},
  {'id': 'P-2', 'value': (ups / (ups + downs))::DOUBLE, 'status': CASE WHEN ups / (ups + downs) >= 0.3 AND ups + downs >= 20 THEN 'pass' ELSE 'fail' END},
  {'id': 'P-3', 'value': NULL::DOUBLE, 'status': 'nodata'},
  {'id': 'P-4', 'value': 0::DOUBLE, 'status': 'fail'}]) AS c FROM s)
SELECT c.id AS id, round(c.value, 6) AS value, c.status AS status FROM c""")
def trial_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eleven criteria, a day being a round, errors bad sources and twelve recorded openings."""
    rows = table(spark, sf_dir, "events")
    days = rows.groupBy(F.to_date("ts").alias("round")).agg(
        F.count_if(F.col("event_type") == "view").alias("candidates"),
        F.count_if(F.col("event_type") == "click").alias("delivered"),
        F.count_distinct(F.when(F.col("event_type") == "error", F.col("user_id"))).alias("bad_sources"),
        F.count_distinct("user_id").alias("enabled_sources"),
        (F.count_if(F.col("value") >= 100) / F.count("*")).alias("saturation"),
    )
    signals = rows.select(F.when(F.col("event_type") == "purchase", "up").when(F.col("event_type") == "error", "down").alias("signal"))
    found = reports.criteria(days, signals, views=12, ended=True)
    return found.select("id", F.round("value", 6).alias("value"), "status")


@query("""SELECT event_type AS endpoint, CAST(count(*) AS BIGINT) AS calls, CAST(count_if(value < 10) AS BIGINT) AS failures, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS ms,
  row_number() OVER (ORDER BY count(*) DESC, min(event_id)) = 1 AS most_used FROM events GROUP BY 1""")
def endpoint_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as calls of endpoints: their kind the endpoint, small values failures."""
    calls = table(spark, sf_dir, "events").select(F.col("event_type").alias("endpoint"), (F.col("value") >= 10).alias("ok"), F.floor("value").cast("long").alias("ms"), F.col("event_id").alias("seq"))
    return reports.endpoint_usage(calls)


@query("""SELECT source, CAST(count(*) AS BIGINT) AS collected, CAST(count(quality) AS BIGINT) AS published, CAST(0 AS BIGINT) AS published_zh, round(count(quality) / count(*), 6) AS yield_ratio
FROM documents LEFT JOIN (SELECT * FROM labels WHERE quality = 1) USING (doc_id) GROUP BY source""")
def round_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board of a round that published the documents labelled as good."""
    docs = table(spark, sf_dir, "documents")
    published = docs.join(table(spark, sf_dir, "labels").where("quality = 1"), "doc_id").select("source", T.detect_lang(F.col("text")).alias("lang"))
    return reports.board(docs, published).withColumn("yield_ratio", F.round("yield_ratio", 6))


@query(f"""WITH r AS (SELECT value, event_type = 'signup' AS is_new FROM events), o AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS k, count(*) OVER () AS n FROM r)
SELECT CAST((SELECT count(*) FROM r) AS BIGINT) AS n, floor(max(CASE WHEN k = least(n - 1, floor(0.5 * n)) THEN value END) * 1000 + 0.5) / 1000 AS p50, floor(max(CASE WHEN k = least(n - 1, floor(0.9 * n)) THEN value END) * 1000 + 0.5) / 1000 AS p90,
  floor(max(value) * 1000 + 0.5) / 1000 AS top1, round(avg(value), 2) AS mean, floor(count_if(value >= 0.99) / count(*) * 1000 + 0.5) / 1000 AS saturation, (SELECT floor(count_if(is_new) / count(*) * 1000 + 0.5) / 1000 FROM r) AS new_rate FROM o""")
def round_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of a round, with event values as its scores and signups as its new items."""
    rows = table(spark, sf_dir, "events").select(F.col("value").alias("score"), (F.col("event_type") == "signup").alias("is_new"))
    return learning.round_row(rows).withColumn("mean", F.round("mean", 2))


@query("""WITH g AS (SELECT doc_id, quality = 1 AS want, CASE WHEN lang = 'es' THEN NULL ELSE n_chars > 500 END AS said FROM labels JOIN documents USING (doc_id)),
r AS (SELECT count(*) AS n, count_if(want AND said) AS rgt, count_if(NOT want AND said) AS wrg, count_if(want AND NOT coalesce(said, false)) AS mis, count_if(said IS NULL) AS nul, count_if(want = said) AS agr FROM g)
SELECT CAST(n AS BIGINT) AS n, CAST(rgt AS BIGINT) AS "right", CAST(wrg AS BIGINT) AS wrong, CAST(mis AS BIGINT) AS missed, CAST(nul AS BIGINT) AS missing, round(rgt / (rgt + wrg), 6) AS precision, round(rgt / (rgt + mis), 6) AS recall, nul / n <= 0.3 AND agr / n >= 0.7 AS usable FROM r""")
def recall_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge that includes long documents and does not read Spanish, against the quality labels."""
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    gold = labels.select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("include"))
    said = docs.select(F.col("doc_id").alias("id"), F.when(F.col("lang") != "es", F.col("n_chars") > 500).alias("include"))
    return learning.recall_calibration(gold, said).withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@query(f"""WITH f AS (SELECT source, count(*) AS n, count_if(signal = 'up') AS ups FROM {FEEDBACK_SQL} WHERE signal IS NOT NULL GROUP BY 1),
a AS (SELECT source, count(*) AS entries, count_if(lang = 'en') AS pushed FROM documents GROUP BY 1)
SELECT source, CAST(entries AS BIGINT) AS entries, CAST(pushed AS BIGINT) AS pushed, CASE WHEN pushed > 0 THEN round(coalesce(n, 0) / pushed, 6) END AS feedback_rate, CASE WHEN n > 0 THEN round(ups / n, 6) END AS up_rate FROM a LEFT JOIN f USING (source)""")
def source_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as an archive in which the English ones were pushed, with the feedback that their sources got."""
    archive = table(spark, sf_dir, "documents").withColumn("pushed", F.coalesce(F.col("lang") == "en", F.lit(False)))
    found = reports.feedback_rates(archive, feedback(spark, sf_dir).where("signal is not null"))
    return found.withColumns({c: F.round(c, 6) for c in ("feedback_rate", "up_rate")})


@query("SELECT source, CAST(count(*) AS BIGINT) AS entries, CAST(count_if(lang = 'en') AS BIGINT) AS pushed FROM documents GROUP BY source")
def source_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as an archive in which the English ones were pushed."""
    return reports.evidence(table(spark, sf_dir, "documents").withColumn("pushed", F.coalesce(F.col("lang") == "en", F.lit(False))))


# --- State ------------------------------------------------------------------------------------------------------------


@query(f"""
WITH a AS (SELECT user_id, min((epoch_us(ts) // 1000)) AS first_seen, max((epoch_us(ts) // 1000)) AS last_seen, count(*) AS hits, min(event_id) AS seq FROM events WHERE event_type <> 'signup' GROUP BY 1),
n AS (SELECT user_id, count(*) AS k FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT CAST(coalesce(a.user_id, n.user_id) AS VARCHAR) AS id, CAST(coalesce(first_seen, {NOW_MS}) AS BIGINT) AS first_seen, CAST(CASE WHEN k IS NOT NULL THEN {NOW_MS} ELSE last_seen END AS BIGINT) AS last_seen,
  CAST(coalesce(hits, 0) + coalesce(k, 0) AS BIGINT) AS hits, coalesce(hits > 60, false) AS pushed FROM a FULL JOIN n ON a.user_id = n.user_id""")
def archive_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readers as archive entries: what came before, then a round in which some are seen again and others for the first time."""
    rows = table(spark, sf_dir, "events").withColumn("id", F.col("user_id").cast("string")).withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    blank = [F.lit("").alias(c) for c in ("title", "url", "source")]
    old = rows.where("event_type <> 'signup'").groupBy("id").agg(F.min("ms").alias("first_seen"), F.max("ms").alias("last_seen"), F.count("*").alias("hits"), F.min("event_id").alias("seq"))
    archive = old.select("id", *blank, "first_seen", "last_seen", "hits", F.lit(False).alias("pushed"), "seq")
    archive = state.pushed_marked(archive, archive.where("hits > 60"))
    round_items = rows.where("event_type = 'signup'").select("id", *blank, F.col("event_id").alias("seq"))
    return state.archive_merged(archive, round_items, NOW_MS, most=None).select("id", "first_seen", "last_seen", "hits", "pushed")


@query("SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 5000")
def engagement_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 5000 engagements: the store's own bound."""
    return dedupe.retain(table(spark, sf_dir, "events"), state.ENGAGEMENTS_MAX, F.desc("ts"), F.desc("event_id")).select("event_id", "user_id")


_SIGNALS_SQL = """(SELECT event_id AS seq, 'd' || (user_id % 50) AS digest_id, CAST(json_extract(props, '$.k') AS INT) % 10 AS idx, 's' || (CAST(json_extract(props, '$.k') AS INT) % 10) AS source, event_type, value FROM events
  WHERE CAST(json_extract(props, '$.k') AS INT) % 10 < 8)"""


@query(f"""
WITH s AS (SELECT *, event_type IN ('click', 'view') AND value > 0 AS opened, event_type = 'purchase' AS up, event_type = 'error' AS down FROM {_SIGNALS_SQL}),
f AS (SELECT 'expand' AS kind, digest_id, idx, source, seq FROM s WHERE opened
  UNION ALL SELECT 'up', digest_id, idx, source, min(seq) FROM s WHERE up GROUP BY ALL UNION ALL SELECT 'down', digest_id, idx, source, min(seq) FROM s WHERE down GROUP BY ALL
  UNION ALL SELECT 'view', digest_id, arg_min(idx, seq), arg_min(source, seq), min(seq) FROM s WHERE opened GROUP BY digest_id)
SELECT kind, digest_id, CAST(idx AS INT) AS "index", source, CAST(seq AS BIGINT) AS seq FROM f""")
def signal_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as reader signals on posts, routed to expands, likes, dislikes and views; some posts are unknown."""
    signals, refs = rounds.event_signals(table(spark, sf_dir, "events"))
    return state.routed(signals, refs).select("kind", "digest_id", "index", "source", "seq")


@query(f"""
WITH s AS (SELECT *, event_type = 'signup' AS fav, event_type IN ('click', 'view') AND value > 0 AS opened, event_type = 'purchase' AS up, event_type = 'error' AS down FROM {_SIGNALS_SQL}),
u AS (SELECT *, row_number() OVER (PARTITION BY digest_id, idx ORDER BY fav, seq) AS k FROM s WHERE up OR fav),
f AS (SELECT 'expand' AS kind, digest_id, idx, source, seq FROM s WHERE opened UNION ALL SELECT 'expand', digest_id, idx, source, seq FROM u WHERE k = 1 AND fav
  UNION ALL SELECT 'up', digest_id, idx, source, seq FROM u WHERE k = 1 UNION ALL SELECT 'down', digest_id, idx, source, min(seq) FROM s WHERE down GROUP BY ALL
  UNION ALL SELECT 'view', digest_id, arg_min(idx, seq), arg_min(source, seq), min(seq) FROM s WHERE opened GROUP BY digest_id)
SELECT kind, digest_id, CAST(idx AS INT) AS "index", source, CAST(seq AS BIGINT) AS seq FROM f""")
def favourite_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same signals with signups as favourites, which count only where no like came before."""
    rows = table(spark, sf_dir, "events")
    signals, refs = rounds.event_signals(rows)
    marks = rows.select(F.col("event_id").alias("seq"), (F.col("event_type") == "signup").alias("favorite"))
    return state.routed(signals.drop("favorite").join(marks, "seq"), refs).select("kind", "digest_id", "index", "source", "seq")


#: Ways to write an address that strict parsers refuse or read otherwise, and whether it still is one.
ODD_WAYS = {"spaces": True, "capitals": True, "port": True, "user": True, "tracked": True, "fragment": True, "slashes": True, "backslashes": True, "broken line": True, "other scheme": False, "no scheme": False, "script": False}


@query("SELECT page_id, way, CASE WHEN sound THEN canonical_url ELSE '' END AS canonical_url FROM " + CANON_SQL + " CROSS JOIN (VALUES " + ", ".join(f"('{w}', {str(s).lower()})" for w, s in ODD_WAYS.items()) + ") AS v(way, sound)")
def url_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url written in odd ways: those that are still the same address have the same canonical form."""
    url = F.col("url")
    scheme, rest = F.substring_index(url, "://", 1), F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = F.substr(rest, F.length(host) + 1)
    joined = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    path, query_ = F.regexp_extract(tail, "^[^?#]*", 0), F.regexp_extract(tail, "[?].*$", 0)
    made = {
        "spaces": joined("  ", url, " \t"), "capitals": joined(F.upper(scheme), "://WWW.", F.upper(F.regexp_replace(host, "^www\\.", "")), tail), "port": joined(scheme, "://", host, ":8080", tail), "user": joined(scheme, "://me:pw@", host, tail),
        "tracked": joined(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), "utm_medium=x&fbclid=1"), "fragment": joined(url, "#part?x=1"), "slashes": joined(scheme, ":/", host, tail),
        "backslashes": joined(scheme, ":\\\\", host, F.replace(path, F.lit("/"), F.lit("\\")), query_), "broken line": joined(F.left(url, F.lit(3)), "\n", F.substr(url, F.lit(4))),
        "other scheme": joined("ftp://", rest), "no scheme": rest, "script": joined("javascript:alert('", url, "')"),
    }
    ways = F.array(*[F.struct(F.lit(w).alias("way"), made[w].alias("url")) for w in ODD_WAYS])
    return table(spark, sf_dir, "pages").select("page_id", F.explode(ways).alias("w")).select("page_id", "w.way", canonical_url(F.col("w.url")).alias("canonical_url"))


@query(f"""
WITH s AS (SELECT *, event_type IN ('click', 'view') AND value > 0 AS opened FROM {_SIGNALS_SQL})
SELECT source, CAST(count_if(opened) AS BIGINT) AS expands FROM s WHERE opened GROUP BY source""")
def stream_expands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same signals read as a stream, each micro-batch merged into a state table: expands by source."""
    return rounds.streamed_expands(spark, f"{sf_dir}/events.parquet")


@query("""
WITH o AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last FROM events), s AS (SELECT *, sum(CASE WHEN last IS NULL OR ts >= last + INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM o)
SELECT user_id, CAST(epoch_us(min(ts)) // 1000 AS BIGINT) AS start_ms, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY user_id, k""")
def reader_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of readers with gaps of six hours."""
    rows = table(spark, sf_dir, "events").withColumn("t", F.col("ts").cast("timestamp"))
    return rows.groupBy("user_id", F.session_window("t", "6 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.unix_millis(F.col("w.start")).alias("start_ms"), "n")


@query("""SELECT conv_id, turn, CAST((row_number() OVER (ORDER BY conv_id, turn, role) - 1) // 20 AS BIGINT) AS batch FROM conversations WHERE role <> 'system'""")
def batch_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty turns to a model batch, numbered in order."""
    rows = table(spark, sf_dir, "conversations").where("role <> 'system'").select("conv_id", "turn", "role")
    return numbered(rows, "conv_id", "turn", "role").select("conv_id", "turn", F.floor(F.col("n") / 20).alias("batch"))


@query("SELECT conv_id, turn FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'system')")
def resume_unfinished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of conversations without a finished mark (a system turn): what a resumed job still has to do."""
    rows = table(spark, sf_dir, "conversations")
    return rows.join(rows.where("role = 'system'").select("conv_id").distinct(), "conv_id", "left_anti").select("conv_id", "turn")


# --- Posts -------------------------------------------------------------------------------------------------------------


@query(f"""{COMPONENT_SQL} SELECT CAST(event_key AS VARCHAR) AS event_key, CAST(count(*) AS BIGINT) AS n FROM k GROUP BY event_key HAVING count(*) > 2""")
def crowded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that would be oversubscribed if all their documents were published."""
    return events.oversubscribed(clustered(spark, sf_dir))


@query()
def rendered_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a post with its hooks, summary, reason, and the first assertion that it breaks. post_assertions tests each assertion."""
    items = from_pages(table(spark, sf_dir, "pages")).withColumn("pos", F.col("seq")).withColumn("event_key", F.col("id"))
    # Written between rendering and asserting: one generated method for both would be too long to compile.
    with small_methods(spark):
        posts = written(render.rendered(items, "daily", "d1", "prose", KEYWORDS, SIGNALS, list(CONFIG.stopwords)), "posts")
    known = spark.createDataFrame([], "canonical_url string")
    return render.asserted(posts, CONFIG, known, 720, NOW_MS).select("id", "title", "hooks", "summary", "why", "lang", "rule")


@query(f"""
WITH RECURSIVE c AS (SELECT page_id, url, canonical_url, 'daily:d1:' || (page_id % 97) || page_id AS id, CAST((page_id % 97) || page_id AS BIGINT) AS n FROM {CANON_SQL}),
a AS (SELECT arg_min(id, page_id) AS id, arg_min(n, page_id) AS n, arg_min(url, page_id) AS url, min(page_id) AS page_id, canonical_url FROM c WHERE starts_with(url, 'http:') GROUP BY canonical_url),
b AS (SELECT arg_min(id, page_id) AS id, arg_min(n, page_id) AS n, arg_min(url, page_id) AS url, min(page_id) AS page_id, canonical_url FROM c WHERE starts_with(url, 'https:') GROUP BY canonical_url),
new AS (SELECT *, row_number() OVER (ORDER BY n) AS k FROM b WHERE canonical_url NOT IN (SELECT canonical_url FROM a)),
runs AS (SELECT min(n) AS s, max(n) AS f FROM (SELECT n, n - row_number() OVER (ORDER BY n) AS g FROM (SELECT DISTINCT n FROM a)) GROUP BY g),
r AS (SELECT k, page_id, url, coalesce((SELECT f + 1 FROM runs WHERE n BETWEEN s AND f), n) AS place FROM new WHERE k = 1
  UNION ALL SELECT w.k, w.page_id, w.url, coalesce(u.f + 1, greatest(w.n, r.place + 1)) FROM r JOIN new w ON w.k = r.k + 1 LEFT JOIN runs u ON greatest(w.n, r.place + 1) BETWEEN u.s AND u.f)
SELECT 'daily:d1:' || place AS id, url AS source_url, page_id FROM r
UNION ALL SELECT a.id, coalesce(b.url, a.url), coalesce(b.page_id, a.page_id) FROM a LEFT JOIN b USING (canonical_url)""")
def merged_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two packs of pages merged by canonical url: http ones first, then all others."""
    pages = table(spark, sf_dir, "pages").withColumn("_c", canonical_url(F.col("url")))
    pack = lambda d: dedupe.latest_of(d, ["_c"], F.asc("page_id")).select(F.concat(F.lit("daily:d1:"), (F.col("page_id") % 97).cast("string"), F.col("page_id").cast("string")).alias("id"), F.col("url").alias("source_url"), "page_id")
    return state.pack_merged(pack(pages.where(F.startswith("url", F.lit("http:")))), pack(pages.where(F.startswith("url", F.lit("https:")))))


# Registers the queries of connectors, editors and publication as well.
from loomsift import editor_queries as _editor_queries, round_queries as _round_queries, state_queries as _state_queries  # noqa: E402, F401
