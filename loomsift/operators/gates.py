"""Rule gates: one verdict for each item, from the first rule that it fails; drops with their attribution; the recall pool.

All rules are native expressions over one projection. The rules of a gate stand in one `coalesce`, so the first failing
one names the verdict and later ones are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.functions import text as T

HOUR_MS = 3_600_000
#: What a keyword only the body has counts, by tier.
BODY_POINTS = {"core": 1, "ecosystem": 0, "generic": 0}


@dataclass(frozen=True)
class Rule:
    id: str
    pattern: str
    flags: str = "i"
    scope: str = "both"
    group: str | None = None
    unless_strong: bool = False


@dataclass(frozen=True)
class Tier:
    tier: str
    points: int
    words: tuple[str, ...]


@dataclass(frozen=True)
class GateConfig:
    min_title_chars: int = 15
    min_points: int = 3
    strong_words: tuple[str, ...] = ()
    tiers: tuple[Tier, ...] = ()
    blacklist: tuple[Rule, ...] = ()
    stopwords: tuple[str, ...] = ()
    jaccard: float = 0.75
    max_per_event: int = 2
    max_entity_df: int = 20
    max_entity_df_ratio: float = 0.02


@dataclass(frozen=True)
class Persona:
    id: str
    sources: tuple[str, ...] = ()
    max_age_hours: float = 72.0
    max_items: int = 10
    reject: tuple[Rule, ...] = ()
    min_quality: int = 0
    display: str = ""
    domain: str = ""
    extra: dict = field(default_factory=dict, hash=False, compare=False)


def java_pattern(pattern: str, flags: str = "i") -> str:
    """A feed rule's pattern in Java's dialect: Unicode case folding, `$` only at the very end, wide white space."""
    kept = "".join(f for f in flags or "i" if f in "ims")
    out = re.sub(r"(\\.)|\$(?=\)|\||\Z)", lambda m: m[1] or ("$" if "m" in kept else "\\z"), pattern)
    out = re.sub(r"\\([sS])", lambda m: f"[{T.SPACE}]" if m[1] == "s" else f"[^{T.SPACE}]", _no_class_space(out))
    return (f"(?{kept}u)" if "i" in kept else f"(?{kept})" if kept else "") + out


def _no_class_space(pattern: str) -> str:
    """\\s inside a character class becomes the members of the class of white space."""
    return re.sub(r"\[[^\]]*\]", lambda m: m[0].replace("\\s", T.SPACE.replace("\\s", " \\t\\n\\x0B\\f\\r")), pattern)


def bad_rules(spark: SparkSession, rules: tuple[Rule, ...]) -> list[tuple[str, str]]:
    """(rule id, error) of the rules whose pattern does not compile; a run must stop if there are any."""
    out = []
    for rule in rules:
        try:
            if not rule.pattern:
                raise ValueError("empty pattern")
            spark.range(1).select(F.concat(F.lit(""), F.col("id").cast("string")).rlike(java_pattern(rule.pattern, rule.flags))).collect()
        except Exception as error:  # whatever the engine raises for a bad pattern is the finding
            out.append((rule.id, str(error).splitlines()[0][:200]))
    return out


def _hit(rule: Rule, title: Column, body: Column) -> Column:
    text = {"title": title, "body": body}.get(rule.scope, F.concat(title, F.lit("\n"), body))
    return text.rlike(java_pattern(rule.pattern, rule.flags))


def first_failing(rules: list[tuple[Column, str | Column]]) -> Column:
    """The name of the first rule whose condition holds, else null."""
    return F.coalesce(*[F.when(c, F.lit(n) if isinstance(n, str) else n) for c, n in rules], F.lit(None).cast("string"))


def age_rules(published_at: Column, title: Column, max_age_hours: float, now_ms: int) -> list[tuple[Column, str]]:
    import datetime

    year = datetime.datetime.fromtimestamp(now_ms / 1000, datetime.timezone.utc).year
    dated = published_at > 0
    return [
        (dated & ((F.lit(now_ms) - published_at) / HOUR_MS > max_age_hours), "persona:tooOld"),
        (dated & (published_at > now_ms), "persona:futureTimestamp"),
        (~dated & T.stale_year(title, F.lit(year)).isNotNull(), "persona:staleYearInTitle"),
    ]


def persona_verdict(persona: Persona, now_ms: int) -> Column:
    title, body = F.col("title"), F.col("body")
    return first_failing(
        [(~F.col("source").isin(list(persona.sources)), "persona:sourceNotWhitelisted")]
        + age_rules(F.col("published_at"), title, persona.max_age_hours, now_ms)
        + [(_hit(r, title, body), f"persona:reject:{r.id}") for r in persona.reject]
    )


def blacklist_verdict(config: GateConfig, title: Column | None = None, body: Column | None = None, hay: Column | None = None) -> Column:
    """The first structural or pattern rule that an item breaks, else null. hay: its haystack, if there is one already; else it
    is made for those items alone that a rule looks it up for."""
    title, body = F.col("title") if title is None else title, F.col("body") if body is None else body
    hay = T.haystack(F.concat(title, F.lit(" "), body)) if hay is None else hay
    strong = T.bound(hay, lambda h: T.any_of([T.matches(h, T.normalize(F.lit(w))) for w in config.strong_words]))
    damaged = "(?i)\\[object Object\\]"
    shown = lambda c: F.contains(c, F.lit("[")) & c.rlike(damaged)
    rules = [(shown(body) | shown(title), "damaged:objectObject"), (F.length(T.strip(title)) < config.min_title_chars, "damaged:titleTooShort")]
    for rule in config.blacklist:
        hit = _hit(rule, title, body)
        # A condition of its own: both sides of a plain `and` may be computed for every row.
        rules.append((F.coalesce(F.when(hit, ~strong), F.lit(False)) if rule.unless_strong else hit, rule.id))
    return first_failing(rules)


def relevance(config: GateConfig) -> Column:
    """points, and hits as (word, tier, points): each keyword once, by its tier in the title, less in the body alone."""
    words = [(w, t.tier, t.points, BODY_POINTS.get(t.tier, 0)) for t in config.tiers for w in t.words]
    empty = F.expr("named_struct('points', 0, 'hits', cast(array() as array<struct<word:string,tier:string,points:int>>))")
    if not words:
        return empty
    known = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(t).alias("tier"), F.lit(p).alias("p"), F.lit(b).alias("b"), T.normalize(F.lit(w)).alias("norm"), T.needle(T.normalize(F.lit(w))).alias("needle")) for w, t, p, b in words])
    found = lambda hay, k: (k["norm"] != "") & F.contains(F.col(hay), k["needle"])
    judged = F.transform(
        known,
        lambda k: F.struct(k["word"].alias("word"), k["tier"].alias("tier"), F.when(found("_title", k), k["p"]).when(found("_body", k), k["b"]).alias("points")),
    )
    hits = F.filter(judged, lambda h: h["points"].isNotNull())
    return F.struct(F.aggregate(hits, F.lit(0), lambda a, h: a + h["points"]).alias("points"), hits.alias("hits"))


def with_relevance(items: DataFrame, config: GateConfig) -> DataFrame:
    """items with points and hits; the haystacks are made once for each row."""
    hay = T.once(items, _title=T.haystack(F.col("title")), _body=T.haystack(F.col("body")))
    scored = T.once(hay, _r=relevance(config))
    return scored.withColumn("points", F.col("_r.points")).withColumn("hits", F.col("_r.hits")).drop("_r", "_title", "_body")


def recall_eligible(config: GateConfig) -> Column:
    title, body = T.strip(F.col("title")), T.strip(F.col("body"))
    letters = F.length(T.sub(title, "[^\\p{L}\\p{N}]", ""))
    return (F.length(title) >= config.min_title_chars) & (letters >= max(4, config.min_title_chars // 2)) & ((body == "") | (F.length(body) >= 30))


def judged(items: DataFrame, persona: Persona, config: GateConfig, now_ms: int, recall: int | None = None) -> DataFrame:
    """items with points, gate and rule (both null for those that pass all rules), in the order of the gates.

    With recall (the size of the pool), an item that fails on relevance alone is routed to gate 'recall': rule
    'recall:candidate' if eligible, else 'recall:ineligible'.
    """
    hay = T.once(items, _title=T.haystack(F.col("title")), _body=T.haystack(F.col("body")))
    first = T.once(hay, _r=relevance(config), _p=persona_verdict(persona, now_ms), _b=blacklist_verdict(config))
    first = first.withColumn("points", F.col("_r.points")).withColumn("hits", F.col("_r.hits")).drop("_r", "_title", "_body")
    low = F.col("points") < config.min_points
    short = F.concat(F.lit("relevance:belowMinPoints("), F.col("points").cast("string"), F.lit(f"<{config.min_points})"))
    if recall is not None:
        short = F.when(recall_eligible(config), F.lit("recall:candidate")).otherwise(F.lit("recall:ineligible"))
    gate = F.when(F.col("_p").isNotNull(), "persona").when(F.col("_b").isNotNull(), "blacklist").when(low, "relevance" if recall is None else "recall")
    rule = F.coalesce("_p", "_b", F.when(low, short))
    return first.withColumn("gate", gate).withColumn("rule", rule).drop("_p", "_b")


def by_keyword(items: DataFrame, keywords: list[str]) -> DataFrame:
    """items (title, body) with relevant: whether they match any keyword. The filter of old, without points or tiers."""
    hay = T.once(items, _hay=T.haystack(F.concat("title", F.lit(" "), "body")))
    return hay.withColumn("relevant", F.size(T.keyword_hits(F.col("_hay"), keywords)) > 0).drop("_hay")


def recall_pool(verdicts: DataFrame, most: int) -> DataFrame:
    """The candidates with most points (ties by order) up to the size of the pool."""
    return verdicts.where("rule = 'recall:candidate'").orderBy(F.desc("points"), "seq").limit(most)


def drops(verdicts: DataFrame, pool: DataFrame | None = None) -> DataFrame:
    """Drop records: item_id, title, source, url, gate, rule, seq. What overflows the recall pool is one record for all."""
    columns = [F.col("id").alias("item_id"), "title", "source", "url", "gate", "rule", "seq"]
    lost = verdicts.where("rule is not null and rule <> 'recall:candidate'").select(*columns)
    if pool is None:
        return lost
    n = verdicts.where("rule = 'recall:candidate'").agg(F.count("*").alias("n")).crossJoin(pool.agg(F.count("*").alias("kept")))
    over = n.where("n > kept").select(
        F.lit("(batch)").alias("item_id"), (F.col("n") - F.col("kept")).cast("string").alias("title"), F.lit("(multiple)").alias("source"), F.lit("").alias("url"),
        F.lit("recall").alias("gate"), F.lit("recall:poolOverflow").alias("rule"), F.lit(2**62).cast("long").alias("seq"),
    )
    return lost.unionByName(over)


def funnel(dropped: DataFrame) -> DataFrame:
    """gate, rule, n and the place of the first such drop, by falling count and then by that place."""
    counts = dropped.groupBy("gate", "rule").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
    return counts.orderBy(F.desc("n"), "first_seq", "rule")


def prescreened(items: DataFrame, max_age_hours: float, now_ms: int) -> DataFrame:
    """items with stale: dated ones older than the limit. Kept apart from the gates, as they go before deduplication."""
    stale = (F.col("published_at") > 0) & ((F.lit(now_ms) - F.col("published_at")) > max_age_hours * HOUR_MS)
    return items.withColumn("stale", stale)
