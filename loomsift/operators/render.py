"""Rendered posts and the assertions that a post must hold before it is published."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.functions import text as T
from loomsift.functions.urls import canonical_url
from loomsift.lineage import small_methods, spread, written
from loomsift.operators.gates import GateConfig, age_rules, blacklist_verdict, first_failing

#: Fixed value: code points of a post's title.
TITLE_MAX = 120
ASSERTIONS = (
    "damagedBody duplicateUrl alreadyPublished mechanicalTruncation fragmentHook scoreEcho blacklistRecheck hookEntity tooOld shapeViolation htmlLeak hollowSummary "
    "summaryBelowFloor bodyBelowFloor"
).split()


def plain_subject(title: Column, body: Column) -> Column:
    """The first sentence of a title, or of a body without one, without its outlet, its last marks and decimal numbers."""
    whole = T.strip(F.when(title != "", title).otherwise(body))
    sentence = T.first_sentence(T.strip_outlet(whole), 400)
    bare = T.strip(T.sub(sentence, f"(?![A-Za-z0-9])[。．.!?！？:：,，、{T.SPACE}…]+\\z", ""))
    return T.collapse(T.sub(bare, "\\d+[.,]\\d+", " "))


# What a reason says, by language, for what an item matches: keywords and a signal word, either, a subject, nothing.
REASONS = {
    "en": ('Matches your interests in {found}, with a strong "{signal}" signal', "Matches your interest in {found}", 'Strong "{signal}" signal in {domain}', "Picked for {subject}", "Related to your {domain} feed"),
    "zh": ("聚焦你的关注点 {found}，并出现强信号「{signal}」", "聚焦你的关注点 {found}", "出现领域信号「{signal}」", "因「{subject}」入选", "与「{domain}」相关"),
}
# What is said in place of a reason that may not be shown.
FALLBACKS = {"en": "Hand-picked from the {domain} feed by {persona}", "zh": "{display}为你挑的{pick}"}
PICK = "深度内容"


def _filled(template: str, **parts: Column) -> Column:
    """The template with columns in place of its names."""
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[parts[p] if k % 2 else F.lit(p) for k, p in enumerate(pieces) if k % 2 or p])


def with_reason(items: DataFrame, keywords: list[str], signals: list[str], domain: str) -> DataFrame:
    """items (title, body) with reason, in the item's language, from the keywords and signal words that it matches; if there are
    none, from its own subject. Steps are columns, made once. A reason is never empty."""
    zh = T.detect_lang(F.concat("title", F.lit("\n"), "body")) == "zh"
    staged = T.once(items, _hay=T.haystack(F.concat("title", F.lit(" "), "body")))
    staged = T.once(staged, _found=F.slice(T.keyword_hits(F.col("_hay"), keywords), 1, 2), _signal=F.coalesce(F.get(T.keyword_hits(F.col("_hay"), signals), 0), F.lit("")), _zh=zh)
    has, strong, subject = F.size("_found") > 0, F.col("_signal") != "", F.col("_subject")
    plain = F.when(~has & ~strong, plain_subject(F.col("title"), F.col("body"))).otherwise(F.lit(""))
    staged = T.once(T.once(staged, _plain=plain), _subject=T.truncate_why(F.col("_plain"), 28))
    listed = {"en": F.array_join("_found", ", "), "zh": F.array_join(F.transform("_found", lambda k: F.concat(F.lit("「"), k, F.lit("」"))), "")}

    def said(lang: str) -> Column:
        both, words, signal, own, none = (_filled(t, found=listed[lang], signal=F.col("_signal"), subject=subject, domain=F.lit(domain)) for t in REASONS[lang])
        return F.when(has & strong, both).when(has, words).when(strong, signal).when(subject != "", own).otherwise(none)

    return T.once(staged, reason=F.when(F.col("_zh"), said("zh")).otherwise(said("en"))).drop("_hay", "_found", "_signal", "_zh", "_plain", "_subject")


def fallback_why(reason: Column, lang: Column, persona: str, display: str, domain: str, pick: str = PICK) -> Column:
    """The reason, unless it is empty or shows a score (a number with a decimal): then a sentence that names who picked the post."""
    own = T.strip(F.coalesce(reason, F.lit("")))
    words = {k: F.lit(t.format(persona=persona, display=display, domain=domain, pick=pick)) for k, t in FALLBACKS.items()}
    return F.when((own != "") & ~own.rlike("\\d\\.\\d"), own).when(lang == "en", words["en"]).otherwise(words["zh"])


def with_why(posts: DataFrame, persona: str, display: str, domain: str, pick: str = PICK) -> DataFrame:
    """posts (reason, lang) with why: what of the reason may be shown, at the length that posts keep to."""
    told = T.once(posts, _why=fallback_why(F.col("reason"), F.col("lang"), persona, display, domain, pick))
    return T.once(told, why=T.truncate_why(F.col("_why"), T.WHY_MAX)).drop("_why")


def rendered(items: DataFrame, persona: str, digest: str, domain: str, keywords: list[str], signals: list[str], stopwords: list[str], display: str = "", pick: str = PICK) -> DataFrame:
    """Posts from items (id, title, body, url, published_at, source, event_key, pos): title, three hooks, summary, body, why.

    why comes from the items' reason, which a scorer gave them; items without such a column get that of with_reason().
    """
    told = spread(items) if "reason" in items.columns else with_reason(spread(items), keywords, signals, domain)
    clean = told.withColumn("title", T.truncate(T.collapse(T.strip_html(F.regexp_replace("title", "^[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+:\\s+", ""))), TITLE_MAX))
    clean = clean.withColumn("body", T.strip_both(F.col("body")))
    clean = clean.withColumn("lang", T.detect_lang(F.concat("title", F.lit("\n"), "body")))
    clean = clean.withColumn("_lead", T.sentence_of(F.col("body"), T.by_lang(F.col("lang"), T.SUMMARY_MAX)))
    clean = clean.withColumn("summary", T.ensure_summary_floor(F.col("_lead"), F.col("body"), F.col("lang")))
    clean = clean.withColumn("_text", T.strip_metadata(F.when(F.col("summary") != "", F.col("summary")).otherwise(F.col("title"))))
    clean = clean.withColumn("_sentences", T.split_sentences(F.col("_text"))).withColumn("_tokens", T.tokens(F.col("title")))
    clean = clean.withColumn("_entities", T.topic_tokens(F.concat("title", F.lit(" "), "_text"), stopwords))
    hooks = T.derive_hooks(F.col("title"), F.col("_tokens"), F.col("_sentences"), F.col("_entities"), F.lit(domain), F.col("lang"))
    clean = with_why(clean, persona, display, domain, pick)
    post = F.concat(F.lit(f"{persona}:{digest}:"), F.col("pos").cast("string"))
    return clean.select(
        post.alias("id"), F.col("id").alias("item_id"), "title", hooks.alias("hooks"), "summary", "body", "why", "url", "lang", "published_at", "source", "event_key", "pos"
    )


def asserted(posts: DataFrame, config: GateConfig, known: DataFrame, max_age_hours: float, now_ms: int) -> DataFrame:
    """posts with one flag for each assertion (true: broken) and rule, the first broken in their order, or null.

    A url counts as a duplicate for every post after the first that carries it and breaks nothing else.
    """
    named = spread(posts)
    published = known.select(F.col("canonical_url").alias("_canon")).distinct().withColumn("_known", F.lit(True))
    stop = list(config.stopwords)
    text = F.concat("summary", F.lit("\n"), "body", F.lit("\n"), F.array_join("hooks", " "), F.lit("\n"), "why")
    both = T.once(
        named,
        _canon=canonical_url(F.col("url")),
        _black=blacklist_verdict(config, F.col("title"), text).isNotNull(),
        _named=T.topic_tokens(F.col("title"), stop),
        _hooks=F.transform("hooks", lambda h: T.topic_tokens(h, stop)),
    )
    title, summary, body, why, hooks, lang = (F.col(c) for c in ("title", "summary", "body", "why", "hooks", "lang"))
    shows = lambda sign, pattern: lambda c: F.contains(c, F.lit(sign)) & c.rlike(pattern)
    damaged, tag = shows("[", "(?i)\\[object Object\\]"), shows("<", f"(?i)</?[a-z][a-z0-9-]*(?:[{T.SPACE}][^<>]*)?>")
    # What the title names, or the title and the body's head, the whole text names: the body's tokens are made for those posts
    # alone for which these do not do.
    foreign = lambda found: (F.size(found) == 0) | F.exists("_hooks", lambda h: ~F.arrays_overlap(h, found))
    strange_to = lambda body: T.bound(T.topic_tokens(F.concat(F.col("title"), F.lit(" "), body), stop), foreign)
    strange = F.when(foreign(F.col("_named")).eqNullSafe(False), False).when(strange_to(T.head_of(F.col("body"))).eqNullSafe(False), False).otherwise(strange_to(F.col("body")))
    most = T.by_lang(lang, T.HOOK_MAX)
    shape = (F.size(hooks) != 3) | (F.size(F.array_distinct(hooks)) != 3) | F.exists(hooks, lambda h: F.length(h) > most)
    shape |= (F.length(summary) > T.by_lang(lang, T.SUMMARY_MAX)) | (F.length(why) > T.WHY_MAX) | (title == "") | (F.col("url") == "")
    old = first_failing(age_rules(F.col("published_at"), title, max_age_hours, now_ms)).isNotNull()
    broken = {
        "damagedBody": T.any_of([damaged(c) for c in (title, summary, body)]),
        "mechanicalTruncation": F.exists(hooks, lambda h: T.is_title_prefix(h, title)),
        "fragmentHook": F.exists(hooks, lambda h: (F.length(h) < T.HOOK_MIN) | h.rlike(f"(?i)^[{T.SPACE}]*arxiv:\\d+")),
        "scoreEcho": why.rlike("(价值|得分|分数|score)[ \\t]*[:：]?[ \\t]*\\d+\\.\\d|\\d\\.\\d{2}"),
        "blacklistRecheck": F.col("_black"),
        "hookEntity": strange,
        "tooOld": old,
        "shapeViolation": shape,
        "htmlLeak": T.any_of([tag(c) for c in (title, summary, body, why)]) | F.exists(hooks, tag),
        "hollowSummary": F.when(T.substance(summary) >= 5, False).otherwise(F.greatest(T.substance(summary), T.substance(body)) < 5),
        "summaryBelowFloor": F.length(summary) < T.by_lang(lang, T.SUMMARY_MIN),
        "bodyBelowFloor": F.length(body) < T.by_lang(lang, T.BODY_MIN),
    }
    with small_methods(posts.sparkSession):
        flagged = written(T.once(both, **{f"gk_{name}": c for name, c in broken.items()}).drop("_named", "_hooks", "_black"), "assertions")
    flagged = flagged.join(published, "_canon", "left").withColumn("gk_alreadyPublished", F.coalesce("_known", F.lit(False)))
    sound = flagged.where(~T.any_of([F.col(f"gk_{name}") for name in [*broken, "alreadyPublished"]]) & (F.col("_canon") != ""))
    first = sound.groupBy("_canon").agg(F.min("pos").alias("_first"))
    flagged = flagged.join(first, "_canon", "left").withColumn("gk_duplicateUrl", F.coalesce(F.col("_first") < F.col("pos"), F.lit(False)))
    flagged = flagged.select(*posts.columns, *[f"gk_{n}" for n in ASSERTIONS])
    return flagged.withColumn("rule", first_failing([(F.col(f"gk_{n}"), f"gk:{n}") for n in ASSERTIONS]))
