"""A whole round: collect (prescreen, dedupe, gates, scores, events) and finalize (render, assert, select), and what is remembered of
it (archive, digest, references, settlement).

Each stage writes its result as a table; the next one reads it. A round may stop after collect and go on later from the
table, with the same result as in one run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.functions import text as T
from loomsift.lineage import small_methods, written
from loomsift.operators import dedupe, editorial, events, gates, learning, render, reports, similarity, state
from loomsift.operators.gates import GateConfig, Persona
from loomsift.operators.order import numbered
from loomsift.operators.scoring import Scorer, by_words


@dataclass(frozen=True)
class Round:
    persona: Persona
    config: GateConfig
    keywords: tuple[str, ...]
    signals: tuple[str, ...]
    now_ms: int
    digest: str
    recall_pool: int = 60
    quality_bar: float = 5
    #: How many entries the archive keeps; None: all.
    archive_max: int | None = state.ARCHIVE_MAX


Judge = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def collect(items: DataFrame, round_: Round, archive: DataFrame, published: DataFrame, weights: DataFrame, judge: Judge | None = None, scorer: Scorer | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidates in order, drops, funnel) of items.

    archive: (id, title); published: (canonical_url); weights: (source, weight). judge, editorial.recalled with its clients,
    takes the pool of those that fail on relevance alone; what it includes goes on like all others. scorer gives scores and
    reasons, by the round's keywords and signal words if there is none.
    """
    fresh = gates.prescreened(items, round_.persona.max_age_hours, round_.now_ms)
    known = archive.select("id")
    kept = dedupe.first_wins(fresh.where(~F.col("stale")).drop("stale"), "id", known)
    judged = written(gates.judged(kept, round_.persona, round_.config, round_.now_ms, None if judge is None else round_.recall_pool), "judged")
    sound, lost = judged.where("rule is null"), gates.drops(judged)
    if judge is not None:
        pool = written(gates.recall_pool(judged, round_.recall_pool), "pool")
        included, excluded = judge(pool)
        sound, lost = sound.unionByName(included.select(sound.columns)), gates.drops(judged, pool).unionByName(gates.drops(excluded))
    by_url = dedupe.by_canonical_url(sound.drop("gate", "rule"), published)
    lost = lost.unionByName(gates.drops(by_url.where("rule is not null").withColumn("gate", F.lit("fingerprint"))))
    passed = by_url.where("rule is null").drop("rule")
    scored = (scorer or by_words(list(round_.keywords), list(round_.signals), round_.persona.domain))(passed)
    titled = scored.withColumn("tokens", T.tokens(F.col("title")))
    new = similarity.novel(titled, archive.select("id", T.tokens(F.col("title")).alias("tokens")))
    ranked = learning.weighted(new, weights).drop("score").withColumnRenamed("rank_score", "score")
    # Events are named by, and keep, their highest scoring items; words are rare or not among all that was collected.
    placed = numbered(ranked, F.desc("score"), F.asc("seq")).withColumnRenamed("n", "pos")
    collected = fresh.where(~F.col("stale"))
    background = written(events.document_frequency(collected, round_.config), "background")
    keyed = events.event_keys(placed, round_.config, background, collected.count())
    candidates = written(events.capped_events(keyed, round_.config), "candidates")
    counts = candidates.agg(F.count("*").alias("candidates"), F.count_if("kept").alias("kept"), F.count_distinct("event_key").alias("events"))
    funnel = items.agg(F.count("*").alias("collected")).crossJoin(fresh.agg(F.count_if(~F.col("stale")).alias("fresh"))).crossJoin(kept.agg(F.count("*").alias("deduped")))
    return candidates, lost, funnel.crossJoin(counts)  # one row each


def targets(candidates: DataFrame, round_: Round) -> DataFrame:
    """The scope of a round, twice its posts, numbered in order (pos): what the editors read and what is rendered."""
    scope = events.ordered(candidates).limit(2 * round_.persona.max_items)
    return numbered(scope.withColumn("_order", F.struct(~F.col("kept"), -F.col("score"), F.col("event_pos"), F.col("pos"))), "_order").withColumn("pos", F.col("n"))


def finalize(candidates: DataFrame, round_: Round, published: DataFrame, edited: editorial.Edited | None = None) -> DataFrame:
    """The targets of a round as posts with their first broken assertion and their state.

    With editors, what the reviewers rejected or scored under the bar comes after all others, and a writer's copy stands in
    place of what is rendered. Whether a post is sound only the assertions say.
    """
    placed = targets(candidates, round_)
    if edited and edited.verdicts is not None:
        review = F.when(F.col("decision") == "reject", F.lit(-1.0)).otherwise(F.col("score").cast("double"))
        placed = events.by_bar(placed.join(edited.verdicts.select("id", review.alias("review")), "id", "left"), round_.quality_bar)
    posts = render.rendered(placed, round_.persona.id, round_.digest, round_.persona.domain, list(round_.keywords), list(round_.signals), list(round_.config.stopwords), round_.persona.display, round_.persona.extra.get("pick", render.PICK))
    if edited and edited.copies is not None:
        posts = editorial.with_copies(posts, edited.copies.withColumnRenamed("id", "item_id"), "item_id")
    with small_methods(candidates.sparkSession):
        posts = written(posts, "posts")
    asserted = written(render.asserted(posts, round_.config, published, round_.persona.max_age_hours, round_.now_ms), "asserted")
    return events.selected(asserted.withColumn("passed", F.col("rule").isNull()), round_.persona.max_items, round_.config.max_per_event)


@dataclass(frozen=True)
class Memory:
    """What rounds remember, as tables: archive, digests, refs, exposures shown, engagements, settled exposures."""

    archive: DataFrame
    digests: DataFrame
    refs: DataFrame
    shown: DataFrame
    engaged: DataFrame
    settled: DataFrame


def recorded(memory: Memory, candidates: DataFrame, posts: DataFrame, round_: Round) -> Memory:
    """The memory after a round: all candidates are archived, then those published are marked as pushed, the digest and
    its references saved, and exposures that are due settled. Running a round again changes nothing but hits.

    posts: what finalize() gives; those accepted or filled are published, numbered in their order.
    """
    published = posts.where(F.col("state").isin("accepted", "filled"))
    filled_last = numbered(published, (F.col("state") == "filled").asc(), F.col("pos").asc()).withColumnRenamed("n", "index")
    archive = state.pushed_marked(state.archive_merged(memory.archive, candidates.select("id", "title", "url", "source", "seq"), round_.now_ms, round_.archive_max), published.select(F.col("item_id").alias("id")))
    now = F.lit(round_.now_ms).cast("long")
    ref = F.concat_ws(":", F.lit(round_.digest), F.col("index").cast("string"))
    place = now * F.lit(2**20) + F.col("index")
    new_refs = filled_last.select(ref.alias("ref"), F.lit(round_.digest).alias("digest_id"), "item_id", "source", place.alias("seq"))
    digest = filled_last.groupBy(F.lit(round_.digest).alias("digest_id")).agg(F.sort_array(F.collect_list(F.struct("index", "title", "summary", "url"))).alias("clusters"))  # as many as a digest has
    digests = state.digest_saved(memory.digests, digest.select("digest_id", now.alias("generated_at"), "clusters", now.alias("seq")))
    shown = memory.shown.join(digest.select("digest_id"), "digest_id", "left_anti").unionByName(filled_last.select(F.lit(round_.digest).alias("digest_id"), F.col("index").cast("int").alias("index"), "source", now.alias("at")))
    due = learning.settled(shown, memory.engaged, memory.settled, round_.now_ms)
    settled = memory.settled.unionByName(due.select("digest_id", "index"))
    return Memory(archive, digests, state.refs_registered(memory.refs, new_refs), shown, memory.engaged, settled)


STAGES = ("collected", "fresh", "deduped", "candidates", "targets", "published")


def audited(counts: DataFrame, candidates: DataFrame, posts: DataFrame, drops: DataFrame, persona: str = "", bad_rules: int = 0, signals: DataFrame | None = None, editors: DataFrame | None = None) -> DataFrame:
    """(board, level, rule, n) of a round: see reports.audited(). signals: the reader's facts that are known; editors: one
    row of reports.editorial_board()."""
    spark = posts.sparkSession
    made = posts.agg(F.count("*").alias("targets"), F.count_if(F.col("state").isin("accepted", "filled")).alias("published"), F.count_if(F.col("state") == "rejected").alias("rejected"), F.coalesce(F.max(F.col("state") == "filled"), F.lit(False)).alias("filled"))
    lost = drops.agg(F.count("*").alias("dropped"))
    known = signals.agg(F.count("*").alias("signals")) if signals is not None else spark.range(1).select(F.lit(0).cast("long").alias("signals"))
    row = counts.select("collected", "fresh", "deduped", "candidates").crossJoin(made).crossJoin(lost).crossJoin(known).withColumn("board", F.lit(persona))  # of one row each
    stages = F.array(*[F.struct(F.lit(k).alias("pos"), F.lit(n).alias("stage"), F.col(n).cast("long").alias("n")) for k, n in enumerate(STAGES)])
    funnels = row.select("board", F.explode(stages).alias("s")).select("board", "s.*")
    if editors is None:
        none = {"enabled": F.lit(False), "active": F.lit(False), "calibration_passed": F.lit(None).cast("boolean")} | {n: F.lit(0) for n in ("writer_degraded", "reviewer_degraded", "truncated", "copies")}
        row = row.withColumns(none)
    else:
        row = row.crossJoin(editors.drop("board"))  # one row
    return reports.audited(funnels, row.withColumn("bad_rules", F.lit(bad_rules)), spark.createDataFrame([], "board string, role string, endpoint string"))


def audit(stages: list[tuple[str, int]], published: int, dropped: int, rejected: int) -> list[str]:
    """What is wrong with a round's counts: a stage that grows, a last stage unlike what was published, more drops than entries."""
    problems = [f"{b[0]} ({b[1]}) exceeds {a[0]} ({a[1]})" for a, b in zip(stages, stages[1:]) if b[1] > a[1]]
    if stages and stages[-1][1] != published:
        problems.append(f"the last stage has {stages[-1][1]}, published are {published}")
    if stages and dropped + rejected > stages[0][1]:
        problems.append(f"{dropped} dropped and {rejected} rejected of {stages[0][1]}")
    return problems
