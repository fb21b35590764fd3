"""What rounds remember, kept as one set of tables that is committed together, and a whole round in one call."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.lineage import written
from loomsift.operators import dedupe, editorial, gates, learning
from loomsift.operators.scoring import Scorer
from loomsift.plans import rounds
from loomsift.sources.commits import Commits

SCHEMAS = {
    "archive": "id string, title string, url string, source string, first_seen long, last_seen long, hits long, pushed boolean, seq long",
    "digests": "digest_id string, generated_at long, clusters array<struct<index:long,title:string,summary:string,url:string>>, seq long",
    "refs": "ref string, digest_id string, item_id string, source string, seq long",
    "shown": "digest_id string, index int, source string, at long",
    "engaged": "digest_id string, index int",
    "settled": "digest_id string, index int",
}
#: State beside the memory: urls published, reader's facts on items, and one row for each round.
BESIDE = {
    "fingerprints": "canonical_url string, seq long",
    "feedback": "kind string, digest_id string, index int, item_id string, source string, seq long",
    "weights": "source string, weight double, token string",
    "observations": "persona string, digest_id string, at long, collected long, candidates long, events long, published long, rejected long, p50 double, p90 double, top1 double",
}


def store(root: str) -> Commits:
    return Commits(root.rstrip("/"), SCHEMAS | BESIDE)


def remembered(spark: SparkSession, root: str, number: int | None = None) -> rounds.Memory:
    """The memory as the newest commit (or the one of that number) left it; empty before the first."""
    tables = store(root).tables(spark, number)
    return rounds.Memory(*[tables[f.name] for f in fields(rounds.Memory)])


def committed(memory: rounds.Memory, root: str, after: int | None = None, **beside: DataFrame) -> int:
    """Commits all tables of a memory, and those beside it that are given, as one."""
    return store(root).commit(memory.archive.sparkSession, {f.name: getattr(memory, f.name) for f in fields(memory)} | beside, after)


@dataclass(frozen=True)
class Result:
    commit: int
    posts: DataFrame
    drops: DataFrame
    funnel: DataFrame
    problems: DataFrame


def observation(round_: rounds.Round, counts: DataFrame, candidates: DataFrame, posts: DataFrame) -> DataFrame:
    """One row: what a round brought, and the quantiles of its scores."""
    made = posts.agg(F.count_if(F.col("state").isin("accepted", "filled")).alias("published"), F.count_if(F.col("state") == "rejected").alias("rejected"))
    q = learning.quantiles(candidates, "score", [0.5, 0.9]).agg(*[F.max(F.when(F.col("q") == x, F.col("value"))).alias(n) for x, n in ((0.5, "p50"), (0.9, "p90"))])
    top = candidates.agg(F.coalesce(F.max("score"), F.lit(0.0)).alias("top1"))
    row = counts.select("collected", "candidates", "events").crossJoin(made).crossJoin(q).crossJoin(top)  # of one row each
    own = [F.lit(round_.persona.id).alias("persona"), F.lit(round_.digest).alias("digest_id"), F.lit(round_.now_ms).cast("long").alias("at")]
    return row.select(*own, *row.columns)


def run_round(items: DataFrame, round_: rounds.Round, root: str, judge: rounds.Judge | None = None, edited: editorial.Edited | None = None, weights: DataFrame | None = None, scorer: Scorer | None = None) -> Result:
    """A whole round over items, from the state under root to the state after it, in one commit at its end.

    Items known to the archive, and urls published before, drop out; sources' weights come from the feedback in the state
    unless they are given. A round that breaks off anywhere leaves the state as it was; run again, it starts from there.
    """
    spark, kept = items.sparkSession, store(root)
    numbers = kept.numbers(spark)
    after = numbers[-1] if numbers else 0
    state = kept.tables(spark)
    memory = rounds.Memory(*[state[f.name] for f in fields(rounds.Memory)])
    if bad := gates.bad_rules(spark, round_.persona.reject + round_.config.blacklist):
        raise ValueError(f"rules that do not compile: {bad}")
    rated = state["feedback"].where("kind in ('up', 'down')").withColumn("signal", F.col("kind"))
    learned = written(learning.refreshed_weights(state["weights"], rated, items), "round-weights")
    weights = learned.select("source", "weight") if weights is None else weights
    candidates, drops, counts = rounds.collect(items, round_, memory.archive, state["fingerprints"], weights, judge, scorer)
    counts = written(counts, "round-counts")
    posts = rounds.finalize(candidates, round_, state["fingerprints"], edited)
    posts = written(posts, "round-posts")
    new = rounds.recorded(memory, candidates, posts, round_)
    published = posts.where(F.col("state").isin("accepted", "filled"))
    prints = dedupe.fingerprints_appended(state["fingerprints"], published.select("url", F.col("pos").cast("long").alias("seq")))
    seen = state["observations"].where(F.col("digest_id") != round_.digest).unionByName(observation(round_, counts, candidates, posts))
    number = committed(new, root, after, fingerprints=prints, observations=seen, weights=learned)
    return Result(number, posts, drops, counts, rounds.audited(counts, candidates, posts, drops, round_.persona.id, signals=state["feedback"]))
