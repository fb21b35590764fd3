"""The editors of a round: writers and reviewers run by model, their staged work combined, and the judge of recall."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.lineage import written
from loomsift.operators import events, inference, learning
from loomsift.operators.inference import Client
from loomsift.sources import tables

CALIBRATION_TTL_MS = 24 * 3_600_000
CALIBRATION = "key string, calibrated_at long, passed boolean, precision double, recall double"


class Edited(NamedTuple):
    """What the editors made: copies (id, hooks, summary, why) and verdicts (id, score, decision, category, reason), None for a
    part that did not run; reason says why nothing was made."""

    copies: DataFrame | None = None
    verdicts: DataFrame | None = None
    calibration: DataFrame | None = None
    reason: str | None = None


def edited(candidates: DataFrame, writers: list[Client], reviewers: list[Client], gold: DataFrame | None = None, size: int = 20, display: str = "the feed", focus: str = "its subject") -> Edited:
    """candidates (id, title, body, pos) read by writers and reviewers, each a chain of endpoints; [] for a part not wanted.

    With gold (id, title, body, pos, human_score, human_decision) the reviewers judge that first. If they fail there, nobody
    edits: what is written could not be judged.
    """
    if not writers and not reviewers:
        return Edited(reason="no endpoint")
    if candidates.isEmpty():
        return Edited(reason="no candidates")
    calibration = None
    if reviewers and gold is not None:
        said = inference.verdicts(inference.answered(inference.prompts(gold, "pos", size, inference.task("review", display, focus)), reviewers))
        calibration = written(learning.calibration(gold.select("id", "human_score", "human_decision"), said), "calibration")
        if not calibration.first().usable:
            return Edited(calibration=calibration, reason="reviewers failed the gold set")
    ask = lambda role, chain: inference.answered(inference.prompts(candidates, "pos", size, inference.task(role, display, focus)), chain)
    copies = inference.copies(ask("write", writers)) if writers else None
    verdicts = inference.verdicts(ask("review", reviewers)) if reviewers else None
    return Edited(copies, verdicts, calibration)


def aligned(kind: str, targets: DataFrame, staged: DataFrame) -> None:
    """Raises if a staged list (pos, id) is not that of the targets: a copy or verdict would land on another item."""
    first = events.misaligned(targets, staged).orderBy("pos").first()
    if first:
        raise ValueError(f"staged {kind} at {first.pos}: {first.staged} is not {first.target}; run that stage again")


def combined(targets: DataFrame, copies: DataFrame | None, verdicts: DataFrame | None, least: float) -> DataFrame:
    """targets (id, pos, ...) with copy (hooks, summary, why) and verdict (score, decision, category, reason) by id, both null
    where none is, and qualified: whether the score reaches the bar, null for all if no reviewer ran."""
    none = lambda *types: [F.lit(None).cast(t) for t in types]
    out = targets
    if copies is None:
        out = out.withColumn("copy", *none("struct<hooks: array<string>, summary: string, why: string>"))
    else:
        said = copies.where("summary is not null").select("id", F.struct("hooks", "summary", "why").alias("copy"))
        out = out.join(said, "id", "left")
    if verdicts is None:
        return out.withColumn("verdict", *none("struct<score: int, decision: string, category: string, reason: string>")).withColumn("qualified", *none("boolean"))
    said = verdicts.where("score is not null").select("id", F.struct("score", "decision", "category", "reason").alias("verdict"))
    return out.join(said, "id", "left").withColumn("qualified", F.coalesce(F.col("verdict.score") >= least, F.lit(False)))


def with_copies(posts: DataFrame, copies: DataFrame, key: str = "id") -> DataFrame:
    """posts (key, hooks, summary, why, ...) with the copies (key, hooks, summary, why) that a model or somebody by hand wrote
    in place of those rendered; one copy a key. A field that a copy leaves out stays as it was."""
    fields = ("hooks", "summary", "why")
    said = copies.dropDuplicates([key]).select(key, *[F.col(c).alias(f"_{c}") for c in fields])
    both = posts.join(said, key, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in fields})
    return both.select(posts.columns)


def recall_usable(gold: DataFrame, judges: list[Client], root: str, key: str, now_ms: int, size: int = 20) -> bool:
    """Whether the judges of recall passed the gold set (id, title, body, pos, include) within the last 24 hours.

    The answer is a versioned table under root. One of another key (persona, endpoints, gold set) or an older one is not
    taken: the judges are then asked again.
    """
    spark = gold.sparkSession
    cached = tables.state(spark, root, CALIBRATION).where((F.col("key") == key) & (F.col("calibrated_at") >= now_ms - CALIBRATION_TTL_MS)).first()
    if cached:
        return cached.passed
    replies = inference.answered(inference.prompts(gold, "pos", size, inference.task("recall")), judges)
    report = learning.recall_calibration(gold.select("id", "include"), inference.inclusions(replies))
    row = report.select(F.lit(key).alias("key"), F.lit(now_ms).cast("long").alias("calibrated_at"), F.coalesce("usable", F.lit(False)).alias("passed"), "precision", "recall")
    path = tables.version_written(row, root)
    return spark.read.parquet(path).first().passed


def recalled(pool: DataFrame, usable: bool, judges: list[Client], order: str = "pos", size: int = 20) -> tuple[DataFrame, DataFrame]:
    """(included, excluded with rule) of a recall pool (id, title, body, and their order). Judges that failed their gold set include nothing,
    and silence is no."""
    if not usable:
        return pool.limit(0), pool.withColumn("rule", F.lit("recall:calibrationFailed"))
    said = inference.inclusions(inference.answered(inference.prompts(pool, order, size, inference.task("recall")), judges))
    both = pool.join(said.withColumnRenamed("include", "_include"), "id", "left")
    rule = F.when(F.col("_include").isNull(), "recall:unanswered").otherwise("recall:excluded")
    taken = F.coalesce("_include", F.lit(False))
    return both.where(taken).drop("_include"), both.where(~taken).withColumn("rule", rule).drop("_include")
