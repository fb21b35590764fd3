"""What a round leaves behind: staged candidates with their integrity, and one step that publishes: pack, board, fingerprints, log."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.operators import dedupe, similarity, state
from loomsift.sources import tables

STAGE = "stage/1"
LOG = "run string, at string, persona string, digest_id string, pack string, post_ids array<string>"
Embed = Callable[[list[str]], list[list[float] | None]]


def staged_problems(candidates: DataFrame, scores: DataFrame, order: DataFrame) -> DataFrame:
    """(problem, id) of a stage: candidates (id) that come twice, candidates without a score (id) and scores without a
    candidate, places of the order (id) without a candidate. No rows if it is sound."""
    ids, scored = candidates.select("id").distinct(), scores.select("id").distinct()
    found = {
        "duplicate candidate": dedupe.duplicates(candidates, "id").select("id"),
        "no score": ids.join(scored, "id", "left_anti"),
        "score of no candidate": scored.join(ids, "id", "left_anti"),
        "order of no candidate": order.select("id").distinct().join(ids, "id", "left_anti"),
    }
    out = None
    for problem, rows in found.items():
        part = rows.select(F.lit(problem).alias("problem"), "id")
        out = part if out is None else out.unionByName(part)
    return out


def stage_saved(candidates: DataFrame, root: str) -> str:
    """Candidates (id, score, pos, ...) as a new version of the stage under root, with the form they are in."""
    return tables.version_written(candidates.withColumn("stage", F.lit(STAGE)), root)


def stage_restored(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest whole stage under root, None if there is none. Raises if it is of another form or not sound."""
    path = tables.latest_version(spark, root)
    if path is None:
        return None
    rows = spark.read.parquet(path)
    if "stage" not in rows.columns or not rows.where(~F.col("stage").eqNullSafe(STAGE)).isEmpty():
        raise ValueError(f"{path} is not of the form {STAGE}")
    first = staged_problems(rows, rows.where("score is not null"), rows.where("pos is not null")).first()
    if first:
        raise ValueError(f"{path}: {first.problem}: {first.id}")
    return rows.drop("stage")


def lines_appended(rows: DataFrame, path: str) -> None:
    """Rows added to a log of JSON lines; lines written before are never touched. Serves the log of publications and that of
    a round's observations."""
    rows.write.mode("append").json(path)


def publish_log(spark: SparkSession, path: str) -> DataFrame:
    """The log of publications without lines that do not parse; of a run that was repeated, one entry."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LOG)
    rows, _ = tables.json_lines(spark, path, LOG)
    return dedupe.latest_of(rows.where("run is not null"), ["run"], F.desc("at"))


def with_embeddings(posts: DataFrame, embed: Embed, size: int) -> DataFrame:
    """posts (title, summary, ...) with embedding, a vector of `size` numbers from an injected model. A text for which it
    fails or gives none that is valid stays without one: that stops no publication."""

    def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            try:
                found = embed(list(texts))
            except Exception:  # the batch goes out without vectors
                found = [None] * len(texts)
            yield pd.Series(found, dtype=object)

    vector = F.pandas_udf(vectors, "array<float>")(F.concat("title", F.lit("\n"), "summary"))
    made = posts.withColumn("embedding", vector)
    return made.withColumn("embedding", F.when(similarity.is_valid_embedding(F.col("embedding"), size), F.col("embedding")))


def emitted(published: DataFrame, board: DataFrame, root: str, persona: str, display: str, digest: str, now_ms: int, problems: list[str], dry_run: bool = False) -> list[str]:
    """Publishes posts (id, title, hooks, summary, body, url, why, published_at, pos): the pack, the board, the fingerprints and
    the log under root, in this order; the brief follows the pack. Gives what stopped it, [] if nothing did.

    A round's own problems and a broken contract stop it before anything is written; a dry run writes nothing either. To
    run it again after a loss is safe: pack and board are replaced, fingerprints added once, the log has one entry a run.
    """
    spark, root = published.sparkSession, root.rstrip("/")
    pack = state.pack_posts(published, persona, display, now_ms)
    brief = state.pack_brief(pack)
    stopped = problems + [f"{r.rule}: {r.n}" for r in state.contract_breaks(pack, brief).collect()]  # at most five rows
    if stopped or dry_run:
        return stopped
    path = f"{root}/packs/{persona}-{digest}"
    tables.pack_written(pack, path, persona=persona, digest_id=digest)
    brief.write.mode("overwrite").json(f"{root}/briefs/{persona}-{digest}")
    board.write.mode("overwrite").json(f"{root}/boards/{persona}-{digest}")
    run = f"{persona}:{digest}:{now_ms}"
    # From what was known before this run: what the bound pushed out the first time must not come back as new.
    known = tables.state(spark, f"{root}/fingerprints", "canonical_url string, seq long", before=run)
    placed = published.select("url", F.col("pos").cast("long").alias("seq"))
    tables.version_written(dedupe.fingerprints_appended(known, placed), f"{root}/fingerprints", run)
    at = F.date_format(F.timestamp_millis(F.lit(now_ms)), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    ids = published.agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("p"))  # a digest's posts
    entry = ids.select(F.lit(run).alias("run"), at.alias("at"), F.lit(persona).alias("persona"), F.lit(digest).alias("digest_id"), F.lit(path).alias("pack"), F.col("p.id").alias("post_ids"))
    lines_appended(entry, f"{root}/log")
    return []
