"""Reader signals against recorded state: exports that repeat what was known, and exposures that settle once the watermark says so."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.operators.learning import HORIZON_MS
from loomsift.operators.state import FACTS, routed
from loomsift.sources.ledger import Ledger
from loomsift.sources.tables import removed, whole_folders

Signals = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def facts_ledger(root: str) -> Ledger:
    return Ledger(f"{root.rstrip('/')}/facts", FACTS)


def ingested(batch: DataFrame, epoch: int, ledger: Ledger, signals: Signals) -> None:
    """Adds the facts of a micro-batch of raw rows to those of the epochs before; signals(batch) gives signals and refs.

    What counts once (feedback on an item, the view of a digest) is looked up in the ledger, so exports that overlap, or a
    batch that runs twice, count it once.
    """
    spark = batch.sparkSession
    ledger.compact(spark, epoch)
    ledger.write(routed(*signals(batch), ledger.before(spark, epoch)), epoch)


def ingest_stream(rows: DataFrame, signals: Signals, root: str) -> Ledger:
    """Runs a stream of raw rows until it has read all there is; run again, it goes on where it stopped."""
    ledger = facts_ledger(root)
    run = rows.writeStream.foreachBatch(lambda b, e: ingested(b, e, ledger, signals)).option("checkpointLocation", f"{root}/offsets").trigger(availableNow=True).start()
    run.awaitTermination()
    return ledger


#: What is known of an exposure: its latest row's time and source, whether it was opened, whether it was settled before.
HELD = "digest_id string, index int, last struct<t:timestamp,source:string>, opened boolean, done boolean"


def settled_ledger(root: str) -> Ledger:
    return Ledger(f"{root.rstrip('/')}/settled", "digest_id string, index int, source string, counted boolean")


def marks_ledger(root: str) -> Ledger:
    """Watermarks in ms: what each epoch has moved it to."""
    return Ledger(f"{root.rstrip('/')}/marks", "ms long", lambda marks: marks.agg(F.max("ms").alias("ms")))


def settled(batch: DataFrame, epoch: int, delay: str, root: str, horizon_ms: int = HORIZON_MS) -> None:
    """Settles what is due after a micro-batch of exposures (digest_id, index, source, opened, done, t).

    t is the event time of an exposure or of what happened to it. An exposure is due once the watermark (the latest t less
    `delay`) has passed the horizon after its latest row: it counts unless it was opened, and not at all if it was settled
    before (done). Rows behind the watermark of the epochs before are dropped; without a key they belong to no exposure.

    Each epoch writes the exposures that it has met or found open, and the next one reads those that were not due: two
    epochs of them are kept, so a batch that runs twice finds what it found. All of it is grouping: no exposure costs a call.
    """
    spark, folder = batch.sparkSession, lambda n: f"epoch={n:012d}"
    facts, marks, home = settled_ledger(root), marks_ledger(root), f"{root.rstrip('/')}/held"
    facts.compact(spark, epoch)
    marks.compact(spark, epoch)
    passed = marks.before(spark, epoch).agg(F.max("ms")).first()[0]
    due = lambda mark: F.unix_millis("last.t") + horizon_ms < mark
    yes = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    met = batch.where("digest_id is not null and index is not null and t is not null")
    met = met if passed is None else met.where(F.unix_micros("t") > passed * 1000)
    rows = met.select("digest_id", "index", F.struct("t", F.coalesce("source", F.lit("")).alias("source")).alias("last"), yes("opened"), yes("done"))
    before = sorted((name, path) for name, path in whole_folders(spark, home) if name < folder(epoch))
    if before and passed is not None:
        rows = rows.unionByName(spark.read.schema(HELD).parquet(before[-1][1]).where(~due(passed)))
    held = rows.groupBy("digest_id", "index").agg(F.max("last").alias("last"), F.bool_or("opened").alias("opened"), F.bool_or("done").alias("done"))
    held.write.mode("overwrite").parquet(f"{home}/{folder(epoch)}")
    held = spark.read.schema(HELD).parquet(f"{home}/{folder(epoch)}")
    latest = held.agg(F.unix_millis(F.max("last.t") - F.expr(f"INTERVAL '{delay}'"))).first()[0]
    if latest is not None and (passed is None or latest > passed):
        passed = latest
        marks.write(spark.createDataFrame([(passed,)], marks.schema), epoch)
        fresh = F.col("last.source")
        facts.write(held.where(due(passed) & ~F.col("done")).select("digest_id", "index", fresh.alias("source"), (~F.col("opened") & (fresh != "")).alias("counted")), epoch)
    for _, path in before[:-1]:
        removed(spark, path)


def settle_stream(exposures: DataFrame, delay: str, root: str, horizon_ms: int = HORIZON_MS) -> Ledger:
    """Runs a stream of exposures until it has read all there is, into the ledger at root/settled; run again, it goes on where
    it stopped."""
    run = exposures.writeStream.foreachBatch(lambda b, e: settled(b, e, delay, root, horizon_ms)).option("checkpointLocation", f"{root}/settling").trigger(availableNow=True).start()
    run.awaitTermination()
    return settled_ledger(root)
