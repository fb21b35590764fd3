"""Rounds over streams: reader signals, micro-batches merged into state tables, and batch numbers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.lineage import shared_dir
from loomsift.operators.state import routed
from loomsift.sources.ledger import Ledger

EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_signals(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """events as signals on posts, and the references of the posts that are known (indexes 0 to 7 of 50 digests)."""
    k = F.from_json("props", "k int")["k"]
    signals = events.select(
        F.concat_ws(":", F.lit("daily"), F.concat(F.lit("d"), (F.col("user_id") % 50).cast("string")), (k % 10).cast("string")).alias("post_id"),
        F.when(F.col("event_type").isin("click", "view"), F.col("value")).alias("dwell_ms"),
        F.lit(False).alias("completed"),
        F.lit(0).alias("chat_turns"),
        (F.col("event_type") == "error").alias("dismissed"),
        F.when(F.col("event_type") == "purchase", "satisfied").alias("reaction"),
        F.lit(False).alias("favorite"),
        F.col("event_id").alias("seq"),
    )
    spark = events.sparkSession
    refs = spark.range(400).select(
        F.concat_ws(":", F.concat(F.lit("d"), (F.col("id") % 50).cast("string")), F.floor(F.col("id") / 50).cast("string")).alias("ref"),
        F.concat(F.lit("i"), F.col("id").cast("string")).alias("item_id"),
        F.concat(F.lit("s"), F.floor(F.col("id") / 50).cast("string")).alias("source"),
    )
    return signals, refs


def summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("source").agg(F.sum("expands").alias("expands"))


def counts_ledger(root: str) -> Ledger:
    """Expands by source: deltas of epochs, added up when they are merged."""
    return Ledger(f"{root}/state", "source string, expands long", summed)


def merge_counts(batch: DataFrame, epoch: int, ledger: Ledger) -> None:
    """Adds the expands of a micro-batch to the state of the epochs before. A batch that runs twice counts once."""
    ledger.compact(batch.sparkSession, epoch)
    facts = routed(*event_signals(batch)).where("kind = 'expand'")
    ledger.write(facts.groupBy("source").agg(F.count("*").alias("expands")), epoch)


def event_stream(spark: SparkSession, source: str, files: int | None = None) -> DataFrame:
    """A stream over the event files of `source`, a file or a folder; `files` a micro-batch."""
    folder, _, name = source.rpartition("/")
    if not name.endswith(".parquet"):
        folder, name = source, ""
    reader = spark.readStream.schema(EVENT).option("pathGlobFilter", "*.parquet")
    reader = reader if files is None else reader.option("maxFilesPerTrigger", files)
    return reader.parquet(f"{folder}/{name.replace('.parquet', '')}*.parquet")


def streamed_expands(spark: SparkSession, source: str) -> DataFrame:
    """Expands by source from a stream over the files of `source`, run until it has read them all."""
    home = f"{shared_dir(spark)}/loomsift/stream-{uuid.uuid4().hex}"
    ledger = counts_ledger(home)
    run = event_stream(spark, source).writeStream.foreachBatch(lambda b, e: merge_counts(b, e, ledger)).option("checkpointLocation", f"{home}/offsets").trigger(availableNow=True).start()
    run.awaitTermination()
    return summed(ledger.before(spark))
