"""What the operators of this subpackage share: table reading, hold-out rule, bounded samples, what workers keep."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bounds what a Python worker holds at once: whole texts of at most so many rows, or 16 MB of them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id's text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_by_label(df: DataFrame, label: str, cells: int) -> DataFrame:
    """At most `cells` rows for each value of `label` (columns doc_id, label and whatever df has).

    Every cell of a hash of doc_id gives its row of least hash, so the choice is spread over all rows, needs one
    aggregate of two long columns, and has the same bound at every size. Of rows that repeat a doc_id one is taken.
    """
    h = F.xxhash64(F.col("doc_id"), F.lit(17))
    picked = df.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).withColumn("_h", h)
    least = picked.groupBy(label, F.pmod("_h", F.lit(cells)).alias("_cell")).agg(F.min("_h").alias("_h"))
    rows = picked.join(F.broadcast(least.select(label, "_h")), [label, "_h"], "left_semi")
    return rows.dropDuplicates([label, "_h"]).drop("_h")


def one_text(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """sample (doc_id, ...) with text: of rows of docs (doc_id, text) that share a sampled doc_id the one whose text has the
    least hash, so there are never more rows than the sample has. Texts themselves are not shuffled but for those chosen."""
    mine = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample.select("doc_id").distinct()), "doc_id")
    one = mine.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return sample.join(one, "doc_id")


Kept = TypeVar("Kept")
_KEPT: dict[Hashable, object] = {}


def remembered(key: Hashable, make: Callable[[], Kept]) -> Kept:
    """What a Python worker keeps from task to task: that of one operator at a time, so stages do not add up."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]
