"""First-wins deduplication, set operations and retention, all by aggregates and joins that split hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomsift.functions.urls import canonical_url
from loomsift.operators.order import numbered


def first_wins(items: DataFrame, key: str, known: DataFrame | None = None, order: str = "seq") -> DataFrame:
    """The first row of each key in the given order; keys of `known` (a column of the same name) have none.

    The first place is aggregated before any row moves, so a key with a third of all rows costs one row for each task.
    """
    firsts = items.groupBy(key).agg(F.min(order).alias(order))
    kept = items.join(firsts, [key, order], "left_semi")
    return kept if known is None else kept.join(known.select(key).distinct(), key, "left_anti")


def by_canonical_url(items: DataFrame, known: DataFrame, order: str = "seq") -> DataFrame:
    """items with canonical_url and rule: null for the kept, else why not. known: column canonical_url.

    Without a canonical url an item is kept. A known url never counts as seen in the batch.
    """
    named = items.withColumn("canonical_url", canonical_url(F.col("url")))
    firsts = named.where("canonical_url <> ''").groupBy("canonical_url").agg(F.min(order).alias("_first"))
    published = known.select("canonical_url").distinct().withColumn("_known", F.lit(True))
    both = named.join(firsts, "canonical_url", "left").join(published, "canonical_url", "left")
    rule = (
        F.when(F.col("canonical_url") == "", F.lit(None))
        .when(F.col("_known"), F.lit("fingerprint:alreadyPublished"))
        .when(F.col("_first") < F.col(order), F.lit("fingerprint:duplicateUrlInBatch"))
    )
    return both.withColumn("rule", rule.cast("string")).drop("_first", "_known")


#: Up to so many rows a top-k is cheaper than numbering; each of its tasks holds that many.
TOP_K = 100_000


def retain(rows: DataFrame, most: int | None, *order: Column) -> DataFrame:
    """The first `most` rows in an order that leaves no ties; all of them for None.

    A small bound is a distributed top-k. Beyond that rows are sorted in ranges and numbered, so no task holds them all.
    """
    if most is None:
        return rows
    if most <= TOP_K:
        return rows.orderBy(*order).limit(most)
    return numbered(rows, *order).where(F.col("n") < most).drop("n")


def latest_of(rows: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """One row for each key, the first in the order given."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_n", n).where("_n = 1").drop("_n")


def fingerprints_appended(known: DataFrame, published: DataFrame, most: int = 20_000) -> DataFrame:
    """Set union of canonical urls, the known before the new, of which the last `most` stay. known: canonical_url, seq."""
    new = published.select(canonical_url(F.col("url")).alias("canonical_url"), F.col("seq")).where("canonical_url <> ''")
    new = new.groupBy("canonical_url").agg(F.min("seq").alias("seq")).join(known.select("canonical_url"), "canonical_url", "left_anti")
    last = known.agg(F.coalesce(F.max("seq"), F.lit(-1)).alias("last"))
    both = known.select("canonical_url", "seq").unionByName(new.crossJoin(F.broadcast(last)).select("canonical_url", (F.col("seq") + F.col("last") + 1).alias("seq")))
    return retain(both, most, F.desc("seq"), F.asc("canonical_url"))


def set_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key and state (added, removed or kept) of two sets of keys."""
    a, b = (d.select(key).distinct() for d in (old, new))
    return (
        b.join(a, key, "left_anti").withColumn("state", F.lit("added"))
        .unionByName(a.join(b, key, "left_anti").withColumn("state", F.lit("removed")))
        .unionByName(b.join(a, key, "left_semi").withColumn("state", F.lit("kept")))
    )


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """Keys of more than one row, with their counts."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
