"""Places in a total order without sorting all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomsift.lineage import written


def numbered(rows: DataFrame, *order: str | Column) -> DataFrame:
    """rows with n, their place (from 0) in a total order.

    Rows are sorted in ranges; a range's first number is the sum of the sizes of those before it. Bounds of ranges are
    sampled anew whenever they are computed, so the ranges are written before anything is counted in them.
    """
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = rows.repartitionByRange(*keys).withColumn("_p", F.spark_partition_id())
    ranged = written(ranged, "numbered")
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_size"))  # one row for each range
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.withColumn("_start", before).select("_p", "_start")
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(*keys))
    return ranged.withColumn("_k", inside).join(F.broadcast(starts), "_p").withColumn("n", F.col("_start") + F.col("_k") - 1).drop("_p", "_k", "_start")


def ranged(rows: DataFrame, by: str, *order: str | Column) -> DataFrame:
    """rows in ranges of the order (by, order), a table with _p, the number of a row's range. `by` must not be null.

    Rows of one value of `by`, however many, are in several ranges: what running() needs to scan them in several tasks.
    """
    return written(rows.repartitionByRange(by, *order).withColumn("_p", F.spark_partition_id()), "ranged")


def running(rows: DataFrame, by: str, order: list[str | Column], sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None) -> DataFrame:
    """ranged() rows with running sums and maxima over each value of `by`, up to and with the row itself.

    The order must be the one of ranged() and leave no ties. Every range is scanned by itself; to it come the totals of the
    ranges before it that have the same value of `by`, which are as many rows as there are pieces of values.
    """
    wanted = {n: (c, F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))) for n, c in (sums or {}).items()}
    wanted |= {n: (c, F.max, F.greatest) for n, c in (maxima or {}).items()}
    rows = rows.withColumns({f"_v_{n}": c for n, (c, _, _) in wanted.items()})
    totals = rows.groupBy(by, "_p").agg(*[agg(f"_v_{n}").alias(f"_t_{n}") for n, (_, agg, _) in wanted.items()])
    earlier = Window.partitionBy(by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(by, "_p", *[agg(f"_t_{n}").over(earlier).alias(f"_b_{n}") for n, (_, agg, _) in wanted.items()])
    inside = Window.partitionBy(by, "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    both = rows.join(totals, [by, "_p"])
    out = both.withColumns({n: merge(F.col(f"_b_{n}"), agg(f"_v_{n}").over(inside)) for n, (_, agg, merge) in wanted.items()})
    return out.drop(*[f"{k}{n}" for n in wanted for k in ("_v_", "_b_")])
