"""A table that grows by epochs, for micro-batches that may run twice.

Every epoch owns one delta and may write it again; an epoch reads only what earlier ones left, so a batch that is run
again after a loss gives what it gave before. Once there are more than `every` deltas they are merged into a base, and
deltas and bases that it covers go: a read lists a bounded number of folders however long the stream has run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loomsift.sources.tables import removed, whole_folders


def unchanged(rows: DataFrame) -> DataFrame:
    return rows


@dataclass(frozen=True)
class Ledger:
    root: str
    schema: str
    #: What rows of several epochs become when they are merged.
    merged: Callable[[DataFrame], DataFrame] = unchanged
    every: int = 16

    def _folders(self, spark: SparkSession, before: int) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
        """(bases, deltas) of epochs before `before`; a base of an epoch holds those before it."""
        found = [(kind, int(n), path) for name, path in whole_folders(spark, self.root) for kind, _, n in [name.partition("=")]]
        bases = sorted((n, p) for kind, n, p in found if kind == "base" and n <= before)
        return bases, sorted((n, p) for kind, n, p in found if kind == "delta" and n < before)

    def before(self, spark: SparkSession, epoch: int = 2**62) -> DataFrame:
        """What the epochs before `epoch` left (all epochs, if it is not given)."""
        bases, deltas = self._folders(spark, epoch)
        start = bases[-1][0] if bases else 0
        paths = [p for _, p in bases[-1:]] + [p for n, p in deltas if n >= start]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame, epoch: int) -> None:
        """The delta of an epoch; writing it again replaces it."""
        rows.write.mode("overwrite").parquet(f"{self.root}/delta={epoch:012d}")

    def compact(self, spark: SparkSession, epoch: int) -> None:
        """Merges what lies before `epoch` into a base if it has too many deltas. Called by the batch of that epoch alone."""
        bases, deltas = self._folders(spark, epoch)
        start = bases[-1][0] if bases else 0
        if sum(n >= start for n, _ in deltas) > self.every:
            self.merged(self.before(spark, epoch)).write.mode("overwrite").parquet(f"{self.root}/base={epoch:012d}")
            start = epoch
        for n, path in [*((n, p) for n, p in bases if n < start), *((n, p) for n, p in deltas if n < start)]:
            removed(spark, path)
