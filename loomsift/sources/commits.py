"""Several state tables that change together: one manifest names a consistent set of their versions.

A commit writes every changed table to a folder of its own and then, as the last step, one small manifest that names the
folder of each table. The manifest appears by a rename that fails if its number is taken, so readers see all tables of a
commit or none, a commit that is broken off anywhere leaves the state before it, and of two writers of one number one
fails. Tables that a commit does not change keep their folder. Needs a file system whose rename is atomic.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loomsift.sources.tables import removed


class Conflict(RuntimeError):
    """Another writer made the commit that this one was to be."""


@dataclass(frozen=True)
class Commits:
    root: str
    #: Each table's columns; a table that no commit has written is empty.
    schemas: dict[str, str]

    def _fs(self, spark: SparkSession, name: str = "") -> tuple:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def numbers(self, spark: SparkSession) -> list[int]:
        """The commits there are, oldest first."""
        fs, path = self._fs(spark, "manifests")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))

    def manifest(self, spark: SparkSession, number: int) -> dict[str, str]:
        """The folder of each table that the commit names."""
        return json.loads(spark.read.text(f"{self.root}/manifests/{number:012d}.json", wholetext=True).first().value)

    def tables(self, spark: SparkSession, number: int | None = None) -> dict[str, DataFrame]:
        """All tables as the commit (the newest, if it is not given) left them."""
        numbers = self.numbers(spark)
        number = number if number is not None or not numbers else numbers[-1]
        folders = self.manifest(spark, number) if number is not None else {}
        return {n: spark.read.schema(s).parquet(f"{self.root}/{folders[n]}") if n in folders else spark.createDataFrame([], s) for n, s in self.schemas.items()}

    def commit(self, spark: SparkSession, changed: dict[str, DataFrame], after: int | None = None) -> int:
        """Writes the changed tables and then the manifest; gives the commit's number.

        after: the commit that the changes were made from (the newest, if it is not given); raises Conflict if another one
        has followed it.
        """
        numbers = self.numbers(spark)
        newest = numbers[-1] if numbers else 0
        if after is not None and after != newest:
            raise Conflict(f"commit {newest} has followed {after}")
        folders, number = self.manifest(spark, newest) if newest else {}, newest + 1
        for name, rows in changed.items():
            columns = rows.sparkSession.createDataFrame([], self.schemas[name]).columns
            folders[name] = f"tables/{name}/{number:012d}-{uuid.uuid4().hex}"
            rows.select(columns).write.parquet(f"{self.root}/{folders[name]}")
        self._publish(spark, number, folders)
        return number

    def _publish(self, spark: SparkSession, number: int, folders: dict[str, str]) -> None:
        fs, draft = self._fs(spark, f"manifests/_{number:012d}-{uuid.uuid4().hex}")
        _, final = self._fs(spark, f"manifests/{number:012d}.json")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise Conflict(f"commit {number} was made by another writer")

    def swept(self, spark: SparkSession, keep: int = 2) -> int:
        """Deletes what the newest `keep` commits do not name: older versions and what broken commits left. Gives the number of
        folders deleted. To be called by the only writer, between commits."""
        numbers = self.numbers(spark)
        named = {folder for n in numbers[-keep:] for folder in self.manifest(spark, n).values()}
        gone = 0
        for name in self.schemas:
            fs, path = self._fs(spark, f"tables/{name}")
            for status in fs.listStatus(path) if fs.exists(path) else ():
                if f"tables/{name}/{status.getPath().getName()}" not in named:
                    removed(spark, status.getPath().toString())
                    gone += 1
        for n in numbers[:-keep]:
            removed(spark, f"{self.root}/manifests/{n:012d}.json")
        fs, path = self._fs(spark, "manifests")
        for status in fs.listStatus(path) if fs.exists(path) else ():
            if status.getPath().getName().startswith("_"):
                removed(spark, status.getPath().toString())
        return gone
