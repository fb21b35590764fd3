"""State kept as JSON lines: what of it cannot be read is told by file and set apart, and the last whole version is served."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.sources.tables import all_folders, whole_folders


def by_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines with the columns of schema, file (the path of the file they stand in) and bad (the line, where it
    does not parse). Empty lines are none."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    parsed = F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return lines.select("file", parsed.alias("j"), "value").select("file", "j.*", "value").withColumn("bad", F.when(F.col("_bad").isNotNull(), F.col("value"))).drop("_bad", "value")


def health(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, n, bad): lines of each file, and how many do not parse."""
    return by_file(spark, path, schema).groupBy("file").agg(F.count("*").alias("n"), F.count("bad").alias("bad"))


def quarantined(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(rows, moved): the rows of the sound files under path, after every file with a bad line was renamed to a name that no
    reader takes (a dot in front, .corrupt-<time> behind). moved: its old and new path, for the report; nothing is deleted."""
    rows = by_file(spark, path, schema)
    broken = [r.file for r in health(spark, path, schema).where("bad > 0").select("file").toLocalIterator()]
    jvm, moved = spark._jvm, []
    for file in broken:
        old = jvm.org.apache.hadoop.fs.Path(file)
        new = jvm.org.apache.hadoop.fs.Path(old.getParent(), f".{old.getName()}.corrupt-{time.time_ns() // 1_000_000}")
        if old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new):
            moved.append((file, new.toString()))
    return (by_file(spark, path, schema) if moved else rows).drop("file", "bad"), moved


def state_written(df: DataFrame, root: str) -> str:
    """df as a new version of a state of JSON lines under root."""
    path = f"{root.rstrip('/')}/version={time.time_ns():020d}"
    df.write.mode("errorifexists").json(path)
    return path


def state_served(spark: SparkSession, root: str, schema: str) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(rows, moved): the newest version under root of which every line parses.

    A newer one that has lines that do not is renamed as a whole to corrupt-<time>-<its name>, so that it is looked at once,
    kept for whoever mends it, and never taken for an empty state. Without a whole version the state is empty, and moved
    says whether that is because there was none or because all were broken.
    """
    jvm, moved = spark._jvm, []
    versions = sorted((p for n, p in whole_folders(spark, root) if n.startswith("version=")), reverse=True)
    for path in versions:
        if health(spark, path, schema).where("bad > 0").isEmpty():
            return by_file(spark, path, schema).drop("file", "bad"), moved
        old = jvm.org.apache.hadoop.fs.Path(path)
        new = jvm.org.apache.hadoop.fs.Path(old.getParent(), f"corrupt-{time.time_ns() // 1_000_000}-{old.getName()}")
        if old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new):
            moved.append((path, new.toString()))
    return spark.createDataFrame([], schema), moved


def set_apart(spark: SparkSession, root: str) -> list[str]:
    """Names of the versions that state_served() has set apart."""
    return sorted(n for n, _ in all_folders(spark, root) if n.startswith("corrupt-"))
