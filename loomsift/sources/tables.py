"""State and configuration files: JSON lines with bad lines counted, typed configurations, atomic table versions."""

from __future__ import annotations

import hashlib
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, bad) of a JSON-lines path: lines that do not parse are skipped and kept apart."""
    whole = spark.read.schema(f"{schema}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    lines = spark.read.text(path).where(F.trim("value") != "")
    bad = lines.select(F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("j"), "value").where("j._bad is not null").select("value")
    return whole.where("_bad is null").drop("_bad"), bad


def config(spark: SparkSession, path: str) -> dict:
    """A JSON configuration through Spark's readers, so it may be in any store that Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def _mark(run: str) -> str:
    """What the name of a version ends with if a run has written it."""
    return f"-{hashlib.sha1(run.encode()).hexdigest()[:16]}" if run else ""


def version_written(df: DataFrame, root: str, run: str = "") -> str:
    """df as a new version of the state table under root; readers see a version only when it is whole. run: who writes it."""
    path = f"{root.rstrip('/')}/version={time.time_ns():020d}{_mark(run)}"
    df.write.mode("errorifexists").parquet(path)
    return path


def all_folders(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(name, path) of what lies directly under root."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(folder)] if fs.exists(folder) else []


def whole_folders(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(name, path) of the folders under root that a job wrote to the end (they have a _SUCCESS mark)."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    return [(n, p) for n, p in all_folders(spark, root) if fs.exists(path(p, "_SUCCESS"))]


def removed(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def latest_version(spark: SparkSession, root: str, before: str = "") -> str | None:
    """The newest whole version under root. before: a run whose own versions at the end do not count."""
    found = sorted((name, path) for name, path in whole_folders(spark, root) if name.startswith("version="))
    while before and found and found[-1][0].endswith(_mark(before)):
        found.pop()
    return found[-1][1] if found else None


def state(spark: SparkSession, root: str, schema: str, before: str = "") -> DataFrame:
    """The newest version of a state table, empty if there is none; with before, what that run found when it began."""
    path = latest_version(spark, root, before)
    return spark.read.schema(schema).parquet(path) if path else spark.createDataFrame([], schema)


def pack_written(posts: DataFrame, path: str, **header: str) -> None:
    """A pack as JSON lines: a header line's columns on every post, posts in order of id within files."""
    posts.select(*[F.lit(v).alias(k) for k, v in header.items()], F.struct(*posts.columns).alias("post")).write.mode("overwrite").json(path)
