"""Lineage cuts: tables written to the folder that driver and executors share, and read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only in local mode, where nothing else is set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{tempfile.gettempdir()}/checkpoints"


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """df as a table in the shared folder: a lost executor costs no recompute of what came before. Filters on the columns `by`
    read only their folders."""
    path = f"{shared_dir(df.sparkSession)}/loomsift/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back.select(df.columns) if by else back


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly over as many partitions as a shuffle has: for work that takes long a row on tables of few files. The
    number is not left to the size in bytes, by which so little text would be one partition."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside compile no method that the JVM would refuse to compile further (8,000 bytes): wide projections of long
    expressions run as many small methods instead of one large one that stays interpreted. The setting is put back."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unwritten(*frames: DataFrame) -> None:
    """Deletes tables made by written() that no later frame reads."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/loomsift/" in urlparse(folder).path:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
