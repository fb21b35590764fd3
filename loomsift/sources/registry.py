"""Sources as a Spark data source: payload files read in parallel, a partition each; one that fails is a row, not an error."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from loomsift.sources.feeds import PAYLOAD_MAX, items_of

PAYLOADS = "source string, url string, payload string, fallback string, problem string"


@dataclass
class Payload(InputPartition):
    source: str
    url: str
    path: str


class FeedReader(DataSourceReader):
    def __init__(self, sources: list[dict], root: str) -> None:
        self.sources, self.root = sources, root

    def partitions(self) -> list[Payload]:
        return [Payload(s["source"], s.get("url", ""), s.get("path", f"{self.root}/{s['source']}")) for s in self.sources]

    def read(self, partition: Payload | None) -> Iterator[tuple]:
        from pyarrow import fs

        if partition is None:  # what Spark asks for where there are no partitions
            return
        try:
            bare = re.sub("^file:/(?=[^/])", "/", partition.path)  # as Hadoop writes local paths
            store, path = fs.FileSystem.from_uri(bare if "://" in bare else f"file://{bare}")
            with store.open_input_stream(path) as stream:
                content = stream.read(PAYLOAD_MAX + 1)
            if len(content) > PAYLOAD_MAX:
                raise ValueError(f"more than {PAYLOAD_MAX} bytes")
            text = content.decode()
            yield partition.source, partition.url, text, None, None if text.strip() else "empty"
        except Exception as error:  # whatever keeps a payload from being read is the finding; the other sources go on
            yield partition.source, partition.url, None, None, f"{type(error).__name__}: {error}"[:200]


class FeedSource(DataSource):
    """`spark.read.format("feed_payloads")` with the options root (a folder of payload files) and sources, a JSON array of
    objects (source, url, and path where it is not root/source)."""

    @classmethod
    def name(cls) -> str:
        return "feed_payloads"

    def schema(self) -> str:
        return PAYLOADS

    def reader(self, schema: StructType) -> FeedReader:
        return FeedReader(json.loads(self.options["sources"]), self.options.get("root", ""))


def payloads(spark: SparkSession, sources: list[dict], root: str = "") -> DataFrame:
    """The payloads of sources (source, url, path), each read by a task of its own. A registry of sources is short: one line
    each."""
    spark.dataSource.register(FeedSource)
    return spark.read.format("feed_payloads").option("root", root).option("sources", json.dumps(sources)).load()


def collected(spark: SparkSession, sources: list[dict], root: str = "") -> tuple[DataFrame, DataFrame]:
    """(items, skipped) of the enabled sources (source, type, url, enabled, path) in their order; skipped: (source, problem),
    what kept a source from giving any item."""
    wanted = [s for s in sources if s.get("enabled", True)]
    table = spark.createDataFrame([(s["source"], s["type"], k, True) for k, s in enumerate(wanted)], "source string, type string, ordinal int, enabled boolean")
    read = payloads(spark, wanted, root)
    items, skipped = items_of(read.where("payload is not null").drop("problem"), table)
    why = read.where("problem is not null").select("source", "problem")
    return items, skipped.join(why, "source", "left").select("source", F.coalesce("problem", F.lit("no entry")).alias("problem"))
