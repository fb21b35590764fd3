"""Views of driver tables as feed items: id, source, title, body, url, published_at (epoch ms, 0 unknown), seq."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.functions import text as T

ITEM = ["id", "source", "title", "body", "url", "published_at", "seq"]


def title_of(text: Column) -> Column:
    """The first line."""
    return F.substring_index(text, "\n", 1)


def body_of(text: Column) -> Column:
    """What follows the title, without the line break between: nothing of a text is in neither."""
    return F.substr(text, F.length(title_of(text)) + 2)


def from_documents(docs: DataFrame) -> DataFrame:
    """documents as items; seq is doc_id, an explicit order that survives shuffles."""
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.withColumn("text", text)
    return whole.select(
        F.col("doc_id").cast("string").alias("id"),
        "source",
        title_of(F.col("text")).alias("title"),
        body_of(F.col("text")).alias("body"),
        F.lit("").alias("url"),
        F.lit(0).cast("long").alias("published_at"),
        F.col("doc_id").cast("long").alias("seq"),
    )


def from_pages(pages: DataFrame) -> DataFrame:
    """pages as items: the title element, the page's text without markup, the page's url."""
    html = F.coalesce(F.col("html"), F.lit(""))
    title = T.strip_html(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1))
    return pages.select(
        F.col("page_id").cast("string").alias("id"),
        F.lit("pages").alias("source"),
        title.alias("title"),
        T.strip_html(F.regexp_replace(html, "(?is)<head.*?</head>", " ")).alias("body"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.lit(0).cast("long").alias("published_at"),
        F.col("page_id").cast("long").alias("seq"),
    )


def from_events(events: DataFrame) -> DataFrame:
    """events as items without text: the kind of event is the source, its time in epoch ms the date of publication."""
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("source"),
        F.lit("").alias("title"),
        F.lit("").alias("body"),
        F.lit("").alias("url"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("published_at"),
        F.col("event_id").cast("long").alias("seq"),
    )
