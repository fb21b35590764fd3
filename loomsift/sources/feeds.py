"""Feed payloads as items: one parser for each kind of source, all native expressions over a table of payloads.

Payloads come as rows (source, url, payload): what a fetch of that source gave. Each parser returns (source, pos, title,
body, url, published_at), one row for each entry; `items_of` routes every payload to the parser of its source's kind,
gives ids and the order of arrival, and lists the sources that gave nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.functions import text as T
from loomsift.functions.urls import canonical_url, is_public_https, is_safe_link
from loomsift.lineage import written

# How much of a body the kinds of sources keep, and the widest payload that is read.
BLOCK_MAX, PAGE_MAX, TOPIC_MAX, TWEET_MAX, TWEET_TITLE, PAYLOAD_MAX = 6000, 2000, 600, 1000, 120, 2 * 1024 * 1024
_DATES = ("d MMM yyyy HH:mm:ss Z", "MMM d HH:mm:ss Z yyyy", "yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ssZ")
#: Forms that name no zone: UTC, whatever the session's zone is.
_ZONELESS = ("yyyy-MM-dd'T'HH:mm:ss[.SSS]", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def _utc(date: Column, form: str) -> Column:
    return F.try_to_timestamp(F.concat(date, F.lit(" +0000")), F.lit(f"{form} Z"))


def millis(date: Column) -> Column:
    """Epoch milliseconds of a date in the forms that feeds use, 0 for others."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(date), "^[A-Z][a-z]{2},? ", ""), " (GMT|UTC|UT|Z)(?= |$)", " +0000")
    found = [F.try_to_timestamp(plain, F.lit(f)) for f in _DATES] + [_utc(plain, f) for f in _ZONELESS]
    return F.coalesce(*[F.unix_millis(t) for t in found], F.lit(0).cast("long"))


def _or(*choices: Column) -> Column:
    """The first choice that is neither null nor empty, else an empty string."""
    return F.coalesce(*[F.when(c != "", c) for c in choices], F.lit(""))


def _rows(found: DataFrame, title: Column, body: Column, url: Column, published: Column) -> DataFrame:
    return found.select(
        "source", F.col("pos").cast("long").alias("pos"), F.coalesce(title, F.lit("")).alias("title"), F.coalesce(body, F.lit("")).alias("body"),
        F.coalesce(url, F.lit("")).alias("url"), F.coalesce(published.cast("long"), F.lit(0).cast("long")).alias("published_at"),
    )


_LINK = "array<struct<_href string, _rel string, _VALUE string>>"
_ITEM = "title string, description string, summary string, `content:encoded` string, pubDate string, `dc:date` string, link string"
_ENTRY = f"title string, summary string, content string, updated string, published string, link {_LINK}"


def rss(payloads: DataFrame) -> DataFrame:
    """RSS items, else Atom entries. Of an Atom entry's links the alternate one, else the first; unsafe links are blank."""
    atom = F.col("payload").rlike("(?is)<feed[\\s>]")
    options = {"mode": "PERMISSIVE", "ignoreNamespace": "false"}
    item = payloads.where(~atom).select("source", F.posexplode_outer(F.from_xml("payload", f"channel struct<item array<struct<{_fields(_ITEM)}>>>", options)["channel"]["item"]).alias("pos", "e"))
    item = item.where("e is not null").select("source", "pos", "e.*")
    date = F.coalesce("pubDate", "dc:date", F.lit(""))
    one = _rows(item, F.col("title"), _or(F.col("description"), F.col("summary"), F.col("content:encoded")), _safe(F.col("link")), millis(date))
    entry = payloads.where(atom).select("source", F.posexplode_outer(F.from_xml("payload", f"entry array<struct<{_fields(_ENTRY)}>>", options)["entry"]).alias("pos", "e"))
    entry = entry.where("e is not null").select("source", "pos", "e.*")
    link = F.coalesce(F.get(F.filter("link", lambda k: k["_rel"] == "alternate"), 0)["_href"], F.get(F.filter("link", lambda k: k["_href"].isNotNull()), 0)["_href"])
    two = _rows(entry, F.col("title"), _or(F.col("summary")), _safe(link), millis(F.coalesce("updated", "published", F.lit(""))))
    return one.unionByName(two)


def _fields(ddl: str) -> str:
    """'a string, b int' as the fields of a struct: 'a: string, b: int'."""
    out, depth, start = [], 0, 0
    for k, c in enumerate(ddl + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            name, _, kind = ddl[start:k].strip().partition(" ")
            out.append(f"{name}: {kind.replace('struct<_href string, _rel string, _VALUE string>', 'struct<_href: string, _rel: string, _VALUE: string>')}")
            start = k + 1
    return ", ".join(out)


def _safe(url: Column) -> Column:
    return F.when(is_safe_link(F.trim(url)), F.trim(url)).otherwise(F.lit(""))


def repositories(payloads: DataFrame) -> DataFrame:
    """Repository search results: 'owner/name: description'; description, stars and topics as the body."""
    kind = "items array<struct<full_name: string, description: string, html_url: string, created_at: string, stargazers_count: bigint, topics: array<string>>>"
    found = payloads.select("source", F.posexplode(F.from_json("payload", kind)["items"]).alias("pos", "e")).select("source", "pos", "e.*")
    about = F.trim(F.coalesce("description", F.lit("")))
    stars = F.when(F.col("stargazers_count") != 0, F.concat(F.col("stargazers_count").cast("string"), F.lit(" stars")))
    body = F.concat_ws(" · ", F.when(about != "", about), stars, F.when(F.size("topics") > 0, F.array_join("topics", " ")))
    title = F.when(about != "", F.concat(F.col("full_name"), F.lit(": "), about)).otherwise(F.col("full_name"))
    return _rows(found, title, body, F.col("html_url"), millis(F.coalesce("created_at", F.lit(""))))


def _blocks(payloads: DataFrame, mark: str) -> DataFrame:
    """One row for each block that begins with a mark at the start of a line."""
    found = payloads.select("source", F.posexplode(F.split("payload", f"(?m)^{mark}")).alias("pos", "block"))
    return found.where("pos > 0").withColumn("title", F.trim(F.regexp_extract("block", "^([^\\n]*)", 1)))


def search_blocks(payloads: DataFrame) -> DataFrame:
    """Search results as text blocks: Title, URL, Published, and what follows Highlights."""
    found = _blocks(payloads, "Title: ").withColumn("link", F.regexp_extract("block", "(?m)^URL: (\\S*)", 1))
    after = F.when(F.col("block").rlike("(?m)^Highlights:\\s*$"), F.regexp_replace("block", "(?ms)\\A.*?^Highlights:\\s*$", "")).otherwise(F.lit(""))
    body = F.substring(F.trim(T.strip(F.regexp_replace(F.regexp_replace(after, "(?m)^---$", ""), "\\n{2,}", "\n"))), 1, BLOCK_MAX)
    date = F.trim(F.regexp_extract("block", "(?m)^Published: (.*)$", 1))
    return _rows(found.where((F.col("title") != "") & is_safe_link(F.col("link"))), F.col("title"), body, F.col("link"), millis(date))


def markdown_blocks(payloads: DataFrame) -> DataFrame:
    """Numbered markdown results inside a JSON-RPC answer; links must be public https."""
    answer = F.from_json("payload", "result struct<content: array<struct<type: string, text: string>>>")["result"]["content"]
    text = F.coalesce(F.get(F.filter(answer, lambda c: c["type"] == "text"), 0)["text"], F.lit(""))
    found = _blocks(payloads.withColumn("payload", text), "### \\d+\\. ").withColumn("link", F.regexp_extract("block", "\\*\\*URL\\*\\*: (\\S*)", 1))
    body = T.strip(F.regexp_replace(F.regexp_replace("block", "(?m)^- \\*\\*URL\\*\\*: .*\\n?", ""), "\\n{2,}", "\n"))
    return _rows(found.where((F.col("title") != "") & is_public_https(F.col("link"))), F.col("title"), F.substring(body, 1, BLOCK_MAX), F.col("link"), F.lit(0))


def topics(payloads: DataFrame) -> DataFrame:
    """Forum topics as a JSON array; without text, node and author are the body. Dates are seconds."""
    kind = "array<struct<title: string, url: string, content: string, created: bigint, member: struct<username: string>, node: struct<title: string>>>"
    found = payloads.select("source", F.posexplode(F.from_json("payload", kind)).alias("pos", "e")).select("source", "pos", "e.*")
    who = F.concat(F.lit("Node: "), F.coalesce("node.title", F.lit("unknown")), F.lit(" · Author: "), F.coalesce("member.username", F.lit("unknown")))
    body = _or(F.substring("content", 1, TOPIC_MAX), who)
    return _rows(found, F.col("title"), body, _safe(F.col("url")), F.col("created") * 1000)


def video_listing(payloads: DataFrame, base: str = "https://www.bilibili.com/video/") -> DataFrame:
    """Listings of `- id:` records with `key: value` lines: bvid, title, author and play."""
    found = payloads.select("source", F.posexplode(F.split("payload", "(?m)^\\s*- id: \\S+.*$")).alias("pos", "block")).where("pos > 0")
    value = lambda k: F.trim(F.regexp_extract("block", f"(?m)^\\s+{k}:[ \\t]*(.*)$", 1))
    plays = F.coalesce(value("play").try_cast("long"), F.lit(0))
    body = F.concat(value("author"), F.lit(" · "), F.format_number(plays, 0), F.lit(" plays"))
    return _rows(found, value("title"), body, F.when(value("bvid") != "", F.concat(F.lit(base), value("bvid"))), F.lit(0))


def video_lines(payloads: DataFrame) -> DataFrame:
    """One JSON object for each line; lines that are none are skipped, as are entries without title or address."""
    kind = "id string, title string, url string, webpage_url string, channel string, uploader string, view_count bigint, upload_date string"
    found = payloads.select("source", F.posexplode(F.split("payload", "\\n")).alias("pos", "line")).where(F.startswith(F.trim("line"), F.lit("{")))
    found = found.select("source", "pos", F.from_json(F.trim("line"), kind).alias("e")).select("source", "pos", "e.*")
    link = F.coalesce("webpage_url", "url", F.concat(F.lit("https://www.youtube.com/watch?v="), F.col("id")), F.lit(""))
    body = F.concat(F.coalesce("channel", "uploader", F.lit("unknown channel")), F.lit(" · "), F.format_number(F.coalesce("view_count", F.lit(0)), 0), F.lit(" views"))
    date = F.when(F.length("upload_date") == 8, F.unix_millis(_utc(F.col("upload_date"), "yyyyMMdd")))
    return _rows(found.where((F.coalesce(F.trim("title"), F.lit("")) != "") & (link != "")), F.trim("title"), body, link, date)


def pages_read(payloads: DataFrame) -> DataFrame:
    """Pages by a reader, or by the second reader where the first gave nothing (column fallback): title and body."""
    has = F.coalesce("payload", F.lit("")) != ""
    text = F.when(has, F.col("payload")).otherwise(F.coalesce("fallback", F.lit("")))
    found = payloads.withColumn("text", text).where("text <> ''").withColumn("pos", F.lit(0))
    first = F.trim(F.regexp_extract("text", "(?m)^Title: (.*)$", 1))
    second = F.trim(F.regexp_extract("text", "(?m)^#{1,3} (.+)$", 1))
    body = F.when(has, F.regexp_replace("text", "(?m)^(Title|URL Source):.*$", "")).otherwise(F.regexp_replace(F.regexp_replace("text", "(?m)^#{1,3} .+$", ""), "(?m)^URL:.*$", ""))
    return _rows(found, _or(F.when(has, first).otherwise(second), F.col("url")), F.substring(T.strip(body), 1, PAGE_MAX), F.col("url"), F.lit(0))


def posts(payloads: DataFrame) -> DataFrame:
    """Timeline posts: short links taken out, the first line as the title."""
    kind = "ok boolean, data array<struct<id: string, text: string, author: struct<screenName: string>, createdAtISO: string, createdAt: string>>"
    whole = payloads.select("source", F.from_json("payload", kind).alias("j")).where("j.ok")
    found = whole.select("source", F.posexplode("j.data").alias("pos", "e")).select("source", "pos", "e.*").where("coalesce(id, '') <> '' and coalesce(text, '') <> ''")
    text = T.strip(F.regexp_replace("text", "https://t\\.co/\\w+", ""))
    handle = F.coalesce("author.screenName", F.lit(""))
    link = F.when(handle != "", F.concat(F.lit("https://x.com/"), handle, F.lit("/status/"), F.col("id"))).otherwise(F.concat(F.lit("https://x.com/i/web/status/"), F.col("id")))
    date = millis(F.coalesce("createdAtISO", F.lit("")))
    return _rows(found, F.substring(F.substring_index(text, "\n", 1), 1, TWEET_TITLE), F.substring(text, 1, TWEET_MAX), link, F.when(date > 0, date).otherwise(millis(F.coalesce("createdAt", F.lit("")))))


PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "rss": rss, "github": repositories, "exa": search_blocks, "anysearch": markdown_blocks, "v2ex": topics, "bili": video_listing, "ytsearch": video_lines, "jina": pages_read, "twitter": posts,
}


def items_of(payloads: DataFrame, sources: DataFrame, most: int | None = PAYLOAD_MAX) -> tuple[DataFrame, DataFrame]:
    """(items, skipped) from payloads (source, url, payload, fallback) and sources (source, type, ordinal, enabled).

    Items have ids and seq, the order of sources and then of entries. Skipped are enabled sources whose payload is
    missing, longer than `most` bytes (None: no bound), or holds no entry: one that fails stops no other.
    """
    # A registry of sources has a row for each source, however much they send: no payload moves to meet it.
    wanted = F.broadcast(sources.where("enabled").select("source", "type", "ordinal"))
    # Written by kind once: whatever the payloads come from is read once, and each parser reads its own kind.
    short = payloads if most is None else payloads.where(F.octet_length(F.coalesce("payload", F.lit(""))) <= most)
    sound = written(short.join(wanted, "source"), "payloads", "type")
    found = None
    for kind, parse in PARSERS.items():
        part = parse(sound.where(F.col("type") == kind))
        found = part if found is None else found.unionByName(part)
    canon = canonical_url(F.col("url"))
    items = found.join(wanted.select("source", "ordinal"), "source").select(
        T.item_id(canon, F.col("title"), F.col("body")).alias("id"), "source", "title", "body", "url", "published_at", (F.col("ordinal").cast("long") * 2**32 + F.col("pos")).alias("seq")
    )
    skipped = sources.where("enabled").join(found.select("source").distinct(), "source", "left_anti").select("source")
    return items, skipped
