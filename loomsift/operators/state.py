"""State tables of rounds: archive, references, digests, engagements, signals, and merged packs.

State is a table that a round reads and a new one that it writes; nothing is changed in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.functions.text import detect_lang
from loomsift.functions.urls import canonical_url
from loomsift.lineage import written
from loomsift.operators.dedupe import latest_of, retain
from loomsift.operators.order import ranged, running

# How much of each state is kept.
ARCHIVE_MAX, REFS_MAX, DIGESTS_MAX, ENGAGEMENTS_MAX = 20_000, 500, 30, 5000
POST_ID = "^[a-z0-9-]+:[a-z0-9]+:\\d+$"
REF = "^[a-z0-9]+:\\d+$"


def archive_merged(archive: DataFrame, items: DataFrame, now_ms: int, most: int | None = ARCHIVE_MAX) -> DataFrame:
    """archive (id, title, url, source, first_seen, last_seen, hits, pushed, seq) after a round's items (id, title, url, source, seq).

    New ids come in with one hit; each further row of an id is a hit more. Beyond `most` rows (None: no bound) those
    pushed, then those seen last, stay; ties go to the older entry.
    """
    hits = items.groupBy("id").agg(F.count("*").alias("_n"), F.min("seq").alias("seq"))
    fresh = items.join(hits, ["id", "seq"]).dropDuplicates(["id"])
    last = archive.agg(F.coalesce(F.max("seq"), F.lit(-1)).alias("_last"))
    old = archive.join(hits.select("id", "_n"), "id", "left")
    seen = F.col("_n").isNotNull()
    kept = old.select(
        "id", "title", "url", "source", "first_seen", F.when(seen, F.lit(now_ms)).otherwise(F.col("last_seen")).alias("last_seen"), (F.col("hits") + F.coalesce("_n", F.lit(0))).alias("hits"), "pushed", "seq"
    )
    now = F.lit(now_ms).cast("long")
    new = fresh.join(archive.select("id"), "id", "left_anti").crossJoin(F.broadcast(last)).select(
        "id", "title", "url", "source", now.alias("first_seen"), now.alias("last_seen"), F.col("_n").alias("hits"), F.lit(False).alias("pushed"), (F.col("seq") + F.col("_last") + 1).alias("seq")
    )
    return retain(kept.unionByName(new), most, F.desc("pushed"), F.desc("last_seen"), F.asc("seq"), F.asc("id"))


def pushed_marked(archive: DataFrame, ids: DataFrame) -> DataFrame:
    marks = ids.select("id").distinct().withColumn("_now", F.lit(True))
    return archive.join(marks, "id", "left").withColumn("pushed", F.col("pushed") | F.coalesce("_now", F.lit(False))).drop("_now")


def refs_registered(refs: DataFrame, new: DataFrame, most: int = REFS_MAX) -> DataFrame:
    """refs (ref, digest_id, item_id, source, seq): the newest of each ref, the last `most` by its first place."""
    bad = new.where(~F.col("ref").rlike(REF)).limit(1).collect()
    if bad:
        raise ValueError(f"not a reference: {bad[0].ref}")
    both = refs.unionByName(new)
    place = both.groupBy("ref").agg(F.min("seq").alias("_place"))
    newest = latest_of(both, ["ref"], F.desc("seq")).join(place, "ref").withColumn("seq", F.col("_place")).drop("_place")
    return retain(newest, most, F.desc("seq"), F.asc("ref"))


def digest_saved(digests: DataFrame, digest: DataFrame, most: int = DIGESTS_MAX) -> DataFrame:
    """digests (digest_id, generated_at, clusters, seq): the new one replaces its namesake; the newest `most` stay."""
    return retain(digests.join(digest.select("digest_id"), "digest_id", "left_anti").unionByName(digest), most, F.desc("seq"))


def first_feedback(feedback: DataFrame) -> DataFrame:
    """One row for each (digest_id, item_id, signal): the first by seq."""
    return latest_of(feedback, ["digest_id", "item_id", "signal"], F.asc("seq"))


def engagements_kept(engagements: DataFrame, most: int = ENGAGEMENTS_MAX) -> DataFrame:
    return retain(engagements, most, F.desc("seq"))


def post_parts(signals: DataFrame) -> DataFrame:
    """signals with digest_id and index of a post_id `persona:digest:index`; null if it is none."""
    ok = F.col("post_id").rlike(POST_ID)
    parts = F.split("post_id", ":")
    return signals.withColumn("digest_id", F.when(ok, parts[1])).withColumn("index", F.when(ok, parts[2].try_cast("int")))


FACTS = "kind string, digest_id string, index int, item_id string, source string, seq long"


def routed(signals: DataFrame, refs: DataFrame, recorded: DataFrame | None = None) -> DataFrame:
    """Facts (kind, digest_id, index, item_id, source, seq) from signals (post_id, dwell_ms, completed, chat_turns,
    dismissed, reaction, favorite, seq), for posts whose reference (ref, item_id, source) is known.

    kind is expand (dwelt on, read through or talked about), view (the first expand of a digest), up (satisfied) or down
    (dismissed or stopped). A signal may give several facts. Feedback counts only once for each item, and the view once for
    each digest; expands count each time. A favourite is an up that comes after all signals; only one that is new counts,
    and then as an expand too. recorded: the facts of earlier batches; what counts once counts once over all of them.
    """
    named = post_parts(signals).where("digest_id is not null").withColumn("ref", F.concat_ws(":", "digest_id", "index"))
    both = named.join(refs.select("ref", "item_id", "source"), "ref")
    yes = lambda c: F.coalesce(c, F.lit(False))
    favorite = yes(F.col("favorite"))
    opened = ~favorite & (yes(F.col("dwell_ms") > 0) | yes(F.col("completed")) | yes(F.col("chat_turns") > 0))
    up = favorite | yes(F.col("reaction") == "satisfied")
    down = ~favorite & (yes(F.col("dismissed")) | yes(F.col("reaction") == "stopped"))
    kinds = F.array_compact(F.array(F.when(opened, "expand"), F.when(up, "up"), F.when(down, "down")))
    facts = both.withColumn("favorite", favorite).withColumn("kind", F.explode(kinds))
    expands = facts.where("kind = 'expand'")
    once = latest_of(facts.where("kind in ('up', 'down')"), ["digest_id", "item_id", "kind"], F.asc("favorite"), F.asc("seq"))
    views = latest_of(expands, ["digest_id"], F.asc("seq")).withColumn("kind", F.lit("view"))
    if recorded is not None:
        once = once.join(recorded.where("kind in ('up', 'down')").select("digest_id", "item_id", "kind"), ["digest_id", "item_id", "kind"], "left_anti")
        views = views.join(recorded.where("kind = 'view'").select("digest_id"), "digest_id", "left_anti")
    liked = once.where("favorite").withColumn("kind", F.lit("expand"))
    columns = ["kind", "digest_id", "index", "item_id", "source", "seq"]
    return expands.select(columns).unionByName(liked.select(columns)).unionByName(once.select(columns)).unionByName(views.select(columns))


def pack_posts(published: DataFrame, persona: str, display: str, generated_ms: int) -> DataFrame:
    """Published posts (id, title, hooks, summary, body, url, why, published_at) as the rows of a pack.

    The language is told anew from the summary; an unknown date becomes the time of the pack.
    """
    at = F.timestamp_millis(F.when(F.col("published_at") > 0, F.col("published_at")).otherwise(F.lit(generated_ms)))
    return published.select(
        "id", "title", "hooks", "summary", "body", detect_lang(F.col("summary")).alias("lang"),
        F.struct(F.lit(f"{persona}-bot").alias("id"), F.lit(display).alias("name"), F.lit("user").alias("kind")).alias("author"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"), F.col("url").alias("source_url"), "why",
    )


def pack_brief(posts: DataFrame) -> DataFrame:
    """What a pack says beside its posts (id, why): (post_id, why, source) for each of them. Its reasons are made before anybody
    reads the pack, so their source is static."""
    return posts.select(F.col("id").alias("post_id"), "why", F.lit("static").alias("source"))


def contract_breaks(posts: DataFrame, brief: DataFrame | None = None) -> DataFrame:
    """(rule, n) of what a pack of posts (id, source_url) breaks; no rows if it is sound. With its brief, that must have as many
    entries as there are posts."""
    canon = canonical_url(F.col("source_url"))
    whole = posts.agg(
        F.count_if(~F.col("id").rlike(POST_ID)).alias("id"),
        (F.count("*") - F.count_distinct("id")).alias("duplicate id"),
        F.count_if(F.trim("source_url") == "").alias("missing url"),
        (F.count_if(canon != "") - F.count_distinct(F.when(canon != "", canon))).alias("duplicate url"),
    )
    if brief is not None:
        counts = posts.agg(F.count("*").alias("posts")).crossJoin(brief.agg(F.count("*").alias("said")))  # one row each
        whole = whole.crossJoin(counts.select(F.abs(F.col("posts") - F.col("said")).alias("brief")))
    return whole.unpivot([], whole.columns, "rule", "n").where("n > 0")


def pack_merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Posts (id, source_url, ...) of an earlier pack and a new one: by canonical url new content takes the old post's
    id, other new posts come in, in order of their numbers. One whose id is taken moves up to the next free number of
    its prefix.

    With the numbers of a prefix in order, the k-th new post takes the free number of index k + max(g(j) - j for j up to k),
    g(j) being how many numbers below the own one of the j-th are free. Running counts and maxima are scanned in ranges, so
    a prefix that all posts share is no single task. Rows of the result are in no order; their ids have one.
    """
    key = canonical_url(F.col("source_url"))
    number = lambda c: F.coalesce(F.regexp_extract(c, ":(\\d+)$", 1).try_cast("long"), F.lit(2**53))
    prefix = lambda c: F.regexp_extract(c, "^(.*:)\\d+$", 1)
    a = old.withColumn("_key", key)
    b = latest_of(new.withColumn("_key", key), ["_key"], F.desc(number(F.col("id"))))
    replaced = b.join(a.select("_key", F.col("id").alias("_old")), "_key").withColumn("id", F.col("_old")).drop("_old")
    untouched = a.join(b.select("_key"), "_key", "left_anti")
    added = b.join(a.select("_key"), "_key", "left_anti").withColumns({"_prefix": prefix(F.col("id")), "_n": number(F.col("id"))})
    used = a.select(prefix(F.col("id")).alias("_prefix"), number(F.col("id")).alias("_n")).distinct()
    columns = [c for c in added.columns if c not in ("_prefix", "_n")]
    empty = F.lit(None)
    both = added.withColumn("_used", F.lit(False)).unionByName(used.select(*[empty.alias(c) for c in columns], "_prefix", "_n", F.lit(True).alias("_used")))
    both = both.withColumn("_prefix", F.coalesce("_prefix", F.lit("")))
    is_used, is_new = F.col("_used").cast("long"), (~F.col("_used")).cast("long")
    # Used numbers stand after new posts of the same number, so that running counts are of those below.
    in_order = ["_n", "_used", "id"]
    counted = running(ranged(both, "_prefix", *in_order), "_prefix", in_order, {"_below": is_used, "_count": is_new})
    counted = written(counted.withColumn("_k", F.col("_count") - 1).drop("_count"), "pack-counted")
    gap = F.when(~F.col("_used"), F.col("_n") - F.col("_below") - F.col("_k"))
    indexed = running(counted, "_prefix", in_order, maxima={"_gap": gap})
    # For a used number: how many free ones lie below it.
    free = indexed.withColumn("_free", F.when(F.col("_used"), F.col("_n") - (F.col("_below") - 1)).otherwise(F.col("_k") + F.col("_gap"))).drop("_p", "_gap")
    by_free = ["_free", F.desc("_used"), "_n"]
    placed = running(ranged(free, "_prefix", *by_free), "_prefix", by_free, {"_skip": is_used})
    placed = placed.where(~F.col("_used")).withColumn("_n", F.col("_free") + F.col("_skip")).drop("_skip", "_p")
    placed = placed.withColumn("id", F.concat("_prefix", F.col("_n").cast("string")))
    columns = old.columns
    return untouched.select(columns).unionByName(replaced.select(columns)).unionByName(placed.select(columns))
