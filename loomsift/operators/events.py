"""Events: items of one story by shared rare entity words, caps for each event, and the diverse top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomsift.functions import text as T
from loomsift.lineage import written
from loomsift.operators.gates import GateConfig
from loomsift.operators.graph import components
from loomsift.operators.order import numbered


def first_k(rows: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """The first k rows of each key. Spark keeps k rows of a key in each task before the shuffle, so hot keys cost no more."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("_k", n).where(F.col("_k") <= k).drop("_k")


def document_frequency(items: DataFrame, config: GateConfig) -> DataFrame:
    """(token, df): in how many titles an entity word stands."""
    words = T.with_entities(items.select("title"), "title", "_entities", list(config.stopwords)).select(F.explode_outer("_entities").alias("token")).where("token is not null")
    return words.groupBy("token").agg(F.count("*").alias("df"))


def event_keys(items: DataFrame, config: GateConfig, background: DataFrame | None = None, background_size: int | None = None) -> DataFrame:
    """items (id, title, pos) with event_key, the id of the first item (by pos) of its event.

    Two items are of one event if they share an entity word that is rare enough in the background (the items themselves
    if none is given). Each word links its items to its first one, so a word of n items gives n - 1 edges, never n**2.
    """
    words = T.with_entities(items.select("pos", "title"), "title", "_entities", list(config.stopwords))
    # explode_outer, as explode would push a filter on the size of the tokens below all steps that make them.
    words = written(words.select("pos", F.explode_outer("_entities").alias("token")).where("token is not null"), "entity-words")  # read three times
    df = background if background is not None else words.groupBy("token").agg(F.count("*").alias("df"))
    size = background_size if background is not None and background_size is not None else items.count()
    limit = max(float(config.max_entity_df), config.max_entity_df_ratio * size)
    rare = words.join(df.where(F.col("df") > limit).select("token"), "token", "left_anti")
    first = rare.groupBy("token").agg(F.min("pos").alias("first"))
    edges = rare.join(first, "token").where(F.col("pos") > F.col("first")).select(F.col("pos").alias("x"), F.col("first").alias("y")).distinct()
    labels = components(edges).select(F.col("id").alias("pos"), F.col("comp"))
    # Names go to numbers first, texts only by their own number: an event may have most of the items.
    named = labels.join(items.select(F.col("pos").alias("comp"), F.col("id").alias("event_key")), "comp").select("pos", "event_key")
    return items.join(named, "pos", "left").withColumn("event_key", F.coalesce("event_key", "id"))


#: Rows of an event that meet their lead in one place; larger events are dealt over several.
EVENT_ROWS = 10_000


def with_lead(rows: DataFrame, lead: DataFrame) -> DataFrame:
    """rows (event_key, pos, ...) with what lead (event_key, ...) says of their event, at most EVENT_ROWS or so at one place."""
    sizes = rows.groupBy("event_key").agg(F.count("*").alias("_n")).where(F.col("_n") > EVENT_ROWS)
    hot = written(sizes.select("event_key", F.ceil(F.col("_n") / EVENT_ROWS).cast("int").alias("_parts")), "large-events")  # one in EVENT_ROWS rows at most
    dealt = rows.join(F.broadcast(hot), "event_key", "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("pos"), F.col("_parts")).cast("int"), F.lit(0)))
    copies = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    each = lead.join(F.broadcast(hot), "event_key", "left").withColumn("_part", F.explode(copies)).drop("_parts")
    return dealt.drop("_parts").join(each, ["event_key", "_part"]).drop("_part")


def capped_events(items: DataFrame, config: GateConfig) -> DataFrame:
    """items (id, title, pos, event_key) with kept: at most max_per_event of each event, in order of pos.

    The rest are demoted, not dropped; so are reposts, items whose title tokens are too like the event's first title.
    """
    named = items.withColumn("_tokens", T.tokens(F.col("title")))
    first = items.groupBy("event_key").agg(F.min("pos").alias("pos"))
    lead = items.select("event_key", "pos", "id", "title").join(first.select("pos"), "pos", "left_semi").select("event_key", T.tokens(F.col("title")).alias("_lead"), F.col("id").alias("_lead_id"))
    repost = (F.col("id") != F.col("_lead_id")) & (T.jaccard(F.col("_lead"), F.col("_tokens")) >= config.jaccard)
    flagged = with_lead(named, lead).withColumn("repost", repost).drop("_tokens", "_lead", "_lead_id")
    kept = first_k(flagged.where(~F.col("repost")), "event_key", "pos", config.max_per_event).select("id", F.lit(True).alias("_kept"))
    return flagged.join(kept, "id", "left").withColumn("kept", F.coalesce("_kept", F.lit(False))).drop("_kept")


def ordered(capped: DataFrame) -> DataFrame:
    """The order of publication: kept before demoted, each by falling score; ties by the event's first place, then pos."""
    place = capped.groupBy("event_key").agg(F.min("pos").alias("event_pos"))
    return capped.join(place, "event_key").orderBy(F.desc("kept"), F.desc("score"), "event_pos", "pos")


def selected(posts: DataFrame, target: int, max_per_event: int = 2) -> DataFrame:
    """posts (id, pos, event_key, passed) with state: accepted, filled, rejected, deferred or unread.

    Posts are read in order of pos until `target` are accepted, at most max_per_event of an event; those over that are
    deferred, and fill what is missing, in order, if the posts run out. Rejected posts count only as far as was read.
    """
    primary = first_k(posts.where("passed"), "event_key", "pos", max_per_event).select("id", F.lit(True).alias("_primary"))
    ranked = posts.join(primary, "id", "left").withColumn("_primary", F.coalesce("_primary", F.lit(False)))
    # The posts of the target-th place decide how far is read: a top-k of `target` rows, not a total order of all.
    top = ranked.where("_primary").orderBy("pos").limit(target).agg(F.count("*").alias("_n"), F.max("pos").alias("_last"))
    both = ranked.crossJoin(F.broadcast(top)).withColumn("_full", F.col("_n") >= target)
    read = ~F.col("_full") | (F.col("pos") <= F.col("_last"))
    deferred = both.where(~F.col("_full") & F.col("passed") & ~F.col("_primary")).orderBy("pos").limit(target).select("id", "pos", "_n")
    rank = F.row_number().over(Window.orderBy("pos"))  # of `target` rows at most
    fill = deferred.withColumn("_k", rank).where(F.col("_k") <= target - F.col("_n")).select("id", F.lit(True).alias("_fill"))
    state = (
        F.when(~read, "unread")
        .when(~F.col("passed"), "rejected")
        .when(F.col("_primary"), "accepted")
        .when(F.col("_fill"), "filled")
        .otherwise("deferred")
    )
    return both.join(fill, "id", "left").withColumn("state", state).drop("_primary", "_n", "_last", "_full", "_fill")


def oversubscribed(published: DataFrame, max_per_event: int = 2) -> DataFrame:
    """Events with more published posts than allowed, and how many they have; no rows if the selection was sound."""
    return published.groupBy("event_key").agg(F.count("*").alias("n")).where(F.col("n") > max_per_event)


def by_bar(candidates: DataFrame, least: float) -> DataFrame:
    """candidates (pos, score of a reviewer, null for none) with demoted and a new pos: those under the bar come last, the
    order within both parts stays. What has no score is under no bar."""
    demoted = F.coalesce(F.col("review") < least, F.lit(False))
    return numbered(candidates.withColumn("demoted", demoted).withColumnRenamed("pos", "_pos"), "demoted", "_pos").withColumnRenamed("n", "pos").drop("_pos")


def backfill(pool: DataFrame, published: DataFrame, most: int) -> DataFrame:
    """The best of a pool (id, score, pos) that are not published yet, ties by pos."""
    return pool.join(published.select("id"), "id", "left_anti").orderBy(F.desc("score"), "pos").limit(most)


def cluster_cards(members: DataFrame) -> DataFrame:
    """One row for each event of members (event_key, pos, title, summary): the first one's title, its summary with how many
    more there are, and the size."""
    first = members.groupBy("event_key").agg(F.min("pos").alias("pos"), F.count("*").alias("size"))
    lead = members.select("event_key", "pos", "title", "summary").join(first, ["event_key", "pos"])
    more = F.when(F.col("size") > 1, F.concat("summary", F.lit(" ("), (F.col("size") - 1).cast("string"), F.lit(" more)"))).otherwise(F.col("summary"))
    return lead.select("event_key", "title", more.alias("summary"), "size")


def misaligned(targets: DataFrame, staged: DataFrame) -> DataFrame:
    """Places at which two lists (pos, id) differ, with both ids; no rows if a staged job fits its targets."""
    a, b = targets.select("pos", F.col("id").alias("target")), staged.select("pos", F.col("id").alias("staged"))
    return a.join(b, "pos", "full").where(~F.col("target").eqNullSafe(F.col("staged")))
