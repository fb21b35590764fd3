"""Scores, source weights, interest, metrics of a round, calibration and criteria."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomsift.functions import text as T
from loomsift.lineage import written

# Fixed values of the formulas.
ALPHA, PRIOR_UP, PRIOR_DOWN = 0.2, 1.0, 1.0
EXPANDS_PRIOR, IGNORED_PRIOR, HORIZON_MS = 1.0, 2.0, 24 * 3_600_000
DEFAULT_WEIGHT, NOT_NEW = 0.5, 0.75


def clamp(x: Column) -> Column:
    """Within 0 and 1; null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def round3(x: Column) -> Column:
    """To three places, halves up."""
    return F.floor(x * 1000 + 0.5) / 1000


def with_score(items: DataFrame, keywords: list[str], signals: list[str]) -> DataFrame:
    """items (title, body) with score, from the shares of keywords and signal words that they match."""
    hay = F.col("_hay")  # made once for each row, not for each word
    share = lambda words, full: F.least(F.lit(1.0), F.sqrt(F.size(T.keyword_hits(hay, words)).cast("double")) / F.sqrt(F.lit(float(full))))
    staged = T.once(items, _hay=T.haystack(F.concat("title", F.lit(" "), "body")))
    return staged.withColumn("score", 0.25 + 0.5 * share(keywords, 8) + 0.25 * share(signals, 6)).drop("_hay")


def weighted(items: DataFrame, weights: DataFrame) -> DataFrame:
    """items (source, score, is_new) with rank_score: by the source's weight (source, weight), less if not new."""
    both = items.join(weights, "source", "left")
    by_source = F.col("score") * (0.5 + F.coalesce("weight", F.lit(DEFAULT_WEIGHT)))
    return both.withColumn("rank_score", F.when(F.col("is_new"), by_source).otherwise(by_source * NOT_NEW)).drop("weight")


def feedback_by_source(feedback: DataFrame) -> DataFrame:
    """source, up, down."""
    return feedback.groupBy("source").agg(F.count_if(F.col("signal") == "up").alias("up"), F.count_if(F.col("signal") == "down").alias("down"))


def updated_weights(weights: DataFrame, stats: DataFrame) -> DataFrame:
    """Each weight moved by ALPHA towards the mean of its source's Beta posterior; without feedback that is 0.5."""
    both = weights.join(stats, "source", "left").na.fill(0, ["up", "down"])
    mean = (F.col("up") + PRIOR_UP) / (F.col("up") + F.col("down") + PRIOR_UP + PRIOR_DOWN)
    return both.select("source", clamp((1 - ALPHA) * F.col("weight") + ALPHA * mean).alias("weight"))


def feedback_token(feedback: DataFrame) -> str:
    """A digest of all feedback that changes if any row does; weights are computed anew only then.

    Rows are hashed apart and the hashes summed, so the order of rows and their number do not matter.
    """
    h = F.xxhash64(*[F.col(c) for c in sorted(feedback.columns)]).cast("decimal(38,0)")
    row = feedback.agg(F.count("*").alias("n"), F.coalesce(F.sum(h), F.lit(0)).alias("h")).select(F.sha2(F.concat_ws(":", "n", "h"), 256).alias("t"))
    return row.first().t


def refreshed_weights(weights: DataFrame, feedback: DataFrame, sources: DataFrame) -> DataFrame:
    """weights (source, weight, token) after feedback (source, signal, ...), one row for each of sources (source).

    token is that of the feedback the weights were made from. If it is the same now, no feedback has come since, and the
    weights stay as they are: moving them again would only pull them towards the middle.
    """
    token = feedback_token(feedback)
    told = weights.where(F.col("token") == token)
    moved = updated_weights(sources.select("source").distinct().join(weights.select("source", "weight"), "source", "left").na.fill(DEFAULT_WEIGHT, ["weight"]), feedback_by_source(feedback))
    if not told.isEmpty():
        moved = sources.select("source").distinct().join(told.select("source", "weight"), "source", "left").na.fill(DEFAULT_WEIGHT, ["weight"])
    return moved.withColumn("token", F.lit(token))


def interest(counts: DataFrame) -> DataFrame:
    """counts (source, exposures, expands) with interest, the mean of Beta(1, 2) after them."""
    return counts.withColumn("interest", (F.col("expands") + EXPANDS_PRIOR) / (F.col("exposures") + EXPANDS_PRIOR + IGNORED_PRIOR))


def settled(shown: DataFrame, engaged: DataFrame, done: DataFrame, now_ms: int, horizon_ms: int = HORIZON_MS) -> DataFrame:
    """What of shown (digest_id, index, source, at) settles now, with counted: shown long enough ago, not settled before
    (done), and an exposure without effect unless it was opened (engaged)."""
    key = ["digest_id", "index"]
    due = shown.where(F.col("at") + horizon_ms <= now_ms).join(done.select(*key), key, "left_anti").dropDuplicates(key)
    opened = engaged.select(*key).distinct().withColumn("_opened", F.lit(True))
    return due.join(opened, key, "left").withColumn("counted", F.col("_opened").isNull() & (F.coalesce("source", F.lit("")) != "")).drop("_opened")


def quantiles(values: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """(q, value) for each share q: the sorted values' element floor(q * n), 0 for none.

    Values are counted, and a place is found on running sums of the counts of ranges, so no task sorts them all. The
    ranges are written first: their bounds are sampled anew whenever they are computed.
    """
    counts = values.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n"))
    parts = written(counts.repartitionByRange("v").withColumn("_p", F.spark_partition_id()), "quantile-ranges")
    sums = sorted((r["_p"], r.n) for r in parts.groupBy("_p").agg(F.sum("n").alias("n")).collect())  # one row for each range
    total = sum(n for _, n in sums)
    out = None
    for q in shares:
        found = values.sparkSession.range(1).select(F.lit(0.0).alias("value"))
        place, before = min(total - 1, int(q * total // 1)), 0
        for p, n in sums:
            if before <= place < before + n:
                run = F.sum("n").over(Window.orderBy("v")) + before
                found = parts.where(F.col("_p") == p).withColumn("_run", run).where(F.col("_run") > place).agg(F.min("v").alias("value"))
            before += n
        found = found.select(F.lit(q).alias("q"), "value")
        out = found if out is None else out.union(found)
    return out


def quantile(values: DataFrame, column: str, q: float) -> DataFrame:
    """One row, `value`: see quantiles()."""
    return quantiles(values, column, [q]).select("value")


def bucket_of(score: Column) -> Column:
    return F.when(score <= 2, "0-2").when(score <= 4, "3-4").when(score <= 6, "5-6").otherwise("7-10")


def calibration(gold: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row on how verdicts (id, score, decision) agree with gold (id, human_score, human_decision).

    Missing verdicts count against agreement. usable is false if the spread, the agreement or the coverage is poor.
    """
    both = gold.join(verdicts, "id", "left")
    n, has = F.count("*"), F.col("score").isNotNull()
    top = both.where(has).groupBy(bucket_of(F.col("score")).alias("b")).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.count("*").alias("buckets"))
    row = both.agg(
        n.alias("n"),
        F.count_if(has).alias("judged"),
        (F.count_if(F.col("decision") == F.col("human_decision")) / n).alias("agreement"),
        (F.count_if(~has) / n).alias("missing"),
        F.coalesce(F.stddev_pop("score"), F.lit(0.0)).alias("spread"),
        F.count_if(has & (bucket_of(F.col("score")) == bucket_of(F.col("human_score")))).alias("same_bucket"),
    ).crossJoin(top)
    saturation = F.when(F.col("judged") > 0, F.coalesce("most", F.lit(0)) / F.col("judged")).otherwise(F.lit(0.0))
    row = row.withColumn("saturation", saturation)
    good = (F.col("buckets") >= 3) & (F.col("saturation") <= 0.5) & (F.col("agreement") >= 0.7) & (F.col("missing") <= 0.2) & (F.col("spread") >= 0.5)
    return row.withColumn("usable", good).drop("most")


def confusion(gold: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Counts by human bucket and the verdict's bucket, 'missing' where there is none."""
    mine = F.when(F.col("score").isNull(), "missing").otherwise(bucket_of(F.col("score")))
    return gold.join(verdicts, "id", "left").groupBy(bucket_of(F.col("human_score")).alias("human"), mine.alias("verdict")).agg(F.count("*").alias("n"))


def source_yield(enabled: DataFrame, rows: DataFrame) -> DataFrame:
    """enabled (source) with fetched, after_dedupe, after_filter of rows (source, first, passed), and the two warnings."""
    counts = rows.groupBy("source").agg(
        F.count("*").alias("fetched"), F.count_if("first").alias("after_dedupe"), F.count_if(F.col("first") & F.col("passed")).alias("after_filter")
    )
    both = enabled.join(counts, "source", "left").na.fill(0, ["fetched", "after_dedupe", "after_filter"])
    zero = (F.col("fetched") > 0) & (F.col("after_dedupe") > 0) & (F.col("after_filter") == 0)
    return both.withColumn("zero_yield", zero).withColumn("empty_yield", F.col("fetched") == 0)


def streaks(days: DataFrame, key: str, day: str) -> DataFrame:
    """Runs of consecutive days of each key (key, first_day, last_day, days), by gaps and islands."""
    w = Window.partitionBy(key).orderBy(day)
    island = F.date_sub(day, F.row_number().over(w))
    runs = days.select(key, day).distinct().withColumn("_island", island)
    return runs.groupBy(key, "_island").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("days")).drop("_island")


def round_row(scores: DataFrame) -> DataFrame:
    """One row on the scores of a round (score, is_new): n, p50, p90, top1, mean, the share of saturated scores (0.99 or
    more) and of new items, to three places."""
    q = quantiles(scores, "score", [0.5, 0.9]).agg(F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("p50"), F.max(F.when(F.col("q") == 0.9, F.col("value"))).alias("p90"))
    n = F.count("*")
    rest = scores.agg(
        n.alias("n"), F.coalesce(F.max("score"), F.lit(0.0)).alias("top1"), F.coalesce(F.avg("score"), F.lit(0.0)).alias("mean"),
        F.when(n > 0, F.count_if(F.col("score") >= 0.99) / n).otherwise(F.lit(0.0)).alias("saturation"), F.when(n > 0, F.count_if("is_new") / n).otherwise(F.lit(0.0)).alias("new_rate"),
    )
    return rest.crossJoin(q).select("n", *[round3(F.col(c)).alias(c) for c in ("p50", "p90", "top1", "mean", "saturation", "new_rate")])  # one row each


def recall_calibration(gold: DataFrame, judged: DataFrame, agreement: float = 0.7) -> DataFrame:
    """One row on how a recall judge (id, include; null for no answer) agrees with gold (id, include): counts of right and
    wrong inclusions, precision, recall, and usable: at most 0.3 of the answers are missing and `agreement` of all are right."""
    both = gold.select("id", F.col("include").alias("want")).join(judged.select("id", F.col("include").alias("said")), "id", "left")
    n = F.count("*")
    row = both.agg(
        n.alias("n"), F.count_if(F.col("want") & F.col("said")).alias("right"), F.count_if(~F.col("want") & F.col("said")).alias("wrong"),
        F.count_if(F.col("want") & ~F.coalesce("said", F.lit(False))).alias("missed"), F.count_if(F.col("said").isNull()).alias("missing"),
        F.count_if(F.col("want") == F.col("said")).alias("_agreed"),
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    right, n = F.col("right"), F.col("n")
    good = (n > 0) & (ratio(F.col("missing"), n) <= 0.3) & (ratio(F.col("_agreed"), n) >= agreement)
    return row.withColumns({"precision": ratio(right, right + F.col("wrong")), "recall": ratio(right, right + F.col("missed")), "usable": good}).drop("_agreed")
