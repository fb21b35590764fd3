"""Reports: the criteria of a trial period, evidence by source, and what is wrong with a configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomsift.operators.gates import GateConfig, Persona, bad_rules

LAST = 3  # rounds that the criteria on streaks look at


def criteria(observations: DataFrame, feedback: DataFrame, views: int | None, ended: bool, artifacts: DataFrame | None = None) -> DataFrame:
    """(id, value, status) of the eleven criteria; status is pass, fail or nodata.

    observations: round, candidates, delivered, bad_sources, enabled_sources, saturation, one row a round.
    feedback: signal (up or down). views: how often digests were opened, None if that is not recorded. artifacts: lines
    of notes, of which those with a date, a digest, an item and a decision count. Criteria on the whole period need its end.
    """
    rounds = observations.agg(
        F.count("*").alias("rounds"), F.coalesce(F.sum("delivered"), F.lit(0)).alias("delivered"), F.max(F.when(F.col("candidates") > 0, F.col("round"))).alias("alive")
    )
    empty = observations.crossJoin(F.broadcast(rounds.select("alive"))).where("alive is null or round > alive").agg(F.count("*").alias("empty_rounds"))
    last = observations.orderBy(F.desc("round")).limit(LAST).agg(
        F.count_if(F.col("bad_sources") / F.col("enabled_sources") > 1 / 3).alias("bad_rounds"),
        F.count_if(F.coalesce("enabled_sources", F.lit(0)) == 0).alias("unknown"),
        F.count_if(F.col("saturation") > 0.5).alias("saturated"),
        F.max_by("saturation", "round").alias("saturation"),
        F.max_by(F.col("bad_sources") / F.col("enabled_sources"), "round").alias("bad_share"),
    )
    said = feedback.agg(F.count_if(F.col("signal") == "up").alias("ups"), F.count_if(F.col("signal") == "down").alias("downs"))
    notes = F.lit(0).cast("long")
    one = rounds.crossJoin(empty).crossJoin(last).crossJoin(said)  # one row each
    if artifacts is not None:
        sound = [F.col("line").rlike(p) for p in ("^\\|\\s*P-4\\s*\\|", "\\d{4}-\\d{2}-\\d{2}", "(?i)digestId\\s*[=:]\\s*\\S+", "(?i)itemId\\s*[=:]\\s*\\S+", "(?i)decision\\s*[=:]")]
        one = one.crossJoin(artifacts.agg(F.count_if(sound[0] & sound[1] & sound[2] & sound[3] & sound[4]).alias("notes")))
        notes = F.col("notes")
    valid = F.col("ups") + F.col("downs")
    rate = F.when(valid > 0, F.col("ups") / valid)
    answered = F.when(F.col("delivered") > 0, valid / F.col("delivered"))
    seen = F.lit(views).cast("double")
    over = F.lit(ended)
    enough = F.col("rounds") >= LAST
    status = lambda known, good: F.when(F.coalesce(known, F.lit(False)), F.when(good, "pass").otherwise("fail")).otherwise("nodata")
    rows = [
        ("I-1", F.col("empty_rounds"), status(enough, F.col("empty_rounds") < LAST)),
        ("I-2", answered, status(answered.isNotNull(), answered >= 0.05)),
        ("I-3", F.col("bad_share"), status(enough & (F.col("unknown") == 0), F.col("bad_rounds") < LAST)),
        ("I-4", F.col("saturation"), status(enough, F.col("saturated") < LAST)),
        ("G-1", seen, status(over & seen.isNotNull(), seen >= 10)),
        ("G-2", rate, status(over & rate.isNotNull(), rate >= 0.2)),
        ("G-3", F.lit(None), F.lit("nodata")),  # read by a person after the period
        ("P-1", seen, status(over & seen.isNotNull(), seen >= 10)),
        ("P-2", rate, status(over & rate.isNotNull(), (rate >= 0.3) & (valid >= 20))),
        ("P-3", F.lit(None), F.lit("nodata")),
        ("P-4", notes, status(over, notes >= 1)),
    ]
    made = F.array(*[F.struct(F.lit(i).alias("id"), v.cast("double").alias("value"), s.alias("status")) for i, v, s in rows])
    return one.select(F.explode(made).alias("c")).select("c.*")


def evidence(archive: DataFrame) -> DataFrame:
    """source, entries, pushed of an archive."""
    return archive.groupBy("source").agg(F.count("*").alias("entries"), F.count_if("pushed").alias("pushed"))


def missing_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths where nothing is, on whatever file system they name."""
    out = []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            out.append(path)
    return out


def config_problems(spark: SparkSession, config: GateConfig, personas: list[Persona], sources: set[str], files: list[str] | None = None) -> list[str]:
    """What would keep a configuration from doing what it says. files: paths that it cannot do without."""
    out = [f"missing file {p}" for p in missing_files(spark, files or [])]
    if not config.stopwords:
        out.append("no stop words: events would merge on common words")
    out += [f"keyword tier generic has {t.points} points, must be 0" for t in config.tiers if t.tier == "generic" and t.points]
    if not personas:
        out.append("no persona")
    out += [f"blacklist/{i}: {e}" for i, e in bad_rules(spark, config.blacklist)]
    for p in personas:
        out += [f"{p.id}/reject/{i}: {e}" for i, e in bad_rules(spark, p.reject)]
        unknown = sorted(set(p.sources) - sources)
        if unknown:
            out.append(f"{p.id}: unknown sources {', '.join(unknown)}")
    return out


def board(items: DataFrame, published: DataFrame) -> DataFrame:
    """What each source brought to a round: collected, published, of these in Chinese, and the share published."""
    got = items.groupBy("source").agg(F.count("*").alias("collected"))
    out = published.groupBy("source").agg(F.count("*").alias("published"), F.count_if(F.col("lang") == "zh").alias("published_zh"))
    both = got.join(out, "source", "left").na.fill(0, ["published", "published_zh"])
    return both.withColumn("yield_ratio", F.col("published") / F.col("collected"))


def board_report(published: DataFrame, drops: DataFrame, collected: DataFrame, signals: DataFrame, pool: DataFrame | None = None) -> DataFrame:
    """(part, name, value) of a round's board: source and lang, each with its posts; yield, the share of what was collected that was
    published; signals by kind, and whether there are any, without which nothing is learned from readers (evolution: 1 or 0).

    published: (source, lang); drops: as gates.drops() gives them; collected: one row (n); signals: (kind). With the pool of
    the wide channel, recall has its size, how many of it were included and how many excluded: a drop of the gate recall
    that was neither unfit for the pool nor beyond its room.
    """
    part = lambda rows, name, value, part: rows.select(F.lit(part).alias("part"), F.coalesce(name.cast("string"), F.lit("")).alias("name"), value.cast("double").alias("value"))
    out = part(published.groupBy("source").agg(F.count("*").alias("n")), F.col("source"), F.col("n"), "source")
    out = out.unionByName(part(published.groupBy("lang").agg(F.count("*").alias("n")), F.col("lang"), F.col("n"), "lang"))
    out = out.unionByName(part(signals.groupBy("kind").agg(F.count("*").alias("n")), F.col("kind"), F.col("n"), "signals"))
    out = out.unionByName(part(signals.agg((F.count("*") > 0).cast("int").alias("n")), F.lit("active"), F.col("n"), "evolution"))
    both = published.agg(F.count("*").alias("posts")).crossJoin(collected.select("n"))  # one row each
    out = out.unionByName(part(both, F.lit("published"), F.when(F.col("n") > 0, F.col("posts") / F.col("n")).otherwise(0), "yield"))
    if pool is None:
        return out
    refused = F.col("gate").eqNullSafe("recall") & ~F.col("rule").startswith("recall:ineligible") & ~F.col("rule").startswith("recall:poolOverflow")
    recall = pool.agg(F.count("*").alias("pool")).crossJoin(drops.agg(F.count_if(refused).alias("excluded"))).withColumn("included", F.col("pool") - F.col("excluded"))
    return out.unionByName(part(recall.unpivot([], ["pool", "included", "excluded"], "k", "n"), F.col("k"), F.col("n"), "recall"))


def endpoint_usage(calls: DataFrame) -> DataFrame:
    """endpoint with calls, failures and time of calls (endpoint, ok, ms, seq), and whether it is the one that is called
    most (ties: the one called first)."""
    sums = calls.groupBy("endpoint").agg(F.count("*").alias("calls"), F.count_if(~F.col("ok")).alias("failures"), F.sum("ms").alias("ms"), F.min("seq").alias("_first"))
    top = sums.orderBy(F.desc("calls"), "_first").limit(1).select("endpoint", F.lit(True).alias("_top"))
    return sums.join(top, "endpoint", "left").select("endpoint", "calls", "failures", "ms", F.coalesce("_top", F.lit(False)).alias("most_used"))


def feedback_rates(archive: DataFrame, feedback: DataFrame) -> DataFrame:
    """source with its entries, how many were pushed, feedback for each pushed one, and the share of likes (null for none)."""
    said = feedback.groupBy("source").agg(F.count("*").alias("feedback"), F.count_if(F.col("signal") == "up").alias("ups"))
    both = evidence(archive).join(said, "source", "left").na.fill(0, ["feedback", "ups"])
    rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return both.select("source", "entries", "pushed", rate("feedback", "pushed").alias("feedback_rate"), rate("ups", "feedback").alias("up_rate"))


def editorial_board(batches: DataFrame, published: DataFrame, copies: DataFrame, enabled: DataFrame) -> DataFrame:
    """One row a board on what its editors did: enabled (board, enabled, calibration_passed) with active, degraded and truncated
    batches by role and how many of the published have a writer's copy.

    batches: (board, role, degraded, truncated), one row for each batch asked; published: (board, id); copies: (board, id)
    with a usable copy. Editors are active if any batch of theirs was not degraded.
    """
    role = lambda name, flag: F.count_if((F.col("role") == name) & F.col(flag))
    work = batches.groupBy("board").agg(
        F.count_if(~F.col("degraded")).alias("sound"), role("writer", "degraded").alias("writer_degraded"), role("reviewer", "degraded").alias("reviewer_degraded"), F.count_if("truncated").alias("truncated")
    )
    written = published.join(copies.select("board", "id").distinct(), ["board", "id"], "left_semi").groupBy("board").agg(F.count("*").alias("copies"))
    both = enabled.join(work, "board", "left").join(written, "board", "left").na.fill(0, ["sound", "writer_degraded", "reviewer_degraded", "truncated", "copies"])
    active = F.col("enabled") & (F.col("sound") > 0)
    return both.select("board", "enabled", "calibration_passed", active.alias("active"), "writer_degraded", "reviewer_degraded", "truncated", F.when(active, F.col("copies")).otherwise(0).alias("copies"))


#: What an audit needs to know of each board beside its funnel.
BOARDS = (
    "board string, published long, dropped long, rejected long, bad_rules long, signals long, filled boolean, enabled boolean, active boolean, "
    "calibration_passed boolean, writer_degraded long, reviewer_degraded long, truncated long, copies long"
)


def audited(funnels: DataFrame, boards: DataFrame, endpoints: DataFrame) -> DataFrame:
    """(board, level, rule, n): what is wrong with each board; no rows for one that is sound.

    funnels: (board, pos, stage, n); boards: the columns of BOARDS; endpoints: (board, role, endpoint) that answered.
    fatal: the counts cannot be reconciled, or rules of the configuration do not compile: nothing may be published.
    warning: the round may go out, but something worked less well than it was set up to; n says how often or how many.
    A null calibration is one that was not made.
    """
    steps = Window.partitionBy("board").orderBy("pos")  # the stages of a round
    staged = funnels.withColumn("_before", F.lag("n").over(steps))
    grown = staged.groupBy("board").agg(F.count_if(F.col("n") > F.col("_before")).alias("_grown"), F.min_by("n", "pos").alias("_first"), F.max_by("n", "pos").alias("_last"))
    by_role = endpoints.groupBy("board", "endpoint").agg(F.count_if(F.col("role") == "writer").alias("w"), F.count_if(F.col("role") == "reviewer").alias("r"))
    shared = by_role.where("w > 0 and r > 0").groupBy("board").agg(F.count("*").alias("_shared"))
    rows = boards.join(grown, "board", "left").join(shared, "board", "left").na.fill(0, ["_grown", "_first", "_last", "_shared"])
    one, c = F.lit(1).cast("long"), F.col
    found = [
        ("fatal", "funnel grows", c("_grown") > 0, c("_grown")),
        ("fatal", "last stage is not what was published", c("_last") != c("published"), F.abs(c("_last") - c("published"))),
        ("fatal", "more drops than entries", c("dropped") + c("rejected") > c("_first"), c("dropped") + c("rejected") - c("_first")),
        ("fatal", "rules that do not compile", c("bad_rules") > 0, c("bad_rules")),
        ("warning", "editors inactive", c("enabled") & ~c("active"), one),
        ("warning", "endpoints of both roles", c("_shared") > 0, c("_shared")),
        ("warning", "truncated batches", c("truncated") > 0, c("truncated")),
        ("warning", "degraded writer batches", c("writer_degraded") > 0, c("writer_degraded")),
        ("warning", "degraded reviewer batches", c("reviewer_degraded") > 0, c("reviewer_degraded")),
        ("warning", "calibration failed", c("calibration_passed") == F.lit(False), one),
        ("warning", "published without a copy", c("active") & (c("copies") < c("_last")), c("_last") - c("copies")),
        ("warning", "no signals", c("signals") == 0, one),
        ("warning", "filled beyond the cap of events", c("filled"), one),
    ]
    marks = [F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule"), n.cast("long").alias("n"))) for level, rule, cond, n in found]
    return rows.select("board", F.explode(F.array_compact(F.array(*marks))).alias("m")).select("board", "m.*")
