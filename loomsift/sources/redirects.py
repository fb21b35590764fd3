"""Redirects followed under guard: every hop looked at, none beyond the limit, by joins over all urls at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.functions.urls import is_public_https, is_public_origin
from loomsift.lineage import unwritten, written

# How many redirects are followed, and the answers that are redirects.
MAX_HOPS = 5
REDIRECTS = (301, 302, 303, 307, 308)


def absolute(location: Column, base: Column) -> Column:
    """A redirect's target: as it stands, or relative to the url that gave it (its scheme, host or folder)."""
    scheme, origin = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(path, "^(.*/)", 1)
    return (
        F.when(location.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), location)
        .when(F.startswith(location, F.lit("//")), F.concat(scheme, F.lit(":"), location))
        .when(F.startswith(location, F.lit("/")), F.concat(origin, location))
        .when(F.startswith(location, F.lit("?")), F.concat(origin, F.when(path == "", "/").otherwise(path), location))
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), location))
    )


def followed(urls: DataFrame, answers: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """(url, final, hops, problem) for each different url of urls: where it ends, or why it was not followed.

    answers: (url, status, location), one for each url that was asked; an answer without a location, or none at all, is an
    end. A start must not be of a private host or carry credentials; every redirect must lead to a public https url. A chain
    of more than max_hops redirects, as every loop is, stops with 'too many redirects'. Only urls that still move are in the
    next join, and their number falls with every hop.
    """
    table = answers.where(F.col("status").isin(*REDIRECTS) & F.col("location").isNotNull() & (F.col("location") != ""))
    table = written(table.groupBy(F.col("url").alias("_at")).agg(F.min("location").alias("location")), "redirects")
    start = urls.select("url").where("url is not null").distinct()
    state = start.select("url", F.col("url").alias("final"), F.lit(0).alias("hops"), F.when(~is_public_origin(F.col("url")), "private start").alias("problem"))
    moving, done = state.where("problem is null"), state.where("problem is not null")
    for hop in range(1, max_hops + 2):
        step = written(moving.join(table, F.col("final") == F.col("_at"), "left"), "hops")
        done = done.unionByName(step.where("location is null").select("url", "final", "hops", "problem"))
        onward = step.where("location is not null").select("url", absolute(F.col("location"), F.col("final")).alias("next"), "final")
        if hop > max_hops:
            done = done.unionByName(onward.select("url", "final", F.lit(max_hops).alias("hops"), F.lit("too many redirects").alias("problem")))
            break
        checked = onward.select("url", F.col("next").alias("final"), F.lit(hop).alias("hops"), F.when(~is_public_https(F.col("next")), "target is not public https").alias("problem"))
        done, moving = done.unionByName(checked.where("problem is not null")), checked.where("problem is null")
        if moving.isEmpty():
            break
    out = written(done, "followed")
    unwritten(table)
    return out
