"""SimHash near-duplicate groups by exact comparison of tiles of fingerprints.

1. One pass over the texts makes the fingerprints: bit k is set if it is set in over half of the 64-bit hashes of the
   text's word shingles, repeats included.
2. Equal fingerprints collapse to one class; all later steps see classes only.
3. A fingerprint is cut into r + 1 bands of bits. Two that differ in at most r bits agree in one band at least, so only
   classes that share a band are compared: a tile holds those of one value of a band, and a value with more than TILE
   of them has several tiles by hash, paired with each other. Values that one class alone has are left out.
4. A tile, or a pair of them, is one row of packed arrays. Inside it the fingerprints, in order of the population counts
   (numbers of set bits) of their four quarters, are cut into small blocks; a pair of blocks is skipped if the ranges of
   those counts are together further apart than r. All others are compared in full: exclusive or, bit count, at most r.
   Nothing is estimated, so no link is missed.
5. A tile or pair of tiles gives each fingerprint's least connected one, not all links: a group of n edited copies makes
   n rows, not n * n. Components of those rows are the components of all links.

Every fingerprint is shipped r + 1 times, 8 bytes each. What is compared is still quadratic in the number of different
fingerprints, but a band of 12 or 13 bits divides it: five bands compare about five in 8,192 pairs where their values are
evenly spread, and the longest rows of tiles are bounded by TILE. Rows of a hot fingerprint (copies, empty texts) meet
their class in one join at the end, which adaptive execution splits.

Edge cases: null and empty texts and texts of white space have fingerprint zero, which is linked like any other; texts
of fewer words than a shingle are one shingle; rows that repeat a doc_id, and a doc_id with several texts, have a row
each; a row of null doc_id is linked like others, its component is that of its group (null if no row of it has a
doc_id); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.lineage import unwritten, written
from loomsift.llm.common import small_batches, table
from loomsift.operators.graph import components

WIDTH, RADIUS = 4, 4
#: Fingerprints of a tile and of the blocks that it is compared in.
TILE, BLOCK = 32_768, 512
SEED = 42
#: Hashes whose bits are added up at once.
CHUNK = 8_192


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The 64-bit fingerprint; words are runs without ASCII white space, A-Z lowered."""
    words = text.encode().lower().split() if text else ()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    n = max(1, len(words) - width + 1)
    ends = (ends[min(width, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp): a row for each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _blocks(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """fps in order of their quarters' population counts, and the least and greatest counts of each block."""
    counts = np.bitwise_count(fps.view(np.uint16).reshape(-1, 4))
    order = np.lexsort(counts.T)
    counts = counts[order].astype(np.int16)
    starts = np.arange(0, len(fps), BLOCK)
    return fps[order], np.minimum.reduceat(counts, starts), np.maximum.reduceat(counts, starts)


def linked(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(x, y): each fingerprint of two tiles (of one, if b is None) that links connect to a lesser one, and the least such.

    The links are those within a, if b is None, else those between a and b.
    """
    own = b is None
    a, low_a, high_a = _blocks(a)
    b, low_b, high_b = (a, low_a, high_a) if own else _blocks(b)
    shift = 0 if own else len(a)
    every = a if own else np.concatenate([a, b])
    root = np.arange(len(every))
    for k in range(len(low_a)):
        # How far apart the counts of the quarters are at least, added up.
        apart = (np.maximum(low_b - high_a[k], 0) + np.maximum(low_a[k] - high_b, 0)).sum(axis=1)
        left = a[k * BLOCK : (k + 1) * BLOCK, None]
        for m in np.flatnonzero(apart <= radius):
            if own and m < k:
                continue
            right = b[None, m * BLOCK : (m + 1) * BLOCK]
            i, j = np.divmod(np.flatnonzero(np.bitwise_count(left ^ right) <= radius), right.shape[1])
            i, j = root[i + k * BLOCK], root[j + shift + m * BLOCK]
            while (apart_yet := i != j).any():
                i, j = i[apart_yet], j[apart_yet]
                np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
                while (root[root] != root).any():
                    root = root[root]
                i, j = root[i], root[j]
    least = np.full(len(every), np.uint64(2**64 - 1))
    np.minimum.at(least, root, every)
    y = least[root]
    return every[y != every], y[y != every]


def bands(radius: int) -> list[tuple[int, int]]:
    """(first bit, mask) of radius + 1 bands that together are all 64 bits; bands beyond 64 have no bit."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(a, int(np.uint64(2 ** (b - a) - 1).view(np.int64))) for a, b in zip(cuts, cuts[1:])]


def edges(classes: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(x, y): rows whose components are those of all links between the different fingerprints fp of classes."""
    spark = classes.sparkSession
    values = [F.shiftrightunsigned("fp", first).bitwiseAND(F.lit(mask)) for first, mask in bands(radius)]
    shared = classes.select("fp", F.posexplode(F.array(*values)).alias("band", "value"))
    counts = shared.groupBy("band", "value").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"), F.count("*").alias("n"))
    placed = shared.join(counts.where("n > 1").drop("n"), ["band", "value"])
    placed = placed.withColumn("part", F.pmod(F.xxhash64("fp", F.lit(3)), "parts").cast("int"))
    tiles = written(placed.groupBy("band", "value", "parts", "part").agg(F.collect_list("fp").alias("fps")), "tiles")
    own = tiles.select("band", "value", "part", F.col("part").alias("other"), "fps", F.lit(None).cast("array<long>").alias("others"))
    left = tiles.where("part < parts - 1").select("band", "value", "part", F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1)).alias("other"), "fps")
    right = tiles.where("part > 0").select("band", "value", F.col("part").alias("other"), F.col("fps").alias("others"))
    pairs = own.unionByName(left.join(right, ["band", "value", "other"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for fps, others in zip(batch.column(0), batch.column(1)):
                found.append(linked(np.asarray(fps.values).view(np.uint64), np.asarray(others.values).view(np.uint64) if others.is_valid else None, radius))
            if found:
                x, y = (np.concatenate(side).view(np.int64) for side in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])

    # Dealt by pair: work goes by pairs of tiles, not by bytes, so the number of partitions is not left to their size.
    dealt = pairs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "band", "value", "part", "other").select("fps", "others")
    return dealt.mapInArrow(run, "x long, y long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row for each row of docs (doc_id, text)."""
    small_batches(docs.sparkSession)
    marked = written(fingerprints(docs, width), "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("doc")), "fingerprint-classes")
    comps = components(edges(classes, radius, tile))
    grouped = classes.join(comps.withColumnRenamed("id", "fp"), "fp", "left").select("fp", "doc", F.coalesce("comp", "fp").alias("comp"))
    grouped = written(grouped, "fingerprint-groups")
    unwritten(classes, comps)
    least = grouped.groupBy("comp").agg(F.min("doc").alias("component_id"))
    named = grouped.join(least, "comp").select("fp", "component_id")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return marked.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def op12_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), radius=RADIUS, width=WIDTH)
