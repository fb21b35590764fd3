"""Near-duplicate groups by MinHash with tensored banding and exact verification.

Tensoring. Two collections of SIDE short bands are made, each band being the hash of BAND minhashes. A table key is a
pair (band i of the first collection, band j of the second), so SIDE * SIDE tables of 2 * BAND minhashes each come from
2 * SIDE * BAND minhashes instead of 2 * SIDE**2 * BAND. Two sets of similarity s meet in a table with probability
(1 - (1 - s**BAND)**SIDE)**2, which is 0.99998 at s = 0.85 and 0.9996 at s = 0.8.

Steps, all of them joins and aggregates of narrow rows:
1. One pass over the texts makes each document's sketch: set size, 128-bit hash of its set, its bands.
2. Equal sets collapse to one class, named by the number of one of its rows; all later steps see classes only.
3. Bands that no other class has are dropped before any pair of bands is formed: a table key can only be shared if
   both of its halves are.
4. Each bucket of a table sends its members to one leader, the member with most company over all bands (in a group of
   edited copies that is the original); those links are confirmed on the full sets and give components.
5. Members that met under one leader and are in different components still may be linked. Two exact prefix filters
   over the full sets give the pairs that can reach the similarity (see missed_pairs); confirmed links are added and
   the components found anew.
A link can stay unconfirmed only inside a component that is already connected, so groups equal those of all links.

No group is gathered in one task: buckets are aggregated before the shuffle and joined by rows.

Edge cases: null and empty texts, and texts of white space, have an empty set, n_shingles 0 and are their own group;
texts of fewer words than a shingle are one shingle; rows that repeat a doc_id and its text repeat its result; a doc_id
with several texts has a row, and a group, for each of them; a row of null doc_id is linked like others, has the
component of its group (null if no row of it has a doc_id) and is not kept; an empty table gives an empty result; extra
columns are ignored.

The stage keeps one row of each group: of its least doc_id (a null one only where there is no other), and of that the
text of least hash; rows that repeat both are one. Rows without words are linked with nothing and all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.lineage import unwritten, written
from loomsift.llm.common import remembered, small_batches, table
from loomsift.operators.graph import components

SIDE, BAND = 12, 3
#: Words that a worker remembers, of so many bytes at most.
MEMO, MEMO_BYTES = 150_000, 64
SEED = 20_240_501
SKETCH = "doc_id long, t long, n_shingles long, h1 long, h2 long, a array<long>, b array<long>"
#: Stands for a null doc_id where rows are told apart; the greatest long, so that it comes last.
NO_ID = 2**63 - 1


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= MEMO_BYTES:
            self[word] = h
        return h


def shingle_hashes(text: str | None, width: int, memo: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; words are runs without ASCII white space, A-Z lowered."""
    words = text.encode().lower().split() if text else ()
    if not words:
        return np.zeros(0, np.uint64)
    if len(memo) > MEMO:
        memo.clear()
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    out = np.full(n, np.uint64(min(len(h), width)))
    for k in range(min(width, len(h))):
        out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    xor, odd = rng.integers(0, 2**64, (2, 2 * SIDE * BAND), dtype=np.uint64)
    return xor, odd | np.uint64(1)


def bands(shingles: np.ndarray, xor: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """The 2 * SIDE bands of a set: each the mix of BAND minhashes."""
    least = np.full(len(xor), np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 512):  # blocks that stay in the cache
        least = np.minimum(least, ((shingles[at : at + 512, None] ^ xor) * odd).min(axis=0))
    mins = least.reshape(2 * SIDE, BAND)
    out = np.zeros(2 * SIDE, np.uint64)
    for k in range(BAND):
        out = (out ^ mins[:, k]) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """One row for each row of docs (doc_id, text); t is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, (xor, odd) = remembered("neardup", _WordHash), _functions()
        with np.errstate(over="ignore"):
            for batch in batches:
                size, h1, h2, keys = [], [], [], []
                for text in batch.column(2).to_pylist():
                    s = shingle_hashes(text, width, memo)
                    size.append(len(s))
                    if len(s):
                        x, y = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                        h1.append(int(x))
                        h2.append(int(y))
                        keys.append(bands(s, xor, odd))
                    else:
                        h1.append(None)
                        h2.append(None)
                flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
                ends = np.cumsum([0] + [2 * SIDE if n else 0 for n in size])
                halves = [pa.ListArray.from_arrays(pa.array(ends // 2, pa.int32()), pa.array(flat.reshape(-1, 2, SIDE)[:, k].ravel())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), *halves], ["doc_id", "t", "n_shingles", "h1", "h2", "a", "b"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("t"), text).mapInArrow(run, SKETCH)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, s): the full set of each row of docs (id, text), as sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = remembered("neardup", _WordHash)
        with np.errstate(over="ignore"):
            for batch in batches:
                sets = [shingle_hashes(t, width, memo).view(np.int64) for t in batch.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, sets)])
                values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], ["id", "s"])

    return docs.select("id", "text").mapInArrow(run, "id long, s array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) with 100 * intersection >= percent * union, counted on the full sets."""
    left, right = sets.select(F.col("id").alias("x"), F.col("s").alias("sx")), sets.select(F.col("id").alias("y"), F.col("s").alias("sy"))
    both = pairs.join(left, "x").join(right, "y")
    common = F.size(F.array_intersect("sx", "sy")).cast("long")
    return both.where(100 * common >= percent * (F.size("sx") + F.size("sy") - common)).select("x", "y")


def _table_keys(sketch: DataFrame, *more: str) -> DataFrame:
    """A row for each table that a class can share: key, id and the columns `more`; `fa`, `fb` hold the shared bands' numbers."""
    return (
        sketch.select("id", "a", "b", "fa", "fb", *more)
        .withColumn("i", F.explode("fa"))
        .withColumn("j", F.explode("fb"))
        .withColumn("key", F.xxhash64("i", F.get("a", "i"), "j", F.get("b", "j")))
    )


def missed_pairs(pairs: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) that met under one leader, lie in different components and may reach the similarity.

    Two prefix filters, both exact. In the first, with shingles in one order, rarest first, two sets of the similarity
    share one of the first n - ceil(percent * n / 100) + 1 of each; a set with that many shingles that no other has is
    out. The second compares sets by their difference from the leader they have in common: the sets x and y differ in
    as many shingles as their differences d(x) and d(y) do, and may differ in h = (100 - percent) / (100 + percent) *
    (|x| + |y|) of them, so d(x) and d(y) share (|d(x)| + |d(y)| - h) / 2 at least. Edited copies of a text differ from
    it each in its own way, and this rules nearly all pairs of them out, however many there are.
    """
    named = lambda c: comps.select(F.col("id").alias(c), F.col("comp").alias(f"c{c}"))
    met = pairs.join(named("x"), "x", "left").join(named("y"), "y", "left")
    met = met.select("x", F.coalesce("cx", "x").alias("comp"), F.col("y").alias("leader"), (F.coalesce("cx", "x") != F.coalesce("cy", "y")).alias("outside"))
    mixed = met.where("outside").select("leader").distinct()
    met = written(met.join(mixed, "leader"), "met")

    own = met.select(F.col("x").alias("id")).distinct().join(sets, "id").withColumn("size", F.size("s"))
    every = own.select("id", F.explode("s").alias("shingle"))
    common = every.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    shared = every.join(common, "shingle").groupBy("id").agg(F.count("*").cast("int").alias("shared"))
    prefix = F.col("size") - F.ceil(F.lit(percent) * F.col("size") / 100).cast("int") + 1
    alive = own.select("id", "s", "size").join(shared, "id").where(F.col("size") - F.col("shared") < prefix).select(F.col("id").alias("x"), "s", "size")

    both = met.join(alive, "x").join(sets.select(F.col("id").alias("leader"), F.col("s").alias("ls")), "leader")
    differ = F.concat(F.array_except("s", "ls"), F.array_except("ls", "s"))
    each = written(both.select("leader", "x", "comp", "outside", "size", differ.alias("d")), "differences")
    rows = each.select("leader", "x", F.explode("d").alias("e"))
    common = rows.groupBy("leader", "e").agg(F.count("*").alias("df")).where("df > 1")
    shared = rows.join(common, ["leader", "e"]).groupBy("leader", "x").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("shared"))
    most = F.floor(F.lit(100 - percent) * F.col("size") / percent).cast("int")  # h for the largest partner
    kept = each.select("leader", "x", "comp", "outside", "size", F.size("d").alias("n")).join(shared, ["leader", "x"])
    kept = kept.withColumn("common", F.size("shared")).withColumn("rest", most + 1 - (F.col("n") - F.col("common"))).where("rest > 0")
    kept = written(kept.select("leader", "x", "comp", "outside", "size", "n", "common", F.slice(F.col("shared.e"), F.lit(1), F.col("rest")).alias("first")), "prefixes")
    strays, rows = stray_rows(kept.withColumn("e", F.explode("first")))
    strays = strays.select("leader", "e", "base", F.col("x").alias("y"), *[F.col(c).alias(f"{c}_y") for c in ("comp", "outside", "size", "n", "common", "first")])
    rows = rows.select("leader", "e", "x", *[F.col(c).alias(f"{c}_x") for c in ("comp", "outside", "size", "n", "common", "first")])
    sizes = F.col("size_x") + F.col("size_y")
    # Two strays meet twice, a stray and a row of the base once.
    fits = (F.col("comp_x") != F.col("comp_y")) & ((F.col("comp_x") == F.col("base")) | (F.col("x") < F.col("y"))) & (F.col("outside_x") | F.col("outside_y"))
    fits &= 100 * F.least("size_x", "size_y") >= percent * F.greatest("size_x", "size_y")
    fits &= (100 + percent) * (F.col("n_x") + F.col("n_y") - 2 * F.least("common_x", "common_y")) <= (100 - percent) * sizes
    # Once for each pair: at the first shingle that both prefixes have.
    fits &= F.col("e") == F.get(F.array_intersect("first_x", "first_y"), F.lit(0))
    return rows.join(strays, ["leader", "e"]).where(fits).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def stray_rows(one: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of one (leader, e, comp, ...) the rows outside the base, the component with most rows under a leader and shingle,
    with it (base), and all rows that these have to be compared with.

    A link between components has a row outside the base at one end at least, so pairs are those of the strays with all
    rows: linear in a large cluster, however many rows it has under the shingle. A shingle that only one component has
    under a leader has no strays.
    """
    each = one.groupBy("leader", "e", "comp").agg(F.count("*").alias("n"))
    bases = each.groupBy("leader", "e").agg(F.max(F.struct("n", "comp")).alias("most"), F.count("*").alias("comps")).where("comps > 1")
    mixed = one.join(bases.select("leader", "e", F.col("most.comp").alias("base")), ["leader", "e"])
    mixed = written(mixed, "mixed")
    return mixed.where("comp <> base"), mixed.drop("base")


def grouped(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """doc_id, t, n_shingles, group, component_id: one row for each row of docs (doc_id, text). group is null for rows without words."""
    small_batches(docs.sparkSession)
    # The number of a row names it from here on: ids may be missing or repeat.
    sketch = written(sketches(docs.select("doc_id", "text"), width).withColumn("row", F.monotonically_increasing_id()), "sketch")
    # Classes of equal sets. A shingle set of one sequence has no near partner but its equals.
    classes = sketch.where(F.col("h1").isNotNull()).groupBy("h1", "h2").agg(F.min("row").alias("id"), F.min("doc_id").alias("doc"))
    classes = written(classes, "classes")
    bands_of = sketch.withColumnRenamed("row", "id").join(classes.select("id"), "id").select("id", "doc_id", "t", "a", "b")

    # Bands that at least two classes share, and how many classes each class meets by them.
    slots = bands_of.select("id", F.posexplode(F.concat("a", "b")).alias("slot", "band"))
    shared = slots.groupBy("slot", "band").agg(F.count("*").alias("n")).where("n > 1")
    company = slots.join(shared, ["slot", "band"]).groupBy("id").agg(F.sum("n").alias("company"), F.collect_set("slot").alias("slots"))
    side = F.lit(SIDE)
    company = company.select(
        "id", "company", F.filter("slots", lambda s: s < side).alias("fa"), F.transform(F.filter("slots", lambda s: s >= side), lambda s: s - side).alias("fb")
    ).where((F.size("fa") > 0) & (F.size("fb") > 0))
    near = written(bands_of.join(company, "id"), "near")

    # One leader for each bucket: most company, then least id.
    keys = _table_keys(near, "company").select("key", "id", "company")
    leaders = keys.groupBy("key").agg(F.max("company").alias("company"), F.count("*").alias("n")).where("n > 1").select("key", "company")
    leaders = keys.join(leaders, ["key", "company"]).groupBy("key").agg(F.min("id").alias("y"))
    pairs = keys.join(leaders, "key").where("id <> y").select(F.col("id").alias("x"), "y").distinct()
    pairs = written(pairs, "pairs")
    # The text of each class's row; a row that is there several times gives it several times.
    wanted = near.select("id", F.coalesce("doc_id", F.lit(NO_ID)).alias("k"), "t")
    texts = _told_apart(docs.select("doc_id", F.col("text").cast("string").alias("text"))).join(wanted, ["k", "t"]).select("id", "text")
    sets = written(shingle_sets(texts, width).dropDuplicates(["id"]), "sets")
    links = written(confirmed(pairs, sets, percent), "links")
    comps = components(links)

    missed = missed_pairs(pairs, comps, sets, percent)
    more = written(confirmed(missed, sets, percent), "links")
    if more.limit(1).count():
        old = comps
        comps = components(links.union(more))
        unwritten(old)
    unwritten(sets, pairs, near)

    linked = classes.join(comps, "id")
    least = linked.groupBy("comp").agg(F.min("doc").alias("least"))
    linked = linked.join(least, "comp").select("id", "comp", "least")
    named = classes.join(linked, "id", "left").select("h1", "h2", F.coalesce("comp", "id").alias("group"), F.when(F.col("comp").isNull(), F.col("doc")).otherwise(F.col("least")).alias("component_id"))
    out = sketch.select("doc_id", "t", "n_shingles", "h1", "h2").join(named, ["h1", "h2"], "left")
    return out.select("doc_id", "t", "n_shingles", "group", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _told_apart(docs: DataFrame) -> DataFrame:
    """docs with k and t, the doc_id (NO_ID if null) and a hash of the text."""
    return docs.withColumns({"k": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "t": F.xxhash64(F.col("text").cast("string"))})


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 3) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of docs (doc_id, text)."""
    out = grouped(docs, percent, width)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85, width=3)


def one_of_each(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """docs with one row of each group, and all rows without words."""
    found = grouped(docs, percent, width).where(F.col("group").isNotNull()).select("group", F.coalesce("doc_id", F.lit(NO_ID)).alias("k"), "t")
    first = found.groupBy("group").agg(F.min("k").alias("k"))
    first = found.join(first, ["group", "k"]).groupBy("group", "k").agg(F.min("t").alias("t"))
    has_words = F.coalesce(F.col("text").cast("string").rlike("[^ \\t-\\r]"), F.lit(False))
    names = [f"_{k}" for k in range(len(docs.columns))]  # no column of docs clashes with k and t
    told = _told_apart(docs.where(has_words).select(F.struct(*docs.columns).alias("row"), "doc_id", "text")).select("row", "k", "t")
    told = told.select(*[F.col("row")[c].alias(n) for c, n in zip(docs.columns, names)], "k", "t")
    kept = told.dropDuplicates(["k", "t"]).join(first.select("k", "t"), ["k", "t"], "left_semi").select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
    return kept.unionByName(docs.where(~has_words))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: that of the least doc_id. Five-word shingles, similarity 0.8 or more."""
    return one_of_each(docs, percent=80, width=5)
