"""Vector code compression: each vector becomes PARTS indexes into codebooks learned in integers (product quantisation).

Components become the integers floor(SCALE * x) and vectors are cut into PARTS equal consecutive parts. The codebook of
a part position starts as that part of the ENTRIES vectors of smallest vec_id. In each round the codebooks are broadcast
(their size is fixed: ENTRIES vectors), Arrow batches of vectors compute all squared distances by
|v|**2 - 2 v.c + |c|**2 with int64 matrix products, and each part takes the first nearest entry. A task adds up its
parts by entry and gives one row for each entry that it met, so what is shuffled does not grow with the vectors; the
sums are merged by a grouped shuffle, position by position, and every entry becomes floor(sum / count). After the last
round the parts are assigned once more. All numbers are integers, so results do not depend on the order of rows.

Vectors are written once as integers; rounds read only those. Nothing but the codebooks passes the driver.

Edge cases: vectors that are null or hold a null, NaN or infinite component are dropped. The dimension is that of the
vector of smallest vec_id; a vector of another dimension, or with a component of RANGE or more in size (beyond which
64-bit sums could overflow), cannot be coded: it is kept with null code and error and teaches nothing. A dimension that
PARTS does not divide is filled up with zeros, which add nothing to a distance; of a dimension 0 every part is entry 0.
Null vec_ids come after all others, and of rows that share a vec_id the one of the lesser vector comes first; repeated
rows have a row each, and may be entries each. With fewer vectors than ENTRIES there are fewer entries; with none the
result is empty. label_error adds up the errors of equal labels, null labels being one, and is null where none of the
label's vectors could be coded. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.lineage import unwritten, written
from loomsift.llm.common import table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components of at least this size, before scaling, are not coded.
RANGE = 32_768
#: Vectors whose distances are computed at once.
SLAB = 2_048


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v, small): the vectors of finite components as integers; small says that all are in range."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long"), "label", F.col("embedding").cast("array<double>").alias("embedding")).where(F.coalesce(finite, F.lit(False)))
    small = F.forall("embedding", lambda x: F.abs(x) < RANGE)
    return kept.select("vec_id", "label", F.when(small, F.transform("embedding", lambda x: F.floor(scale * x).cast("int"))).alias("v"), small.alias("small"))


def parted(column: pa.Array, width: int, parts: int) -> np.ndarray:
    """The vectors of a column as (parts, rows, width) integers, filled up with zeros."""
    n = len(column)
    flat = np.asarray(column.flatten()).reshape(n, -1).astype(np.int64)
    full = np.zeros((n, parts * width), np.int64)
    full[:, : flat.shape[1]] = flat
    return full.reshape(n, parts, width).transpose(1, 0, 2)


def nearest(v: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of a codebook for each row of v, and its squared distance."""
    far = (book * book).sum(axis=1) - 2 * (v @ book.T)
    at = far.argmin(axis=1)
    return at, far[np.arange(len(v)), at] + (v * v).sum(axis=1)


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLAB):
            yield batch.slice(at, SLAB)


def merged(coded: DataFrame, books: Broadcast, parts: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry): the number of parts nearest to it and their sum. At most parts * ENTRIES entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = books.value
        _, entries, width = book.shape
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for slab in _slabs(batches):
            for p, v in enumerate(parted(slab.column(0), width, parts)):
                at, _ = nearest(v, book[p])
                order = np.argsort(at, kind="stable")
                met, starts, n = np.unique(at[order], return_index=True, return_counts=True)
                counts[p, met] += n
                if width:
                    sums[p, met] += np.add.reduceat(v[order], starts, axis=0)
        p, e = np.nonzero(counts)
        ends = np.arange(len(p) + 1) * (width + 1)
        # The count rides along as one more position.
        values = np.concatenate([counts[p, e][:, None], sums[p, e]], axis=1).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], ["part", "entry", "sums"])

    rows = coded.select("v").mapInArrow(run, "part int, entry int, sums array<long>")
    added = rows.select("part", "entry", F.posexplode("sums").alias("pos", "x")).groupBy("part", "entry", "pos").agg(F.sum("x").alias("x"))
    found: dict[tuple[int, int], dict[int, int]] = {}
    for r in added.toLocalIterator():
        found.setdefault((r.part, r.entry), {})[r.pos] = r.x
    return {k: (x[0], [x[i] for i in range(1, len(x))]) for k, x in found.items()}


def codebooks(coded: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """(parts, entries, width) learned on coded (vec_id, v), all of one dimension; not empty."""
    first = coded.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()  # a top-k: ENTRIES rows
    width = -(-len(first[0].v) // parts)
    books = np.ascontiguousarray(parted(pa.array([r.v for r in first], pa.list_(pa.int32())), width, parts))
    spark = coded.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        new = books.copy()
        for (p, e), (n, sums) in merged(coded, shared, parts).items():
            new[p, e] = np.array(sums, np.int64) // n
        shared.unpersist()
        books = new
    return books


def assigned(coded: DataFrame, books: Broadcast, parts: int = PARTS) -> DataFrame:
    """(vec_id, label, code, error): two hex digits for each part, and the squared distances added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = books.value
        for slab in _slabs(batches):
            cut = parted(slab.column(2), book.shape[2], parts)
            at, error = zip(*[nearest(v, book[p]) for p, v in enumerate(cut)])
            codes = [row.tobytes().hex() for row in np.stack(at, axis=1).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([slab.column(0), slab.column(1), pa.array(codes, pa.string()), pa.array(sum(error), pa.int64())], ["vec_id", "label", "code", "error"])

    kind = coded.schema["label"].dataType.simpleString()
    return coded.select("vec_id", "label", "v").mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: one row for each kept row of vectors (vec_id, embedding, label)."""
    if entries > 256:
        raise ValueError("a code has two hex digits for each part")
    spark = vectors.sparkSession
    every = written(integers(vectors, scale), "vectors")
    lead = every.where("small").orderBy(F.asc_nulls_last("vec_id"), "v").limit(1).select(F.size("v")).collect()
    size = lead[0][0] if lead else -1
    fits = F.coalesce(F.size("v") == size, F.lit(False))
    books = codebooks(every.where(fits), parts, entries, rounds) if lead else np.zeros((parts, 0, 0), np.int64)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = assigned(every.where(fits), spark.sparkContext.broadcast(books), parts)
    rest = every.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = written(coded.union(rest), "vector-codes")
    unwritten(every)
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """All rounds written out; distances by differences, not by norms."""
    nearest = "list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        """kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT vec_id, label, k AS part, v[k * len(v) // 4 + 1 : (k + 1) * len(v) // 4] AS v FROM kept, range(4) t(k)
), book0 AS (
    SELECT part, v, entry FROM (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id, v) - 1 AS entry FROM parts) WHERE entry < 256
)"""
    ]
    for n in range(ROUNDS + 1):
        steps.append(f"""near{n} AS (
    SELECT p.vec_id, p.label, p.part, any_value(p.v) AS v, min({{'d': d, 'entry': b.entry}}) AS best
    FROM parts p JOIN book{n} b ON p.part = b.part, LATERAL (SELECT {nearest} AS d) GROUP BY p.vec_id, p.label, p.part
)""")
        if n < ROUNDS:
            steps.append(f"""sums{n} AS (
    SELECT part, best.entry AS entry, i, sum(v[i]) AS s, count(*) AS c FROM near{n}, range(1, 1 + (SELECT max(len(v)) FROM parts)) t(i) GROUP BY ALL
), new{n} AS (
    SELECT part, entry, list((s // c - (CASE WHEN s % c < 0 THEN 1 ELSE 0 END))::BIGINT ORDER BY i) AS v FROM sums{n} GROUP BY ALL
), book{n + 1} AS (
    SELECT b.part, coalesce(w.v, b.v) AS v, b.entry FROM book{n} b LEFT JOIN new{n} w ON b.part = w.part AND b.entry = w.entry
)""")
    return f"""WITH {', '.join(steps)}, coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
    FROM near{ROUNDS} GROUP BY vec_id, label
), digest AS (
    SELECT sha256(string_agg(list_aggregate(v, 'string_agg', ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, digest
"""


OP11_SQL = _sql()
