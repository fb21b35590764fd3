"""Best-fit packing by a grouping genetic algorithm on islands.

Token sequences are cut into pieces of CAPACITY tokens at most. Full pieces are sequences of their own; the rest are
dealt by a hash into shards of about SHARD pieces, each a bin-packing problem of bounded size. In each shard ISLANDS
populations evolve apart: best-fit packings of shuffled, falling lengths are crossed by injecting whole well-filled bins
of one parent into the other, dropping the bins that hold a piece twice, emptying some of the emptier ones, and placing
the displaced pieces by best fit. An island stops where it needs no more bins than the sum of lengths asks for. After each round but the last every island's best packing migrates to the next island of its shard. Islands are rows:
a round is one pass over all islands and migration is a shuffle of lengths and bin numbers, never of texts.

What is left loose at the end is packed again: the pieces of all badly filled bins are dealt into new shards, so shards
cost no half-empty bins of their own.

Edge cases: a null or empty text is its end token alone; documents longer than CAPACITY are cut, none is dropped;
repeated rows are packed each for itself; pieces of equal length are placed by their order, packings of equal fitness
rank by age, and islands of equal bins by number; an empty table gives an empty result; a null doc_id is carried along;
extra columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomsift.lineage import written
from loomsift.llm.common import remembered, small_batches, table

CAPACITY, END = 2048, 0
#: Pieces of a shard, islands of a shard, packings of an island, crossings of an island in a round, rounds.
SHARD, ISLANDS, POPULATION, CROSSINGS, ROUNDS = 4000, 2, 4, 60, 2
#: Of a crossing: fill (as a quantile) from which bins can be injected, shares of bins injected and emptied, and how far
#: the order of displaced pieces strays from falling lengths.
GOOD, INJECTED, EMPTIED, BLUR = 0.6, 0.1, 0.1, 0.05
#: Bins below this fill are packed again at the end.
LOOSE = 0.985
#: Chunks, and parts of chunks, that a worker remembers in each of two generations, of so many bytes at most.
MEMO, PARTS_MEMO, MEMO_BYTES = 200_000, 400_000, 64
#: ASCII punctuation but the apostrophe.
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class PartIds(dict):
    """Ids of a chunk's core or of the punctuation at its end, as little-endian unsigned 32-bit numbers.

    A run of Latin letters is one word to the tokenizer: it goes to the model straight, written in the model's alphabet
    of bytes. Everything else takes the tokenizer's whole way.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.old: dict[bytes, bytes] = {}
        # Byte-level alphabet: printable bytes stand for themselves, the others for the letters from U+0100 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.alphabet = "".join(chr(b if b in plain else 256 + others.index(b)) for b in range(256))

    def __missing__(self, part: bytes) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            if part.isalpha():  # ASCII letters, lower-cased by the caller
                found = [t.id for t in self.model.tokenize(part.decode())]
            else:
                text = part.decode()
                if text.isalpha() and max(text) < "\u0180" and "\u0130" not in text:
                    word = text.lower().encode().decode("latin-1").translate(self.alphabet)
                    found = [t.id for t in self.model.tokenize(word)]
                else:
                    found = self.tokenizer.encode(text, add_special_tokens=False).ids
            ids = array("I", found).tobytes()
        if len(part) <= MEMO_BYTES:
            self[part] = ids
        return ids


class ChunkIds(dict):
    """Ids of a chunk without ASCII white space.

    The tokenizer drops white space and never forms a token across it, nor across a letter and the punctuation after it,
    so a text's ids are those of its chunks in order, and a chunk's those of its core and the punctuation at its end.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.parts = PartIds(path)
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            core = chunk.rstrip(PUNCTUATION)
            last = core[-1:]
            if not last.isalpha() and (last < b"\x80" or not core.decode()[-1].lower()[-1].isalpha()):
                core = chunk
            parts = self.parts
            ids = parts[core.lower() if core.isascii() else core]
            if len(core) < len(chunk):
                ids += parts[chunk[len(core) :]]
        if len(chunk) <= MEMO_BYTES:
            self[chunk] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        for known, most in ((self, MEMO), (self.parts, PARTS_MEMO)):  # what is still met comes back from the generation before
            if len(known) > most:
                known.old = dict(known)
                known.clear()
        return b"".join(map(self.__getitem__, text.encode().split()))


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row for each piece of each document: doc_id, piece, start, length, ids_crc32."""
    path = tokenizer or default_tokenizer()
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = remembered(("packing", path), lambda: ChunkIds(path))
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = memo.encode(text) + last
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    doc.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((doc, piece, start, length, crc), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, PIECE)


def best_fit(order: list[int], length: list[int], capacity: int, room: list[int], bin_of: list[int]) -> None:
    """Puts the pieces of `order` into the bin with least room that holds them, else into a new bin.

    room: what is left of each bin; bin_of: the bin of each piece. Both are changed.
    """
    free = sorted((r, b) for b, r in enumerate(room) if r)
    for piece in order:
        size = length[piece]
        at = bisect_left(free, (size, -1))
        if at < len(free):
            left, b = free.pop(at)
        else:
            left, b = capacity, len(room)
            room.append(capacity)
        bin_of[piece] = b
        room[b] = left - size
        if room[b]:
            insort(free, (room[b], b))


def packed_at_random(length: np.ndarray, capacity: int, rng: np.random.Generator, blur: float) -> np.ndarray:
    """Best fit of the lengths in falling order, each length blurred by a share at random."""
    order = np.argsort(-(length * (1 + blur * rng.standard_normal(len(length)))), kind="stable")
    room: list[int] = []
    bin_of = [0] * len(length)
    best_fit(order.tolist(), length.tolist(), capacity, room, bin_of)
    return np.array(bin_of, np.int32)


def fitness(length: np.ndarray, bin_of: np.ndarray, capacity: int) -> float:
    """Mean squared fill of the bins: more for fewer bins and for bins that are full or nearly empty."""
    fill = np.bincount(bin_of, weights=length) / capacity
    fill = fill[fill > 0]
    return float((fill * fill).mean()) if len(fill) else 1.0


def crossed(length: np.ndarray, mother: np.ndarray, father: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """The father with well-filled bins of the mother injected: his bins that hold one of their pieces go, some of his
    emptier ones too, and what they held besides is placed by best fit, the longest first."""
    fill, own = np.bincount(mother, weights=length), np.bincount(father, weights=length)
    good = np.flatnonzero(fill >= np.quantile(fill[fill > 0], GOOD))
    chosen = np.zeros(len(fill), bool)
    chosen[rng.permutation(good)[: max(1, int(INJECTED * len(good)))]] = True
    injected = chosen[mother]
    broken = np.zeros(len(own), bool)
    broken[father[injected]] = True
    whole = np.flatnonzero((own > 0) & ~broken)
    odds = (capacity - own[whole] + 1) * rng.random(len(whole))
    broken[whole[np.argsort(-odds)[: int(EMPTIED * len(whole)) + 1]]] = True
    stays = ~injected & ~broken[father]
    loose = ~injected & ~stays
    label = np.where(injected, mother, len(fill) + father)
    kept = injected | stays
    names, bins = np.unique(label[kept], return_inverse=True)
    bin_of = np.zeros(len(length), np.int64)
    bin_of[kept] = bins
    room = (capacity - np.bincount(bins, weights=length[kept], minlength=len(names))).astype(np.int64).tolist()
    out = bin_of.tolist()
    at = np.flatnonzero(loose)
    order = np.argsort(-length[at] * (1 + BLUR * rng.standard_normal(len(at))), kind="stable")
    best_fit(at[order].tolist(), length.tolist(), capacity, room, out)
    return np.array(out, np.int32)


def evolved(length: np.ndarray, start: list[np.ndarray], capacity: int, seed: int, crossings: int = CROSSINGS, population: int = POPULATION) -> list[np.ndarray]:
    """A population (best first) after some crossings; `start` are packings to begin with. Stops at the lower bound."""
    rng = np.random.default_rng(seed)
    found = [(-fitness(length, p, capacity), k, p) for k, p in enumerate(start)]
    while len(found) < population:
        made = packed_at_random(length, capacity, rng, 0.0 if not found and seed % 2 == 0 else 0.08)
        found.append((-fitness(length, made, capacity), len(found), made))
    found.sort(key=lambda f: f[:2])
    least = -(-int(length.sum()) // capacity)
    for k in range(crossings):
        if len(np.unique(found[0][2])) <= least:
            break
        a, b = rng.choice(len(found), 2, replace=False).tolist()
        child = crossed(length, found[a][2], found[b][2], capacity, rng)
        found.append((-fitness(length, child, capacity), len(start) + population + k, child))
        found = sorted(found, key=lambda f: f[:2])[:population]
    return [p for _, _, p in found]


def _islands(capacity: int):
    """A function of (shard, island, lengths, guest, population) rows, one for each island, that evolves each."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for shard, island, lengths, packings, step in zip(frame["shard"], frame["island"], frame["lengths"], frame["packings"], frame["step"]):
                length = np.asarray(lengths, np.int64)
                start = [np.asarray(p, np.int32) for p in packings]
                found = evolved(length, start, capacity, seed=int(shard) * 1009 + int(island) + 31 * int(step))
                rows.append((shard, island, lengths, found, step + 1))
            yield pd.DataFrame(rows, columns=["shard", "island", "lengths", "packings", "step"])

    return run


ISLAND = "shard long, island int, lengths array<int>, packings array<array<int>>, step int"
COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]


def packed(items: DataFrame, capacity: int = CAPACITY, shard_size: int = SHARD, level: int = 0) -> DataFrame:
    """items (item and COLUMNS) with sequence_id, offset and fill, the tokens of the whole sequence."""
    spark = items.sparkSession
    shards = max(1, round(items.count() / shard_size))
    dealt = items.select(F.pmod(F.xxhash64("item", F.lit(level)), F.lit(shards)).alias("shard"), F.struct("item", *COLUMNS).alias("p"))
    # `shards` bounds a shard's pieces, and so its arrays.
    problem = written(dealt.groupBy("shard").agg(F.sort_array(F.collect_list("p")).alias("pieces")), "pack-problem")
    tasks = min(shards * ISLANDS, max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    state = problem.select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("pieces.length").alias("lengths"),
        F.expr("cast(array() as array<array<int>>)").alias("packings"),
        F.lit(0).alias("step"),
    )
    for step in range(ROUNDS):
        state = written(state.repartition(tasks, "shard", "island").mapInPandas(_islands(capacity), ISLAND), "pack-islands")
        if step + 1 < ROUNDS:
            elite = state.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("packings")[0].alias("guest"))
            state = state.join(elite, ["shard", "island"]).select("shard", "island", "lengths", F.concat(F.array("guest"), "packings").alias("packings"), "step")
    best = state.select("shard", "island", F.col("packings")[0].alias("packing"), F.size(F.array_distinct(F.col("packings")[0])).alias("bins"))
    # Fewest bins, then the first island.
    chosen = best.groupBy("shard").agg(F.min(F.struct("bins", "island")).alias("top")).select("shard", "top.island")
    packing = best.join(chosen, ["shard", "island"]).select("shard", "packing")
    pairs = problem.join(packing, "shard").select("shard", F.explode(F.arrays_zip("pieces", "packing")).alias("z")).select("shard", "z.pieces.*", F.col("z.packing").alias("bin"))
    # The rows of a shard are together already; a sequence has at most `capacity` pieces.
    one = Window.partitionBy("shard", "bin")
    before = F.sum("length").over(one.orderBy("item").rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    number = (F.lit(level).cast("long") * 2**61) + F.col("shard") * 2**20 + F.col("bin")
    return pairs.select("item", *COLUMNS, number.alias("sequence_id"), before.alias("offset"), F.sum("length").over(one).alias("fill"))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, shard_size: int = SHARD) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row for each piece of each row of docs (doc_id, text)."""
    made = written(pieces(docs, tokenizer, capacity).withColumn("item", F.monotonically_increasing_id()), "pieces")
    whole = made.where(F.col("length") == capacity).select("item", *COLUMNS, (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    first = written(packed(made.where(F.col("length") < capacity), capacity, shard_size), "packed")
    tight = F.col("fill") >= LOOSE * capacity
    second = packed(first.where(~tight), capacity, shard_size, level=1).drop("fill")
    out = whole.unionByName(first.where(tight).drop("fill")).unionByName(second)
    return out.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents: the place of each in its sequence."""
    return pack(docs)
