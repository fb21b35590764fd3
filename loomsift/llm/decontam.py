"""Benchmark decontamination by q-gram lemma filtering.

A document leaks a benchmark item if some passage of it lies within an edit budget of the whole item: at most RATE of the
item's characters, after both are lower-cased and runs of white space become one space. By the q-gram lemma such a
passage shares at least m - q + 1 - k * q of the item's q-grams (m its length, k the budget), all on diagonals (position
in the document less position in the item) that differ by k at most. q is Q, or less for items where that bound would
fall below one, so the bound is one at least for every item.

Shared q-grams are counted in overlapping diagonal bands. Positions are first cut into cells of k + 1 characters on both
sides; a q-gram of x occurrences in a cell of the document and y in a cell of the item counts min(x, y) on the difference
of the two cells. An item has 1 / RATE cells or so, so the counting is linear in the text however often a q-gram repeats
on both sides. Three neighbouring differences hold all q-grams of a passage within the budget; where they meet the bound
the band is kept, neighbouring bands are joined, and the region is verified by alignment within it. Nothing below the
bound can be a leak, so the filter loses none.

Items under MIN_ITEM characters have too few q-grams for edits: they leak where they stand verbatim between word borders.

The items are the query set. They travel to the workers in blocks of BLOCK_CHARS characters at most, one pass over the
documents for each block; documents never meet each other and nothing is shuffled.

Edge cases: null and empty texts and items match nothing; each item that a document leaks gives one row, repeated rows of
documents or benchmark repeat them; a row has the fewest edits of any passage, ties go to the earliest end; texts of any
length are read whole; extra columns are ignored; an empty table of documents or items gives an empty result. The stage
decides row by row: rows of a null or repeated doc_id stay or go by their own text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import remembered, small_batches, table

Q, RATE, MIN_ITEM = 10, 0.08, 20
BLOCK_CHARS = 4_000_000
#: Characters of documents that are hashed at once, and documents that are counted at once (their rows and characters).
SLICE, ROWS, CHARS = 1 << 20, 64, 1 << 20
#: Diagonals that are aligned at once.
REGION = 1 << 16
TABLE_BITS = 22
BASE = 0x9E3779B97F4A7C15
MATCH = "doc_id long, item_id long, edits int, end long, shared int"
Leak = tuple[int, int, int, int, int]


def normalised(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(c: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the q characters from each position, by doubling: hashes of 1, 2, 4, ... characters, put together as q has them."""
    if len(c) < q:
        return np.zeros(0, np.uint64)
    piece, size, done = c.astype(np.uint64) + np.uint64(1), 1, 0
    out = np.zeros(len(c) - q + 1, np.uint64)
    with np.errstate(over="ignore"):
        while True:
            power = np.uint64(pow(BASE, size, 1 << 64))
            if q & size:
                out = out * power + piece[done : done + len(out)]
                done += size
            if 2 * size > q:
                break
            piece = piece[:-size] * power + piece[size:]
            size *= 2
        return (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def budget(length: int) -> int:
    return int(RATE * length)


def gram_size(length: int) -> int:
    """The longest q up to Q for which a passage within the budget shares at least one q-gram."""
    return max(1, min(Q, length // (budget(length) + 1)))


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys begins, and its length."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(key)))


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] numbers), first[1], ..."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)


class Grams:
    """The q-grams of items of one q: sorted hashes, the items that each has, and the cells of each in an item.

    A table of the hashes' first bits rules most positions of a text out.
    """

    def __init__(self, q: int, items: list[int], arrays: list[np.ndarray], width: np.ndarray) -> None:
        self.q = q
        hashes = [gram_hashes(arrays[i], q) for i in items]
        flat = np.concatenate(hashes)
        item = np.repeat(np.array(items, np.int64), [len(h) for h in hashes])
        cell = np.concatenate([np.arange(len(h)) for h in hashes]) // width[item]
        order = np.lexsort([cell, item, flat])
        flat, item, cell = flat[order], item[order], cell[order]
        new_hash = np.concatenate([[True], flat[1:] != flat[:-1]])
        new_entry = new_hash | np.concatenate([[True], item[1:] != item[:-1]])
        new_cell = new_entry | np.concatenate([[True], cell[1:] != cell[:-1]])
        at_hash, at_entry, at_cell = (np.flatnonzero(x) for x in (new_hash, new_entry, new_cell))
        self.hash = flat[at_hash]
        self.entry_first = np.searchsorted(at_entry, at_hash)
        self.entry_count = np.diff(np.append(self.entry_first, len(at_entry)))
        self.item = item[at_entry]
        self.cell_first = np.searchsorted(at_cell, at_entry)
        self.cell_count = np.diff(np.append(self.cell_first, len(at_cell)))
        self.cell = cell[at_cell]
        self.times = np.diff(np.append(at_cell, len(flat)))
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.hash >> np.uint64(64 - TABLE_BITS)] = True

    def counts(self, joined: np.ndarray, starts: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, item, difference of cells, count): shared q-grams of the texts that `joined` has, beginning at `starts`."""
        at, gram = [], []
        for start in range(0, len(joined), SLICE):
            h = gram_hashes(joined[start : start + SLICE + self.q - 1], self.q)
            maybe = np.flatnonzero(self.table[h >> np.uint64(64 - TABLE_BITS)])
            found = np.searchsorted(self.hash, h[maybe])
            found[found == len(self.hash)] = 0
            same = self.hash[found] == h[maybe]
            at.append(maybe[same] + start)
            gram.append(found[same])
        at, gram = np.concatenate(at), np.concatenate(gram)
        n = self.entry_count[gram]
        at, entry = np.repeat(at, n), _spread(self.entry_first[gram], n)
        row = np.searchsorted(starts, at, side="right") - 1
        key = ((row << 24 | entry) << 32) | (at - starts[row]) // width[self.item[entry]]
        key.sort()
        first, times = _groups(key)
        key = key[first]
        entry, cell = key >> 32 & (1 << 24) - 1, key & (1 << 32) - 1
        n = self.cell_count[entry]
        where = _spread(self.cell_first[entry], n)
        return np.repeat(key >> 56, n), np.repeat(self.item[entry], n), np.repeat(cell, n) - self.cell[where], np.minimum(np.repeat(times, n), self.times[where])


class Index:
    """A block of items: their q-grams, budgets and bounds, and an automaton of the short ones."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        kept = [(i, normalised(t)) for i, t in items]
        self.items = [(i, codes(t)) for i, t in kept if len(t) >= MIN_ITEM]
        self.short: dict[str, list[int]] = {}
        for i, t in kept:
            if 0 < len(t) < MIN_ITEM:
                self.short.setdefault(t, []).append(i)
        self.automaton = None
        if self.short:
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for t in self.short:
                self.automaton.add_word(t, t)
            self.automaton.make_automaton()
        arrays = [c for _, c in self.items]
        length = np.array(list(map(len, arrays)), np.int64)
        self.k = np.array([budget(n) for n in length], np.int64)
        self.width = self.k + 1
        q = np.array([gram_size(n) for n in length], np.int64)
        self.least = length - q + 1 - self.k * q
        self.grams = [Grams(int(x), np.flatnonzero(q == x).tolist(), arrays, self.width) for x in np.unique(q)]

    def regions(self, joined: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, first band, last band, most shared q-grams) of neighbouring bands that meet the bound, in order."""
        parts = [g.counts(joined, starts, self.width) for g in self.grams]
        if not sum(len(p[0]) for p in parts):
            return
        row, item, c, n = (np.concatenate(x) for x in zip(*parts))
        items, zero = len(self.items), 1 << 24
        key = (np.concatenate([row * items + item] * 3) << 34) + np.concatenate([c, c - 1, c - 2]) + zero
        order = np.argsort(key, kind="stable")
        key = key[order]
        first, _ = _groups(key)
        total, key = np.add.reduceat(np.concatenate([n, n, n])[order], first), key[first]
        pair, band = key >> 34, (key & (1 << 34) - 1) - zero
        good = total >= self.least[pair % items]
        pair, band, total = pair[good], band[good], total[good]
        if not len(pair):
            return
        new = np.concatenate([[True], (pair[1:] != pair[:-1]) | (band[1:] > band[:-1] + 2)])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(pair))
        for a, b, most in zip(begin, end, np.maximum.reduceat(total, begin)):
            yield int(pair[a] // items), int(pair[a] % items), int(band[a]), int(band[b - 1]), int(most)


def banded(item: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> tuple[int, int]:
    """Least edits between the item and a passage of text whose diagonals lie in [low - k, high + k], and its earliest end.

    Row r holds the cost of the item's first r characters ending on each diagonal; edits beyond the band count as too many.
    """
    first, width = low - k, high - low + 2 * k + 1
    window = np.full(len(item) + width, 0xFFFFFFFF, np.uint32)
    lo, hi = max(0, first), min(len(text), first + len(window))
    if hi <= lo:
        return k + 1, 0
    window[lo - first : hi - first] = text[lo:hi]
    steps = np.arange(width, dtype=np.int32)
    row = np.zeros(width, np.int32)
    for r, c in enumerate(item):
        new = row + (window[r : r + width] != c)
        np.minimum(new[:-1], row[1:] + 1, out=new[:-1])
        new -= steps
        row = np.minimum.accumulate(new, out=new)
        row += steps
        if r % 32 == 31 and row.min() > k:
            return k + 1, 0
    best = int(row.argmin())
    return int(row[best]), best + first + len(item)


def _verbatim(text: str, index: Index) -> Iterator[tuple[int, int, int]]:
    """(item_id, end, characters) of the short items that stand between word borders, the first place of each."""
    seen = set()
    for last, item in index.automaton.iter(text):
        a, b = last + 1 - len(item), last + 1
        if item not in seen and not (a and text[a - 1].isalnum() and item[0].isalnum()) and not (text[b : b + 1].isalnum() and item[-1].isalnum()):
            seen.add(item)
            yield from ((i, b, len(item)) for i in index.short[item])


def _part(texts: list[str], index: Index) -> Iterator[Leak]:
    arrays = [codes(t) for t in texts]
    gap = np.full(1, 0x110000, np.uint32)  # no character: a q-gram never spans two texts
    joined = np.concatenate([x for a in arrays for x in (a, gap)])
    starts = np.cumsum([0] + [len(a) + 1 for a in arrays])
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for row, i, first, last, shared in index.regions(joined, starts):
        if found.get((row, i), (1,))[0] == 0:
            continue  # verbatim already, and earlier
        k, w, c = int(index.k[i]), int(index.width[i]), index.items[i][1]
        for low in range(first * w, (last + 2) * w, REGION):
            edits, end = banded(c, arrays[row], low, min(low + REGION, (last + 2) * w) - 1, k)
            if edits <= k:
                found[row, i] = min(found.get((row, i), (edits, end, -shared)), (edits, end, -shared))
            if edits == 0:
                break
    for (row, i), (edits, end, shared) in sorted(found.items()):
        yield row, index.items[i][0], edits, end, -shared
    if index.automaton is not None:
        for row, text in enumerate(texts):
            for i, end, size in _verbatim(text, index):
                yield row, i, 0, end, size - min(Q, size) + 1


def leaks(texts: list[str | None], index: Index) -> Iterator[Leak]:
    """(row, item_id, edits, end, shared) of the rows of `texts`; end counts characters of the normalised text."""
    part: list[str] = []
    size = start = 0
    for k, text in enumerate(map(normalised, texts)):
        if part and (len(part) == ROWS or size + len(text) > CHARS):
            yield from ((start + row, *rest) for row, *rest in _part(part, index))
            part, size, start = [], 0, k
        part.append(text)
        size += len(text)
    if part:
        yield from ((start + row, *rest) for row, *rest in _part(part, index))


def blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size."""
    block, size = [], 0
    for row in benchmark.where(F.length("text") > 0).select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        if block and size + len(row[1]) > chars:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += len(row[1])
    if block:
        yield block


def _index_on_workers(spark: SparkSession, block: list[tuple[int, str]]):
    """A function that gives the block's index in a worker, which keeps it from task to task."""
    shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex
    return lambda: remembered(("decontam", name), lambda: Index(shared.value))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each (document, item) whose passage lies within the edit budget."""
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = spark.createDataFrame([], MATCH)
    for block in blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], index=_index_on_workers(spark, block)) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[r], *rest) for r, *rest in leaks(batch.column(1).to_pylist(), index())]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], ["doc_id", "item_id", "edits", "end", "shared"])

        found = found.union(narrow.mapInArrow(run, MATCH))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose text leaks no item, with all their columns; rows are filtered where they are."""
    spark = docs.sparkSession
    small_batches(spark)
    at = docs.columns.index("text")
    for block in blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], index=_index_on_workers(spark, block)) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaked = {row for row, *_ in leaks(batch.column(at).to_pylist(), index())}
                yield batch.filter(pa.array([k not in leaked for k in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that leak no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))
