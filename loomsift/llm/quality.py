"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader updates.

A text is read as two sequences of words: its words as written (lower-cased) and their shapes (classes of letters, and
the marks around them), each giving unigrams and bigrams; a word that repeats the one before gives one feature whatever
the word is. Features are hashed into 2**BITS places and a text's vector holds their shares, so its length does not
matter; scoring is the dot product of that vector with the weights.

Training reads a bounded sample: at most CELLS rows for each label, spread over all labelled rows outside the held-out
fold. The sample is dealt into SHARDS; each runs EPOCHS of FTRL-proximal and the weights are averaged.

Edge cases: null and empty texts have no features and get the score of the bias; very long texts are read whole;
repeated rows get equal scores; an empty table gives an empty result; without labels all scores are 0.5; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import held_out, one_text, sample_by_label, small_batches, table

BITS, CELLS, SHARDS, EPOCHS = 18, 2000, 4, 12
#: FTRL: learning rate, its offset, and the two penalties; what a share of 1 counts in a vector.
ALPHA, BETA, L1, L2, SCALE = 0.6, 1.0, 0.02, 0.05, 12.0
THRESHOLD = 0.3
#: Chunks that a worker remembers, of so many characters at most.
MEMO, MEMO_CHARS = 150_000, 64
SHARED, MASK = np.uint64(0x9E3779B97F4A7C15), np.uint64((1 << BITS) - 1)


def shape(chunk: str) -> str:
    """Classes of the characters of a chunk, runs as one: 'The,' is 'Aa,', 'THE!!' is 'A!!', '42***' is '0***'."""
    out = []
    for c in chunk:
        kind = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        if kind not in "Aa0" or not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


class _Pairs(dict):
    """(hash of the word, hash of its shape) of a chunk, as an index into two growing arrays. Long chunks are not remembered."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[tuple[int, int]] = []
        self.known = np.zeros((0, 2), np.uint64)

    def size(self) -> int:
        return len(self.known) + len(self.fresh)

    def __missing__(self, chunk: str) -> int:
        at = self.size()
        self.fresh.append((xxhash.xxh3_64_intdigest("w" + chunk.lower()), xxhash.xxh3_64_intdigest("s" + shape(chunk))))
        if len(chunk) <= MEMO_CHARS:
            self[chunk] = at
        return at

    def rows(self) -> np.ndarray:
        if self.fresh:
            self.known = np.concatenate([self.known, np.array(self.fresh, np.uint64)])
            self.fresh = []
        return self.known


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * SHARED
    return ((h ^ (h >> np.uint64(32))) & MASK).astype(np.int64)


def places(words: np.ndarray) -> np.ndarray:
    """Hash places of all n-grams of one text; words: rows of (word hash, shape hash)."""
    w, s = words[:, 0], words[:, 1]
    same = w[1:] == w[:-1]
    pair = np.where(same, SHARED, w[1:] * np.uint64(3) ^ w[:-1])
    return _mixed(np.concatenate([w, s, pair, s[1:] * np.uint64(5) ^ s[:-1]]))


def texts_places(texts: list[str | None], memo: _Pairs) -> list[np.ndarray]:
    picks = [np.fromiter(map(memo.__getitem__, t.split()), np.int64) if t else np.zeros(0, np.int64) for t in texts]
    rows = memo.rows()
    with np.errstate(over="ignore"):
        return [places(rows[p]) if len(p) else p for p in picks]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """FTRL-proximal over `size` weights; the last place is the bias."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> None:
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def step(self, at: np.ndarray, gradient: np.ndarray, w: np.ndarray) -> None:
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + gradient * gradient

    def learn(self, at: np.ndarray, value: np.ndarray, label: float, weight: float = 1.0) -> None:
        w = self.weights(at)
        self.step(at, weight * (float(sigmoid(w @ value)) - label) * value, w)


def vector(places_of: np.ndarray, bias: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and values of a text, the bias last."""
    at, count = np.unique(places_of, return_counts=True)
    return np.append(at, bias), np.append(SCALE * count / max(1, len(places_of)), 1.0)


def learn(docs: DataFrame, labels: DataFrame, label: str) -> np.ndarray:
    """Weights (bias last) from labelled rows outside the held-out fold."""
    size = (1 << BITS) + 1
    fold = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    sample = sample_by_label(fold.distinct(), "label", CELLS)
    rows = one_text(docs, sample).withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SHARDS)))

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "label"])
        vectors = [vector(p, size - 1) for p in texts_places(frame["text"].tolist(), _Pairs())]
        model, rng = Ftrl(size), np.random.default_rng(7)
        for _ in range(EPOCHS):
            for k in rng.permutation(len(vectors)):
                model.learn(*vectors[k], float(frame["label"].iloc[k]))
        return pd.DataFrame({"rows": [len(frame)], "weights": [model.weights().astype("<f4").tobytes()]})

    shards = rows.groupBy("shard").applyInPandas(train, "rows long, weights binary").collect()  # SHARDS rows of 1 MB
    if not shards:
        return np.zeros(size, np.float32)
    each = np.stack([np.frombuffer(r.weights, "<f4") for r in shards])
    return np.average(each, axis=0, weights=[r.rows for r in shards]).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of every row of docs (doc_id, text)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, memo = shared.value.astype(np.float64), _Pairs()
        for batch in batches:
            if memo.size() > MEMO:
                memo = _Pairs()
            found = texts_places(batch.column(1).to_pylist(), memo)
            margin = np.array([SCALE * w[p].mean() if len(p) else 0.0 for p in found]) + w[-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(margin))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, learn(docs, table(spark, sf_dir, "labels"), "quality"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
