"""Toxicity: a counterfactual-regularised classifier of the words that a text holds.

Logistic regression over the distinct words of a text (runs of letters, lower-cased) and the beginnings of its words,
which inflected forms share, fitted by FTRL-proximal steps so that most weights are zero. In every labelled text that mentions a group, the
group's term is swapped for the other terms of its kind in the whole text, so all features that leave and that enter
count; the squared change of the margin is penalised, so that which group is named hardly moves a score. Neutral
sentences about every group, labelled harmless, are learned along and swapped in the same way. Terms and sentences are
in four languages; a term is swapped within its language.

Training reads a bounded sample: at most CELLS rows for each label, spread over all labelled rows outside the held-out
fold; one task fits it, as its size has a bound whatever the size of the tables. Of several rows of a sampled doc_id
the one whose text has the least hash is read.

Edge cases: null and empty texts have no words and get the score of the bias; very long texts are read whole; repeated
rows get equal scores; an empty table gives an empty result; without labels all scores are 0.5, and predicted is then
1; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import held_out, one_text, sample_by_label, small_batches, table
from loomsift.llm.langid import letter_words
from loomsift.llm.quality import Ftrl, sigmoid

CELLS, EPOCHS, MIN_TEXTS = 2000, 20, 3
ALPHA, BETA, L2 = 1.0, 1.0, 0.001
CHOOSING_L1, WEIGHING_L1 = 16.0, 0.5
#: What a toxic text counts against a harmless one.
POSITIVE = 3.0
#: Lengths of the beginnings.
STEMS = (3, 4, 5, 6)
#: Weight of the counterfactual penalty.
FAIRNESS = 0.5
THRESHOLD, MEMO = 0.5, 150_000

#: Chunks of so many characters at most are remembered.
MEMO_CHARS = 64

# Terms of groups by kind, and neutral sentences with a place for a term, in English, German, French, Spanish.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("disabled", "deaf", "blind", "autistic"),
    ("old", "young", "elderly"),
)
NEUTRAL = ("my {} neighbours came to the meeting", "a report about {} people in the city", "{} teachers and doctors spoke here", "we are proud to be {}")
TERMS_DE = (
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("schwarze", "weiße", "asiaten", "afrikaner", "europäer", "araber"),
    ("schwule", "lesben", "heteros", "bisexuelle"),
    ("einwanderer", "flüchtlinge", "bürger", "ausländer"),
    ("behinderte", "gehörlose", "blinde", "autisten"),
    ("alte", "junge", "senioren"),
)
NEUTRAL_DE = ("die {} aus der nachbarschaft kamen zum treffen", "ein bericht über {} in der stadt", "viele {} lehren und arbeiten hier", "wir kennen {} seit langem")
TERMS_FR = (
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("noirs", "blancs", "asiatiques", "africains", "européens", "arabes"),
    ("gays", "lesbiennes", "hétéros", "bisexuels"),
    ("immigrés", "réfugiés", "citoyens", "étrangers"),
    ("handicapés", "sourds", "aveugles", "autistes"),
    ("vieux", "jeunes", "aînés"),
)
NEUTRAL_FR = ("les {} du quartier sont venus à la réunion", "un rapport sur les {} de la ville", "beaucoup de {} travaillent ici", "nous connaissons des {} depuis longtemps")
TERMS_ES = (
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("negros", "blancos", "asiáticos", "africanos", "europeos", "árabes"),
    ("gais", "lesbianas", "heteros", "bisexuales"),
    ("inmigrantes", "refugiados", "ciudadanos", "extranjeros"),
    ("discapacitados", "sordos", "ciegos", "autistas"),
    ("viejos", "jóvenes", "mayores"),
)
NEUTRAL_ES = ("los {} del barrio vinieron a la reunión", "un informe sobre {} en la ciudad", "muchos {} trabajan aquí", "conocemos a {} desde hace tiempo")
LANGUAGES = ((IDENTITY_TERMS, NEUTRAL), (TERMS_DE, NEUTRAL_DE), (TERMS_FR, NEUTRAL_FR), (TERMS_ES, NEUTRAL_ES))
KIND = {term: kind for terms, _ in LANGUAGES for kind in terms for term in kind}


def marks(word: str) -> list[str]:
    """The word itself and its beginnings, these with a hyphen."""
    return [word, *(word[:k] + "-" for k in STEMS if len(word) > k)]


def words_of(text: str | None) -> set[str]:
    return {m for chunk in set((text or "").split()) for w in letter_words(chunk) for m in marks(w)}


def swaps(words: set[str]) -> Iterator[tuple[str, str]]:
    """(term in the text, term of its kind that takes its place)."""
    for term in sorted(words & KIND.keys()):
        for other in KIND[term]:
            if other not in words:
                yield term, other


def swapped(words: set[str], term: str, other: str) -> tuple[list[str], list[str]]:
    """Features that leave and that enter when other takes the place of term; those that other words give stay."""
    stay = {m for w in words if w != term and not w.endswith("-") for m in marks(w)}
    return sorted((set(marks(term)) & words) - stay), sorted(set(marks(other)) - stay - (words - set(marks(term))))


def fit(texts: list[set[str]], labels: list[float], fairness: float = FAIRNESS, seed: int = 5) -> dict[str, float]:
    """Weights by word, the bias under ''.

    A first fit with a strong L1 penalty chooses the words, a second with a weak one gives the chosen their weights.
    Only words of MIN_TEXTS texts at least, and the terms, can be chosen.
    """
    neutral = [words_of(s.format(t)) for terms, sentences in LANGUAGES for kind in terms for t in kind for s in sentences]
    texts, labels = [*texts, *neutral], [*labels, *[0.0] * len(neutral)]
    count: dict[str, int] = {}
    for words in texts:
        for w in words:
            count[w] = count.get(w, 0) + 1
    names = sorted(w for w, n in count.items() if n >= MIN_TEXTS or w in KIND)
    for l1 in (CHOOSING_L1, WEIGHING_L1):
        weights = _fitted(texts, labels, names, l1, fairness, seed)
        names = [w for w in names if weights[w] or w in KIND]
    return {w: v for w, v in weights.items() if v or not w}


def _fitted(texts: list[set[str]], labels: list[float], names: list[str], l1: float, fairness: float, seed: int) -> dict[str, float]:
    at = {w: k for k, w in enumerate(names)}
    bias = len(names)
    rows = [np.array([*sorted(at[w] for w in words if w in at), bias]) for words in texts]
    pairs = []
    for words in texts:
        changes = [[[at[w] for w in side if w in at] for side in swapped(words, *pair)] for pair in swaps(words)]
        pairs.append([(np.array([*out, *new]), np.array([1.0] * len(out) + [-1.0] * len(new))) for out, new in changes])
    model, rng = Ftrl(bias + 1, ALPHA, BETA, l1, L2), np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            model.learn(rows[k], np.ones(len(rows[k])), labels[k], POSITIVE if labels[k] else 1.0)
            for both, sign in pairs[k]:
                # The margin changes by the weights that leave less those that enter; its square is the penalty.
                w = model.weights(both)
                model.step(both, 2 * fairness * (sign @ w) / len(pairs[k]) * sign, w)
    found = model.weights()
    return {w: float(found[k]) for w, k in [*at.items(), ("", bias)]}


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> dict[str, float]:
    """Weights from labelled rows outside the held-out fold."""
    fold = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    sample = sample_by_label(fold.distinct(), "label", CELLS)
    rows = one_text(docs, sample)

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "label"])
        found = fit([words_of(t) for t in frame["text"]], frame["label"].astype(float).tolist())
        return pd.DataFrame({"word": list(found), "weight": list(found.values())})

    # The chosen words, some thousands at most.
    found = rows.groupBy(F.lit(0).alias("all")).applyInPandas(train, "word string, weight double")
    return {r.word: r.weight for r in found.collect()} or {"": 0.0}


class _Known(dict):
    """The words with a weight that a chunk holds; most chunks have none."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, chunk: str) -> tuple[str, ...]:
        out = tuple(m for w in letter_words(chunk) for m in marks(w) if m in self.weights)
        if len(chunk) <= MEMO_CHARS:
            self[chunk] = out
        return out


def margin(text: str | None, known: _Known) -> float:
    words = set().union(*filter(None, map(known.__getitem__, (text or "").split())))
    return known.weights[""] + sum(known.weights[w] for w in sorted(words))


def score(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """doc_id and score of every row of docs (doc_id, text)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(shared.value)
        for batch in batches:
            if len(known) > MEMO:
                known.clear()
            margins = np.array([margin(t, known) for t in batch.column(1).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(margins))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
