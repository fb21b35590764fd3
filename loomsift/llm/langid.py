"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text is built for each language: passages of labelled documents as they stand, lower-cased,
with everything but letters made single spaces. A text is parsed, in the same form, into the longest phrases that the
automaton of a language knows; a phrase may cross words, and a letter that the automaton lacks is a phrase of its own.
The language whose parse costs the fewest bits wins: its phrases times the bits of a pointer into its text, for each
letter.

Texts are parsed in stretches of STRETCH characters, a phrase ending with its stretch, and all stretches of a batch
advance together by one character a step, so the work of a step is one look-up in the automaton's table for each.

No letter is left out, however many there are. Where all languages together have at most SHARED letters, their tables are
over one alphabet. With more, each language has an alphabet of its own, into which a step's letters are translated. A
table has a place for each state and letter if it has its share of DENSE places at most; a larger one (ideographs) has
only the transitions that occur, in order, and is searched.

Learning reads a bounded sample: at most SAMPLE_DOCS labelled rows a language (fewer if there are more than LANGUAGES
languages, one at least), spread by hash over all of them, and of each a passage of at most PASSAGE characters at a place
chosen by hash. So the model grows with the number of label values beyond LANGUAGES * SAMPLE_DOCS of them, by one passage each.

Edge cases: null texts and texts without a letter get language `und` and score 0; very long texts are parsed whole;
repeated rows get equal results; an empty table gives an empty result; without any labelled row every text is `und`;
a language with tied cost is chosen by name; extra columns are passed on. The stage drops the rows of `und`, and those of
which the chosen language's text lacks more than half of the letters: they are in a script that nothing was learned of.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.llm.common import held_out, remembered, sample_by_label, small_batches, table

#: Labelled documents taken for each language, characters of the passage taken of each, and for how many languages so many.
SAMPLE_DOCS, PASSAGE, LANGUAGES = 96, 1024, 16
#: Characters that are parsed in one go, and stretches that are parsed together.
STRETCH, TOGETHER = 1024, 8192
#: How sharply the score falls with the distance in bits a letter between the languages.
SHARPNESS = 12.0
#: Share of its letters that the chosen language must know for the stage to keep a document.
LEAST_KNOWN = 0.5
#: Letters that all languages may have together to share an alphabet, and places (4 bytes each) that the tables of all
#: languages with a place for each state and letter may have.
SHARED, DENSE = 96, 96_000_000
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"
#: Codes of a letter that no automaton has, and of white space; the letters follow.
UNKNOWN, SPACE = 0, 1


def letter_words(chunk: str) -> list[str]:
    """Lower-case runs of letters in a chunk without white space."""
    bare = chunk.strip(MARKS)
    if bare.isalpha():
        return [bare.lower()]
    return "".join(c if c.isalpha() else " " for c in chunk).lower().split()


class SuffixAutomaton:
    """Suffix automaton of a text: for each state the next state by character."""

    def __init__(self, text: str) -> None:
        step: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(step)
            step.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = cur
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(step)
                    step.append(dict(step[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.step = step

    def table(self, codes: dict[str, int]) -> np.ndarray:
        """Flat table at state * width + code of the next state * width; its complement where a phrase ends before the
        character. A character that the text lacks leads to the start."""
        width = max(codes.values(), default=SPACE) + 1
        root = self.first(codes) * width
        out = np.empty((len(self.step), width), np.int32)
        out[:] = np.where(root >= 0, ~root, -1)
        out[0] = np.maximum(root, 0)
        for s, onward in enumerate(self.step):
            for c, n in onward.items():
                out[s, codes[c]] = n * width
        return out.ravel()

    def first(self, codes: dict[str, int]) -> np.ndarray:
        """The state after one character by its code, negative for a character that the text lacks."""
        root = np.full(max(codes.values(), default=SPACE) + 1, -1, np.int32)
        for c, n in self.step[0].items():
            root[codes[c]] = n
        return root


class DenseTable:
    """An automaton with a place for each state and letter."""

    def __init__(self, automaton: SuffixAutomaton, codes: dict[str, int]) -> None:
        self.table = automaton.table(codes)

    def parsed(self, steps: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases of stretches of text, a column of `steps` each; active[t] of them have a character at step t."""
        table_ = self.table
        state, ended = np.zeros(steps.shape[1], np.int32), np.zeros(steps.shape[1], np.int32)
        for codes, n in zip(steps, active.tolist()):
            now = table_[state[:n] + codes[:n]]
            breaks = now >> 31  # -1 where a phrase ended
            ended[:n] -= breaks
            state[:n] = now ^ breaks
        return ended + (state != 0)


class SparseTable:
    """An automaton with the transitions that occur, in order of state and letter: linear in its text."""

    def __init__(self, automaton: SuffixAutomaton, codes: dict[str, int]) -> None:
        self.root = automaton.first(codes)
        self.width = len(self.root)
        moves = sorted((s * self.width + codes[c], n) for s, onward in enumerate(automaton.step) for c, n in onward.items())
        self.keys, self.next = np.array([k for k, _ in moves], np.int64), np.array([n for _, n in moves], np.int32)

    def parsed(self, steps: np.ndarray, active: np.ndarray) -> np.ndarray:
        """As DenseTable.parsed()."""
        start = np.maximum(self.root, 0)
        state, ended = np.zeros(steps.shape[1], np.int64), np.zeros(steps.shape[1], np.int32)
        for codes, n in zip(steps, active.tolist()):
            key = state[:n] * self.width + codes[:n]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            goes_on = self.keys[place] == key
            # A phrase ends where the state has no such letter; a letter that the text lacks ends none at the start.
            ended[:n] += ~goes_on & (state[:n] != 0)
            state[:n] = np.where(goes_on, self.next[place], start[codes[:n]])
        return ended + (state != 0)


def plain(text: str) -> str:
    """Lower case; everything but letters as single spaces, with one at both ends."""
    return " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "


def learn(docs: DataFrame, lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> tuple[tuple[str, str], ...]:
    """(language, reference text) pairs from a bounded sample of the labelled rows outside the held-out fold."""
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("text").isNotNull()).select("doc_id", "text", F.col(lang).cast("string").alias("_lang"))
    languages = rows.select("_lang").distinct().count()
    cells = max(1, min(sample_docs, sample_docs * LANGUAGES // max(1, languages)))
    passages = F.ceil(F.length("text") / PASSAGE)
    place = F.pmod(F.xxhash64("doc_id", F.lit(19)), F.greatest(passages, F.lit(1))) * PASSAGE + 1
    sample = sample_by_label(rows, "_lang", cells).select("_lang", "doc_id", F.substr("text", place.cast("int"), F.lit(PASSAGE)).alias("passage"))
    found: dict[str, list[tuple[int, str]]] = {}
    for row in sample.collect():  # bounded: `cells` passages a language
        found.setdefault(row[0], []).append((row[1], row[2]))
    return tuple((k, plain(" ".join(t for _, t in sorted(v)))) for k, v in sorted(found.items()))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """UNKNOWN for each code point that is a letter, else SPACE."""
    return np.fromiter((UNKNOWN if chr(c).isalpha() else SPACE for c in range(0x110000)), np.uint8, 0x110000)


class Parser:
    """The automata of a model as tables over one alphabet."""

    def __init__(self, model: tuple[tuple[str, str], ...]) -> None:
        self.names = [k for k, _ in model]
        codes = {" ": SPACE} | {c: k + 2 for k, c in enumerate(sorted({c for _, text in model for c in text} - {" "}))}
        self.width = len(codes) + 1
        self.kind = np.min_scalar_type(self.width)
        self.lookup = _letters().astype(self.kind)
        self.lookup[[ord(c) for c in codes]] = list(codes.values())
        self.tables: list[DenseTable | SparseTable] = []
        # Of each language the own code of a shared one, None where they are the same.
        self.own: list[np.ndarray | None] = []
        self.lacks = np.ones((self.width, len(model)), np.int64)
        self.bits = np.array([math.log2(len(t) + 2) for _, t in model])
        for k, (_, text) in enumerate(model):
            automaton, letters = SuffixAutomaton(text), sorted(set(text) - {" "})
            mine, own = codes, None
            if self.width > SHARED:
                mine = {" ": SPACE} | {c: n + 2 for n, c in enumerate(letters)}
                own = np.full(self.width, UNKNOWN, np.min_scalar_type(len(mine) + 1))
                own[[codes[c] for c in mine]] = list(mine.values())
            self.own.append(own)
            dense = len(automaton.step) * (len(mine) + 1) * len(model) <= DENSE
            self.tables.append((DenseTable if dense else SparseTable)(automaton, mine))
            self.lacks[[codes[c] for c in letters], k] = 0
        self.lacks[SPACE] = 0

    def codes(self, text: str | None) -> np.ndarray:
        """The text's letters and single spaces, with a space at both ends, as codes."""
        points = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        c = self.lookup[points]
        space = c == SPACE
        space[1:] &= space[:-1]
        space[0] = False
        return c[~space]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (a row) in each language, those of letters that it lacks not counted."""
        sizes = np.array([len(t) for t in texts], np.int64)
        pieces = -(-sizes // STRETCH)
        of_text = np.repeat(np.arange(len(texts)), pieces)
        place = np.arange(len(of_text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(sizes[of_text] - place * STRETCH, STRETCH)
        out = np.zeros((len(texts), len(self.tables)), np.int64)
        order = np.argsort(-size, kind="stable")
        for at in range(0, len(order), TOGETHER):
            own = order[at : at + TOGETHER]
            longest = int(size[own[0]])
            block = np.zeros((len(own), longest), self.kind)
            for k, piece in enumerate(own):
                part = texts[of_text[piece]][place[piece] * STRETCH :][:STRETCH]
                block[k, : len(part)] = part
            steps = np.ascontiguousarray(block.T)
            active = np.searchsorted(-size[own], -np.arange(longest), side="left")  # the longest come first
            for k, (table_, code) in enumerate(zip(self.tables, self.own)):
                found = table_.parsed(steps if code is None else code[steps], active)
                out[:, k] += np.bincount(of_text[own], weights=found, minlength=len(texts)).astype(np.int64)
        return out


def _found(texts: list[str | None], parser: Parser) -> Iterator[tuple[str, float, float]]:
    """(language, score, share of the letters that the language knows) of each text."""
    coded = [parser.codes(t) for t in texts]
    if not parser.names:
        yield from (("und", 0.0, 0.0) for _ in texts)
        return
    letters, lacks = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(parser.names)), np.int64)
    for k, c in enumerate(coded):
        count = np.bincount(c, minlength=parser.width)
        letters[k], lacks[k] = len(c) - count[SPACE], count @ parser.lacks
    cost = (parser.phrases(coded) + lacks) * parser.bits / np.maximum(letters, 1)[:, None]
    for n, c, gone in zip(letters.tolist(), cost, lacks):
        best = int(c.argmin())
        yield (parser.names[best], float(1.0 / np.exp(-SHARPNESS * (c - c[best])).sum()), 1.0 - float(gone[best]) / n) if n else ("und", 0.0, 0.0)


def predict(docs: DataFrame, model: tuple[tuple[str, str], ...], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns `keep`) with lang_pred, score and known (share of letters that the language knows); existing
    columns of those names are replaced."""
    docs = docs.drop("lang_pred", "score", "known")
    at = docs.columns.index(text)
    small_batches(docs.sparkSession)
    names_kept = docs.columns if keep is None else keep
    kept = [docs.columns.index(c) for c in names_kept]
    extra = ("lang_pred", "score", "known")
    schema = T.StructType([*(docs.schema[i] for i in kept), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("known", T.DoubleType())])
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = remembered(("langid", name), lambda: Parser(shared.value))
        for batch in batches:
            found = list(_found(batch.column(at).to_pylist(), parser))
            made = [pa.array([x[k] for x in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *made], [*names_kept, *extra])

    return docs.mapInArrow(run, schema)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), learn(docs), keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language can be told; the rest (no text or letter, or letters unknown to all) go."""
    columns = docs.columns
    renamed = docs.toDF(*[f"_{k}" for k in range(len(columns))])  # columns of any name pass
    found = predict(renamed, learn(docs), text=f"_{columns.index('text')}")
    return found.where((F.col("lang_pred") != "und") & (F.col("known") >= LEAST_KNOWN)).select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(columns)])
