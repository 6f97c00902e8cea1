"""Toxicity of deobfuscated text (operator 3).

Channel: a writer may replace letters by look-alikes (leetspeak), put separators between letters, and repeat letters. A lattice holds,
for each odd piece of text, every way to read it; Viterbi finds the best path under a character trigram model of the corpus and fixed
costs of the channel. The restored words' prefixes and the words themselves are the features of a logistic regression.

The character model counts all documents, each by itself, so that scores don't depend on how rows are dealt. The regression uses
labelled rows, up to TRAIN_ROWS of them; every feature that these tie to the label (by the likelihood ratio, at SCREEN) is in it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import kernels as K
from pagewright.llm.common import in_slices, written

#: Labelled rows that the fit uses at most, and the least likelihood-ratio statistic of a feature (10.83: one in 1,000 by chance).
TRAIN_ROWS, SCREEN = 20_000, 10.83
THRESHOLD = 0.7
MEMO_WORDS = 300_000

# ---- character model ---------------------------------------------------------------------------------------------------------

#: Classes: 0 anything but a letter, 1-26 a-z, 27-58 the lower-case letters U+00E0-U+00FF.
CLASSES = 59
_ASCII = np.zeros(256, dtype=np.int64)
_ASCII[97:123] = np.arange(1, 27)
_ASCII[65:91] = np.arange(1, 27)
_LATIN = np.zeros(64, dtype=np.int64)
_LATIN[32:] = np.arange(27, 59)
_LATIN[:32] = np.arange(27, 59)
_LETTERS = {chr(97 + i): i + 1 for i in range(26)} | {chr(0xE0 + i): 27 + i for i in range(32)}


def trigram_counts(column: pa.Array) -> np.ndarray:
    """Counts of three classes in a row, runs of other characters counting as one boundary; CLASSES ** 3 values.

    Each text counts by itself, from two boundaries to one, whatever texts are next to it.
    """
    total = np.zeros(CLASSES**3, dtype=np.int64)
    for _, _, t in K.blocks(column):
        d = t.data
        c = _ASCII[d]
        after = np.flatnonzero(d[:-1] == 0xC3) + 1
        c[after] = _LATIN[d[after] & 63]
        first = np.zeros(len(d) + 1, dtype=bool)
        first[t.start[t.start < t.end]] = True
        first = np.flatnonzero(first)
        keep = np.insert(d != 0xC3, first, True)
        border = np.insert(np.zeros(len(d), dtype=bool), first, True)[keep]
        c = np.append(np.insert(c, first, 0)[keep], 0)
        border = np.append(border, False)
        # Of each run of boundaries one is left; it parts two texts if one in the run does.
        run = np.ones(len(c), dtype=bool)
        run[1:] = (c[1:] != 0) | (c[:-1] != 0)
        parts = np.logical_or.reduceat(border, np.flatnonzero(run)) if len(c) else border
        c, before = c[run], np.concatenate([[0], c[run][:-1]])
        before[parts] = 0
        total += np.bincount((before[:-1] * CLASSES + c[:-1]) * CLASSES + c[1:], minlength=CLASSES**3)
    return total


#: Share of characters that any class may be, so that a word which the corpus lacks costs no more than that.
UNSEEN = 0.005


class CharModel:
    """log P(class | two classes before), interpolated with the bigram, unigram and uniform models."""

    def __init__(self, counts: np.ndarray):
        n3 = counts.reshape(CLASSES, CLASSES, CLASSES).astype(np.float64)
        n2, n1 = n3.sum(0), n3.sum((0, 1))
        p1 = (n1 + 1) / (n1.sum() + CLASSES)
        p2 = (n2 + 20 * p1) / (n2.sum(1, keepdims=True) + 20)
        p3 = (n3 + 20 * p2) / (n3.sum(2, keepdims=True) + 20)
        self.log = np.log((1 - UNSEEN) * p3 + UNSEEN / CLASSES).tolist()


# ---- channel -----------------------------------------------------------------------------------------------------------------

#: Look-alikes of letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "|": "il", "(": "c", "€": "e", "£": "l", "¡": "i"}
#: Log costs of the channel.
SUBSTITUTE, KEEP, DROP, REPEAT, DOUBLE = -1.0, -6.0, -1.5, -0.3, -2.0
#: A kept sign is a character as well, which the model has no odds for: it costs what a letter costs about.
SIGN = -2.8
#: Between single letters: a space that is left out, and one that stays.
CLOSE, PART = -0.2, -6.0
#: Characters after which the best path so far is taken, to bound a path's memory.
CUT = 4096
_SPACERS = set(" .-_*~'`·,/\\")
_EDGE = re.compile(r"^[^\w@$!|(€£¡+]+|(?:[^\w]{2,}|[^\w@$!|(€£¡+])$")
_ODD = re.compile(r"[\W\d_]|(.)\1\1")
_SPELT = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")


def candidates(piece: str) -> bool:
    """Whether a lower-case piece has more than one path through the lattice: a letter, and an inner sign, digit or long repetition."""
    return len(piece) > 2 and _ODD.search(piece) is not None and sum(c.isalpha() for c in piece) >= 1 and not piece.isdigit()


def viterbi(piece: str, model: CharModel, spelt: bool = False) -> str:
    """The best reading of a piece, with a space for each boundary. spelt: the piece is single characters with a space between each."""
    log, said = model.log, []
    states: dict[tuple[int, int], tuple[float, tuple | None, str]] = {(0, 0): (0.0, None, "")}

    def step(new: dict, state: tuple[int, int], score: float, cell, ch: str, cost: float) -> None:
        a, b = state
        c = _LETTERS.get(ch, 0)
        if c == 0 and b == 0:
            to, value = (0, 0), score + cost
        else:
            to, value = (b, c), score + cost + log[a][b][c]
        if to not in new or value > new[to][0]:
            new[to] = (value, cell, ch)

    n = len(piece)
    for i, ch in enumerate(piece):
        new: dict = {}
        letter = ch in _LETTERS
        inner = 0 < i < n - 1
        repeated = i > 0 and piece[i - 1] == ch
        for state, cell in states.items():
            score = cell[0]
            if letter:
                step(new, state, score, cell, ch, 0.0)
                if repeated:  # this one is left out: the state stays
                    value = score + (REPEAT if i > 1 and piece[i - 2] == ch or i + 1 < n and piece[i + 1] == ch else DOUBLE)
                    if state not in new or value > new[state][0]:
                        new[state] = (value, cell, "")
                continue
            for to in LEET.get(ch, ""):
                step(new, state, score, cell, to, SUBSTITUTE)
            gap = spelt and ch == " "
            if inner and ch in _SPACERS or repeated and i > 1 and piece[i - 2] == ch:
                value = score + (CLOSE if gap else DROP)
                if state not in new or value > new[state][0]:
                    new[state] = (value, cell, "")
            step(new, state, score, cell, " " if not ch.isalpha() else ch, PART if gap else 0.0 if ch == " " else KEEP + SIGN)
        states = new
        if i % CUT == CUT - 1:
            state, cell = max(states.items(), key=lambda x: (x[1][0], x[0]))
            said.append(_path(cell))
            states = {state: (0.0, None, "")}
    end: dict = {}
    for state, cell in states.items():
        step(end, state, cell[0], cell, " ", 0.0)
    return "".join([*said, _path(max(end.values(), key=lambda x: x[0]))]).strip()


def _path(cell: tuple | None) -> str:
    out = []
    while cell is not None:
        out.append(cell[2])
        cell = cell[1]
    return "".join(reversed(out))


class Restorer:
    """Restored words of texts; what a piece gives is remembered, up to MEMO_WORDS pieces."""

    def __init__(self, model: CharModel):
        self.model = model
        self.memo: dict[str, tuple[str, ...]] = {}

    def piece(self, p: str) -> tuple[str, ...]:
        core = _EDGE.sub("", p.lower())
        if core.isalpha() and not _ODD.search(core):
            return (core,)
        read = viterbi(core, self.model) if candidates(core) else core
        return tuple(x for x in re.split(r"[\W\d_]+", read) if x)

    def words(self, text: str) -> set[str]:
        """The distinct restored words of a text, those spelt in single letters joined where the character model says so."""
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        out: set[str] = set()
        for p in set(text.split()):
            w = memo.get(p)
            if w is None:
                w = memo[p] = self.piece(p)
            out.update(w)
        for m in _SPELT.finditer(text):  # a wider gap parts words
            out.update(x for x in re.split(r"[\W\d_]+", viterbi(m[0].lower(), self.model, spelt=True)) if x)
        return out


# ---- features and regression -------------------------------------------------------------------------------------------------


def features_of(word: str) -> tuple[str, ...]:
    """The word, and its prefixes of 3 to 6 letters."""
    return (word + "$", *(word[:k] for k in range(3, min(6, len(word)) + 1)))


def document_features(words: set[str]) -> set[str]:
    return {f for w in words for f in features_of(w)}


class Regression:
    """Ridge logistic regression over binary features, fitted by Adagrad on the whole batch."""

    def __init__(self, names: list[str], rows: list[list[int]], y: np.ndarray, ridge: float = 0.3):
        self.names = names
        self.index = {f: i for i, f in enumerate(names)}
        n, m = len(rows), len(names)
        at = np.repeat(np.arange(n), [len(r) for r in rows])
        col = np.array([c for r in rows for c in r], dtype=np.int64)
        w, b = np.zeros(m), math.log((y.sum() + 0.5) / (n - y.sum() + 0.5)) if n else -2.0
        g2, gb2 = np.full(m, 1e-8), 1e-8
        for _ in range(600 if n else 0):
            p = 1 / (1 + np.exp(-(b + np.bincount(at, w[col], n))))
            g = np.bincount(col, (p - y)[at], m) + ridge * w
            gb = (p - y).sum()
            g2 += g * g
            gb2 += gb * gb
            w -= 0.5 * g / np.sqrt(g2)
            b -= 0.3 * gb / math.sqrt(gb2)
        self.weights, self.bias = w, b

    def score(self, found: set[int]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + sum(self.weights[i] for i in found)))))


def _hold(i) -> int:
    return crc32(b"" if i is None else str(i).encode()) % 3


def character_model(docs: DataFrame, text_column: str = "text") -> CharModel:
    """Counts of all documents, summed by the cluster; CLASSES ** 3 numbers come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, dtype=np.int64)
        for b in in_slices(batches):
            total += trigram_counts(b.column(0))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    rows = docs.select(F.col(text_column).cast("string").alias("text")).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(CLASSES**3, dtype=np.int64)
    for at, n in rows:
        counts[at] = n
    return CharModel(counts)


def train(docs: DataFrame, labels: DataFrame, model: CharModel, id_column: str = "doc_id", text_column: str = "text", seed: int = 42) -> Regression:
    """Regression on labelled rows whose crc32(id as text) mod 3 is not 1. Conflicting and null labels are left out.

    TRAIN_ROWS labelled ids at most, in hash order. The cluster counts every feature of these rows; those that toxic rows have more
    often than others, with a likelihood-ratio statistic of SCREEN or more, make the regression. Rows are put in order before it, so
    that sums don't depend on how they came.
    """
    spark = docs.sparkSession
    y = labels.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most AND doc_id IS NOT NULL").select("doc_id", "toxic")
    y = y.filter((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) != 1).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(TRAIN_ROWS)
    y = spark.createDataFrame(y.collect(), "doc_id long, toxic int")  # TRAIN_ROWS small rows at most
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).join(F.broadcast(y), "doc_id")

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for b in in_slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array([sorted(restore.words(x or "")) for x in b.column("text").to_pylist()], pa.list_(pa.string()))], names=["toxic", "words"])

    words = written(rows.mapInArrow(restored, "toxic int, words array<string>"), "toxicity-training")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for b in in_slices(batches):
            for toxic, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[toxic > 0].update(document_features(set(w)))
        names = list(seen[1])  # what no toxic row has can't be tied to the label
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][f] for f in names], pa.int64()), pa.array([0] * len(names), pa.int64())], names=["f", "t", "c"])
        names = list(seen[0])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([0] * len(names), pa.int64()), pa.array([seen[0][f] for f in names], pa.int64())], names=["f", "t", "c"])

    n_t, n_c = words.filter("toxic > 0").count(), words.filter("toxic <= 0").count()
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    log = lambda x, of: F.when(x > 0, x * F.log(x / of)).otherwise(F.lit(0.0))
    both = t + c
    ratio = 2 * (log(t, both * n_t / (n_t + n_c)) + log(c, both * n_c / (n_t + n_c)) + log(n_t - t, (n_t + n_c - both) * n_t / (n_t + n_c)) + log(n_c - c, (n_t + n_c - both) * n_c / (n_t + n_c)))
    names = []
    if n_t and n_c:
        counted = words.mapInArrow(count, "f string, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        names = [x[0] for x in counted.filter((t * n_c > c * n_t) & (ratio >= SCREEN)).select("f").orderBy("f").collect()]
    index = spark.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for b in in_slices(batches):
            found = [sorted(known[f] for f in document_features(set(w)) if f in known) for w in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "f"])

    got = sorted((x["f"], x["toxic"]) for x in words.mapInArrow(encode, "toxic int, f array<int>").collect())  # TRAIN_ROWS rows, some numbers each
    return Regression(names, [f for f, _ in got], np.array([y > 0 for _, y in got], dtype=np.float64))


class Scorer:
    """Scores of texts, with memos of bounded size."""

    def __init__(self, model: CharModel, regression: Regression):
        self.restore, self.regression, self.memo = Restorer(model), regression, {}

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, list[int]]:
        """Each text's score and its number of distinct restored words."""
        index, memo = self.regression.index, self.memo
        scores, sizes = [], []
        for text in texts:
            words = self.restore.words(text or "")
            if len(memo) > MEMO_WORDS:
                memo.clear()
            found: set[int] = set()
            for w in words:
                f = memo.get(w)
                if f is None:
                    f = memo[w] = tuple(index[x] for x in features_of(w) if x in index)
                if f:
                    found.update(f)
            scores.append(self.regression.score(found))
            sizes.append(len(words))
        return np.array(scores, dtype=np.float64), sizes


def fitted(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
    """The character model and the regression, broadcast; both have a bounded size."""
    model = character_model(docs, text_column)
    return docs.sparkSession.sparkContext.broadcast((model, train(docs, labels, model, id_column, text_column)))


def reject(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` without the rows that score THRESHOLD or more; its columns, and null texts, stay."""
    shared = fitted(docs, labels, id_column, text_column)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for b in in_slices(batches):
            s, _ = scorer.scores(b.column(at).to_pylist())
            yield b.filter(pa.array(s < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


_OUT = "doc_id long, held_out boolean, score double, predicted int, restored_words int"


def score(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted (score >= THRESHOLD) for every row of `docs`.

    Null and empty texts get the score of no evidence. Rows with equal or null ids are scored each by itself (a null id is not held
    out). Without labelled rows every score is the same low one. Empty table: no rows. Only the text is an input of the score.
    """
    shared = fitted(docs, labels, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for b in in_slices(batches):
            s, sizes = scorer.scores(b.column(1).to_pylist())
            held = [_hold(i) == 1 for i in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(held, pa.bool_()), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32)), pa.array(sizes, pa.int32())], names=["doc_id", "held_out", "score", "predicted", "restored_words"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, _OUT)
