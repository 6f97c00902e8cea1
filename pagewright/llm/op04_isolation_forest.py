"""Quality rules as an isolation forest over rule statistics (operator 4).

Every document gets statistics of its words, symbols, lines and repeats. Trees of random splits, each grown on a few
documents, isolate odd documents by short paths; the score is 2 ** (-mean path / expected path). The threshold comes from all labelled
rows, counted by bins of their scores. Documents that fail a base rule are dropped whatever their score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.llm import kernels as K
from pagewright.llm.common import in_slices

#: Labelled rows that a task scores at once.
LABELLED_ROWS = 20_000
#: Bins of scores in which labelled rows are counted; the threshold lies on an edge or in the middle of one.
BINS = 1 << 16
#: Small trees: odd documents come in kinds, and more rows a tree would hold many of a kind and hide them.
TREES, TREE_ROWS = 200, 32
#: Share of labelled good rows that must be kept.
KEEP_GOOD = 0.99
WINDOW_WORDS = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_upper", "n_marks")


def _sums(flags: np.ndarray, t: K.Texts) -> np.ndarray:
    c = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=c[1:])
    return c[t.end] - c[t.start]


def _repeated(h: np.ndarray, doc: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Words in windows of k words that are found twice or more in the same text, for each text."""
    run = K.run_hashes(h, k)
    n = len(b) - 1
    if not len(run):
        return np.zeros(n, dtype=np.int64)
    inside = doc[: len(run)] == doc[k - 1 :]
    at = np.flatnonzero(inside)
    key = K.mix(run[at] ^ (doc[at].astype(K.U64) * K.U64(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + k, -1)
    c = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
    return c[b[1:]] - c[b[:-1]]


def _repeated_lines(t: K.Texts, s: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each text: lines with a word that equal an earlier line."""
    n = len(t)
    new = np.flatnonzero(t.data == 0x0A)
    begin = np.concatenate([t.start, new + 1])
    begin = np.unique(begin[begin < len(t.data)])
    if not len(begin):
        return np.zeros(n, dtype=np.int64)
    of = np.searchsorted(t.start, begin, "right") - 1
    end = np.minimum(np.concatenate([begin[1:], [len(t.data)]]), t.end[of])
    end = np.where((end > begin) & (t.data[np.maximum(end - 1, 0)] == 0x0A), end - 1, end)
    end = np.maximum(end, begin)
    some = np.searchsorted(s, end) > np.searchsorted(s, begin)
    begin, end, of = begin[some], end[some], of[some]
    key = K.mix(K.span_hashes(t.data, begin, end) ^ (of.astype(K.U64) * K.U64(0x9E3779B97F4A7C15)))
    _, first = np.unique(key, return_index=True)
    later = np.ones(len(key), dtype=bool)
    later[first] = False
    return np.bincount(of[later], minlength=n)


def statistics(column: pa.Array) -> np.ndarray:
    """BASE then EXTRA statistics of each text (null: none), whole numbers."""
    out = []
    for i, j, t in K.blocks(column):
        n = j - i
        s, e, doc = K.words(t)
        h = K.span_hashes(t.data, s, e)
        b = K.bounds(doc, n)
        chars = np.concatenate([[0], np.cumsum(K.char_counts(t, s, e))])
        later = _repeated_lines(t, s, doc)
        d = t.data
        letters = ((d | 32) >= 97) & ((d | 32) <= 122) | (d >= 128)
        digits = (d >= 48) & (d <= 57)
        marks = ~(letters | digits | K.SEPARATOR[d])
        out.append(
            np.stack(
                [b[1:] - b[:-1], chars[b[1:]] - chars[b[:-1]], _sums(_SYMBOL[d], t), later, _repeated(h, doc, b, WINDOW_WORDS), _sums((d >= 65) & (d <= 90), t), _sums(marks, t)],
                axis=1,
            )
        )
    return np.concatenate(out).astype(np.int64) if out else np.zeros((0, len(BASE) + len(EXTRA)), dtype=np.int64)


def features(s: np.ndarray) -> np.ndarray:
    """What the trees split on: symbols, capitals and marks (logarithms), characters a word, and the share of repeated words."""
    words, chars, symbols, _, repeat, upper, marks = s.T.astype(np.float64)
    w, c = np.maximum(words, 1), np.maximum(chars, 1)
    return np.stack([np.log1p(100 * symbols / w), np.log1p(30 * upper / c), np.log1p(marks / w), chars / w, repeat / w], axis=1)


def base_failed(s: np.ndarray) -> np.ndarray:
    return (s[:, 0] < MIN_WORDS) | (100 * s[:, 4] > MAX_REPEAT_PERCENT * s[:, 0])


class Forest:
    """Isolation trees as arrays: feature and cut of each node, its children, and the path length at leaves."""

    def __init__(self, x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.rows = min(rows, max(len(x), 1))
        self.depth = max(1, int(np.ceil(np.log2(max(self.rows, 2)))))
        if len(x) >= trees * self.rows:  # enough for rows of its own for each tree
            dealt = rng.permutation(len(x))[: trees * self.rows].reshape(trees, self.rows)
        else:
            dealt = [rng.choice(len(x), self.rows, replace=False) if len(x) else np.zeros(0, dtype=np.int64) for _ in range(trees)]
        self.trees = [self._grow(x[rows], rng) for rows in dealt]

    @staticmethod
    def expected(n: np.ndarray | float) -> np.ndarray:
        """Mean path length of an unsuccessful search in a random tree of n rows."""
        n = np.asarray(n, dtype=np.float64)
        m = np.maximum(n, 2)
        return np.where(n > 2, 2 * (np.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))

    def _grow(self, x: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        nodes: list[list] = []

        def node(rows: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([0, 0.0, at, at, depth + float(self.expected(len(rows)))])
            spread = np.ptp(rows, axis=0) if len(rows) > 1 else np.zeros(1)
            can = np.flatnonzero(spread > 0)
            if depth < self.depth and can.size:
                f = int(rng.choice(can))
                lo, hi = rows[:, f].min(), rows[:, f].max()
                c = float(rng.uniform(lo, hi))
                left = rows[:, f] < c
                nodes[at][:2] = [f, c]
                nodes[at][2] = node(rows[left], depth + 1)
                nodes[at][3] = node(rows[~left], depth + 1)
            return at

        node(x, 0)
        f, c, left, right, path = zip(*nodes, strict=True)
        return np.array(f), np.array(c), np.array(left), np.array(right), np.array(path)

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, higher: odder."""
        total = np.zeros(len(x))
        all_rows = np.arange(len(x))
        for f, c, left, right, path in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = np.where(x[all_rows, f[at]] < c[at], left[at], right[at])
            total += path[at]
        return 2.0 ** (-total / max(len(self.trees), 1) / max(float(self.expected(self.rows)), 1e-9))


def bins_of(score: np.ndarray) -> np.ndarray:
    """The bin of each score: a score is in bin b or lower if it is b / BINS or less."""
    return np.ceil(score * BINS).astype(np.int64)


def calibrate(bins: np.ndarray, good: np.ndarray, bad: np.ndarray, keep_good: float = KEEP_GOOD) -> float:
    """The threshold at or below which documents are kept, from the good and bad rows of each bin: of those that keep `keep_good` of the
    good rows, the one with the best balanced accuracy. Without labelled rows of both kinds nothing is dropped."""
    if not good.sum() or not bad.sum():
        return 1.0
    order = np.argsort(bins)
    cuts = bins[order]
    kept = np.cumsum(good[order]) / good.sum()
    dropped = 1 - np.cumsum(bad[order]) / bad.sum()
    best = int(np.where(kept >= keep_good, kept + dropped, -1).argmax())
    # In the middle of the scores that no labelled row has.
    return float(cuts[best] + (cuts[best + 1] - 1 if best + 1 < len(cuts) else cuts[best])) / (2 * BINS)


def _table(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    names = [*BASE, *EXTRA]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(x, T.LongType()) for x in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c) for c in statistics(b.column(1)).T]], names=["doc_id", *names])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)


def fit(table: DataFrame, labels: DataFrame, seed: int = 42) -> tuple[Forest, float]:
    """The forest and its threshold. `labels` has doc_id and quality (1: good); conflicting or null labels are left out."""
    names = [*BASE, *EXTRA]
    order = F.xxhash64(F.lit(seed), "doc_id", *names), "doc_id", *names
    usable = (F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = np.array([list(r) for r in table.filter(usable).orderBy(*order).limit(TREES * TREE_ROWS).select(*names).collect()], dtype=np.int64).reshape(-1, len(names))
    forest = Forest(features(rows), seed=seed)
    clean = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("most")).filter("q = most").select("doc_id", "q")
    shared = table.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, LABELLED_ROWS):
            s = np.stack([b.column(x).to_numpy(zero_copy_only=False) for x in names], axis=1)
            yield pa.RecordBatch.from_arrays([b.column("q"), pa.array(bins_of(shared.value.score(features(s))))], names=["q", "bin"])

    scored = table.filter(usable).join(clean, "doc_id").select(F.col("q").cast("long").alias("q"), *names).mapInArrow(run, "q long, bin long")
    is_good = (F.col("q") == 1).cast("long")
    got = scored.groupBy("bin").agg(F.sum(is_good).alias("good"), F.sum(1 - is_good).alias("bad")).collect()  # BINS rows at most
    bins, good, bad = np.array([list(r) for r in got], dtype=np.int64).reshape(-1, 3).T
    return forest, calibrate(bins, good, bad)


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, the BASE statistics, base_failed, kept and the anomaly score, a row for each row of `docs`.

    Null or empty text: all statistics 0, so base_failed. Rows with equal or null ids are judged each by itself. Empty tables: no
    rows; without usable labels only the base rules drop. Other columns are ignored.
    """
    from pagewright.llm.common import written

    table = written(_table(docs, id_column, text_column), "rule-statistics")
    forest, threshold = fit(table, labels)
    shared = docs.sparkSession.sparkContext.broadcast((forest, threshold))
    names = [*BASE, *EXTRA]
    schema = T.StructType.fromDDL(", ".join(["doc_id long", *[f"{x} long" for x in BASE], "base_failed boolean", "kept boolean", "anomaly double"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, threshold = shared.value
        for b in batches:
            s = np.stack([b.column(x).to_numpy(zero_copy_only=False) for x in names], axis=1)
            failed = base_failed(s)
            score = forest.score(features(s))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[b.column(x) for x in BASE], pa.array(failed), pa.array(~failed & (score <= threshold)), pa.array(score)], names=schema.names)

    return table.mapInArrow(run, schema)
