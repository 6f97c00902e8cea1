"""Line-level deduplication by winnowing (operator 5).

A text is the sequence of its lines that have a word. A window is a shortest run of lines with RUN_WORDS words or more, taken forward
from each line and backward from each line.

1. Select. Of each window the line with the least hash (the last of equal ones) is a fingerprint. Two equal runs of RUN_WORDS words or
   more have a window in common, and so a fingerprint at the same place of both: that is guaranteed, not likely.
2. Join positions. Only fingerprints that occur in two places are kept; the rest of the text goes no further.
3. Extend. A kept fingerprint is extended both ways to the windows whose minimum it is; each is compared with the first place of an
   equal window. Matched windows that meet or overlap are one run. A run's line is in a window with its neighbour, so that runs are
   maximal, whatever earlier places their parts have.
4. Delete every line of a run that occurs at an earlier place.

Fingerprints and windows are counted with partial aggregates and joined with tables of one row each, so that a line that a third of
all documents have is never one task's: the join's other side can be split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.llm import kernels as K
from pagewright.llm.common import in_slices, own_name, passing, written

#: Words that a repeated run has at least: well below a passage of 50 words without its two broken end lines.
RUN_WORDS = 8


def lines(t: K.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, text number, words) of each line that has a word."""
    new = np.flatnonzero(t.data == 0x0A)
    begin = np.unique(np.concatenate([t.start, new + 1]))
    begin = begin[begin < len(t.data)]
    of = np.searchsorted(t.start, begin, "right") - 1
    end = np.minimum(np.append(begin[1:], len(t.data)), t.end[of])
    end -= (end > begin) & (t.data[np.maximum(end - 1, 0)] == 0x0A)
    s, _, _ = K.words(t)
    n = np.searchsorted(s, end) - np.searchsorted(s, begin)
    some = n > 0
    return begin[some], end[some], of[some], n[some]


def windows(h: np.ndarray, n: np.ndarray, of: np.ndarray, least: int = RUN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first line, last line, minimum's line, key) of each distinct window, in order of the minimum. h, n, of: hash, words and text of
    each line; lines are counted over all texts. The key is a hash of the window's lines."""
    size = len(h)
    if not size:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z
    at = np.arange(size)
    c = np.concatenate([[0], np.cumsum(n)])
    begin, end = np.searchsorted(of, of, "left"), np.searchsorted(of, of, "right")
    stop = np.searchsorted(c, c[:-1] + least) - 1  # the window from line i ends with line stop[i]
    back = np.searchsorted(c, c[1:] - least, "right") - 1  # the window that ends with line i begins with line back[i]
    fore, rear = stop < end, back >= begin
    pair = np.unique(np.concatenate([at[fore] * size + stop[fore], back[rear] * size + at[rear]]))
    first, last = pair // size, pair % size
    least_at = first.copy()
    for step in range(1, int((last - first).max(initial=0)) + 1):  # a window has `least` lines at most, as each has a word
        x = np.minimum(first + step, last)
        least_at = np.where(h[x] <= h[least_at], x, least_at)
    power, inverse = K._power(size + 1)
    total = np.zeros(size + 1, dtype=K.U64)
    np.cumsum(K.mix(h) * power[:size], out=total[1:])
    key = K.mix((total[last + 1] - total[first]) * inverse[first] + (last - first + 1).astype(K.U64) * K.U64(0x9E3779B97F4A7C15)).view(np.int64)
    order = np.argsort(least_at, kind="stable")
    return first[order], last[order], least_at[order], key[order]


def _fingerprints(rows: DataFrame, least: int) -> DataFrame:
    """(fingerprint, id, row, windows) for each selected line: the windows whose minimum it is, by line numbers within the text.
    rows: row, id, text."""
    window = pa.struct([("key", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches):
            column, rows_, ids = b.column(2), b.column(0), b.column(1)
            for i, j, t in K.blocks(column):
                begin, end, of, n = lines(t)
                h = K.span_hashes(t.data, begin, end)
                first, last, at, key = windows(h, n, of, least)
                if not len(first):
                    continue
                cut = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1, [len(at)]]).astype(np.int32)
                chosen = at[cut[:-1]]
                base = np.searchsorted(of, of[first], "left")
                values = pa.StructArray.from_arrays([pa.array(key), pa.array((first - base).astype(np.int32)), pa.array((last - base).astype(np.int32))], fields=list(window))
                where = pa.array(i + of[chosen])
                yield pa.RecordBatch.from_arrays([pa.array(h[chosen].view(np.int64)), ids.take(where), rows_.take(where), pa.ListArray.from_arrays(pa.array(cut), values)], names=["fingerprint", "id", "row", "windows"])

    return rows.mapInArrow(run, "fingerprint long, id long, row long, windows array<struct<key:long,first:int,last:int>>")


def _spans(rows: DataFrame, least: int) -> DataFrame:
    """(row, spans): the windows of each row, by line numbers, that also occur at an earlier place."""
    chosen = written(_fingerprints(rows, least), "lines-fingerprints")
    twice = written(chosen.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").select("fingerprint"), "lines-repeated")
    extended = chosen.join(twice, "fingerprint", "left_semi").select("id", "row", F.explode("windows").alias("w")).select("w.key", F.struct(F.col("id").isNotNull().alias("set"), "id", "row", F.col("w.first").alias("first")).alias("place"), F.col("w.last").alias("last"))
    extended = written(extended, "lines-windows")
    earliest = written(extended.groupBy("key").agg(F.min("place").alias("earliest"), F.count("*").alias("n")).filter("n > 1").select("key", "earliest"), "lines-earliest")
    later = extended.join(earliest, "key").filter((F.col("earliest.row") != F.col("place.row")) | (F.col("earliest.first") != F.col("place.first")))
    return later.groupBy(F.col("place.row").alias("row")).agg(F.collect_list(F.struct(F.col("place.first").alias("first"), "last")).alias("spans"))


def _cut(text: str, spans: list[tuple[int, int]]) -> tuple[str, int, int, int]:
    """The text without the lines of the spans (line numbers among lines with a word), its lines, the lines and the runs removed."""
    parts = text.split("\n")
    worded = [i for i, x in enumerate(parts) if x.strip(" \t\n\x0b\x0c\r")]
    gone: set[int] = set()
    runs, reach = 0, -2
    for first, last in sorted(spans):
        if first > reach + 1:
            runs += 1
        reach = max(reach, last)
        gone.update(worded[first : last + 1])
    return "\n".join(x for i, x in enumerate(parts) if i not in gone), len(worded), len(gone), runs


def deduplicate(docs: DataFrame, least: int = RUN_WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with its columns, repeated runs deleted from the text, and __n_lines, __n_removed, __n_runs (with one more underscore where
    `docs` has such a column).

    A line is deleted when it is in a run of lines with `least` words or more that also begins at an earlier place: in a document
    with a smaller id (nulls first; of rows with equal ids the one read first), or higher up in the same document; the two places may
    overlap. Lines are equal when their bytes are. Lines without a word never count, and stay. Null and empty texts stay as they are,
    as do texts of fewer words. Empty table: no rows. Other columns are kept untouched.
    """
    row, spans = own_name(docs, "__row"), own_name(docs, "__spans")
    mine = written(docs.withColumn(row, F.monotonically_increasing_id()), "lines-input")
    with passing(docs.sparkSession) as keep:
        found = keep(_spans(mine.select(row, F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")), least), "lines-spans")
    # Spans grow with the documents: they are never broadcast, however few there are.
    joined = mine.join(found.toDF(row, spans).hint("merge"), row, "left").drop(row)
    names = docs.columns
    at = names.index(text_column)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(own_name(docs, x), T.LongType()) for x in ("__n_lines", "__n_removed", "__n_runs")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 1024):
            columns = [b.column(i) for i in range(len(names))]
            done = [(None, 0, 0, 0) if x is None else _cut(x, [(s["first"], s["last"]) for s in spans or ()]) for x, spans in zip(columns[at].to_pylist(), b.column(len(names)).to_pylist(), strict=True)]
            columns[at] = pa.array([d[0] for d in done], type=columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array([d[k] for d in done], pa.int64()) for k in (1, 2, 3)]], names=schema.names)

    return joined.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs and the sha256 of what is left of each text (null: of the empty text), and that text."""
    d = deduplicate(docs.select("doc_id", "text"))
    return d.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), F.col("__n_runs").alias("n_runs"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), F.col("text").alias("kept_text"))


def brute_force(texts: list[str | None], least: int = RUN_WORDS) -> list[str | None]:
    """The definition itself, for tests: every run of lines against every earlier place."""
    split = [[(k, x) for k, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\x0b\x0c\r")] for t in texts]
    seen: set[bytes] = set()
    out: list[str | None] = []
    for t, rows in zip(texts, split, strict=True):
        gone: set[int] = set()
        for i in range(len(rows)):
            starts = []
            for j in range(i, len(rows)):
                run = [x for _, x in rows[i : j + 1]]
                if sum(len(x.split()) for x in run) >= least:
                    name = hashlib.sha256("\n".join(run).encode()).digest()
                    if name in seen:
                        gone.update(k for k, _ in rows[i : j + 1])
                    starts.append(name)
            seen.update(starts)
        out.append(None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))
    return out
