"""Threshold-scaled sketches of documents (operator 2).

A sketch keeps every distinct shingle hash below a fixed fraction of the hash range. As the cut is the same for all documents,
sketches of any two sizes can be compared (containment, Jaccard), and the sketch of a union is the union of the sketches. A text
none of whose hashes is below the cut keeps its least hash alone; `merge` drops such a hash again once there is one below the cut.
"""

from __future__ import annotations

import hashlib
from base64 import b64decode, b64encode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm import kernels as K
from pagewright.llm.common import id_ranges, in_slices, range_of, shuffle_partitions

#: The fraction of the hash range that is kept: 1 / SCALE.
SCALE = 8
SHINGLE_WORDS = 5
#: Hash bytes kept; hashes are whole numbers below 2 ** (8 * HASH_BYTES).
HASH_BYTES = 6


def cut(scale: int) -> int:
    return (1 << (8 * HASH_BYTES)) // scale


def sketches(column: pa.Array, scale: int = SCALE, k: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted kept hashes of each text (null: empty), in order. Words are not lower-cased."""
    limit = np.uint64(cut(scale))
    for i, j, t in K.blocks(column):
        s, e, doc = K.words(t)
        h, doc = K.shingles(K.span_hashes(t.data, s, e), doc, j - i, k)
        h >>= np.uint64(64 - 8 * HASH_BYTES)
        b = K.bounds(doc, j - i)
        below = h < limit
        for x in range(j - i):
            mine = h[b[x] : b[x + 1]]
            kept = np.unique(mine[below[b[x] : b[x + 1]]])
            yield kept if kept.size or not mine.size else mine.min(keepdims=True)


def encode(sketch: np.ndarray) -> str:
    """A fingerprint: base64 of the hashes, each big-endian in HASH_BYTES bytes, ascending."""
    raw = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BYTES :]
    return b64encode(raw.tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(b64decode(fingerprint), dtype=np.uint8).reshape(-1, HASH_BYTES)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, 8 - HASH_BYTES :] = raw
    return wide.view(">u8").reshape(-1).astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    u = np.union1d(a, b)
    kept = u[u < np.uint64(cut(scale))]
    return kept if kept.size else u[:1]


def compare(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """Estimates of Jaccard similarity, of the share of a that b contains, and of the share of b that a contains.

    Two texts without words are alike (1); a text without words is unlike any other (0).
    """
    if not a.size or not b.size:
        same = float(a.size == b.size)
        return same, same, same
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (a.size + b.size - both), both / a.size, both / b.size


def edited(text: str, following: str) -> str:
    """text with its last half (rounded down, in code points) replaced by as many first code points of the next text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, contained_edited double, contained_next double"


def fingerprints(docs: DataFrame, scale: int = SCALE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each document's sketch, its edited text's sketch and the likeness to that and to the next document.

    Next: in ascending order of id, then text; null ids come first; after the last document comes the first (for a single document:
    itself). Null text is the empty text. Rows with equal ids, or wholly equal, stay separate rows. Empty table: no rows. Other
    columns are ignored. `near_*` are Jaccard estimates, `contained_*` the share of the smaller sketch that the other has.

    Documents are dealt by id range, each range sorted and read as a stream; a range's last document needs the first one of the range
    after it, which is sent along as one more row for each range.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    cuts = id_ranges(docs, id_column, 2 * shuffle_partitions(docs.sparkSession))
    rows = rows.withColumn("range", range_of(F.col("id"), cuts))
    # One row for each range: the first document's id, and the range before it that has rows (the last one for the first).
    firsts = rows.groupBy("range").agg(F.min(F.struct(F.col("id").isNotNull().alias("set"), "id"))["id"].alias("first"))
    order = Window.partitionBy(F.lit(0)).orderBy("range")
    last = F.max("range").over(Window.partitionBy(F.lit(0)))
    ahead = firsts.select("first", F.col("range").alias("of"), F.coalesce(F.lag("range").over(order), last).alias("to"))
    ahead = F.broadcast(ahead)  # as many rows as there are ranges
    again = rows.join(ahead, (F.col("range") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")))
    again = again.groupBy("to").agg(F.min("text").alias("text")).select(F.lit(None).cast("long").alias("id"), "text", F.col("to").alias("range"), F.lit(True).alias("ahead"))
    dealt = rows.withColumn("ahead", F.lit(False)).unionByName(again).repartitionByRange(2 * shuffle_partitions(docs.sparkSession), "range")
    dealt = dealt.sortWithinPartitions(F.col("range"), F.col("ahead"), F.col("id").asc_nulls_first(), "text")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # the document that waits for its next one

        def out(rows: list) -> pa.RecordBatch:
            """rows: (id, text, sketch, next text, next sketch)."""
            changed = [edited(r[1], r[3]) for r in rows]
            result = []
            for (i, text, mine, _, after), new, other in zip(rows, changed, sketches(pa.array(changed, pa.string()), scale), strict=True):
                (near_e, ae, ea), (near_n, an, na) = compare(mine, other), compare(mine, after)
                result.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), encode(mine), encode(other), near_e, near_n, max(ae, ea), max(an, na)))
            names = [x.split()[0] for x in _OUT.split(", ")]
            types = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[x.split()[1]] for x in _OUT.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*result, strict=True), types, strict=True)], names=names)

        for b in in_slices(batches, 512):
            ready = []
            for i, text, extra, mine in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), sketches(b.column(1), scale), strict=True):
                if held:
                    ready.append((*held.pop(), text, mine))
                if not extra:
                    held.append((i, text, mine))
            if ready:
                yield out(ready)

    return dealt.mapInArrow(sketch, _OUT)
