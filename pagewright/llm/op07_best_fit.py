"""Variable-capacity best-fit packing (operator 7).

Sequences may have one of several lengths. Pieces, longest first, go to the open bin that they leave least room in. When none has
room, a bin is opened: for every permitted size that holds the piece, the pieces still to come are laid into it greedily, and the
size with the least cost for each token so placed is taken. At the end each bin shrinks to the least permitted size that holds its contents.

Pieces are dealt by a hash of their row, not of its id, into shards of some thousand pieces, each packed by itself, so that however
many rows have one id or none, shards are of like size; a shard wastes a few bins at most.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import written
from pagewright.llm.op08_mixing import n_words

CAPACITIES = (512, 1024, 2048, 4096)
#: Cost of a sequence besides its length: what starting one more costs, in tokens.
OVERHEAD = 16
#: Pieces in a shard, about.
SHARD_ROWS = 8192


def linear_cost(capacity: int) -> float:
    return capacity + OVERHEAD


class _Lengths:
    """How many pieces of each length are still to come; the longest of at most a given length."""

    def __init__(self, lengths: np.ndarray, top: int):
        self.count = np.bincount(lengths, minlength=top + 1).tolist()
        self.below = list(range(top + 1))
        for i in range(top + 1):
            if not self.count[i]:
                self.below[i] = self.below[i - 1] if i else 0

    def longest(self, most: int) -> int:
        i = most
        while i > 0 and not self.count[i]:
            i = self.below[i] if self.below[i] != i else i - 1
        j = most
        while j != i and j > 0:  # path compression: counts only fall
            nxt = self.below[j] if self.below[j] != j else j - 1
            self.below[j] = i
            j = nxt
        return i

    def fill(self, room: int) -> int:
        """Tokens that fit when the longest fitting piece is taken again and again."""
        used, most = 0, room
        while (n := self.longest(min(most, room))) > 0:
            k = min(room // n, self.count[n])
            used += k * n
            room -= k * n
            most = n - 1  # no more of n fits or is left
        return used


def pack(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = linear_cost) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset in it) of each piece, and each bin's final capacity. Every length is from 1 to the largest capacity."""
    sizes = sorted(capacities)
    lengths = np.asarray(lengths, dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    rest = _Lengths(lengths, sizes[-1])
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    open_: dict[int, list[int]] = {}
    used: list[int] = []
    bins, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for i in order.tolist():
        n = int(lengths[i])
        rest.count[n] -= 1
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[at]
        else:
            fits = [c for c in sizes if c >= n]
            room = min(fits, key=lambda c: (cost(c) / (n + rest.fill(c - n)), c)) if len(fits) > 1 else fits[0]
            b = len(used)
            used.append(0)
        bins[i], offset[i] = b, used[b]
        used[b] += n
        room -= n
        if room > 0:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append(b)
    final = np.array(sizes)[np.searchsorted(sizes, used)] if used else np.zeros(0, dtype=np.int64)
    return bins, offset, final


def best_fit(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, length: Column | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each piece: doc_id, piece (from 0), piece_start, n_tokens, bin_id, bin_offset, bin_used, bin_capacity.

    A document's length is its words and an end token, or `length`. A document longer than the largest capacity is cut into pieces of
    that capacity and one rest, so that nothing is dropped. Null and empty texts have the end token alone. Rows with equal or null
    ids are packed each by itself; where a `length` is below 1 or null nothing is placed. Empty table: no rows. Other columns are
    ignored. A bin's pieces do not overlap and lie within its capacity; bin_id is unique.
    """
    top = max(capacities)
    size = F.coalesce(length, F.lit(0)).cast("long") if length is not None else n_words(F.col(text_column).cast("string")) + 1
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), size.alias("size"), F.monotonically_increasing_id().alias("row")).filter("size > 0")
    rows = written(rows, "pack-rows")
    total = rows.agg(F.sum(F.ceil(F.col("size") / top))).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_ROWS))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / top))))
    pieces = pieces.select("doc_id", "row", "piece", (F.col("piece") * top).alias("piece_start"), F.least(F.lit(top), F.col("size") - F.col("piece") * top).cast("long").alias("n_tokens"))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "row", "piece"], ascending=[False, True, True], kind="stable")
        bins, offset, final = pack(pdf["n_tokens"].to_numpy(), capacities)
        used = np.bincount(bins, pdf["n_tokens"].to_numpy(), len(final)).astype(np.int64)
        out = pdf[["doc_id", "piece", "piece_start", "n_tokens"]].copy()
        out["bin_id"] = int(pdf["shard"].iloc[0]) * (1 << 32) + bins
        out["bin_offset"], out["bin_used"], out["bin_capacity"] = offset, used[bins], final[bins]
        return out

    return pieces.groupBy("shard").applyInPandas(run, "doc_id long, piece long, piece_start long, n_tokens long, bin_id long, bin_offset long, bin_used long, bin_capacity long")

