"""Exact n-gram Jaccard join by a token-group matrix (operator 9).

Documents are sets of distinct word shingles (64-bit hashes). Equal sets are one class. The join links two classes when
100 * intersection >= 75 * union, and the result is the connected components. It is exact:

1. Prefixes. In any fixed order of all shingles, two linked sets of sizes n and m have a common shingle among their first
   n - ceil(0.75 n) + 1 and m - ceil(0.75 m) + 1 ones. The order puts frequent shingles last, by a counting sketch of all documents (of
   fixed size), so that common passages stay out of prefixes; any sketch gives the same result.
2. Groups. In rounds, each document is compared with two centres at most among those that have its prefix shingles; copies of one
   document fall into one component. A group is such a component with the single documents that meet it (or, without one, each
   other's centre), cut by size. The token-group matrix holds the prefix shingles of a group's members: each group's token union.
3. Bound. A document q is joined with the matrix. A shingle that it has in common with a member is in both prefixes, or lies after
   the end of the prefix that ends first; so the shingles that q shares with a group's union, and the longer rest of q's and the
   members' sets after their prefixes, bound its overlap with any member. Groups that can't reach the needed overlap stay closed.
4. An opened group's members of other components are held against q by a closer bound, with both prefixes and their ends at hand,
   and those that it lets through are compared exactly.

No step writes all pairs of a group: pairs are made with a centre, or pass the bound of both prefixes. A document is asked about
members of larger components only, and a component once linked is never compared within itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm import kernels as K
from pagewright.llm.common import batches_of, in_slices, own_name, passing, written

SHINGLE_WORDS = 5
#: Similarity as a whole percentage.
PERCENT = 75
#: The frequency sketch has a counter for so many bytes of text, within bounds given as powers of two; a shingle is frequent from
#: FREQUENT documents on, or from twice the mean counter.
SKETCH_BYTES, SKETCH_LEAST, SKETCH_MOST = 64, 16, 26
SKETCH_CHUNKS = 64
FREQUENT = 16
#: Keys that may be broadcast to skip documents that no comparison needs; with more of them a join alone does it.
BROADCAST_KEYS = 1_000_000
#: Level from which a shingle's rows are dealt to 4 tasks, and 4 times as many with each level more.
SALTED = 11
#: Steps of size between groups of one component.
BAND = 1.03
#: Hash ranges of a set's sketch, and the share of them in which two sketches agree if their sets are to be compared in a round.
SKETCH_BINS, SKETCH_SHARE = 64, 0.5
#: Rows that Python gets at once: sets of long documents have some MB.
BATCH_ROWS = 512
#: Links that the driver merges to components (some 60 MB); of more, rounds on the executors leave so many.
DRIVER_LINKS = 500_000
#: Pairs of a document that are compared before the others of it are looked at again.
FIRST = 8
#: Most rounds of comparison with centres; they end when a round finds no link.
STAR_ROUNDS = 2


def prefix_length(n):
    """How many first shingles of a set of n are its prefix."""
    return n - (PERCENT * n + 99) // 100 + 1


def linked(both, n, m):
    """Whether an intersection of this size links sets of n and m; for numbers and columns."""
    return (100 + PERCENT) * both >= PERCENT * (n + m)


def block_sets(column: pa.Array, k: int = SHINGLE_WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes, ends) for runs of rows: each text's sorted distinct shingle hashes, A-Z as a-z, and where they end."""
    for i, j, t in K.blocks(column):
        s, e, doc = K.words(t)
        h, doc = K.shingles(K.span_hashes(t.data, s, e, lower=True), doc, j - i, k)
        yield i, j, *K.distinct_per_text(h, doc, j - i)


def keys_of(v: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A signed 64-bit name of each set; 0 for the empty one."""
    size = np.diff(ends)
    with np.errstate(over="ignore"):
        one = _sums(K.mix(v), ends)
        two = _sums(K.mix(v * np.uint64(0x9E3779B97F4A7C15) + np.repeat(size, size).astype(K.U64)), ends)
        key = K.mix(one ^ two * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)
    key[size == 0] = 0
    return key


def _sums(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
    c = np.concatenate([np.zeros(1, dtype=K.U64), np.cumsum(x)])
    return c[ends[1:]] - c[ends[:-1]]


def _texts(docs: DataFrame, text_column: str) -> DataFrame:
    return docs.select(F.col(text_column).cast("string").alias("text"))


def _classes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, n, key, sketch) for each row, and (chunk, counts) rows of each task's frequencies, whose counters stop at 255."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_column).cast("string")))).first()[0] or 0
    bits = min(max(math.ceil(math.log2(max(total, 1) / SKETCH_BYTES + 1)), SKETCH_LEAST), SKETCH_MOST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << bits, dtype=np.uint8)
        for b in in_slices(batches):
            n, key, sketch, at = [], [], [], []
            for _, _, v, ends in block_sets(b.column(1)):
                n.append(np.diff(ends))
                key.append(keys_of(v, ends))
                sketch.append(sketches_of(v, ends))
                at.append((v >> np.uint64(64 - bits)).astype(np.uint32))
            if not n:
                continue
            where, more = np.unique(np.concatenate(at), return_counts=True)
            count[where] = np.minimum(count[where].astype(np.int64) + more, 255)
            yield _rows(b.column(0), pa.array(np.concatenate(n)), pa.array(np.concatenate(key)), pa.concat_arrays(sketch), None, None)
        if count.any():
            pack = zstandard.ZstdCompressor(level=1).compress
            yield _rows(None, None, None, None, pa.array(range(SKETCH_CHUNKS), pa.int32()), pa.array([pack(x.tobytes()) for x in np.split(count, SKETCH_CHUNKS)], pa.binary()))

    def _rows(*columns) -> pa.RecordBatch:
        m = next(len(c) for c in columns if c is not None)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.nulls(m, k) if c is None else c for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n", "key", "sketch", "chunk", "counts"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, "doc_id long, n long, key long, sketch array<int>, chunk int, counts binary")


class Levels:
    """The level of each sketch counter, four bits each: 0 for most, then one more for each doubling of the count."""

    def __init__(self, bits: int, packed: np.ndarray):
        self.bits, self.packed = bits, packed

    def of(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.packed[at >> 1] >> ((at & 1) << 2).astype(np.uint8)) & 15


def _levels(table: DataFrame) -> Levels:
    """The sketches of all tasks added up, chunk by chunk; half a byte a counter comes to the driver, 2 ** SKETCH_MOST of them at most."""

    def add(t: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        total = None
        for x in t.column("counts"):
            c = np.frombuffer(unpack(x.as_py()), dtype=np.uint8).astype(np.int32)
            total = c if total is None else total + c
        floor = max(float(FREQUENT), 2.0 * float(total.mean()))
        level = np.zeros(len(total), dtype=np.uint8)
        at = np.flatnonzero(total >= floor)
        level[at] = np.minimum(1 + np.floor(np.log2(total[at] / floor)), 15)
        return pa.table({"chunk": t.column("chunk")[:1], "levels": pa.array([zstandard.ZstdCompressor(level=1).compress((level[::2] | level[1::2] << 4).tobytes())], pa.binary())})

    got = table.filter("chunk IS NOT NULL").select("chunk", "counts").groupBy("chunk").applyInArrow(add, "chunk int, levels binary").orderBy("chunk").toArrow()
    if not len(got):
        return Levels(SKETCH_LEAST, np.zeros(1 << SKETCH_LEAST - 1, dtype=np.uint8))
    packed = np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(x.as_py()), dtype=np.uint8) for x in got.column("levels")])
    return Levels(len(packed).bit_length(), packed)


def prefixes(v: np.ndarray, ends: np.ndarray, levels: Levels) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each set's prefix in the order of all shingles (by level, and by hash within a level): hashes, levels, and where they end."""
    size = np.diff(ends)
    doc = np.repeat(np.arange(len(size)), size)
    lev = levels.of(v)
    if lev.any():
        order = np.argsort(doc * 16 + lev, kind="stable")
        v, lev = v[order], lev[order]
    keep = np.arange(len(v)) - ends[:-1][doc] < prefix_length(size)[doc]
    cut = np.zeros(len(ends), dtype=np.int64)
    np.cumsum(np.where(size > 0, prefix_length(size), 0), out=cut[1:])
    return v[keep], lev[keep], cut


def places(v: np.ndarray, lev: np.ndarray) -> np.ndarray:
    """Shingles as numbers: places in the order of all shingles."""
    return (lev.astype(np.int64) << 56) + (v >> np.uint64(8)).astype(np.int64)


def _before(places: Column, end: Column) -> Column:
    """How many shingles of a prefix lie before `end`, or at it."""
    return F.size(F.filter(places, lambda x: x <= end))


def _prefixes(docs: DataFrame, levels, text_column: str) -> DataFrame:
    """(token, salt, key, n): each set's prefix shingles; copies within a task once. Rows of very frequent shingles are dealt to several salts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = levels.value, set()
        for b in in_slices(batches):
            for i, j, v, ends in block_sets(b.column(0)):
                key, size = keys_of(v, ends), np.diff(ends)
                fresh = np.array([n > 0 and k not in seen and not seen.add(k) for k, n in zip(key.tolist(), size.tolist(), strict=True)], dtype=bool)
                token, lev, cut = prefixes(v, ends, level)
                count = np.diff(cut)
                keep, doc = np.repeat(fresh, count), np.repeat(np.arange(j - i), count)
                token, lev, doc = token[keep], lev[keep], doc[keep]
                salts = np.int64(1) << 2 * np.maximum(lev.astype(np.int64) - SALTED + 1, 0)
                salt = np.where(salts > 1, 1 + (key[doc] & salts - 1), 0).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(salt), pa.array(key[doc]), pa.array(size[doc].astype(np.int32))], names=["token", "salt", "key", "n"])

    return _texts(docs, text_column).mapInArrow(run, "token long, salt int, key long, n int")


def sketches_of(v: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """The least shingle of each of SKETCH_BINS equal hash ranges that has one, for each set: range and 24 bits. Like sets have like
    sketches."""
    bin_ = (v >> np.uint64(64 - int(math.log2(SKETCH_BINS)))).astype(np.int64)
    first = np.ones(len(v), dtype=bool)
    first[1:] = bin_[1:] != bin_[:-1]
    first[ends[:-1][ends[:-1] < len(v)]] = True
    at = np.flatnonzero(first)
    return K.list_array((bin_[at] << 24 | (v[at] & np.uint64(0xFFFFFF)).astype(np.int64)).astype(np.int32), np.searchsorted(at, ends))


def _sets_of(docs: DataFrame, keys: DataFrame, levels, text_column: str) -> DataFrame:
    """(key, hashes as bytes, places of the prefix) of the sets whose key is in `keys` (key), stored. If the keys are few they are broadcast to leave out other documents early."""
    spark = docs.sparkSession
    few = None
    if keys.count() <= BROADCAST_KEYS:
        few = spark.sparkContext.broadcast(np.sort(keys.select("key").toArrow().column(0).to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        wanted = few.value if few is not None else None
        for b in in_slices(batches, 512):
            for _, _, v, ends in block_sets(b.column(0)):
                key = keys_of(v, ends)
                mine = np.diff(ends) > 0
                if wanted is not None:
                    mine &= wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key if len(wanted) else False
                pick = [x for x in np.flatnonzero(mine).tolist() if key[x] not in seen and not seen.add(key[x])]
                if pick:
                    token, lev, cut = prefixes(v, ends, levels.value)
                    place = places(token, lev)
                    data = [v[ends[x] : ends[x + 1]].tobytes() for x in pick]
                    yield pa.RecordBatch.from_arrays([pa.array(key[pick]), pa.array(data, pa.binary()), pa.array([place[cut[x] : cut[x + 1]] for x in pick], pa.list_(pa.int64()))], names=["key", "hashes", "places"])

    sets = _texts(docs, text_column).mapInArrow(run, "key long, hashes binary, places array<long>")
    if few is None:
        sets = sets.join(keys.select("key"), "key", "left_semi")
    return written(sets.dropDuplicates(["key"]), "jaccard-sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are linked; pairs without stored sets are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 512):
            ok = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), dtype=K.U64), np.frombuffer(y.as_buffer(), dtype=K.U64)
                ok.append(bool(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
            yield b.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("hashes").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, labels) of the ends of the links a, b: the least key of each connected component."""
    keys, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(keys))
    while len(x):
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))  # a larger root goes to a smaller one
        while (label[label] != label).any():
            label = label[label]
        x, y = label[x], label[y]
        apart = x != y
        x, y = x[apart], y[apart]
    return keys, keys[label]


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(key, label) for every end of `links` (a, b): label is the same key for all of a connected component.

    In each round every key goes to the one of itself and its neighbours with the least hash, another one each round, and links are
    drawn between the keys that theirs went to, each once. So keys and links get fewer by a share of them each round, long chains and
    dense groups alike. When DRIVER_LINKS are left or fewer, the driver merges all of them.
    """
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), name + "-edges")
    labels, round_ = None, 0
    while edges.count() > 2 * DRIVER_LINKS:
        least = F.least(F.min(F.struct(F.xxhash64(F.lit(round_), "b").alias("h"), F.col("b").alias("key"))), F.struct(F.xxhash64(F.lit(round_), "a").alias("h"), F.col("a").alias("key")))
        steps = written(edges.groupBy("a").agg(least["key"].alias("to")), name + "-steps")
        if labels is None:
            labels = steps.select(F.col("a").alias("key"), F.col("to").alias("label"))
        else:
            labels = written(labels.join(steps.select(F.col("a").alias("label"), "to"), "label", "left").select("key", F.coalesce("to", "label").alias("label")), name)
        both = edges.join(steps, "a").select("b", F.col("to").alias("from")).join(steps.select(F.col("a").alias("b"), "to"), "b").select(F.col("from").alias("a"), F.col("to").alias("b"))
        edges = written(both.filter("a <> b").distinct(), name + "-edges")
        round_ += 1
    few = edges.filter("a < b").toArrow()
    keys, to = merged(few.column("a").to_numpy(), few.column("b").to_numpy())
    rest = links.sparkSession.createDataFrame(pa.table({"label": pa.array(keys, pa.int64()), "to": pa.array(to, pa.int64())}))
    if labels is None:
        return written(rest.select(F.col("label").alias("key"), F.col("to").alias("label")), name)
    return written(labels.join(rest, "label", "left").select("key", F.coalesce("to", "label").alias("label")), name)


def _prefix(n: Column) -> Column:
    return n - F.ceil(n * PERCENT / 100) + 1


def _near_size(n: Column, m: Column) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def _centres(rows: DataFrame) -> DataFrame:
    """(a, b, s, w): each key with the centres of its shingles whose size allows a link, how many shingles have it, and its weight."""
    return rows.filter((F.col("key") != F.col("c.key")) & _near_size(F.col("n"), F.col("c.n"))).groupBy(F.col("key").alias("a"), F.col("c.key").alias("b")).agg(F.count("*").alias("s"), F.min("c.w").alias("w"))


def _alike(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs whose sketches agree enough for a comparison."""
    both = pairs.join(sizes.select(F.col("key").alias("a"), F.col("sketch").alias("x")), "a").join(sizes.select(F.col("key").alias("b"), F.col("sketch").alias("y")), "b")
    return both.filter(F.size(F.array_intersect("x", "y")) >= SKETCH_SHARE * F.greatest(F.size("x"), F.size("y"))).select("a", "b")


def _star(pairs: DataFrame) -> DataFrame:
    """(a, b): of each key's pairs two at most: with the centre that most of its shingles have, and with one of the largest component.

    So there are two pairs for each key at most, however large a group; a round may miss links, the matrix finds them.
    """
    tie = F.xxhash64("a", "b")
    best = pairs.groupBy("a").agg(F.max(F.struct("s", tie, "b"))["b"].alias("near"), F.min(F.struct("w", tie, "b"))["b"].alias("large"))
    return best.select("a", F.explode(F.array_distinct(F.array("near", "large"))).alias("b"))


def link_classes(docs: DataFrame, classes: DataFrame, text_column: str = "text") -> DataFrame:
    """(key, label) of all classes that are linked with another. `classes`: what `_classes` gave, stored."""
    spark = docs.sparkSession
    levels = spark.sparkContext.broadcast(_levels(classes))
    by_token = Window.partitionBy("token", "salt")
    runs = _prefixes(docs, levels, text_column).withColumns({"low": F.min("key").over(by_token), "high": F.max("key").over(by_token)})
    # A shingle that one set alone has can't link it; of salted ones that isn't known here.
    runs = runs.filter((F.col("salt") > 0) | (F.col("low") != F.col("high"))).withColumn("c", F.min(F.struct("key", "n", F.lit(-1).cast("long").alias("w"))).over(by_token))
    runs = written(runs.select("token", "key", "n", "c").distinct(), "jaccard-runs")

    sizes = runs.select("key", F.col("n").cast("long").alias("n")).distinct()
    sizes = written(classes.filter("key IS NOT NULL").select("key", "n", "sketch").join(sizes.select("key"), "key", "left_semi").dropDuplicates(["key"]), "jaccard-sizes")
    alike = written(_alike(_star(_centres(runs)), sizes), "jaccard-alike")
    ends = lambda pairs: pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    sets = _sets_of(docs, written(ends(alike), "jaccard-keys"), levels, text_column)
    links = written(_verified(alike, sets), "jaccard-links")
    labels = components(links)
    rows = runs.select("token", "key", "n")
    for round_ in range(1, STAR_ROUNDS + 1):
        # Rows of shingles that two components have, with a centre of the largest component there, another one each round.
        members = sizes.join(labels, "key", "left").select("key", F.coalesce("label", "key").alias("label"))
        weight = written(members.groupBy("label").agg(F.count("*").alias("weight")), "jaccard-weights")
        members = members.join(weight, "label")
        rows = rows.select("token", "key", "n").join(members, "key")
        centre = F.min(F.struct((-F.col("weight")).alias("w"), F.xxhash64(F.lit(round_), "key").alias("h"), "key", "n", "label"))
        tokens = written(rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), centre.alias("c")).filter("low <> high").select("token", "c"), "jaccard-tokens")
        rows = written(rows.join(tokens, "token"), "jaccard-mixed")
        if round_ == STAR_ROUNDS:
            break
        # Keys without a stored set have no like centre so far, and are left to the matrix.
        asked = rows.filter("c.label <> label").join(sets.select("key"), "key", "left_semi")
        found = written(_verified(_alike(_star(_centres(asked)), sizes), sets), "jaccard-links")
        if found.isEmpty():
            break
        links = links.unionByName(found)
        labels = components(written(links, "jaccard-links"))

    # The token-group matrix. Only documents with a row here can have a link to another component.
    n, m = F.col("n"), F.col("m")
    rank = F.struct("weight", "label")
    hub = rows.groupBy("key").agg(F.first("n").cast("long").alias("n"), F.first(rank).alias("rank"), F.min(F.struct("c.w", "c.h", "c.label"))["label"].alias("hub"))
    group = F.when(F.col("rank.weight") > 1, F.col("rank.label")).otherwise(F.col("hub"))
    band = F.floor(F.log(n.cast("double")) / math.log(BAND))
    members = written(hub.withColumn("g", group).withColumn("band", band).drop("hub"), "jaccard-members")
    rows = rows.select("token", "key").join(members, "key")
    matrix = rows.groupBy("token", "g", "band").agg(F.max("rank").alias("top"), F.min("n").alias("least"), F.max("n").alias("most"))
    sizes_near = (F.col("most") * 100 >= n * PERCENT) & (n * 100 >= F.col("least") * PERCENT)
    met = rows.select("token", "key", "n", "rank").join(matrix, "token").filter((F.col("top") > F.col("rank")) & sizes_near).groupBy("key", "n", "rank", "g", "band").agg(F.count("*").alias("s"), F.min("least").alias("least"), F.max("most").alias("most"))
    # What is in one prefix alone lies after the end of the other, so that the overlap is s and the longer rest at most. What is
    # missing to the overlap that a link needs is least at one end of the members' sizes.
    missing = lambda size: (n + size) * PERCENT - (100 + PERCENT) * (F.col("s") + F.greatest(n - _prefix(n), size - _prefix(size)))
    low, high = F.greatest(F.col("least"), F.ceil(n * PERCENT / 100)), F.least(F.col("most"), F.floor(n * 100 / PERCENT))
    opened = written(met.filter(F.least(missing(low), missing(high)) <= 100 + PERCENT).select("g", "band", F.col("key").alias("a"), "n", "rank"), "jaccard-groups")
    inside = members.join(opened.select("g", "band").distinct(), ["g", "band"], "left_semi")
    more = opened.select(F.col("a").alias("key")).unionByName(inside.select("key")).distinct().join(sets.select("key"), "key", "left_anti")
    sets = sets.unionByName(_sets_of(docs, written(more, "jaccard-keys"), levels, text_column))
    prefix = sets.select("key", "places", F.element_at("places", -1).alias("end"))
    opened = opened.join(prefix.withColumnRenamed("key", "a"), "a")
    inside = inside.join(prefix, "key").select("g", "band", F.col("key").alias("b"), n.alias("m"), F.col("rank").alias("m_rank"), F.col("places").alias("m_places"), F.col("end").alias("m_end"))
    both = F.size(F.array_intersect("places", "m_places"))
    rest = F.least(n - _before(F.col("places"), F.col("m_end")), m - _before(F.col("m_places"), F.col("end")))
    passes = (F.col("m_rank") > F.col("rank")) & (F.col("m_rank.label") != F.col("rank.label")) & _near_size(n, m) & (both > 0) & linked(both + rest, n, m)
    pairs = opened.join(inside, ["g", "band"]).filter(passes).select("a", "b", ((both + rest) / (n + m)).alias("most"))
    pairs = written(pairs.withColumn("turn", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("most"), F.xxhash64("b")))), "jaccard-opened")
    # A document's likeliest pairs come first; of the others those whose ends these have not put into one component already.
    links = written(links.unionByName(_verified(pairs.filter(F.col("turn") <= FIRST).select("a", "b"), sets)), "jaccard-links")
    labels = components(links)
    label = lambda end: labels.select(F.col("key").alias(end), F.col("label").alias(f"{end}_label"))
    pairs = pairs.filter(F.col("turn") > FIRST).join(label("a"), "a", "left").join(label("b"), "b", "left")
    pairs = pairs.filter(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b")
    return components(written(links.unionByName(_verified(pairs, sets)), "jaccard-links"))


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for each row of `docs`.

    Null, empty and wordless texts have no shingles, are linked with nothing and are their own component. Rows with equal texts are
    linked; a component's id is its least non-null doc_id. A null id gives a row with a null doc_id. Empty table: no rows. Other
    columns are ignored.
    """
    with batches_of(docs.sparkSession, BATCH_ROWS), passing(docs.sparkSession) as keep:
        classes = written(_classes(docs, id_column, text_column), "jaccard-classes")
        labels = link_classes(docs, classes, text_column)
        rows = classes.filter("key IS NOT NULL").select("doc_id", "n", "key")
        named = keep(rows.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key")), "jaccard-named")
        least = keep(named.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id")), "jaccard-least")
    found = named.filter("n > 0").join(least, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.unionByName(named.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` without near-duplicates: of each component the row with the least id stays (of rows with equal ids one), with its columns."""
    row = own_name(docs, "__row")
    mine = written(docs.withColumn(row, F.monotonically_increasing_id()), "jaccard-input")
    order = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.col(row).alias("row"))
    found = jaccard_components(mine, row, text_column).select(F.col("doc_id").alias(row), "component_id")
    first = mine.select(F.col(id_column), row).join(found, row).groupBy("component_id").agg(F.min(order)["row"].alias(row))
    return mine.join(first.select(row), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
