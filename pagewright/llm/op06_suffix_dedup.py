"""Exact substring deduplication by external induced sorting (operator 6).

A byte goes when a string of LENGTH bytes that covers it also starts in a document with a smaller id. The corpus is stored in blocks of
whole documents. Winnowing marks in every string of LENGTH bytes a gram by its hash alone, so that equal strings have equal marked
grams at the same place; marks found in one document only can't be in a repeated string. The others' surroundings (all strings whose
mark it is) are dealt to ranges by the mark's hash, so that equal strings meet, and stream into files of the worker's scratch
folder. A range's distinct surroundings are sorted in shards: all their suffixes, with their common prefixes, by induced sorting with
disk-backed queues (`induced_sorting`). Neighbours whose common prefix is LENGTH are one string, of which the least document id is
found, and the blocks get back which of their strings to remove.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import kernels as K
from pagewright.llm.common import batches_of, in_slices, rows_of, shuffle_partitions, written
from pagewright.llm.induced_sorting import suffix_order

LENGTH, GRAM = 50, 20
#: Grams in a string, strings around a mark, bytes around a mark.
STRINGS = LENGTH - GRAM + 1
AROUND = 2 * LENGTH - GRAM
BLOCK_BYTES = 1 << 20
#: Blocks that Spark hands to Python at once.
BATCH_BLOCKS = 8
#: Bytes of surroundings that are sorted together, about; more only if they share one mark.
SHARD_BYTES = 4 << 20
#: Bytes of suffix tuples that a shard's sort keeps out of files, and of an array that is not a file.
SORT_MEMORY = 1 << 20
#: Text bytes for one range of marks, about.
RANGE_BYTES = 8 << 20
NO_ID = -(1 << 63)
_MAX = np.uint32(0xFFFFFFFF)

_SPOOLED = np.dtype([("id", "<i8"), ("row", np.uint8, (AROUND,)), ("valid", np.uint8, (2,))])
_BLOCK = "block long, ids binary, sizes binary, text binary"


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a))


def _unpack(b, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=kind)


def encode_blocks(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        ids: list = []
        parts: list[K.Texts] = []

        def close() -> pa.RecordBatch:
            nonlocal number, ids, parts
            sizes = np.concatenate([t.end - t.start for t in parts]).astype("<i8")
            row = [number, _pack(np.array(ids, dtype="<i8")), _pack(sizes), _pack(np.concatenate([t.data for t in parts]))]
            number, ids, parts = number + 1, [], []
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for v in row], names=["block", "ids", "sizes", "text"])

        for b in in_slices(batches, 512):
            names = b.column(0).fill_null(NO_ID).to_pylist() if b.column(0).null_count else b.column(0).to_pylist()
            for i, j, t in K.blocks(b.column(1)):
                ids += names[i:j]
                parts.append(t)
                if sum(len(p.data) for p in parts) >= BLOCK_BYTES:
                    yield close()
        if ids:
            yield close()

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, _BLOCK)


class Block:
    """A stored block: documents' ids and sizes, and all bytes."""

    def __init__(self, ids: bytes, sizes: bytes, text: bytes):
        self.ids, self.sizes, self.data = _unpack(ids, "<i8"), _unpack(sizes, "<i8"), _unpack(text, np.uint8)
        self.end = np.cumsum(self.sizes)
        self.start = self.end - self.sizes

    def marks(self, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(position, document, hash, own) of marked grams, in order, without the documents in `skip`. own: numbers of the first and last of
        the STRINGS that hold the mark, of those in its document in which no other gram is less, the last of equal ones counting."""
        d = self.data
        n = len(d) - GRAM + 1
        if n <= 0:
            z = np.zeros(0, dtype=np.int64)
            return z, z, z.astype(K.U64), np.zeros((0, 2), dtype=np.int64)
        hashes = K.gram_hashes(d, GRAM)
        h = np.minimum((hashes >> np.uint64(32)).astype(np.uint32), _MAX - np.uint32(1))
        for e in self.end[self.end < len(d)].tolist():
            h[max(e - GRAM + 1, 0) : e] = _MAX  # grams across a border
        low = _sliding(h, STRINGS, np.minimum, _MAX)  # least of the window that begins here
        high = _sliding(low[::-1], STRINGS, np.maximum, np.uint32(0))[::-1]  # greatest of the windows that hold this gram
        at = np.flatnonzero((high == h) & (h != _MAX))
        h, hashes = h[at], hashes[at]
        doc = np.searchsorted(self.end, at, "right")
        first = at - (LENGTH - GRAM)
        begin, end = np.maximum(self.start[doc] - first, 0), np.minimum(self.end[doc] - LENGTH - first, STRINGS - 1)
        for k in range(1, STRINGS):  # marks so near that one string may hold both
            near = at[k:] - at[:-k] < STRINGS
            if not near.any():
                break
            right = near & (h[k:] <= h[:-k])
            end[:-k][right] = np.minimum(end[:-k], at[k:] - STRINGS - first[:-k])[right]
            left = near & (h[:-k] < h[k:])
            begin[k:][left] = np.maximum(begin[k:], at[:-k] + 1 - first[k:])[left]
        keep = ~skip[doc] & (self.sizes[doc] >= LENGTH) & (begin <= end)
        return at[keep], doc[keep], hashes[keep], np.stack([begin, end], axis=1)[keep]

    def surroundings(self, at: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The AROUND bytes around each mark, those alone that are in a string of its own."""
        first = at - (LENGTH - GRAM)
        padded = np.concatenate([np.zeros(LENGTH, np.uint8), self.data, np.zeros(LENGTH, np.uint8)])
        rows = np.lib.stride_tricks.sliding_window_view(padded, AROUND)[first + LENGTH].copy()
        place = np.arange(AROUND)
        rows[(place < own[:, :1]) | (place >= own[:, 1:] + LENGTH)] = 0
        return rows


def _sliding(h: np.ndarray, w: int, take, filler) -> np.ndarray:
    """take over h[i:i+w] for each i, in about log2(w) passes; missing values count as `filler`."""
    out, size = h.copy(), 1
    while size < w:
        step = min(size, w - size)
        moved = np.full_like(out, filler)
        moved[:-step] = out[step:] if step < len(out) else moved[:-step]
        out = take(out, moved)
        size += step
    return out


def row_names(rows: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """A 64-bit name of each surrounding with its valid strings."""
    n = len(rows)
    if not n:
        return np.zeros(0, dtype=K.U64)
    name = np.empty(n, dtype=K.U64)
    for i in range(0, n, 1 << 14):
        part = np.ascontiguousarray(rows[i : i + (1 << 14)])
        at = np.arange(len(part) + 1) * AROUND
        name[i : i + len(part)] = K.span_hashes(part.ravel(), at[:-1], at[1:])
    return name ^ (valid[:, 0].astype(np.int64) * 64 + valid[:, 1]).astype(K.U64) * K.U64(0x9E3779B97F4A7C15)


def _split(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts keys into n equal hash ranges, and where each range begins."""
    bucket = ((K.mix(keys) >> np.uint64(32)).astype(np.int64) * n) >> 32  # marks are least hashes, and not even themselves
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def _batch(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _copies(blocks: DataFrame) -> DataFrame:
    """(block, copies): numbers of the documents whose text is also that of a smaller id."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in rows_of(b):
                k = Block(r["ids"], r["sizes"], r["text"])
                digest = [hashlib.md5(k.data[a:z], usedforsecurity=False).digest() for a, z in zip(k.start.tolist(), k.end.tolist(), strict=True)]
                n = len(digest)
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(k.ids), pa.array(digest, pa.binary())], names=["block", "number", "id", "digest"])

    rows = blocks.mapInArrow(digests, "block long, number int, id long, digest binary")
    least = rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").select("digest", "least")
    return rows.join(least, "digest").filter("id > least").groupBy("block").agg(F.collect_list("number").alias("copies"))


def _skip(n: int, copies) -> np.ndarray:
    out = np.zeros(n, dtype=bool)
    out[list(copies or ())] = True
    return out


def _shared_marks(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, shared): for each hash range of the block's distinct marks, in order, whether two documents have the mark."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in rows_of(b):
                k = Block(r["ids"], r["sizes"], r["text"])
                _, doc, h, _ = k.marks(_skip(len(k.ids), r["copies"]))
                hashes, more = _distinct_marks(h, doc)
                order, cut = _split(hashes, buckets)
                rows = [(q, r["block"], hashes[order[x:y]].tobytes(), more[order[x:y]].tobytes()) for q, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if y > x]
                if rows:
                    yield _batch(["bucket", "block", "h", "more"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()], rows)

    def total(t: pa.Table) -> pa.Table:
        h = [np.frombuffer(x.as_buffer(), "<u8") for x in t.column("h")]
        more = np.concatenate([np.frombuffer(x.as_buffer(), bool) for x in t.column("more")])
        _, inverse = np.unique(np.concatenate(h), return_inverse=True)
        often = np.bincount(inverse, 1 + more)[inverse] > 1
        cut = np.cumsum([0, *map(len, h)])
        return pa.table({"block": t.column("block"), "bucket": t.column("bucket"), "shared": pa.array([np.packbits(often[x:y]).tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())})

    return blocks.mapInArrow(send, "bucket int, block long, h binary, more binary").groupBy("bucket").applyInArrow(total, "block long, bucket int, shared binary")


def _distinct_marks(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, and whether two documents of the block have it."""
    if not len(h):
        return h, np.zeros(0, dtype=bool)
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(h)) - 1
    return h[first], doc[first] != doc[last]


def _answers(rows, buckets: int, name: str) -> dict[int, bytes]:
    return {x["bucket"]: x[name] for x in rows or ()}


def _candidates(r: dict, buckets: int):
    """Of a block and its shared marks: the block, its marks' positions, own strings, documents and surroundings' numbers, and its
    distinct surroundings (rows, own strings, hash, least id)."""
    k = Block(r["ids"], r["sizes"], r["text"])
    at, doc, h, own = k.marks(_skip(len(k.ids), r["copies"]))
    hashes, _ = _distinct_marks(h, doc)
    order, cut = _split(hashes, buckets)
    shared = np.zeros(len(hashes), dtype=bool)
    got = _answers(r["shared"], buckets, "shared")
    for q, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        if y > x and q in got:
            shared[order[x:y]] = np.unpackbits(np.frombuffer(got[q], np.uint8), count=y - x).astype(bool)
    keep = shared[np.searchsorted(hashes, h)] if len(h) else np.zeros(0, dtype=bool)
    at, doc, h, own = at[keep], doc[keep], h[keep], own[keep]
    rows = k.surroundings(at, own) if len(at) else np.zeros((0, AROUND), np.uint8)
    _, first, number = np.unique(row_names(rows, own), return_index=True, return_inverse=True)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, number, k.ids[doc])
    return k, at, own, doc, number, rows[first], own[first], h[first], least


def sort_shard(rows: np.ndarray, valid: np.ndarray, ids: np.ndarray, told: dict | None = None) -> np.ndarray:
    """For each surrounding and each of its strings: the least id that has the string; of strings that aren't its own, the largest
    number. A row of STRINGS numbers for each surrounding."""
    n = len(rows)
    text = np.full((n, AROUND + 1), 1, dtype=np.uint8)
    text[:, :AROUND] = rows
    text[text == 0] = 255  # no byte of UTF-8; 0 ends the whole text alone
    place = np.arange(AROUND + 1)
    held = (place >= valid[:, :1]) & (place < valid[:, 1:] + LENGTH)
    held[:, AROUND] = True
    end = np.cumsum(held.sum(axis=1))
    order, common = suffix_order(np.append(text[held], np.uint8(0)), LENGTH, SORT_MEMORY, told)
    group = np.cumsum(common < LENGTH)  # suffixes that agree in LENGTH bytes
    owner = np.repeat(np.arange(n + 1), np.diff(np.concatenate([[0], end, [end[-1] + 1]])))[order]
    some = owner < n
    order, owner, group = order[some], owner[some], group[some]
    place = order - np.concatenate([[0], end])[owner] + valid[owner, 0]
    use = place <= valid[owner, 1]
    owner, place, group = owner[use], place[use], group[use]
    out = np.full((n, STRINGS), np.iinfo(np.int64).max)
    if len(owner):
        new = np.concatenate([[True], group[1:] != group[:-1]])
        out[owner, place] = np.minimum.reduceat(ids[owner], np.flatnonzero(new))[np.cumsum(new) - 1]
    return out


def sort_range(rows: np.ndarray, valid: np.ndarray, ids: np.ndarray, told: dict | None = None) -> np.ndarray:
    """For each surrounding a bit for each string: whether the string is also in a surrounding with a smaller id.

    Equal surroundings are sorted once, with the least of their ids. Shards of SHARD_BYTES about are cut by the marks' hashes, as
    surroundings that share a string have equal marks.
    """
    name = row_names(rows, valid)
    _, first, number = np.unique(name, return_index=True, return_inverse=True)
    by = np.argsort(number, kind="stable")
    cut = np.searchsorted(number[by], np.arange(len(first) + 1))
    least = np.minimum.reduceat(ids[by], cut[:-1])
    mark = np.zeros(len(first), dtype=K.U64)
    for i in range(LENGTH - GRAM, LENGTH):
        mark = mark * K.U64(0x100000001B3) + rows[first, i]
    parts = max(1, -(-len(first) * (AROUND + 1) // SHARD_BYTES))
    part = (K.mix(mark) >> K.U64(33)).astype(np.int64) % parts
    order = np.argsort(part, kind="stable")
    out = np.zeros(len(rows), dtype=np.uint32)
    bit = np.uint32(1) << np.arange(STRINGS, dtype=np.uint32)
    for o in np.split(order, np.searchsorted(part[order], np.arange(1, parts))):
        if len(o):
            found = sort_shard(rows[first[o]], valid[first[o]].astype(np.int64), least[o], told)
            mine = np.concatenate([by[a:b] for a, b in zip(cut[o].tolist(), cut[o + 1].tolist(), strict=True)])
            at = np.repeat(np.arange(len(o)), cut[o + 1] - cut[o])
            for i in range(0, len(mine), 1 << 16):
                m, k = mine[i : i + (1 << 16)], at[i : i + (1 << 16)]
                out[m] = ((found[k] < ids[m][:, None]) * bit).sum(axis=1, dtype=np.uint32)
    return out


def _string_masks(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, masks): for each hash range of the block's distinct surroundings, in order, the answer of `sort_shard`."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in rows_of(b):
                _, _, _, _, _, rows, valid, h, least = _candidates(r, buckets)
                order, cut = _split(h, buckets)
                out = []
                for q, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                    if y > x:
                        o = order[x:y]
                        out.append((q, r["block"], rows[o].tobytes(), valid[o].astype(np.uint8).tobytes(), least[o].tobytes()))
                if out:
                    yield _batch(["bucket", "block", "rows", "valid", "ids"], [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()], out)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows come range by range; a range's are in a file while they come."""
        with tempfile.TemporaryDirectory(prefix="suffix-") as folder:
            spool, bucket, sent = None, None, []

            def close() -> pa.RecordBatch:
                spool.close()
                n = sum(x for _, x in sent)
                raw = np.memmap(spool.name, dtype=_SPOOLED, mode="r", shape=(n,))
                masks = sort_range(raw["row"], raw["valid"], np.ascontiguousarray(raw["id"]))
                cut = np.cumsum([0, *(x for _, x in sent)])
                return _batch(["block", "bucket", "masks"], [pa.int64(), pa.int32(), pa.binary()], [(block, bucket, masks[x:y].tobytes()) for (block, _), x, y in zip(sent, cut[:-1], cut[1:], strict=True)])

            for b in batches:
                for r in rows_of(b):
                    if r["bucket"] != bucket:
                        if sent:
                            yield close()
                        spool, bucket, sent = open(os.path.join(folder, "range"), "wb"), r["bucket"], []
                    ids = np.frombuffer(r["ids"], "<i8")
                    got = np.empty(len(ids), dtype=_SPOOLED)
                    got["id"], got["row"], got["valid"] = ids, np.frombuffer(r["rows"], np.uint8).reshape(-1, AROUND), np.frombuffer(r["valid"], np.uint8).reshape(-1, 2)
                    spool.write(got.tobytes())
                    sent.append((r["block"], len(ids)))
            if sent:
                yield close()

    sent = blocks.mapInArrow(send, "bucket int, block long, rows binary, valid binary, ids binary")
    return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(answer, "block long, bucket int, masks binary")


def _removed(r: dict, buckets: int) -> tuple[Block, np.ndarray]:
    """The block and whether each byte goes."""
    k, at, own, doc, number, _, _, h, least = _candidates(r, buckets)
    order, cut = _split(h, buckets)
    masks = np.zeros(len(h), dtype=np.uint32)
    got = _answers(r["masks"], buckets, "masks")
    for q, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        if y > x:
            masks[order[x:y]] = np.frombuffer(got[q], np.uint32)
    place = np.arange(STRINGS)
    inside = (place >= own[:, :1]) & (place <= own[:, 1:])
    bits = (masks[number][:, None] >> place.astype(np.uint32)) & np.uint32(1) != 0
    bits |= (k.ids[doc] > least[number])[:, None]  # the same strings with a smaller id are in this block
    i, j = np.nonzero(bits & inside)
    string = at[i] - (LENGTH - GRAM) + j
    n = len(k.data) + 1
    change = np.bincount(string, minlength=n) - np.bincount(string + LENGTH, minlength=n)
    gone = np.cumsum(change[:-1]) > 0
    for d in np.flatnonzero(_skip(len(k.ids), r["copies"]) & (k.sizes >= LENGTH)).tolist():
        gone[k.start[d] : k.end[d]] = True
    return k, gone


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def deduplicate(docs: DataFrame, keep_bytes: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with `keep_bytes` the bytes that stay.

    Null and empty texts have no bytes; texts shorter than LENGTH lose none. A null id is smaller than any other and comes back as
    null. Rows with equal ids never remove from each other. Strings within one document don't count against it. What stays need not be
    valid UTF-8. Empty table: no rows. Other columns are ignored.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(text_column).cast("string")))).first()[0] or 0
    buckets = max(-(-total // RANGE_BYTES), shuffle_partitions(docs.sparkSession))
    blocks = written(encode_blocks(docs, id_column, text_column), "suffix-blocks")
    spark = docs.sparkSession
    with batches_of(spark, BATCH_BLOCKS):
        blocks = blocks.join(written(_copies(blocks), "suffix-copies"), "block", "left")
        shared = written(_shared_marks(blocks, buckets), "suffix-marks").groupBy("block").agg(F.collect_list(F.struct("bucket", "shared")).alias("shared"))  # a row for each range
        blocks = blocks.join(shared, "block", "left")
        masks = written(_string_masks(blocks, buckets), "suffix-masks").groupBy("block").agg(F.collect_list(F.struct("bucket", "masks")).alias("masks"))
        blocks = blocks.join(masks, "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in rows_of(b):
                k, gone = _removed(r, buckets)
                n = len(k.ids)
                c = np.concatenate([[0], np.cumsum(gone)])
                first = gone.copy()
                first[1:] &= ~gone[:-1]
                inner = k.start[(k.sizes > 0)]
                first[inner] = gone[inner]
                f = np.concatenate([[0], np.cumsum(first)])
                kept = [k.data[a:z][~gone[a:z]].tobytes() for a, z in zip(k.start.tolist(), k.end.tolist(), strict=True)]
                columns = [pa.array(k.ids, mask=k.ids == NO_ID), pa.array(k.sizes), pa.array(c[k.end] - c[k.start]), pa.array(f[k.end] - f[k.start]), pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array(kept if keep_bytes else [None] * n, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _OUT.split(", ")])

    with batches_of(spark, BATCH_BLOCKS):
        out = written(blocks.mapInArrow(run, _OUT), "suffix-result")
    return out if keep_bytes else out.drop("kept")


def brute_force(ids: list[int | None], texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """The definition itself, for tests: n_bytes, n_removed, n_spans, kept_sha256."""
    raw = [(t or "").encode() for t in texts]
    names = [NO_ID if i is None else i for i in ids]
    least: dict[bytes, int] = {}
    for i, x in zip(names, raw, strict=True):
        for p in range(len(x) - length + 1):
            s = x[p : p + length]
            least[s] = min(i, least.get(s, i))
    out = []
    for i, x in zip(names, raw, strict=True):
        gone = bytearray(len(x))
        for p in range(len(x) - length + 1):
            if least[x[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for p in range(len(x)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((len(x), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(x, gone, strict=True) if not g)).hexdigest()))
    return out
