"""Token ids as bit-plane or byte-plane files (operator 1).

A shard file holds the ids of consecutive documents, ascending by id. Layout, little-endian:

* header: magic ``PWTP``, version, plane kind (0 byte, 1 bit), id width in bytes, reserved byte, block size u32, documents u64, ids u64;
* blocks: each of `block` ids (the last may be shorter) is transposed into planes - plane p of kind byte holds byte p of every id,
  of kind bit it holds bit p - and each plane is one zstandard frame;
* tables: documents' ids (i64, zstandard), documents' id counts (u32, zstandard);
* chunk index: for each block and plane the offset u64 and length u32 of its frame; then the offsets of the tables and of the index, and the magic again.

With the index any document is read by decompressing only the blocks that it touches (`read_document`).
"""

from __future__ import annotations

import gc
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.llm.common import fresh_folder, in_slices, shuffle_partitions, written

MAGIC, HEAD, TAIL = b"PWTP", struct.Struct("<4sBBBxIQQ"), struct.Struct("<QQQQ4s")
KINDS = {"byte": 0, "bit": 1}
BLOCK_IDS = 1 << 16
#: Text bytes that go into one shard file, about, and into one task, which writes one file after the other.
SHARD_BYTES, TASK_BYTES = 6 << 20, 64 << 20
#: Remembered pieces and words; about 150 bytes each in every worker.
MEMO_WORDS = 1_200_000


# ---- file format -------------------------------------------------------------------------------------------------------------


def planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of one block of unsigned ids."""
    raw = np.ascontiguousarray(ids).view(np.uint8).reshape(len(ids), ids.itemsize)
    if kind == "byte":
        return [raw[:, p].tobytes() for p in range(ids.itemsize)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, p], bitorder="little").tobytes() for p in range(8 * ids.itemsize)]


def unplanes(parts: list[bytes], n: int, width: int, kind: str) -> np.ndarray:
    if kind == "byte":
        raw = np.stack([np.frombuffer(p, dtype=np.uint8) for p in parts], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, dtype=np.uint8), bitorder="little", count=n) for p in parts], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view(f"<u{width}").reshape(n)


def encode_shard(doc_ids: Iterable[int], counts: Iterable[int], ids: np.ndarray, kind: str = "byte", block: int = BLOCK_IDS, level: int = 3) -> bytes:
    """A whole shard file. `ids`: unsigned integers of 2 or 4 bytes, all documents' ids one after the other."""
    pack = zstandard.ZstdCompressor(level=level).compress
    doc_ids, counts = np.asarray(doc_ids, dtype="<i8"), np.asarray(counts, dtype="<u4")
    out = [HEAD.pack(MAGIC, 1, KINDS[kind], ids.itemsize, block, len(doc_ids), len(ids))]
    at, index = HEAD.size, []
    for k in range(0, len(ids), block):
        for p in planes(ids[k : k + block], kind):
            out.append(pack(p))
            index.append((at, len(out[-1])))
            at += len(out[-1])
    docs, sizes = pack(doc_ids.tobytes()), pack(counts.tobytes())
    table = b"".join(struct.pack("<QI", *x) for x in index)
    out += [docs, sizes, table, TAIL.pack(at, at + len(docs), at + len(docs) + len(sizes), len(index), MAGIC)]
    return b"".join(out)


class Shard:
    """A shard file's bytes, read through its chunk index."""

    def __init__(self, data: bytes | memoryview):
        self.data = data
        magic, version, kind, self.width, self.block, self.n_docs, self.n_ids = HEAD.unpack_from(data, 0)
        docs, sizes, table, n, end = TAIL.unpack_from(data, len(data) - TAIL.size)
        if magic != MAGIC or end != MAGIC or version != 1:
            raise ValueError("not a token-plane file, or cut short")
        self.kind = "bit" if kind else "byte"
        self._unpack = zstandard.ZstdDecompressor().decompress
        self.doc_ids = np.frombuffer(self._unpack(bytes(data[docs:sizes])), dtype="<i8")
        self.counts = np.frombuffer(self._unpack(bytes(data[sizes:table])), dtype="<u4")
        self.index = [struct.unpack_from("<QI", data, table + 12 * i) for i in range(n)]

    def read_block(self, k: int) -> np.ndarray:
        n, each = min(self.block, self.n_ids - k * self.block), self.width * (8 if self.kind == "bit" else 1)
        return unplanes([self._unpack(bytes(self.data[a : a + m])) for a, m in self.index[k * each : (k + 1) * each]], n, self.width, self.kind)

    def read_all(self) -> np.ndarray:
        blocks = [self.read_block(k) for k in range(-(-self.n_ids // self.block))]
        return np.concatenate(blocks) if blocks else np.zeros(0, dtype=f"<u{self.width}")

    def read_document(self, i: int) -> np.ndarray:
        """The ids of the i-th document, from the blocks that it touches alone."""
        a = int(self.counts[:i].sum(dtype=np.int64))
        b = a + int(self.counts[i])
        if a == b:
            return np.zeros(0, dtype=f"<u{self.width}")
        got = np.concatenate([self.read_block(k) for k in range(a // self.block, -(-b // self.block))])
        return got[a % self.block : a % self.block + b - a]


# ---- tokenizer ---------------------------------------------------------------------------------------------------------------

#: Letters, then punctuation, with no white space: the tokenizer cuts between them and lower-cases, whatever stands around.
_SIMPLE = re.compile(r"^([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:%$#*&|]*)$", re.M)


class WordTokenizer:
    """A tokenizer that drops white space and never merges across it, with a memo of bounded size from space-free piece to ids."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.width = 2 if self.t.get_vocab_size() <= 1 << 16 else 4
        # Two generations of pieces: when the newer one is full it becomes the older one, whose pieces come back when they are met.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.core: dict[str, bytes] = {}
        self.end = self._bytes([end_id])

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, dtype=f"<u{self.width}").tobytes()

    def _add_cores(self, cores: list[str]) -> None:
        """Each core is one pre-token, so that a joint encoding splits by word number."""
        for k in range(0, len(cores), 2000):
            part = cores[k : k + 2000]
            e = self.t.encode(" ".join(part), add_special_tokens=False)
            number = np.array(e.word_ids, dtype=np.int64)
            cut = np.searchsorted(number, np.arange(len(part) + 1))
            if number.size and number[-1] + 1 == len(part) and (np.diff(cut) > 0).all():
                raw = self._bytes(e.ids)
                w = self.width
                for c, a, b in zip(part, cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    self.core[c] = raw[w * a : w * b]
            else:
                for c, r in zip(part, self.t.encode_batch_fast(part, add_special_tokens=False), strict=True):
                    self.core[c] = self._bytes(r.ids)

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pieces; they have neither spaces nor line feeds."""
        if len(self.core) > MEMO_WORDS:
            self.core.clear()
        simple = _SIMPLE.findall("\n".join(pieces))
        names = list(map("".join, simple))
        other = list(pieces.difference(names)) if len(names) < len(pieces) else []
        core, memo = self.core, self.memo
        lower = [c.lower() for c, _ in simple]
        tails = list({t for _, t in simple}.difference(core, [""]))
        for t, e in zip(tails, self.t.encode_batch_fast(tails, add_special_tokens=False), strict=True):
            core[t] = self._bytes(e.ids)
        self._add_cores(list(set(lower).difference(core)))
        memo.update(zip(names, [core[low] + core[t] if t else core[low] for low, (_, t) in zip(lower, simple, strict=True)], strict=True))
        for p, e in zip(other, self.t.encode_batch_fast(other, add_special_tokens=False), strict=True):
            memo[p] = self._bytes(e.ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids with the end id, as bytes. Python's search for cycles is off meanwhile: there are none, and many objects."""
        searched = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if searched:
                gc.enable()

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [(x or "").replace("\n", " ").split(" ") for x in texts]
        missing = set().union(*cut)
        if len(self.memo) > MEMO_WORDS // 2:
            self.older, self.memo = self.memo, {}
        missing = missing.difference(self.memo)
        older = self.older
        known = [p for p in missing if p in older]
        self.memo.update(zip(known, map(older.__getitem__, known), strict=True))
        missing.difference_update(known)
        if missing:
            self._learn(missing)
        get = self.memo.__getitem__
        return [b"".join(map(get, x)) + self.end for x in cut]


_tokenizers: dict[tuple[str, int], WordTokenizer] = {}


def tokenizer(path: str, end_id: int) -> WordTokenizer:
    if (path, end_id) not in _tokenizers:
        _tokenizers[path, end_id] = WordTokenizer(path, end_id)
    return _tokenizers[path, end_id]


# ---- write and read ----------------------------------------------------------------------------------------------------------

_MANIFEST = "shard string, n_docs long, n_ids long, n_bytes long"


def _put(folder: str, name: str, data: bytes) -> None:
    """Write under another name, then move: a repeated or doubled task leaves one whole file of the same bytes."""
    fs, at = pyarrow.fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", folder))
    fs.create_dir(at, recursive=True)
    tmp = f"{at}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(tmp) as f:
        f.write(data)
    fs.move(tmp, f"{at}/{name}")


def write_token_planes(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, kind: str = "byte", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode every whole text and write the shard files `folder`/0000000-0000.pwtp, ... ; returns the manifest, a row for each shard.

    Tasks have ranges of ids, and cut theirs into shards, so that files in name order hold the documents in ascending order of id. Null
    text is the empty text and has the end id alone; a null id comes first and is stored as the least long; rows with equal ids follow
    each other, by text. An empty table gives no file and an empty manifest. Other columns are ignored. Only the rows of one shard
    (about SHARD_BYTES of text, or one document if that is longer) are in a worker's memory, however many rows have one id.
    """
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    tasks = max(1, -(-size // TASK_BYTES), min(-(-size // SHARD_BYTES), shuffle_partitions(docs.sparkSession)))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    dealt = rows.repartitionByRange(tasks, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok, task = tokenizer(tokenizer_path, end_id), TaskContext.get().partitionId()
        number, held, ids, counts, parts = 0, 0, [], [], []

        def close():
            nonlocal number, held, ids, counts, parts
            name = f"{task:07d}-{number:04d}"
            data = encode_shard(ids, counts, np.frombuffer(b"".join(parts), dtype=f"<u{tok.width}"), kind)
            _put(folder, f"{name}.pwtp", data)
            row = {"shard": pa.array([name]), "n_docs": pa.array([len(ids)], pa.int64()), "n_ids": pa.array([sum(counts)], pa.int64()), "n_bytes": pa.array([len(data)], pa.int64())}
            number, held, ids, counts, parts = number + 1, 0, [], [], []
            return pa.RecordBatch.from_pydict(row)

        for b in in_slices(batches, 256):
            texts = tok.encode(b.column(1).to_pylist())
            ids += [-(1 << 63) if i is None else i for i in b.column(0).to_pylist()]
            counts += [len(t) // tok.width for t in texts]
            parts += texts
            held += b.column(1).nbytes
            if held >= SHARD_BYTES:
                yield close()
        if ids:
            yield close()

    return dealt.mapInArrow(encode, _MANIFEST)


def read_token_planes(manifest: DataFrame, folder: str) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as little-endian u32).

    `manifest` must be a stored table: reading it again must not write the files again. It has a row for each shard (some MB of
    input); a shard's offset is the sum of the tasks before its own and of its task's shards before it.
    """
    spark = manifest.sparkSession
    schema = T.StructType.fromDDL("shard string, first long, doc_id long, n_tokens long, ids_crc32 long")
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                s = Shard(memoryview(content.as_buffer()))
                raw = s.read_all().astype("<u4").tobytes()
                ends = np.cumsum(s.counts.astype(np.int64))
                first = ends - s.counts
                crc = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(first.tolist(), ends.tolist(), strict=True)]
                n = s.n_docs
                docs = pa.array(s.doc_ids, mask=s.doc_ids == -(1 << 63))
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(first), docs, pa.array(s.counts.astype(np.int64)), pa.array(crc, type=pa.int64())], names=schema.names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pwtp").load(folder)
    rows = files.select(F.regexp_extract(F.col("path"), r"([0-9-]+)\.pwtp$", 1).alias("shard"), "content").mapInArrow(decode, schema)
    shards = manifest.select("shard", "n_ids", F.substring_index("shard", "-", 1).alias("task"))
    tasks = shards.groupBy("task").agg(F.sum("n_ids").alias("n"))  # a row for TASK_BYTES of text
    tasks = tasks.select("task", (F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("task")) - F.col("n")).alias("task_start"))
    inside = F.sum("n_ids").over(Window.partitionBy("task").orderBy("shard")) - F.col("n_ids")
    before = shards.withColumn("inside", inside).join(tasks, "task").select("shard", (F.col("task_start") + F.col("inside")).alias("before"))
    return rows.join(before, "shard").select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def token_planes(docs: DataFrame, tokenizer_path: str, end_id: int = 1, kind: str = "byte") -> DataFrame:
    """Write `docs` to a new folder in the shared one and read the files back."""
    folder = fresh_folder(docs.sparkSession, "token-planes")
    manifest = written(write_token_planes(docs, folder, tokenizer_path, end_id, kind), "token-manifest")
    return read_token_planes(manifest, folder)
