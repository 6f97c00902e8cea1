"""Log-bilinear language model scores (operator 10).

Vocabulary. Texts are encoded in blocks: a block has the sorted 64-bit hashes of its distinct tokens, their counts in training
documents, and its documents as numbers into that list. Blocks send their lists to hash ranges, where counts of all blocks are summed, and
each block gets the total counts of its own tokens back; no list of all tokens exists in one place.

Symbols. The most frequent training tokens, and REST symbols that the others are hashed to. There are about N ** GROWTH of the former
for N training tokens, so that the vocabulary, its vectors and its classes grow with the input: 1,000 at 3 * 10 ** 7 tokens, 8,000 at
5 * 10 ** 9 (some MB of vectors and their squared gradients on the driver).

Model. A symbol is predicted from the CONTEXT ones before it: q = sum C_i r[w_i]. Symbols are cut into classes of equal size by what
stands next to them, and P(w | q) = P(class | q) P(w | class, q), each a softmax of q . t + b; both are trained in numpy by
noise-contrastive estimation on every training token. A pass is cut into rounds: in each, all tasks start from the same model, go over
a part of their own blocks' tokens, and the mean of their models, weighed by tokens, is the next round's; what comes to the driver is
that mean. Symbols' counts and neighbours are sums over all training tokens too. Scores are batched matrix products, one per class,
over the distinct (context, symbol) of a block. A token that isn't a symbol itself has the share
(c + 1) / (N + V + 1) of its rest symbol, N tokens and V distinct ones in training there, and one share for whatever is not in
training, so that log-probabilities are normalised over all tokens.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import kernels as K
from pagewright.llm.common import in_slices, rows_of, shuffle_partitions, written

#: Frequent tokens are N ** GROWTH, a power of two and WORDS at least; the others share REST symbols.
GROWTH, WORDS, REST = 0.4, 128, 64
#: Symbols of context; sizes of vectors, of noise for each batch of classes and for each word, of batches.
CONTEXT, DIMENSIONS, NOISE, WORD_NOISE, BATCH = 3, 24, 32, 2, 2048
#: A model is trained on each training token so often, and on small tables more often, until it has seen SEEN tokens; in so many rounds.
PASSES, SEEN, ROUNDS = 1, 2_000_000, 4
#: Batches of a model trained on rows at hand, at least.
STEPS = 1000
#: Signs of a symbol on each side in the sums of neighbours, and parts in which sums of all tasks are added up.
SIGNS, PARTS = 16, 64
#: Text bytes for one hash range, about.
RANGE_BYTES = 8 << 20
#: Words in a block, about; bounds a worker's memory.
BLOCK_WORDS = 1_500_000
END = int(K.mix(np.array([0xE0D], dtype=K.U64))[0])

_BLOCK = "block long, doc_ids binary, held binary, sizes binary, tokens binary, hashes binary, counts binary, classes binary, n_train long"


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=kind)


def _encode(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(token hashes, classes, tokens of each text) for runs of texts; an end follows each text."""
    for i, j, t in K.blocks(texts):
        s, e, doc = K.words(t)
        h = K.span_hashes(t.data, s, e, lower=True)
        first = K.LOWER[t.data[s]].astype(np.int64)
        second = np.where(e - s > 1, K.LOWER[t.data[np.minimum(s + 1, max(len(t.data) - 1, 0))]], 0).astype(np.int64) if len(s) else first
        group = ((first * 257 + second) * 2654435761 >> 7) % REST
        b = K.bounds(doc, j - i)
        at = b[1:]
        yield np.insert(h, at, np.uint64(END)), np.insert(group, at, 0).astype(np.uint8), np.diff(b) + 1


def encode_blocks(docs: DataFrame, fold: int = 7, held_fold: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each block of documents; see _BLOCK. Documents whose crc32(id as text) mod `fold` is `held_fold` are held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        ids, held, parts = [], [], []

        def close() -> pa.RecordBatch:
            nonlocal number, ids, held, parts
            h, g, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
            hashes, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            out = np.array(held, dtype=bool)
            train = ~np.repeat(out, sizes)
            counts = np.bincount(inverse[train], minlength=len(hashes)).astype("<u4")
            valid = np.array([x is not None for x in ids], dtype=np.uint8)
            doc_ids = np.stack([np.array([0 if x is None else x for x in ids], dtype="<i8"), valid.astype("<i8")])
            row = [number, _pack(doc_ids), _pack(out), _pack(sizes.astype("<u4")), _pack(inverse.astype("<u4")), _pack(hashes), _pack(counts), _pack(g[first]), int(train.sum())]
            number, ids, held, parts = number + 1, [], [], []
            names = [x.split()[0] for x in _BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for v in row], names=names)

        for b in in_slices(batches, 512):
            ids += b.column(0).to_pylist()
            held += (K.crc32_mod(b.column(0), fold) == held_fold).tolist()
            parts += _encode(b.column(1))
            if sum(len(p[0]) for p in parts) >= BLOCK_WORDS:
                yield close()
        if ids:
            yield close()

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, _BLOCK)


def _ranges(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where the n equal ranges of hashes begin in a sorted list; n + 1 values."""
    edges = (np.arange(1, n, dtype=np.float64) * (2.0**64 / n)).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]]).astype(np.int64)


def n_words(train_tokens: int) -> int:
    """How many tokens are symbols of their own: a power of two near N ** GROWTH."""
    return max(WORDS, 1 << round(np.log2(max(train_tokens, 1) ** GROWTH)))


def exchange_counts(blocks: DataFrame, buckets: int, words: int) -> DataFrame:
    """(block, bucket, totals, top): for each block and hash range the training counts over all blocks of its hashes there, in order.

    A row with a null block for each range has in `top` the range's most frequent hashes, their counts and rest symbols, and in `totals`
    the tokens and the distinct tokens of each rest symbol. As hashes are dealt evenly, a range has `words` / `buckets` of the most
    frequent ones, and gives that number and six standard deviations more.
    """
    share = words / buckets
    most = min(words, int(share + 6 * share**0.5 + 4))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, hashes, counts, classes in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
                h, c, g = _unpack(hashes, "<u8"), _unpack(counts, "<u4"), _unpack(classes, np.uint8)
                cut = _ranges(h, buckets)
                rows = [(k, block, h[x:y].tobytes(), c[x:y].tobytes(), g[x:y].tobytes()) for k, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if y > x]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "block", "h", "c", "g"])

    def total(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        h = [np.frombuffer(x.as_buffer(), "<u8") for x in t.column("h")]
        c = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in t.column("c")]).astype(np.int64)
        g = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in t.column("g")])
        u, first, inverse = np.unique(np.concatenate(h), return_index=True, return_inverse=True)
        n = np.bincount(inverse, c, len(u)).astype("<i8")
        cut = np.cumsum([0, *map(len, h)])
        answers = [n[inverse[x:y]].astype("<u8").tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]
        group, seen = g[first], n > 0
        best = np.lexsort((u, -n))[:most]
        top = np.stack([u[best].view("<i8"), n[best], group[best].astype("<i8")])
        sums = np.concatenate([np.bincount(group, n, REST), np.bincount(group[seen], minlength=REST)]).astype("<i8")
        return pa.table({"block": pa.array([*t.column("block").to_pylist(), None], pa.int64()), "bucket": pa.array([bucket] * (len(h) + 1), pa.int32()), "totals": pa.array([*answers, sums.tobytes()], pa.binary()), "top": pa.array([*[None] * len(h), top.tobytes()], pa.binary())})

    sent = blocks.select("block", "hashes", "counts", "classes").mapInArrow(send, "bucket int, block long, h binary, c binary, g binary")
    return sent.groupBy("bucket").applyInArrow(total, "block long, bucket int, totals binary, top binary")


class Vocabulary:
    """What all tasks need to know: the frequent tokens' hashes, the end first, and each rest symbol's tokens and distinct tokens without them."""

    def __init__(self, rows: list, words: int):
        sums = np.zeros(2 * REST, dtype=np.int64)
        tops = []
        for r in rows:
            sums += np.frombuffer(r["totals"], "<i8")
            tops.append(np.frombuffer(r["top"], "<i8").reshape(3, -1))
        top = np.concatenate(tops, axis=1) if tops else np.zeros((3, 0), dtype=np.int64)
        self.train_tokens, self.distinct = int(sums[:REST].sum()), int(sums[REST:].sum())
        h, n, g = top[0].view(np.uint64), top[1], top[2]
        at = np.lexsort((h, -n))
        end = np.uint64(END)
        at = np.concatenate([at[h[at] == end], at[(h[at] != end) & (n[at] > 0)][: words - 1]])
        self.words = h[at]  # the end is symbol 0
        if not len(self.words) or self.words[0] != end:
            self.words = np.concatenate([[end], self.words])[:words]
        self.order = np.argsort(self.words)
        self.size = len(self.words) + REST
        self.rest_n, self.rest_v = sums[:REST].copy(), sums[REST:].copy()
        counts = n[at] if len(at) == len(self.words) else np.concatenate([[0], n[at]])[: len(self.words)]
        np.subtract.at(self.rest_n, g[at], n[at])
        np.subtract.at(self.rest_v, g[at], (n[at] > 0).astype(np.int64))
        #: Training tokens of each symbol.
        self.counts = np.concatenate([counts, self.rest_n])

    def symbols(self, hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The symbol of each hash of a sorted list."""
        s = classes.astype(np.int64) + len(self.words)
        at = np.searchsorted(hashes, self.words)
        hit = at < len(hashes)
        hit[hit] = hashes[at[hit]] == self.words[hit]
        s[at[hit]] = np.flatnonzero(hit)
        return s


def token_shares(v: Vocabulary, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 of each token's share of its symbol: of symbols of their own all, of a rest symbol by the token's training count."""
    words = len(v.words)
    rest = np.maximum(symbols - words, 0)
    return np.where(symbols >= words, np.log10(counts + 1.0) - np.log10(v.rest_n + v.rest_v + 1.0)[rest], 0.0)


def contexts(symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CONTEXT symbols before each token, the nearest first; before a text stands the end."""
    first = np.cumsum(sizes) - sizes
    out, last = [], symbols
    for _ in range(CONTEXT):
        last = np.roll(last, 1)
        last[first] = 0
        out.append(last)
    return np.stack(out)


def training_rows(row: dict, vocabulary: Vocabulary) -> np.ndarray:
    """(symbol, symbols before it) of every training token of a block."""
    s = vocabulary.symbols(_unpack(row["hashes"], "<u8"), _unpack(row["classes"], np.uint8)).astype(np.int32)
    sizes = _unpack(row["sizes"], "<u4").astype(np.int64)
    symbols = s[_unpack(row["tokens"], "<u4")]
    return np.concatenate([symbols[None], contexts(symbols, sizes)])[:, ~np.repeat(_unpack(row["held"], bool), sizes)].T


_TRAINING = ("block", "hashes", "classes", "sizes", "tokens", "held")


def summed(parts: DataFrame) -> np.ndarray:
    """The sum of all tasks' lists of numbers; `parts` (part, block, numbers) has each list cut by `_cut`. Added in order of blocks."""

    def add(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("block").to_numpy(), kind="stable")
        x = t.column("numbers")
        total = sum(np.frombuffer(x[int(i)].as_buffer(), "<f8") for i in order)
        return pa.table({"part": t.column("part")[:1], "numbers": pa.array([total.tobytes()], pa.binary())})

    got = parts.groupBy("part").applyInArrow(add, "part int, numbers binary").orderBy("part").collect()
    return np.concatenate([np.frombuffer(r["numbers"], "<f8") for r in got]) if got else np.zeros(0)


def _cut(block: int, numbers: np.ndarray) -> pa.RecordBatch:
    cut = np.array_split(np.asarray(numbers, dtype="<f8"), PARTS)
    return pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([block] * PARTS, pa.int64()), pa.array([x.tobytes() for x in cut], pa.binary())], names=["part", "block", "numbers"])


_PARTS = "part int, block long, numbers binary"


def neighbours(rows: np.ndarray, size: int, seed: int = 42) -> np.ndarray:
    """For each symbol the sum of its left neighbours' signs and of its right ones'; whole numbers, that add up over blocks."""
    signs = np.random.default_rng(seed).integers(0, 2, (2, SIGNS, size)) * 2 - 1
    pairs, n = np.unique(rows[:, 0].astype(np.int64) * size + rows[:, 1], return_counts=True)
    w, left = np.divmod(pairs, size)
    return np.stack([np.bincount(w, n * x[left], size) for x in signs[0]] + [np.bincount(left, n * x[w], size) for x in signs[1]], axis=1)


def all_neighbours(blocks: DataFrame, vocabulary) -> np.ndarray:
    """`neighbours` of all training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, block = None, 0
        for b in batches:
            for r in rows_of(b):
                x = neighbours(training_rows(r, vocabulary.value), vocabulary.value.size)
                total, block = (x, r["block"]) if total is None else (total + x, block)
        if total is not None:
            yield _cut(block, total.ravel())

    return summed(blocks.select(*_TRAINING).mapInArrow(run, _PARTS)).reshape(-1, 2 * SIGNS)


def trained(blocks: DataFrame, vocabulary, steps: int | None = None, seed: int = 42) -> LogBilinear:
    """The model after PASSES or more over every training token. steps: rounds that they are cut into, else ROUNDS."""
    v = vocabulary.value
    if not v.train_tokens:
        return LogBilinear.untrained(v.counts, np.zeros((v.size, 2 * SIGNS)), seed)
    model = LogBilinear.untrained(v.counts, all_neighbours(blocks, vocabulary), seed)
    passes, steps = max(PASSES, -(-SEEN // v.train_tokens)), steps or ROUNDS
    for round_ in range(steps):
        shared = blocks.sparkSession.sparkContext.broadcast(model)
        got = summed(blocks.select(*_TRAINING).mapInArrow(_round(vocabulary, shared, round_, steps, passes, seed), _PARTS))
        model.load(got[:-1] / got[-1])
        shared.unpersist()
    return model


def turns(n: int, passes: int, round_: int, steps: int, order: np.ndarray) -> np.ndarray:
    """Which of a block's n tokens a round goes over: over all rounds, each token `passes` times."""
    return order[np.arange(passes * n * round_ // steps, passes * n * (round_ + 1) // steps) % n]


def _round(vocabulary, shared, round_: int, steps: int, passes: int, seed: int):
    rate = 0.1 * (1 - round_ / steps) + 0.005

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, block, weight = shared.value.copy(), None, 0
        for b in batches:
            for r in rows_of(b):
                rows = training_rows(r, vocabulary.value)
                if not len(rows):
                    continue
                rows = rows[turns(len(rows), passes, round_, steps, np.random.default_rng([seed, r["block"]]).permutation(len(rows)))]
                rng = np.random.default_rng([seed, r["block"], round_])
                for i in range(0, len(rows), BATCH):
                    model.learn(rows[i : i + BATCH], rate, rng)
                block, weight = r["block"] if block is None else block, weight + len(rows)
        if weight:
            yield _cut(block, np.append(model.state() * weight, weight))

    return run


def classes_of(features: np.ndarray, counts: np.ndarray, seed: int = 42) -> tuple[np.ndarray, int]:
    """A class for each symbol, and how many there are: symbols are halved again and again at the median of the direction in which
    their neighbours (see `neighbours`) differ most, so that classes have equal sizes."""
    size = len(counts)
    features = features / (counts[:, None] + 1.0)
    features += np.random.default_rng(seed).normal(0, 1e-6, features.shape)
    levels = max(1, round(np.log2(size) / 2))
    out = np.zeros(size, dtype=np.int64)
    for _ in range(levels):
        deeper = np.zeros_like(out)
        for c in range(out.max() + 1):
            mine = np.flatnonzero(out == c)
            x = features[mine] - features[mine].mean(0)
            direction = np.linalg.eigh(x.T @ x)[1][:, -1]
            half = np.argsort(x @ direction, kind="stable")[len(mine) // 2 :]
            deeper[mine] = 2 * c
            deeper[mine[half]] += 1
        out = deeper
    return out, 1 << levels


class LogBilinear:
    """The model. Trained on rows at hand by its constructor; `trained` trains one on all blocks."""

    #: What is trained.
    LEARNED = ("r", "t", "k", "c", "b", "kb")

    def __init__(self, samples: np.ndarray, size: int, steps: int | None = None, seed: int = 42):
        """samples: rows of (symbol, symbols before it), of `size` symbols. steps: of training; else as many as the samples ask for."""
        self._start(np.bincount(samples[:, 0], minlength=size), neighbours(samples, size) if len(samples) else np.zeros((size, 2 * SIGNS)), seed)
        rng = np.random.default_rng(seed)
        steps = max(STEPS, len(samples) // BATCH) if steps is None else steps
        for step in range(steps if len(samples) else 0):
            self.learn(samples[rng.integers(0, len(samples), BATCH)], 0.1 * (1 - step / steps) + 0.005, rng)

    @classmethod
    def untrained(cls, counts: np.ndarray, features: np.ndarray, seed: int = 42) -> LogBilinear:
        """A model to be trained, of symbols with these counts and `neighbours`."""
        model = cls.__new__(cls)
        model._start(counts, features, seed)
        return model

    def _start(self, counts: np.ndarray, features: np.ndarray, seed: int) -> None:
        rng, f = np.random.default_rng(seed), np.float32
        self.size = size = len(counts)
        self.cls, self.n_classes = classes_of(features, counts)
        # Symbols in order of class: a class is a run of them.
        self.order = np.argsort(self.cls, kind="stable")
        self.place = np.empty(size, dtype=np.int64)
        self.place[self.order] = np.arange(size)
        self.begin = np.searchsorted(self.cls[self.order], np.arange(self.n_classes + 1))
        unigram = counts + 1.0
        mass = np.bincount(self.cls, unigram, self.n_classes)
        self.noise, self.inside = mass / mass.sum(), (unigram / mass[self.cls])[self.order]
        self.upto = np.concatenate([[0.0], np.cumsum(self.inside)])
        self.log_noise, self.log_inside = np.log(NOISE * self.noise).astype(f), np.log(WORD_NOISE * self.inside).astype(f)
        start = lambda *shape: rng.normal(0, 0.1, shape).astype(f)
        self.r, self.t, self.k = start(size, DIMENSIONS), start(size, DIMENSIONS), start(self.n_classes, DIMENSIONS)
        self.c = np.stack([np.eye(DIMENSIONS, dtype=f) / (i + 1) for i in range(CONTEXT)])
        self.b, self.kb = np.log(self.inside).astype(f), np.log(self.noise).astype(f)  # t, b: in order of class
        self.square = {n: np.full_like(getattr(self, n), 1e-6) for n in self.LEARNED}

    def copy(self) -> LogBilinear:
        """One that can be trained without changing this one."""
        other = copy.copy(self)
        other.square = {}
        for n in self.LEARNED:
            setattr(other, n, getattr(self, n).copy())
            other.square[n] = self.square[n].copy()
        return other

    def state(self) -> np.ndarray:
        """All that training changes, in a row."""
        return np.concatenate([x.ravel().astype(np.float64) for n in self.LEARNED for x in (getattr(self, n), self.square[n])])

    def load(self, state: np.ndarray) -> None:
        at = 0
        for n in self.LEARNED:
            for x in (getattr(self, n), self.square[n]):
                x[...] = state[at : at + x.size].reshape(x.shape)
                at += x.size

    def learn(self, rows: np.ndarray, rate: float, rng: np.random.Generator) -> None:
        """One step on a batch of rows (symbol, symbols before it)."""
        sigmoid = lambda x: 1 / (1 + np.exp(-x))
        f, size = np.float32, len(rows)
        w, before, cls = self.place[rows[:, 0]], rows[:, 1:].T, self.cls[rows[:, 0]]
        context = self.r[before]
        q = sum(context[i] @ self.c[i] for i in range(CONTEXT))
        # The class against NOISE classes that the batch shares.
        z = rng.choice(self.n_classes, NOISE, p=self.noise)
        good = (1 - sigmoid((q * self.k[cls]).sum(1) + self.kb[cls] - self.log_noise[cls])).astype(f)
        bad = -sigmoid(q @ self.k[z].T + self.kb[z] - self.log_noise[z]).astype(f)
        gq = good[:, None] * self.k[cls] + bad @ self.k[z]
        class_at, class_by = np.concatenate([cls, z]), np.concatenate([good, bad.sum(0)])
        class_rows = np.concatenate([good[:, None] * q, bad.T @ q])
        # The word against WORD_NOISE words of its class each.
        low, high = self.upto[self.begin[cls]], self.upto[self.begin[cls + 1]]
        z = np.searchsorted(self.upto, low[:, None] + rng.random((size, WORD_NOISE)) * (high - low)[:, None], "right") - 1
        z = np.clip(z, self.begin[cls][:, None], self.begin[cls + 1][:, None] - 1)
        good = (1 - sigmoid((q * self.t[w]).sum(1) + self.b[w] - self.log_inside[w])).astype(f)
        noise = self.t[z]
        bad = -sigmoid(np.matmul(noise, q[:, :, None])[:, :, 0] + self.b[z] - self.log_inside[z]).astype(f)
        gq += good[:, None] * self.t[w] + np.matmul(bad[:, None], noise)[:, 0]
        word_rows = np.concatenate([good[:, None] * q, (bad[:, :, None] * q[:, None]).reshape(-1, DIMENSIONS)])
        matrices = np.stack([context[i].T @ gq for i in range(CONTEXT)]) / size
        self._step("r", before.ravel(), np.concatenate([gq @ self.c[i].T for i in range(CONTEXT)]), size, rate)
        self._step("t", np.concatenate([w, z.ravel()]), word_rows, size, rate, "b", np.concatenate([good, bad.ravel()]))
        self._step("k", class_at, class_rows, size, rate, "kb", class_by)
        self.square["c"] += matrices * matrices
        self.c += rate * matrices / np.sqrt(self.square["c"])

    def _step(self, name: str, at: np.ndarray, rows: np.ndarray, size: int, rate: float, bias: str | None = None, by: np.ndarray | None = None) -> None:
        """Moves the rows `at` of what is called `name`, and their biases, by their gradients; numbers may repeat."""
        order = np.argsort(at, kind="stable")
        sorted_ = at[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        for n, x in ((name, rows), (bias, by)):
            if n is not None:
                u, d = sorted_[first], np.add.reduceat(x[order], first, axis=0) / size
                square = self.square[n][u] + d * d
                self.square[n][u] = square
                getattr(self, n)[u] += rate * d / np.sqrt(square)

    def log10(self, rows: np.ndarray) -> np.ndarray:
        """log10 P(symbol | symbols before it) of rows (symbol, symbols before it), normalised over all symbols."""
        out = np.empty(len(rows))
        cls = self.cls[rows[:, 0]]
        by = np.argsort(cls, kind="stable")
        edges = np.searchsorted(cls[by], np.arange(self.n_classes + 1))
        for c in range(self.n_classes):
            for i in range(edges[c], edges[c + 1], BATCH):
                mine = by[i : min(i + BATCH, edges[c + 1])]
                q = sum(self.r[rows[mine, 1 + k]] @ self.c[k] for k in range(CONTEXT))
                a, z = self.begin[c], self.begin[c + 1]
                words = q @ self.t[a:z].T + self.b[a:z]
                classes = q @ self.k.T + self.kb
                out[mine] = words[np.arange(len(mine)), self.place[rows[mine, 0]] - a] - _log_sum(words) + classes[:, c] - _log_sum(classes)
        return out / np.log(10.0)


def _log_sum(x: np.ndarray) -> np.ndarray:
    most = x.max(1)
    return most + np.log(np.exp(x - most[:, None]).sum(1))


def distinct_scores(model: LogBilinear, rows: np.ndarray) -> np.ndarray:
    """`log10` of each row, computed once for equal ones."""
    name = rows[:, 0].astype(np.int64)
    for i in range(CONTEXT):
        if len(name) and int(name.max()) > (1 << 62) // model.size:
            name = np.unique(name, return_inverse=True)[1]
        name = name * model.size + rows[:, 1 + i]
    _, first, inverse = np.unique(name, return_index=True, return_inverse=True)
    return model.log10(rows[first])[inverse]


_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def log_bilinear_scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", steps: int | None = None) -> DataFrame:
    """A row for each row of `docs`; see _OUT and the module. A-Z count as a-z, and every text ends with one end token.

    Null and empty texts consist of the end token. A null id counts as the empty text in the fold and is given back as null; rows with
    equal ids or texts are rows of their own. If no document is for training, every count is 0 and train_tokens is 0. Empty table: no
    rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    blocks = written(encode_blocks(docs, id_column=id_column, text_column=text_column), "lm-blocks")
    total = blocks.agg(F.sum("n_train"), F.sum(F.octet_length("tokens"))).first()
    words = n_words(total[0] or 0)
    buckets = max(-(-(total[1] or 0) // RANGE_BYTES), shuffle_partitions(spark))
    counts = written(exchange_counts(blocks, buckets, words), "lm-counts")
    vocabulary = spark.sparkContext.broadcast(Vocabulary(counts.filter("block IS NULL").select("totals", "top").orderBy("bucket").collect(), words))
    model = spark.sparkContext.broadcast(trained(blocks, vocabulary, steps))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, m = vocabulary.value, model.value
        whole = np.log10(v.train_tokens + v.distinct + 1.0)
        for b in batches:
            for r in rows_of(b):
                c = np.concatenate([np.frombuffer(x["totals"], "<u8") for x in sorted(r["answers"], key=lambda x: x["bucket"])])
                s = v.symbols(_unpack(r["hashes"], "<u8"), _unpack(r["classes"], np.uint8))
                own = np.log10(c + 1.0)
                within = token_shares(v, s, c)
                sizes, tokens = _unpack(r["sizes"], "<u4").astype(np.int64), _unpack(r["tokens"], "<u4")
                symbols = s[tokens]
                first = np.cumsum(sizes) - sizes
                log_p = distinct_scores(m, np.concatenate([symbols[None], contexts(symbols, sizes)]).T) + within[tokens]
                ids, valid = _unpack(r["doc_ids"], "<i8").reshape(2, -1)
                n = len(sizes)
                columns = [pa.array(ids, mask=valid == 0), pa.array(_unpack(r["held"], bool)), pa.array(sizes), pa.array(np.add.reduceat((c > 0).astype(np.int64)[tokens], first)), pa.array(np.full(n, v.train_tokens)), pa.array(np.add.reduceat(own[tokens], first) - sizes * whole), pa.array(np.add.reduceat(log_p, first))]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _OUT.split(", ")])

    answers = counts.filter("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("bucket", "totals")).alias("answers"))  # a row for each hash range
    return blocks.select("block", "doc_ids", "held", "sizes", "tokens", "hashes", "classes").join(answers, "block").mapInArrow(run, _OUT)
