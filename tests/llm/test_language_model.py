"""The log-bilinear model against a direct softmax, its normalisation over tokens, its growth, and its held-out gain."""

import random
import zlib
from types import SimpleNamespace

import numpy as np

from pagewright.llm import op10_log_bilinear as O10


def trained(size=37, n=4000, steps=200):
    rng = np.random.default_rng(1)
    w = rng.integers(0, size, (n, O10.CONTEXT + 1))
    w[:, 0] = np.where(rng.random(n) < 0.8, (w[:, 1] + 1) % size, w[:, 0])
    return O10.LogBilinear(w, size, steps), w


def test_scores_equal_a_direct_softmax():
    m, samples = trained()
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    rows = samples[:200]
    want = []
    for w, *before in rows:
        q = sum(m.r[b].astype(np.float64) @ m.c[i] for i, b in enumerate(before))
        c = m.cls[w]
        mine = m.order[m.begin[c] : m.begin[c + 1]]
        inside = softmax(np.array([q @ m.t[m.place[x]] + m.b[m.place[x]] for x in mine]))
        want.append(np.log10(softmax(m.k @ q + m.kb)[c]) + np.log10(inside[list(mine).index(w)]))
    assert np.allclose(O10.distinct_scores(m, rows), want, atol=1e-4)


def test_normalised_over_symbols_and_learned():
    m, samples = trained()
    for before in samples[:20, 1:]:
        rows = np.concatenate([np.arange(m.size)[:, None], np.tile(before, (m.size, 1))], axis=1)
        assert abs((10.0 ** m.log10(rows)).sum() - 1) < 1e-4
    assert m.log10(samples).mean() > np.log10(1 / m.size) + 0.4
    assert np.bincount(m.cls).max() - np.bincount(m.cls).min() <= 2


def test_normalised_over_tokens(spark, monkeypatch):
    monkeypatch.setattr(O10, "WORDS", 16)
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, " ".join(f"w{int(rng.expovariate(0.05))}" for _ in range(60))) for i in range(80)], "doc_id long, text string")
    blocks = O10.encode_blocks(docs).cache()
    counts = O10.exchange_counts(blocks, 3, O10.n_words(blocks.first()["n_train"])).cache()
    v = O10.Vocabulary(counts.filter("block IS NULL").select("totals", "top").collect(), 16)
    total = {}
    for r in blocks.collect():
        h = O10._unpack(r["hashes"], "<u8")
        c = np.concatenate([np.frombuffer(x["totals"], "<u8") for x in counts.filter(f"block = {r['block']}").orderBy("bucket").collect()])
        s = v.symbols(h, O10._unpack(r["classes"], np.uint8))
        for x, y, z, n in zip(h.tolist(), s.tolist(), O10.token_shares(v, s, c).tolist(), c.tolist(), strict=True):
            if n:
                total[x] = (y, 10.0**z)
    by = np.bincount([y for y, _ in total.values()], [p for _, p in total.values()], v.size)
    words = len(v.words)
    assert np.allclose(by[:words], 1)
    assert np.allclose(by[words:] + 1 / (v.rest_n + v.rest_v + 1), 1)  # what is not in training has one share
    blocks.unpersist()
    counts.unpersist()


def test_vocabulary_and_samples_grow():
    sizes = [O10.n_words(10**k) for k in range(4, 13)]
    assert sizes == sorted(sizes) and sizes[-1] > 50 * sizes[0] and all(n & (n - 1) == 0 for n in sizes)


def test_held_out_gain_and_partitioning(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        w, text = rng.randrange(40), []
        for _ in range(60):
            text.append(f"t{w}")
            w = (w * 7 + 3) % 40 if rng.random() < 0.8 else rng.randrange(40)
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = O10.log_bilinear_scores(docs).toPandas()
    held = got[got["held_out"]]
    assert set(held["doc_id"]) == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    assert held["score"].sum() / held["n_tokens"].sum() > held["base_score"].sum() / held["n_tokens"].sum() + 0.3


class Counting(O10.LogBilinear):
    """Keeps what it is trained on."""

    seen: list = []

    def learn(self, rows, rate, rng):
        self.seen.append(rows)


def test_every_training_token_is_learned_from(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 31 + j * j) % 97}" for j in range(40 + i))) for i in range(60)], "doc_id long, text string").coalesce(2)
    blocks = O10.encode_blocks(docs).cache()
    words = O10.n_words(1)
    counts = O10.exchange_counts(blocks, 3, words)
    v = SimpleNamespace(value=O10.Vocabulary(counts.filter("block IS NULL").select("totals", "top").orderBy("bucket").collect(), words))
    rows = np.concatenate([O10.training_rows(r.asDict(), v.value) for r in blocks.collect()])
    assert len(rows) == v.value.train_tokens == sum(41 + i for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2)
    assert np.array_equal(np.bincount(rows[:, 0], minlength=v.value.size), v.value.counts)
    size = v.value.size
    assert np.array_equal(O10.all_neighbours(blocks, v), O10.neighbours(rows, size))
    model = Counting.untrained(v.value.counts, O10.neighbours(rows, size))
    batch = blocks.select(*O10._TRAINING).toArrow().combine_chunks().to_batches()
    Counting.seen, weight = [], 0
    for round_ in range(3):
        (got,) = O10._round(v, SimpleNamespace(value=model), round_, 3, 2, 42)(batch)
        parts = [np.frombuffer(x, "<f8") for x in got.column("numbers").to_pylist()]
        state = np.concatenate(parts)
        weight += state[-1]
        assert np.allclose(state[:-1] / state[-1], model.state())
    order = lambda x: x[np.lexsort(x.T)]
    assert weight == 2 * len(rows)
    assert np.array_equal(order(np.concatenate(Counting.seen)), order(np.concatenate([rows, rows])))  # each token twice in two passes
    blocks.unpersist()


def test_model_is_the_mean_of_the_tasks_models(spark):
    state = np.arange(200.0)
    parts = spark.createDataFrame([(p, b, bytearray(x)) for b, w in ((5, 1), (2, 3)) for p, x in zip(range(O10.PARTS), O10._cut(b, np.append(state * b * w, w)).column("numbers").to_pylist(), strict=True)], O10._PARTS)
    got = O10.summed(parts)
    assert np.allclose(got[:-1] / got[-1], state * (5 * 1 + 2 * 3) / 4)
