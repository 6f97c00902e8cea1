"""The noisy channel against all paths of short pieces, scores under other partitionings, and held-out accuracy."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pagewright.llm import op03_toxicity as O3

WORDS = ["idiot", "stupid", "kill", "love", "you", "a", "fine", "day", "the", "text", "moron", "trash", "under", "odd", "book", "stool"]


def model():
    rng = random.Random(1)
    return O3.CharModel(O3.trigram_counts(pa.array([" ".join(rng.choice(WORDS) for _ in range(40)) for _ in range(200)])))


def all_paths(piece, m, spelt):
    """The best reading by trying every choice for every character."""
    choices = []
    for i, ch in enumerate(piece):
        repeated = i > 0 and piece[i - 1] == ch
        if ch in O3._LETTERS:
            c = [(ch, 0.0)]
            if repeated:
                c.append(("", O3.REPEAT if i > 1 and piece[i - 2] == ch or piece[i + 1 : i + 2] == ch else O3.DOUBLE))
        else:
            gap = spelt and ch == " "
            c = [(x, O3.SUBSTITUTE) for x in O3.LEET.get(ch, "")]
            if 0 < i < len(piece) - 1 and ch in O3._SPACERS or repeated and i > 1 and piece[i - 2] == ch:
                c.append(("", O3.CLOSE if gap else O3.DROP))
            c.append((" ", O3.PART if gap else 0.0 if ch == " " else O3.KEEP + O3.SIGN))
        choices.append(c)
    best = (-1e9, "")
    for path in itertools.product(*choices):
        a = b = 0
        score = 0.0
        for ch, cost in [*path, (" ", 0.0)]:
            score += cost
            c = O3._LETTERS.get(ch, 0)
            if ch and (c or b):
                score += m.log[a][b][c]
                a, b = b, c
            elif ch:
                a, b = 0, 0
        best = max(best, (score, "".join(ch for ch, _ in path).strip()))
    return best[1]


def test_viterbi_equals_all_paths():
    m, rng = model(), random.Random(2)
    for _ in range(150):
        piece = "".join(rng.choice("idotl10!.-*5$ ") for _ in range(rng.randrange(3, 9)))
        for spelt in (False, True):
            assert O3.viterbi(piece, m, spelt).split() == all_paths(piece, m, spelt).split(), piece


def test_restores_what_writers_do():
    r = O3.Restorer(model())
    for written, word in (("1d10t", "idiot"), ("1D10T!!", "idiot"), ("ki11", "kill"), ("$tupid", "stupid"), ("IDIOOOOT", "idiot"), ("i d i o t", "idiot"), ("i.d.i.o.t", "idiot"), ("m0r0n###", "moron"), ("tr@sh", "trash"), ("st00l", "stool")):
        assert word in r.words(f"the {written} day"), written
    assert {"love", "you"} <= r.words("l o v e   y o u")
    assert len(r.words("a b " * 5000)) > 0  # a long spelt run takes bounded memory


@pytest.mark.parametrize("limit", [60, 1 << 20])
def test_texts_count_by_themselves(limit, monkeypatch):
    monkeypatch.setattr(O3.K, "blocks", lambda c, _=None, f=O3.K.blocks: f(c, limit))
    texts = ["", "  ab", "Été, cd ", None, "x", "..", "a-b--c.", "ß"]
    whole = O3.trigram_counts(pa.array(texts, pa.string()))
    assert (whole == sum(O3.trigram_counts(pa.array([t], pa.string())) for t in texts)).all()
    one = O3.trigram_counts(pa.array(["ab"]))
    at = [(i // O3.CLASSES**2, i // O3.CLASSES % O3.CLASSES, i % O3.CLASSES) for i in np.flatnonzero(one)]
    assert sorted(at) == [(0, 0, 1), (0, 1, 2), (1, 2, 0)]


def test_partitioning_and_held_out_accuracy(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        toxic = int(rng.random() < 0.2)
        words = [rng.choice(["fine", "day", "the", "text", "under", "book", "love", "you"]) for _ in range(30)]
        if toxic:
            for _ in range(3):
                words[rng.randrange(30)] = rng.choice(["idiot", "1d10t", "i d i o t", "m0ron", "stupid###", "STUUUPID"])
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs, y = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in O3.score(docs, y).collect()}
    again = {r["doc_id"]: r["score"] for r in O3.score(docs.repartition(5), y.repartition(3)).collect()}
    assert all(got[i]["score"] == again[i] for i in got)
    held = [(got[i]["predicted"], t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(p and t for p, t in held) >= 0.85 * sum(t for _, t in held) and not any(p and not t for p, t in held)
