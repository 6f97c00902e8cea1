"""Sketches against the sets of shingles themselves."""

import random
import re

import numpy as np
import pyarrow as pa

from pagewright.llm import kernels as K
from pagewright.llm import op02_scaled_sketch as O2

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)} if w else set()


def hash_of(shingle):
    """One shingle's hash, by a text that consists of it alone."""
    (_, _, t), = K.blocks(pa.array([shingle]))
    s, e, doc = K.words(t)
    h, _ = K.shingles(K.span_hashes(t.data, s, e), doc, 1)
    return int(h[0]) >> (64 - 8 * O2.HASH_BYTES)


def sketch(text):
    h = sorted({hash_of(x) for x in shingles(text)})
    return [x for x in h if x < O2.cut(O2.SCALE)] or h[:1]


def test_every_column(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(25):
        t = list(base)
        for _ in range(rng.randrange(40)):
            t[rng.randrange(len(t))] = f"x{rng.randrange(99)}"
        rows.append((i, rng.choice([" ".join(t), " ".join(t), " ".join(t[:3]), None, " \n"])))
    got = {r["doc_id"]: r for r in O2.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, after = text or "", after or ""
        new = O2.edited(text, after)
        mine, other, next_ = (set(sketch(x)) for x in (text, new, after))
        assert O2.decode(got[i]["fingerprint"]).tolist() == sorted(mine) and O2.decode(got[i]["edited_fingerprint"]).tolist() == sorted(other)
        for name, x in (("edited", other), ("next", next_)):
            near = len(mine & x) / len(mine | x) if mine and x else float(len(mine) == len(x))
            held = len(mine & x) / min(len(mine), len(x)) if mine and x else float(len(mine) == len(x))
            assert abs(got[i][f"near_{name}"] - near) < 1e-12 and abs(got[i][f"contained_{name}"] - held) < 1e-12


def test_estimates_are_near_the_truth():
    a, b = " ".join(f"w{i}" for i in range(8000)), " ".join(f"w{i}" for i in range(2000, 12000))
    x, y = O2.sketches(pa.array([a, b]))
    near, mine, _ = O2.compare(x, y)
    assert abs(near - 5996 / 11996) < 0.06 and abs(mine - 0.75) < 0.06
    assert np.array_equal(O2.merge(x, y), np.union1d(x, y))
