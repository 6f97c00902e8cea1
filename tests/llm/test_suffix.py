"""External induced sorting against brute force, and the suffix operator with queues, shards and ranges far larger than its memory."""

import random
from collections import Counter

import numpy as np
import pytest

from pagewright.llm import induced_sorting as I
from pagewright.llm import op06_suffix_dedup as O6


@pytest.mark.parametrize("depth", [5, 50, 10**6])
@pytest.mark.parametrize("memory", [64, 1 << 20])
def test_order_and_common_prefixes(monkeypatch, depth, memory):
    monkeypatch.setattr(I, "TAKE", 7)
    rng, told = np.random.default_rng(3), {}
    for k in range(150):
        t = np.append(rng.integers(1, 3 + k % 4, rng.integers(1, 70)), 0).astype(np.uint8)
        order, common = I.suffix_order(t, depth, memory, told)
        head = [t[i : i + depth].tobytes() for i in order]
        assert sorted(order.tolist()) == list(range(len(t))) and head == sorted(head)
        for a, b, n in zip(head[:-1], head[1:], common[1:].tolist(), strict=True):
            assert a[:n] == b[:n] and (n == depth or a[n : n + 1] != b[n : n + 1])
    assert told["levels"] > 0 and (told["spilled"] > 0) == (memory == 64)


def test_sort_is_external(monkeypatch):
    """A text of many times the memory: arrays are files, queues go to disk, and the order is right."""
    rng, told = np.random.default_rng(1), {}
    t = np.append(rng.integers(1, 5, 60_000), 0).astype(np.uint8)
    order, common = I.suffix_order(t, 50, 2048, told)
    head = [t[i : i + 50].tobytes() for i in order]
    assert head == sorted(head) and told["spilled"] > len(t)
    assert all((a == b) == (n == 50) for a, b, n in zip(head[:-1], head[1:], common[1:].tolist(), strict=True))


def test_ranges_equal_brute_force(spark, monkeypatch):
    for name, value in (("SHARD_BYTES", 500), ("SORT_MEMORY", 256), ("BLOCK_BYTES", 700), ("RANGE_BYTES", 2000)):
        monkeypatch.setattr(O6, name, value)
    rng = random.Random(2)
    word = lambda: rng.choice(["ab", "abc", "été", "x", "yz", "1", "the", "of ", "\x00\x01", "\x01"])
    passage = [" ".join(word() for _ in range(rng.choice((12, 20, 60)))) for _ in range(4)]
    rows = []
    for i in range(60):
        t = " ".join(rng.choice(passage) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randrange(30))) for _ in range(rng.randrange(5)))
        rows.append((rng.choice([i, i, 7, None]), rng.choice([t, t, t, None, "", "a" * 120])))
    got = Counter(tuple(r) for r in O6.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    want = O6.brute_force([r[0] for r in rows], [r[1] for r in rows])
    assert got == Counter((r[0], *x) for r, x in zip(rows, want, strict=True))
