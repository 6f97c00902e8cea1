"""Packing against the rule itself written plainly, and against the best of all packings for a few pieces."""

import random

import numpy as np

from pagewright.llm import op07_best_fit as O7

SIZES = (8, 16, 32)


def plain(lengths, sizes, cost):
    """Best fit by looking at every bin, and a new bin's size by filling each size from the list of what is left."""
    left = sorted(lengths, reverse=True)
    bins = []
    while left:
        n = left.pop(0)
        rooms = [(b["size"] - b["used"], -k) for k, b in enumerate(bins) if b["size"] - b["used"] >= n]
        if rooms:
            bins[-min(rooms)[1]]["used"] += n
            continue

        def placed(size, n=n):
            room, got = size - n, n
            for x in left:
                if x <= room:
                    room, got = room - x, got + x
            return got

        size = min((c for c in sizes if c >= n), key=lambda c: (cost(c) / placed(c), c))
        bins.append({"size": size, "used": n})
    return sorted(min(c for c in sizes if c >= b["used"]) for b in bins)


def best(lengths, sizes, cost):
    """The least cost of all ways to part the pieces."""
    least = [float("inf")]

    def go(k, bins, spent):
        if k == len(lengths):
            least[0] = min(least[0], sum(cost(min(c for c in sizes if c >= b)) for b in bins))
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= max(sizes):
                bins[i] += lengths[k]
                go(k + 1, bins, spent)
                bins[i] -= lengths[k]
        go(k + 1, [*bins, lengths[k]], spent)

    go(0, [], 0)
    return least[0]


def test_pack_is_the_rule():
    rng = random.Random(1)
    for _ in range(200):
        lengths = [rng.randint(1, 32) for _ in range(rng.randint(1, 40))]
        bins, offset, final = O7.pack(lengths, SIZES)
        assert sorted(final.tolist()) == plain(lengths, SIZES, O7.linear_cost)
        used = np.bincount(bins, lengths)
        assert (used <= final).all()
        for b in range(len(final)):
            mine = sorted((o, n) for o, n, x in zip(offset, lengths, bins, strict=True) if x == b)
            assert all(o + n == p for (o, n), (p, _) in zip(mine, mine[1:])) and mine[0][0] == 0


def test_cost_is_near_the_best():
    rng, mine, least = random.Random(2), 0.0, 0.0
    for _ in range(60):
        lengths = [rng.randint(1, 32) for _ in range(rng.randint(1, 7))]
        got, want = sum(map(O7.linear_cost, O7.pack(lengths, SIZES)[2].tolist())), best(lengths, SIZES, O7.linear_cost)
        assert want <= got <= 1.7 * want
        mine, least = mine + got, least + want
    assert mine <= 1.1 * least


def test_null_and_equal_ids_are_dealt_over_shards(spark, monkeypatch):
    monkeypatch.setattr(O7, "SHARD_ROWS", 10)
    rows = [(None if i % 2 else 7, "w " * (i % 50)) for i in range(200)]
    got = O7.best_fit(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert got["n_tokens"].sum() == sum(i % 50 + 1 for i in range(200))
    assert (got["bin_id"] // (1 << 32)).value_counts().max() < 40
