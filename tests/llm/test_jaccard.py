"""The Jaccard join against brute force: size ratios, frequent and rare shingles, dense groups of near copies, shared passages."""

import random
from collections import Counter

import pytest

from pagewright.llm import op09_jaccard_join as O9


def components(texts):
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []) for w in (t.lower().split() for t in texts)]
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and group[i] != group[j] and 100 * len(a & b) >= 75 * len(a | b):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return {(i, len(s), g) for i, (s, g) in enumerate(zip(sets, group, strict=True))}


def found(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {tuple(r) for r in O9.jaccard_components(d).collect()}


def test_copies_and_one_extension(spark):
    """20 copies of 104 words, and one that 30 new words follow: 100 shingles of 130 are common."""
    rng = random.Random(1)
    texts = []
    for _ in range(40):
        text = [f"v{rng.randrange(10**6)}" for _ in range(104)]
        texts += [" ".join(text)] * 20 + [" ".join([*text, *(f"x{rng.randrange(10**6)}" for _ in range(30))])]
    assert found(spark, texts) == components(texts)


@pytest.mark.parametrize("seed", range(3))
def test_ratios_and_frequencies(spark, seed):
    rng = random.Random(seed)
    texts = []
    common = [[f"c{rng.randrange(10**6)}" for _ in range(rng.choice((8, 30, 60)))] for _ in range(4)]
    for _ in range(25):
        base = [f"v{rng.randrange(10**6)}" for _ in range(rng.choice((3, 6, 20, 80, 200)))]
        if rng.random() < 0.5:
            base += rng.choice(common) * rng.choice((1, 2))
        for _ in range(rng.choice((1, 2, 12))):
            t = list(base)
            kind = rng.randrange(4)
            if kind == 0:  # words in other places are changed
                for _ in range(rng.randrange(1, 4)):
                    t[rng.randrange(len(t))] = f"x{rng.randrange(10**6)}"
            elif kind == 1:  # new words follow or lead, to ratios round the limit
                more = [f"x{rng.randrange(10**6)}" for _ in range(int(len(base) * rng.uniform(0.2, 0.4)))]
                t = t + more if rng.random() < 0.5 else more + t
            elif kind == 2:  # a part goes
                t = t[: max(1, int(len(t) * rng.uniform(0.7, 1)))]
            texts += [" ".join(t)] * rng.choice((1, 1, 1, 5))
    assert found(spark, texts) == components(texts)


def test_group_of_near_copies(spark):
    """One text edited in other places each time: about half of the pairs are linked, and outliers with few or none."""
    rng = random.Random(7)
    base = [f"v{i}" for i in range(150)]
    texts = []
    for _ in range(250):
        t = list(base)
        for _ in range(rng.choice((1, 3, 4, 5, 6, 7))):
            t[rng.randrange(len(t))] = f"x{rng.randrange(40)}"
        texts.append(" ".join(t))
    assert found(spark, texts) == components(texts)


def test_clashing_names_and_repeats(spark):
    rows = [(1, "a b c d e f g", 5, 6, 7), (1, "a b c d e f g", 5, 6, 7), (None, "a b c d e f g", 5, 6, 7), (None, None, 5, 6, 7), (4, "", 5, 6, 7)]
    d = spark.createDataFrame(rows, "doc_id long, text string, __row long, component_id long, label long")
    got = O9.one_of_each(d)
    assert got.columns == d.columns
    assert Counter(map(tuple, got.collect())) == Counter([rows[0], rows[3], rows[4]])


def test_few_links_are_merged_in_one_go_and_many_in_rounds(spark, monkeypatch):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(-150, 150)]
    links = chain + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(180)] + [(9000, 5000 + i) for i in range(40)]
    near = {}
    for a, b in links:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want, left = set(), set(near)
    while left:
        todo, group = [left.pop()], set()
        while todo:
            x = todo.pop()
            group.add(x)
            todo += near[x] - group
        left -= group
        want.add(frozenset(group))
    made, written = [], O9.written
    monkeypatch.setattr(O9, "written", lambda df, name: made.append(name) or written(df, name))
    table = spark.createDataFrame(links, "a long, b long")

    def groups():
        by = {}
        for r in O9.components(table).collect():
            by.setdefault(r["label"], []).append(r["key"])
        assert all(label in keys and len(keys) == len(set(keys)) for label, keys in by.items())
        return {frozenset(x) for x in by.values()}

    assert groups() == want
    assert len(made) == 2  # not some tables in each of many rounds
    monkeypatch.setattr(O9, "DRIVER_LINKS", 20)
    assert groups() == want
    assert len(made) > 4
    assert O9.components(table.limit(0)).count() == 0
