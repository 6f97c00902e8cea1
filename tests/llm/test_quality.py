"""The isolation forest's verdicts on rows that its threshold was not fitted on."""

import random

import numpy as np

from pagewright.llm import op04_isolation_forest as O4


def text(rng, bad):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(60, 200))]
    if bad == "symbols":
        words = [w + rng.choice(["###", "$$$", "&&"]) for w in words]
    if bad == "capitals":
        words = [w.upper() + "!!" for w in words]
    return " ".join(words) + "."


def test_held_out_verdicts(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        bad = rng.choice(["symbols", "capitals"]) if i % 9 == 0 else ""
        rows.append((i, text(rng, bad)))
        if i < 450:
            labels.append((i, int(not bad)))
    got = {r["doc_id"]: r["kept"] for r in O4.judge(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    good, bad = [i for i in range(450, 900) if i % 9], [i for i in range(450, 900) if i % 9 == 0]
    assert sum(got[i] for i in good) >= 0.96 * len(good) and sum(not got[i] for i in bad) >= 0.9 * len(bad)


def test_path_lengths_against_walking_the_trees():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    x[0] = 9
    score = O4.Forest(x).score(x)
    assert score.shape == (400,) and (score > 0).all() and (score < 1).all() and score.argmax() == 0


def test_threshold_is_of_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(O4, "LABELLED_ROWS", 10)
    rng = random.Random(6)
    rows = [(i, text(rng, "symbols" if i % 4 == 0 else "")) for i in range(300)]
    table = O4._table(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").cache()
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i, _ in rows], "doc_id long, quality int")
    forest, threshold = O4.fit(table, labels)
    names = [*O4.BASE, *O4.EXTRA]
    got = table.toPandas()
    s = got[names].to_numpy()
    ok = ~O4.base_failed(s)
    bins, good = O4.bins_of(forest.score(O4.features(s[ok]))), (got["doc_id"].to_numpy() % 4 > 0)[ok]
    value = {c: (bins[good] <= c).mean() + (bins[~good] > c).mean() for c in np.unique(bins) if (bins[good] <= c).mean() >= O4.KEEP_GOOD}
    best = min(c for c in value if value[c] == max(value.values()))
    later = bins[bins > best]
    assert threshold == (best + (later.min() - 1 if len(later) else best)) / (2 * O4.BINS)
    table.unpersist()
