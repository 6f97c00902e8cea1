"""Each operator against brute force on a small table with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import kernels as K
from pagewright.llm import op01_token_planes as O1
from pagewright.llm import op02_scaled_sketch as O2
from pagewright.llm import op03_toxicity as O3
from pagewright.llm import op04_isolation_forest as O4
from pagewright.llm import op05_line_winnowing as O5
from pagewright.llm import op06_suffix_dedup as O6
from pagewright.llm import op07_best_fit as O7
from pagewright.llm import op08_mixing as O8
from pagewright.llm import op09_jaccard_join as O9
from pagewright.llm import op10_log_bilinear as O10
from pagewright.llm.common import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def corpus():
    rng = random.Random(5)
    bag = [f"w{i}" for i in range(60)] + ["été", "Größe", "the", "of", "idiot"]
    text = lambda n: " ".join(rng.choice(bag) for _ in range(n))
    passage = "\n".join(text(30) for _ in range(3))
    base = text(120)
    near = base.split()
    near[60] = "changed"
    rows = [(1, text(40), "b"), (2, base, "a"), (3, base, None), (4, " ".join(near), "a"), (5, None, "a"), (6, "", None), (7, " \n\t ", "b"), (8, "one", "a"), (9, passage + "\n" + text(50), "a"), (10, text(20) + "\n" + passage, "c"), (10, text(8), "c"), (11, text(3000), "a"), (11, text(12), None), (None, base, "a"), (12, "x\x1cy é", "b")]
    return [(i, t, s, "clash", 7) for i, t, s in rows] + [(2, base, "a", "clash", 7)]


SCHEMA = "doc_id long, text string, source string, `key` string, n long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_and_hashes():
    import pyarrow as pa

    texts = [t for _, t, *_ in corpus()]
    for limit in (50, 1 << 20):
        for i, j, t in K.blocks(pa.array(texts), limit):
            s, e, d = K.words(t)
            for x in range(j - i):
                assert [t.data[a:b].tobytes().decode() for a, b, z in zip(s, e, d, strict=True) if z == x] == WORD.findall(texts[i + x] or "")


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    counts = [0, 5, 1000, 1, 0, 77]
    ids = rng.integers(0, 49408, sum(counts)).astype("<u2")
    s = O1.Shard(O1.encode_shard(range(6), counts, ids, kind, block=128))
    assert (s.read_all() == ids).all() and s.counts.tolist() == counts
    ends = np.cumsum(counts)
    for i, n in enumerate(counts):
        assert (s.read_document(i) == ids[ends[i] - n : ends[i]]).all()
    with pytest.raises(ValueError):
        O1.Shard(b"x" * 100)


def test_op1(docs, empty):
    path = "/opt/tokenizers/word_bpe_49k.json"
    pytest.importorskip("tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    got = O1.token_planes(docs, path).collect()
    rows = sorted(corpus(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [1]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda x: x[1]) == want
    assert O1.token_planes(empty, path).count() == 0


def test_op2(docs, empty):
    got = O2.fingerprints(docs).collect()
    rows = sorted(corpus(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = Counter()
    for a, b in zip(rows, rows[1:] + rows[:1], strict=True):
        t, u = a[1] or "", b[1] or ""
        h = len(t) // 2
        want[a[0], len(t), hashlib.sha256((t[: len(t) - h] + u[:h]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    same = {r["fingerprint"] for r in got if r["doc_id"] in (2, 3, None)}
    assert len(same) == 1 and all(0 <= r["near_edited"] <= 1 for r in got)
    a = O2.decode(next(iter(same)))
    assert O2.encode(a) == next(iter(same)) and (O2.merge(a[:3], a[3:]) == a).all()
    assert O2.fingerprints(empty).count() == 0


def test_op3(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    train = spark.createDataFrame([(i, f"text number {'idiot' if i % 4 == 0 else 'fine'} here") for i in range(400)] + [(None, None), (400, "1d10t or IDIOOOT"), (400, "i d i o t"), (401, "")], "doc_id long, text string")
    got = {(r["doc_id"], r["predicted"], r["held_out"]) for r in O3.score(train, labels).collect()}
    assert all(p == int(i % 4 == 0) for i, p, _ in got if i is not None and i < 400)
    assert {p for i, p, _ in got if i in (None, 401)} == {0}
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, h in got if i is not None)
    assert O3.reject(train, labels).count() == O3.score(train, labels).filter("predicted = 0").count()
    assert O3.score(empty, labels.limit(0)).count() == 0
    model = O3.character_model(train)
    assert O3.Restorer(model).words("plain words stay, as they are") == {"plain", "words", "stay", "as", "they", "are"}


def test_op4(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (8, 0), (None, 1)], "doc_id long, quality int")
    got = O4.judge(docs, labels).collect()

    def stats(t):
        w, seen, dup = WORD.findall(t or ""), set(), 0
        for x in (t or "").split("\n"):
            if WORD.search(x):
                dup += x in seen
                seen.add(x)
        runs = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        rep = {k for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
        return len(w), sum(map(len, w)), sum(map((t or "").count, "#*$%&|<>")), dup, len(rep)

    assert Counter(tuple(r)[:6] for r in got) == Counter((r[0], *stats(r[1])) for r in corpus())
    assert all(r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) and not (r["base_failed"] and r["kept"]) for r in got)
    assert O4.judge(empty, labels).count() == 0


def test_op4_trees_have_rows_of_their_own(monkeypatch):
    grown = []
    monkeypatch.setattr(O4.Forest, "_grow", lambda self, x, rng: grown.append(x))
    O4.Forest(np.arange(O4.TREES * O4.TREE_ROWS + 100.0)[:, None])
    assert len(np.unique(np.concatenate(grown))) == O4.TREES * O4.TREE_ROWS


def test_op4_threshold_does_not_depend_on_row_order(spark, monkeypatch):
    monkeypatch.setattr(O4, "LABELLED_ROWS", 10)
    rng = random.Random(4)
    rows = [(i % 10, "".join(rng.choice("abc DE#*.! ") for _ in range(rng.randint(120, 900)))) for i in range(400)]
    table = written(O4._table(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "doc_id", "text"), "test")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    assert len({O4.fit(t, labels)[1] for t in (table, table.orderBy("n_words"), table.orderBy(F.desc("n_symbols")), table.repartition(5))}) == 1


def test_op5(spark, docs, empty):
    d = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(corpus())], SCHEMA)
    got = [r["text"] for r in O5.deduplicate(d).orderBy("doc_id").collect()]
    assert got == O5.brute_force([r[1] for r in corpus()])
    assert set(docs.columns) <= set(O5.deduplicate(docs).columns) and O5.deduplicate(docs).count() == len(corpus())
    assert O5.deduplicate(empty).count() == 0


def test_op5_broken_passage(spark):
    """A passage of 54 words that begins and ends inside lines: its whole line in the middle, of 20 words, goes."""
    word = iter(f"u{i}" for i in range(1000))
    text = lambda n: " ".join(next(word) for _ in range(n))
    start, middle, end = text(17), text(20), text(17)
    rows = [(i, f"{text(9)} {start}\n{middle}\n{end} {text(9)}") for i in range(3)]
    got = O5.digest(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in got] == [0, 1, 1]
    assert [r["kept_text"] for r in got[1:]] == ["\n".join(t.split("\n")[::2]) for _, t in rows[1:]]


def test_op6(docs, empty):
    got = Counter(tuple(r) for r in O6.deduplicate(docs).collect())
    want = O6.brute_force([r[0] for r in corpus()], [r[1] for r in corpus()])
    assert got == Counter((r[0], *x) for r, x in zip(corpus(), want, strict=True))
    assert O6.deduplicate(empty).count() == 0


def test_op7(docs, empty):
    got = O7.best_fit(docs, capacities=(64, 256, 512)).toPandas()
    assert got["n_tokens"].sum() == sum(len(WORD.findall(r[1] or "")) + 1 for r in corpus())
    for _, b in got.groupby("bin_id"):
        b = b.sort_values("bin_offset")
        ends = (b["bin_offset"] + b["n_tokens"]).tolist()
        assert b["bin_offset"].tolist() == [0, *ends[:-1]] and ends[-1] == b["bin_used"].iloc[0] <= b["bin_capacity"].iloc[0]
        assert b["bin_capacity"].iloc[0] == min(c for c in (64, 256, 512) if c >= ends[-1])
    assert O7.best_fit(empty).count() == 0


def test_op7_filling_passes_used_up_lengths():
    assert O7._Lengths(np.array([5, 4, 3, 2, 1]), 20).fill(20) == 15
    assert O7._Lengths(np.array([9, 7, 7, 4, 3, 2]), 40).fill(26) == 26
    for seed in range(50):
        x = np.random.default_rng(seed).integers(1, 60, 30)
        room, want = 200, 0
        for n in sorted(x.tolist(), reverse=True):
            if n <= room - want:
                want += n
        assert O7._Lengths(x, 200).fill(room) == want


def test_op8(docs, empty):
    got = O8.mix(docs).toPandas()
    assert len(got) == len(corpus()) and (got["taken"] <= 2 * got["size"]).all()
    for _, g in got.fillna({"source": "~"}).groupby("source"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) < 1 and g["target"].iloc[0] <= 2 * g["source_size"].iloc[0]
    assert math.isclose(got.drop_duplicates("source")["target"].sum(), 1.5 * got["size"].sum())
    assert set(O8.mixed_documents(docs).columns) == set(docs.columns)
    assert O8.mix(empty).count() == 0


def test_op9(docs, empty):
    rows = corpus()
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []) for w in (words(r[1]) for r in rows)]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min((r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None), default=None) for g in group}
    want = Counter((r[0], len(s), least[g] if s else r[0]) for r, s, g in zip(rows, sets, group, strict=True))
    assert Counter(tuple(r) for r in O9.jaccard_components(docs).collect()) == want
    assert O9.jaccard_components(empty).count() == 0


def test_op9_extended_copies(spark):
    rng = random.Random(9)
    rows = []
    for group in range(10):
        text = [f"v{rng.randrange(10**6)}" for _ in range(150)]
        longer = [*text, *(f"x{rng.randrange(10**6)}" for _ in range(48))]  # 146 shingles of 194 are common
        rows += [(100 * group + i, " ".join(text)) for i in range(30)] + [(100 * group + 30, " ".join(longer))]
    got = O9.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter((i, i // 100 * 100) for i, _ in rows)


def test_op10(docs, empty):
    rows = corpus()
    tokens = [[*words(r[1]), None] for r in rows]
    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 == 2 for r in rows]
    c = Counter(x for t, h in zip(tokens, held, strict=True) if not h for x in t)
    n, v = sum(c.values()), len(c)
    got = O10.log_bilinear_scores(docs, steps=20).collect()
    want = Counter((r[0], h, len(t), sum(c[x] > 0 for x in t), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), 6)) for r, t, h in zip(rows, tokens, held, strict=True))
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert O10.log_bilinear_scores(empty, steps=1).count() == 0


