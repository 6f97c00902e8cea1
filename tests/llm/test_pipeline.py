"""The pipeline's stages and `run` on small tables: what each must keep, drop and return, with nulls, repeats and an empty table."""

import random
from collections import Counter

import pytest

import corpus_pipeline as P
from pagewright.llm import op05_line_winnowing as O5
from pagewright.llm import op09_jaccard_join as O9

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `__row` int"


def corpus():
    rng = random.Random(3)
    text = lambda n, tag: " ".join(f"{tag}{rng.randrange(400)}" for _ in range(n))
    rows = []
    for i in range(120):
        body = "\n".join(text(25, "v") for _ in range(4))
        if i % 4 == 0:
            body += " idiot 1d10t and you moron stupid"
        rows.append((i, body, "en", ["a", "b", None][i % 3], len(body), 1))
    rows += [(200 + i, rows[i][1], "en", "a", 1, 1) for i in (1, 2, 3)]  # copies
    rows += [(300 + i, rows[i][1].replace("v1 ", "x "), "en", "a", 1, 1) for i in (5, 6, 7)]  # near copies
    shared = text(60, "shared")
    rows += [(400 + i, text(30, "u") + "\n" + shared + "\n" + text(30, "u"), "en", "b", 1, 1) for i in range(4)]
    return [*rows, (None, None, None, None, None, None), (500, "", None, None, 0, 1), (501, None, "en", "a", None, 1), (1, rows[1][1], "en", "a", 1, 1)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id long, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


def test_stages_and_their_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "mixing", "packing"]


def test_toxicity_rejects_what_is_toxic_alone(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = P.reject_toxic(spark, docs, folder)
    assert got.columns == docs.columns
    kept = Counter(r["doc_id"] for r in got.collect())
    assert not [i for i in range(0, 120, 4) if kept[i]] and all(kept[r[0]] for r in corpus() if not (r[0] is not None and r[0] < 120 and r[0] % 4 == 0))


def test_line_dedup_equals_brute_force(spark, folder):
    rows = sorted(corpus()[:-1], key=lambda r: (r[0] is not None, r[0] or 0))
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    got = {r["doc_id"]: r for r in P.deduplicate_lines(spark, docs, folder).collect()}
    for r, text in zip(rows, O5.brute_force([r[1] for r in rows]), strict=True):
        assert got[r[0]]["text"] == text and got[r[0]]["n_chars"] == (None if text is None else len(text)) and got[r[0]]["__row"] == r[5]


def test_one_of_each_group_stays(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = P.one_of_near_copies(spark, docs, folder)
    assert got.columns == docs.columns
    groups = {r["doc_id"]: r["component_id"] for r in O9.jaccard_components(docs).collect() if r["doc_id"] is not None}
    kept = Counter(r["doc_id"] for r in got.collect())
    assert all(kept[i] == 1 for i in groups.values()) and not any(kept[i] for i, c in groups.items() if i != c)


def test_mixing_repeats_whole_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = P.mix_sources(spark, docs, folder)
    assert got.columns == docs.columns
    often = Counter((r["doc_id"], r["text"]) for r in got.collect())
    there = Counter((r[0], r[1]) for r in corpus())
    assert all(n <= 2 * there[k] for k, n in often.items()) and not any(not t for _, t in often)


def test_run(spark, folder):
    got = P.run(spark, folder).toPandas()
    assert not set(got["doc_id"].dropna()) & set(range(0, 120, 4))
    assert not {201, 202, 203} & set(got["doc_id"])
    for _, b in got.groupby("bin_id"):
        b = b.sort_values("bin_offset")
        ends = (b["bin_offset"] + b["n_tokens"]).tolist()
        assert b["bin_offset"].tolist() == [0, *ends[:-1]] and ends[-1] <= b["bin_capacity"].iloc[0]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
