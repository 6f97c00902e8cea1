"""Every query against its SQL on the smallest tables, where these are there."""

import os

import duckdb
import pytest

from pagewright.plans.catalogue import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(map(repr, df.where(df.notna(), None).values.tolist()))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"create view {f[:-8]} as select * from '{DIR}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    a, b = QUERIES[name](spark, DIR).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).limit(5).collect() is not None


def test_plans_have_no_products(spark):
    for name in ("drop_fragments", "match_summary", "missing_lines", "bbox_restore"):
        plan = QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_entry_without_the_subpackage(monkeypatch):
    import importlib.util

    import __spark_entry__

    found = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n in ("pagewright.llm", "corpus_pipeline") else found(n, *a))
    assert set(__spark_entry__.queries()) == set(QUERIES) and set(__spark_entry__.oracle_sql()) == set(SQL)


def test_fuzzy_queries_read_whole_lines(spark, tmp_path):
    """Lines whose first eight words are equal and whose tails differ."""
    tails = ["quick brown foxes jump over lazy dogs " * 4, "0123456789 " * 14, "zyxwv utsrq ponml kjihg fedcb " * 5]
    heads = "alpha beta gamma delta epsilon zeta theta iota "
    text = "\n".join(heads + t.strip() for t in tails)
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: QUERIES[name](spark, str(tmp_path)).collect()
    assert all(r["total"] == r["same"] > 400 for r in run("text_coverage"))
    assert all(len(heads) < r["likeness"] * 200 < 200 for r in run("greedy_match"))
    assert [r["seq"] for r in run("verify_draft")] == [2]
    assert run("type_breaks") and {r["seq"] for r in run("type_breaks")} == {0, 2}
    assert {r["seq"]: r["bbox"][3] - r["bbox"][1] for r in run("locate_drafts")}.keys() == {0, 1, 2}


def test_html_headings_decode_what_their_sql_does(spark, duck, tmp_path):
    heads = ["a &quot;b&quot; &amp;&amp", "&lt;c&gt &copy &amp;lt; &#39;", "d"]
    data = [(i, "", f"<article><h1>{h}</h1><p>x</p></article>") for i, h in enumerate(heads)]
    spark.createDataFrame(data, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["html_headings"](spark, str(tmp_path)).toPandas()
    with duck.cursor() as con:
        con.execute(f"create temp view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
        assert rows(got) == rows(con.execute(SQL["html_headings"]).df())
    assert 'a &quot;b&quot; &&amp' in set(got["heading"])


def test_html_strip_text_decodes_what_its_sql_does(spark, duck, tmp_path):
    texts = ["a &quot;b&quot; &amp;&amp", "<style>x</style>&lt;c&gt &copy &eacute; &amp;lt; &#39;&#40;<br>&nbsp;d", "<p>e</p>"]
    spark.createDataFrame([(i, "", t) for i, t in enumerate(texts)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["html_strip_text"](spark, str(tmp_path)).toPandas()
    with duck.cursor() as con:
        con.execute(f"create temp view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
        assert rows(got) == rows(con.execute(SQL["html_strip_text"]).df())


def test_split_merged_of_lines_with_marks(spark, duck, tmp_path):
    """The query cuts at the mark that it puts in, as its SQL; the rule itself cuts at the line's mark too."""
    from pagewright.operators import rewrite as R

    text = "a\nanedst. 41.67.62.24 Anatti oferly\nb 1.2.3 C\nd"
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["split_merged"](spark, str(tmp_path)).toPandas()
    with duck.cursor() as con:
        con.execute(f"create temp view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
        assert rows(got) == rows(con.execute(SQL["split_merged"]).df())
    line = spark.createDataFrame([(1, 1, 0, "paragraph", text.split("\n")[1])], "doc_id long, page int, seq long, type string, content string")
    assert [r["content"] for r in R.split_merged(line).collect()] == ["anedst.", "41.67.62.24 Anatti oferly"]
