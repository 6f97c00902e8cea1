from difflib import SequenceMatcher

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import similarity as S
from pagewright.functions import text as X


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<double>' if isinstance(v, list) else 'string'}" for k, v in values.items()))
    return row.select(expression.alias("x")).first()[0]


@pytest.mark.parametrize(("text", "joined"), [("Т а б л и ц а 2.2.1", "Таблица 2.2.1"), ("a b cd", "a b cd"), ("a b c", "abc"), ("", "")])
def test_spaced_letters(spark, text, joined):
    assert one(spark, X.remove_spaced_letters(F.col("t")), t=text) == joined


@pytest.mark.parametrize(("text", "clean"), [("a​  b c ", "a b c"), ("x/1/2 y", "x y"), ("1/2", "1")])
def test_soft_clean(spark, text, clean):
    assert one(spark, X.soft_clean(F.col("t")), t=text) == clean


@pytest.mark.parametrize(("text", "noise"), [("", True), ("PDF", False), ("ABC DEF", True), ("a b c", True), ("1.2", True), ("Судно класса", False), ("short words", True), ("a longer line of latin text", False)])
def test_garbage(spark, text, noise):
    assert one(spark, X.is_garbage(F.col("t")), t=text) is noise


def test_normal_forms(spark):
    assert one(spark, X.norm_pdf(F.col("t")), t=" м 3 — ( A ) , b") == "м3 - (a), b"
    assert one(spark, X.norm_compare(F.col("t")), t="з а т о п ") == "затоп ·"
    assert one(spark, X.norm_verify_flat(F.col("t")), t="А-Б 1!") == "аб1"


def test_detection(spark):
    assert one(spark, X.detect_tables(F.col("t")), t="a  b\nc  d") is True
    assert one(spark, X.detect_tables(F.col("t")), t="a  b") is False
    assert one(spark, X.detect_formulas(F.col("t")), t="2 x 3") is True
    assert one(spark, X.is_formula_tail(F.col("t")), t="для всех") is True
    assert one(spark, X.is_formula_tail(F.col("t")), t="Для всех") is False


def test_geometry(spark):
    a, b = [0.0, 0.0, 10.0, 10.0], [5.0, 0.0, 15.0, 10.0]
    assert one(spark, G.iou(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(1 / 3)
    assert one(spark, G.iou(F.col("a"), F.col("b")), a=a, b=[10.0, 0.0, 20.0, 10.0]) == 0.0
    assert one(spark, G.same_band(F.col("a"), F.col("b")), a=a, b=[0.0, 9.5, 1.0, 20.0]) is False
    assert one(spark, G.same_band(F.col("a"), F.col("b")), a=a, b=[0.0, 9.49, 1.0, 20.0]) is True
    assert one(spark, G.known(F.col("a")), a=[0.0] * 4) is False


@given(st.text("abc ", max_size=12), st.text("abc ", max_size=40))
def test_contained_share(needle, hay):
    got = S.contained_share(needle, hay)
    best = max((k for k in range(len(needle) + 1) if any(needle[i : i + k] in hay for i in range(len(needle) - k + 1))), default=0)
    assert got == (1.0 if not needle else pytest.approx(best / len(needle)))


@given(st.text("ab", max_size=9), st.text("ab", max_size=9))
def test_ratio_bound(a, b):
    if a or b:
        assert SequenceMatcher(None, a, b).ratio() <= 2 * min(len(a), len(b)) / (len(a) + len(b)) + 1e-9


def test_words(spark):
    assert one(spark, X.words_of(F.col("t")), t="a bb, ccc-d (ee)") == ["bb", "ccc", "ee"]


def test_strip_html(spark):
    page = "<script>x</script><p>a&nbsp;&eacute;&#1078;&#x41; &amp;lt; 1 &lt; 2</p>"
    assert one(spark, X.strip_html(F.col("t")), t=page) == "a éжA &lt; 1 < 2"
