"""Golden comparison, M1-M10."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import similarity as S
from pagewright.functions import text as X

CUT = 300


ITEMS = "array<struct<content:string,bbox:array<double>>>"
ROWS = "array<struct<cells:array<struct<block:array<struct<content:string>>>>>>"


def prepared(blocks: DataFrame) -> DataFrame:
    """What comparing needs of a block: text and its normal form, that form's own (which likeness is taken of), structure, image key.

    Columns that the table lacks count as null; without `items` a list's lines are its items.
    """
    c = blocks.columns
    get = lambda n, kind: F.col(n) if n in c else F.lit(None).cast(kind)
    lines = F.transform(F.split(F.coalesce("content", F.lit("")), "\n"), lambda x: F.struct(x.alias("content"), F.lit(None).cast("array<double>").alias("bbox")))
    items, columns, rows = F.col("items") if "items" in c else lines, get("columns", "array<string>"), get("rows", ROWS)
    text = X.block_text(F.col("type"), F.col("content"), items, columns, rows)
    key = get("image_key", "string")
    size = lambda x: F.coalesce(F.size(x), F.lit(0))
    shape = X.fingerprint(F.col("type"), get("heading_level", "int"), key, F.col("content"), F.greatest(size(columns), F.lit(0)), F.greatest(size(rows), F.lit(0)), F.greatest(size(items), F.lit(0)))
    return blocks.select("doc_id", "page", "seq", "type", text.alias("text"), X.norm_compare(text).alias("norm"), X.norm_compare(X.norm_compare(text)).alias("deep"), key.alias("image_key"), shape.alias("shape"))


class Unused:
    """A page's result blocks that no golden block took, in order; equal texts and image keys are looked up, not searched for."""

    def __init__(self, rows: list[dict]):
        self.rows, self.texts = dict(enumerate(rows)), {}
        self.equal: dict[tuple, list[int]] = {}
        for j, r in reversed(self.rows.items()):
            name = ("text", r["type"], r["norm"]) if r["norm"] else ("image", r["type"], r["image_key"])
            self.equal.setdefault(name, []).append(j)
        for j, r in reversed(self.rows.items()):  # an image with text can be asked for by its key as well
            if r["norm"] and r["type"] == "image":
                self.equal.setdefault(("image", "image", r["image_key"]), []).append(j)
        for x in self.equal.values():
            x.sort(reverse=True)

    def first(self, *name) -> int | None:
        left = self.equal.get(name, [])
        while left and left[-1] not in self.rows:
            left.pop()
        return left[-1] if left else None

    def likest(self, g: dict, same_type: bool, least: float) -> tuple[int | None, float]:
        """The first block with the highest ratio from `least` on, among those of the type; any one of `least` among all others.

        The likest by the characters that both texts have come first, and what can't win isn't compared to its end.
        """
        left = [j for j, r in self.rows.items() if (r["type"] == g["type"]) == same_type and r["norm"]]
        if not left:
            return None, least
        text, best, top = S.Text(g["deep"]), None, least
        most = S.bounds(text, [self.text(j) for j in left])
        for bound, j in sorted(zip((-most).tolist(), left, strict=True)):
            if -bound < top:
                break
            if not same_type:
                if S.reaches(text, self.text(j), least):
                    return j, least
                continue
            s = S.likeness(text, self.text(j), top)
            if s > top or s == top and (best is None or j < best):
                best, top = j, s
                if top == 1.0:
                    break
        return best, top

    def text(self, j: int) -> S.Text:
        if j not in self.texts:
            self.texts[j] = S.Text(self.rows[j]["deep"])
        return self.texts[j]


def _pairs(golden: list[dict], result: list[dict], threshold: float) -> list[tuple]:
    """(seq, result's seq, likeness, type break) for the golden blocks of a page, in order."""
    unused, out = Unused(result), []
    for g in golden:
        broken, likeness = False, 1.0
        if g["norm"]:
            j = unused.first("text", g["type"], g["norm"])
            if j is None:
                j, likeness = unused.likest(g, True, threshold)
                broken = j is None and unused.likest(g, False, threshold)[0] is not None
        else:
            j = unused.first("image", "image", g["image_key"]) if g["type"] == "image" and g["image_key"] else None
        taken = unused.rows.pop(j)["seq"] if j is not None else None
        out.append((g["seq"], taken, likeness if j is not None else None, broken))
    return out


def greedy_match(golden: DataFrame, result: DataFrame, threshold: float = S.MATCH_THRESHOLD) -> DataFrame:
    """M1-M3: (doc_id, page, seq, result_seq, likeness, type_break) for each golden block of `prepared` tables. A page is one row."""

    names = ["seq", "type", "norm", "deep", "image_key"]
    in_order = lambda rows: sorted(rows, key=lambda r: r["seq"])
    run = lambda pages: [_pairs(in_order(g), in_order(r), threshold) for g, r in pages]
    out = f"seq {golden.schema['seq'].dataType.simpleString()}, result_seq long, likeness double, type_break boolean"
    return S.by_page(golden.select("doc_id", "page", *names), result.select("doc_id", "page", *names), run, out)


def exact_match(golden: DataFrame, result: DataFrame) -> DataFrame:
    """The part of M1 that equality decides: the n-th golden block of a page, type and text with the n-th result block of these."""
    w = Window.partitionBy("doc_id", "page", "type", "norm").orderBy("seq")
    g = golden.filter("norm <> ''").withColumn("n", F.row_number().over(w)).select("doc_id", "page", "type", "norm", "n", "seq")
    r = result.filter("norm <> ''").withColumn("n", F.row_number().over(w)).select("doc_id", "page", "type", "norm", "n", F.col("seq").alias("result_seq"))
    return g.join(r, ["doc_id", "page", "type", "norm", "n"]).select("doc_id", "page", "seq", "result_seq", F.lit(1.0).alias("likeness"), F.lit(False).alias("type_break"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, F.round(a / b, 3)).otherwise(F.lit(0.0))


def f1_of(matched: Column, golden: Column, result: Column) -> Column:
    p, r = F.when(result > 0, matched / result).otherwise(0.0), F.when(golden > 0, matched / golden).otherwise(0.0)
    return F.when(p + r > 0, F.round(2 * p * r / (p + r), 3)).otherwise(F.lit(0.0))


def status_rows(golden: DataFrame, result: DataFrame, match: DataFrame) -> DataFrame:
    """A row for each block of either side with its status: ok, missed or extra."""
    hit = match.filter("result_seq IS NOT NULL")
    g = golden.join(hit.select("doc_id", "page", "seq", F.lit(True).alias("hit")), ["doc_id", "page", "seq"], "left")
    r = result.join(hit.select("doc_id", "page", F.col("result_seq").alias("seq"), F.lit(True).alias("hit")), ["doc_id", "page", "seq"], "left")
    side = lambda d, name, no: d.select(F.lit(name).alias("side"), "doc_id", "page", "seq", "type", "text", F.when(F.col("hit"), F.lit("ok")).otherwise(F.lit(no)).alias("status"))
    return side(g, "golden", "missed").unionByName(side(r, "result", "extra"))


def scores(status: DataFrame, *keys: str) -> DataFrame:
    """M4, M6, M7: counts, precision, recall and F1 by the keys. A value on one side alone counts there; no outer join is needed as both
    sides are rows of one table."""
    golden, result = F.count_if(F.col("side") == "golden"), F.count_if(F.col("side") == "result")
    matched = F.count_if((F.col("side") == "golden") & (F.col("status") == "ok"))
    out = status.groupBy(*keys).agg(golden.alias("golden"), result.alias("result"), matched.alias("matched"))
    g, r, m = F.col("golden"), F.col("result"), F.col("matched")
    return out.withColumns({"precision": _ratio(m, r), "recall": _ratio(m, g), "f1": f1_of(m, g, r)})


def score_rollup(status: DataFrame) -> DataFrame:
    """M4, M6 and M7 in one pass, as grouping sets (), (type) and (page)."""
    out = status.sparkSession.sql(
        "SELECT type, page, count_if(side = 'golden') AS golden, count_if(side = 'result') AS result, count_if(side = 'golden' AND status = 'ok') AS matched FROM {blocks} GROUP BY GROUPING SETS ((), (type), (page))",
        blocks=status,
    )
    g, r, m = F.col("golden"), F.col("result"), F.col("matched")
    return out.withColumns({"precision": _ratio(m, r), "recall": _ratio(m, g), "f1": f1_of(m, g, r)})


def unmatched(status: DataFrame, what: str) -> DataFrame:
    """M8: missed or extra blocks, text cut."""
    return status.filter(F.col("status") == what).select("doc_id", "page", "seq", "type", F.substring("text", 1, CUT).alias("content"))


def structure_mismatches(golden: DataFrame, result: DataFrame, match: DataFrame) -> DataFrame:
    """M9: matched blocks whose structure differs."""
    m = match.filter("result_seq IS NOT NULL").select("doc_id", "page", "seq", "result_seq")
    g = golden.select("doc_id", "page", "seq", "type", F.col("shape").alias("golden_shape"))
    r = result.select("doc_id", "page", F.col("seq").alias("result_seq"), F.col("shape").alias("result_shape"))
    return m.join(g, ["doc_id", "page", "seq"]).join(r, ["doc_id", "page", "result_seq"]).filter(~F.col("golden_shape").eqNullSafe(F.col("result_shape")))


def text_coverage(golden: DataFrame, result: DataFrame, match: DataFrame) -> DataFrame:
    """M5: characters of golden texts that matched blocks have."""
    m = match.filter("result_seq IS NOT NULL").select("doc_id", "page", "seq", "result_seq")
    r = result.select("doc_id", "page", F.col("seq").alias("result_seq"), F.col("norm").alias("other"))
    got = m.join(golden.select("doc_id", "page", "seq", "norm"), ["doc_id", "page", "seq"]).join(r, ["doc_id", "page", "result_seq"])
    same = got.groupBy("doc_id").agg(F.sum(F.when(F.col("norm") == F.col("other"), F.length("norm").cast("long")).otherwise(S.equal_run_length("norm", "other"))).alias("same"))
    total = golden.groupBy("doc_id").agg(F.sum(F.length("norm")).alias("total"))
    return total.join(same, "doc_id", "left").select("doc_id", "total", F.coalesce("same", F.lit(0)).alias("same"), _ratio(F.coalesce("same", F.lit(0)), F.col("total")).alias("coverage"))
