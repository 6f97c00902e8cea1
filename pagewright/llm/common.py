"""What the operators share: the folder that all executors see, tables written there, and balanced id ranges."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset (tests), one of our own for this application."""
    root = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not root and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not root:
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="pagewright-")
        root = _own[app]
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends there, and a lost executor costs no recomputation."""
    path = fresh_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    if _passing:
        _passing[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_passing: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession):
    """Tables that `written` makes inside are deleted at the end. What is to stay is computed inside and written outside of it, or
    handed to the function that this gives, which writes it to stay."""
    mine: list[str] = []
    _passing.append(mine)

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = written(df, name)
        path = mine.pop()
        if len(_passing) > 1:
            _passing[-2].append(path)
        return out

    try:
        yield keep
    finally:
        _passing.pop()
        for p in mine:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def own_name(df: DataFrame, base: str) -> str:
    """A column name like `base` that `df` doesn't have in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_ranges(df: DataFrame, column: str, n: int) -> list[int]:
    """About n - 1 ascending ids that cut the rows into ranges of like counts. Reads the id column only."""
    if n < 2:
        return []
    cuts = df.stat.approxQuantile(column, [i / n for i in range(1, n)], 0.2 / n)
    return sorted({int(x) for x in cuts})


def range_of(column: Column, cuts: Sequence[int]) -> Column:
    """Number of the range that an id falls in: as many as there are cuts at or below it; null is in range 0."""
    if not cuts:
        return F.lit(0)
    tree = _tree(column, list(cuts), 0, len(cuts))
    return F.when(column.isNull(), F.lit(0)).otherwise(tree)


def _tree(column: Column, cuts: list[int], lo: int, hi: int) -> Column:
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(column < F.lit(cuts[mid]), _tree(column, cuts, lo, mid)).otherwise(_tree(column, cuts, mid + 1, hi))


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """For what is run inside: Arrow batches of at most `rows` rows, for tables whose rows have some MB each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def rows_of(batch: pa.RecordBatch):
    """A batch's rows as dictionaries, made one at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def in_slices(batches, rows: int = 2048):
    """Arrow batches cut to at most `rows` rows, to bound a worker's memory."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
