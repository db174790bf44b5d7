"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilspark.session import ensure_checkpoint_dir, scratch_dir

# Memory that one Python worker lends to its cache of words.
CACHE_ENTRIES = 400_000
# Rows of a batch that a Python worker gets at once.
ROWS_PER_BATCH = 2000
_BATCH_ROWS, _DEFAULT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
GROUP_CHARS = 1_000_000
_SHIPPED: set[str] = set()
# What empties the caches of each operator that this Python worker has run.
_HELD: dict[str, Callable[[], None]] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, for sessions started without it on their path, and
    keep the batches that they get small: whole texts are long rows."""
    if spark.conf.get(_BATCH_ROWS) == _DEFAULT_ROWS:  # unless the session says otherwise
        spark.conf.set(_BATCH_ROWS, str(ROWS_PER_BATCH))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = pathlib.Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="package-")  # on the driver, which serves the file to the workers
    archive = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(archive)


def hold(owner: str, release: Callable[[], None]) -> None:
    """Called in a Python worker by an operator that is about to keep something between tasks, with what empties it. What
    other operators have kept goes, since a worker that is used again would hold the caches of every operator before."""
    for name in [n for n in _HELD if n != owner]:
        _HELD.pop(name)()
    _HELD[owner] = release


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that nothing above them is computed twice."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """A reliable checkpoint, which cuts the lineage of a loop."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def running(df: DataFrame, order: list[Column], amount: str, name: str) -> DataFrame:
    """``df`` with ``name``, the sum of ``amount`` over all rows that come before in the order.

    Rows are dealt out by ranges of the order and added up where they lie; only the ranges' totals, one row a task, meet in
    one place.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = df.columns.index(amount)
    fields = [*df.schema.fields, T.StructField("_inner", T.LongType()), T.StructField("_part", T.IntegerType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column(place).to_numpy()
            ends = np.cumsum(n) + total
            total = int(ends[-1]) if len(n) else total
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends - n, pa.int64()), pa.array(np.full(len(n), part, np.int32))],
                                             names=[f.name for f in fields])

    stored = kept(dealt.mapInArrow(run, T.StructType(fields)), "running-sums")
    totals = stored.groupBy("_part").agg(F.max(F.col("_inner") + F.col(amount)).alias("_sum"))
    earlier = totals.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_earlier"))
    return stored.join(F.broadcast(earlier), "_part").select(*df.columns, (F.col("_earlier") + F.col("_inner")).alias(name))


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def with_columns(df: DataFrame, text: str, fields: list[T.StructField], make: Callable[[], Callable]) -> DataFrame:
    """``df`` with columns made from the texts of one column, batch by batch, in Arrow.

    ``make`` runs once per task and gives a function from a list of texts (None for null) to one Arrow array per field.
    A column of ``df`` that has the name of a new field is replaced.
    """
    rest = df.drop(*[f.name for f in fields if f.name in df.columns and f.name != text])
    names = [*rest.columns, *[f.name for f in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            made = work(batch.column(batch.schema.get_field_index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, *fields]))


def groups(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about ``GROUP_CHARS`` characters, which bounds what is split into words at once."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or "")
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


class Forest:
    """Connected parts of the numbers 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            above = self.up[self.up]
            if np.array_equal(above, self.up):
                return self.up
            self.up = above

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            top = self.roots()
            x, y = top[a], top[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))
