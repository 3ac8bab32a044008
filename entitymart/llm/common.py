"""What the corpus operators share: table access, hashing of ids, shipping the package, work by Arrow batches."""

from __future__ import annotations

import itertools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from entitymart.sources import storage
from entitymart.sources.storage import shared_folder, spread

__all__ = ["arrow_schema", "batch_of", "field_of", "fold", "maybe_one_of", "packed", "per_batch", "per_group_rows", "shared_folder", "ship", "slices", "small_batches", "stored", "table", "unpacked"]

#: Rows worked on at once, and rows that Spark hands to Python at once while a table is stored (it also bounds their bytes).
BATCH_ROWS = 512
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bits of a field that tells which rows need a join at all: 8 MB at most.
MAX_BITS = 1 << 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While a job runs in it, Spark hands small batches to Python; then the session has its own setting back."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING) if before is None else spark.conf.set(BATCH_SETTING, before)


def stored(df: DataFrame, what: str) -> DataFrame:
    """``storage.stored``, with small batches for the Python steps on the way."""
    with small_batches(df.sparkSession):
        return storage.stored(df, what)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; remainder 2 is held out of every fit."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def packed(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """The columns of ``df`` but those called as in ``without``, in one struct, so that names of an operator's own columns meet none of the caller's."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in without])


def field_of(batch: pa.RecordBatch, struct: str, name: str) -> pa.Array:
    """A field of a struct column, found as Spark finds columns: whatever the case."""
    column = batch.column(struct)
    names = [f.name.lower() for f in column.type]
    return column.field(names.index(name.lower()))


def unpacked(df: DataFrame, struct: str) -> list[Column]:
    """The fields of a struct as columns again."""
    return [F.col(struct).getField(c).alias(c) for c in df.schema[struct].dataType.names]


def maybe_one_of(ids: DataFrame, ident: Column) -> Column:
    """False only where ``ident`` is null or none of ``ids`` (one column, stored, without repeats).

    A field of bits in which the hash of each id sets one, eight bits an id and ``MAX_BITS`` at most; with more ids it says true more often
    than it should, never false. It reaches the plan as a scalar subquery, so rows are told apart in the scan."""
    n, bits = ids.count(), 64
    while bits < min(8 * n, MAX_BITS):
        bits *= 2
    bit = lambda x: F.pmod(F.xxhash64(F.lit("bit"), x), F.lit(bits))
    word, place = lambda x: F.shiftright(bit(x), 6), lambda x: (bit(x) % 64).cast("int")
    x = F.col(ids.columns[0])
    words = ids.groupBy(word(x).alias("i")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place(x))).alias("w"))
    every = ids.sparkSession.range(bits // 64).select(F.col("id").alias("i")).join(words, "i", "left")
    cells = every.agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("w", F.lit(0).cast("long")).alias("w")))).alias("cells"))
    field = cells.select(F.transform("cells", lambda c: c["w"])).scalar()
    return F.coalesce(F.getbit(F.get(field, word(ident).cast("int")), place(ident)) == 1, F.lit(False))


def ship(spark: SparkSession) -> None:
    """Sends this package to the workers unless they find it on the path that they inherit."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_entitymart_sent", False):
        return
    target = Path(tempfile.mkdtemp(prefix="spark-")) / "entitymart.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in (root / "entitymart").rglob("*.py"):
            z.write(f, f.relative_to(root))
    context.addPyFile(str(target))
    context._entitymart_sent = True


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``rows`` rows, without empty ones."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def batch_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """Columns by name, lists or Arrow arrays, in the schema's order and types."""
    arrays = []
    for f in schema:
        x = columns[f.name]
        if not isinstance(x, pa.Array):
            x = pa.array(x, f.type)
        arrays.append(x if x.type == f.type else x.cast(f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def per_batch(df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: str | StructType) -> DataFrame:
    """Applies ``make`` to slices of Arrow batches; it returns the columns of ``schema`` by name."""
    ship(df.sparkSession)
    target = to_arrow_schema(schema) if isinstance(schema, StructType) else arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch_of(make(batch), target)

    return df.mapInArrow(run, schema)


def per_group_rows(df: DataFrame, run: Callable[[Iterator[tuple]], Iterator[dict]], schema: StructType, rows: int = BATCH_ROWS) -> DataFrame:
    """Streams groups of rows that stand together by their first column through ``run``, which takes (key, iterator of the other columns' tuples) pairs and
    gives rows as dicts. A group is never held: its rows are read on as ``run`` asks for them, and what it leaves is skipped."""
    ship(df.sparkSession)
    target = to_arrow_schema(schema)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in slices(batches, rows):
            yield from zip(*[c.to_pylist() for c in batch.columns])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = ((key, (x[1:] for x in own)) for key, own in itertools.groupby(lines(batches), key=lambda x: x[0]))
        held: list[dict] = []
        for row in run(groups):
            held.append(row)
            if len(held) == rows:
                yield batch_of({f.name: [x[f.name] for x in held] for f in target}, target)
                held = []
        if held:
            yield batch_of({f.name: [x[f.name] for x in held] for f in target}, target)

    return df.mapInArrow(work, schema)
