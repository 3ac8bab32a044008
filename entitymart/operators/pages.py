"""Pages of a table in key order: a layout in which a page reads what lies after its cursor, and all borders at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entitymart.sources.storage import shared_folder, stored


def in_key_order(df: DataFrame, key: str = "id", parts: int | None = None, group_rows: int = 1 << 20) -> DataFrame:
    """``df`` stored by ranges of ``key`` and sorted within, so that a filter on the key skips files and row groups by their bounds."""
    path = shared_folder(df.sparkSession, "in-key-order")
    dealt = df.repartitionByRange(parts, key) if parts else df.repartitionByRange(key)
    dealt.sortWithinPartitions(key).write.option("parquet.block.row.count.limit", group_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def borders(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """(page, first, last, n) of all pages of ``n`` rows in key order. Rows are numbered within ranges; only the count of each range is added up in one place."""
    ranked = df.select(F.col(key).alias("key")).repartitionByRange("key").sortWithinPartitions("key")
    numbered = ranked.select("key", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() % (1 << 33)).alias("at"))
    numbered = stored(numbered, "numbered")
    counts = numbered.groupBy("part").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    placed = numbered.join(F.broadcast(counts.select("part", before.alias("before"))), "part")
    page = F.floor((F.col("before") + F.col("at")) / n).cast("int").alias("page")
    return placed.groupBy(page).agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").cast("int").alias("n"))
