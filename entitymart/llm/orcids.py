"""Token ids in ORC files: stripes that are read apart, integer run-length encoding, row indexes, Bloom filters on ids.

Texts are dealt by ranges of doc_id and sorted, then encoded in that order while they are written, so that what is shuffled
is text, which packs better than ids. Each row holds its document's ids and the number of ids before it in its file's range; the number of ids before a range comes
from one total a range, read from the files. A reader may select documents by id: ORC's stripe statistics, row indexes and Bloom filters prune the rest.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entitymart.llm.common import arrow_schema, batch_of, per_batch, shared_folder, ship, slices, small_batches
from entitymart.llm.tokens import default_path, encoder

END = 1
OPTIONS = {
    "orc.stripe.size": str(64 << 20), "orc.row.index.stride": "10000", "orc.create.index": "true", "orc.encoding.strategy": "SPEED",
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.dictionary.key.threshold": "0", "compression": "snappy",
}
SCHEMA = "part int, doc_id long, before long, n_tokens long, ids array<int>"


def write_ids(docs: DataFrame, folder: str, tokenizer: str | None = None, end: int = END) -> None:
    """Files of (part, doc_id, before, n_tokens, ids) in ascending doc_id order, null ids first. ``before``: ids earlier in the part."""
    tokenizer = tokenizer or default_path()
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    target = arrow_schema(SCHEMA)

    def run(batches):
        before = 0
        for batch in slices(batches):
            got = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in encoder(tokenizer).encode(batch.column(1).to_pylist())]
            n = np.array([len(x) + 1 for x in got], dtype=np.int64)
            values = np.concatenate([y for x in got for y in (x, [np.int32(end)])]).astype(np.int32)
            stops = np.concatenate([[0], np.cumsum(n)])
            ids = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(values, pa.int32()))
            yield batch_of({"part": batch.column(2), "doc_id": batch.column(0), "before": before + stops[:-1], "n_tokens": n, "ids": ids}, target)
            before += int(stops[-1])

    ship(docs.sparkSession)
    rows = ordered.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(run, SCHEMA)
    with small_batches(docs.sparkSession):
        rows.write.options(**OPTIONS).orc(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files with ``start``, the number of ids before it in the whole corpus."""
    rows = spark.read.schema(SCHEMA).orc(folder)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one short row a file
    offsets = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    return rows.join(F.broadcast(offsets), "part").select("doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids")


def read_some(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The documents of a few ids (doc_id, n_tokens, ids). The ids are pushed to the scan: stripes, and groups of rows within a stripe, whose
    statistics or Bloom filter rule them all out are not decoded."""
    return spark.read.schema(SCHEMA).orc(folder).where(F.col("doc_id").isin(list(doc_ids))).select("doc_id", "n_tokens", "ids")


def digest(rows: DataFrame) -> DataFrame:
    """Per document the crc32 of its ids as little-endian 32-bit integers."""

    def make(batch):
        ids = batch.column(3)
        values, stops = ids.flatten().to_numpy(False).astype("<u4"), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(False))])
        crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())]
        return {"doc_id": batch.column(0), "start": batch.column(1), "n_tokens": batch.column(2), "ids_crc32": crcs}

    return per_batch(rows, make, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes the ids of all texts (a null text has the end id only) and reads them back. Rows with the same id keep their own entries,
    ordered by text; an empty table gives an empty result."""
    folder = shared_folder(docs.sparkSession, "orc-ids")
    write_ids(docs, folder, tokenizer)
    return digest(read_ids(docs.sparkSession, folder))
