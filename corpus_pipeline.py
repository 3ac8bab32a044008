"""A corpus from raw documents to packed sequences: five stages, each a table of its own.

Each stage reads what the one before has kept and returns the columns of ``documents``, the last one the packed pieces. Decisions take
effect: documents of low quality, near duplicates but one of each group, and documents with benchmark passages go; repeated line
windows go from the texts, and with them documents of which nothing is left.

In every stage but the last, all columns of its input pass through, under any name; an empty table gives an empty one; rows that repeat are judged
alike, each for itself, but for near duplicates, where rows of one id and text are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymart.llm import decontaminate, linededup, neardup, packing, quality
from entitymart.llm.common import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score below the cut; the classifier learns from this input and the labels. A null text is judged as an empty one; a
    row with a null id is judged but teaches nothing. Without labels of both classes nothing is dropped."""
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.where(F.col("quality_score") >= quality.CUT).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later occurrences of line windows, and documents all of whose lines were. n_chars follows the text. Rows with a null id or text
    stay as they are."""
    found = linededup.dedup_lines(docs).where("n_removed = 0 or n_removed < n_lines")
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the least id stays. Texts without words, null ones too, are one group; rows with a null id
    stay; an id that repeats with another text is another document."""
    return neardup.keep_one(docs).select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item. A null text holds none; items without words, text or id are never held."""
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, with its sequence and its place there. A null text is packed as its end id; a null id stays null."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack_sequences),
]

#: SQL cannot state the learned scores, the fingerprint groups or the packing; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
