"""Staged rows on disk: typed Parquet, and a flat layout of plain strings for exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from entitymart.schemas import REFS

ROWS_PER_FILE = 100_000

#: Files that flows exchange: rejected lines, genre names, labels, and enrichment of albums and tracks.
LAYOUTS = {
    "rejects": "file string, raw string, reason string",
    "genres": "id string, name string",
    "labels": "qid string, label string, description string",
    "enrichment": "entity_qid string, entity_type string, release_date date, record_label_qid string, duration_seconds long, genre_qid string, parent_album_qid string",
}


def write_layout(df: DataFrame, layout: str, path: str) -> None:
    """Writes the columns of a layout in its order and types; a column that is missing or of a type that does not fit is an error."""
    columns = StructType.fromDDL(LAYOUTS[layout])
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns]).write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def read_layout(spark: SparkSession, layout: str, path: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[layout]).parquet(path)


def write_staged(staged: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    staged.write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def to_flat(staged: DataFrame) -> DataFrame:
    """14 string columns: vectors joined by ``|``, references and parents as JSON, dates in ISO form."""
    refs = F.to_json("performers")
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return staged.select(
        "id", "name", "description", "artist_type", "inclusion_reason", "role", day("birth_date"), day("death_date"),
        *[F.array_join(c, "|").alias(c) for c in ("genres", "instruments", "member_of")],
        F.when(F.col("role") == "Album", refs).otherwise("[]").alias("albums"),
        F.when(F.col("role") == "Track", refs).otherwise("[]").alias("tracks"),
        F.to_json("parents").alias("parents"),
    )


def from_flat(flat: DataFrame) -> DataFrame:
    vector = lambda c: F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, r"\|")).alias(c)
    refs = lambda c: F.coalesce(F.from_json(c, REFS), F.array().cast(REFS))
    day = lambda c: F.nullif(F.col(c), F.lit("")).try_cast("date").alias(c)
    return flat.select(
        "id", "name", "description", "artist_type", "inclusion_reason", "role", day("birth_date"), day("death_date"),
        *map(vector, ("genres", "instruments", "member_of")), F.concat(refs("albums"), refs("tracks")).alias("performers"),
        F.from_json("parents", "array<string>").alias("parents"),
    )
