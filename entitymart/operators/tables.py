"""Catalog tables from staged rows. References that lead nowhere are dropped by semi joins; repeats by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.operators.merge import apart, may_repeat, one_per_key
from entitymart.schemas import KEYS
from entitymart.sources.storage import stored


#: How rows that may share a key become one: told by the caller where it knows that they do not.
Merge = Callable[[DataFrame, list[str]], DataFrame]


def as_is(df: DataFrame, keys: list[str]) -> DataFrame:
    """For rows of different keys."""
    return df


def agents(staged: DataFrame, merge: Merge = one_per_key) -> DataFrame:
    columns = ["id", "name", "description", "artist_type", "inclusion_reason", "birth_date", "death_date"]
    return merge(staged.where("role = 'Agent'").select(*columns), KEYS["artist"])


def albums(staged: DataFrame, merge: Merge = one_per_key) -> DataFrame:
    rows = merge(staged.where("role = 'Album'").select("id", F.coalesce("name", "id").alias("name")), KEYS["album"])
    return rows.withColumns({"release_date": F.lit(None).cast("date"), "record_label": F.lit(None).cast("string")})


def tracks(staged: DataFrame, merge: Merge = one_per_key) -> DataFrame:
    rows = merge(staged.where("role = 'Track'").select("id", F.coalesce("name", "id").alias("name")), KEYS["track"])
    return rows.withColumn("duration_seconds", F.lit(None).cast("int"))


def genre_ids(staged: DataFrame) -> DataFrame:
    return staged.select(F.explode("genres").alias("qid")).distinct()


def guarded(df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """Rows whose ``column`` is an id of ``parent``."""
    return df.join(parent.select(F.col("id").alias(column)), column, "left_semi")


def of_agents(staged: DataFrame, vector: str, name: str, merge: Merge = one_per_key) -> DataFrame:
    rows = staged.where("role = 'Agent'").select(F.col("id").alias("artist_id"), F.explode(F.array_distinct(vector)).alias(name))
    return merge(rows, ["artist_id", name])


def performer_refs(staged: DataFrame, role: str, id_column: str, merge: Merge = one_per_key) -> DataFrame:
    """(id, artist_id, role) of the works of a role, whether their performers are known or not."""
    refs = staged.where(F.col("role") == role).select(F.col("id").alias(id_column), F.explode(F.array_distinct("performers")).alias("p"))
    return merge(refs.select(id_column, F.col("p.qid").alias("artist_id"), F.col("p.role").alias("role")), [id_column, "artist_id", "role"])


def parent_refs(staged: DataFrame, merge: Merge = one_per_key) -> DataFrame:
    rows = staged.where("role = 'Track'").select(F.col("id").alias("track_id"), F.explode(F.array_distinct("parents")).alias("album_id"))
    return merge(rows, ["track_id", "album_id"])


def bootstrap_tables(staged: DataFrame, genre: DataFrame) -> dict[str, DataFrame]:
    """All tables of a bootstrap. Those that others refer to are stored, the rest are plans over ``staged``.

    Only rows of ids that may come more than once meet others of their key; what one row gives is made different in the row itself."""
    repeats = may_repeat(staged, "id")
    made = lambda make, *args: apart(staged, repeats, lambda rows: make(rows, *args, as_is), lambda rows: make(rows, *args))
    artist, album, track = (stored(made(make), name) for make, name in ((agents, "artist"), (albums, "album"), (tracks, "track")))
    return {
        "artist": artist,
        "genre": genre,
        "artist_genre": guarded(made(of_agents, "genres", "genre_id"), "genre_id", genre).select("artist_id", "genre_id"),
        "artist_instrument": made(of_agents, "instruments", "instrument_id"),
        "artist_member_of": guarded(made(of_agents, "member_of", "group_id"), "group_id", artist).select("artist_id", "group_id"),
        "album": album,
        "album_artist": guarded(made(performer_refs, "Album", "album_id"), "artist_id", artist).select("album_id", "artist_id", "role"),
        "track": track,
        "track_artist": guarded(made(performer_refs, "Track", "track_id"), "artist_id", artist).select("track_id", "artist_id", "role"),
        "track_album": guarded(made(parent_refs), "album_id", album).select("track_id", "album_id", F.lit(None).cast("int").alias("track_number")),
    }
