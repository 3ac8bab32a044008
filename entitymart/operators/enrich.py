"""Id sets, labels, lookups and backfills from the second pass over the dump."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.operators.merge import insert_or_ignore, one_per_key
from entitymart.operators.tables import guarded
from entitymart.schemas import KEYS

UNRESOLVED = "name is null or name = id"


def id_sets(t: dict[str, DataFrame]) -> DataFrame:
    """(kind, qid): albums, tracks, artists without a name, instruments, genres, and all of them. A table has each of its ids once."""
    kinds = {
        "albums": t["album"].select(F.col("id").alias("qid")),
        "tracks": t["track"].select(F.col("id").alias("qid")),
        "artists_with_null_names": t["artist"].where(UNRESOLVED).select(F.col("id").alias("qid")),
        "instruments": t["artist_instrument"].select(F.col("instrument_id").alias("qid")).distinct(),
        "genres": t["genre"].select(F.col("id").alias("qid")),
    }
    each = reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("kind"), "qid") for k, df in kinds.items()])
    return each.unionByName(each.select(F.lit("all").alias("kind"), "qid").distinct())


def wanted_ids(sets: DataFrame, album_enrichment: DataFrame) -> DataFrame:
    """All ids, and the record labels that albums name, wherever in the dump they stand."""
    more = album_enrichment.where("record_label_qid is not null").select(F.col("record_label_qid").alias("qid"))
    return sets.where("kind = 'all'").select("qid").union(more).distinct()


def labels(entries: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return insert_or_ignore(existing, entries, KEYS["qid_label"])


def lookup(ids: DataFrame, qid_label: DataFrame) -> DataFrame:
    """(id, name) of the distinct ``qid`` that have a label."""
    named = qid_label.where("label is not null").select("qid", F.col("label").alias("name"))
    return ids.distinct().join(named, "qid").select(F.col("qid").alias("id"), "name")


def instruments(artist_instrument: DataFrame, qid_label: DataFrame) -> DataFrame:
    return lookup(artist_instrument.select(F.col("instrument_id").alias("qid")), qid_label)


def record_labels(enriched: DataFrame, qid_label: DataFrame) -> DataFrame:
    return lookup(enriched.where("record_label_qid is not null").select(F.col("record_label_qid").alias("qid")), qid_label)


def album_genres(enriched: DataFrame, genre: DataFrame, album: DataFrame) -> DataFrame:
    rows = enriched.where("entity_type = 'album' and genre_qid is not null").select(F.col("entity_qid").alias("album_id"), F.col("genre_qid").alias("genre_id"))
    return guarded(guarded(rows.distinct(), "genre_id", genre), "album_id", album).select("album_id", "genre_id")


def track_albums(existing: DataFrame, enriched: DataFrame, album: DataFrame, track: DataFrame) -> DataFrame:
    rows = enriched.where("entity_type = 'track' and parent_album_qid is not null").select(
        F.col("entity_qid").alias("track_id"), F.col("parent_album_qid").alias("album_id"), F.lit(None).cast("int").alias("track_number")
    )
    new = guarded(guarded(rows, "album_id", album), "track_id", track)
    # Existing rows win as the least. One aggregate takes them once, where an anti-join would compute or read them twice.
    both = existing.select(*new.columns, F.lit(0).alias("later")).union(new.withColumn("later", F.lit(1)))
    return one_per_key(both.select(*KEYS["track_album"], "later", "track_number"), KEYS["track_album"]).select(*new.columns)


def with_label(df: DataFrame, qid_label: DataFrame) -> DataFrame:
    return df.join(qid_label.select(F.col("qid").alias("id"), F.col("label").alias("_label")), "id", "left")


def backfill_names(df: DataFrame, qid_label: DataFrame, only_unresolved: bool = False) -> DataFrame:
    """Names from labels: always where there is one, or only for rows without a name of their own."""
    new = F.coalesce("_label", "name")
    name = F.when(F.expr(UNRESOLVED), new).otherwise(F.col("name")) if only_unresolved else new
    return with_label(df, qid_label).withColumn("name", name).select(*df.columns)


def best(enriched: DataFrame, kind: str, column: str) -> DataFrame:
    """The least value of ``column`` for each entity of ``kind``."""
    rows = enriched.where((F.col("entity_type") == kind) & F.col(column).isNotNull())
    return rows.groupBy(F.col("entity_qid").alias("id")).agg(F.min(column).alias(f"_{column}"))


def backfill_albums(album: DataFrame, enriched: DataFrame, qid_label: DataFrame) -> DataFrame:
    named = backfill_names(album, qid_label)
    said = enriched.where("entity_type = 'album' and record_label_qid is not null").select(F.col("entity_qid").alias("id"), F.col("record_label_qid").alias("qid"))
    text = said.join(qid_label.where("label is not null").select("qid", "label"), "qid").groupBy("id").agg(F.min("label").alias("_text"))
    joined = named.join(best(enriched, "album", "release_date"), "id", "left").join(text, "id", "left")
    changes = {"release_date": F.coalesce("_release_date", "release_date"), "record_label": F.coalesce("_text", "record_label")}
    return joined.withColumns(changes).select(*album.columns)


def backfill_tracks(track: DataFrame, enriched: DataFrame, qid_label: DataFrame) -> DataFrame:
    joined = backfill_names(track, qid_label).join(best(enriched, "track", "duration_seconds"), "id", "left")
    seconds = F.coalesce(F.col("_duration_seconds").try_cast("int"), F.col("duration_seconds"))
    return joined.withColumn("duration_seconds", seconds).select(*track.columns)


def populate(t: dict[str, DataFrame], found_labels: DataFrame, enriched: DataFrame) -> dict[str, DataFrame]:
    """All tables after labels and enrichment; children stay as they are, so the tables can be published as one snapshot.

    ``found_labels``: one row a qid. A backfill changes no id, so references are guarded by the tables as they were."""
    qid_label = found_labels if "qid_label" not in t else labels(found_labels, t["qid_label"])
    return t | {
        "qid_label": qid_label,
        "artist": backfill_names(t["artist"], qid_label, only_unresolved=True),
        "album": backfill_albums(t["album"], enriched, qid_label),
        "track": backfill_tracks(t["track"], enriched, qid_label),
        "instrument": instruments(t["artist_instrument"], qid_label),
        "record_label": record_labels(enriched, qid_label),
        "album_genre": one_per_key(album_genres(enriched, t["genre"], t["album"]), KEYS["album_genre"]),
        "track_album": track_albums(t["track_album"], enriched, t["album"], t["track"]),
    }
