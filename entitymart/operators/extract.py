"""Projections of decoded entities: staged rows, genre entries, labels and enrichment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.functions.claims import duration_seconds, english, first, first_parsed_date, precise_date, resolved_label, targets
from entitymart.schemas import REFS


#: Properties that both staged rows and entries read.
SHARED = ("P136", "P361")


def with_shared(rows: DataFrame) -> DataFrame:
    """Adds the targets of ``SHARED`` to decoded lines, as columns, for both to read once."""
    return rows.withColumns({f"of_{p}": targets(F.col("entity")["claims"], p) for p in SHARED})


def targets_in(claims: Column, found: bool) -> Callable[[str], Column]:
    return lambda p: F.col(f"of_{p}") if found and p in SHARED else targets(claims, p)


def staged_columns(e: Column, role: Column, reason: Column, found: bool = False) -> list[Column]:
    """A staged row of an entity. Vectors keep order and repeats; performers and parents depend on the role. ``found``: the row is one of ``with_shared``."""
    claims = e["claims"]
    of = targets_in(claims, found)
    performers = F.transform(targets(claims, "P175"), lambda q: F.struct(q.alias("qid"), F.lit("performer").alias("role")))
    return [
        e["id"].alias("id"),
        english(e["labels"]).alias("name"),
        english(e["descriptions"]).alias("description"),
        F.when(reason.startswith("P31:"), "group").otherwise("person").alias("artist_type"),
        reason.alias("inclusion_reason"),
        role.alias("role"),
        first_parsed_date(claims, "P569").alias("birth_date"),
        first_parsed_date(claims, "P570").alias("death_date"),
        of("P136").alias("genres"),
        targets(claims, "P1303").alias("instruments"),
        targets(claims, "P463").alias("member_of"),
        F.when(role != "Agent", performers).otherwise(F.array().cast(REFS)).alias("performers"),
        F.when(role == "Track", of("P361")).otherwise(F.array().cast("array<string>")).alias("parents"),
    ]


def extract(triaged: DataFrame) -> DataFrame:
    """A staged row for each kept line, in one narrow projection."""
    kept = triaged.where("status = 'filtered'").select("entity", "verdict.role", "verdict.reason")
    return kept.select(*staged_columns(F.col("entity"), F.col("role"), F.col("reason")))


def entry_columns(e: Column, found: bool = False) -> list[Column]:
    """What any entity may be asked for later, in or out of the catalog: names, and the claims of albums and tracks."""
    claims = e["claims"]
    of = targets_in(claims, found)
    return [
        e["id"].alias("qid"),
        english(e["labels"]).alias("name"),
        resolved_label(e["labels"], e["sitelinks"]).alias("label"),
        english(e["descriptions"]).alias("description"),
        precise_date(claims, "P577").alias("release_date"),
        first(targets(claims, "P264")).alias("record_label_qid"),
        duration_seconds(claims, "P2047").alias("duration_seconds"),
        first(of("P136")).alias("genre_qid"),
        first(of("P361")).alias("parent_album_qid"),
    ]


def entries(hits: DataFrame) -> DataFrame:
    """An entry for each decoded entity (column entity)."""
    return hits.select(*entry_columns(F.col("entity")))


def genre_entries(found: DataFrame) -> DataFrame:
    """(id, name) of entries that have an English label; a page title does not count here."""
    return found.where("qid <> '' and name <> ''").select(F.col("qid").alias("id"), "name")


def label_entries(found: DataFrame) -> DataFrame:
    return found.select("qid", "label", "description")


def enrichment(found: DataFrame, ids: DataFrame) -> DataFrame:
    """A row for each entry of an album or track in ``ids`` (kind, qid): release date, record label and genre, or duration and parent."""
    kinds = ids.where("kind in ('albums', 'tracks')").select("qid", F.when(F.col("kind") == "albums", "album").otherwise("track").alias("entity_type"))
    is_album = F.col("entity_type") == "album"
    of_album = lambda c: F.when(is_album, F.col(c)).alias(c)
    of_track = lambda c: F.when(~is_album, F.col(c)).alias(c)
    return found.join(kinds, "qid").select(
        F.col("qid").alias("entity_qid"),
        "entity_type",
        of_album("release_date"),
        of_album("record_label_qid"),
        of_track("duration_seconds"),
        of_album("genre_qid"),
        of_track("parent_album_qid"),
    )
