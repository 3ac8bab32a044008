"""Flows from dump lines to catalog tables: bootstrap, populate, update. A dump's lines are parsed once; what follows reads columns of stored tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from entitymart.operators import enrich, tables, update
from entitymart.operators.bitfilter import may_be_in
from entitymart.operators.extract import enrichment, entry_columns, genre_entries, label_entries, staged_columns, with_shared
from entitymart.operators.merge import insert_or_replace, one_per_key
from entitymart.profiles import MUSIC, Profile
from entitymart.schemas import KEYS
from entitymart.sources.dump import counted, triage
from entitymart.sources.storage import stored


@dataclass
class Bootstrap:
    triaged: DataFrame
    staged: DataFrame
    found: DataFrame
    tables: dict[str, DataFrame]
    #: Lines by what became of them, counted in the pass itself.
    counts: dict[str, int]


def entries_of(found: DataFrame, ids: DataFrame) -> DataFrame:
    """Entries whose qid is in ``ids``, few of all: the others are told by a bounded filter in the scan and do not travel."""
    return found.where(may_be_in(ids, F.col("qid"))).join(ids, "qid", "left_semi")


def bootstrap(lines: DataFrame, profile: Profile = MUSIC) -> Bootstrap:
    """``lines``: (file, value). One narrow pass triages, classifies and extracts, and keeps an entry of every readable entity, so that
    names of genres, and later labels and enrichment, are joins of slim columns and the lines are not read again."""
    status, entity = F.col("status"), F.col("entity")
    parsed = with_shared(triage(lines, profile)).select(
        "file", "status", "reason", "verdict",
        F.when(status == "rejected", F.col("value")).alias("value"),
        F.when(status == "filtered", F.struct(*staged_columns(entity, F.col("verdict.role"), F.col("verdict.reason"), found=True))).alias("staged"),
        F.when(status.isin("filtered", "excluded"), F.struct(*entry_columns(entity, found=True))).alias("entry"),
    )
    counts = Observation("triage")
    triaged = stored(parsed.observe(counts, *counted()), "triaged")
    staged = triaged.where("status = 'filtered'").select("staged.*")
    found = triaged.where("status in ('filtered', 'excluded')").select("entry.*")
    met = entries_of(found, tables.genre_ids(staged))
    genre = stored(one_per_key(genre_entries(met), KEYS["genre"]), "genre")
    return Bootstrap(triaged, staged, found, tables.bootstrap_tables(staged, genre), counts.get)


@dataclass
class Populated:
    sets: DataFrame
    labels: DataFrame
    enriched: DataFrame
    tables: dict[str, DataFrame]


def populate(found: DataFrame, t: dict[str, DataFrame]) -> Populated:
    """Labels of all ids, and of record labels that albums name, and enrichment of works. ``found``: entries, of a bootstrap or, for
    a dump that was not parsed here, ``entries(by_ids(lines, ids))``."""
    sets = stored(enrich.id_sets(t), "id-sets")
    enriched = stored(enrichment(found, sets), "enriched")
    named = label_entries(found.join(enrich.wanted_ids(sets, enriched), "qid", "left_semi"))
    labels = stored(one_per_key(named, KEYS["qid_label"]), "labels")
    return Populated(sets, labels, enriched, enrich.populate(t, labels, enriched))


def populate_if_needed(found: DataFrame, t: dict[str, DataFrame], force: bool = False) -> tuple[dict[str, DataFrame], bool]:
    """Tables after ``populate``, and True; or as they are, and False, where no album still has its id for a name. The look at the albums ends at the first such one."""
    if not force and t["album"].where("name = id").isEmpty():
        return t, False
    return populate(found, t).tables, True


def with_retries(t: dict[str, DataFrame], changes: DataFrame) -> DataFrame:
    """Changes, and failed ones of earlier batches that wait for an entity among them."""
    again = update.tried_again(t, changes)
    rows = changes.select("qid", "modified", "value", F.lit(0).alias("tries"))
    return rows if again is None else rows.unionByName(again)


def run_update(t: dict[str, DataFrame], changes: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables, and the state that updates carry on, after a batch of changes (qid, modified, value), and what was decided for each entity."""
    decided = stored(update.decide(update.parse(with_retries(t, changes)), t), "decided")
    return update.upsert(t, decided), decided


def sync(
    t: dict[str, DataFrame], changes: DataFrame, since: str | None = None, dry_run: bool = False, late: str | None = None
) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """An update from where the last one ended, or from ``since`` (an ISO time), and the cursor's new place in ``sync_state``. Without either it
    fails. A dry run only decides; without changes nothing is decided and nothing moves. ``late`` (an interval, such as ``3 days``) reads that much again before the
    cursor for changes that came late; those already seen change nothing."""
    since = since or update.cursor_of(t.get("sync_state"))
    if since is None:
        raise ValueError("no update has run on these tables: say since when")
    first = F.lit(since).cast("timestamp") - F.expr(f"interval {late}") if late else F.lit(since).cast("timestamp")
    recent = changes.where(F.col("modified") >= first)
    if dry_run:
        return t, update.decide(update.parse(with_retries(t, recent)), t)
    cursor = stored(update.cursor_after(recent), "cursor")
    if cursor.isEmpty():
        return t, None
    new, decided = run_update(t, recent)
    state = t.get("sync_state")
    return new | {"sync_state": cursor if state is None else insert_or_replace(state, cursor, KEYS["sync_state"])}, decided
