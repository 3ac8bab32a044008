"""Incremental updates: changed entities are decoded, classified, split by outcome and merged into the tables.

A batch's agents count as present for its own references, unless they fail themselves. Nothing is ever deleted.

Batches may come in any order. Beside the tables stand the change that each row comes from, so an older change replaces nothing and only adds what nothing
ever takes away; failed changes, tried again when a group that they wait for arrives; and references to entities that are not known yet.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from entitymart.operators.classify import branches
from entitymart.operators.extract import staged_columns
from entitymart.operators.bitfilter import may_be_in
from entitymart.operators.merge import apart, insert_or_ignore, insert_or_replace, may_repeat, one_per_key
from entitymart.operators.tables import agents, as_is, of_agents, parent_refs, performer_refs
from entitymart.profiles import MUSIC, Profile
from entitymart.schemas import KEYS, STATE, STATE_KEYS
from entitymart.sources.dump import decode, triage
from entitymart.sources.storage import stored

ENTITY_PREFIX = "http://www.wikidata.org/entity/"
CURSOR = "last_sync"
OUTCOMES = ("upserted", "stale", "skipped", "failed")


def decode_bindings(responses: DataFrame, prefix: str = ENTITY_PREFIX) -> DataFrame:
    """(qid) of result pages in the ``results.bindings[].item.value`` form, those with the prefix only."""
    schema = "results struct<bindings:array<struct<item:struct<value:string>>>>"
    found = responses.select(F.explode(F.from_json("value", schema)["results"]["bindings"]).alias("b")).select(F.col("b.item.value").alias("uri"))
    return found.where(F.col("uri").startswith(prefix)).select(F.substring("uri", len(prefix) + 1, 1 << 20).alias("qid"))


def decode_envelope(responses: DataFrame) -> DataFrame:
    """(qid, value, problem) of ``{"entities": {qid: entity}}``. A response without entities, or with an entity marked as missing, gives a row
    that says so in ``problem``, for its caller to try again or report."""
    entities = F.from_json(F.get_json_object("value", "$.entities"), "map<string,string>")
    rows = responses.select(F.explode_outer(entities).alias("qid", "value"))
    missing = F.col("value").isNull() | F.get_json_object("value", "$.missing").isNotNull()
    return rows.withColumn("problem", F.when(F.col("qid").isNull(), "no entity in the response").when(missing, "the entity is missing"))


def modified_since(changes: DataFrame, since: Column, profile: Profile = MUSIC) -> DataFrame:
    """Distinct qid of entities that match the profile and changed at ``since`` or later."""
    recent = triage(changes.where(F.col("modified") >= since).select(F.lit("").alias("file"), "value"), profile)
    return recent.where("status = 'filtered'").select(F.col("entity.id").alias("qid")).distinct()


def matched_branches(changes: DataFrame, since: Column, profile: Profile = MUSIC) -> DataFrame:
    """(qid, branch): why entities changed at ``since`` or later belong in the catalog, for an audit of ``modified_since``."""
    rows = decode(changes.where(F.col("modified") >= since).select(F.lit("").alias("file"), "value"))
    found = rows.where("entity.id is not null and entity.type is not null and entity.broken is null")
    return found.select(F.col("entity.id").alias("qid"), F.explode(branches(F.col("entity.claims"), profile)).alias("branch")).distinct()


def keyset_page(df: DataFrame, cursor: str | None, n: int, key: str = "id") -> DataFrame:
    """The next ``n`` rows after ``cursor`` in key order: a pushed filter and a top-n, no offset."""
    return (df if cursor is None else df.where(F.col(key) > cursor)).orderBy(key).limit(n)


def keyset_pages(page: Callable[[str | None], DataFrame], n: int, key: str = "id", most: int = 10_000) -> Iterator[list[Row]]:
    """All pages in turn, each brought to the caller, up to the first with fewer than ``n`` rows. ``page`` gives the rows after a cursor. A cursor
    that stands still and a source of over ``most`` pages are errors: they would never end."""
    cursor = None
    for _ in range(most):
        rows = page(cursor).collect()  # n rows at most
        if rows:
            yield rows
        if len(rows) < n:
            return
        if cursor is not None and rows[-1][key] <= cursor:
            raise ValueError(f"the page after {cursor} ends at {rows[-1][key]}")
        cursor = rows[-1][key]
    raise ValueError(f"more than {most} pages")


LONG_BEFORE = "0001-01-01"


def mark(value: Column) -> Column:
    """Tells changes of one entity at one time apart, in the same order in every batch."""
    return F.xxhash64(value)


def at(prefix: str = "") -> Column:
    """What orders changes: the time (none is the earliest), then the mark."""
    return F.struct(F.coalesce(F.col(f"{prefix}modified"), F.lit(LONG_BEFORE).cast("timestamp")).alias("modified"), F.col(f"{prefix}mark").alias("mark"))


def newest(changes: DataFrame) -> DataFrame:
    """The last change of each qid; of changes at one time that of the greatest mark. Of changes in one batch only this one counts, as if fetched once;
    those that are tried again come from other batches and count each for itself. Only entities that may have several changes send their texts."""
    tries = F.col("tries") if "tries" in changes.columns else F.lit(0)
    rows = changes.select("qid", "modified", mark(F.col("value")).alias("mark"), "value", tries.alias("tries"))
    again = F.when(F.col("tries") > 0, F.col("mark")).alias("again")
    last = lambda df: df.groupBy("qid", again).agg(F.max(F.struct("modified", "mark", "value", "tries")).alias("x")).select("qid", "x.*")
    return apart(rows, may_repeat(changes, "qid") | F.col("qid").isNull(), lambda df: df, last)


def state_of(t: dict[str, DataFrame], name: str, spark: SparkSession) -> DataFrame:
    return t[name] if name in t else spark.createDataFrame([], STATE[name])


def reaching(hops: DataFrame, targets: DataFrame, most: int = 64) -> DataFrame:
    """(qid), stored: ``targets`` and all that lead to one over ``hops`` (qid, to), over any number of hops.

    Each round looks twice as far as the one before, so a chain of n takes log n rounds; rounds end with the first that finds nothing, so cycles do too.
    Who has been found drops out of the hops."""
    found = stored(targets.select("qid").distinct(), "reached")
    if found.isEmpty():
        return found
    hops = stored(hops.select("qid", "to").distinct(), "hops")
    for _ in range(most):
        more = stored(hops.join(found.select(F.col("qid").alias("to")), "to", "left_semi").select("qid").distinct().join(found, "qid", "left_anti"), "reached-more")
        if more.isEmpty():
            return found
        found = stored(found.union(more), "reached")
        left = hops.join(found, "qid", "left_anti")
        hops = stored(left.join(hops.select(F.col("qid").alias("to"), F.col("to").alias("beyond")), "to").select("qid", F.col("beyond").alias("to")).distinct(), "hops")
    raise ValueError(f"chains of over 2^{most}")


def failing(edges: DataFrame, standing: DataFrame, arriving: DataFrame) -> DataFrame:
    """(qid) of members that must fail: a group of theirs neither stands in the table nor comes with this batch, or comes but fails. ``edges``: (qid, to) from
    members to groups; ``standing`` and ``arriving``: (id). New groups that name each other in a circle, and nobody unknown, stay."""
    named = lambda ids: ids.select(F.col("id").alias("to")).distinct()
    open_ = stored(edges.join(named(standing), "to", "left_anti"), "open-groups")
    lost = open_.join(named(arriving), "to", "left_anti").select("qid")
    return reaching(open_.join(named(arriving), "to", "left_semi"), lost)


def tried_again(t: dict[str, DataFrame], changes: DataFrame) -> DataFrame | None:
    """Failed changes of earlier batches (as changes, with their tries) that wait, over any number of steps, for an entity that this batch brings or that
    has come to stand since."""
    if "retry" not in t or "waiting" not in t:
        return None
    waits = t["waiting"].where("kind = 'member'").select(F.col("id").alias("qid"), F.col("ref").alias("to"))
    standing = waits.select(F.col("to").alias("id")).join(t["artist"], "id", "left_semi")
    brought = reaching(waits, changes.select("qid").union(standing))
    woken = waits.join(brought.select(F.col("qid").alias("to")), "to", "left_semi").select("qid").distinct()
    return t["retry"].join(woken, "qid", "left_semi").select("qid", "modified", "value", "tries")


def parse(changes: DataFrame, profile: Profile = MUSIC) -> DataFrame:
    """The newest changes with what was extracted in ``staged``, stored. ``id`` is the entity's own. The text stays only where the change may fail."""
    rows = newest(changes).select("qid", "modified", "mark", "tries", F.lit("").alias("file"), "value")
    staged = F.when(F.col("status") == "filtered", F.struct(*staged_columns(F.col("entity"), F.col("verdict.role"), F.col("verdict.reason"))))
    parsed = triage(rows, profile).select("qid", "modified", "mark", "tries", "status", "reason", "verdict", staged.alias("staged"), "value")
    may_fail = (F.col("status") == "rejected") | (F.size("staged.member_of") > 0)
    return stored(parsed.withColumns({"value": F.when(may_fail, F.col("value")), "id": F.coalesce("staged.id", "qid")}), "changes-parsed")


def decide(parsed: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    """Parsed changes with their outcome: upserted; stale (what stands in that role is newer: only references are added); skipped (no longer of interest); or
    failed (unreadable, or member of a group that is unknown or fails itself)."""
    own, its = Window.partitionBy("id", "verdict.role"), F.when(F.col("status") == "filtered", at())
    alone, beside = (lambda df: df.withColumn("last", its)), (lambda df: df.withColumn("last", F.max(its).over(own)))  # a few rows an entity
    repeats = may_repeat(parsed, "id") | F.col("id").isNull()
    rows = apart(parsed, repeats, alone, beside)
    members = rows.where("status = 'filtered' and verdict.role = 'Agent'").select("id", "mark", (at() == F.col("last")).alias("lead"), "staged.member_of")
    edges = stored(members.select("id", "mark", "lead", F.explode_outer("member_of").alias("to")), "members")
    # Of several changes of an agent the last one tells whether it arrives; each change then fails or not by its own groups.
    arriving = edges.where("lead").select("id").distinct()
    bad = failing(edges.where("lead and to is not null").select(F.col("id").alias("qid"), "to"), t["artist"].select("id"), arriving)
    there = t["artist"].select("id").union(arriving.join(bad.select(F.col("qid").alias("id")), "id", "left_anti")).select(F.col("id").alias("to"))
    lost = stored(edges.where("to is not null").join(there, "to", "left_anti").groupBy("id", "mark").agg(F.collect_set("to").alias("missing")), "lost-groups")
    # Whole rows move only where an entity may have several changes, or a group of it is missing.
    found_missing = lambda df: beside(df).join(lost, ["id", "mark"], "left")
    rows = apart(parsed, repeats | may_be_in(lost.select("id"), F.col("id")), lambda df: alone(df).withColumn("missing", F.lit(None).cast("array<string>")), found_missing)
    newer = at() < F.col("last")
    if "entity_version" in t:
        known = t["entity_version"].select(F.col("qid").alias("id"), F.col("role").alias("_role"), F.col("modified").alias("_modified"), F.col("mark").alias("_mark"), "named")
        rows = rows.join(known, (rows["id"] == known["id"]) & (F.col("verdict.role") == F.col("_role")), "left").drop(known["id"])
        newer = newer | (F.col("_mark").isNotNull() & (at() <= at("_")))
    outcome = (
        F.when(F.col("status") == "rejected", "failed").when(F.col("status") != "filtered", "skipped").when(F.col("missing").isNotNull(), "failed")
        .when(newer, "stale").otherwise("upserted")
    )
    named = F.coalesce("named", F.lit(True)) if "entity_version" in t else F.lit(True)
    return rows.select("qid", "id", "modified", "mark", "tries", "verdict", "staged", "reason", "missing", "value", named.alias("named"), repeats.alias("several"), outcome.alias("outcome"))


def outcomes(changes: DataFrame, artist: DataFrame, profile: Profile = MUSIC) -> DataFrame:
    """What would become of changes to a catalog of these artists that has not been updated before."""
    return decide(parse(changes, profile), {"artist": artist})


def plan(decided: DataFrame) -> DataFrame:
    """What a dry run reports."""
    return decided.select("qid", F.col("verdict.role").alias("role"), "outcome")


def summary(decided: DataFrame) -> DataFrame:
    return decided.groupBy("outcome").agg(F.count("*").alias("n"))


def upsert_labels(t: dict[str, DataFrame], batch: DataFrame) -> dict[str, DataFrame]:
    """A label that stands stays, unless an update brought it from a change later than this one: so the earliest label stays whatever the order."""
    rows = batch.where("name is not null").select(F.col("id").alias("qid"), at().alias("at"), F.col("name").alias("label"), "description", "several")
    new = apart(rows, F.col("several"), lambda df: df.drop("several"), lambda df: one_per_key(df.drop("several"), ["qid"]))
    known = t["qid_label"].select("qid", F.lit(True).alias("known"))
    brought = state_of(t, "label_version", batch.sparkSession).select("qid", at().alias("before"))
    wins = F.col("known").isNull() | (F.col("before").isNotNull() & (F.col("at") < F.col("before")))
    chosen = stored(new.join(known, "qid", "left").join(brought, "qid", "left").where(wins).select("qid", "label", "description", "at.*"), "labels-brought")
    labels = insert_or_replace(t["qid_label"], chosen.select("qid", "label", "description"), KEYS["qid_label"])
    versions = insert_or_replace(state_of(t, "label_version", batch.sparkSession), chosen.select("qid", "modified", "mark"), ["qid"])
    return {"qid_label": labels, "label_version": versions}


def upsert_agents(t: dict[str, DataFrame], batch: DataFrame, fresh: DataFrame) -> dict[str, DataFrame]:
    """Artists are replaced by ``fresh`` rows; unknown genres enter under their ids; junction rows of the whole batch are added."""
    genres = of_agents(batch, "genres", "genre_id")
    placeholders = genres.select(F.col("genre_id").alias("id"), F.col("genre_id").alias("name"))
    return {
        "artist": insert_or_replace(t["artist"], agents(fresh), KEYS["artist"]),
        "genre": insert_or_ignore(t["genre"], placeholders, KEYS["genre"]),
        "artist_genre": insert_or_ignore(t["artist_genre"], genres, KEYS["artist_genre"]),
        "artist_instrument": insert_or_ignore(t["artist_instrument"], of_agents(batch, "instruments", "instrument_id"), KEYS["artist_instrument"]),
        "artist_member_of": insert_or_ignore(t["artist_member_of"], of_agents(batch, "member_of", "group_id"), KEYS["artist_member_of"]),
    }


def work_names(batch: DataFrame, role: str, qid_label: DataFrame) -> DataFrame:
    """(id, name): own label, else the known one, else the id. Of rows with one id the least name. An older change names a work only if the newer one, which
    decides, has no name: then by the known label."""
    rows = batch.where((F.col("role") == role) & (F.col("fresh") | ~F.col("named")))
    said = F.when(F.col("fresh"), F.col("name"))
    own = apart(rows, F.col("several"), lambda df: df.select("id", said.alias("own")), lambda df: df.groupBy("id").agg(F.min(said).alias("own")))
    named = own.join(qid_label.select(F.col("qid").alias("id"), "label"), "id", "left")
    return named.select("id", F.coalesce("own", "label", "id").alias("name"))


def ids_after(table: DataFrame, batch: DataFrame, role: str) -> DataFrame:
    """Ids of a table once the batch is in, without merging the rows."""
    return table.select("id").union(batch.where(F.col("role") == role).select("id"))


#: Junctions whose rows wait for a parent: the role they belong to, their own id, the parent's id and table.
REFERENCES = {
    "album_artist": ("Album", "album_id", "artist_id", "artist"),
    "track_artist": ("Track", "track_id", "artist_id", "artist"),
    "track_album": ("Track", "track_id", "album_id", "album"),
}


def references(batch: DataFrame) -> DataFrame:
    """(ref, kind, id, role) of all works of a batch, whether what they refer to is known or not."""
    made = lambda make, *args: apart(batch, F.col("several"), lambda rows: make(rows, *args, as_is), lambda rows: make(rows, *args))
    parents = made(parent_refs).select(F.col("album_id").alias("ref"), F.lit("track_album").alias("kind"), F.col("track_id").alias("id"), F.lit("").alias("role"))
    of = lambda kind: made(performer_refs, REFERENCES[kind][0], "id").select(F.col("artist_id").alias("ref"), F.lit(kind).alias("kind"), "id", "role")
    return parents.unionByName(of("album_artist")).unionByName(of("track_artist"))


def refer(t: dict[str, DataFrame], batch: DataFrame, parents: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Junctions with the references of the batch, and with those of earlier batches that waited for an entity that it brings. ``parents``: ids once the batch
    is in. Returns the junctions, references that go on waiting (new ones), and those that were waited for."""
    waiting, spark = t.get("waiting"), batch.sparkSession
    arrived = batch.where("role in ('Agent', 'Album')").select(F.col("id").alias("ref"), F.when(F.col("role") == "Agent", "artist").otherwise("album").alias("parent"))
    parent = F.when(F.col("kind") == "track_album", "album").otherwise("artist")
    woken = spark.createDataFrame([], STATE["waiting"])
    if waiting is not None:
        woken = stored(waiting.where("kind <> 'member'").withColumn("parent", parent).join(arrived, ["ref", "parent"], "left_semi").drop("parent"), "woken")
    known = parents["artist"].select(F.col("id").alias("ref"), F.lit("artist").alias("parent")).union(parents["album"].select("id", F.lit("album"))).distinct()
    asked = references(batch)
    if waiting is not None:
        asked = apart(asked, may_be_in(woken.select("id"), F.col("id")), lambda df: df, lambda df: df.unionByName(woken).distinct())
    asked = asked.withColumn("parent", parent)
    told = stored(asked.join(known.withColumn("there", F.lit(True)), ["ref", "parent"], "left").withColumn("there", F.coalesce("there", F.lit(False))), "references")
    kinds = {r[0] for r in told.where("there").select("kind").distinct().collect()}  # three at most
    new = {}
    for kind in kinds:
        _, own, other, _ = REFERENCES[kind]
        rows = told.where(F.col("there") & (F.col("kind") == kind))
        more = F.lit(None).cast("int").alias("track_number") if kind == "track_album" else F.col("role")
        new[kind] = insert_or_ignore(t[kind], rows.select(F.col("id").alias(own), F.col("ref").alias(other), more), KEYS[kind], different=True)
    return new, told.where("not there").select("ref", "kind", "id", "role"), woken


def upsert(t: Mapping[str, DataFrame], decided: DataFrame) -> Mapping[str, DataFrame]:
    """All tables, and the state beside them, after decided changes (stored: many tables read them): agents first, then albums, then tracks. A stale change
    adds its references and replaces nothing. Tables that the batch does not touch stay the frames they were."""
    spark = decided.sparkSession
    taken = decided.where("outcome in ('upserted', 'stale')")
    batch = taken.select("staged.*", "modified", "mark", "named", "several", (F.col("outcome") == "upserted").alias("fresh"))
    fresh = batch.where("fresh")
    roles = {r[0] for r in batch.select("role").distinct().collect()}  # three at most
    new = ChainMap({}, t)
    if roles:
        new |= upsert_labels(t, batch)
        parents = {"artist": ids_after(t["artist"], batch, "Agent"), "album": ids_after(t["album"], batch, "Album")}
        if "Agent" in roles:
            new |= upsert_agents(new, batch, fresh)
        for role, name in (("Album", "album"), ("Track", "track")):
            if role in roles:
                new[name] = insert_or_replace(t[name], work_names(batch, role, new["qid_label"]), KEYS[name])
        junctions, loose, woken = refer(t, batch, parents)
        version = fresh.select(F.col("id").alias("qid"), "role", "several", F.struct(*at_columns()).alias("v"), F.col("name").isNotNull().alias("named"))
        last = lambda df: df.groupBy("qid", "role").agg(F.max(F.struct("v", "named")).alias("x")).select("qid", "role", "x.*")
        version = apart(version, F.col("several"), lambda df: df.drop("several"), last).select("qid", "role", "v.*", "named")
        new |= junctions | {"entity_version": insert_or_replace(state_of(t, "entity_version", spark), version, STATE_KEYS["entity_version"])}
    else:
        loose = woken = spark.createDataFrame([], STATE["waiting"])
    return new | carried(t, decided, loose, woken)


def at_columns() -> list[Column]:
    return [at()["modified"].alias("modified"), at()["mark"].alias("mark")]


UNKNOWN_GROUP = "a group is unknown or failed"


def carried(t: dict[str, DataFrame], decided: DataFrame, loose: DataFrame, woken: DataFrame) -> dict[str, DataFrame]:
    """The state of failed changes and of references to unknown entities. A change that went well when tried again is no longer kept, nor an unreadable one
    once a readable one of its entity has come; one that fails again counts its tries."""
    spark = decided.sparkSession
    retry, waiting = state_of(t, "retry", spark), state_of(t, "waiting", spark)
    failed = decided.where("outcome = 'failed'")
    reason = F.coalesce("reason", F.lit(UNKNOWN_GROUP))
    now = failed.select("qid", "modified", "mark", "value", reason.alias("reason"), (F.col("tries") + 1).cast("int").alias("tries"))
    tried = decided.where("tries > 0")
    settled = tried.unionByName(failed).select("qid", "mark").distinct()
    readable = decided.where("outcome <> 'failed'").select("qid", F.lit(True).alias("readable")).distinct()
    left = retry.join(settled, ["qid", "mark"], "left_anti").join(readable, "qid", "left")
    left = left.where((F.col("reason") == UNKNOWN_GROUP) | F.col("readable").isNull()).select(*retry.columns)
    groups = failed.select(F.explode("missing").alias("ref"), F.lit("member").alias("kind"), F.col("qid").alias("id"), F.lit("").alias("role"))
    kept = waiting.where("kind <> 'member'").join(woken, STATE_KEYS["waiting"], "left_anti")
    still = waiting.where("kind = 'member'").join(tried.select(F.col("qid").alias("id")), "id", "left_anti").select("ref", "kind", "id", "role")
    return {"retry": left.unionByName(now), "waiting": kept.unionByName(still).unionByName(loose).unionByName(groups).distinct()}


def cursor_after(changes: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The sync cursor as a one-row table: the newest change seen, which a batch without changes leaves alone."""
    at = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    new = changes.agg(F.max("modified").alias("at")).where("at is not null").select(F.lit(CURSOR).alias("key"), at.alias("value"))
    return new if before is None else insert_or_replace(before, new, ["key"])


def cursor_of(sync_state: DataFrame | None) -> str | None:
    row = sync_state.where(F.col("key") == CURSOR).first() if sync_state is not None else None
    return row["value"] if row else None
