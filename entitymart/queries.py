"""Registered queries: the flows over dump lines rendered from the star tables, and SQL that states the expected rows over those tables."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymart.operators import audit, details, enrich, pages, search, tables, tokenindex, update
from entitymart.operators.extract import entries, genre_entries, label_entries
from entitymart.operators.merge import insert_or_ignore
from entitymart.plans.catalog import Bootstrap, Populated, bootstrap, populate, run_update, sync
from entitymart.schemas import FOREIGN_KEYS, KEYS
from entitymart.sources import feed, staging
from entitymart.sources.dump import by_ids, rejects, scan
from entitymart.sources.storage import StoredTables, latest, publish, shared_folder, stored
from entitymart.streaming.updates import apply_batch, start

ARTIST_TERM, ALBUM_TERM, TRACK_TERM, GENRE_TERM, ALL_TERM = "0001", "Order 1", "Item 1", "A", "er 1"
SINCE, LONG_AGO = "1998-01-01", "0001-01-01"
MIDDLE = "2024-01-16"
PAGE = 5000
FTS = {"artist": "machinery 000000012", "album": "order 12", "track": "item 12 1"}


class Catalog:
    """The flows over one set of star tables; each is run when first asked for and kept as stored tables for the session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @functools.cached_property
    def lines(self) -> DataFrame:
        folder = shared_folder(self.spark, "dump")
        feed.write_dump(feed.dump_lines(self.spark, self.sf_dir), folder)
        return scan(self.spark, folder)

    @functools.cached_property
    def first(self) -> Bootstrap:
        return bootstrap(self.lines)

    @functools.cached_property
    def second(self) -> Populated:
        return populate(self.first.found, self.first.tables)

    @functools.cached_property
    def tables(self) -> Mapping[str, DataFrame]:
        return StoredTables(self.second.tables, {"qid_label": self.second.labels, "genre": self.first.tables["genre"]})

    @functools.cached_property
    def changes(self) -> DataFrame:
        return stored(feed.change_lines(self.spark, self.sf_dir), "changes")

    @functools.cached_property
    def updated(self) -> tuple[Mapping[str, DataFrame], DataFrame]:
        return sync(self.tables, self.changes, LONG_AGO)


_catalogs: dict[tuple[str, str], Catalog] = {}


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _catalogs:
        _catalogs[key] = Catalog(spark, sf_dir)
    return _catalogs[key]


def texts(df: DataFrame) -> DataFrame:
    """Dates as ISO text."""
    return df.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes])


def joined(df: DataFrame, **vectors) -> DataFrame:
    """Vectors as text."""
    return df.select(*[F.array_join(vectors.get(c, F.col(c)), "|").alias(c) if t.startswith("array") else F.col(c) for c, t in texts(df).dtypes])


def staged_text(df: DataFrame) -> DataFrame:
    return texts(df.withColumn("performers", F.transform("performers", lambda p: F.concat(p["qid"], F.lit(":"), p["role"])))).transform(joined)


def stage_roundtrip(c: Catalog) -> DataFrame:
    path = shared_folder(c.spark, "staged-files")
    staging.write_staged(c.first.staged, path)
    return staged_text(staging.read_staged(c.spark, path)).select("id", "role", "genres", "performers", "parents")


def flat_roundtrip(c: Catalog) -> DataFrame:
    flat = stored(staging.to_flat(c.first.staged), "flat")
    return staged_text(staging.from_flat(flat)).select("id", "role", "birth_date", "genres", "instruments", "member_of", "performers", "parents")


def bindings(c: Catalog) -> DataFrame:
    """Result pages as a service would give them: an entity and a foreign address for each customer."""
    customer = c.spark.read.parquet(f"{c.sf_dir}/customer.parquet")
    item = lambda uri: F.struct(F.struct(F.lit("uri").alias("type"), uri.alias("value")).alias("item"))
    pair = F.array(item(F.concat(F.lit(update.ENTITY_PREFIX), feed.qid("QC", F.col("c_custkey")))), item(F.lit("http://example.org/entity/Q1")))
    return update.decode_bindings(customer.select(F.to_json(F.struct(F.struct(pair.alias("bindings")).alias("results"))).alias("value")))


def envelopes(c: Catalog) -> DataFrame:
    """Suppliers as a service would send them; every seventh is missing there."""
    supplier = c.spark.read.parquet(f"{c.sf_dir}/supplier.parquet")
    qid = feed.qid("QS", F.col("s_suppkey"))
    line = feed.line(qid, F.col("s_name"), feed.claims(P31=[feed.target(F.lit("Q215380"))]))
    entity = F.when(F.col("s_suppkey") % 7 == 0, F.concat(F.lit('{"id":"'), qid, F.lit('","missing":""}'))).otherwise(F.regexp_replace(line, ",$", ""))
    found = update.decode_envelope(supplier.select(F.concat(F.lit('{"entities":{"'), qid, F.lit('":'), entity, F.lit("}}")).alias("value")))
    return found.select("qid", F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", "$.labels.en.value").alias("label"), "problem")


def update_stream(c: Catalog) -> DataFrame:
    """Publishes the tables, streams the changes in, and returns the artists of the newest snapshot."""
    root, landing = shared_folder(c.spark, "snapshots"), shared_folder(c.spark, "landing")
    publish(c.tables, root, 1)
    c.changes.write.option("compression", "gzip").json(landing)
    changes = c.spark.readStream.schema("qid string, modified timestamp, value string").json(landing)
    start(changes, root, shared_folder(c.spark, "stream-checkpoint")).awaitTermination()
    return texts(latest(c.spark, root).tables["artist"])


def artist_terms(c: Catalog) -> DataFrame:
    """A term for every customer: whole names, parts, short ends, wildcards, and descriptions that many artists have."""
    k, name = F.col("c_custkey"), F.col("c_name")
    parts = [name, F.substring(name, 12, 20), F.concat(F.lit("%"), k.cast("string"), F.lit("_")), F.substring(name, 17, 20)]
    term = F.col("c_mktsegment")
    for i, part in enumerate(parts):
        term = F.when(k % 5 == i, part).otherwise(term)
    return c.spark.read.parquet(f"{c.sf_dir}/customer.parquet").select(term.alias("term"))


def search_terms(c: Catalog) -> DataFrame:
    return search.search_terms(c.tables["artist"], artist_terms(c), ["name", "description"], exact_first=True)


def genre_rescan(c: Catalog) -> DataFrame:
    """Names of genres from the raw lines, for the genres that staged rows refer to."""
    return genre_entries(entries(by_ids(c.lines, tables.genre_ids(c.first.staged))))


def label_rescan(c: Catalog) -> DataFrame:
    """Labels from the raw lines, for all ids that the tables ask for."""
    return label_entries(entries(by_ids(c.lines, enrich.wanted_ids(c.second.sets, c.second.enriched)))).dropDuplicates(["qid"])


def member_chain(c: Catalog) -> DataFrame:
    """What becomes of agents that are members of each other in long chains."""
    _, decided = run_update(c.tables, feed.chain_changes(c.spark, c.sf_dir)[0])
    return decided.select("qid", "outcome")


def update_retry(c: Catalog) -> DataFrame:
    """Two batches: chains of which some fail, then groups that some of them wait for. Where each member of a chain stands, and how often it was tried."""
    chains, groups = feed.chain_changes(c.spark, c.sf_dir)
    first = {name: stored(df, name) for name, df in run_update(c.tables, chains)[0].items()}
    new, _ = run_update(first, groups)
    stands = new["artist"].where("id like 'QM%'").select(F.col("id").alias("qid"), F.lit("artist").alias("place"), F.lit(0).alias("tries"))
    return stands.unionByName(new["retry"].select("qid", F.lit("retry").alias("place"), "tries"))


def update_late(c: Catalog) -> DataFrame:
    """Snapshots in buckets, and two batches in the wrong order: later changes first, then earlier ones."""
    root = shared_folder(c.spark, "snapshots")
    publish(c.tables, root, 1, buckets=16)
    changes = stored(feed.late_changes(c.spark, c.sf_dir), "late-changes")
    for number, some in enumerate((F.col("modified") >= MIDDLE, F.col("modified") < MIDDLE)):
        apply_batch(root, lambda spark: "late")(changes.where(some), number)
    return texts(latest(c.spark, root).tables["artist"])


def fts(table: str, *columns: str) -> Callable[[Catalog], DataFrame]:
    def run(c: Catalog) -> DataFrame:
        index = stored(search.token_index(c.tables[table], list(columns)), "tokens")
        return search.token_search(c.tables[table], index, FTS[table], list(columns))

    return run


def layout(name: str, make: Callable[[Catalog], DataFrame], *columns: str) -> Callable[[Catalog], DataFrame]:
    """A table through a file of the named layout."""

    def run(c: Catalog) -> DataFrame:
        path = shared_folder(c.spark, name)
        staging.write_layout(make(c), name, path)
        return texts(staging.read_layout(c.spark, name, path)).select(*columns)

    return run


def fts_terms(c: Catalog) -> DataFrame:
    """Many queries against an index that was built before the updates and has followed them."""
    columns, after = ["name", "description"], c.updated[0]["artist"]
    index = tokenindex.build(c.tables["artist"], columns, shared_folder(c.spark, "token-index"), buckets=16)
    index = tokenindex.bring_up_to_date(index, after, tokenindex.changed(c.tables["artist"], after), columns)
    number = F.substring("c_name", 10, 9)
    query = F.when(F.col("c_custkey") % 50 == 0, F.concat("c_mktsegment", F.lit(" "), number)).otherwise(number)
    return tokenindex.search_many(index, after, c.spark.read.parquet(f"{c.sf_dir}/customer.parquet").select(query.alias("query")))


def dangling(c: Catalog) -> DataFrame:
    """The audit over references as they were staged, before any guard."""
    t, staged = c.first.tables, c.first.staged
    of_role = lambda role, name: staged.where(F.col("role") == role).select(F.col("id").alias(name), F.explode("performers.qid").alias("artist_id")).distinct()
    raw = {
        "artist_genre": tables.of_agents(staged, "genres", "genre_id"), "artist_member_of": tables.of_agents(staged, "member_of", "group_id"),
        "album_artist": of_role("Album", "album_id"), "track_artist": of_role("Track", "track_id"),
    }
    parents = {name: t[name] for name in ("artist", "genre", "album", "track")}
    return audit.orphans(raw | parents)


def tables_query(name: str) -> Callable[[Catalog], DataFrame]:
    return lambda c: texts(c.first.tables[name])


def artist_hits(c: Catalog) -> DataFrame:
    return search.search_artist(c.tables["artist"], ARTIST_TERM)


def album_hits(c: Catalog) -> DataFrame:
    return search.search_album(c.tables["album"], ALBUM_TERM)


def genre_hits(c: Catalog) -> DataFrame:
    return search.search_genre(c.tables["genre"], GENRE_TERM)


def enriched(c: Catalog, kind: str, *columns: str) -> DataFrame:
    return texts(c.second.enriched.where(F.col("entity_type") == kind).select("entity_qid", *columns))


QUERIES: dict[str, Callable[[Catalog], DataFrame]] = {
    "line_triage": lambda c: c.spark.createDataFrame([c.first.counts], ", ".join(f"{k} long" for k in c.first.counts)),
    "rejects": lambda c: rejects(c.first.triaged).select("raw", "reason"),
    "classify": lambda c: c.first.triaged.where("verdict is not null").select("staged.id", "verdict.role", "verdict.reason"),
    "reason_distribution": lambda c: audit.reasons(c.first.tables["artist"]),
    "extract_agent": lambda c: staged_text(c.first.staged.where("role = 'Agent'")).drop("performers", "parents", "role"),
    "extract_work": lambda c: staged_text(c.first.staged.where("role <> 'Agent'")).select("id", "role", "name", "genres", "performers", "parents"),
    "genre": tables_query("genre"),
    "artist": tables_query("artist"),
    "artist_genre": tables_query("artist_genre"),
    "artist_instrument": tables_query("artist_instrument"),
    "artist_member_of": tables_query("artist_member_of"),
    "album": lambda c: c.first.tables["album"].select("id", "name"),
    "album_artist": tables_query("album_artist"),
    "track": lambda c: c.first.tables["track"].select("id", "name"),
    "track_artist": tables_query("track_artist"),
    "track_album": lambda c: c.first.tables["track_album"].select("track_id", "album_id"),
    "load_summary": lambda c: audit.summary(c.first.tables),
    "orphan_audit": lambda c: audit.orphans(c.tables),
    "battery": lambda c: audit.battery(c.tables),
    "idempotent_load": lambda c: texts(insert_or_ignore(c.tables["artist"], c.first.tables["artist"], KEYS["artist"])),
    "search_artist": lambda c: texts(artist_hits(c)),
    "search_album": lambda c: texts(album_hits(c)),
    "search_track": lambda c: search.search_track(c.tables["track"], TRACK_TERM),
    "search_genre": genre_hits,
    "search_all": lambda c: search.search_all(c.tables, ALL_TERM),
    "artist_genres": lambda c: details.artist_genres(artist_hits(c), c.tables),
    "artist_albums": lambda c: texts(details.artist_albums(artist_hits(c), c.tables)),
    "all_artist_albums": lambda c: texts(details.artist_albums(c.tables["artist"], c.tables)),
    "artist_instruments": lambda c: details.artist_instruments(artist_hits(c), c.tables),
    "album_artists": lambda c: details.album_artists(album_hits(c), c.tables),
    "album_genres": lambda c: details.album_genres(album_hits(c), c.tables),
    "album_tracks": lambda c: details.album_tracks(album_hits(c), c.tables),
    "genre_artists": lambda c: details.genre_artists(genre_hits(c), c.tables),
    "artist_cards": lambda c: texts(details.artist_cards(artist_hits(c), c.tables)),
    "album_cards": lambda c: texts(details.album_cards(album_hits(c), c.tables)),
    "genre_cards": lambda c: details.genre_cards(genre_hits(c), c.tables),
    "qid_sets": lambda c: c.second.sets,
    "qid_label": lambda c: c.tables["qid_label"],
    "enrichment_album": lambda c: enriched(c, "album", "release_date", "record_label_qid", "genre_qid"),
    "enrichment_track": lambda c: enriched(c, "track", "duration_seconds", "parent_album_qid"),
    "backfill_names": lambda c: enrich.backfill_names(c.first.tables["artist"], c.tables["qid_label"], only_unresolved=True).select("id", "name"),
    "backfill_album": lambda c: texts(c.tables["album"]),
    "backfill_track": lambda c: c.tables["track"],
    "instrument": lambda c: c.tables["instrument"],
    "record_label": lambda c: c.tables["record_label"],
    "album_genre": lambda c: c.tables["album_genre"],
    "track_album_enriched": lambda c: c.tables["track_album"].select("track_id", "album_id"),
    "resolution_counts": lambda c: audit.resolution(c.tables),
    "modified_since": lambda c: update.modified_since(c.changes, F.lit(SINCE).cast("timestamp")),
    "branch_audit": lambda c: update.matched_branches(c.changes, F.lit(SINCE).cast("timestamp")).groupBy("branch").agg(F.count("*").alias("n")),
    "keyset_pages": lambda c: pages.borders(c.tables["artist"], PAGE),
    "keyset_page": lambda c: update.keyset_page(c.tables["artist"].select("id"), "QC5", 50),
    "decode_bindings": bindings,
    "decode_envelope": envelopes,
    "upsert_agent": lambda c: texts(c.updated[0]["artist"]),
    "upsert_album": lambda c: texts(c.updated[0]["album"]),
    "upsert_track": lambda c: c.updated[0]["track"],
    "upsert": lambda c: audit.summary(c.updated[0]),
    "update_summary": lambda c: update.summary(c.updated[1]),
    "update_dry_run": lambda c: update.plan(sync(c.tables, c.changes, LONG_AGO, dry_run=True)[1]),
    "sync_state": lambda c: c.updated[0]["sync_state"],
    "update_stream": update_stream,
    "search_terms": search_terms,
    "genre_rescan": genre_rescan,
    "label_rescan": label_rescan,
    "member_chain": member_chain,
    "update_retry": update_retry,
    "update_late": update_late,
    "stage_roundtrip": stage_roundtrip,
    "flat_roundtrip": flat_roundtrip,
    "reject_file": layout("rejects", lambda c: rejects(c.first.triaged), "raw", "reason"),
    "genre_file": layout("genres", lambda c: c.first.tables["genre"], "id", "name"),
    "labels_file": layout("labels", lambda c: c.second.labels, "qid", "label", "description"),
    "enrichment_file": layout(
        "enrichment", lambda c: c.second.enriched, "entity_qid", "entity_type", "release_date", "record_label_qid", "duration_seconds", "genre_qid", "parent_album_qid"
    ),
    "dangling_references": dangling,
    "fts_artist": fts("artist", "name", "description"),
    "fts_album": fts("album", "name"),
    "fts_track": fts("track", "name"),
    "fts_terms": fts_terms,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, f=f: f(catalog(spark, sf_dir))) for name, f in QUERIES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From dump lines to the first artists of every genre."""
    c = catalog(spark, sf_dir)
    return details.genre_artists(c.first.tables["genre"], c.first.tables)


# What the rendered dump must come to, stated over the star tables.
PRELUDE = """WITH
ns AS (SELECT count(*) AS s FROM supplier),
c0 AS (SELECT c_custkey AS k, 'QC' || c_custkey AS id, c_name, 'QN' || c_nationkey AS g, c_mktsegment AS seg, 'QS' || (c_custkey % ((SELECT s FROM ns) + 10)) AS grp FROM customer),
a0 AS (
  SELECT id, CASE WHEN k % 10 <> 0 THEN c_name END AS name, seg AS description, 'person' AS artist_type,
    CASE seg WHEN 'MACHINERY' THEN 'P106:Q639669' WHEN 'BUILDING' THEN 'P106:Q177220' WHEN 'AUTOMOBILE' THEN 'PROP:P136' ELSE 'PROP:P1303' END AS inclusion_reason,
    CASE WHEN seg IN ('MACHINERY', 'BUILDING') AND (k % 13 <> 0 OR k % 26 = 0) THEN strftime(DATE '1950-01-01' + CAST(k AS INTEGER), '%Y-%m-%d') END AS birth_date,
    CAST(NULL AS VARCHAR) AS death_date
  FROM c0 WHERE seg <> 'HOUSEHOLD'
  UNION ALL SELECT 'QS' || s_suppkey, s_name, NULL, 'group', 'P31:Q215380', NULL, NULL FROM supplier),
o0 AS (
  SELECT o_orderkey AS k, 'QO' || o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'Q' || o_orderkey ELSE 'Order ' || o_orderkey END AS label, 'QC' || o_custkey AS perf,
    CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-01') WHEN 2 THEN strftime(o_orderdate, '%Y-01-01') END AS release_date,
    'QL' || (o_orderkey % (SELECT count(*) FROM part)) AS lab, 'QN' || (o_orderkey % 25) AS g, o_orderdate FROM orders),
t0 AS (
  SELECT 'QT' || l_orderkey || 'x' || l_linenumber AS id, 'Item ' || l_orderkey || '-' || l_linenumber AS name, 'QO' || l_orderkey AS alb, 'QS' || l_suppkey AS perf,
    CASE WHEN l_linenumber % 3 <> 2 THEN CAST(l_quantity AS BIGINT) * 10 END AS dur, l_orderkey AS k, l_shipdate FROM lineitem),
l0 AS (SELECT 'QL' || p_partkey AS id, CASE WHEN p_partkey % 9 <> 0 THEN p_name END AS label FROM part),
genre AS (SELECT 'QN' || n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey % 7 <> 0 AND 'QN' || n_nationkey IN (
  SELECT g FROM c0 WHERE seg IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') UNION SELECT g FROM o0)),
artist_genre AS (SELECT id AS artist_id, g AS genre_id FROM c0 WHERE seg IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') AND g IN (SELECT id FROM genre)),
artist_instrument AS (SELECT id AS artist_id, 'Q171' AS instrument_id FROM c0 WHERE seg = 'FURNITURE'),
artist_member_of AS (SELECT id AS artist_id, grp AS group_id FROM c0 WHERE seg IN ('MACHINERY', 'BUILDING') AND grp IN (SELECT id FROM a0)),
album0 AS (SELECT id, coalesce(label, id) AS name FROM o0),
album_artist AS (SELECT id AS album_id, perf AS artist_id, 'performer' AS role FROM o0 WHERE perf IN (SELECT id FROM a0)),
track0 AS (SELECT DISTINCT id, name FROM t0),
track_artist AS (SELECT DISTINCT id AS track_id, perf AS artist_id, 'performer' AS role FROM t0 WHERE perf IN (SELECT id FROM a0)),
track_album AS (SELECT DISTINCT id AS track_id, alb AS album_id FROM t0 WHERE alb IN (SELECT id FROM o0)),
album_genre AS (SELECT id AS album_id, g AS genre_id FROM o0 WHERE g IN (SELECT id FROM genre)),
qid_label AS (
  SELECT id AS qid, label, CAST(NULL AS VARCHAR) AS description FROM o0
  UNION ALL SELECT id, name, NULL FROM track0
  UNION ALL SELECT id, CASE WHEN k % 20 = 0 THEN replace(c_name, '#', ' ') END, seg FROM c0 WHERE seg <> 'HOUSEHOLD' AND k % 10 = 0
  UNION ALL SELECT id, name, NULL FROM genre
  UNION ALL SELECT DISTINCT instrument_id, 'Instrument 171', NULL FROM artist_instrument
  UNION ALL SELECT id, label, NULL FROM l0 WHERE id IN (SELECT lab FROM o0)),
artist AS (SELECT a0.id, coalesce(a0.name, q.label) AS name, a0.description, artist_type, inclusion_reason, birth_date, death_date FROM a0 LEFT JOIN qid_label q ON q.qid = a0.id AND a0.name IS NULL),
album AS (SELECT o0.id, coalesce(o0.label, o0.id) AS name, release_date, l0.label AS record_label FROM o0 LEFT JOIN l0 ON l0.id = o0.lab),
track AS (SELECT id, name, CAST(min(dur) AS INTEGER) AS duration_seconds FROM t0 GROUP BY id, name),
instrument AS (SELECT DISTINCT instrument_id AS id, 'Instrument 171' AS name FROM artist_instrument),
record_label AS (SELECT id, label AS name FROM l0 WHERE label IS NOT NULL AND id IN (SELECT lab FROM o0)),
qid_sets0 AS (
  SELECT 'albums' AS kind, id AS qid FROM album0 UNION ALL SELECT 'tracks', id FROM track0 UNION ALL SELECT 'artists_with_null_names', id FROM a0 WHERE name IS NULL
  UNION ALL SELECT DISTINCT 'instruments', instrument_id FROM artist_instrument UNION ALL SELECT 'genres', id FROM genre),
ah AS (SELECT * FROM artist WHERE name LIKE '%0001%' OR description LIKE '%0001%' ORDER BY (name = '0001') DESC NULLS LAST, name ASC NULLS LAST, id LIMIT 100),
bh AS (SELECT id, name, release_date FROM album WHERE name LIKE '%Order 1%' ORDER BY name, id LIMIT 100),
gh AS (SELECT id, name FROM genre WHERE name LIKE '%A%' ORDER BY name, id LIMIT 20),
ga AS (SELECT genre_id, artist_id, name, place FROM (SELECT genre_id, artist_id, ar.name, row_number() OVER (PARTITION BY genre_id ORDER BY ar.name ASC NULLS LAST, artist_id) AS place
  FROM artist_genre x JOIN artist ar ON ar.id = x.artist_id WHERE genre_id IN (SELECT id FROM gh)) WHERE place <= 20),
nc AS (SELECT count(*) AS n FROM customer),
tc AS (SELECT c0.*, m, CASE WHEN seg = 'HOUSEHOLD' THEN 'skipped' WHEN seg IN ('MACHINERY', 'BUILDING') AND grp NOT IN (SELECT id FROM a0) THEN 'failed' ELSE 'upserted' END AS outcome
  FROM c0 JOIN (SELECT user_id % (SELECT n FROM nc) AS k, max(ts) AS m FROM events GROUP BY 1) e ON e.k = c0.k),
uc AS (SELECT * FROM tc WHERE outcome = 'upserted'),
ug AS (SELECT id AS artist_id, g AS genre_id FROM uc WHERE seg IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') UNION SELECT id, 'QZ' || (k % 3) FROM uc WHERE seg IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE')),
uartist AS (SELECT artist.id, CASE WHEN uc.id IS NULL THEN artist.name WHEN k % 10 <> 0 THEN c_name || ' v2' END AS name, description, artist_type, inclusion_reason, birth_date, death_date
  FROM artist LEFT JOIN uc ON uc.id = artist.id)
"""

def _bm25(table: str, *columns: str, k1: float = 1.2, b: float = 0.75) -> str:
    words = lambda text: f"list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    return f""", fd AS (SELECT id, name, {words(f"concat_ws(' ', {', '.join(columns)})")} AS w FROM {table}),
fn AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM fd),
ft AS (SELECT id, len(w) AS len, unnest(w) AS token FROM fd),
fq AS (SELECT DISTINCT unnest({words(f"'{FTS[table]}'")}) AS token),
fh AS (SELECT id, len, token, count(*) AS tf FROM ft SEMI JOIN fq USING (token) GROUP BY ALL),
fc AS (SELECT token, count(*) AS df FROM fh GROUP BY 1),
fs AS (SELECT id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {k1 + 1} / (tf + {k1} * ({1 - b} + {b} * len / mean))), 9) AS score FROM fh JOIN fc USING (token), fn GROUP BY 1)
SELECT id, name, score FROM fd JOIN fs USING (id) ORDER BY coalesce(name = '{FTS[table]}', false) DESC, score DESC, name NULLS LAST, id LIMIT 100"""


#: Chains of members: who names whom, and who leads to a group that is unknown before and after the second batch.
_CHAINS = """, ch AS (SELECT 'QM' || k AS id, CASE WHEN k % 50 <> 49 THEN 'QM' || (k + 1) WHEN (k // 50) % 3 = 0 THEN 'QX' || (k // 50) WHEN (k // 50) % 3 = 2 THEN 'QM' || (k // 50 * 50) END AS grp FROM c0),
b1(id) AS (SELECT id FROM ch WHERE grp IS NOT NULL AND grp NOT IN (SELECT id FROM ch) UNION SELECT ch.id FROM ch JOIN b1 ON ch.grp = b1.id),
known AS (SELECT id FROM ch UNION ALL SELECT 'QX' || (k // 50) FROM c0 WHERE k % 50 = 49 AND (k // 50) % 6 = 0),
b2(id) AS (SELECT id FROM ch WHERE grp IS NOT NULL AND grp NOT IN (SELECT id FROM known) UNION SELECT ch.id FROM ch JOIN b2 ON ch.grp = b2.id)"""

_SELECT = {
    "member_chain": _CHAINS + "SELECT id AS qid, CASE WHEN id IN (SELECT id FROM b1) THEN 'failed' ELSE 'upserted' END AS outcome FROM ch",
    "update_retry": _CHAINS + "SELECT id AS qid, CASE WHEN id IN (SELECT id FROM b2) THEN 'retry' ELSE 'artist' END AS place, CAST(id IN (SELECT id FROM b2) AS INTEGER) AS tries FROM ch",
    "update_late": """SELECT artist.id, coalesce(l.name, artist.name) AS name, description, artist_type, inclusion_reason, birth_date, death_date
  FROM artist LEFT JOIN (SELECT id, c_name || ' ' || strftime(m, '%Y-%m-%d %H:%M:%S') AS name FROM uc) l ON l.id = artist.id""",
    "search_terms": """, st AS (SELECT DISTINCT CASE k % 5 WHEN 0 THEN c_name WHEN 1 THEN substr(c_name, 12) WHEN 2 THEN '%' || k || '_' WHEN 3 THEN substr(c_name, 17) ELSE seg END AS term FROM c0)
SELECT term, CAST(place AS INTEGER) AS place, id, name FROM (SELECT term, id, name, row_number() OVER (PARTITION BY term ORDER BY coalesce(name = term, false) DESC, name ASC NULLS LAST, id) AS place
  FROM artist JOIN st ON name LIKE '%' || term || '%' OR description LIKE '%' || term || '%') WHERE place <= 100""",
    "genre_rescan": "SELECT * FROM genre",
    "label_rescan": "SELECT * FROM qid_label",
    "line_triage": """SELECT 2 + (SELECT count(*) FROM nation) + b + p + 1 + s + c + o + l AS processed, a + o + l AS filtered, b AS rejected, (SELECT count(*) FROM nation) + p + 1 + c + s - a AS excluded,
  CAST(2 AS BIGINT) AS brackets FROM (SELECT (SELECT count(*) FROM nation WHERE n_nationkey % 5 = 0) AS b, (SELECT count(*) FROM l0) AS p, (SELECT s FROM ns) AS s, (SELECT n FROM nc) AS c,
  (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM lineitem) AS l, (SELECT count(*) FROM a0) AS a)""",
    "rejects": """SELECT '{"id":"QX' || n_nationkey || '","claims": broken},' AS raw, 'not an entity object' AS reason FROM nation WHERE n_nationkey % 5 = 0""",
    "classify": "SELECT id, 'Agent' AS role, inclusion_reason AS reason FROM a0 UNION ALL SELECT id, 'Album', 'P31:Q482994' FROM o0 UNION ALL SELECT id, 'Track', 'P31:Q7366' FROM t0",
    "reason_distribution": "SELECT inclusion_reason, count(*) AS n FROM a0 GROUP BY 1",
    "extract_agent": """SELECT a0.*, CASE WHEN seg IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') THEN g ELSE '' END AS genres, CASE WHEN seg = 'FURNITURE' THEN 'Q171' ELSE '' END AS instruments,
  CASE WHEN seg IN ('MACHINERY', 'BUILDING') THEN grp ELSE '' END AS member_of FROM a0 LEFT JOIN c0 ON c0.id = a0.id""",
    "extract_work": """SELECT id, 'Album' AS role, label AS name, g AS genres, perf || ':performer' AS performers, '' AS parents FROM o0
  UNION ALL SELECT id, 'Track', name, '', perf || ':performer', alb FROM t0""",
    "genre": "SELECT * FROM genre",
    "artist": "SELECT * FROM a0",
    "artist_genre": "SELECT * FROM artist_genre",
    "artist_instrument": "SELECT * FROM artist_instrument",
    "artist_member_of": "SELECT * FROM artist_member_of",
    "album": "SELECT * FROM album0",
    "album_artist": "SELECT * FROM album_artist",
    "track": "SELECT * FROM track0",
    "track_artist": "SELECT * FROM track_artist",
    "track_album": "SELECT * FROM track_album",
    "load_summary": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n FROM {source}"
        for name, source in {"album": "album0", "artist": "a0", "track": "track0"}.items() | {(x, x) for x in ("album_artist", "artist_genre", "artist_instrument", "artist_member_of", "genre", "track_album", "track_artist")}
    ),
    "orphan_audit": " UNION ALL ".join(f"SELECT '{c}.{k}' AS metric, count(*) AS n FROM {c} WHERE {k} NOT IN (SELECT id FROM {p})" for c, k, p in FOREIGN_KEYS),
    "dangling_references": """SELECT 'artist_genre.artist_id' AS metric, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'artist_member_of.artist_id', 0 UNION ALL SELECT 'album_artist.album_id', 0
  UNION ALL SELECT 'track_artist.track_id', 0 UNION ALL SELECT 'artist_genre.genre_id', count(*) FROM c0 WHERE seg IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') AND g NOT IN (SELECT id FROM genre)
  UNION ALL SELECT 'artist_member_of.group_id', count(*) FROM c0 WHERE seg IN ('MACHINERY', 'BUILDING') AND grp NOT IN (SELECT id FROM a0)
  UNION ALL SELECT 'album_artist.artist_id', count(*) FROM o0 WHERE perf NOT IN (SELECT id FROM a0)
  UNION ALL SELECT 'track_artist.artist_id', count(*) FROM (SELECT DISTINCT id, perf FROM t0 WHERE perf NOT IN (SELECT id FROM a0))""",
    "battery": """SELECT 'role_overlap' AS metric, count(*) AS n FROM album JOIN artist ON album.id = artist.id UNION ALL SELECT 'artists_with_albums', count(DISTINCT artist_id) FROM album_artist
  UNION ALL SELECT 'track_album_rows', count(*) FROM track_album UNION ALL SELECT 'tracks_with_duration', count(duration_seconds) FROM track
  UNION ALL SELECT 'albums_with_date', count(release_date) FROM album UNION ALL SELECT 'albums_named_by_id', count(*) FROM album WHERE name = id
  UNION ALL SELECT 'albums_named_like_an_id', count(*) FROM album WHERE regexp_matches(name, '^Q[0-9]+$')""",
    "idempotent_load": "SELECT * FROM artist",
    "search_artist": "SELECT id, name, description, artist_type, birth_date, death_date FROM ah",
    "search_album": "SELECT * FROM bh",
    "search_track": "SELECT * FROM track WHERE name LIKE '%Item 1%' ORDER BY name, id LIMIT 100",
    "search_genre": "SELECT * FROM gh",
    "search_all": """SELECT * FROM (SELECT 'artist' AS kind, id, name FROM artist WHERE name LIKE '%er 1%' OR description LIKE '%er 1%' ORDER BY name NULLS LAST, id LIMIT 100)
  UNION ALL SELECT * FROM (SELECT 'album', id, name FROM album WHERE name LIKE '%er 1%' ORDER BY name, id LIMIT 100) UNION ALL SELECT * FROM (SELECT 'track', id, name FROM track WHERE name LIKE '%er 1%' ORDER BY name, id LIMIT 100)""",
    "artist_genres": "SELECT artist_id, genre_id, genre.name, row_number() OVER (PARTITION BY artist_id ORDER BY genre.name NULLS LAST, genre_id) AS place FROM ah JOIN artist_genre ON artist_id = ah.id JOIN genre ON genre.id = genre_id",
    "artist_albums": "SELECT artist_id, album_id, album.name, release_date, role, row_number() OVER (PARTITION BY artist_id ORDER BY album.name NULLS LAST, album_id) AS place FROM ah JOIN album_artist ON artist_id = ah.id JOIN album ON album.id = album_id",
    "all_artist_albums": "SELECT artist_id, album_id, album.name, release_date, role, row_number() OVER (PARTITION BY artist_id ORDER BY album.name NULLS LAST, album_id) AS place FROM album_artist JOIN artist ON artist.id = artist_id JOIN album ON album.id = album_id",
    "artist_instruments": "SELECT artist_id, instrument_id, row_number() OVER (PARTITION BY artist_id ORDER BY instrument_id) AS place FROM ah JOIN artist_instrument ON artist_id = ah.id",
    "album_artists": "SELECT album_id, artist_id, artist.name, role, row_number() OVER (PARTITION BY album_id ORDER BY artist.name NULLS LAST, artist_id) AS place FROM bh JOIN album_artist ON album_id = bh.id JOIN artist ON artist.id = artist_id",
    "album_genres": "SELECT album_id, genre_id, genre.name, row_number() OVER (PARTITION BY album_id ORDER BY genre.name NULLS LAST, genre_id) AS place FROM bh JOIN album_genre ON album_id = bh.id JOIN genre ON genre.id = genre_id",
    "album_tracks": "SELECT album_id, track_id, track.name, duration_seconds, CAST(NULL AS INTEGER) AS track_number, row_number() OVER (PARTITION BY album_id ORDER BY track_id) AS place FROM bh JOIN track_album ON album_id = bh.id JOIN track ON track.id = track_id",
    "genre_artists": "SELECT * FROM ga",
    "artist_cards": """SELECT id, name, description, artist_type, birth_date, death_date,
  coalesce((SELECT string_agg(genre.name, ', ' ORDER BY genre.name, genre.id) FROM artist_genre JOIN genre ON genre.id = genre_id WHERE artist_id = ah.id), '') AS genres,
  coalesce((SELECT string_agg(album.name || ' (' || role || ')', '; ' ORDER BY album.name, album.id) FROM album_artist JOIN album ON album.id = album_id WHERE artist_id = ah.id), '') AS albums,
  coalesce((SELECT string_agg(instrument_id, ', ' ORDER BY instrument_id) FROM artist_instrument WHERE artist_id = ah.id), '') AS instruments FROM ah""",
    "album_cards": """SELECT id, name, release_date,
  coalesce((SELECT string_agg(coalesce(artist.name, '(unknown)') || ' (' || role || ')', '; ' ORDER BY artist.name NULLS LAST, artist.id) FROM album_artist JOIN artist ON artist.id = artist_id WHERE album_id = bh.id), '') AS artists,
  coalesce((SELECT string_agg(genre.name, ', ' ORDER BY genre.name, genre.id) FROM album_genre JOIN genre ON genre.id = genre_id WHERE album_id = bh.id), '') AS genres,
  coalesce((SELECT string_agg('  - ' || track.name || CASE WHEN duration_seconds IS NULL THEN '' ELSE ' (' || (duration_seconds // 60) || ':' || lpad(CAST(duration_seconds % 60 AS VARCHAR), 2, '0') || ')' END, '; ' ORDER BY track.id)
    FROM track_album JOIN track ON track.id = track_id WHERE album_id = bh.id), '') AS tracks FROM bh""",
    "genre_cards": "SELECT id, name, coalesce((SELECT string_agg(coalesce(ga.name, '(unknown)'), '; ' ORDER BY place) FROM ga WHERE genre_id = gh.id), '') AS artists FROM gh",
    "qid_sets": "SELECT * FROM qid_sets0 UNION ALL SELECT DISTINCT 'all', qid FROM qid_sets0",
    "qid_label": "SELECT * FROM qid_label",
    "enrichment_album": "SELECT id AS entity_qid, release_date, lab AS record_label_qid, g AS genre_qid FROM o0",
    "enrichment_track": "SELECT id AS entity_qid, dur AS duration_seconds, alb AS parent_album_qid FROM t0",
    "backfill_names": "SELECT id, name FROM artist",
    "backfill_album": "SELECT * FROM album",
    "backfill_track": "SELECT * FROM track",
    "instrument": "SELECT * FROM instrument",
    "record_label": "SELECT * FROM record_label",
    "album_genre": "SELECT * FROM album_genre",
    "track_album_enriched": "SELECT * FROM track_album",
    "resolution_counts": """SELECT 'album_named' AS metric, count(*) AS n FROM album WHERE name <> id UNION ALL SELECT 'track_named', count(*) FROM track UNION ALL SELECT 'artist_named', count(name) FROM artist
  UNION ALL SELECT 'album_release_date', count(release_date) FROM album UNION ALL SELECT 'album_record_label', count(record_label) FROM album UNION ALL SELECT 'track_duration_seconds', count(duration_seconds) FROM track""",
    "modified_since": f"""SELECT id AS qid FROM tc WHERE seg <> 'HOUSEHOLD' AND m >= TIMESTAMP '{SINCE}' UNION SELECT id FROM o0 WHERE o_orderdate >= TIMESTAMP '{SINCE}'
  UNION SELECT id FROM t0 WHERE l_shipdate >= TIMESTAMP '{SINCE}'""",
    "keyset_page": "SELECT id FROM artist WHERE id > 'QC5' ORDER BY id LIMIT 50",
    "decode_bindings": "SELECT id AS qid FROM c0",
    "decode_envelope": """SELECT 'QS' || s_suppkey AS qid, 'QS' || s_suppkey AS id, CASE WHEN s_suppkey % 7 <> 0 THEN s_name END AS label,
  CASE WHEN s_suppkey % 7 = 0 THEN 'the entity is missing' END AS problem FROM supplier""",
    "branch_audit": f"""SELECT branch, count(*) AS n FROM (
  SELECT id, unnest(CASE seg WHEN 'MACHINERY' THEN ['P106 Q639669', 'P136'] WHEN 'BUILDING' THEN ['P106 Q177220', 'P136'] WHEN 'AUTOMOBILE' THEN ['P136'] WHEN 'FURNITURE' THEN ['P1303'] ELSE [] END) AS branch
    FROM tc WHERE m >= TIMESTAMP '{SINCE}'
  UNION ALL SELECT id, unnest(['P31 Q482994', 'P175', 'P136']) FROM o0 WHERE o_orderdate >= TIMESTAMP '{SINCE}'
  UNION ALL SELECT id, unnest(['P31 Q7366', 'P175']) FROM (SELECT DISTINCT id FROM t0 WHERE l_shipdate >= TIMESTAMP '{SINCE}')) GROUP BY 1""",
    "keyset_pages": f"""SELECT CAST(p AS INTEGER) AS page, min(id) AS first, max(id) AS last, CAST(count(*) AS INTEGER) AS n
  FROM (SELECT id, (row_number() OVER (ORDER BY id) - 1) // {PAGE} AS p FROM artist) GROUP BY p""",
    "reject_file": """SELECT '{"id":"QX' || n_nationkey || '","claims": broken},' AS raw, 'not an entity object' AS reason FROM nation WHERE n_nationkey % 5 = 0""",
    "genre_file": "SELECT * FROM genre",
    "labels_file": "SELECT * FROM qid_label",
    "enrichment_file": """SELECT id AS entity_qid, 'album' AS entity_type, release_date, lab AS record_label_qid, CAST(NULL AS BIGINT) AS duration_seconds, g AS genre_qid, CAST(NULL AS VARCHAR) AS parent_album_qid FROM o0
  UNION ALL SELECT id, 'track', NULL, NULL, dur, NULL, alb FROM t0""",
    "fts_artist": _bm25("artist", "name", "description"),
    "fts_album": _bm25("album", "name"),
    "fts_track": _bm25("track", "name"),
    "fts_terms": r""", fd AS (SELECT id, name, list_filter(string_split_regex(lower(concat_ws(' ', name, description)), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM uartist),
fn AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM fd),
ft AS (SELECT id, len(w) AS len, unnest(w) AS token FROM fd),
fw AS (SELECT DISTINCT CASE WHEN k % 50 = 0 THEN seg || ' ' || substr(c_name, 10) ELSE substr(c_name, 10) END AS query FROM c0),
fq AS (SELECT DISTINCT query, unnest(string_split_regex(lower(query), '[^\p{L}\p{N}]+')) AS token FROM fw),
fh AS (SELECT id, len, token, count(*) AS tf FROM ft SEMI JOIN fq USING (token) GROUP BY ALL),
fc AS (SELECT token, count(*) AS df FROM fh GROUP BY 1),
fs AS (SELECT query, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 9) AS score FROM fq JOIN fh USING (token) JOIN fc USING (token), fn GROUP BY 1, 2)
SELECT query, CAST(place AS INTEGER) AS place, id, name, score FROM (SELECT query, id, name, score, row_number() OVER (PARTITION BY query ORDER BY coalesce(name = query, false) DESC, score DESC, name NULLS LAST, id) AS place
  FROM fd JOIN fs USING (id)) WHERE place <= 100""",
    "upsert_agent": "SELECT * FROM uartist",
    "upsert_album": "SELECT o0.id, CASE WHEN o0.k % 11 <> 0 THEN album.name || ' rev' ELSE album.name END AS name, album.release_date, record_label FROM album JOIN o0 ON o0.id = album.id",
    "upsert_track": "SELECT id, name || ' rev' AS name, duration_seconds FROM track",
    "upsert": " UNION ALL ".join(f"SELECT '{x}' AS table_name, count(*) AS n FROM {x}" for x in ("artist", "artist_member_of", "album", "album_artist", "album_genre", "track", "track_artist", "track_album", "instrument", "record_label"))
    + """ UNION ALL SELECT 'sync_state', 1 UNION ALL SELECT 'genre', count(*) FROM (SELECT id FROM genre UNION SELECT genre_id FROM ug) UNION ALL SELECT 'artist_genre', count(*) FROM (SELECT * FROM artist_genre UNION SELECT * FROM ug)
  UNION ALL SELECT 'artist_instrument', count(*) FROM (SELECT * FROM artist_instrument UNION SELECT id, 'Q172' FROM uc WHERE seg = 'FURNITURE')
  UNION ALL SELECT 'qid_label', count(*) FROM (SELECT qid FROM qid_label UNION SELECT id FROM uc WHERE k % 10 <> 0)""",
    "update_summary": """SELECT outcome, count(*) AS n FROM (SELECT outcome FROM tc UNION ALL SELECT 'upserted' FROM o0 UNION ALL SELECT 'upserted' FROM (SELECT DISTINCT id FROM t0)) GROUP BY 1""",
    "update_dry_run": """SELECT id AS qid, CASE WHEN seg <> 'HOUSEHOLD' THEN 'Agent' END AS role, outcome FROM tc UNION ALL SELECT id, 'Album', 'upserted' FROM o0
  UNION ALL SELECT DISTINCT id, 'Track', 'upserted' FROM t0""",
    "sync_state": """SELECT 'last_sync' AS key, strftime(max(m), '%Y-%m-%dT%H:%M:%SZ') AS value FROM (SELECT m FROM tc UNION ALL SELECT o_orderdate FROM o0 UNION ALL SELECT l_shipdate FROM t0)""",
    "update_stream": "SELECT * FROM uartist",
    "stage_roundtrip": """SELECT a0.id, 'Agent' AS role, CASE WHEN seg IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') THEN g ELSE '' END AS genres, '' AS performers, '' AS parents FROM a0 LEFT JOIN c0 ON c0.id = a0.id
  UNION ALL SELECT id, 'Album', g, perf || ':performer', '' FROM o0 UNION ALL SELECT id, 'Track', '', perf || ':performer', alb FROM t0""",
    "flat_roundtrip": """SELECT a0.id, 'Agent' AS role, birth_date, CASE WHEN seg IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') THEN g ELSE '' END AS genres, CASE WHEN seg = 'FURNITURE' THEN 'Q171' ELSE '' END AS instruments,
  CASE WHEN seg IN ('MACHINERY', 'BUILDING') THEN grp ELSE '' END AS member_of, '' AS performers, '' AS parents FROM a0 LEFT JOIN c0 ON c0.id = a0.id
  UNION ALL SELECT id, 'Album', NULL, g, '', '', perf || ':performer', '' FROM o0 UNION ALL SELECT id, 'Track', NULL, '', '', '', perf || ':performer', alb FROM t0""",
}


def oracle_sql() -> dict[str, str]:
    return {name: (PRELUDE.replace("WITH", "WITH RECURSIVE", 1) if sql.startswith(_CHAINS) else PRELUDE) + sql for name, sql in _SELECT.items()}
