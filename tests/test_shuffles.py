"""What the flows shuffle and write twice: exchanges that plans do without."""

import os
import re

from pyspark.sql import functions as F

from entitymart import queries as q
from entitymart.operators import audit, enrich, search, tables, update
from entitymart.plans.catalog import entries_of
from entitymart.schemas import REFS
from entitymart.sources.storage import SHUFFLE_CLEANUP, StoredTables, stored

DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_references_and_parents_meet_in_one_aggregate(spark):
    """Two references to one parent are told apart, null references and parents without an id do not meet."""
    make = lambda rows, names: stored(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split())), "t")
    t = {
        "artist": make([("a",), ("b",), (None,)], "id"), "genre": make([("g",)], "id"),
        "artist_genre": make([("a", "g"), ("x", "g"), ("x", "h"), (None, "g")], "artist_id genre_id"),
        "artist_member_of": make([("a", "b"), ("b", "y"), ("y", "y")], "artist_id group_id"),
    }
    found = audit.orphans(t)
    assert {r["metric"]: r["n"] for r in found.collect()} == {
        "artist_genre.artist_id": 3, "artist_genre.genre_id": 1, "artist_member_of.artist_id": 1, "artist_member_of.group_id": 2,
    }
    # One exchange of references and parents, none of references alone before.
    fresh = plan(audit.orphans(t))
    assert len(re.findall(r"hashpartitioning\(parent#\d+, ref#\d+", fresh)) == 1 and "hashpartitioning(metric" not in fresh


def test_existing_rows_of_track_album_are_computed_once(spark):
    existing = stored(spark.createDataFrame([("t1", "a1", 7), ("t3", "gone", 1)], "track_id string, album_id string, track_number int"), "marked-place")
    enriched = spark.createDataFrame([("t1", "track", "a1"), ("t2", "track", "a1"), ("t2", "track", "a1"), ("t2", "track", "no")], "entity_qid string, entity_type string, parent_album_qid string")
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "id string")
    new = enrich.track_albums(existing, enriched, ids("a1"), ids("t1", "t2"))
    assert plan(new).count("marked-place") == 1
    assert sorted(map(tuple, new.collect()), key=str) == [("t1", "a1", 7), ("t2", "a1", None), ("t3", "gone", 1)]


def test_stored_tables_are_not_stored_again(spark):
    a = spark.range(3)
    t = StoredTables({"a": spark.range(9), "b": spark.range(4)}, {"a": a})
    assert t["a"] is a and not t.kept
    c = q.Catalog(spark, DIR)
    assert c.tables["qid_label"] is c.second.labels and c.tables["genre"] is c.first.tables["genre"]


def test_entries_that_no_genre_asks_for_do_not_travel(spark):
    found = stored(spark.range(20_000).selectExpr("cast(id as string) as qid", "'x' as name"), "found")
    ids = spark.createDataFrame([("7",), ("12345",), ("none",)], "qid string")
    met = entries_of(found, ids)
    assert "getbit" in plan(met)
    assert sorted(r["qid"] for r in met.collect()) == ["12345", "7"]


def left_in(spark):
    return sum(f.startswith("shuffle_") and f.endswith(".data") for at, _, files in os.walk(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]) for f in files)


def test_what_was_stored_leaves_no_shuffle_files(spark):
    before = left_in(spark)
    stored(spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count(), "groups")
    assert left_in(spark) <= before
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_only_rows_of_ids_that_come_twice_meet(spark):
    """Of one id: two rows of a role, two of different roles, and a row that says the same twice."""
    refs = lambda *qs: [(q, "performer") for q in qs]
    row = lambda id, role, name, genres=(), performers=(), parents=(): (id, name, None, "person", "r", role, None, None, list(genres), [], [], refs(*performers), list(parents))
    schema = f"id string, name string, description string, artist_type string, inclusion_reason string, role string, birth_date date, death_date date, genres array<string>, instruments array<string>, member_of array<string>, performers {REFS}, parents array<string>"
    rows = [
        row("a", "Agent", "A", "gg"), row("b", "Agent", "B2", "g"), row("b", "Agent", "B1", "gh"), row("x", "Agent", None), row("x", "Album", "X", performers="aab"),
        row("l", "Album", "L", performers="ab"), row("t", "Track", "T", performers="aa", parents="ll"), row("u", "Track", "U", parents="l"), row("u", "Track", None, performers="b", parents="lx"),
    ]
    staged = stored(spark.createDataFrame(rows, schema), "staged")
    genre = spark.createDataFrame([("g", "G"), ("h", "H")], "id string, name string")
    t = tables.bootstrap_tables(staged, genre)
    got = {name: sorted(tuple(r)[:3] for r in t[name].select(*t[name].columns[:2]).collect()) for name in ("artist_genre", "album", "album_artist", "track", "track_artist", "track_album")}
    assert sorted((r.id, r.name) for r in t["artist"].collect()) == [("a", "A"), ("b", "B1"), ("x", None)]
    assert got == {
        "artist_genre": [("a", "g"), ("b", "g"), ("b", "h")], "album": [("l", "L"), ("x", "X")], "album_artist": [("l", "a"), ("l", "b"), ("x", "a"), ("x", "b")],
        "track": [("t", "T"), ("u", "U")], "track_artist": [("t", "a"), ("u", "b")], "track_album": [("t", "l"), ("u", "l"), ("u", "x")],
    }
    assert "getbit" in plan(t["track_artist"])


def test_only_changes_of_one_entity_meet(spark):
    at = lambda day: f"2024-01-{day:02}"
    rows = [("a", at(1), "old"), ("a", at(2), "new"), ("b", at(1), "only"), (None, at(1), "x"), (None, at(3), "y")]
    changes = stored(spark.createDataFrame(rows, "qid string, modified string, value string").withColumn("modified", F.col("modified").cast("timestamp")), "some-changes")
    last = update.newest(changes)
    assert sorted(((r.qid, r.value) for r in last.collect()), key=str) == [("a", "new"), ("b", "only"), (None, "y")]
    assert "getbit" in plan(last)


def test_words_are_counted_within_their_row(spark):
    df = spark.createDataFrame([("1", "b a b"), ("2", ""), ("3", None), ("4", "a")], "id string, name string")
    index = search.token_index(df, ["name"])
    assert sorted(map(tuple, index.collect())) == [("a", "1", 3, 1), ("a", "4", 1, 1), ("b", "1", 3, 2)]
    assert "Exchange" not in plan(index)
