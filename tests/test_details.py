"""Places and cards where one id has very many rows."""

import pytest
from pyspark.sql import functions as F

from entitymart.operators import details
from tests.test_flows import rows


@pytest.fixture(scope="module")
def tables(spark):
    """An artist of 300,000 albums and 500 of few; names are tied, or null, for many."""
    ids = spark.range(0, 302_000, 1, 8)
    album = ids.select(
        F.concat(F.lit("Q"), "id").alias("id"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("name "), (F.xxhash64("id") % 1000).cast("string"))).alias("name"),
        F.date_add(F.lit("2000-01-01"), (F.col("id") % 1000).cast("int")).alias("release_date"),
    )
    owner = F.when(F.col("id") < 300_000, F.lit("A0")).otherwise(F.concat(F.lit("A"), F.col("id") % 500 + 1))
    tied = ids.select(F.concat(F.lit("Q"), "id").alias("album_id"), owner.alias("artist_id"), F.lit("performer").alias("role"))
    artist = spark.range(0, 600).select(F.concat(F.lit("A"), "id").alias("id"), F.lit("x").alias("name"))
    none = spark.createDataFrame([], "artist_id string, genre_id string, instrument_id string")
    return {"album": album, "album_artist": tied, "artist": artist, "artist_genre": none.drop("instrument_id"), "artist_instrument": none.drop("genre_id"), "genre": spark.createDataFrame([], "id string, name string")}


def wanted(t):
    from pyspark.sql import Window

    rows_ = t["album_artist"].join(t["album"].withColumnRenamed("id", "album_id"), "album_id")
    return rows_.select("artist_id", "album_id", F.row_number().over(Window.partitionBy("artist_id").orderBy(F.col("name").asc_nulls_last(), "album_id")).alias("place"))


@pytest.mark.parametrize("run", [500, 5000, details.RUN])
def test_places_across_borders_are_those_of_one_sort(tables, run):
    t = tables
    got = details.of(t["artist"], t["album_artist"], "artist_id", "album_id", t["album"], ["name"], ["name"], run=run).select("artist_id", "album_id", "place")
    want = wanted(t)
    assert got.count() == 302_000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_no_part_of_a_large_id_is_much_larger_than_a_run(tables):
    t, run = tables, 5000
    tied = t["album_artist"].join(t["album"].withColumnRenamed("id", "album_id"), "album_id")
    at = details.ranked(tied, "artist_id", ["name", "album_id"], run)
    picked = tied.where(F.pmod(F.xxhash64("artist_id", "album_id"), F.lit(run)) == 0).select("artist_id", "album_id")
    places = [r["place"] for r in at.join(picked, ["artist_id", "album_id"]).where("artist_id = 'A0'").orderBy("place").collect()]
    gaps = [b - a for a, b in zip([0, *places], [*places, 300_000], strict=True)]
    assert 30 <= len(places) <= 100 and max(gaps) <= 8 * run


def test_numbering_is_dealt_by_part(tables):
    """Rows are exchanged by id and part, never sorted whole by id."""
    t = tables
    plan = details.ranked(t["album_artist"], "artist_id", ["album_id"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number()" in line and "Window [" in line]
    assert len(windows) == 1 and "_part" in windows[0]


def test_first_rows_are_cut_before_the_exchange(tables):
    t = tables
    plan = details.artist_albums(t["artist"], t, first=10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_a_card_shows_so_many_and_says_that_there_are_more(tables):
    t = tables
    cards = {r["id"]: r["albums"].split("; ") if r["albums"] else [] for r in details.artist_cards(t["artist"], t, shown=5).collect()}
    assert len(cards) == 600 and cards["A599"] == []
    assert len(cards["A0"]) == 6 and cards["A0"][-1] == "..."
    assert len(cards["A1"]) <= 5 and "..." not in cards["A1"]
    assert all(c["albums"] == c2["albums"] for c, c2 in zip(*[details.artist_cards(t["artist"].where("id = 'A1'"), t, shown=n).collect() for n in (5, 1000)], strict=True))


def test_no_hits_and_no_rows(spark, tables):
    t = tables
    assert details.artist_albums(t["artist"].where("false"), t).isEmpty()
    empty = t | {"album_artist": t["album_artist"].where("false")}
    assert details.artist_albums(t["artist"], empty).isEmpty()
    assert rows(details.artist_cards(t["artist"].where("id = 'A0'"), empty).select("albums")) == [("",)]
