"""A small hand-made dump through bootstrap, populate and update, and single operators on awkward rows."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from entitymart.functions.claims import duration_seconds, first_parsed_date, precise_date, resolved_label, trimmed
from entitymart.operators import audit, details, merge, search, update
from entitymart.operators.classify import branches, classify
from entitymart.operators.extract import entries
from entitymart.plans.catalog import bootstrap, populate, populate_if_needed, run_update, sync
from entitymart.schemas import ENTITY
from entitymart.sources import staging
from entitymart.sources.dump import by_ids, counters, rejects, scan, triage
from entitymart.sources.storage import latest, publish, shared_folder
from entitymart.streaming.updates import apply_batch, read_changes, start


def claim(value, snaktype="value"):
    return {"mainsnak": {"snaktype": snaktype, "datavalue": {"value": value}}, "rank": "normal"}


def ids(*qids):
    return [claim({"id": q}) for q in qids]


def entity(qid, label=None, claims=None, **more):
    e = {"id": qid, "type": "item", "claims": claims or {}, **more}
    return e | ({"labels": {"en": {"language": "en", "value": label}, "de": {"value": "x"}}} if label is not None else {})


SECONDS = "http://www.wikidata.org/entity/Q11574"
DUMP = [
    entity("Q10", "Rock"),
    entity("Q1", "Singer One", {"P106": ids("Q5", "Q177220"), "P31": ids("Q215380"), "P136": ids("Q10", "Q10", "Q99"), "P569": [claim({"time": "+1926-00-00T00:00:00Z"}), claim({"time": "+1926-05-26T00:00:00Z"})], "P18": [claim("a.jpg")], "P625": [claim({"latitude": 1})]}),
    entity("Q2", "The Band", {"P31": ids("Q5", "Q215380"), "P463": ids("Q2", "Q77"), "P1303": ids("Q20")}),
    entity("Q42", "Nobody", {"P31": ids("Q5")}),
    entity("Q3", None, {"P136": [claim(None, "novalue")], "P358": []}, sitelinks={"enwiki": {"site": "enwiki", "title": " Ivy_Queen "}}),
    entity("Q4", "An Album", {"P31": ids("Q482994"), "P175": ids("Q1", "Q404"), "P136": ids("Q10"), "P264": ids("Q30"), "P577": [claim({"time": "+1987-03-00T00:00:00Z", "precision": 10})]}),
    entity("Q5000", None, {"P31": ids("Q7366"), "P361": ids("Q4", "Q404"), "P175": ids("Q1"), "P2047": [claim({"amount": "+4", "unit": "http://x/Q7727"}), claim({"amount": "+240", "unit": SECONDS})]}),
    entity("Q30", "The Label"),
    entity("Q20", "guitar"),
    entity("", "No id", {"P106": ids("Q177220")}),
]
LINES = ["[", *(json.dumps(e) + "," for e in DUMP), '{"id": "Q9", "claims": {', '{"id":"Q8"}', '{"type":"item"},', '{"id":"Q7","type":"item","claims":[]},', '{"id":"Q6","type":"item","claims":null}', "", "   ", "]"]


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("dump") / "dump.json.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n".join(LINES))
    return scan(spark, str(path), deal_to=4)


@pytest.fixture(scope="module")
def first(lines):
    return bootstrap(lines)


@pytest.fixture(scope="module")
def second(first):
    return populate(first.found, first.tables)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rescan_equals_entries_of_the_first_pass(lines, first):
    ids = first.found.select("qid").distinct()
    again = entries(by_ids(lines, ids))
    assert again.exceptAll(first.found).isEmpty() and first.found.exceptAll(again).isEmpty()
    assert ids.count() > 5


def test_trimmed_is_white_space_of_any_script(spark):
    texts = ["", " ", "\u00a0\t{}\u2003\r", "\u3000a b\u0085", "\u180ex\u200b", "\x1cx"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(trimmed(F.col("t"))).collect()
    assert [r[0] for r in got] == ["", "", "{}", "a b", "\u180ex\u200b", "\x1cx"]


def test_triage_counts_and_rejects(lines):
    done = triage(lines)
    assert counters(done).first().asDict() == {"processed": 17, "filtered": 5, "rejected": 6, "excluded": 4, "brackets": 2}
    assert {r["reason"] for r in rejects(done).collect()} == {"not an entity object", "no type", "no id", "claims are null", "empty id"}


def test_bootstrap_tables(first):
    t = first.tables
    artist = {r["id"]: r for r in t["artist"].withColumn("birth_date", F.col("birth_date").cast("string")).collect()}
    assert set(artist) == {"Q1", "Q2", "Q3"}
    assert (artist["Q1"]["artist_type"], artist["Q1"]["inclusion_reason"], artist["Q1"]["birth_date"]) == ("person", "P106:Q177220", "1926-05-26")
    assert (artist["Q2"]["artist_type"], artist["Q2"]["inclusion_reason"]) == ("group", "P31:Q215380")
    assert (artist["Q3"]["name"], artist["Q3"]["inclusion_reason"]) == (None, "PROP:P136,P358")
    assert rows(t["genre"]) == [("Q10", "Rock")] and rows(t["artist_genre"]) == [("Q1", "Q10")]
    assert rows(t["artist_instrument"]) == [("Q2", "Q20")] and rows(t["artist_member_of"]) == [("Q2", "Q2")]
    assert rows(t["album"].select("id", "name")) == [("Q4", "An Album")] and rows(t["album_artist"]) == [("Q4", "Q1", "performer")]
    assert rows(t["track"].select("id", "name")) == [("Q5000", "Q5000")] and rows(t["track_album"].select("track_id", "album_id")) == [("Q5000", "Q4")]
    assert all(r["n"] == 0 for r in audit.orphans(t).collect())


def test_populate(second):
    t = second.tables
    assert rows(t["album"].select("name", F.col("release_date").cast("string"), "record_label")) == [("An Album", "1987-03-01", "The Label")]
    assert rows(t["track"].select("id", "duration_seconds")) == [("Q5000", 240)]
    assert {r["id"]: r["name"] for r in t["artist"].collect()}["Q3"] == "Ivy Queen"
    assert rows(t["instrument"]) == [("Q20", "guitar")] and rows(t["record_label"]) == [("Q30", "The Label")] and rows(t["album_genre"]) == [("Q4", "Q10")]


def test_update(spark, second):
    changed = [
        ("Q1", "2026-01-02", entity("Q1", "Singer Uno", {"P106": ids("Q177220"), "P136": ids("Q98")})),
        ("Q1", "2026-01-01", entity("Q1", "Old", {"P106": ids("Q177220")})),
        ("Q42", "2026-01-01", entity("Q42", "Nobody", {"P31": ids("Q5")})),
        ("Q60", "2026-01-01", entity("Q60", "New", {"P106": ids("Q177220"), "P463": ids("Q61")})),
        ("Q61", "2026-01-03", entity("Q61", "Group", {"P31": ids("Q215380")})),
        ("Q62", "2026-01-01", entity("Q62", "Lost", {"P106": ids("Q177220"), "P463": ids("Q404")})),
        ("Q4", "2026-01-01", entity("Q4", None, {"P31": ids("Q482994"), "P175": ids("Q60")})),
    ]
    changes = spark.createDataFrame([(q, m, json.dumps(e)) for q, m, e in changed], "qid string, modified string, value string").withColumn("modified", F.to_timestamp("modified"))
    new, decided = run_update(second.tables, changes)
    assert dict(rows(update.summary(decided))) == {"upserted": 4, "skipped": 1, "failed": 1}
    artist = {r["id"]: r["name"] for r in new["artist"].collect()}
    assert artist == {"Q1": "Singer Uno", "Q2": "The Band", "Q3": "Ivy Queen", "Q60": "New", "Q61": "Group"}
    assert ("Q98", "Q98") in rows(new["genre"]) and ("Q60", "Q61") in rows(new["artist_member_of"])
    assert rows(new["album"].select("name", F.col("release_date").cast("string"))) == [("An Album", "1987-03-01")]
    assert ("Q4", "Q60", "performer") in rows(new["album_artist"])
    assert rows(update.modified_since(changes, F.lit("2026-01-02").cast("timestamp"))) == [("Q1",), ("Q61",)]
    assert update.cursor_after(changes).first()["value"] == "2026-01-03T00:00:00Z"
    root = shared_folder(spark, "snap")
    publish(second.tables, root, 1)
    publish(new, root, 2, {"last_sync": "x"})
    newest = latest(spark, root)
    assert (newest.version, newest.note) == (2, {"last_sync": "x"}) and newest.tables["artist"].count() == 5


@pytest.mark.parametrize(
    ("claims", "want"),
    [
        ({}, None),
        ({"P106": ids("Q5")}, None),
        ({"P106": ids("Q36834"), "P31": ids("Q7366")}, ("Agent", "P106:Q36834")),
        ({"P31": ids("Q7366", "Q482994")}, ("Album", "P31:Q482994")),
        ({"P175": ids("Q1"), "P1303": []}, ("Agent", "PROP:P1303,P175")),
        ({"P106": [claim("text"), claim(None, "somevalue")], "P358": []}, ("Agent", "PROP:P358")),
    ],
)
def test_classify(spark, claims, want):
    e = F.from_json(F.lit(json.dumps({"id": "Q1", "type": "item", "claims": claims})), ENTITY)
    got = spark.range(1).select(classify(e["claims"]).alias("v")).first()["v"]
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(
    ("time", "precision", "want"),
    [
        ("+1926-05-26T00:00:00Z", 11, "1926-05-26"), ("+1926-05-00T00:00:00Z", 10, "1926-05-01"), ("+1926-00-00T00:00:00Z", 9, "1926-01-01"), ("+1926-00-00T00:00:00Z", 8, None),
        ("+1926-05-26T00:00:00Z", None, "1926-05-26"), ("+1926-00-00T00:00:00Z", 11, None), ("+1926-05", 11, None), ("-0044-03-15T00:00:00Z", 9, None), ("junk", 11, None),
    ],
)
def test_precise_date(spark, time, precision, want):
    value = {"time": time} | ({"precision": precision} if precision is not None else {})
    e = F.from_json(F.lit(json.dumps(entity("Q1", claims={"P577": [claim("no time"), claim(value), claim({"time": "+2000-01-01T00:00:00Z"})]}))), ENTITY)
    got = spark.range(1).select(precise_date(e["claims"], "P577").cast("string").alias("d"), first_parsed_date(e["claims"], "P577").cast("string").alias("f")).first()
    assert got["d"] == want and got["f"] is not None


def test_durations_and_labels(spark):
    amounts = [claim({"amount": "1.5"}), claim({"amount": "+9", "unit": "http://x/Q7727"}), claim({"amount": "++7"})]
    e = F.from_json(F.lit(json.dumps(entity("Q1", "", {"P2047": amounts}, sitelinks={"enwiki": {"title": " A_(album)_"}}))), ENTITY)
    got = spark.range(1).select(duration_seconds(e["claims"], "P2047").alias("s"), resolved_label(e["labels"], e["sitelinks"]).alias("n")).first()
    assert tuple(got) == (7, "A (album)")


def test_merge(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, None, 20)], "k int, x string, y int")
    new = spark.createDataFrame([(2, "b", 5), (3, "d", 7), (3, "c", 9), (3, None, 1)], "k int, x string, y int")
    assert rows(merge.insert_or_ignore(old, new, ["k"]).where("k = 3")) == [(3, "c", 9)]
    assert merge.insert_or_ignore(old, new, ["k"]).where("k = 2").first()["x"] is None
    again = merge.insert_or_ignore(old, old, ["k"])
    assert again.count() == 2
    replaced = merge.insert_or_replace(old, new.where("k = 2").select("k", "x"), ["k"])
    assert {tuple(r) for r in replaced.collect()} == {(1, "a", 10), (2, "b", 20)}


def test_search(spark):
    names = ["U2", "U2 live", "AU2", None, "100%", "a\\b", "x_y"] + [f"U2 {i:03}" for i in range(120)]
    artist = spark.createDataFrame([(f"Q{i}", n, "from U2" if n is None else None, "group", None, None) for i, n in enumerate(names)], "id string, name string, description string, artist_type string, birth_date date, death_date date")
    hits = [r["name"] for r in search.search_artist(artist, "U2").collect()]
    assert hits[0] == "U2" and len(hits) == 100 and hits[1] == "AU2"
    assert search.search_artist(artist, "").count() == 0 and search.search_artist(artist, "'").count() == 0
    assert [r["name"] for r in search.search_album(artist.withColumn("release_date", F.lit(None)), "a\\b").collect()] == ["a\\b"]
    assert search.search_track(artist.withColumn("duration_seconds", F.lit(1)), "x%y").count() == 1
    assert [r["id"] for r in search.search_genre(artist, "U2", 2, 1).collect()] == ["Q0", "Q7"]
    index = search.token_index(artist, ["name", "description"])
    assert search.token_search(artist, index, "live", ["name", "description"]).first()["name"] == "U2 live"


def test_decoding_of_responses(spark):
    pages = spark.createDataFrame([(json.dumps({"results": {"bindings": [{"item": {"type": "uri", "value": u}} for u in (update.ENTITY_PREFIX + "Q1", "http://other/Q2")]}}),), ('{"results":{"bindings":[]}}',), ("junk",)], "value string")
    assert rows(update.decode_bindings(pages)) == [("Q1",)]
    found = update.decode_envelope(spark.createDataFrame([('{"entities":{"Q1":{"id":"Q1"}}}',), ("{}",)], "value string")).collect()
    assert {(r["qid"], r["value"], r["problem"]) for r in found} == {("Q1", '{"id":"Q1"}', None), (None, None, "no entity in the response")}


def test_orphans_are_counted(second):
    t = second.tables
    planted = t | {
        "album_artist": t["album_artist"].unionAll(t["album_artist"].limit(1).select(F.lit("Q4"), F.lit("Q404"), F.lit("performer"))),
        "artist_member_of": t["artist_member_of"].unionAll(t["artist_member_of"].limit(1).select(F.lit("Q405"), F.lit("Q406"))),
    }
    assert {r["metric"]: r["n"] for r in audit.orphans(planted).where("n > 0").collect()} == {"album_artist.artist_id": 1, "artist_member_of.artist_id": 1, "artist_member_of.group_id": 1}


def test_details_are_in_order(spark, second):
    t = second.tables | {
        "track": spark.createDataFrame([("T1", "a", 5), ("T2", "b", None), ("T3", "c", 65), ("T4", "d", 1)], "id string, name string, duration_seconds int"),
        "track_album": spark.createDataFrame([("T1", "Q4", None), ("T2", "Q4", 2), ("T3", "Q4", 1), ("T4", "Q4", None)], "track_id string, album_id string, track_number int"),
    }
    hits = second.tables["album"].where("id = 'Q4'").select("id", "name")
    assert rows(details.album_tracks(hits, t).select("place", "track_id")) == [(1, "T3"), (2, "T2"), (3, "T1"), (4, "T4")]
    assert details.album_cards(hits, t).first()["tracks"] == "01. c (1:05); 02. b;   - a (0:05);   - d (0:01)"


def test_populate_is_skipped_where_all_albums_have_names(first, second):
    named = second.tables | {"album": second.tables["album"].withColumn("name", F.lit("a name"))}
    assert populate_if_needed(first.found, named) == (named, False)
    again, done = populate_if_needed(first.found, named, force=True)
    assert done and rows(again["qid_label"]) == rows(second.tables["qid_label"])
    unnamed = named | {"album": named["album"].withColumn("name", F.col("id"))}
    again, done = populate_if_needed(first.found, unnamed)
    assert done and rows(again["album"].select("id", "name")) == rows(second.tables["album"].select("id", "name"))


def test_keyset_pages(spark):
    df = spark.range(25).select(F.format_string("Q%02d", "id").alias("id"))
    pages = list(update.keyset_pages(lambda cursor: update.keyset_page(df, cursor, 10), 10))
    assert [len(p) for p in pages] == [10, 10, 5] and [p[0]["id"] for p in pages] == ["Q00", "Q10", "Q20"]
    with pytest.raises(ValueError, match="ends at"):  # a source that repeats its page
        list(update.keyset_pages(lambda cursor: update.keyset_page(df, None, 10), 10))
    with pytest.raises(ValueError, match="more than 2"):
        list(update.keyset_pages(lambda cursor: update.keyset_page(df, cursor, 5), 5, most=2))
    assert list(update.keyset_pages(lambda cursor: update.keyset_page(df.where("false"), cursor, 5), 5)) == []


def test_all_branches_of_an_entity(spark):
    e = F.from_json(F.lit(json.dumps({"id": "Q1", "type": "item", "claims": {"P106": ids("Q36834", "Q5"), "P31": ids("Q7366"), "P136": [], "P1": ids("Q2")}})), ENTITY)
    assert spark.range(1).select(branches(e["claims"]).alias("b")).first()["b"] == ["P106 Q36834", "P136", "P31 Q7366"]


def change(qid, at, e):
    return (qid, at, json.dumps(e))


def changes_of(spark, found):
    return spark.createDataFrame(found, "qid string, modified string, value string").withColumn("modified", F.to_timestamp("modified"))


def test_sync_moves_the_cursor(spark, second):
    t = second.tables
    first = changes_of(spark, [change("Q60", "2026-01-02", entity("Q60", "New", {"P106": ids("Q177220")})), change("Q2", "2025-01-01", entity("Q2", "Old news", {"P106": ids("Q177220")}))])
    with pytest.raises(ValueError, match="since when"):
        sync(t, first)
    same, decided = sync(t, first, "2026-01-01", dry_run=True)
    assert same is t and rows(update.plan(decided)) == [("Q60", "Agent", "upserted")]
    new, decided = sync(t, first, "2026-01-01")
    assert rows(new["sync_state"]) == [("last_sync", "2026-01-02T00:00:00Z")] and rows(update.summary(decided)) == [("upserted", 1)]
    assert new["album"] is t["album"] and new["track"] is t["track"]  # no such change
    later = changes_of(spark, [change("Q61", "2026-01-03", entity("Q61", "Next", {"P106": ids("Q177220")})), change("Q62", "2026-01-01", entity("Q62", "Before", {"P106": ids("Q177220")}))])
    newer, decided = sync(new, later)
    assert rows(newer["sync_state"]) == [("last_sync", "2026-01-03T00:00:00Z")] and rows(decided.select("qid")) == [("Q61",)]
    still, decided = sync(newer, later.where("false"))
    assert still is newer and decided is None


def test_layouts(spark, first, second):
    for name, df in {"rejects": rejects(first.triaged), "genres": first.tables["genre"], "labels": second.labels, "enrichment": second.enriched}.items():
        path = shared_folder(spark, name)
        staging.write_layout(df, name, path)
        again = staging.read_layout(spark, name, path)
        assert again.exceptAll(df.select(*again.columns)).isEmpty() and again.count() == df.count() > 0


def test_stream_counts_each_batch_once(spark, second):
    root, landing, checkpoint = (shared_folder(spark, x) for x in ("snapshots", "landing", "checkpoint"))
    publish(second.tables, root, 1)
    batch = changes_of(spark, [change("Q60", "2026-01-02", entity("Q60", "New", {"P106": ids("Q177220")}))])
    batch.write.json(landing)
    start(read_changes(spark, landing), root, checkpoint).awaitTermination()
    newest = latest(spark, root)
    assert newest.version == 2 and newest.note["last_sync"] == "2026-01-02T00:00:00Z" and newest.tables["artist"].where("id = 'Q60'").count() == 1
    assert newest.paths["album"] == f"{root}/v=1/album" and newest.paths["artist"] == f"{root}/v=2/artist"  # written again only where changed
    apply_batch(root, lambda s: s.read.text(f"{checkpoint}/metadata").first()[0])(batch, 0)  # the same batch after a failure
    assert latest(spark, root).version == 2
    landing2 = shared_folder(spark, "landing")
    unknown = changes_of(spark, [change("Q61", None, entity("Q61", "Timeless", {"P106": ids("Q177220")}))])
    unknown.write.json(landing2)
    start(read_changes(spark, landing2), root, shared_folder(spark, "checkpoint")).awaitTermination()  # batch 0 of another query
    newest = latest(spark, root)
    assert newest.version == 3 and newest.note["last_sync"] == "2026-01-02T00:00:00Z" and newest.tables["artist"].where("id = 'Q61'").count() == 1
