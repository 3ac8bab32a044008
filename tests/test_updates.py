"""Updates in batches of any order: groups that fail, changes tried again, late changes, references that wait, and snapshots in buckets."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from entitymart.operators import audit, update
from entitymart.operators.merge import insert_or_ignore
from entitymart.plans.catalog import bootstrap, populate, run_update, sync
from entitymart.schemas import KEYS
from entitymart.sources.storage import latest, names_in, publish, shared_folder
from entitymart.streaming.updates import apply_batch
from tests.test_flows import LINES, change, changes_of, entity, ids, rows

SINGER, GROUP, ALBUM, TRACK = {"P106": ids("Q177220")}, {"P31": ids("Q215380")}, {"P31": ids("Q482994")}, {"P31": ids("Q7366")}


@pytest.fixture(scope="module")
def t(spark):
    first = bootstrap(spark.createDataFrame([("", x) for x in LINES], "file string, value string"))
    done = populate(first.found, first.tables).tables
    return {name: spark.createDataFrame(df.collect(), df.schema).coalesce(1) for name, df in done.items()}


def agent(qid, at, name, *groups, kind=SINGER, genres=()):
    return change(qid, at, entity(qid, name, kind | ({"P463": ids(*groups)} if groups else {}) | ({"P136": ids(*genres)} if genres else {})))


def outcomes(decided):
    return {r["qid"]: r["outcome"] for r in decided.select("qid", "outcome").collect()}


def no_orphans(tables):
    return all(r["n"] == 0 for r in audit.orphans(tables).collect())


def chain(n, last):
    """Q1000 is a member of Q1001, and so on; the last names ``last``."""
    return [agent(f"Q{1000 + i}", "2026-01-01", f"n{i}", f"Q{1001 + i}" if i < n - 1 else last) for i in range(n)]


@pytest.mark.parametrize("n", [2, 50])
def test_members_of_failed_groups_fail(spark, t, n):
    new, decided = run_update(t, changes_of(spark, chain(n, "Q999") + [agent("Q900", "2026-01-01", "Fine", "Q2")]))
    assert outcomes(decided) == {f"Q{1000 + i}": "failed" for i in range(n)} | {"Q900": "upserted"}
    assert no_orphans(new) and new["retry"].count() == n and new["waiting"].where("kind = 'member'").count() == n
    if n > 2:
        return
    new, decided = run_update(t, changes_of(spark, chain(n, "Q2")))
    assert set(outcomes(decided).values()) == {"upserted"} and new["artist_member_of"].count() == t["artist_member_of"].count() + n


def test_reaching_is_closure(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "c"), ("e", "f"), ("f", "x"), ("g", "e"), ("g", "d"), ("h", "h"), ("i", "g")]
    hops = spark.createDataFrame(edges, "qid string, to string")
    assert rows(update.reaching(hops, spark.createDataFrame([("x",)], "qid string"))) == [(x,) for x in "efgix"]
    assert rows(update.reaching(hops, hops.where("false").select("qid"))) == []


def test_a_circle_of_new_groups_stays(spark, t):
    circle = [agent("Q1", "2026-01-01", "Old singer"), agent("Q70", "2026-01-01", "a", "Q71", kind=GROUP), agent("Q71", "2026-01-01", "b", "Q72", kind=GROUP), agent("Q72", "2026-01-01", "c", "Q70", kind=GROUP)]
    assert set(outcomes(run_update(t, changes_of(spark, circle))[1]).values()) == {"upserted"}
    lost = circle[:-1] + [agent("Q72", "2026-01-01", "c", "Q70", "Q999", kind=GROUP)]
    new, decided = run_update(t, changes_of(spark, lost))
    assert outcomes(decided) == {"Q1": "upserted", "Q70": "failed", "Q71": "failed", "Q72": "failed"} and no_orphans(new)


def test_failed_changes_are_tried_again(spark, t):
    batches = [chain(3, "Q999"), [agent("Q1", "2026-01-02", "Unrelated")], [agent("Q999", "2026-01-03", "At last", kind=GROUP)]]
    new, seen = t, []
    for batch in batches:
        new, decided = run_update(new, changes_of(spark, batch))
        seen.append((outcomes(decided), rows(new["retry"].select("qid", "tries"))))
    assert seen[0] == ({f"Q{1000 + i}": "failed" for i in range(3)}, [(f"Q{1000 + i}", 1) for i in range(3)])
    assert seen[1] == ({"Q1": "upserted"}, seen[0][1])  # nothing that they wait for came
    assert seen[2] == ({f"Q{1000 + i}": "upserted" for i in range(3)} | {"Q999": "upserted"}, [])
    assert new["waiting"].isEmpty() and ("Q1002", "Q999") in rows(new["artist_member_of"]) and no_orphans(new)


def test_tries_are_counted(spark, t):
    new, _ = run_update(t, changes_of(spark, [agent("Q60", "2026-01-01", "x", "Q61", "Q999"), ("Q62", "2026-01-01", "{broken")]))
    new, decided = run_update(new, changes_of(spark, [agent("Q61", "2026-01-02", "One of two", kind=GROUP)]))
    assert outcomes(decided) == {"Q61": "upserted", "Q60": "failed"}
    assert rows(new["retry"].select("qid", "tries")) == [("Q60", 2), ("Q62", 1)] and rows(new["waiting"].select("ref", "id")) == [("Q999", "Q60")]
    new, decided = run_update(new, changes_of(spark, [("Q62", "2026-01-03", json.dumps(entity("Q62", "Mended", SINGER))), agent("Q60", "2026-01-04", "no groups now")]))
    assert outcomes(decided) == {"Q62": "upserted", "Q60": "upserted"}


#: Batches whose order must not matter: names, labels, references before and after what they name, roles, a change tried again, and equal times.
BATCHES = [
    [agent("Q60", "2026-01-01", "older", genres=["Q10"]), change("Q80", "2026-01-01", entity("Q80", "First name", ALBUM | {"P175": ids("Q61")}))],
    [agent("Q60", "2026-01-02", "newer", genres=["Q97"]), change("Q80", "2026-01-02", entity("Q80", None, ALBUM | {"P175": ids("Q60", "Q404")}))],
    [agent("Q61", "2026-01-01", "The group", kind=GROUP), agent("Q63", "2026-01-01", "member", "Q61"), change("Q81", "2026-01-03", entity("Q81", "Song", TRACK | {"P361": ids("Q80", "Q82"), "P175": ids("Q63")}))],
    [change("Q60", "2026-01-03", entity("Q60", "no music", {"P31": ids("Q5")})), change("Q82", "2026-01-01", entity("Q82", "Late album", ALBUM)), agent("Q64", "2026-01-01", "same time a", "Q61")],
    [agent("Q64", "2026-01-01", "same time b", "Q61"), change("Q63", "2025-01-01", entity("Q63", "was an album", ALBUM))],
]


def catalog_rows(tables):
    return {name: sorted(map(str, tables[name].collect())) for name in KEYS if name in tables and name != "sync_state"}


def test_batches_in_any_order_give_the_same_tables(spark, t):
    base = t
    results = []
    for order in [(0, 1, 2, 3, 4), (4, 3, 2, 1, 0)]:
        new = base
        for i in order:
            new, _ = run_update(new, changes_of(spark, BATCHES[i]))
            new = {name: spark.createDataFrame(df.collect(), df.schema) for name, df in new.items()}
        assert no_orphans(new) and new["retry"].isEmpty()
        results.append(catalog_rows(new))
    assert results[0] == results[1]
    assert any("newer" in x for x in results[0]["artist"]) and any("First name" in x and "Q80" in x for x in results[0]["album"])
    assert any("Q80" in x and "Q61" in x for x in results[0]["album_artist"]) and any("Q81" in x and "Q82" in x for x in results[0]["track_album"])


def test_an_older_change_replaces_nothing(spark, t):
    new, _ = run_update(t, changes_of(spark, [agent("Q1", "2026-01-02", "newer")]))
    again, decided = run_update(new, changes_of(spark, [agent("Q1", "2026-01-01", "older"), agent("Q60", None, "timeless")]))
    assert outcomes(decided) == {"Q1": "stale", "Q60": "upserted"} and {r["id"]: r["name"] for r in again["artist"].collect()}["Q1"] == "newer"
    _, decided = run_update(again, changes_of(spark, [agent("Q1", "2026-01-02", "newer"), agent("Q60", None, "timeless")]))
    assert set(outcomes(decided).values()) == {"stale"}  # the same ones once more


def test_late_changes_are_read_again(spark, t):
    new, _ = sync(t, changes_of(spark, [agent("Q60", "2026-01-10", "a")]), "2026-01-01")
    late = changes_of(spark, [agent("Q61", "2026-01-08", "came late"), agent("Q60", "2026-01-10", "a"), agent("Q62", "2026-01-01", "too late")])
    _, decided = sync(new, late, late="3 days")
    assert outcomes(decided) == {"Q61": "upserted", "Q60": "stale"}
    assert sync(new, late.where("qid = 'Q61'"))[1] is None


def files(spark, root, version):
    return {path for name in names_in(spark, f"{root}/v={version}", "") for path in names_in(spark, f"{root}/v={version}/{name}", "bucket=")}


def test_only_touched_buckets_are_written(spark, t):
    n, many = 32, changes_of(spark, [agent(f"Q{2000 + i}", "2026-01-01", f"n{i}", "Q2", genres=[f"Q{3000 + i % 40}"]) for i in range(400)])
    start, _ = run_update(t, many)
    root = shared_folder(spark, "buckets")
    publish(start, root, 1, buckets=n)
    before = latest(spark, root)
    assert before.buckets == n and catalog_rows(before.tables) == catalog_rows(start)
    ten = [agent(f"Q{2000 + i}", "2026-01-02", f"changed {i}", "Q2") for i in range(5)] + [agent(f"Q{5000 + i}", "2026-01-02", f"new {i}") for i in range(5)]
    apply_batch(root, lambda s: "q")(changes_of(spark, ten), 0)
    after = latest(spark, root)
    want, _ = run_update(start, changes_of(spark, ten))
    assert catalog_rows(after.tables) == catalog_rows(want)
    moved = {name: sum(after.places[name].get(b) != before.places[name].get(b) for b in range(n)) for name in after.places}
    assert 0 < moved["artist"] <= 10 and max(moved.values()) <= 10 and moved["album"] == moved["track"] == 0
    assert after.places["album"] == before.places["album"] and len(after.places["artist"]) == n


def test_buckets_in_any_order_and_versions_let_go(spark, t):
    results = []
    for order in [(2, 3), (3, 2)]:
        root = shared_folder(spark, "buckets")
        publish(t, root, 1, buckets=8)
        for number, i in enumerate(order):
            apply_batch(root, lambda s: "q", keep=2)(changes_of(spark, BATCHES[i]), number)
        apply_batch(root, lambda s: "q", keep=2)(changes_of(spark, BATCHES[i]), number)  # once more after a failure
        newest = latest(spark, root)
        assert newest.version == 3 and sorted(names_in(spark, f"{root}/manifest", "version")) == ["version=2", "version=3"]
        there = {f"{root}/v={v}/{name}/{b}" for v in range(1, 4) for name in names_in(spark, f"{root}/v={v}", "") for b in names_in(spark, f"{root}/v={v}/{name}", "bucket=")}
        named = {path for at in newest.places.values() for path in at.values()}
        assert named <= there and len(there) < 2 * len(named)
        results.append(catalog_rows(newest.tables))
        assert no_orphans(newest.tables)
    assert results[0] == results[1]


def test_a_batch_reads_its_buckets_only(spark, t):
    root = shared_folder(spark, "buckets")
    publish(run_update(t, changes_of(spark, [agent(f"Q{2000 + i}", "2026-01-01", f"n{i}") for i in range(200)]))[0], root, 1, buckets=64)
    part = latest(spark, root).part("artist", {3, 5})
    assert len(part.inputFiles()) <= 2 and part.count() < 30
    assert list(itertools.chain(part.where(F.col("id").isNull()).collect())) == []


def test_a_batch_is_read_from_its_source_once(spark, t):
    root, read = shared_folder(spark, "snapshots"), spark.sparkContext.accumulator(0)
    publish(t, root, 1)

    def seen(qid):
        read.add(1)
        return qid

    batch = changes_of(spark, [agent("Q7001", "2026-01-01", "one"), agent("Q7001", "2026-01-02", "two"), agent("Q7002", "2026-01-01", "other")])
    apply_batch(root, lambda s: "q")(batch.withColumn("qid", F.udf(seen, "string")("qid")), 0)
    assert read.value == 3
    assert rows(latest(spark, root).tables["artist"].where("id in ('Q7001', 'Q7002')").select("id", "name")) == [("Q7001", "two"), ("Q7002", "other")]


def test_decided_tells_which_entities_come_several_times(spark, t):
    two = [agent("Q7001", "2026-01-01", "one"), agent("Q7001", "2026-01-02", "two"), agent("Q7002", "2026-01-01", "other")]
    again = changes_of(spark, two).withColumn("tries", F.col("modified").cast("date").eqNullSafe(F.lit("2026-01-01").cast("date")).cast("int"))  # as if tried again
    decided = update.decide(update.parse(again), t)
    assert rows(decided.select("qid", "outcome", "several")) == [("Q7001", "stale", True), ("Q7001", "upserted", True), ("Q7002", "upserted", False)]


def test_rows_known_to_differ_are_not_compared(spark):
    make = lambda *rows: spark.createDataFrame(rows, "a string, b string, n int")
    new = insert_or_ignore(make(("x", "y", 1)), make(("x", "y", 2), ("x", "z", None)), ["a", "b"], different=True)
    assert rows(new) == [("x", "y", 1), ("x", "z", None)]
    assert "Aggregate" not in new._jdf.queryExecution().toString()
