"""Many terms at once, the kept token index, rescans, inline counters, audits and pages, against plain versions and by their plans."""

import json
import math
import re

import pytest
from pyspark.sql import functions as F

from entitymart.operators import audit, pages, search, tokenindex
from entitymart.operators.tables import genre_ids
from entitymart.plans.catalog import bootstrap, populate
from entitymart.sources.dump import by_ids, counters
from entitymart.sources.storage import latest, shared_folder
from tests.test_flows import LINES, rows

NAMES = ["U2", "U2 live", "AU2", None, "100%", "a\\b", "x_y", "", "ab", "a", "żółw żółty", "aaaa", "banana bandana", "O'Neil"] + [f"U2 {i:03}" for i in range(120)] + ["tie"] * 3


@pytest.fixture(scope="module")
def artist(spark):
    return spark.createDataFrame([(f"Q{i}", n, "from U2" if n is None else None) for i, n in enumerate(NAMES)], "id string, name string, description string")


def plain(name):
    """LIKE without an escape character."""
    return lambda term: re.compile(".*" + "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in term) + ".*", re.S).fullmatch(name or "") is not None and name is not None


def test_many_terms_find_what_one_finds(spark, artist):
    terms = ["U2", "live", "x%y", "_", "__", "%", "a\\b", "\\", "", None, "zzz", "żół", "ana", "an%an", "U_ 0%9", "'", "100%", "aaa", "U2", "tie", "from"]
    found = search.search_terms(artist, spark.createDataFrame([(t,) for t in terms], "t string"), ["name", "description"], exact_first=True).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["place"]):
        got.setdefault(r["term"], []).append((r["id"], r["name"]))
    want = {}
    for t in {t for t in terms if t}:
        hits = [(f"Q{i}", n) for i, n in enumerate(NAMES) if plain(n)(t) or (n is None and plain("from U2")(t))]
        hits.sort(key=lambda x: (x[1] != t, x[1] is None, (x[1] or "").encode(), x[0]))
        if hits:
            want[t] = hits[:100]
    assert got == want and len(got["U2"]) == 100 and got["U2"][0] == ("Q0", "U2")
    assert search.search_terms(artist.where("false"), artist.select("name"), ["name"]).count() == 0


def tables_of(index):
    words = [(r["id"], r["length"], sorted(r["tokens"])) for r in index.tables["words"].collect()]
    return sorted(words), rows(index.tables["postings"]), rows(index.tables["totals"])


def test_index_follows_changes(spark, artist):
    columns, root = ["name", "description"], shared_folder(spark, "index")
    index = tokenindex.build(artist, columns, root, buckets=8)
    after = artist.where("id <> 'Q1'").withColumn("name", F.when(F.col("id") == "Q0", "Live again").when(F.col("id") == "Q3", None).otherwise(F.col("name")))
    after = after.unionByName(spark.createDataFrame([("Q999", "brand new U2", None)], after.schema))
    changed = tokenindex.changed(artist, after)
    assert rows(changed) == [("Q0",), ("Q1",), ("Q999",)]
    new = tokenindex.bring_up_to_date(index, after, changed, columns)
    assert tables_of(new) == tables_of(tokenindex.build(after, columns, shared_folder(spark, "index"), buckets=8))
    kept = sum(new.places["postings"].get(b) == path for b, path in index.places["postings"].items())
    assert kept > 0 and latest(spark, root).version == 2
    found = tokenindex.search_many(new, after, spark.createDataFrame([("live",), ("U2 new",), ("...",), (None,), ("nothing here",)], "q string"))
    assert rows(found.where("place = 1").select("query", "name")) == [("U2 new", "brand new U2"), ("live", "Live again")]
    one = search.token_search(after, search.token_index(after, columns), "U2 new", columns)
    assert [r["id"] for r in one.collect()] == [r["id"] for r in found.where("query = 'U2 new'").orderBy("place").collect()]


def test_long_terms_look_at_few_rows(spark):
    """Rows of numbered names that share most of their runs of three characters."""
    names = spark.range(2000).select(F.format_string("q%d", "id").alias("id"), F.format_string("Customer#%09d", F.col("id") * 37).alias("name"))
    terms = names.select(F.col("name").alias("term")).union(names.select(F.substring("name", 12, 20))).union(names.sparkSession.createDataFrame([("%0037_",), ("00",)], "t string"))
    near = search.may_hold(names, terms, ["name"])
    assert near.where("term not in ('00', '%0037_')").count() < 3 * 4000
    found = search.search_terms(names, terms, ["name"], exact_first=True)
    assert found.where("term like 'Customer%'").count() == 2000 and found.where("term = '00'").count() == 100


def plain_ranks(texts, queries, top):
    """All rows of all queries, one after the other."""
    docs = {i: (n, [w for w in re.split(r"[^a-z0-9]+", f"{n or ''} {d or ''}".lower()) if w]) for i, n, d in texts}
    mean = sum(len(w) for _, w in docs.values()) / len(docs)
    df = {}
    for _, w in docs.values():
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    weight = lambda t, w: math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / mean))
    out = []
    for q in queries:
        asked = sorted({t for t in re.split(r"[^a-z0-9]+", q.lower()) if t})
        scored = [(n != q, -round(sum(weight(t, w) for t in asked if t in w), 9), n is None, n or "", i) for i, (n, w) in docs.items() if set(asked) & set(w)]
        out += [(q, place, x[4], -x[1]) for place, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def test_queries_of_common_words_look_at_few_rows(spark, monkeypatch):
    monkeypatch.setattr(tokenindex, "COMMON", 20)
    texts = [(f"d{i:03}", None if i % 41 == 0 else f"red {i % 150}" + " blue" * (i % 3) + " red" * (i % 5 == 0), "green" if i % 2 else "blue old") for i in range(400)]
    df = spark.createDataFrame(texts + [("x", "Green red", None), ("y", "zebra", "red")], "id string, name string, description string")
    queries = [f"red {i}" for i in range(60)] + ["red", "blue green red", "Green red", "zebra red old", "7 8", "red blue 9", "none", "zebra", "GREEN", "red 149 green 3"]
    index = tokenindex.build(df, ["name", "description"], shared_folder(spark, "index"), buckets=4)
    found = tokenindex.search_many(index, df, spark.createDataFrame([(q,) for q in queries], "q string"), top=5)
    got = sorted((r["query"], r["place"], r["id"], r["score"]) for r in found.collect())
    want = plain_ranks([tuple(r) for r in df.collect()], queries, 5)
    assert [x[:3] for x in got] == [x[:3] for x in want] and all(abs(x[3] - y[3]) < 2e-9 for x, y in zip(got, want))
    asked = spark.createDataFrame([(f"red {i}", t, t == "red") for i in range(60) for t in ("red", str(i))], "query string, token string, common boolean")
    weighed = index.tables["postings"].select("token", "id", F.lit(1.0).alias("weight"))
    assert tokenindex.candidates(asked, weighed, df, 5).count() < 60 * 10  # 380 rows hold red


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([("f", x) for x in LINES], "file string, value string")


def test_misses_are_never_parsed(spark, lines):
    first = bootstrap(lines)
    assert first.counts == counters(first.triaged).first().asDict()
    hits = by_ids(lines, genre_ids(first.staged))
    assert rows(hits.select("qid")) == [("Q10",)]
    told = plan(hits)
    assert told.index("from_json") < told.index("LeftSemi")  # printed from the top: parsing stands above the join, the join above the scan
    below = told[told.index("LeftSemi") :]
    assert "from_json" not in below and "getbit" in below
    many = spark.createDataFrame([("f", json.dumps({"id": f"Q{i}", "type": "item"})) for i in range(2000)], "file string, value string")
    assert by_ids(many, spark.createDataFrame([("Q7",), ("Q1999",), (None,), ("Q5000",)], "qid string")).count() == 2


def test_audits_read_each_table_once(spark, lines):
    first = bootstrap(lines)
    t = {name: spark.createDataFrame(df.collect(), df.schema) for name, df in populate(first.found, first.tables).tables.items()}
    planted = t | {"artist_member_of": t["artist_member_of"].union(spark.createDataFrame([("Q405", "Q406"), ("Q405", None)], "artist_id string, group_id string"))}
    got = {r["metric"]: r["n"] for r in audit.orphans(planted).collect()}
    assert len(got) == 13 and {k: v for k, v in got.items() if v} == {"artist_member_of.artist_id": 2, "artist_member_of.group_id": 2}
    stored = {name: df for name, df in zip(t, (x for x in t.values()))}
    assert plan(audit.orphans(stored)).count("Scan ExistingRDD") <= 7 + 4 + 1
    assert plan(audit.resolution(stored)).count("Scan ExistingRDD") == 3


def test_pages(spark):
    df = spark.range(1003).select(F.format_string("Q%04d", "id").alias("id"))
    got = sorted(tuple(r) for r in pages.borders(df, 100).collect())
    assert got == [(i, f"Q{100 * i:04d}", f"Q{min(1002, 100 * i + 99):04d}", 100 if i < 10 else 3) for i in range(11)]
    assert pages.borders(df.where("false"), 10).collect() == []
    laid = pages.in_key_order(df, parts=8)
    spans = [r for r in laid.groupBy(F.input_file_name()).agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").select("a", "b").collect()]
    assert len(spans) > 3 and all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))  # a cursor lies in one file, and those before it are skipped by their bounds
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,Q0500)]" in plan(laid.where("id > 'Q0500'"))
