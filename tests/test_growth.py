"""What the flows write: not more than a query asks for, and a dump as dumps come."""

import os

from entitymart import queries as q
from entitymart.sources import feed
from entitymart.sources.dump import scan
from entitymart.sources.storage import StoredTables, shared_folder

DIR = "/root/testdata/sf0.001"


def local(path):
    return path.removeprefix("file://")


def size(path):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(local(path)) for f in files)


def test_a_dump_is_a_small_part_of_its_text(spark):
    lines, path = feed.dump_lines(spark, DIR), shared_folder(spark, "dump")
    feed.write_dump(lines, path)
    text = [r.value for r in lines.collect()]
    assert size(path) < sum(map(len, text)) / 8
    assert sorted(r.value for r in scan(spark, path).select("value").collect()) == sorted(text)


def test_a_catalog_writes_a_compressed_dump(spark):
    names = [os.path.basename(r.file) for r in q.catalog(spark, DIR).lines.select("file").distinct().collect()]
    assert names and all(n.endswith(".txt.gz") for n in names)


def test_tables_are_stored_when_asked_for(spark):
    t = StoredTables({"a": spark.range(3), "b": spark.range(4)})
    assert "a" in t and "c" not in t and t.get("c") is None and not t.kept
    assert t["a"] is t["a"] and list(t.kept) == ["a"]
    assert {name: df.count() for name, df in t.items()} == {"a": 3, "b": 4}


def test_a_search_of_artists_stores_no_other_table(spark):
    c = q.Catalog(spark, DIR)
    assert q.artist_hits(c).count() > 0
    assert list(c.tables.kept) == ["artist"]
