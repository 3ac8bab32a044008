"""Line dedup over overlapping windows of three lines, in DataFrame operations only.

A text's lines are what stands between newline characters. Every window of three consecutive lines gets a 128-bit hash. A window that
occurs again, in another document or later in the same one, is a later occurrence unless it comes first in the order of
(doc_id, place); the lines that later occurrences cover are removed, united per document. Texts of fewer than three lines have no window
and stay. The content of a removed line always survives at its first place.

Shuffles: one aggregation of slim window rows (two hashes, an id), with partial sums before it, so a window that a third of all rows
share sends one row a task; one join of the windows with the repeated ones only, which are stored first, so that adaptive execution can split a
hot window's rows; and one join that brings the covered lines to the documents. For the last, documents that a bit field of bounded size
knows to be untouched stay where they are; only the others travel. Joins are merge joins at every size: no side
has a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import maybe_one_of, packed, stored, unpacked


def windows(docs: DataFrame) -> DataFrame:
    """A row for each window: doc_id, th (which text, where rows share an id), pos from 0, and the hash in h1, h2."""
    lines = F.split("text", "\n", -1)
    numbered = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), lines.alias("l")
    )
    three = F.slice(F.arrays_zip("l", F.slice("l", 2, F.size("l")), F.slice("l", 3, F.size("l"))), 1, F.size("l") - 2)
    each = numbered.where(F.size("l") >= 3).select("doc_id", "th", F.posexplode(three).alias("pos", "w"))
    parts = [F.col("w")["l"], F.col("w")["1"], F.col("w")["2"]]
    return each.select("doc_id", "th", "pos", F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2"))


def later_first(found: Column) -> Column:
    """Of one document's sorted (h1, h2, th, pos, own): those that are later occurrences, as (th, pos).

    ``own`` says that no other document comes before; then a window is later if the entry before it is the same window at
    another place of this document."""
    same = lambda x, y: (x["h1"] == y["h1"]) & (x["h2"] == y["h2"])
    moved = lambda x, y: (x["th"] != y["th"]) | (x["pos"] != y["pos"])
    pairs = F.arrays_zip(found.alias("x"), F.concat(F.array(F.lit(None)), found).alias("y"))
    kept = F.filter(pairs, lambda p: p["x"].isNotNull() & (~p["x"]["own"] | (p["y"].isNotNull() & same(p["x"], p["y"]) & moved(p["x"], p["y"]))))
    return F.transform(kept, lambda p: F.struct(p["x"]["th"].alias("th"), p["x"]["pos"].alias("pos")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts' repeated windows removed, plus n_lines and n_removed.

    Rows with a null id or text keep their text and take no part; a null text has 0 lines. Repeated rows (same id and text) are
    one document and keep the same lines. Extra columns pass through under any name; columns called n_lines or n_removed are replaced.
    """
    slim = windows(docs)
    repeated = slim.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = stored(repeated, "linededup-repeated")
    found = slim.join(repeated.hint("merge"), ["h1", "h2"]).select("doc_id", F.struct("h1", "h2", "th", "pos", (F.col("doc_id") == F.col("first_id")).alias("own")).alias("w"))
    per_doc = found.groupBy("doc_id").agg(F.array_sort(F.collect_set("w")).alias("found"))
    later = per_doc.select(F.col("doc_id").alias("id"), later_first(F.col("found")).alias("later")).where(F.size("later") > 0)
    later = stored(later, "linededup-later")

    rows = docs.select(packed(docs, ("n_lines", "n_removed")).alias("row"), F.col("doc_id").cast("long").alias("id"))
    whole = F.col("row").getField(next(c for c in rows.schema["row"].dataType.names if c.lower() == "text"))
    touched = maybe_one_of(later.select("id"), F.col("id"))
    lines = F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    n_lines = F.coalesce(lines, F.lit(0)).cast("long")
    stay = rows.where(~touched).select(*unpacked(rows, "row"), n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))

    # The hash is a column from below the join: within the lambda it would be taken once for each repeated window.
    both = rows.where(touched).withColumn("own", F.xxhash64(whole)).join(later.hint("merge"), "id", "left")
    starts = F.transform(F.filter("later", lambda x: x["th"] == F.col("own")), lambda x: x["pos"])
    covered = F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))
    split = both.withColumn("lines", F.when(F.col("later").isNotNull() & whole.isNotNull(), F.split(whole, "\n", -1)))
    kept = split.withColumn("kept", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), covered))
    text = F.when(F.col("kept").isNotNull(), F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")).otherwise(whole)
    columns = [text.alias(c) if c.lower() == "text" else x for c, x in zip(rows.schema["row"].dataType.names, unpacked(rows, "row"))]
    removed = F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long")
    return stay.unionAll(kept.select(*columns, n_lines.alias("n_lines"), removed.alias("n_removed")))
