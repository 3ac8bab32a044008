"""Entity dumps: lines of JSON in an array, gzipped or not, scanned, triaged and decoded.

A single gzip file is read by one task, so its lines are dealt anew right after the scan; sharded or splittable input is not.
Decoding parses each line once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymart.functions.claims import targets, trimmed
from entitymart.operators.bitfilter import may_be_in
from entitymart.operators.classify import classify
from entitymart.profiles import MUSIC, Profile
from entitymart.schemas import ENTITY

#: What becomes of a line: kept, of no interest, unreadable, array bracket, blank.
STATUSES = ("filtered", "excluded", "rejected", "bracket", "blank")


def scan(spark: SparkSession, paths: str | list[str], deal_to: int | None = None) -> DataFrame:
    """(file, value) of every line. ``deal_to``: partitions after an input that cannot be split."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.repartition(deal_to) if deal_to else lines


def decode(lines: DataFrame) -> DataFrame:
    """Adds body (the line without white space; a comma behind an object is not read), kind (bracket, blank or entity) and entity with ``broken``."""
    text = trimmed(F.col("value"))
    kind = F.when(text.isin("[", "]"), "bracket").when(text == "", "blank").otherwise("entity")
    rows = lines.withColumns({"kind": kind, "body": text})
    schema = f"{ENTITY}, broken string"
    parsed = F.from_json(F.when(F.col("kind") == "entity", F.col("body")), schema, {"columnNameOfCorruptRecord": "broken"})
    # A generated column: filters on it are not pushed below, which would parse the line again for each use of a field.
    return rows.select("*", F.explode_outer(F.array(parsed)).alias("entity"))


def triage(lines: DataFrame, profile: Profile = MUSIC) -> DataFrame:
    """Adds status, verdict (role and reason, where kept) and reason (where rejected) to decoded lines.

    A line is rejected if it is no entity object, lacks id or type, or says null for its claims.
    """
    rows = decode(lines)
    e = F.col("entity")
    # Columns of their own, so each is read once for all rules, by compiled code.
    props = {r.prop: f"of_{r.prop}" for r in profile.rules}
    rows = rows.withColumns({name: targets(e["claims"], prop, empty=True) for prop, name in props.items()})
    unreadable = e.isNull() | e["broken"].isNotNull()
    null_claims = e["claims"].isNull() & F.col("body").rlike(r'"claims"\s*:\s*null')
    why = (
        F.when(F.col("kind") != "entity", F.lit(None).cast("string"))
        .when(unreadable, "not an entity object")
        .when(e["id"].isNull(), "no id")
        .when(e["type"].isNull(), "no type")
        .when(null_claims, "claims are null")
        .when((e["id"] == "") & F.col("verdict").isNotNull(), "empty id")
    )
    rows = rows.withColumn("verdict", F.when(~unreadable, classify(e["claims"], profile, {prop: F.col(name) for prop, name in props.items()}))).withColumn("reason", why)
    rows = rows.withColumn("verdict", F.when(F.col("reason").isNull(), F.col("verdict")))
    status = (
        F.when(F.col("kind") != "entity", F.col("kind")).when(F.col("reason").isNotNull(), "rejected").when(F.col("verdict").isNull(), "excluded").otherwise("filtered")
    )
    return rows.withColumn("status", status).drop(*props.values())


def rejects(triaged: DataFrame) -> DataFrame:
    return triaged.where("status = 'rejected'").select("file", F.col("value").alias("raw"), "reason")


def counted() -> list[Column]:
    """The counters of triaged lines; processed counts all lines but blank ones."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    return [
        F.count_if(F.col("status") != "blank").alias("processed"), is_("filtered").alias("filtered"), is_("rejected").alias("rejected"),
        is_("excluded").alias("excluded"), is_("bracket").alias("brackets"),
    ]


def counters(triaged: DataFrame) -> DataFrame:
    return triaged.agg(*counted())


def id_in(line: Column) -> Column:
    """The entity's id, cut out of a line; a line that does not begin with it is parsed for it."""
    body = F.rtrim(trimmed(line), F.lit(","))
    quick = F.regexp_extract(body, r'^\{(?:"type":"\w+",)?"id":"([^"\\]+)"', 1)
    return F.when(quick != "", quick).otherwise(F.get_json_object(body, "$.id"))


def by_ids(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """Entities of a dump whose id is in ``ids`` (column qid). Ids are cut out of the lines and tested against a bounded filter in the scan, so few other
    lines travel to the exact join, and only hits are parsed."""
    marked = lines.select("file", "value", id_in(F.col("value")).alias("qid"))
    near = marked.where(may_be_in(ids.select("qid"), F.col("qid")))
    hits = near.join(ids.select("qid").distinct(), "qid", "left_semi")
    return decode(hits).where("entity is not null and entity.broken is null and entity.type is not null").select("qid", "entity")
