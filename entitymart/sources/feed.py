"""Renders relational star tables as entity dump lines, so that the real flow runs over real text.

Nations are genres, customers and suppliers agents, parts record labels, orders albums, line items tracks; events are changes of
customers, and every order and line item is changed once. Which row carries which oddity is a function of its key (see ``_agent_claims`` and the comments below).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymart.sources.storage import spread


def snak(value: Column) -> Column:
    return F.concat(F.lit('{"mainsnak":{"snaktype":"value","datavalue":{"value":'), value, F.lit("}}}"))


def target(qid: Column) -> Column:
    return snak(F.concat(F.lit('{"id":"'), qid, F.lit('"}')))


def time(text: Column, precision: Column | None = None) -> Column:
    said = F.concat(F.lit(',"precision":'), precision.cast("string")) if precision is not None else F.lit("")
    return snak(F.concat(F.lit('{"time":"+'), text, F.lit('T00:00:00Z"'), said, F.lit("}")))


def claims(**props: list[Column]) -> Column:
    """Null claims are left out, and properties without any."""
    parts = [F.nullif(F.concat_ws(",", *cs), F.lit("")) for cs in props.values()]
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{p}":['), x, F.lit("]")) for p, x in zip(props, parts)]), F.lit("}"))


def line(qid: Column, label: Column, claim_text: Column, description: Column | None = None, title: Column | None = None) -> Column:
    text = lambda s: F.to_json(F.struct(s.alias("value")))
    named = lambda key, inner, s: F.when(s.isNotNull(), F.concat(F.lit(f',"{key}":'), inner))
    parts = [
        F.concat(F.lit('{"type":"item","id":"'), qid, F.lit('"')),
        named("labels", F.concat(F.lit('{"en":'), text(label), F.lit("}")), label),
        F.concat(F.lit(',"claims":'), claim_text),
    ]
    if description is not None:
        parts.append(named("descriptions", F.concat(F.lit('{"en":'), text(description), F.lit("}")), description))
    if title is not None:
        parts.append(named("sitelinks", F.concat(F.lit('{"enwiki":'), F.to_json(F.struct(title.alias("title"))), F.lit("}")), title))
    return F.concat(F.concat_ws("", *parts), F.lit("},"))


def qid(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spread(spark.read.parquet(f"{sf_dir}/{n}.parquet")) if n in ("orders", "lineitem") else spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def _agent_claims(more_genres: list[Column], more_instruments: list[Column]) -> Column:
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    within = lambda *s: seg.isin(*s)
    born = F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), k.cast("int")), "yyyy-MM-dd")
    both = within("MACHINERY", "BUILDING")
    genre = within("MACHINERY", "BUILDING", "AUTOMOBILE")
    return claims(
        P18=[snak(F.lit('"Portrait.jpg"'))],
        P106=[
            F.when(within("MACHINERY"), target(F.lit("Q639669"))),
            F.when(within("BUILDING"), target(F.lit("Q5"))),
            F.when(within("BUILDING"), target(F.lit("Q177220"))),
        ],
        P31=[F.when(within("FURNITURE", "HOUSEHOLD"), target(F.lit("Q5")))],
        P1303=[F.when(within("FURNITURE"), target(x)) for x in [F.lit("Q171"), *more_instruments]],
        P136=[F.when(genre, target(x)) for x in [qid("QN", F.col("c_nationkey")), *more_genres]],
        P463=[F.when(both, target(qid("QS", k % (F.col("n_suppliers") + 10))))],
        # every 13th birth date is no date; every second of those has a good one after it
        P569=[F.when(both & (k % 13 == 0), time(F.lit("1950-00-00"))), F.when(both & ((k % 13 != 0) | (k % 26 == 0)), time(born))],
    )


def _counted(df: DataFrame, of: DataFrame, name: str) -> DataFrame:
    """``df`` with the number of rows of another table."""
    return df.crossJoin(F.broadcast(of.agg(F.count("*").alias(name))))  # one row


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = _tables(spark, sf_dir, "customer", "supplier")
    return _counted(customer, supplier, "n_suppliers")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, part = _tables(spark, sf_dir, "orders", "part")
    return _counted(orders, part, "n_parts")


def _order_name() -> Column:
    """Every 11th order has no name, every 13th of the others one that looks like an id."""
    k = F.col("o_orderkey")
    return F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 13 == 0, qid("Q", k)).otherwise(F.concat(F.lit("Order "), k.cast("string")))


def _album(label: Column) -> Column:
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    coarse = [day, F.concat(F.substring(day, 1, 7), F.lit("-00")), F.concat(F.substring(day, 1, 4), F.lit("-00-00"))]
    when = F.when(k % 4 == 0, coarse[0]).when(k % 4 == 1, coarse[1]).otherwise(coarse[2])
    return line(
        qid("QO", k), label,
        claims(P31=[target(F.lit("Q482994"))], P175=[target(qid("QC", F.col("o_custkey")))], P577=[time(when, 11 - k % 4)],
               P264=[target(qid("QL", k % F.col("n_parts")))], P136=[target(qid("QN", k % 25))]),
    )


def _track(label: Column) -> Column:
    unit = F.when(F.col("l_linenumber") % 3 == 1, "Q11574").when(F.col("l_linenumber") % 3 == 2, "Q7727")
    unit = F.coalesce(F.concat(F.lit(',"unit":"http://www.wikidata.org/entity/'), unit, F.lit('"')), F.lit(""))
    amount = F.concat(F.lit('{"amount":"+'), (F.col("l_quantity").cast("long") * 10).cast("string"), F.lit('"'), unit, F.lit("}"))
    return line(
        F.concat(qid("QT", F.col("l_orderkey")), F.lit("x"), F.col("l_linenumber").cast("string")), label,
        claims(P31=[target(F.lit("Q7366"))], P361=[target(qid("QO", F.col("l_orderkey")))], P175=[target(qid("QS", F.col("l_suppkey")))], P2047=[snak(amount)]),
    )


def _item_name() -> Column:
    return F.concat(F.lit("Item "), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of the dump, record labels before the albums that name them."""
    nation, supplier, part, lineitem = _tables(spark, sf_dir, "nation", "supplier", "part", "lineitem")
    n, k, s, p = (F.col(c) for c in ("n_nationkey", "c_custkey", "s_suppkey", "p_partkey"))
    unless = lambda cond, x: F.when(~cond, x)
    none = F.lit("{}")
    parts = [
        spark.createDataFrame([("[",), ("",)], "value string"),
        nation.select(line(qid("QN", n), unless(n % 7 == 0, F.col("n_name")), none)),
        nation.where(n % 5 == 0).select(F.concat(F.lit('{"id":"QX'), n.cast("string"), F.lit('","claims": broken},'))),
        part.select(line(qid("QL", p), unless(p % 9 == 0, F.col("p_name")), none)),
        supplier.limit(1).select(line(F.lit("Q171"), F.lit("Instrument 171"), none)),
        supplier.select(line(qid("QS", s), F.col("s_name"), claims(P31=[target(F.lit("Q215380"))]))),
        _customers(spark, sf_dir).select(
            line(qid("QC", k), unless(k % 10 == 0, F.col("c_name")), _agent_claims([], []), F.col("c_mktsegment"), F.when(k % 20 == 0, F.replace("c_name", F.lit("#"), F.lit("_"))))
        ),
        _orders(spark, sf_dir).select(_album(_order_name())),
        lineitem.select(_track(_item_name())),
        spark.createDataFrame([("]",)], "value string"),
    ]
    return reduce(DataFrame.union, [x.toDF("value") for x in parts])


#: Gzip cannot be split, so a dump is many files of some 20 MB of text each.
LINES_PER_FILE = 50_000


def write_dump(lines: DataFrame, path: str) -> None:
    """Writes dump lines as gzipped files, as dumps come: a twentieth of the plain text."""
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).text(path)


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, modified, value): customers as events touch them, and all orders and items. Names end in v2 or rev; customers have
    a further genre or instrument."""
    events, lineitem = _tables(spark, sf_dir, "events", "lineitem")
    customers = _customers(spark, sf_dir)
    touched = _counted(events, customers, "n_customers").select((F.col("user_id") % F.col("n_customers")).alias("c_custkey"), F.col("ts").alias("modified"))
    k = F.col("c_custkey")
    agent = line(qid("QC", k), F.when(k % 10 != 0, F.concat("c_name", F.lit(" v2"))), _agent_claims([qid("QZ", k % 3)], [F.lit("Q172")]), F.col("c_mktsegment"))
    track = F.concat(qid("QT", F.col("l_orderkey")), F.lit("x"), F.col("l_linenumber").cast("string"))
    return (
        touched.join(customers, "c_custkey").select(qid("QC", k).alias("qid"), "modified", agent.alias("value"))
        .union(_orders(spark, sf_dir).select(qid("QO", F.col("o_orderkey")), "o_orderdate", _album(F.concat(_order_name(), F.lit(" rev")))))
        .union(lineitem.select(track, "l_shipdate", _track(F.concat(_item_name(), F.lit(" rev")))))
    )


def late_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, modified, value): each event names its customer after its own time, so what stands tells which change counted."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    customers = _customers(spark, sf_dir)
    touched = _counted(events, customers, "n_customers").select((F.col("user_id") % F.col("n_customers")).alias("c_custkey"), F.col("ts").alias("modified"))
    named = F.concat("c_name", F.lit(" "), F.date_format("modified", "yyyy-MM-dd HH:mm:ss"))
    agent = line(qid("QC", F.col("c_custkey")), named, _agent_claims([], []), F.col("c_mktsegment"))
    return touched.join(customers, "c_custkey").select(qid("QC", F.col("c_custkey")).alias("qid"), "modified", agent.alias("value"))


CHAIN = 50


def chain_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as new agents QM, each a member of the next, in chains of ``CHAIN``. A third of the chains end with an unknown group QX, a third with nobody,
    a third in a circle. The second frame brings every other unknown group, a day later."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    k, block = F.col("c_custkey"), F.floor(F.col("c_custkey") / CHAIN)
    last = F.when(block % 3 == 0, qid("QX", block)).when(block % 3 == 2, qid("QM", block * CHAIN))
    group = F.when(k % CHAIN != CHAIN - 1, qid("QM", k + 1)).otherwise(last)
    member = line(qid("QM", k), F.col("c_name"), claims(P106=[target(F.lit("Q639669"))], P463=[F.when(group.isNotNull(), target(group))]))
    at = lambda day: F.lit(day).cast("timestamp").alias("modified")
    ends = customer.where((k % CHAIN == CHAIN - 1) & (block % 6 == 0))
    found = line(qid("QX", block), F.lit("Found"), claims(P31=[target(F.lit("Q215380"))]))
    return (
        customer.select(qid("QM", k).alias("qid"), at("2030-01-01"), member.alias("value")),
        ends.select(qid("QX", block).alias("qid"), at("2030-01-02"), found.alias("value")),
    )
