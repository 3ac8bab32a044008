"""URL filters on a Bloom filter cascade.

Keys are host suffixes with a path prefix (``example.net/en/``). The universe is every key of the corpus that a listed key could
equal: all host suffixes of a url with the path cut to the lengths that occur in the list. Level 0 of a cascade encodes the listed keys;
level 1 the universe's keys that level 0 takes wrongly; level 2 the listed keys that level 1 takes wrongly; and so on until
nothing is taken wrongly. Membership of any key of the universe is then exact, without a join and without the list.

The universe stays distributed and is never stored: level 0 is tested where urls are scanned, and only what it takes goes on. A level gets
the bits its keys set, united by Spark, so the driver sees bit arrays of a known size: the first rate is chosen so that level 1 stays within
``MAX_BYTES``, and a list too long for one level of that size is dealt by key hash to several cascades, which are built and asked one
after the other. Cascades of all verdicts are built together, a level at a time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from entitymart.llm.common import batch_of, packed, shared_folder, ship, slices, stored, unpacked

#: Bytes of one level's bits, wrong answers of level 0 (or fewer, where the universe is large) and of the later ones, and levels of a cascade.
MAX_BYTES, FIRST_RATE, RATE, MAX_LEVELS = 64 << 20, 1e-3, 0.1, 60
VERDICTS = ("block", "allow")


def host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, ASCII capitals made small; without ``://`` empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host, to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def keys(host_col: Column, path_col: Column, lengths: list[int], most: int) -> Column:
    """All keys of a url that a list could hold: host suffixes at label borders, of ``most`` labels at most, each with the path's prefixes of the given lengths."""
    labels = F.split(host_col, r"\.", -1)
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - most + 1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cuts = [F.when(F.length(path_col) >= n, F.substring(path_col, 1, n)) for n in lengths]
    prefixes = F.filter(F.array(*cuts), lambda p: p.isNotNull()) if cuts else F.array().cast("array<string>")
    found = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    return F.when(host_col != "", found).otherwise(F.array().cast("array<string>"))


@dataclass
class Bloom:
    bits: int
    hashes: int
    data: np.ndarray = field(repr=False)

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = positions(a, b, self.bits, self.hashes)
        return ((self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def positions(a: np.ndarray, b: np.ndarray, bits: int, hashes: int) -> np.ndarray:
    step = b.astype(np.uint64) | np.uint64(1)
    return (a.astype(np.uint64)[None] + np.arange(hashes, dtype=np.uint64)[:, None] * step[None]) % np.uint64(bits)


@dataclass
class Cascade:
    levels: list[Bloom]

    def has(self, grid: np.ndarray) -> np.ndarray:
        """Exact on the universe. A key's hashes for level i are columns 2i and 2i+1 of the grid. It is listed if the first level that
        refuses it is an odd one, or if none does and the number of levels is odd."""
        answer = np.full(len(grid), len(self.levels) % 2 == 1)
        open_ = np.ones(len(grid), dtype=bool)
        for i, level in enumerate(self.levels):
            refused = open_ & ~level.has(grid[:, 2 * i], grid[:, 2 * i + 1])
            answer[refused] = i % 2 == 1
            open_ &= ~refused
        return answer


def hashes(key: Column, level: int) -> tuple[Column, Column]:
    return F.xxhash64(key, F.lit(2 * level)), F.xxhash64(key, F.lit(2 * level + 1))


def n_bits(n: float, rate: float) -> int:
    return max(64, int(-n * math.log(rate) / math.log(2) ** 2) + 1)


def blooms(some: DataFrame, counts: dict[int, int], rate: float) -> dict[int, Bloom]:
    """Filters of the rows (v, a, b) of ``some`` for each v of ``counts``, which tells how many rows it has."""
    shape = {}
    for v, n in counts.items():
        bits = min(8 * MAX_BYTES, n_bits(n, rate))
        shape[v] = bits, min(16, max(1, round(bits / max(1, n) * math.log(2))))

    def set_bits(batches):
        for batch in batches:
            vs, a, b = (batch.column(i).to_numpy(False) for i in range(3))
            for v, (bits, k) in shape.items():
                at = positions(a[vs == v], b[vs == v], bits, k).ravel()
                word, bit = np.divmod(np.unique(at), 64)
                yield pa.RecordBatch.from_pydict({
                    "v": pa.array(np.full(len(word), v), pa.int32()), "word": word.astype(np.int64), "mask": (np.uint64(1) << bit.astype(np.uint64)).view(np.int64),
                })

    ship(some.sparkSession)
    got = some.mapInArrow(set_bits, "v int, word long, mask long").groupBy("v", "word").agg(F.bit_or("mask").alias("mask")).toPandas()
    out = {}
    for v, (bits, k) in shape.items():
        mine = got[got["v"] == v]
        data = np.zeros(-(-bits // 64), dtype=np.uint64)
        data[mine["word"].to_numpy(np.int64)] = mine["mask"].to_numpy(np.int64).view(np.uint64)
        out[v] = Bloom(bits, k, data.astype("<u8").view(np.uint8))
    return out


def cascades(listed: DataFrame, asked: DataFrame, rate: float) -> dict[int, Cascade]:
    """A cascade for each v. ``listed``: distinct (v, key), stored; ``asked``: the keys of the universe, with repeats, scanned once."""
    spark = listed.sparkSession
    ship(spark)
    counts = {r["v"]: r["count"] for r in listed.groupBy("v").count().collect()}
    built = {v: Cascade([]) for v in counts}

    def hashed(df: DataFrame, level: int, *columns: str) -> DataFrame:
        a, b = hashes(F.col("key"), level)
        return df.select(*columns, a.alias("a"), b.alias("b"))

    def add(df: DataFrame, n: dict[int, int], level: int):
        new = blooms(hashed(df, level, "v"), n, RATE if level else rate)
        for v, filter_ in new.items():
            built[v].levels.append(filter_)
        return spark.sparkContext.broadcast(new)

    first = add(listed, counts, 0)

    def taken_first(batches):
        for batch in slices(batches, 10_000):
            a, b = batch.column(1).to_numpy(False), batch.column(2).to_numpy(False)
            for v, filter_ in first.value.items():
                keys_ = batch.column(0).filter(pa.array(filter_.has(a, b))).unique()
                yield pa.RecordBatch.from_pydict({"v": pa.array(np.full(len(keys_), v), pa.int32()), "key": keys_})

    taken = hashed(asked, 0, "key").mapInArrow(taken_first, "v int, key string").distinct()
    others = taken.join(listed, ["v", "key"], "left_anti").select("v", "key", F.lit(1).alias("side"))
    rows = stored(listed.select("v", "key", F.lit(0).alias("side")).unionByName(others), "urls-level")
    for level in range(1, MAX_LEVELS):
        sizes = {(r["v"], r["side"]): r["count"] for r in rows.groupBy("v", "side").count().collect()}
        side = level % 2
        n = {v: c for (v, s), c in sizes.items() if s == side}
        if not n:
            return built
        shared = add(rows.where(F.col("side") == side), n, level)

        def taken_later(batches, shared=shared):
            for batch in batches:
                vs, a, b = (batch.column(i).to_numpy(False) for i in (0, 3, 4))
                kept = np.zeros(len(vs), dtype=bool)
                for v, filter_ in shared.value.items():
                    kept[vs == v] = filter_.has(a[vs == v], b[vs == v])
                yield batch.filter(pa.array(kept)).select([0, 1, 2])

        other = hashed(rows.where(F.col("side") != side), level, "v", "key", "side").mapInArrow(taken_later, "v int, key string, side int")
        rows = stored(rows.where((F.col("side") == side) & F.col("v").isin(list(n))).unionByName(other), "urls-level")
    raise ValueError("the cascade did not end; two keys share all hashes")


def members(built: dict[int, Cascade], depth: int, hash_lists) -> dict[int, np.ndarray]:
    """Which keys each cascade lists, from the keys' hashes for ``depth`` levels."""
    grid = hash_lists.flatten().to_numpy(False).view(np.uint64).reshape(-1, 2 * depth)
    return {v: c.has(grid) for v, c in built.items()}


def all_hashes(key: Column, depth: int) -> Column:
    """All levels' hashes of a key are Spark's own; Python only tests bits."""
    return F.array(*[h for i in range(depth) for h in hashes(key, i)])


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to the columns of ``pages``, whatever they are called (columns of these four names are replaced).

    ``rules``: host, path, verdict (block or allow). A rule fits its host and all subdomains where the path starts with the
    rule's path; the longest wins, at the same length the first in order; a url that none fits gets ``default``. Rules with a null are ignored. Null or
    unparseable urls have an empty host and no rule.
    """
    own = ("host", "path", "rule", "verdict")
    verdict = F.when(F.col("verdict") == VERDICTS[0], 0).otherwise(1)
    good = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isin(*VERDICTS))
    listed = stored(good.select(verdict.alias("v"), F.concat("host", "path").alias("key"), F.length("path").alias("n")).dropDuplicates(["v", "key", "n"]), "urls-listed")
    lengths = sorted(r[0] for r in listed.select("n").distinct().collect())  # no more than a url has characters
    most = good.agg(F.coalesce(F.max(F.size(F.split("host", r"\.", -1))), F.lit(1))).first()[0]
    listed = listed.select("v", "key").distinct()
    rows = pages.select(packed(pages, own).alias("row"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = rows.withColumn("keys", keys(F.col("host"), F.col("path"), lengths, most))
    n_listed, n_asked = listed.count(), rows.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    rate = min(FIRST_RATE, 4 * MAX_BYTES / max(1.0, n_bits(n_asked, RATE)))
    parts = max(1, math.ceil(n_bits(n_listed, rate) / (8 * MAX_BYTES)))
    found = judged(rows, listed, rate) if parts == 1 else judged_in_parts(rows, listed, rate, parts)
    said = F.when(F.col("v") == 0, VERDICTS[0]).when(F.col("v") == 1, VERDICTS[1]).otherwise(default)
    return found.select(*unpacked(rows, "row"), "host", "path", "rule", said.alias("verdict"))


def judged(rows: DataFrame, listed: DataFrame, rate: float) -> DataFrame:
    """``rows`` with the rule (key) that decides and its v: a narrow map with all cascades at hand."""
    built = cascades(stored(listed, "urls-keys"), rows.select(F.explode("keys").alias("key")), rate)
    depth = max([1, *(len(c.levels) for c in built.values())])
    shared = rows.sparkSession.sparkContext.broadcast(built)
    kept = rows.drop("keys").schema
    schema = StructType([*kept.fields, StructField("rule", StringType()), StructField("v", IntegerType())])
    target = to_arrow_schema(schema)

    def decide(batches):
        for batch in slices(batches, 2000):
            lists, hs = batch.column("keys"), batch.column("h")
            flat, member = lists.flatten().to_pylist(), members(shared.value, depth, hs.flatten())
            at, rule, said = 0, [], []
            for n in pc.list_value_length(lists).to_pylist():
                # at one key of two lists the least v decides
                best = max(((len(flat[i]), -i, -v) for i in range(at, at + n) for v, m in member.items() if m[i]), default=None)
                rule.append(flat[-best[1]] if best else None)
                said.append(-best[2] if best else None)
                at += n
            yield batch_of({c: batch.column(c) for c in kept.names} | {"rule": rule, "v": said}, target)

    return rows.withColumn("h", F.transform("keys", lambda k: all_hashes(k, depth))).mapInArrow(decide, schema)


def judged_in_parts(rows: DataFrame, listed: DataFrame, rate: float, parts: int) -> DataFrame:
    """The same for lists of any size. Rows and their keys are written once, the keys by part; each part has cascades of its own."""
    spark = rows.sparkSession
    part = lambda key: F.pmod(F.xxhash64(F.lit("part"), key), F.lit(parts)).cast("int")
    numbered = stored(rows.withColumn("id", F.monotonically_increasing_id()), "urls-rows")
    folder = shared_folder(spark, "urls-parts")
    numbered.select("id", F.posexplode("keys").alias("at", "key")).withColumn("part", part(F.col("key"))).write.partitionBy("part").parquet(folder)
    asked = spark.read.schema("id long, at int, key string, part int").parquet(folder)
    dealt = stored(listed.withColumn("part", part(F.col("key"))), "urls-listed")
    hits = []
    for p in range(parts):
        some = asked.where(F.col("part") == p)
        built = cascades(stored(dealt.where(F.col("part") == p).select("v", "key"), "urls-keys"), some.select("key"), rate)
        depth = max([1, *(len(c.levels) for c in built.values())])
        shared = spark.sparkContext.broadcast(built)

        def hit(batches, shared=shared, depth=depth):
            for batch in slices(batches, 10_000):
                for v, m in members(shared.value, depth, batch.column("h")).items():
                    got = batch.filter(pa.array(m)).select(["id", "at", "key"])
                    yield got.append_column("v", pa.array(np.full(got.num_rows, v), pa.int32()))

        found = some.select("id", "at", "key", all_hashes(F.col("key"), depth).alias("h")).mapInArrow(hit, "id long, at int, key string, v int")
        hits.append(stored(found, "urls-hits"))
    order = F.struct(F.length("key").alias("n"), (-F.col("at")).alias("at"), (-F.col("v")).alias("v"))
    best = reduce(DataFrame.unionByName, hits).groupBy("id").agg(F.max_by(F.struct("key", "v"), order).alias("best"))
    return numbered.join(best, "id", "left").select("row", "host", "path", F.col("best.key").alias("rule"), F.col("best.v").alias("v"))
