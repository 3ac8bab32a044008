"""N-gram Jaccard join: documents whose sets of word shingles are alike, by adaptive multi-match prefixes.

Shingles stand in one global order, rare ones first. If two sets are alike enough, their prefixes of ``|r| - least overlap + l`` shingles share at least l. A longer
prefix costs more look-ups but asks for more matches, so each document takes the l at which its estimated work (list lengths, and the candidates
that may be left of them) is least; a pair needs as many matches as the smaller l of the two asks for. Any order and any choice of l is exact; they only decide the work.

1. A count sketch over all documents (``CELLS`` counters a task, added up) orders shingles by how frequent they are.
2. Each different set (a point; copies never meet) sends the longest prefix it may take. Shingles that stand in one prefix only are dropped before anything is joined.
3. Lists of shingles with the same least member are one band, so near copies, which share dozens of shingles, meet once or twice and not once a shingle.
4. In a band, points look for partners with enough matches in slim rows. Only those with one go on with their whole sets, to the exact search of
   ``neardup.search_bands``: it returns groups, not pairs, and deals bands of any size to bounded blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from entitymart.llm import simhash
from entitymart.llm.common import arrow_schema, batch_of, maybe_one_of, per_batch, per_group_rows, ship, slices, stored
from entitymart.llm.neardup import GROUP, dealt_pairs, groups, search_bands

SHINGLE, PERCENT, SEED = 3, 90, 42
#: The longest prefixes ask for so many matches.
MOST = 8
#: Counters of the sketch, the parts in which they travel, and part sums added up by different tasks first.
CELLS, PARTS, SALTS = 1 << 22, 64, 32
#: Stands for a null id.
NO_ID = (1 << 63) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """Sorted numbers of the different shingles: ASCII capitals made small, words between ASCII white space, k words each; fewer words are one shingle."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words, repeat(SEED))), dtype=">u8").astype(np.uint64)
    k = min(k, len(h))
    x = np.full(len(h) - k + 1, np.uint64(k))
    for j in range(k):
        x = (x ^ h[j : len(h) - k + 1 + j]) * _ODD
        x ^= x >> np.uint64(29)
    return np.unique(x)


def bytes_of(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def least_overlap(n, percent: int):
    """Shingles that a set of n shares at least with any other that it is alike to."""
    return -(-n * percent // 100)


def sketch(docs: DataFrame, k: int) -> np.ndarray:
    """A level from 0 to 255 for each cell: eight times the logarithm of how many shingles of all documents fall into it."""
    per, schema, target = CELLS // PARTS, StructType().add("key", "long").add("counts", "binary"), arrow_schema("key long, counts binary")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, some = np.zeros(CELLS, dtype=np.uint32), b""
        for batch in slices(batches):
            for text in bytes_of(batch, 0):
                x = shingles(text, k)
                some = some or x[:1].tobytes()
                np.add.at(counts, (x % np.uint64(CELLS)).astype(np.int64), 1)
        salt = xxhash.xxh64_intdigest(some) % SALTS  # tasks are dealt by any shingle of theirs
        for part in range(PARTS):
            own = counts[part * per : (part + 1) * per].astype(np.uint64)
            if own.any():
                yield batch_of({"key": [part * SALTS + salt], "counts": [zlib.compress(own.tobytes(), 1)]}, target)

    def add(rows) -> Iterator[dict]:
        for key, own in rows:
            total = np.zeros(per, dtype=np.uint64)
            for (counts,) in own:
                total += np.frombuffer(zlib.decompress(counts), dtype=np.uint64)
            yield {"key": key, "counts": zlib.compress(total.tobytes(), 1)}

    ship(docs.sparkSession)
    mine = docs.select("text").mapInArrow(count, "key long, counts binary")
    salted = per_group_rows(mine.repartition("key").sortWithinPartitions("key"), add, schema, 16)
    whole = salted.select((F.col("key") / SALTS).cast("long").alias("key"), "counts").repartition("key").sortWithinPartitions("key")
    levels = np.zeros(CELLS, dtype=np.uint8)
    for r in stored(per_group_rows(whole, add, schema, 16), "ngram-sketch").collect():  # PARTS rows
        total = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.uint64)
        levels[r["key"] * per : (r["key"] + 1) * per] = np.minimum(255, np.round(8 * np.log2(total + 1.0)))
    return levels


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def prefixes(docs: DataFrame, levels: np.ndarray, k: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, size, point, prefix), stored: a hash of the set, and the longest prefix in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def make(batch):
        size, point, prefix = [], [], []
        for text in bytes_of(batch, 2):
            x = shingles(text, k)
            n = len(x)
            size.append(n)
            point.append(simhash.signed(xxhash.xxh64_intdigest(x.tobytes())))
            order = np.lexsort((x, shared.value[(x % np.uint64(CELLS)).astype(np.int64)]))
            most = least_overlap(n, percent)
            prefix.append(x[order[: n - most + min(MOST, most)]].view(np.int64))
        return {"doc_id": batch.column(0), "text_hash": batch.column(1), "size": size, "point": point, "prefix": pa.array(prefix, pa.list_(pa.int64()))}

    return stored(per_batch(keyed(docs), make, "doc_id long, text_hash long, size long, point long, prefix array<long>"), "ngram-prefixes")


def members(points: DataFrame, percent: int) -> DataFrame:
    """(point, size, asks, tokens, lows), stored: points that share shingles of their chosen prefixes, and the bands of those shingles.

    A point asks for the number of matches of the least work: entries met in the lists, and for each candidate that may be left, one of ``asks`` entries,
    a whole set."""
    least = F.ceil(F.col("size") * percent / 100)
    asks = F.greatest(F.lit(1), F.col("pos") + 1 - (F.col("size") - least)).cast("int")
    each = points.select("point", "size", F.posexplode("prefix").alias("pos", "token")).select("point", "size", asks.alias("asks"), "token")
    repeated = stored(each.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token"), "ngram-tokens")
    some = each.where(maybe_one_of(repeated, F.col("token")))
    lists = some.groupBy("token").agg(F.count("*").alias("n"), F.min(F.xxhash64("point")).alias("low")).where("n > 1")
    met = some.hint("merge").join(stored(lists, "ngram-lists"), "token")
    entries = [F.sum(F.when(F.col("asks") <= m, F.col("n") - 1).otherwise(0)).alias(f"entries{m}") for m in range(1, MOST + 1)]
    own = met.groupBy("point").agg(F.first("size").alias("size"), *entries, F.collect_list(F.struct("asks", "token", "low")).alias("shared"))
    most = F.least(F.lit(MOST), F.ceil(F.col("size") * percent / 100))
    work = [F.when(most >= m, F.struct((F.col(f"entries{m}") * (1 + F.col("size") / m)).alias("work"), F.lit(m).alias("asks"))) for m in range(1, MOST + 1)]
    chosen = own.select("point", "size", "shared", F.least(*work)["asks"].alias("asks"))
    kept = chosen.select("point", "size", "asks", F.expr("filter(shared, x -> x.asks <= asks)").alias("kept")).where("size(kept) > 0")
    return stored(kept.select("point", "size", "asks", F.col("kept.token").alias("tokens"), F.array_distinct("kept.low").alias("lows")), "ngram-members")


def with_partner(tokens: list[np.ndarray], asks: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """Which members share enough tokens with another one of a size that is near enough. Who has been found a partner does not search."""
    n = np.array(list(map(len, tokens)))
    owner = np.repeat(np.arange(len(tokens)), n)
    _, ids = np.unique(np.concatenate(tokens), return_inverse=True)
    begins = np.concatenate([[0], np.cumsum(n)])
    whose = owner[np.argsort(ids, kind="stable")]
    start = np.concatenate([[0], np.cumsum(np.bincount(ids))])
    found = np.zeros(len(tokens), dtype=bool)
    for p in range(len(tokens)):
        if found[p]:
            continue
        mine = ids[begins[p] : begins[p + 1]]
        a, m = start[mine], start[mine + 1] - start[mine]
        at = np.repeat(a - np.concatenate([[0], np.cumsum(m)[:-1]]), m) + np.arange(m.sum())
        others, matches = np.unique(whose[at], return_counts=True)
        near = (matches >= np.minimum(asks[p], asks[others])) & (100 * np.minimum(size[p], size[others]) >= percent * np.maximum(size[p], size[others])) & (others != p)
        if near.any():
            found[p] = True
            found[others[near]] = True
    return found


def asked_bands(joined: DataFrame, percent: int) -> DataFrame:
    """(band, point, size), stored, without repeats: points that have a possible partner in a band."""
    rows = joined.select(F.explode("lows").alias("band"), "point", "size", "asks", "tokens")
    weight = rows.groupBy("band").agg(F.sum(F.size("tokens")).alias("weight"), F.count("*").alias("n")).where("n > 1")
    met = rows.hint("merge").join(weight.select("band", "weight"), "band")
    dealt = met.select("band", F.explode(dealt_pairs(F.col("weight"), F.col("point"))).alias("block"), "point", "size", "asks", "tokens")
    target = arrow_schema("band long, point long, size long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches):
            tokens = [np.asarray(x, dtype=np.int64) for x in t.column("tokens").to_pylist()]
            found = with_partner(tokens, t.column("asks").to_numpy(), t.column("size").to_numpy(), percent)
            if found.any():
                kept = t.filter(pa.array(found))
                yield batch_of({c: kept.column(c).to_pylist() for c in target.names}, target)

    ship(joined.sparkSession)
    ordered = dealt.repartition("band", "block").sortWithinPartitions("band", "block")
    return stored(ordered.mapInArrow(run, "band long, point long, size long").distinct(), "ngram-asked")


def shingle_sets(rows: DataFrame, k: int) -> DataFrame:
    """(point, set) of rows with a point and a text."""

    def make(batch):
        return {"point": batch.column(0), "set": [shingles(t, k).tobytes() for t in bytes_of(batch, 1)]}

    return per_batch(rows.select("point", "text"), make, "point long, set binary")


def similar_groups(docs: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Groups of points (rows of ``simhash.MEMBERS``) chained by similar sets."""
    first = lambda c: F.first(c).alias(c)
    points = rows.where("size > 0").groupBy("point").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), first("size"), first("prefix"))
    points = stored(points, "ngram-points")
    found = asked_bands(members(points, percent), percent)
    marks = [F.count("*").alias("n"), F.min("point").alias("a"), F.sum(F.xxhash64("point") % (1 << 40)).alias("b"), F.sum("size").alias("weight")]
    chosen = found.groupBy("band").agg(*marks).where("n > 1").groupBy("n", "a", "b").agg(F.min("band").alias("band"), F.max("weight").alias("weight"))
    blocks = F.ceil(F.col("weight") / GROUP)
    places = found.join(stored(chosen.select("band", "weight"), "ngram-bands"), "band")
    asked = stored(places.select("band", F.pmod(F.xxhash64("point"), blocks).alias("block"), (blocks > 1).alias("many"), "point"), "ngram-places")
    wanted = points.select("point", "least.*").join(asked.select("point").distinct(), "point", "left_semi")
    wanted = stored(wanted, "ngram-wanted")
    maybe = maybe_one_of(stored(wanted.select("doc_id").distinct(), "ngram-wanted-ids"), F.col("doc_id"))
    sets = shingle_sets(keyed(docs).where(maybe).hint("merge").join(wanted, ["doc_id", "text_hash"]), k)
    return search_bands(asked, stored(sets, "ngram-sets"), percent / 100)


def join_similar(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: the size of its set, and the least doc_id reachable over pairs whose sets' intersection is at least
    ``percent`` of a hundred of their union.

    Null, empty and blank texts have no shingles and are linked with nothing; rows that repeat are linked; where an id repeats with different texts each has
    its own component; a null id never names one unless all of it are null; extra columns are not read; an empty table gives an empty one."""
    rows = prefixes(docs, sketch(docs, k), k, percent)
    prints = rows.where("size > 0").select("doc_id", F.col("point").alias("fp"), "size")
    found = simhash.with_components(prints, similar_groups(docs, rows, k, percent)).select("doc_id", "size", "component_id")
    alone = rows.where("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    known = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias(c)
    return found.unionByName(alone).select(known("doc_id"), F.col("size").alias("n_shingles"), known("component_id"))
