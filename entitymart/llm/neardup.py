"""Near-duplicate documents at a Jaccard similarity of five-word shingles, one document of each group kept.

A 64-bit fingerprint separates texts of similarity 0.8 by some ten bits, and at that radius the triangle bounds of a vantage-point tree
prune nothing. So the fingerprints and their tree (``simhash``) give what lies within three bits as candidates, and candidates further apart
come from min-wise hashes: rows of ``ROWS`` minima in ``BANDS`` bands, which miss a pair at 0.8 once in 3,000 times. Fingerprints count repeated
shingles, so close ones may belong to different sets: all candidates, of a group of the tree, of a fingerprint or of a band, are compared by their
whole shingle sets. Different sets are the points, so copies never meet in pairs.

Groups of the tree and texts of one fingerprint are bands like the others; bands with the same candidates are searched once. A band's
candidates are searched from one text to the next: what is reached leaves the rest, so a large group of near copies costs few searches and
returns members, not pairs.

A band whose candidates have over ``GROUP`` shingles is dealt to blocks, each of which returns its groups and its stars: a text and those that the search reached
from it. Only the heads of stars meet across blocks. Jaccard distance is a metric, so two stars can hold a link only if their heads are no
further apart than the limit and both stars' reaches; stars that the heads' own links have already joined need nothing more, and the members
of the others, few among near copies, are compared. No link is lost, and a large group of near copies sends each text once and its heads once more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.llm import simhash
from entitymart.llm.common import arrow_schema, batch_of, maybe_one_of, packed, per_batch, ship, stored, unpacked

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 5
#: Shingles whose sets are compared in one task (8 bytes each).
GROUP = 1 << 20
KEY = "doc_id long, text_hash long"
_MULTIPLY = np.random.default_rng(11).integers(0, 1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(h: np.ndarray) -> np.ndarray:
    """A key for each band of a shingle set."""
    least = np.full(BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(h), 2048):
        least = np.minimum(least, np.multiply.outer(_MULTIPLY, h[at : at + 2048]).min(axis=1))
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        key = (key ^ row) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text): an id may repeat with another text, so documents are known by both. A null id is the greatest here."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_hash, fp, same, size, bands), stored; ``same`` is a hash of the shingle set. Texts without words have no bands."""

    def make(batch):
        fps, same, size, keys = [], [], [], []
        for text in batch.column(2).to_pylist():
            h = simhash.hashes(text, k)
            fps.append(simhash.signed(simhash.fingerprint(h)))
            h = np.unique(h)
            same.append(simhash.signed(simhash.xxhash.xxh64_intdigest(h.tobytes())))
            size.append(len(h))
            keys.append(bands(h).tolist() if len(h) else [])
        return {"doc_id": batch.column(0), "text_hash": batch.column(1), "fp": fps, "same": same, "size": size, "bands": keys}

    return stored(per_batch(keyed(docs), make, f"{KEY}, fp long, same long, size long, bands array<long>"), "neardup-sketches")


def point() -> Column:
    """A text's point: its fingerprint and its shingle set."""
    return F.xxhash64("fp", "same")


def shingle_sets(rows: DataFrame, k: int) -> DataFrame:
    """(point, set) of rows with a point and a text, with the sorted shingle hashes as bytes."""

    def make(batch):
        return {"point": batch.column(0), "set": [np.unique(simhash.hashes(t, k)).tobytes() for t in batch.column(1).to_pylist()]}

    return per_batch(rows.select("point", "text"), make, "point long, set binary")


class Common:
    """How many shingles a text shares with others, by an inverted index of those still ``open``."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array(list(map(len, sets)))
        _, self.ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.begins = np.concatenate([[0], np.cumsum(self.size)])
        self.owner = np.repeat(np.arange(len(sets)), self.size)
        self.index(np.ones(len(sets), dtype=bool))

    def index(self, open_: np.ndarray) -> None:
        inside = open_[self.owner]
        ids, owner = self.ids[inside], self.owner[inside]
        self.whose = owner[np.argsort(ids, kind="stable")]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=int(self.ids.max()) + 1))])
        self.n_open = int(open_.sum())

    def similarity(self, p: int) -> np.ndarray:
        """Jaccard similarity of text ``p`` to every indexed text."""
        mine = self.ids[self.begins[p] : self.begins[p + 1]]
        a, n = self.start[mine], self.start[mine + 1] - self.start[mine]
        at = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(self.whose[at], minlength=len(self.size))
        return common / (self.size[p] + self.size - common)


def linked(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group labels of texts whose shingle sets are chained by at least ``similarity``; and for each text the head of its star and its
    distance to it. A head is a text of its own star."""
    n = len(sets)
    common = Common(sets)
    label, star, far, rest = np.arange(n), np.arange(n), np.zeros(n), np.ones(n, dtype=bool)
    for head in range(n):
        if not rest[head]:
            continue
        rest[head] = False
        front = [head]
        while front and (left := int(rest.sum())):
            if 2 * left <= common.n_open:
                common.index(rest)
            p = front.pop()
            found = common.similarity(p)
            near = np.flatnonzero(rest & (found >= similarity))
            if len(near):
                label[near], star[near], far[near], rest[near] = label[head], p, 1 - found[near], False
                star[p], far[p] = p, 0.0
                front += near.tolist()
    return label, star, far


def heads_joined(sets: list[np.ndarray], group: np.ndarray, block: np.ndarray, reach: np.ndarray, similarity: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Labels of heads that share a ``group`` or are linked, and the pairs of other blocks' stars that may hold a link between groups not
    joined here."""
    common, limit = Common(sets), 1 - similarity
    _, first, of = np.unique(group, return_index=True, return_inverse=True)
    left, right, maybe = [np.arange(len(sets))], [first[of]], []
    for i in range(len(sets)):
        away = 1 - common.similarity(i)
        other = (block != block[i]) & (np.arange(len(sets)) > i)
        near = np.flatnonzero(other & (away <= limit + 1e-12))
        left.append(np.full(len(near), i))
        right.append(near)
        maybe.append(np.flatnonzero(other & (away > limit + 1e-12) & (away <= limit + reach[i] + reach + 1e-9)))
    label = simhash.components(len(sets), np.concatenate(left), np.concatenate(right))
    return label, [(i, j) for i, some in enumerate(maybe) for j in some.tolist() if label[i] != label[j]]


def groups(batches):
    """Tables of the rows that agree in the first two columns; rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = batch.column(0).to_numpy(False), batch.column(1).to_numpy(False)
        cuts = [0, *(np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1).tolist(), len(a)]
        for first, end in zip(cuts, cuts[1:]):
            if held and (held[0].column(0)[0], held[0].column(1)[0]) != (batch.column(0)[first], batch.column(1)[first]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(first, end - first))
    if held:
        yield pa.Table.from_batches(held)


def names(t: pa.Table, n: int, what: str) -> np.ndarray:
    """n numbers that no other table of ``groups`` has, and no shard of the tree."""
    first = int(simhash.xxhash.xxh64_intdigest(f"{what} {t.column(0)[0]} {t.column(1)[0]}")) & 0x3FFFFFFFFFFFFFFF
    return -((first + np.arange(n)) % (1 << 62)) - 1


def by_group(rows: DataFrame, sets: DataFrame, keys: tuple[str, str], work, schema: str) -> DataFrame:
    """``work(table, sets)`` for the rows that agree in ``keys``, with their shingle sets (point, set; rows may repeat); it gives tables of columns by name."""
    target = arrow_schema(schema)
    carried = [c for c in rows.columns if c not in keys]

    def run(batches):
        for t in groups(batches):
            for out in work(t, [np.frombuffer(x, dtype=np.uint64) for x in t.column("set").to_pylist()]):
                n = len(next(iter(out.values())))
                if n:
                    yield batch_of({c: out.get(c, pa.nulls(n)) for c in target.names}, target)

    ship(rows.sparkSession)
    dealt = rows.hint("merge").join(sets.dropDuplicates(["point"]), "point").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.select(*keys, *carried, "set").mapInArrow(run, schema)


def of_few(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """The sets that ``rows`` may ask for."""
    return sets.where(maybe_one_of(stored(rows.select("point").distinct(), "neardup-points"), F.col("point")))


def dealt_pairs(n: Column, key: Column) -> Column:
    """The pairs of blocks, of ``GROUP`` shingles each, that a member of a group of ``n`` goes to: all that hold its own block."""
    blocks = F.ceil(n / GROUP)
    own = F.pmod(F.xxhash64(key), blocks)
    other = F.sequence(F.lit(0).cast("long"), blocks - 1)
    return F.when(blocks == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.filter(other, lambda x: x != own), lambda x: F.least(x, own) * blocks + F.greatest(x, own))
    )


STARS = f"{simhash.MEMBERS}, star long, block long, far double, size long, head boolean, home long"
_MEMBERS = ["fp", "gid", "part", "parts"]


def search_bands(asked: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Rows of ``MEMBERS`` for the texts of ``asked`` (band, block, many, point) that are chained within a band. ``sets``: (point, set)."""

    def in_block(t, own):
        points = t.column("point").to_numpy().view(np.uint64)
        label, star, far = linked(own, similarity)
        ids = names(t, len(points), "block")
        out = simhash.member_rows(0, points, label)
        yield out | {"gid": ids[out["gid"]]}
        if t.column("many")[0].as_py():
            yield {
                "fp": points.view(np.int64), "gid": ids[label], "star": ids[star], "block": t.column("block").to_numpy(), "far": far,
                "size": list(map(len, own)), "head": star == np.arange(len(star)), "home": t.column("band").to_numpy(),
            }

    first = stored(by_group(asked, sets, ("band", "block"), in_block, STARS), "neardup-blocks")
    found = first.where("star is null").select(*_MEMBERS)
    stars = first.where("star is not null").select(F.col("fp").alias("point"), "gid", "star", "block", "far", "size", "head", F.col("home").alias("band"))
    if stars.isEmpty():
        return found

    reach = stars.groupBy("band", "star").agg(F.max("far").alias("reach"), F.sum("size").alias("weight"))
    heads = stars.where("head").drop("far", "head").join(reach, ["band", "star"])
    n = heads.groupBy("band").agg(F.sum("size").alias("n"))
    pairs = F.explode(dealt_pairs(F.col("n"), F.col("star"))).alias("pair")
    met = stored(heads.join(n, "band").select("band", "star", "gid", "block", "point", "reach", "weight", pairs), "neardup-met")

    def of_heads(t, own):
        points, star, size = t.column("point").to_numpy().view(np.uint64), t.column("star").to_numpy(), t.column("weight").to_numpy()
        label, maybe = heads_joined(own, t.column("gid").to_numpy(), t.column("block").to_numpy(), t.column("reach").to_numpy(), similarity)
        out = simhash.member_rows(0, points, label)
        yield out | {"gid": names(t, len(points), "heads")[out["gid"]]}
        pairs = [(i, j) if size[i] >= size[j] else (j, i) for i, j in maybe]
        yield {"home": [star[i] for i, _ in pairs], "star": [star[j] for _, j in pairs]}

    second = stored(by_group(met, of_few(sets, met), ("band", "pair"), of_heads, STARS), "neardup-heads")
    found = found.unionByName(second.where("home is null").select(*_MEMBERS))
    open_ = stored(second.where("home is not null").select("home", "star").distinct(), "neardup-open")
    if open_.isEmpty():
        return found

    visits = open_.join(stars.select("star", "point", "size"), "star").select("home", "point", "size").distinct()
    chunks = visits.groupBy("home").agg(F.ceil(F.sum("size") / GROUP).alias("chunks"))
    visitors = visits.join(chunks, "home").select("home", F.pmod(F.xxhash64("point"), F.col("chunks")).alias("chunk"), "point")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
    own_rows = stars.select(F.col("star").alias("home"), "point").join(chunks, "home").select("home", every, "point")

    def across(t, own):
        points = t.column("point").to_numpy().view(np.uint64)
        out = simhash.member_rows(0, points, linked(own, similarity)[0])
        yield out | {"gid": names(t, len(points), "across")[out["gid"]]}

    both = stored(visitors.unionByName(own_rows).distinct(), "neardup-visits")
    return found.unionByName(stored(by_group(both, of_few(sets, both), ("home", "chunk"), across, simhash.MEMBERS), "neardup-across"))


def similar_groups(docs: DataFrame, rows: DataFrame, k: int, similarity: float) -> DataFrame:
    """Groups of points (rows of ``simhash.MEMBERS``, with ``point`` as fp) that shingle sets of at least ``similarity`` join."""
    # One document stands for all of the same shingles.
    first = lambda c: F.first(c).alias(c)
    least = rows.where(F.size("bands") > 0).groupBy("fp", "same").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), first("size"), first("bands"))
    texts = stored(least.select("fp", "same", "size", "least.*", "bands"), "neardup-texts")
    near = stored(simhash.vantage_links(stored(texts.select("fp").distinct(), "neardup-fps")), "neardup-near")
    key = ["doc_id", "text_hash"]
    columns = ["fp", "same", "size", *key]
    each = texts.select(*columns, F.explode(F.concat("bands", F.array(F.xxhash64(F.lit("fp"), "fp")))).alias("band"))
    each = each.unionByName(texts.join(near.select("fp", "gid"), "fp").select(*columns, F.xxhash64(F.lit("tree"), "gid").alias("band")))
    marks = [F.count("*").alias("n"), F.min("same").alias("a"), F.sum(F.xxhash64("fp", "same") % (1 << 40)).alias("b"), F.sum("size").alias("weight")]
    chosen = each.groupBy("band").agg(*marks).where("n > 1").groupBy("n", "a", "b").agg(F.min("band").alias("band"), F.max("weight").alias("weight"))
    blocks = F.ceil(F.col("weight") / GROUP)
    places = each.join(stored(chosen.select("band", "weight"), "neardup-bands"), "band").select(
        "band", F.pmod(F.xxhash64("same"), blocks).alias("block"), (blocks > 1).alias("many"), point().alias("point"), *key
    )
    asked = stored(places, "neardup-asked")
    wanted = stored(asked.select("point", *key).distinct(), "neardup-wanted")
    # Only texts that may be wanted travel; a merge join at every size, since neither side has a bound.
    maybe = maybe_one_of(stored(wanted.select("doc_id").distinct(), "neardup-wanted-ids"), F.col("doc_id"))
    sets = stored(shingle_sets(keyed(docs).where(maybe).join(wanted.hint("merge"), key), k), "neardup-sets")
    return search_bands(asked.drop(*key), sets, similarity)


def keep_one(docs: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Rows of ``docs`` whose doc_id is the least of their group of near duplicates.

    Texts without words are one group. Rows with a null id stay, and link others; rows that repeat a kept id and its group stay, and where an
    id repeats with different texts each goes or stays with its own group; extra columns pass through.
    """
    rows = sketches(docs, k)
    found = simhash.with_components(rows.select("doc_id", "text_hash", point().alias("fp")), similar_groups(docs, rows, k, similarity))
    dropped = stored(found.where("doc_id <> component_id").select("doc_id", "text_hash").distinct(), "neardup-dropped")
    # Documents whose id is surely none of the dropped do not travel.
    own = docs.select(packed(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    maybe = maybe_one_of(stored(dropped.select("doc_id").distinct(), "neardup-dropped-ids"), F.col("doc_id"))
    kept = own.where(maybe).join(dropped, ["doc_id", "text_hash"], "left_anti").unionByName(own.where(~maybe).select("doc_id", "text_hash", "row"), allowMissingColumns=False)
    return kept.select(*unpacked(own, "row"))
