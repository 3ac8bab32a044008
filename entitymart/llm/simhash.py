"""SimHash near-dedup: fingerprints, an exact search by vantage-point trees, and components of what is linked.

Documents of one fingerprint are one point, so copies never meet in pairs. A vantage-point tree over a bounded sample of points deals all
points to shards: at a node with vantage v and radius t, a point goes left if its distance to v is at most t, else right. A link of up to r bits can
only cross where, by the triangle inequality, its left end lies within r of the border; such points also visit the
right side, and visitors follow every branch that their ball of radius r can reach. Each shard goes on in the same way, down to leaves
that are compared whole. Every pair is so compared in at least one leaf: the search is exact.

A shard returns what it found as groups of points, not as pairs. Groups that share points are joined by contraction: in each round every point
goes to the least point (in an order by hash) that shares a group with it, and the groups go on with what is left, which shrinks by a
share a round, so a chain of any length takes a logarithmic number of rounds. A group of many points is dealt to salted parts, so
that no key gathers more than ``PART`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import arrow_schema, batch_of, per_batch, ship, stored

SEED, SHINGLE, BITS = 42, 3, 3
#: Points in the sample that shapes the tree (and never over 1 in THIN of all), points of a leaf, and members of a group's salted part.
SAMPLE, THIN, LEAF, PART = 1 << 17, 8, 256, 256
#: Points a shard is meant to hold: a share of all for each core twice over, within these bounds.
SMALL_SHARD, SHARD = 1 << 10, 1 << 14
#: Distances computed at once.
CELLS = 1 << 21

MEMBERS = "fp long, gid long, part int, parts int"


def shingles(text: str | None, k: int) -> list[bytes]:
    """ASCII capitals made small, words between ASCII white space, k words each; a shorter text is one shingle, an empty one has none."""
    words = (text or "").encode().lower().split()
    if len(words) <= k:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*[words[i:] for i in range(k)])))


def hashes(text: str | None, k: int) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles(text, k), repeat(SEED))), dtype=">u8").astype(np.uint64)


def fingerprint(h: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 15):
        ones += np.unpackbits(h[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * ones > len(h)).view(np.uint64)[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp), stored. Null and empty texts have fingerprint 0."""

    def make(batch):
        return {"doc_id": batch.column(0), "fp": [signed(fingerprint(hashes(t, k))) for t in batch.column(1).to_pylist()]}

    return stored(per_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, fp long"), "simhash-fingerprints")


def apart(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


@dataclass
class Node:
    """A split, or a shard of one or more blocks (several only where points lie too close together to be split)."""

    vantage: int = 0
    radius: int = 0
    left: Node | None = None
    right: Node | None = None
    shard: int = -1
    blocks: int = 1


def split(points: np.ndarray, seed: int) -> tuple[int, int, np.ndarray] | None:
    """A vantage point, the radius that best halves ``points``, and their distances; nothing if all lie on a few radii."""
    rng = np.random.default_rng(seed)
    for v in points[rng.integers(len(points), size=4)]:
        d = apart(points, v)
        t = int(np.median(d))
        best = min((abs(2 * int((d <= x).sum()) - len(d)), x) for x in (t - 1, t))
        if best[0] <= 0.8 * len(d):
            return int(v), best[1], d
    return None


def tree(sample: np.ndarray, scale: float, shard: int = SHARD) -> tuple[Node, int]:
    """``scale``: points of the corpus for each of the sample. Returns the root and the number of shards."""
    count = 0

    def grow(points: np.ndarray, depth: int) -> Node:
        nonlocal count
        expected = len(points) * scale
        if expected > shard and len(points) > 32 and depth < 40:
            if got := split(points, depth):
                v, t, d = got
                return Node(v, t, grow(points[d <= t], depth + 1), grow(points[d > t], depth + 1))
        blocks = max(1, int(np.ceil(expected / (2 * shard))))
        node = Node(shard=count, blocks=blocks)
        count += blocks
        return node

    return grow(sample, 0), count


def route(node: Node, points: np.ndarray, home: np.ndarray, visit: np.ndarray, r: int):
    """Shards with the indexes of their own points and their visitors."""
    if not len(home) and not len(visit):
        return
    if node.left is None:
        yield from blocks_of(node, points, home, visit)
        return
    v = np.uint64(node.vantage)
    d, e = apart(points[home], v).astype(int), apart(points[visit], v).astype(int)
    t = node.radius
    yield from route(node.left, points, home[d <= t], visit[e <= t + r], r)
    yield from route(node.right, points, home[d > t], np.concatenate([visit[e > t - r], home[(d <= t) & (d > t - r)]]), r)


def blocks_of(node: Node, points: np.ndarray, home: np.ndarray, visit: np.ndarray):
    """A shard's points dealt to its blocks; each block is also visited by the points of those before it."""
    block = ((points[home] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(node.blocks) if node.blocks > 1 else np.zeros(len(home), dtype=int)
    for b in range(node.blocks):
        yield node.shard + b, home[block == b], np.concatenate([visit, home[block < b]])


def search(points: np.ndarray, n_home: int, r: int, leaf: int = LEAF) -> np.ndarray:
    """Group labels of ``points``, the first ``n_home`` of which are at home, the others visiting: two get the same label if a chain
    of links of up to r bits joins them, each with a point at home."""
    left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]

    def link(a: np.ndarray, b: np.ndarray) -> None:
        left.append(a)
        right.append(b)

    def compare(home: np.ndarray, other: np.ndarray) -> None:
        step = max(1, CELLS // max(1, len(home)))
        for at in range(0, len(other), step):
            some = other[at : at + step]
            i, j = np.nonzero(apart(points[some][:, None], points[home][None, :]) <= r)
            link(some[i], home[j])

    def dense(home: np.ndarray) -> np.ndarray:
        """Points too close to be split: reached points leave the rest, so near-copies cost little. One point of each group stays."""
        heads, rest = [], home
        while len(rest):
            heads.append(rest[0])
            front, rest = [rest[0]], rest[1:]
            while front and len(rest):
                p = front.pop()
                near = apart(points[rest], points[p]) <= r
                if near.any():
                    link(np.full(int(near.sum()), p), rest[near])
                    front += rest[near].tolist()
                    rest = rest[~near]
        return np.array(heads)

    def near_any(home: np.ndarray, visit: np.ndarray) -> None:
        """Visitors of a dense set need one link to each of its groups, found among all members."""
        inner = components(len(points), np.concatenate(left), np.concatenate(right))[home]
        step = max(1, CELLS // len(home))
        for at in range(0, len(visit), step):
            some = visit[at : at + step]
            i, j = np.nonzero(apart(points[some][:, None], points[home][None, :]) <= r)
            _, once = np.unique(i * (len(points) + 1) + inner[j], return_index=True)
            link(some[i[once]], home[j[once]])

    def go(home: np.ndarray, visit: np.ndarray, depth: int) -> None:
        if not len(home):
            return
        got = split(points[home], depth) if len(home) > leaf and depth < 64 else None
        if got is None:
            if len(home) > leaf:
                dense(home)
                near_any(home, visit)
            else:
                compare(home, home)
                compare(home, visit)
            return
        v, t, d = got
        d, e = d.astype(int), apart(points[visit], np.uint64(v)).astype(int)
        go(home[d <= t], visit[e <= t + r], depth + 1)
        go(home[d > t], np.concatenate([visit[e > t - r], home[(d <= t) & (d > t - r)]]), depth + 1)

    go(np.arange(n_home), np.arange(n_home, len(points)), 0)
    return components(len(points), np.concatenate(left), np.concatenate(right))


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index of each one's component under the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def member_rows(shard: int, points: np.ndarray, label: np.ndarray) -> dict:
    """Rows of ``MEMBERS`` for all groups of two or more different points."""
    points, label = points[order := np.argsort(label, kind="stable")], label[order]
    first = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
    size = np.diff(np.concatenate([first, [len(label)]]))
    at = np.arange(len(label)) - np.repeat(first, size)
    many = np.repeat(size, size) > 1
    parts = -(-np.repeat(size, size) // PART)
    return {"fp": points[many].view(np.int64), "gid": shard << 32 | label[many], "part": (at // PART)[many], "parts": parts[many]}


def vantage_links(points: DataFrame, r: int = BITS, shard: int | None = None) -> DataFrame:
    """``points``: distinct fp, stored. Returns their groups as rows of ``MEMBERS``; a point may be in groups of several shards."""
    spark = points.sparkSession
    n = points.count()
    shard = shard or min(SHARD, max(SMALL_SHARD, -(-n // (2 * spark.sparkContext.defaultParallelism))))
    share = F.pmod(F.xxhash64("fp"), F.lit(1 << 32)) < int(min(1 / THIN, SAMPLE / max(1, n)) * (1 << 32))
    sample = np.array([r_[0] for r_ in points.where(share).collect()], dtype=np.int64).view(np.uint64)
    root, shards = tree(sample, n / max(1, len(sample)), shard)
    shared = spark.sparkContext.broadcast(root)

    def deal(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(False).view(np.uint64)
            for s, home, visit in route(shared.value, fps, np.arange(len(fps)), np.zeros(0, dtype=np.int64), r):
                at = np.concatenate([home, visit])
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(np.full(len(at), s), pa.int32()), "fp": fps[at].view(np.int64), "visits": np.arange(len(at)) >= len(home),
                })

    ship(spark)
    dealt = points.select("fp").mapInArrow(deal, "shard int, fp long, visits boolean")
    target = arrow_schema(MEMBERS)

    def work(table: pa.Table) -> pa.Table:
        visits = table.column("visits").to_numpy()
        fps = table.column("fp").to_numpy().view(np.uint64)
        fps = np.concatenate([fps[~visits], fps[visits]])
        rows = member_rows(int(table.column("shard")[0].as_py()), fps, search(fps, int((~visits).sum()), r))
        return pa.Table.from_batches([batch_of(rows, target)])

    return dealt.repartition(max(1, shards), "shard").groupBy("shard").applyInArrow(work, MEMBERS)


def contracted(members: DataFrame) -> DataFrame:
    """(node, root): the one node that stands for all that groups join to ``node``. ``members``: rows of ``MEMBERS``; a point's node is its
    XXH64, which is another one for every other 64-bit number."""
    now, steps = members.select(F.xxhash64("fp").alias("node"), "gid", "part", "parts"), []
    while True:
        now = stored(now, "simhash-members")
        groups = now.groupBy("gid").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.max("parts").alias("parts")).where("low < high")
        parts = groups.select("gid", "low", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        told = now.join(stored(parts, "simhash-groups"), ["gid", "part"])
        step = stored(told.groupBy("node").agg(F.min("low").alias("to")), "simhash-step")
        if step.isEmpty():
            break
        steps.append(step)
        moved = told.select("node", "gid", "part", "parts").join(step, "node")
        now = moved.groupBy(F.col("to").alias("node"), "gid").agg(F.min("part").alias("part"), F.max("parts").alias("parts"))
    found = steps.pop() if steps else step
    while steps:  # from the last round, the smallest, back to the first
        last = found.select(F.col("node").alias("to"), F.col("to").alias("end"))
        found = stored(steps.pop().join(last, "to", "left").select("node", F.coalesce("end", "to").alias("to")), "simhash-roots")
    return found.select("node", F.col("to").alias("root"))


def join_groups(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(fp, label) of all points in groups: the least label reachable. ``members``: rows of ``MEMBERS``; ``labels``: (fp, label)."""
    joined = stored(contracted(members).join(labels.withColumn("node", F.xxhash64("fp")), "node").select("fp", "root", "label"), "simhash-joined")
    least = joined.groupBy("root").agg(F.min("label").alias("label"))
    return joined.select("fp", "root").join(least, "root").select("fp", "label")


def with_components(prints: DataFrame, members: DataFrame | None = None, r: int = BITS) -> DataFrame:
    """``prints``: stored (doc_id, fp). Adds component_id, the least doc_id reachable over links. Groups given in ``members`` stand in
    place of the tree's; fp may then be any key of the points."""
    points = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("label"), F.count("*").alias("n")), "simhash-points")
    found = vantage_links(points, r) if members is None else members
    joined = join_groups(stored(found, "simhash-found"), points.select("fp", "label"))
    # Only points of several documents or with links need a look-up; all others are their own component.
    known = points.where("n > 1").join(joined.withColumnRenamed("label", "low"), "fp", "full").select("fp", F.coalesce("low", "label").alias("component_id"))
    return prints.join(stored(known, "simhash-components"), "fp", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, r: int = BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row. Nulls and empty texts have fingerprint 0 and are linked like any other; a null
    id never names a component; rows that repeat are linked; extra columns are not read; an empty table gives an empty result."""
    found = with_components(fingerprints(docs, k), r=r)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
