"""Best-fit packing of token sequences by exact complements.

A plan needs lengths only, and there are at most ``SIZE`` of them: Spark counts the pieces of each length, and the plan is made
on that histogram, whose size does not depend on the corpus. Sums of one, two and three lengths are indexed; for each length, longest first,
the combinations indexed under its gap are taken as often as the counts allow; what remains is filled
best fit, the longest length that still fits first. The plan is a list of patterns (lengths, how often), each of which
uses up a length or ends a combination, so it stays short.

Each piece then finds its place by itself. While pieces are written, each task numbers its pieces of one length; the numbers of earlier tasks'
pieces are added from one slim row for each task and length, so numbering costs no sort and no length gathers in a task. A piece's number falls
into an interval of one pattern's slot.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entitymart.llm.common import arrow_schema, batch_of, per_batch, ship, slices, stored
from entitymart.llm.tokens import default_path, encoder

#: Tokens of a sequence, and the id that ends a document.
SIZE, END = 2048, 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def pieces(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, end: int = END) -> DataFrame:
    """A row for each piece of each document, in place; ``nth`` numbers a task's pieces of one length from 0. A null text has the end id only."""
    tokenizer = tokenizer or default_path()
    target = arrow_schema(PIECES)
    tail = np.array([end], dtype="<u4").tobytes()

    def run(batches):
        met = [0] * (size + 1)
        for batch in slices(batches):
            rows = []
            for doc, task, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), encoder(tokenizer).encode(batch.column(1).to_pylist())):
                data = ids + tail
                for k, at in enumerate(range(0, len(data), 4 * size)):
                    part = data[at : at + 4 * size]
                    n = len(part) // 4
                    rows.append((doc, k, at // 4, n, zlib.crc32(part), task, met[n]))
                    met[n] += 1
            yield batch_of(dict(zip(target.names, map(list, zip(*rows)))), target)

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("task")).mapInArrow(run, PIECES)


@dataclass
class Plan:
    """Intervals of numbers of a length, as ``length << 44 | first number``, with the first sequence and the offset they go to."""

    keys: np.ndarray
    sequences: np.ndarray
    offsets: np.ndarray
    used: int


class Sums:
    """Which of the lengths at hand make up a sum: one, two (by the lesser of each pair) or three (by the greatest of each triple)."""

    def __init__(self, present: np.ndarray):
        self.present = present
        n = len(present)
        self.pairs = [np.flatnonzero(present[: s // 2 + 1] & present[s - np.arange(s // 2 + 1)]) for s in range(n)]
        paired = np.array([len(p) > 0 for p in self.pairs])
        self.triples = [np.flatnonzero(present[: s + 1] & paired[s - np.arange(s + 1)] & (3 * np.arange(s + 1) >= s)) for s in range(n)]

    def of(self, gap: int, most: int, left: np.ndarray):
        """Combinations of lengths of at most ``most`` that fill ``gap``: the single, then pairs, then triples, the longest first. Lengths of which
        none is ``left`` are skipped, so what comes is nearly all of use."""
        if gap <= most and left[gap]:
            yield (gap,)
        yield from self.two(gap, most, left)
        top = self.triples[gap]
        top = top[(top <= most) & (left[top] > 0) & sums_of_two(left > 0)[gap - top]]
        for a in top[::-1].tolist():
            for b, c in self.two(gap - a, a, left):
                yield a, b, c

    def two(self, gap: int, most: int, left: np.ndarray):
        low = self.pairs[gap]
        for b in low[(gap - low <= most) & (left[low] > 0) & (left[gap - low] > 0)].tolist():
            yield gap - b, b


def sums_of_two(present: np.ndarray) -> np.ndarray:
    """Which numbers are a sum of two of those present."""
    n = len(present)
    wave = np.fft.rfft(present.astype(float), 2 * n)
    return np.fft.irfft(wave * wave, 2 * n)[:n] > 0.5


def patterns(counts: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    left = np.zeros(size + 1, dtype=np.int64)
    for n, c in counts.items():
        left[n] += c
    out: list[tuple[list[int], int]] = []

    def take(parts: list[int]) -> None:
        """As often as the counts allow."""
        need = np.bincount(parts, minlength=size + 1)
        at = np.flatnonzero(need)
        times = int((left[at] // need[at]).min())
        if times:
            left[at] -= times * need[at]
            out.append((parts, times))

    take([size])
    sums = Sums(left > 0)
    for n in range(size - 1, 0, -1):
        for parts in sums.of(size - n, n, left) if left[n] else ():
            if not left[n]:
                break
            if all(left[x] for x in parts):
                take([n, *parts])
    # What is left, best fit: the longest that fits, again and again.
    while left.any():
        n = int(np.flatnonzero(left)[-1])
        need, gap = [n], size - n
        spare = left.copy()
        spare[n] -= 1
        while gap:
            fits = np.flatnonzero(spare[: gap + 1])
            if not len(fits):
                break
            x = int(fits[-1])
            k = min(int(spare[x]), gap // x)
            need += [x] * k
            spare[x] -= k
            gap -= k * x
        take(need)
    return out


def plan(counts: dict[int, int], size: int = SIZE) -> Plan:
    taken: dict[int, int] = {}
    keys, sequences, offsets, sequence = [], [], [], 0
    for parts, times in patterns(counts, size):
        at = 0
        for n in parts:
            keys.append(n << 44 | taken.get(n, 0))
            sequences.append(sequence)
            offsets.append(at)
            taken[n] = taken.get(n, 0) + times
            at += n
        sequence += times
    order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
    return Plan(*(np.array(x, dtype=np.int64)[order] for x in (keys, sequences, offsets)), sequence)


def number(rows: DataFrame) -> DataFrame:
    """``nth`` over all tasks: pieces of one length are numbered from 0, task after task."""
    counts = rows.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = counts.select("length", "task", (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    return rows.join(stored(before, "packing-before").hint("merge"), ["length", "task"]).withColumn("nth", F.col("nth") + F.col("before"))


def pack(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Rows that repeat a doc_id are packed each; a null id stays null; an empty table gives an empty result; other columns are not read.
    """
    rows = stored(pieces(docs, size, tokenizer), "packing-pieces")
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most ``size`` rows
    shared = docs.sparkSession.sparkContext.broadcast(plan(counts, size))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    target = arrow_schema(schema)

    def make(batch):
        p = shared.value
        columns = dict(zip(batch.schema.names, batch.columns))
        nth = columns["nth"].to_numpy(False)
        key = columns["length"].to_numpy(False) << 44 | nth
        at = np.searchsorted(p.keys, key, side="right") - 1
        first = p.keys[at] & (1 << 44) - 1
        return columns | {"sequence_id": p.sequences[at] + nth - first, "offset": p.offsets[at]}

    return per_batch(number(rows).select("doc_id", "piece", "start", "length", "ids_crc32", "nth"), make, schema)
