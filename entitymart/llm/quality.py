"""Document quality by Bradley-Terry pairwise ranking.

Every labelled document of label 1 is preferred to every one of label 0. The strength of a document is linear in its text features: hashed
words, pairs of words and runs of three bytes, and beside them a few shares of the whole text (capitals, signs, repeated words and lines).
A preference's probability is the logistic of the feature difference, and the weights minimise the logistic loss over pairs. The decision
threshold is a score quantile: as large a share of the labelled documents falls below it as bears label 0. Scores are mapped so that
this threshold is ``CUT``.

The weights are fitted on ``PER_CLASS`` labelled documents of each class at most, chosen by a hash of the id, outside the held-out fold; only
their features reach the driver. The quantile is taken over the scores of all labelled documents outside that fold: a narrow map gives their raw
scores, slim rows meet the labels, and histograms of at most ``BINS`` counts find the two scores that the threshold lies between.
Scoring is a narrow map over whole texts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, StructField, StructType

from entitymart.llm.common import field_of, fold, maybe_one_of, packed, per_batch, stored, unpacked

#: Labelled documents of each class in the fit, parts they are dealt to, pairs drawn at a step, rounds over all parts, and the score at the threshold.
PER_CLASS, PARTS, PAIRS, ROUNDS, CUT = 2000, 10, 5000, 15, 0.7
#: Buckets of hashed words and pairs of words, and as many again of byte runs.
BUCKETS = 1 << 16
#: Counts of a histogram of raw scores.
BINS = 4096

#: Kinds of bytes: letters and all bytes of other scripts, capitals, digits, white space, sentence marks, other signs.
_KIND = bytes(
    76 if b >= 0x80 or 97 <= b <= 122 else 85 if 65 <= b <= 90 else 68 if 48 <= b <= 57 else 83 if b in b" \t\n\r\v\f" else 80 if b in b".,;:'\"?-()" else 89
    for b in range(256)
)
N_SHARES = 14


def shares(text: str | None) -> list[float]:
    text = text or ""
    data = text.encode("utf-8", "replace")
    kind = data.translate(_KIND)
    n = max(1, len(data))
    words = text.split()
    m = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    odd = sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,;:'\"?-()")
    shout = sum(c for w, c in counts.items() if w.isupper() and len(w) > 1)
    top = max(counts.values(), default=0)
    return [
        math.log1p(len(words)) / 10,
        *(kind.count(k) / n for k in (b"U", b"D", b"S", b"P", b"Y")),
        min(1.0, data.count(b"|") / m),
        min(1.0, data.count(b"!") / m),
        odd / m,
        shout / m,
        # shares that shrink with length in any text, set against what a text of this length usually has
        1 - len(counts) / m - 0.1 * math.log1p(m / 50),
        top / m * min(1.0, m / 20),
        1 - len(set(lines)) / max(1, len(lines)),
        min(2.0, sum(map(len, counts)) / max(1, len(counts)) / 10),
    ]


def hashed(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's words, pairs of words and byte runs, with values whose squares sum to 1 for each kind."""
    data = (text or "").encode("utf-8", "replace").lower()
    words = np.array(list(map(zlib.crc32, data.split())), dtype=np.uint32)
    pairs = (words[:-1] * np.uint32(0x9E3779B1) ^ words[1:]) * np.uint32(0x85EBCA77)
    codes = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    runs = (codes[:-2] << np.uint32(16) | codes[1:-1] << np.uint32(8) | codes[2:]) * np.uint32(0x9E3779B1) if len(codes) > 2 else codes[:0]
    at, values = [], []
    for first, some in ((0, np.concatenate([words, pairs])), (BUCKETS, runs)):
        bucket, n = np.unique(some >> np.uint32(16), return_counts=True)
        value = np.log1p(n).astype(np.float32)
        at.append(bucket.astype(np.int32) + np.int32(first))
        values.append(value / max(1e-6, float(np.sqrt((value * value).sum()))))
    return np.concatenate(at), np.concatenate(values).astype(np.float32)


@dataclass
class Features:
    """Many documents' features: a row of shares for each, and their buckets and values, one document after the other."""

    shares: np.ndarray
    at: np.ndarray
    values: np.ndarray
    stops: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None]) -> Features:
        x = np.array([shares(t) for t in texts]).reshape(-1, N_SHARES)
        found = list(map(hashed, texts))
        return cls.joined(x, [a for a, _ in found], [v for _, v in found])

    @classmethod
    def joined(cls, x: np.ndarray, at: list[np.ndarray], values: list[np.ndarray]) -> Features:
        empty = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.float32)]
        return cls(x, np.concatenate(at or empty[0]), np.concatenate(values or empty[1]), np.cumsum([0, *map(len, at)]))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """Each document's sum over its buckets, whatever other documents there are."""
        total, some = np.zeros(len(self.stops) - 1), self.stops[1:] > self.stops[:-1]
        if some.any():
            total[some] = np.add.reduceat((self.values * weights[self.at]).astype(np.float64), self.stops[:-1][some])
        return total

    def gathered(self, of_document: np.ndarray) -> np.ndarray:
        """Each bucket's sum of a number of each document."""
        return np.bincount(self.at, weights=self.values * np.repeat(of_document, np.diff(self.stops)), minlength=2 * BUCKETS)


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    table: np.ndarray
    threshold: float
    slope: float

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8)

    def raw(self, x: Features) -> np.ndarray:
        return self.scaled(x.shares) @ self.weights + x.dot(self.table)

    def score(self, x: Features) -> np.ndarray:
        z = np.clip((self.raw(x) - self.threshold) * self.slope, -30, 30) + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-z))


#: Without pairs to learn from no document is rejected: all get the threshold's score.
BLANK = Model(np.zeros(N_SHARES), np.ones(N_SHARES), np.zeros(N_SHARES), np.zeros(2 * BUCKETS, dtype=np.float32), 0.0, 0.0)


def learn(x: np.ndarray, at: list[np.ndarray], values: list[np.ndarray], label: np.ndarray, pairs: int = PAIRS, rounds: int = ROUNDS) -> Model:
    """Weights and slope; the threshold is still 0. Each step draws pairs within one of ``PARTS`` parts of the documents, and is scaled
    by each weight's past gradients."""
    if len(set(label.tolist())) < 2:
        return BLANK
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-3, np.zeros(N_SHARES), np.zeros(2 * BUCKETS), 0.0, 1.0)
    rng = np.random.default_rng(7)
    # both classes are dealt evenly
    parts = [p for p in (np.concatenate([rng.permutation(np.flatnonzero(label == q))[i::PARTS] for q in (0, 1)]) for i in range(PARTS)) if len(set(label[p].tolist())) == 2]
    dealt = [(label[p], Features.joined(model.scaled(x[p]), [at[i] for i in p], [values[i] for i in p])) for p in parts]
    past = [np.full(N_SHARES, 1e-6), np.full(2 * BUCKETS, 1e-6)]
    for label_, some in dealt * rounds:
        raw = some.shares @ model.weights + some.dot(model.table)
        good, bad = np.flatnonzero(label_ == 1), np.flatnonzero(label_ == 0)
        g, b = good[rng.integers(len(good), size=pairs)], bad[rng.integers(len(bad), size=pairs)]
        miss = 1 / (1 + np.exp(np.clip(raw[g] - raw[b], -30, 30)))
        push = (np.bincount(g, miss, len(label_)) - np.bincount(b, miss, len(label_))) / pairs
        for weights, gradient, sums in ((model.weights, some.shares.T @ push, past[0]), (model.table, some.gathered(push), past[1])):
            gradient -= 1e-4 * weights
            sums += gradient * gradient
            weights += 0.1 * gradient / np.sqrt(sums)
    raw = [(label_, some.shares @ model.weights + some.dot(model.table)) for label_, some in dealt]
    means = [float(np.concatenate([r[label_ == q] for label_, r in raw]).mean()) for q in (0, 1)]
    return replace(model, table=model.table.astype(np.float32), slope=6 / max(1e-6, means[1] - means[0]))


def cut_after(scores: DataFrame, n: int) -> float:
    """The middle between the ``n``-th least and the next ``raw`` of ``scores``, a stored table. Each histogram covers the bin of the one
    before that holds the ``n``-th, from its least to its greatest value, until these are the same."""
    low, high = scores.agg(F.min("raw"), F.max("raw")).first()
    below = 0
    while low < high:
        where = F.least(F.floor((F.col("raw") - low) / (high - low) * BINS), F.lit(BINS - 1)).alias("bin")
        bins = scores.where(F.col("raw").between(low, high)).groupBy(where).agg(F.count("*"), F.min("raw"), F.max("raw")).collect()
        for _, count, low, high in sorted(bins):
            if below + count >= n:
                break
            below += count
    upto, after = scores.agg(F.count(F.when(F.col("raw") <= low, 1)), F.min(F.when(F.col("raw") > low, F.col("raw")))).first()
    return low if upto > n or after is None else (low + after) / 2


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """``labels``: doc_id and quality 0 or 1; rows with other or null values, or of held-out ids, teach nothing. Repeated rows of a label
    count once; a document with both labels is in both classes. No label of one class: a model that rejects nothing. Ids of both tables meet as whole numbers
    where both are, else as text."""
    whole = all(isinstance(x.schema["doc_id"].dataType, IntegralType) for x in (docs, labels))
    docs, labels = (x.withColumn("doc_id", F.col("doc_id").cast("long" if whole else "string")) for x in (docs.select("doc_id", "text"), labels.select("doc_id", "quality")))
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 2)
    ).distinct()
    seen = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    if len(seen) < 2:
        return BLANK
    part = {q: int(min(1.0, per_class / n) * (1 << 32)) for q, n in seen.items()}
    limit = F.when(F.col("quality") == 1, F.lit(part[1])).otherwise(F.lit(part[0]))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < limit)  # at most about 2 * per_class short rows
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")

    def make(batch):
        found = list(map(hashed, texts := batch.column(1).to_pylist()))
        return {"quality": batch.column(0), "x": list(map(shares, texts)), "at": [a.tobytes() for a, _ in found], "value": [v.tobytes() for _, v in found]}

    rows = per_batch(sample, make, "quality int, x array<double>, at binary, value binary").toArrow()
    buckets = [[np.frombuffer(b, dtype=t) for b in rows.column(c).to_pylist()] for c, t in (("at", np.int32), ("value", np.float32))]
    model = learn(np.array(rows.column("x").to_pylist()).reshape(-1, N_SHARES), *buckets, rows.column("quality").to_numpy())
    if model is BLANK:
        return BLANK
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batch):
        return {"doc_id": batch.column(0), "raw": shared.value.raw(Features.of(batch.column(1).to_pylist()))}

    asked = docs.select("doc_id", "text").where(maybe_one_of(stored(known.select("doc_id").distinct(), "quality-ids"), F.col("doc_id")))
    raw = per_batch(asked, rate, StructType([docs.schema["doc_id"], StructField("raw", DoubleType())]))
    scores = stored(raw.join(known, "doc_id").select("quality", "raw"), "quality-scores")
    return replace(model, threshold=cut_after(scores, scores.where("quality = 0").count()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs``, under any name, plus held_out and quality_score, which replace columns so called. A null text counts as
    empty; repeated rows repeat; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(packed(docs, ("quality_score", "held_out")).alias("row"), F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"))

    def make(batch):
        found = shared.value.score(Features.of(field_of(batch, "row", "text").to_pylist()))
        return {"row": batch.column(0), "held_out": batch.column(1), "quality_score": found}

    schema = StructType([rows.schema["row"], rows.schema["held_out"], StructField("quality_score", DoubleType())])
    return per_batch(rows, make, schema).select(*unpacked(rows, "row"), "held_out", "quality_score")
