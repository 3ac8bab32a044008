"""Language identification with error-correcting output codes.

Each language gets a codeword; for every bit a binary classifier over hashed character 1- to 3-grams tells the languages
whose codeword has a one there from the others. A text's margins on all bits are decoded to the codeword of the least
loss, bits weighted by how well they separate the training languages; a narrow win is flagged as ambiguous.

The fit is a Spark job: n-gram counts per language over a bounded sample (``PER_LANGUAGE`` rows of each, chosen by a hash of the
id), added up by language and n-gram. The driver gets that table only, ``BUCKETS`` numbers a language. Of more than ``LANGUAGES`` values of lang, as
a dirty column has, the most frequent are learnt. Prediction is a narrow map.
"""

from __future__ import annotations

import functools
import itertools
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import fold, per_batch, ship, slices

#: Hashed n-grams, languages in the fit, rows of each, longest code, and the probability under which a win is ambiguous.
BUCKETS, LANGUAGES, PER_LANGUAGE, MAX_BITS, SURE = 1 << 14, 256, 3000, 63, 0.6
#: Characters worked on at once.
CHUNK = 400_000


@functools.cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str) -> np.ndarray:
    """Buckets of all n-grams of letters, small, any other characters read as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = letters()[codes]
    codes = np.where(inside, codes, 32)
    codes = codes[inside | np.concatenate(([True], inside[:-1]))] if len(codes) else codes
    a = codes * np.uint32(0x9E3779B1)
    b = (a[:-1] ^ a[1:] >> np.uint32(5)) * np.uint32(0x85EBCA77)
    c = (b[:-1] ^ a[2:] >> np.uint32(7)) * np.uint32(0xC2B2AE3D)
    return np.concatenate([x >> np.uint32(32 - BUCKETS.bit_length() + 1) for x in (a, b, c)])


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1: all splits of up to seven languages, else the best of some seeded random codes."""
    if n <= 7:
        splits = [(1, *s) for s in itertools.product((1, -1), repeat=n - 1)][1:] if n > 1 else []
        return np.array(splits, dtype=float).T.reshape(n, -1)
    best = None
    for seed in range(50):
        code = np.random.default_rng(seed).choice((-1.0, 1.0), (n, MAX_BITS))
        apart = ((MAX_BITS - code @ code.T) / 2)[np.tril_indices(n, -1)].min()
        if best is None or apart > best[0]:
            best = apart, code
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), dtype=np.float32))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trust: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def margins(self, text: str) -> np.ndarray:
        ids = grams(text)
        total = np.zeros(self.weights.shape[1])
        for at in range(0, len(ids), CHUNK):
            total += np.bincount(ids[at : at + CHUNK], minlength=BUCKETS) @ self.weights
        return total / max(1, len(ids)) * self.scale

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return "und", 0.0, True
        losses = np.logaddexp(0, -self.code * self.margins(text)) @ self.trust
        odds = np.exp(losses.min() - losses)
        best = int(losses.argmin())
        return self.languages[best], float(odds[best] / odds.sum()), bool(odds[best] / odds.sum() < SURE)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> Model:
    """Learns from rows outside the held-out fold that have a lang and a letter. No such row: an empty model, which says ``und``. Values of lang
    beyond the ``languages`` most frequent (ties: the least) are not learnt."""
    rows = docs.select("doc_id", "text", "lang").where((fold(F.col("doc_id")) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    seen = {r[0]: r[1] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()}
    if not seen:
        return Model([])
    most = {k: int(min(1.0, per_language / n) * (1 << 32)) for k, n in seen.items()}
    limit = F.create_map(*[x for k, n in most.items() for x in (F.lit(k), F.lit(n))])
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < limit[F.col("lang")])
    ship(docs.sparkSession)

    def count(batches):
        import pyarrow as pa

        total: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if has_letter(text):
                    got = np.bincount(grams(text), minlength=BUCKETS)
                    total[lang] = total.get(lang, 0) + got
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "gram": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})

    counts = sample.select("text", "lang").mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = counts.groupBy("lang").agg(F.collect_list(F.struct("gram", "n")).alias("x")).collect()
    learnt = sorted(r["lang"] for r in got)
    p = np.full((len(learnt), BUCKETS), 0.5)
    for r in got:
        for gram, n in r["x"]:
            p[learnt.index(r["lang"]), gram] += n
    p /= p.sum(axis=1, keepdims=True)
    code = codewords(len(learnt))
    if code.shape[1] == 0:
        return Model(learnt, code.reshape(len(learnt), 0))
    ones, zeros = (np.stack([p[code[:, b] == s].mean(axis=0) for b in range(code.shape[1])]) for s in (1, -1))
    weights = np.log(ones / zeros).T
    expected = p @ weights  # margins that the languages themselves would get
    middle = np.array([(expected[code[:, b] == 1, b].min() + expected[code[:, b] == -1, b].max()) / 2 for b in range(code.shape[1])])
    weights, expected = weights - middle, expected - middle
    apart = np.maximum((code * expected).min(axis=0), 1e-6)
    return Model(learnt, code, weights.astype(np.float32), 3 / apart, apart / apart.sum() * min(8, len(apart)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row; null or letterless text: ``und``, 0. Repeated rows repeat."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch):
        got = list(map(shared.value.predict, batch.column(2).to_pylist()))
        names = ("lang_pred", "score", "ambiguous")
        return {"doc_id": batch.column(0), "held_out": batch.column(1)} | dict(zip(names, map(list, zip(*got))))

    rows = docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "text")
    return per_batch(rows, make, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
