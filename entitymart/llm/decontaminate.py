"""Benchmark decontamination with one Aho-Corasick automaton over word sequences.

Test texts and documents are normalised alike: ASCII capitals become small, every other ASCII character that is
neither letter nor digit separates words. A test item gives all windows of ``WINDOW`` consecutive words (the whole item where
it is shorter). The automaton's alphabet is the test words' numbers, so a window costs ten nodes instead of one per
character and a match's position is a word's index, which maps back to character offsets of the original text.

Documents are read once, where they lie: no shuffle. Up to ``BLOCK_BYTES`` of test text are broadcast and make one automaton, which a worker
keeps from task to task. A larger benchmark is dealt to blocks of about that size, written to the shared folder; a task then holds up to
``CHUNK_BYTES`` of texts and takes them through one block's automaton after the other.
"""

from __future__ import annotations

import hashlib
import re
from collections import OrderedDict

from pyarrow.dataset import dataset
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from entitymart.llm.common import batch_of, field_of, packed, per_batch, shared_folder, ship, slices, unpacked

WINDOW = 10
#: Bytes of test text in one automaton (some 100 MB of nodes in a worker), automata that a worker keeps, and bytes of
#: texts that a task takes through several.
BLOCK_BYTES, KEEP, CHUNK_BYTES = 1_000_000, 2, 64 << 20

WORD = re.compile(rb"[0-9a-zA-Z\x80-\xff]+")
_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
NORMAL = bytes(b if b >= 0x80 or b in _KEEP else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def merged(ranges) -> list[tuple[int, int]]:
    """Half-open ranges, united where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


class Scan:
    """One block of items, ready to be found."""

    def __init__(self, items, window: int):
        import ahocorasick

        self.number: dict[bytes, int] = {}
        whose: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            seq = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            for i in range(max(1, len(seq) - window + 1)) if seq else ():
                whose.setdefault(tuple(seq[i : i + window]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for seq, ids in whose.items():
            self.automaton.add_word(seq, (len(seq), ids))
        if whose:
            self.automaton.make_automaton()
        self.any = bool(whose)

    def __call__(self, text: str | None) -> tuple[set[int], list[tuple[int, int]]]:
        get = self.number.get
        seq = tuple([get(w, 0) for w in words(text)]) if self.any else ()
        ids: set[int] = set()
        ranges = []
        if any(seq):
            for last, (size, whose) in self.automaton.iter(seq):
                ids |= whose
                ranges.append((last + 1 - size, last + 1))
        return ids, merged(ranges)


class Blocks:
    """The benchmark's blocks: broadcast items, or a folder with a part of Parquet files for each block."""

    _kept: OrderedDict = OrderedDict()

    def __init__(self, name: str, n: int, window: int, broadcast=None):
        self.name, self.n, self.window, self.broadcast = name, n, window, broadcast

    def items(self, block: int):
        if self.broadcast is not None:
            return self.broadcast.value
        fs, path = FileSystem.from_uri(f"{self.name}/block={block}")
        if fs.get_file_info(path).type == FileType.NotFound:  # no item fell to it
            return []
        rows = dataset(path, filesystem=fs, format="parquet").to_table(columns=["item_id", "text"])
        return zip(rows.column("item_id").to_pylist(), rows.column("text").to_pylist())

    def scan(self, block: int) -> Scan:
        """A block's automaton; a worker keeps the latest ``KEEP``."""
        key = (self.name, block, self.window)
        if key not in Blocks._kept:
            while len(Blocks._kept) >= KEEP:
                Blocks._kept.popitem(last=False)
            Blocks._kept[key] = Scan(self.items(block), self.window)
        Blocks._kept.move_to_end(key)
        return Blocks._kept[key]

    def find(self, texts: list[str | None]) -> list[tuple[set[int], list[tuple[int, int]]]]:
        """The items and the merged ranges of words found in each text."""
        out = [(set(), []) for _ in texts]
        for block in range(self.n):
            scan = self.scan(block)
            for (ids, ranges), text in zip(out, texts):
                more, hit = scan(text)
                ids |= more
                ranges += hit
        return [(ids, merged(ranges)) for ids, ranges in out]


def spans(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as character offsets of the original text."""
    if not ranges:
        return []
    data = text.encode()
    at = [m.span() for m in WORD.finditer(data)]
    return [{"first": len(data[: at[a][0]].decode()), "end": len(data[: at[b - 1][1]].decode())} for a, b in ranges]


def blocks_of(items: DataFrame, window: int, block_bytes: int) -> Blocks:
    spark = items.sparkSession
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    name, n = shared_folder(spark, "decontaminate-items"), max(1, -(-size // block_bytes))
    if n == 1:
        return Blocks(name, n, window, spark.sparkContext.broadcast([tuple(r) for r in items.collect()]))
    items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n))).repartition("block").write.partitionBy("block").parquet(name)
    return Blocks(name, n, window)


def chunks(batches, size: int):
    """Lists of batches of up to ``size`` bytes, or of one batch."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


SPANS = "array<struct<first:int,end:int>>"


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` columns plus items array<long>, spans array<struct<first,end>> (characters), n_words, n_hit.

    A null text has no words; an item without words, with null text or null id is never found; repeated rows are judged alike;
    an empty benchmark hits nothing. Columns of ``docs`` called like a result are replaced, all others pass through under any name.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    blocks = blocks_of(items, window, block_bytes)
    rows = docs.select(packed(docs, ("items", "spans", "n_words", "n_hit")).alias("row"))
    results = StructType.fromDDL(f"items array<long>, spans {SPANS}, n_words long, n_hit long")
    schema = StructType([rows.schema["row"], *results.fields])
    target = to_arrow_schema(schema)

    def run(batches):
        for some in chunks(slices(batches), CHUNK_BYTES if blocks.n > 1 else 0):
            texts = [field_of(batch, "row", "text").to_pylist() for batch in some]
            found = iter(blocks.find([t for ts in texts for t in ts]))
            for batch, ts in zip(some, texts):
                out = {"row": batch.column(0), "items": [], "spans": [], "n_words": [], "n_hit": []}
                for text, (ids, ranges) in zip(ts, found):
                    out["items"].append(sorted(ids))
                    out["spans"].append(spans(text or "", ranges))
                    out["n_words"].append(len(words(text)))
                    out["n_hit"].append(sum(b - a for a, b in ranges))
                yield batch_of(out, target)

    ship(docs.sparkSession)
    return rows.mapInArrow(run, schema).select(*unpacked(rows, "row"), "items", "spans", "n_words", "n_hit")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of the operator per document: counts, the found items and their hash."""

    def digest(batch):
        names = batch.schema.names
        items = batch.column(names.index("items")).to_pylist()
        shas = [hashlib.sha256(",".join(sorted(map(str, x))).encode()).hexdigest() for x in items]
        get = lambda c: batch.column(names.index(c))
        return {
            "doc_id": get("doc_id"), "n_words": get("n_words"), "n_hit": get("n_hit"), "n_items": list(map(len, items)),
            "items_sha256": shas, "contaminated": [n > 0 for n in get("n_hit").to_pylist()], "spans": get("spans"),
        }

    found = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark).drop("text")
    return per_batch(found, digest, f"doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans {SPANS}")
