"""The pipeline over the smallest tables: each stage keeps what it should, and the last packs what is left."""

import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from entitymart.llm import packing, tokens
from entitymart.llm.common import stored, table
from tests.llm.test_operators import plain_hits, plain_lines, plain_near

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, DIR, "documents")
    bpe = Tokenizer.from_file(tokens.default_path())
    items = [tuple(r) for r in table(spark, DIR, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = stored(stage(spark, docs, DIR), name)
        if name != "packing":
            assert after.columns == docs.columns
        kept = {r["doc_id"]: r["text"] for r in after.collect()} if name != "packing" else None
        if name == "quality":
            labels = {r["doc_id"]: r["quality"] for r in table(spark, DIR, "labels").collect()}
            right = [(i in kept) == (labels[i] == 1) for i in before if i in labels]
            assert sum(right) >= 0.97 * len(right)
        if name == "line_dedup":
            want = plain_lines(before.items())
            assert kept == {i: t for i, t in want.items() if t or t == before[i]}
        if name == "near_dedup":
            assert set(kept) == plain_near(sorted(before.items()))
        if name == "decontamination":
            assert set(kept) == {i for i, t in before.items() if plain_hits(t, items)[1] == 0}
        if name == "packing":
            whole = {i: [*x.ids, packing.END] for i, x in zip(before, bpe.encode_batch([t or "" for t in before.values()], add_special_tokens=False))}
            want = {
                (i, k): (at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()))
                for i, ids in whole.items()
                for k, at in enumerate(range(0, len(ids), packing.SIZE))
                for part in [ids[at : at + packing.SIZE]]
            }
            got = after.collect()
            assert len(got) == len(want) and {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
            ends: dict[int, int] = {}
            for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
                assert r["offset"] == ends.get(r["sequence_id"], 0)
                ends[r["sequence_id"]] = r["offset"] + r["length"]
            assert max(ends.values()) <= packing.SIZE and len(ends) <= -(-sum(map(len, whole.values())) // packing.SIZE) + 1
        docs = after


def test_stages_on_awkward_rows(spark, tmp_path):
    """Nulls, repeated ids and rows, an extra column, and an empty table, through all stages."""
    text = "one two three four five six seven eight nine ten\nb\nc\nd"
    rows = [(1, text), (1, text), (1, "another text under the same id"), (None, text), (None, None), (2, None), (3, ""), (4, "x " * 3000)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _id int")
    path = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this"), (None, text)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    for table_rows in (docs, docs.where("false")):
        now = table_rows
        for name, stage in corpus_pipeline.STAGES:
            now = stored(stage(spark, now, path), name)
            if name != "packing":
                assert now.columns == docs.columns
        found = sorted((r["doc_id"] or 0, r["length"]) for r in now.collect())
        if table_rows is docs:
            # labels of one class reject nothing; repeated rows stay, as do null ids; a text without words is a duplicate of the least such id
            assert {i for i, _ in found} == {0, 1, 2, 4} and len([i for i, _ in found if i == 1]) == 3 and len([i for i, _ in found if i == 0]) == 2
        else:
            assert found == []
