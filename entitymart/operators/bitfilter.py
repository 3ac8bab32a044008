"""A bounded filter of bits that tells rows that surely do not join, before they travel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.sources.storage import stored

#: Bits for each key, and of a filter at most (8 MB); with more keys more rows pass, never fewer.
BITS_A_KEY, MOST_BITS = 8, 1 << 26


def may_be_in(keys: DataFrame, column: Column) -> Column:
    """False where ``column`` is null or surely none of ``keys`` (one column). The filter is a scalar subquery, so the scan tests rows as it reads them."""
    keys = stored(keys.toDF("key").where("key is not null").distinct(), "filter-keys")
    n, bits = keys.count(), 64
    while bits < min(MOST_BITS, n * BITS_A_KEY):
        bits *= 2
    slot = lambda x: F.pmod(F.xxhash64(x), F.lit(bits))
    word, bit = lambda x: F.shiftright(slot(x), 6).cast("int"), lambda x: F.pmod(slot(x), F.lit(64)).cast("int")
    set_words = keys.groupBy(word(F.col("key")).alias("i")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col("key")))).alias("w"))
    whole = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("i")).join(set_words, "i", "left").select("i", F.coalesce("w", F.lit(0).cast("long")).alias("w"))
    field = whole.agg(F.array_sort(F.collect_list(F.struct("i", "w"))).alias("cells")).select(F.transform("cells", lambda c: c["w"])).scalar()
    return F.coalesce(F.getbit(F.get(field, word(column)), bit(column)) == 1, F.lit(False))
