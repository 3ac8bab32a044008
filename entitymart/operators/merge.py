"""Insert-or-ignore, insert-or-replace and first-row dedupe by primary key.

The winner among rows of one key is the least by its other columns, nulls last, so results do not depend on order of arrival.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.operators.bitfilter import may_be_in


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The least row of each key, by partial and final aggregation: a repeated key never gathers in one task."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = F.struct(*[x for c in rest for x in (F.col(c).isNull().alias(f"null_{c}"), F.col(c))])
    return df.groupBy(*keys).agg(F.min(ranked).alias("row")).select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns])


def may_repeat(df: DataFrame, key: str) -> Column:
    """True where ``key`` is one that several rows of ``df`` have, and for a few others. Only keys are shuffled to tell."""
    return may_be_in(df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key), F.col(key))


def apart(df: DataFrame, repeats: Column, once: Callable[[DataFrame], DataFrame], several: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``once`` of the rows whose key comes once, which need not meet any others, and ``several`` of the rest."""
    return once(df.where(~repeats)).unionByName(several(df.where(repeats)))


def insert_or_ignore(existing: DataFrame | None, new: DataFrame, keys: list[str], different: bool = False) -> DataFrame:
    """Existing rows stay; of new keys one row is added. ``different``: no two new rows share a key."""
    fresh = new if different else one_per_key(new, keys)
    if existing is None:
        return fresh
    return existing.unionByName(fresh.join(existing, keys, "left_anti"), allowMissingColumns=True)


def insert_or_replace(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of ``new`` win where a key is new or known; columns that it lacks keep their values. One new row a key is taken for granted."""
    incoming = new.select(*keys, F.struct(*new.columns).alias("_new"))
    both = existing.join(incoming, keys, "full")
    pick = lambda c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
    return both.select(*[F.col(c) if c in keys else pick(c) if c in new.columns else F.col(c) for c in existing.columns])
