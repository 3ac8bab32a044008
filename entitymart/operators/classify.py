"""Role classification by an ordered rule profile: higher-order functions only, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitymart.functions.claims import first, targets
from entitymart.profiles import MUSIC, Profile


def verdict(role: str, found: Column, reason: Callable[[Column], Column]) -> Column:
    return F.when(found.isNotNull(), F.struct(F.lit(role).alias("role"), reason(found).alias("reason")))


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def by_rules(found: dict[str, Column], profile: Profile) -> list[Column]:
    named = lambda r: first(F.filter(found[r.prop], lambda x: x.isin(*r.ids)))
    return [verdict(r.role, named(r), lambda x, r=r: F.concat(F.lit(f"{r.prop}:"), x)) for r in profile.rules]


def classify(claims: Column, profile: Profile = MUSIC, found: dict[str, Column] | None = None) -> Column:
    """struct(role, reason) of the first rule that matches, else null.

    A rule names the first target in its list, as ``P106:Q639669``. The last rule names all catch-all properties that are present as keys,
    whatever their claims hold, sorted, as ``PROP:P136,P175``. Targets of a property are read once for all rules on it, or given in ``found``.
    """
    present = F.array_sort(F.array_intersect(F.map_keys(claims), F.array(*map(F.lit, profile.catch_all))))
    last = verdict(profile.catch_all_role, F.when(F.size(present) >= 1, present), lambda x: F.concat(F.lit("PROP:"), F.array_join(x, ",")))
    props = list(dict.fromkeys(r.prop for r in profile.rules))

    def bind(left: list[str], found: dict[str, Column]) -> Column:
        if not left:
            return F.coalesce(*by_rules(found, profile), last)
        return bound(targets(claims, left[0], empty=True), lambda x: bind(left[1:], found | {left[0]: x}))

    return bind([p for p in props if p not in (found or {})], found or {})


def _named(claims: Column, prop: str, ids: list[str]) -> Column:
    return F.transform(F.filter(targets(claims, prop), lambda x: x.isin(*ids)), lambda x: F.concat(F.lit(f"{prop} "), x))


def branches(claims: Column, profile: Profile = MUSIC) -> Column:
    """Every way in which an entity belongs, whichever rule decided: ``P106 Q639669`` for each id of a rule that a claim names, ``P136`` for
    each catch-all property that is present; in order, without repeats."""
    ids: dict[str, list[str]] = {}
    for r in profile.rules:
        ids.setdefault(r.prop, []).extend(r.ids)
    named = [_named(claims, prop, of) for prop, of in ids.items()]
    present = F.array_intersect(F.map_keys(claims), F.array(*map(F.lit, profile.catch_all)))
    return F.array_sort(F.array_distinct(F.concat(*named, F.coalesce(present, F.array().cast("array<string>")))))
