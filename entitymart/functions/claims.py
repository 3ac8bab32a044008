"""Reading claims, labels, dates and durations out of decoded entities, with built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = "Q11574"
# The characters of the Unicode property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_DATE = r"^-?\d+-\d{1,2}-\d{1,2}$"


def claims_of(claims: Column, prop: str) -> Column:
    return F.coalesce(F.try_element_at(claims, F.lit(prop)), F.array())


def _value(claim: Column) -> Column:
    return F.when(claim["mainsnak"]["snaktype"] == "value", claim["mainsnak"]["datavalue"]["value"])


def values(claims: Column, prop: str) -> Column:
    """The values of a property as variants, null where a claim has none."""
    return F.transform(claims_of(claims, prop), _value)


def if_any(claims: Column, prop: str, then: Callable[[Column], Column], kind: str) -> Column:
    """``then(values)`` where a property has claims, else nothing of type ``kind``: most have none, and functions over arrays are interpreted."""
    none = F.array().cast(kind) if kind.startswith("array") else F.lit(None).cast(kind)
    found = F.try_element_at(claims, F.lit(prop))
    return F.when(found.isNull(), none).otherwise(then(F.transform(found, _value)))


def field(value: Column, name: str) -> Column:
    """A field of a value as text; null if the value is no object or lacks it."""
    return F.try_variant_get(value, f"$.{name}", "string")


def fields(value: Column, *names: str) -> Column:
    """Several fields of a value as a struct of texts, in one step: each look into a variant costs about as much as parsing a claim."""
    return F.try_variant_get(value, "$", f"struct<{','.join(f'{n}:string' for n in names)}>")


def targets(claims: Column, prop: str, empty: bool = False) -> Column:
    """Ids that the claims point to, in order, with repeats; empty ones only on request."""
    said = lambda x: x.isNotNull() if empty else (x.isNotNull() & (x != ""))
    return if_any(claims, prop, lambda vs: F.filter(F.transform(vs, lambda v: field(v, "id")), said), "array<string>")


def first(array: Column) -> Column:
    return F.try_element_at(array, F.lit(1))


def english(texts: Column) -> Column:
    return F.try_element_at(texts, F.lit("en"))["value"]


def iso_day(text: Column) -> Column:
    """A date of plain year-month-day text, null for anything else."""
    return F.when(text.rlike(_DATE), text.try_cast("date"))


def day_of(time: Column) -> Column:
    """The day of a time value such as ``+1926-05-26T00:00:00Z``."""
    return F.substring_index(F.when(time.startswith("+"), F.substring(time, 2, 1 << 20)).otherwise(time), "T", 1)


def first_parsed_date(claims: Column, prop: str) -> Column:
    """The first claim whose time is a full date."""
    times = lambda vs: F.transform(vs, lambda v: field(v, "time"))
    days = lambda vs: F.transform(F.transform(times(vs), day_of), iso_day)
    return if_any(claims, prop, lambda vs: first(F.filter(days(vs), lambda d: d.isNotNull())), "date")


def precise_date(claims: Column, prop: str) -> Column:
    """The first claim that has a time decides, read by its precision: a day, the first of a month or of a year; coarser ones are null."""
    with_time = lambda vs: F.filter(F.transform(vs, lambda v: fields(v, "time", "precision")), lambda x: x["time"].isNotNull())
    return if_any(claims, prop, lambda vs: first(F.transform(F.slice(with_time(vs), 1, 1), _by_precision)), "date")


def _by_precision(said: Column) -> Column:
    day = day_of(said["time"])
    precision = F.coalesce(said["precision"].try_cast("bigint"), F.lit(11))
    year = F.regexp_extract(day, r"^(\d+)", 1)
    return (
        F.when(precision.isin(6, 7, 8), F.lit(None).cast("date"))
        .when(precision == 9, F.when(year != "", iso_day(F.concat(year, F.lit("-01-01")))))
        .when(precision == 10, iso_day(F.replace(day, F.lit("-00"), F.lit("-01"))))
        .otherwise(iso_day(day))
    )


def duration_seconds(claims: Column, prop: str) -> Column:
    """The first whole amount without a unit or in seconds."""
    in_seconds = lambda x: x["unit"].isNull() | x["unit"].endswith(SECOND)
    amounts = lambda vs: F.transform(F.filter(F.transform(vs, lambda v: fields(v, "amount", "unit")), in_seconds), lambda x: F.ltrim(x["amount"], F.lit("+")))
    whole = lambda vs: F.transform(amounts(vs), lambda a: F.when(a.rlike(r"^-?\d+$"), a.try_cast("bigint")))
    return if_any(claims, prop, lambda vs: first(F.filter(whole(vs), lambda x: x.isNotNull())), "bigint")


def trimmed(text: Column) -> Column:
    """Without white space of any script at both ends. No pattern: it would be tried at every character of a line; nor is a line walked through that begins and
    ends as entities do."""
    return F.when(text.startswith("{") & (text.endswith("},") | text.endswith("}")), text).otherwise(F.btrim(text, F.lit(WHITE_SPACE)))


def page_title(sitelinks: Column, site: str = "enwiki") -> Column:
    """A page's title as a name: underscores are spaces, an empty one is null."""
    return F.nullif(trimmed(F.translate(F.try_element_at(sitelinks, F.lit(site))["title"], "_", " ")), F.lit(""))


def resolved_label(labels: Column, sitelinks: Column) -> Column:
    return F.coalesce(F.nullif(english(labels), F.lit("")), page_title(sitelinks))
