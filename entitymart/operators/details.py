"""One-hop details of many ids at once, pages per group, and cards. ``hits`` is a frame with a column id, such as a search result.

A detail row's ``place`` numbers the rows of one id from 1, in the order in which they are to be shown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN, MORE = "(unknown)", "..."

#: Rows of one id between two of its borders, on average.
RUN = 1 << 20

#: Rows of one kind that a card shows; ``...`` follows where there are more.
SHOWN = 1000


def at_or_below(borders: Column, value: Column) -> Column:
    """How many of the sorted ``borders`` are at or below ``value``, by halving; null without borders."""
    size = F.array_size(borders)
    halvings = F.sequence(F.lit(1), F.ceil(F.log2(size + 1)).cast("int"))

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        below = F.get(borders, middle) <= value
        low, high = F.when(below, middle + 1).otherwise(span["low"]), F.when(below, span["high"]).otherwise(middle)
        done = span["low"] >= span["high"]
        return F.when(done, span).otherwise(F.struct(low.alias("low"), high.alias("high")))

    return F.aggregate(halvings, F.struct(F.lit(0).alias("low"), size.alias("high")), halve)["low"]


def ranked(rows: DataFrame, own: str, order: list[str], run: int = RUN) -> DataFrame:
    """``rows`` with their ``place`` among the rows of one ``own``, by ``order`` (nulls last), whose last column tells rows of one ``own`` apart.

    No task sorts all rows of a large ``own``: rows picked by a hash, one in ``run``, are borders, what lies between two of them is numbered by itself, and
    the counts of what lies before are added. Broadcast are a border for each ``run`` rows and a count for each border, so some 10 MB for 10^11 rows."""
    at = F.struct(*[c for name in order for c in (F.col(name).isNull().alias(f"no_{name}"), F.col(name))])
    marked = rows.withColumn("_at", at)
    picked = marked.where(F.pmod(F.xxhash64(own, order[-1]), F.lit(run)) == 0)
    borders = F.broadcast(picked.groupBy(own).agg(F.array_sort(F.collect_set("_at")).alias("_borders")))
    part = at_or_below(F.col("_borders"), F.col("_at"))
    sizes = marked.join(borders, own).groupBy(own, part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(own).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.broadcast(sizes.select(own, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    dealt = marked.join(borders, own, "left").withColumn("_part", F.coalesce(part, F.lit(0))).join(before, [own, "_part"], "left")
    within = F.row_number().over(Window.partitionBy(own, "_part").orderBy("_at"))
    return dealt.withColumn("place", within + F.coalesce("_before", F.lit(0))).select(*rows.columns, "place")


def first_of(rows: DataFrame, own: str, order: list[str], first: int) -> DataFrame:
    """The rows whose place is ``first`` or less. Each task sends at most ``first`` rows of an id."""
    by = Window.partitionBy(own).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return rows.withColumn("place", F.row_number().over(by).cast("long")).where(F.col("place") <= first)


def of(
    hits: DataFrame, junction: DataFrame, own: str, other: str, table: DataFrame | None, columns: list[str], order: list[str] | None = None,
    first: int | None = None, run: int = RUN,
) -> DataFrame:
    """Rows of ``table`` that the junction ties to the hits, with their place by ``order`` (nulls last, then ids); without a table the junction's own rows.
    ``first``: only so many of each hit."""
    tied = junction.join(hits.select(F.col("id").alias(own)).distinct(), own)
    if table is not None:
        kept = [c for c in columns if c in table.columns and c != other]
        tied = tied.join(table.select(F.col("id").alias(other), *kept), other)
    by = [*(order or []), other]
    placed = ranked(tied, own, by, run) if first is None else first_of(tied, own, by, first)
    return placed.select(own, other, *[c for c in columns if c != other], "place")


def artist_genres(hits: DataFrame, t: dict[str, DataFrame], first: int | None = None) -> DataFrame:
    return of(hits, t["artist_genre"], "artist_id", "genre_id", t["genre"], ["name"], ["name"], first)


def artist_albums(hits: DataFrame, t: dict[str, DataFrame], first: int | None = None) -> DataFrame:
    return of(hits, t["album_artist"], "artist_id", "album_id", t["album"], ["name", "release_date", "role"], ["name"], first)


def artist_instruments(hits: DataFrame, t: dict[str, DataFrame], first: int | None = None) -> DataFrame:
    return of(hits, t["artist_instrument"], "artist_id", "instrument_id", None, [], None, first)


def album_artists(hits: DataFrame, t: dict[str, DataFrame], first: int | None = None) -> DataFrame:
    return of(hits, t["album_artist"], "album_id", "artist_id", t["artist"], ["name", "role"], ["name"], first)


def album_genres(hits: DataFrame, t: dict[str, DataFrame], first: int | None = None) -> DataFrame:
    return of(hits, t["album_genre"], "album_id", "genre_id", t["genre"], ["name"], ["name"], first)


def album_tracks(hits: DataFrame, t: dict[str, DataFrame], first: int | None = None) -> DataFrame:
    return of(hits, t["track_album"], "album_id", "track_id", t["track"], ["name", "duration_seconds", "track_number"], ["track_number"], first)


def genre_artists(hits: DataFrame, t: dict[str, DataFrame], limit: int = 20, offset: int = 0) -> DataFrame:
    """A page of artists by name for each genre. Each task keeps its first rows of a genre before the shuffle."""
    return of(hits, t["artist_genre"], "genre_id", "artist_id", t["artist"], ["name"], ["name"], offset + limit).where(F.col("place") > offset)


def attach(hits: DataFrame, rows: DataFrame, own: str, name: str, text: Column, separator: str, shown: int = SHOWN) -> DataFrame:
    """``hits`` with the texts of each one's rows as one text, in the order of their places. ``rows`` are the first ``shown`` of a hit, and one more where there is one."""
    cells = F.array_sort(F.collect_list(F.struct("place", F.when(F.col("place") > shown, MORE).otherwise(text).alias("text"))))
    lists = rows.groupBy(F.col(own).alias("id")).agg(F.array_join(F.transform(cells, lambda c: c["text"]), separator).alias(name))
    return hits.join(lists, "id", "left").withColumn(name, F.coalesce(name, F.lit("")))


def with_role(name: Column) -> Column:
    return F.concat(name, F.lit(" ("), "role", F.lit(")"))


def artist_cards(hits: DataFrame, t: dict[str, DataFrame], shown: int = SHOWN) -> DataFrame:
    """Genres, albums with the artist's role, and instruments, ``shown`` of each at most."""
    cards = attach(hits, artist_genres(hits, t, shown + 1), "artist_id", "genres", F.col("name"), ", ", shown)
    cards = attach(cards, artist_albums(hits, t, shown + 1), "artist_id", "albums", with_role(F.col("name")), "; ", shown)
    return attach(cards, artist_instruments(hits, t, shown + 1), "artist_id", "instruments", F.col("instrument_id"), ", ", shown)


def clock(seconds: Column) -> Column:
    return F.format_string("%d:%02d", (seconds / 60).cast("int"), seconds % 60)


def album_cards(hits: DataFrame, t: dict[str, DataFrame], shown: int = SHOWN) -> DataFrame:
    """Artists with roles, genres, and tracks as ``02. Name (3:05)`` or ``  - Name`` where number or duration is unknown, ``shown`` of each at most."""
    cards = attach(hits, album_artists(hits, t, shown + 1), "album_id", "artists", with_role(F.coalesce("name", F.lit(UNKNOWN))), "; ", shown)
    cards = attach(cards, album_genres(hits, t, shown + 1), "album_id", "genres", F.col("name"), ", ", shown)
    number = F.when(F.col("track_number").isNotNull(), F.format_string("%02d.", "track_number")).otherwise("  -")
    lasts = F.when(F.col("duration_seconds").isNotNull(), F.concat(F.lit(" ("), clock(F.col("duration_seconds")), F.lit(")"))).otherwise("")
    return attach(cards, album_tracks(hits, t, shown + 1), "album_id", "tracks", F.concat(number, F.lit(" "), "name", lasts), "; ", shown)


def genre_cards(hits: DataFrame, t: dict[str, DataFrame], limit: int = 20) -> DataFrame:
    return attach(hits, genre_artists(hits, t, limit), "genre_id", "artists", F.coalesce("name", F.lit(UNKNOWN)), "; ", limit)
