"""Search by substring with exact matches first, pages, and ranked token search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entitymart.operators.bitfilter import may_be_in
from entitymart.sources.storage import stored

TOP = 100


def contains(column: str, term: str) -> Column:
    """SQL ``LIKE '%term%'`` without an escape character: ``%`` and ``_`` in the term are wildcards, a backslash is itself."""
    return F.col(column).like("%" + term.replace("\\", "\\\\") + "%")


def search(df: DataFrame, term: str, columns: list[str], exact_first: bool = False) -> DataFrame:
    """All rows with the term in any of ``columns``; an empty term finds nothing. Order: see ``ranked``."""
    hit = reduce(Column.__or__, [contains(c, term) for c in columns]) if term else F.lit(False)
    return df.where(hit).withColumn("exact", F.coalesce(F.col("name") == term, F.lit(False)) if exact_first else F.lit(False))


def ranked(found: DataFrame) -> DataFrame:
    return found.orderBy(F.col("exact").desc_nulls_last(), F.col("name").asc_nulls_last(), "id")


def search_artist(artist: DataFrame, term: str, top: int = TOP) -> DataFrame:
    return ranked(search(artist, term, ["name", "description"], exact_first=True)).limit(top).select("id", "name", "description", "artist_type", "birth_date", "death_date")


def search_album(album: DataFrame, term: str, top: int = TOP) -> DataFrame:
    return ranked(search(album, term, ["name"])).limit(top).select("id", "name", "release_date")


def search_track(track: DataFrame, term: str, top: int = TOP) -> DataFrame:
    return ranked(search(track, term, ["name"])).limit(top).select("id", "name", "duration_seconds")


def search_genre(genre: DataFrame, term: str, limit: int = 20, offset: int = 0) -> DataFrame:
    return ranked(search(genre, term, ["name"])).offset(offset).limit(limit).select("id", "name")


def search_all(t: dict[str, DataFrame], term: str) -> DataFrame:
    """Artists, albums and tracks with their kind."""
    found = {"artist": search_artist(t["artist"], term), "album": search_album(t["album"], term), "track": search_track(t["track"], term)}
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("kind"), "id", "name") for k, df in found.items()])


#: Characters that a term asks by, at most: few rows hold a run of as many by chance.
GRAM = 8


def literals(term: Column) -> Column:
    """The runs of a term between its wildcards."""
    return F.split(term, "[%_]")


def grams(text: Column, n: Column | int) -> Column:
    """The different runs of ``n`` characters."""
    return F.array_distinct(F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>")))


def runs_of(df: DataFrame, columns: list[str], sizes: list[int]) -> DataFrame:
    """(id, gram): the different runs of each of ``sizes`` characters in each of ``columns``. A run is taken where it first stands, so none are gathered to be compared."""
    texts = df.select("id", F.explode(F.array(*[F.col(c) for c in columns])).alias("text")).where("text is not null")
    sized = texts.select("id", "text", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")).alias("n")).where("length(text) >= n")
    last = F.when(F.col("n") == 0, 1).otherwise(F.length("text") - F.col("n") + 1)
    each = sized.select("id", "text", "n", F.explode(F.sequence(F.lit(1), last)).alias("i"))
    return each.withColumn("gram", F.substring("text", F.col("i"), F.col("n"))).where(F.instr("text", F.col("gram")) == F.col("i")).select("id", "gram")


def may_hold(df: DataFrame, asked: DataFrame, columns: list[str]) -> DataFrame:
    """(term, id): rows of ``df`` that hold the rarest run of a term, among the runs of ``GRAM`` characters of its longest literal, or of all its characters if it has fewer.
    A term of wildcards only asks by the empty run, which every row holds. Runs that no term asks for never leave the scan."""
    longest = F.array_max(F.transform(literals(F.col("term")), lambda x: F.struct(F.length(x).alias("n"), x.alias("text"))))
    size = F.least(F.lit(GRAM), longest["n"])
    asked = stored(asked.select("term", size.alias("size"), F.when(size == 0, F.array(F.lit(""))).otherwise(grams(longest["text"], size)).alias("grams")), "terms")
    sizes = [r[0] for r in asked.select("size").distinct().collect()]  # GRAM and one more at most
    wanted = asked.select("term", F.explode("grams").alias("gram"))
    each = runs_of(df, columns, sizes).where(may_be_in(wanted.select("gram"), F.col("gram")))
    index = stored(each.join(wanted.select("gram").distinct(), "gram", "left_semi"), "gram-index")
    common = wanted.join(index.groupBy("gram").agg(F.count("*").alias("n")), "gram", "left")
    rarest = common.groupBy("term").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("x")).where("x.n > 0").select("term", "x.gram")
    found = rarest.join(index, "gram").select("term", "id")
    return found.distinct() if len(columns) > 1 else found


def search_terms(df: DataFrame, terms: DataFrame, columns: list[str], exact_first: bool = False, top: int = TOP) -> DataFrame:
    """(term, place, id, name): for each different term the first ``top`` rows that ``search`` would give, for thousands of terms at once.

    Each term asks for the rows of its rarest run of characters (see ``may_hold``), and these are then tested by ``LIKE``. Each task keeps its first rows of a term before
    they travel. Null and empty terms find nothing."""
    found = may_hold(df, terms.toDF("term").where("term <> ''").distinct(), columns).join(df, "id")
    pattern = F.concat(F.lit("%"), F.replace("term", F.lit("\\"), F.lit("\\\\")), F.lit("%"))
    like = reduce(Column.__or__, [F.call_function("like", F.col(c), F.col("_pattern")) for c in columns])
    hits = found.withColumn("_pattern", pattern).where(like)
    exact = F.coalesce(F.col("name") == F.col("term"), F.lit(False)) if exact_first else F.lit(False)
    by = Window.partitionBy("term").orderBy(exact.desc(), F.col("name").asc_nulls_last(), "id")
    return hits.withColumn("place", F.row_number().over(by)).where(F.col("place") <= top).select("term", "place", "id", "name")


def word_counts(rows: DataFrame) -> DataFrame:
    """(token, id, length, tf) of rows (id, words), for each different word of a row. ``id`` tells rows apart, so words are sorted and counted within their row and none travel."""
    length = F.size("words").alias("length")
    words = rows.select("id", length, F.sort_array("words").alias("w"))
    differs = lambda i: F.coalesce(F.get("w", i - 1) != F.get("w", i - 2), F.lit(True))
    starts = words.withColumn("starts", F.when(F.col("length") > 0, F.filter(F.sequence(F.lit(1), F.col("length")), differs)))
    until = lambda j: F.coalesce(F.get("starts", j + 1), F.col("length") + 1)
    cells = F.transform("starts", lambda at, j: F.struct(F.get("w", at - 1).alias("token"), (until(j) - at).cast("long").alias("tf")))
    return starts.select("id", "length", F.inline(cells)).select("token", "id", "length", "tf")


def token_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """(token, id, length, tf): an inverted index of small-letter words, to be stored."""
    words = F.filter(F.split(F.lower(F.concat_ws(" ", *columns)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return word_counts(df.select("id", words.alias("words")))


def token_search(df: DataFrame, index: DataFrame, term: str, columns: list[str], top: int = TOP, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The best rows by BM25 over the term's words; rows whose name is the term come first."""
    docs = df.select(F.size(F.filter(F.split(F.lower(F.concat_ws(" ", *columns)), r"[^\p{L}\p{N}]+"), lambda w: w != "")).alias("length"))
    stats = docs.agg(F.count("*").alias("n"), F.avg("length").alias("mean"))
    wanted = df.sparkSession.range(1).select(F.explode(F.array_distinct(F.filter(F.split(F.lower(F.lit(term)), r"[^\p{L}\p{N}]+"), lambda w: w != ""))).alias("token"))
    hits = index.join(F.broadcast(wanted), "token")
    common = hits.groupBy("token").agg(F.count("*").alias("df"))
    scored = hits.join(F.broadcast(common), "token").crossJoin(F.broadcast(stats))  # words of the term; one row
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    scores = scored.groupBy("id").agg(F.round(F.sum(weight), 9).alias("score"))  # so that the order of addition decides no tie
    found = df.join(scores, "id").withColumn("exact", F.coalesce(F.col("name") == term, F.lit(False)))
    return found.orderBy(F.col("exact").desc(), F.col("score").desc(), F.col("name").asc_nulls_last(), "id").limit(top).select("id", "name", "score")
