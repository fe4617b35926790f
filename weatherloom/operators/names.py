"""Matching names that are spelled differently, such as country names of two sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A name may differ by one edit, and by one more for each further so many letters.
LETTERS_PER_EDIT = 5
#: Letters at either end of a name that make a block of their own.
END_LETTERS = 3


def tokens(name: Column) -> Column:
    """The different words of a name in their order by letters: lower-cased, without marks, digits or what stands in brackets."""
    bare = F.regexp_replace(F.lower(name), r"[\[(][^\])}]*[\])}]", " ")
    words = F.split(F.trim(F.regexp_replace(bare, r"[^\p{L}]+", " ")), " ")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: w != "")))


def _blocks(words: Column, joined: Column) -> Column:
    """What two names must share one of to be compared: a word, or the letters at one end."""
    return F.array_distinct(F.concat(words, F.array(F.concat(F.lit("^"), F.substring(joined, 1, END_LETTERS)), F.concat(F.lit("$"), F.substring(joined, -END_LETTERS, END_LETTERS)))))


def _prepared(names: DataFrame, column: str) -> DataFrame:
    """name, joined, block: one row per block of each different name that has a letter."""
    words = names.select(F.col(column).alias("name")).distinct().withColumn("words", tokens(F.col("name"))).where(F.size("words") > 0)
    joined = words.withColumn("joined", F.array_join("words", " "))
    return joined.select("name", "joined", F.explode(_blocks(F.col("words"), F.col("joined"))).alias("block"))


def match_names(rows: DataFrame, known: DataFrame, *, name: str = "NAME", key: str = "KEY") -> DataFrame:
    """``rows`` with the key of the known name nearest to theirs: the columns KEY, DISTANCE, CANDIDATES, MATCH.

    ``known`` has the columns ``name`` and ``key``. Names are compared by their sorted words, so order, case,
    marks and bracketed remarks do not matter, and only within blocks (a word in common, or the first or last
    letters), so there is no cross join. DISTANCE is the least edit distance, if it is within one edit for
    each LETTERS_PER_EDIT letters. MATCH is ``equal`` (distance 0), ``near``, ``tied`` (several keys at the least
    distance: KEY is null, CANDIDATES lists them) or ``none``. Each different name is compared once, however
    many rows bear it. Null names and names without a letter match nothing; every row stays.
    """
    left, right = _prepared(rows, name), _prepared(known, name)
    keys = known.select(F.col(name).alias("other"), F.col(key).alias("key")).distinct()
    pairs = left.join(right.select(F.col("name").alias("other"), F.col("joined").alias("other_joined"), "block"), "block")
    pairs = pairs.select("name", "joined", "other", "other_joined").distinct()
    limit = F.greatest(F.lit(1), F.floor(F.least(F.length("joined"), F.length("other_joined")) / LETTERS_PER_EDIT))
    near = pairs.withColumn("distance", F.levenshtein("joined", "other_joined")).where(F.col("distance") <= limit)
    # the least distance first, then the keys at it: sums of small sets, combined on the map side
    least = near.groupBy("name").agg(F.min("distance").alias("least"))
    best = near.join(least, "name").where("distance = least").join(keys, "other")
    found = best.groupBy("name").agg(F.first("distance").alias("DISTANCE"), F.array_sort(F.collect_set("key")).alias("CANDIDATES"))
    named = rows.join(found.withColumnRenamed("name", "matched_name"), F.col(name) == F.col("matched_name"), "left").drop("matched_name")
    match = (
        F.when(F.col("CANDIDATES").isNull() | (F.size("CANDIDATES") == 0), "none").when(F.size("CANDIDATES") > 1, "tied")
        .when(F.col("DISTANCE") == 0, "equal").otherwise("near")
    )
    return named.withColumn("MATCH", match).withColumn(key, F.when(F.size("CANDIDATES") == 1, F.get("CANDIDATES", F.lit(0))))
