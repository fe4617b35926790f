"""Benchmark decontamination: short items inside long documents, with DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.llm.common import small, text_hash, without_rows, written

SHINGLE_WORDS = 5
MIN_CONTAINMENT = 0.8
#: Words are runs of letters, marks and digits, in lower case.
_BETWEEN = r"[^\p{L}\p{M}\p{N}]+"


def words_of(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def windows(rows: DataFrame, width: int) -> DataFrame:
    """One row per window of ``width`` words of ``rows`` (keys and words), with its hash; keys, words and at stay.

    The hash is read from the array of words while positions are generated, so no window is built.
    """
    places = F.when(F.size("words") >= width, F.sequence(F.lit(0), F.size("words") - width))
    placed = rows.select("*", F.explode(places).alias("at"))
    return placed.withColumn("width", F.lit(width)).withColumn("hash", F.xxhash64(*(F.col("words")[F.col("at") + i] for i in range(width))))


def _window_text(width: int) -> Column:
    return F.concat_ws(" ", *(F.col("words")[F.col("at") + i] for i in range(width)))


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(item_id, item_hash, n_item, width, hash, shingle): every different shingle of every item; n_item is their number.

    An item of fewer words than a shingle is one shingle of all its words; one without words has
    none. Rows with one item_id and different texts are items of their own, null ids included.
    """
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), text_hash(F.col(text_col)).alias("item_hash"), words_of(F.col(text_col)).alias("words")).distinct()
    parts = []
    for width in range(1, shingle_words + 1):
        own = rows.filter(F.size("words") >= width if width == shingle_words else F.size("words") == width)
        parts.append(windows(own, width).withColumn("shingle", _window_text(width)).select("item_id", "item_hash", "width", "hash", "shingle"))
    every = reduce(DataFrame.union, parts).distinct()
    return every.withColumn("n_item", F.count("*").over(Window.partitionBy("item_id", "item_hash")))


def sketches(shingles: DataFrame, min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """The MinHash sketch of each item: its smallest shingle hashes, as many as its size partition asks for.

    Items are partitioned by size, each partition up to twice as large as the one before. Of u
    shingles (1 - c) u at most are missing in a document that holds the share c, so one more than
    that of the smallest hashes cannot all be missing, u being the upper end of the partition. Such
    a document shares a hash with the sketch however long it is: no document is missed.
    """
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n_item").cast("double"))))
    needed = F.floor(upper * (1 - min_containment) + 1e-9) + 1
    order = Window.partitionBy("item_id", "item_hash").orderBy("hash", "shingle")
    return shingles.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= needed).select("item_id", "item_hash", "width", "hash")


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_containment: float = MIN_CONTAINMENT, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, item_id, item_hash, n_shared, n_item, containment) of every pair with enough of the item.

    Candidates are documents that share a hash with an item's sketch; only these are read again, and
    every shingle of theirs that hashes like one of an item is compared with it as text. containment is
    the share of the item's different shingles found. Null and empty texts contain nothing, an item
    without words is nowhere. A row repeated with id and text counts once; null ids are kept as
    null. Other columns are ignored. Items are broadcast if they were counted small.
    """
    shingles = written(item_shingles(items, shingle_words=shingle_words), "item-shingles")
    sketch = written(sketches(shingles, min_containment), "sketches")
    widths = [r["width"] for r in shingles.select("width").distinct().collect()]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), words_of(F.col(text_col)).alias("words"))
    if not widths:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("item_id", "long"), ("item_hash", "long"), ("n_shared", "long"), ("n_item", "long"), ("containment", "double"))]
        return rows.filter(F.lit(False)).select("doc_id", "text_hash", *none)
    met = [windows(rows, w).select("doc_id", "text_hash", "width", "hash").join(small(sketch.filter(F.col("width") == w).drop("width")), "hash", "left_semi") for w in widths]
    candidates = written(reduce(DataFrame.union, met).select("doc_id", "text_hash").distinct(), "candidates")
    keys = candidates.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"))
    read = rows.join(small(keys), rows["doc_id"].eqNullSafe(keys["i"]) & (rows["text_hash"] == keys["h"]), "left_semi")
    found = []
    for w in widths:
        own = small(shingles.filter(F.col("width") == w).drop("width"))
        equal = windows(read, w).join(own, "hash").filter(F.col("shingle") == _window_text(w))
        found.append(equal.select("doc_id", "text_hash", "item_id", "item_hash", "n_item", "shingle"))
    pairs = reduce(DataFrame.union, found).distinct().groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(F.count("*").alias("n_shared"), F.max("n_item").alias("n_item"))
    share = F.col("n_shared") / F.col("n_item")
    return pairs.withColumn("containment", share).filter(F.col("n_shared") >= F.ceil(F.col("n_item") * min_containment - 1e-9))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    gone = written(contained_items(docs, items).select("doc_id", "text_hash").distinct(), "contaminated")
    return without_rows(docs, gone)


#: For DuckDB over the tables documents and benchmark.
SQL = rf"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{_BETWEEN}'), lambda x: x <> '') AS w FROM documents
), i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{_BETWEEN}'), lambda x: x <> '') AS w FROM benchmark
), iw AS (
  SELECT item_id, w, least(len(w), {SHINGLE_WORDS}) AS n FROM i WHERE len(w) > 0
), its AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM iw)
), sizes AS (
  SELECT item_id, count(*) AS n_item FROM its GROUP BY item_id
), ds AS (
  SELECT DISTINCT doc_id, n, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM w, (SELECT DISTINCT n FROM iw))
), p AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN its USING (n, s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_shared, n_item, round(n_shared / n_item, 6) AS containment
FROM p JOIN sizes USING (item_id) WHERE n_shared >= ceil(n_item * {MIN_CONTAINMENT} - 1e-9)
"""
