"""Facts about the files themselves: size, year, share and expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weatherloom.functions import columns as C


def file_facts(spark: SparkSession, path: str, *, pattern: str | None = None) -> DataFrame:
    """``path, size, year`` of every file below ``path``.

    Only the path and length columns are selected, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path", F.col("length").alias("size"), C.year_in_filename(F.col("path")).alias("year")
    )


def parse_listing(lines: DataFrame) -> DataFrame:
    """``year, size, name`` of every line of a directory listing (column ``value``) that names a year file.

    The fields of a line stand between blanks. The size is the field before the date; in a line
    without a date it is the field before the path. What is no number there gives a null size, so
    that no file vanishes; :func:`unread_sizes` counts them.
    """
    fields = lines.select(F.split(F.trim("value"), r"\s+").alias("field"))
    years = F.transform("field", C.year_in_filename)
    dated = F.transform("field", lambda f: F.try_to_date(f, "yyyy-MM-dd").isNotNull())
    placed = fields.withColumn("year", F.get(F.filter(years, lambda y: y.isNotNull()), 0))
    path_at = F.array_position(F.transform(years, lambda y: y.isNotNull()), True)
    date_at = F.array_position(dated, True)
    before = F.when((date_at > 0) & (date_at < path_at), date_at).otherwise(path_at) - 2
    size = F.get("field", before.cast("int")).try_cast("bigint")
    return placed.where("year IS NOT NULL").select("year", size.alias("size"), F.concat(F.col("year").cast("string"), F.lit(".csv.gz")).alias("name"))


def unread_sizes(listing: DataFrame) -> DataFrame:
    """One row: files named in a listing, and those of them whose size could not be read."""
    return listing.agg(F.count("*").alias("N_FILES"), F.count_if(F.col("size").isNull()).alias("N_UNREAD"))


def size_shares(facts: DataFrame, by: str) -> DataFrame:
    """Files, bytes and share of all bytes per value of ``by``.

    The window spans the aggregated rows only: one per dataset or year.
    """
    return (
        facts.groupBy(by)
        .agg(F.count(F.lit(1)).alias("N_FILES"), F.sum("size").alias("SIZE"))
        .withColumn("SHARE", F.col("SIZE") / F.sum("SIZE").over(Window.partitionBy()))
        .withColumn("SIZE_TEXT", C.bytes_text(F.col("SIZE")))
    )


def expanded_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Uncompressed size of text files, counted while reading (each line plus its newline)."""
    return spark.read.text(path).agg(
        F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).alias("EXPANDED_SIZE")
    )


def expansion_estimate(facts: DataFrame, *, sample_year: int, sample_expanded: int) -> DataFrame:
    """Total bytes, the sample's expansion ratio, and the total it implies."""
    return (
        facts.agg(
            F.sum("size").alias("SIZE"),
            F.sum(F.when(F.col("year") == sample_year, F.col("size"))).alias("SAMPLE_SIZE"),
        )
        .withColumn("RATIO", F.lit(float(sample_expanded)) / F.col("SAMPLE_SIZE"))
        .select("SIZE", "RATIO", (F.col("SIZE") * F.col("RATIO")).alias("ESTIMATED_SIZE"))
    )
