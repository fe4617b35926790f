"""Reading the observation files and landing them once as partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherloom.functions import columns as C
from weatherloom.schema import observations_schema

#: What one bucket of a year holds: bytes of its (compressed) files, or rows where no files are given.
BUCKET_BYTES = 32 * 1024 * 1024
BUCKET_ROWS = 4_000_000


def read_observations(
    spark: SparkSession, path: str | list[str], *, year: int | None = None
) -> DataFrame:
    """Read header-less CSV (gzip or plain): one file, several, or a whole directory.

    With ``year`` only that year's file below the directory is opened. A gzip file
    cannot be split, so repeated analysis should read the landed Parquet instead.
    """
    if year is not None:
        path = f"{str(path).rstrip('/')}/{year}.csv.gz"
    return spark.read.schema(observations_schema()).csv(path)


def land_observations(
    daily: DataFrame,
    path: str,
    *,
    facts: DataFrame | None = None,
    bucket_bytes: int = BUCKET_BYTES,
    bucket_rows: int = BUCKET_ROWS,
    mode: str = "overwrite",
    replace_years: bool = False,
) -> str:
    """Write observations as Parquet, one directory per YEAR.

    A year is divided into buckets by its size: from ``facts`` (``files.file_facts`` of
    the files read), else from its number of rows, which reads ``daily`` once more. A
    year without a file of its own in ``facts`` is one bucket. A bucket is taken from ID
    and DATE, so a year that came in one unsplittable file, or from one station, is still
    sorted and written by many tasks; adaptive execution merges small buckets. Sorting
    inside a file narrows the min/max ranges of ELEMENT and ID, by which a reader skips
    row groups. DATE is kept as text: nothing is lost for dates that do not exist, and a
    year of it is only a small dictionary. With ``replace_years`` only the years that
    ``daily`` holds are overwritten.
    """
    dated = C.with_year(daily)
    if facts is None:
        sizes = dated.groupBy("YEAR").agg((F.count(F.lit(1)) / bucket_rows).alias("size"))
    else:
        sizes = facts.groupBy(F.col("year").alias("YEAR")).agg((F.sum("size") / bucket_bytes).alias("size"))
    # One row per year, as many as there are directories to write: always small.
    buckets = F.broadcast(sizes.select(F.col("YEAR").alias("sized_year"), F.ceil("size").alias("n_buckets")))
    divided = dated.join(buckets, F.col("YEAR").eqNullSafe(F.col("sized_year")), "left").select(
        *dated.columns,
        F.pmod(F.xxhash64("ID", "DATE"), F.greatest(F.col("n_buckets"), F.lit(1).cast("bigint"))).alias("bucket"),
    )
    packed = divided.hint("rebalance", "YEAR", "bucket").sortWithinPartitions("YEAR", "ELEMENT", "ID", "DATE")
    writer = packed.drop("bucket").write.mode(mode).partitionBy("YEAR")
    if replace_years:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def read_landed(
    spark: SparkSession, path: str, *, years: int | list[int] | None = None
) -> DataFrame:
    """Read landed observations; ``years`` prunes whole directories."""
    daily = spark.read.schema(observations_schema().add("YEAR", T.IntegerType())).parquet(path)
    if years is None:
        return daily
    wanted = [years] if isinstance(years, int) else list(years)
    return daily.where(F.col("YEAR").isin(wanted))


def filter_quality(daily: DataFrame, quality: str = "any") -> DataFrame:
    """``any`` keeps every row, ``ok`` only rows whose quality flag is blank or missing."""
    if quality not in ("any", "ok"):
        raise ValueError(f"quality must be 'any' or 'ok', not {quality!r}")
    return daily.where(C.quality_ok()) if quality == "ok" else daily


def exclude_years(daily: DataFrame, years: tuple[int, ...] = ()) -> DataFrame:
    """Leave out years known to be unreliable; rows without a year stay."""
    if not years:
        return daily
    return daily.where(~F.coalesce(C.year_of(daily).isin(*years), F.lit(False)))


def rollup_observations(daily: DataFrame) -> DataFrame:
    """One row per YEAR, ID and ELEMENT.

    Element counts, activity, element profiles and country-year means can all be
    taken from this table, so landing it saves every later scan of the observations.
    """
    day = C.day_of(daily)
    return (
        daily.withColumn("YEAR", C.year_of(daily))
        .groupBy("YEAR", "ID", "ELEMENT")
        .agg(
            F.count(F.lit(1)).alias("N_OBSERVATIONS"),
            F.count("VALUE").alias("N_VALUES"),
            F.sum("VALUE").alias("SUM_VALUE"),
            F.min(day).alias("FIRST_DAY"),
            F.max(day).alias("LAST_DAY"),
        )
    )
