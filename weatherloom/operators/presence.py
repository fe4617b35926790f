"""Who was observed when, as bitmaps: a small table that answers for any span of years without the observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.functions import columns as C
from weatherloom.operators.sizing import BROADCAST_LIMIT, broadcast_if_small
from weatherloom.sources import sinks


def numbered(stations: DataFrame, id_col: str = "ID") -> DataFrame:
    """ID and NUMBER, 1 to the number of different IDs in their order; written once, as numbers must not change.

    IDs are sorted by ranges; a range begins after the sizes of those before it, so no task sees all of them.
    A null ID has no number.
    """
    ids = stations.select(F.col(id_col).alias("ID")).where("ID IS NOT NULL").distinct()
    ranged = ids.repartitionByRange("ID").sortWithinPartitions("ID").select("ID", F.monotonically_increasing_id().alias("place"))
    spark = stations.sparkSession
    path = sinks.shared_path(spark, "places")
    ranged.write.parquet(path)
    placed = spark.read.schema(ranged.schema).parquet(path).withColumns({"part": F.shiftrightunsigned("place", 33), "at": F.col("place").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))  # one row per range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begins"))
    return placed.join(F.broadcast(begins), "part").select("ID", (F.col("begins") + F.col("at") + 1).alias("NUMBER"))


def presence(daily: DataFrame, numbers: DataFrame, *, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """YEAR, BUCKET, BITS: which numbered stations were observed in a year, 32768 to a row of 4 KB.

    One scan; bitmaps are combined on the map side, so a station or year with a third of all rows costs one row per task.
    Tables of different observations merge by ``merged``. IDs without a number are left out, a missing year is a year.
    """
    listed = broadcast_if_small(numbers, broadcast_limit)
    seen = daily.select("ID", C.year_of(daily).alias("YEAR")).join(listed, "ID")
    return _as_bits(seen, "YEAR")


def _as_bits(rows: DataFrame, *by: str) -> DataFrame:
    bucket = F.bitmap_bucket_number("NUMBER").alias("BUCKET")
    return rows.groupBy(*by, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("NUMBER")).alias("BITS"))


def merged(table: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of the same stations united: by YEAR for tables that were made apart, by nothing for all years."""
    return table.groupBy(*by, "BUCKET").agg(F.bitmap_or_agg("BITS").alias("BITS"))


def in_span(table: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """BUCKET and BITS of the stations observed in at least one of the years, ends included."""
    return merged(table.where(F.col("YEAR").between(first_year, last_year)))


def observed_counts(table: DataFrame, *by: str) -> DataFrame:
    """Stations in the bitmaps, by nothing or by YEAR: N_STATIONS."""
    sums = F.coalesce(F.sum(F.bitmap_count("BITS")), F.lit(0)).alias("N_STATIONS")
    return table.groupBy(*by).agg(sums) if by else table.agg(sums)


def _bit(bits: Column, number: Column) -> Column:
    position = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.bit_get(byte, (position % 8).cast("int")) == 1


def members(numbers: DataFrame, bits: DataFrame, *, present: bool = True) -> DataFrame:
    """IDs whose bit is set in ``bits`` (BUCKET, BITS), or with ``present=False`` those whose bit is not."""
    placed = numbers.withColumn("BUCKET", F.bitmap_bucket_number("NUMBER"))
    # one row of 4 KB for 32768 stations: 1 GB of them would be eight billion stations
    held = placed.join(broadcast_if_small(bits), "BUCKET", "left")
    is_set = F.coalesce(_bit(F.col("BITS"), F.col("NUMBER")), F.lit(False))
    return held.where(is_set if present else ~is_set).select("ID")


def never_observed(numbers: DataFrame, table: DataFrame) -> DataFrame:
    """IDs of numbered stations that no year has."""
    return members(numbers, merged(table), present=False)


def absent_in(numbers: DataFrame, table: DataFrame, year: int) -> DataFrame:
    """IDs of numbered stations that one year lacks."""
    return members(numbers, in_span(table, year, year), present=False)


def stopped(numbers: DataFrame, table: DataFrame, last_year: int, span: int) -> DataFrame:
    """IDs observed in the ``span`` years before ``last_year`` but not in it: one station list minus another, from bits."""
    before = members(numbers, in_span(table, last_year - span, last_year - 1))
    return before.join(members(numbers, in_span(table, last_year, last_year)), "ID", "left_anti")
