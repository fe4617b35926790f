"""Tables laid out for what will be asked: by station in buckets, or along a curve through place and time."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.functions import columns as C
from weatherloom.sources import sinks

CURVE_BITS = 16


def save_by_station(df: DataFrame, name: str, buckets: int, *, by: str = "ID") -> str:
    """Save as a table in buckets of ``by``, sorted by it; returns the name under which the catalog knows it.

    Aggregates whose keys include the station, and joins on the station with a table in as many buckets,
    then need no exchange. A bucket is one task when it is read that way, and a station is never divided: choose
    the buckets so that the largest fits, and use the tables by year where a few stations hold most rows. Rows
    are brought together by the same key first, so each bucket is one file.
    """
    table = f"{name}_{uuid.uuid4().hex}"
    packed = df.repartition(buckets, by)
    packed.write.bucketBy(buckets, by).sortBy(by).option("path", sinks.shared_path(df.sparkSession, name)).saveAsTable(table)
    return table


def curve_key(*axes: Column, bits: int = CURVE_BITS) -> Column:
    """Place on a Z-order curve: the bits of whole numbers in [0, 2**bits), the highest first, taken in turn.

    Near places on the curve are near on every axis, so a range of it is a small box. A null axis gives null.
    """
    if bits * len(axes) > 63:
        raise ValueError("bits")
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for n, axis in enumerate(axes):
            taken = F.shiftright(axis.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(taken, bit * len(axes) + len(axes) - 1 - n))
    return key


def on_axis(value: Column, low: float, high: float, bits: int = CURVE_BITS) -> Column:
    """``value`` as a step of an axis from ``low`` to ``high``; what lies outside stands at its end, null stays null."""
    steps = (1 << bits) - 1
    step = F.floor((value - low) / max(high - low, 1e-9) * steps)
    return F.when(value.isNotNull(), F.least(F.greatest(step, F.lit(0)), F.lit(steps)))


def save_along_curve(daily: DataFrame, stations: DataFrame, path: str, *, files: int, row_group_bytes: int | None = None) -> str:
    """Save observations with LATITUDE, LONGITUDE and DAY in the order of a curve through all three.

    The axes span the globe and, as a curve is only as good as its axes are filled, the days that ``daily`` has, which
    one aggregate finds. ``files`` ranges of the curve are written, so a station or a day with most of the rows is still divided by the
    other axes. Each file and row group spans a small box, and its least and greatest values let a reader skip it for a
    box of places or a span of days alike. Rows without a position or day come first. ``stations`` have one row per ID.
    """
    placed = daily.withColumn("DAY", C.day_of(daily)).join(stations.select("ID", "LATITUDE", "LONGITUDE"), "ID", "left")
    first, last = daily.agg(F.min(F.unix_date(C.day_of(daily))), F.max(F.unix_date(C.day_of(daily)))).first()
    day = on_axis(F.unix_date("DAY"), first or 0, last or 0)
    key = curve_key(on_axis(F.col("LATITUDE"), -90.0, 90.0), on_axis(F.col("LONGITUDE"), -180.0, 180.0), day)
    keyed = placed.withColumn("curve", key)
    ordered = keyed.repartitionByRange(files, "curve", "ID", "DAY").sortWithinPartitions("curve", "ID", "DAY").drop("curve")
    writer = ordered.write.mode("overwrite")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    return path


def in_box(df: DataFrame, *, latitude: tuple[float, float], longitude: tuple[float, float], first_day: str, last_day: str) -> DataFrame:
    """Rows of a box of places (ends included) and a span of days; a box over the date line has its west greater than its east."""
    west, east = longitude
    between = F.col("LONGITUDE").between(west, east) if west <= east else (F.col("LONGITUDE") >= west) | (F.col("LONGITUDE") <= east)
    days = F.col("DAY").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    return df.where(F.col("LATITUDE").between(*latitude) & between & days)
