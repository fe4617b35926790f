"""Observations of one element without the other on the same station and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CHUNK = 100_000


def unpaired_days(daily: DataFrame, present: str = "TMAX", absent: str = "TMIN") -> DataFrame:
    """Station-days that have ``present`` but not ``absent``: ``ID, DATE, N_OBSERVATIONS``.

    An anti join would scan the observations twice and shuffle both elements. Counting
    both in one aggregate scans once, combines on the map side and shuffles one row
    per station-day. A null key never matches anything, as in a join.
    """
    element = F.col("ELEMENT")
    no_partner = (F.col("n_absent") == 0) | F.col("ID").isNull() | F.col("DATE").isNull()
    return (
        daily.where(element.isin(present, absent))
        .groupBy("ID", "DATE")
        .agg(
            F.count_if(element == present).alias("N_OBSERVATIONS"),
            F.count_if(element == absent).alias("n_absent"),
        )
        .where((F.col("N_OBSERVATIONS") > 0) & no_partner)
        .drop("n_absent")
    )


def unpaired_summary(daily: DataFrame, present: str = "TMAX", absent: str = "TMIN") -> DataFrame:
    """Number of unpaired observations and of the stations they come from."""
    per_station = unpaired_days(daily, present, absent).groupBy("ID").agg(
        F.sum("N_OBSERVATIONS").alias("n")
    )
    return per_station.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("N_OBSERVATIONS"),
        F.count(F.lit(1)).alias("N_STATIONS"),
    )


def unpaired_observations(daily: DataFrame, present: str = "TMAX", absent: str = "TMIN") -> DataFrame:
    """``ID, DATE`` once per unpaired observation, duplicates included.

    A station-day is written out in chunks that are spread over all tasks first, so
    that even one with a very large count does not fall to a single task.
    """
    days = unpaired_days(daily, present, absent)
    last_chunk = F.floor((F.col("N_OBSERVATIONS") - 1) / _CHUNK)
    chunks = days.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    in_chunk = F.least(F.col("N_OBSERVATIONS") - F.col("chunk") * _CHUNK, F.lit(_CHUNK))
    return (
        chunks.repartition("ID", "DATE", "chunk")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), in_chunk)))
        .select("ID", "DATE")
    )
