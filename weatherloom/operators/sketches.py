"""How many different stations, from mergeable sketches: a small table that answers by year, country or both, and for differences.

Exact counts stay the default (``integrity``, ``counts``, ``presence``). A theta sketch of 2**BITS entries is exact up to
so many stations and has a relative standard error of 1 / sqrt(2**BITS) beyond.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.functions import columns as C

BITS = 12


def relative_error(bits: int = BITS, deviations: float = 3.0) -> float:
    """The relative error that an estimate stays within, in so many standard deviations."""
    return deviations / math.sqrt(1 << bits)


def station_sketches(daily: DataFrame, *by: str | Column, bits: int = BITS) -> DataFrame:
    """YEAR, the columns ``by`` and SKETCH of the different IDs; ``by`` is taken from the observations.

    One scan. Sketches are combined on the map side, so a task sends one of at most 32 KB per group, whatever
    share of the rows a station, year or country has. Null IDs do not count; a missing year is a group.
    """
    sketch = F.theta_sketch_agg(F.col("ID").cast("string"), F.lit(bits)).alias("SKETCH")
    return daily.groupBy(C.year_of(daily).alias("YEAR"), *by).agg(sketch)


def merged(sketches: DataFrame, *by: str, bits: int = BITS) -> DataFrame:
    """Sketches united by fewer columns, or of tables that were made apart."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("SKETCH", F.lit(bits)).alias("SKETCH"))


def estimated(sketches: DataFrame) -> DataFrame:
    """The sketches as whole numbers: N_STATIONS."""
    return sketches.withColumn("N_STATIONS", F.theta_sketch_estimate("SKETCH").cast("bigint")).drop("SKETCH")


def stopped_estimate(by_year: DataFrame, span: int = 1) -> DataFrame:
    """YEAR and N_STOPPED: about how many stations were observed ``span`` years before but not in this year.

    ``by_year`` has YEAR and SKETCH, one row per year; years without a row ``span`` years before have none. The
    error is that of the larger of both years.
    """
    before = by_year.select((F.col("YEAR") + span).alias("YEAR"), F.col("SKETCH").alias("before"))
    gone = F.theta_sketch_estimate(F.theta_difference("before", "SKETCH"))
    return by_year.join(before, "YEAR").select("YEAR", gone.cast("bigint").alias("N_STOPPED"))
