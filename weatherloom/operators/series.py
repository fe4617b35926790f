"""Monthly series per station and country, rolling means, and the dense monthly grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.functions import columns as C
from weatherloom.operators.counts import country_stations
from weatherloom.operators.integrity import with_station_columns
from weatherloom.operators.sizing import BROADCAST_LIMIT, broadcast_if_small

TEMPERATURES = ("TMIN", "TMAX")


def temperature_observations(
    daily: DataFrame,
    stations: DataFrame,
    *,
    country: str = "NZ",
    elements: tuple[str, ...] = TEMPERATURES,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Observations of the elements at one country's stations, with NAME and TEMP_C.

    Only the country's (ID, NAME) list is joined, so the observations are normally
    filtered where they are read, without a shuffle.
    """
    listed = broadcast_if_small(country_stations(stations, country).select("ID", "NAME"), broadcast_limit)
    return (
        daily.where(F.col("ELEMENT").isin(*elements))
        .join(listed, "ID")
        .withColumn("TEMP_C", C.in_units(F.col("ELEMENT"), F.col("VALUE")))
    )


def _mean_in_units() -> Column:
    # Stored values are whole tenths: their sum is exact in any order, so dividing
    # last makes the mean the same however the rows were partitioned.
    return C.in_units(F.col("ELEMENT"), F.avg("VALUE"))


def monthly_means(temperatures: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Mean TEMP_C per station, element and month, with the station's NAME.

    With ``stations`` the observations need no NAME: it is joined to the monthly rows, so
    raw rows neither meet the stations nor carry a name through the shuffle. Stations
    not listed there have a null NAME.
    """
    month = C.month_start_of(temperatures).alias("YEAR_MONTH")
    own = ["ID", "ELEMENT"] if stations is not None else ["ID", "NAME", "ELEMENT"]
    means = temperatures.groupBy(*own, month).agg(_mean_in_units().alias("TEMP_C"))
    if stations is not None:
        means = with_station_columns(means, stations.select("ID", "NAME"))
    return means.select("ID", "NAME", "ELEMENT", "YEAR_MONTH", "TEMP_C")


def country_monthly_means(temperatures: DataFrame, *, weighting: str = "observation") -> DataFrame:
    """Mean TEMP_C per element and month over the whole input.

    ``observation`` weights every row alike, ``station`` first takes each station's
    monthly mean so that a station reporting more often does not count for more.
    """
    if weighting == "observation":
        month = C.month_start_of(temperatures).alias("YEAR_MONTH")
        return temperatures.groupBy("ELEMENT", month).agg(_mean_in_units().alias("TEMP_C"))
    if weighting == "station":
        per_station = monthly_means(temperatures)
        return per_station.groupBy("ELEMENT", "YEAR_MONTH").agg(F.avg("TEMP_C").alias("TEMP_C"))
    raise ValueError(f"weighting must be 'observation' or 'station', not {weighting!r}")


def monthly_pivot(temperatures: DataFrame, elements: tuple[str, ...] = TEMPERATURES) -> DataFrame:
    """One row per station and month with a column of means per element.

    Averages under a condition need one shuffle where ``pivot`` needs two.
    """
    month = C.month_start_of(temperatures).alias("YEAR_MONTH")
    return (
        temperatures.where(F.col("ELEMENT").isin(*elements))
        .groupBy("ID", month)
        .agg(
            *((F.avg(F.when(F.col("ELEMENT") == e, F.col("VALUE"))) / C.element_divisor(e)).alias(e) for e in elements)
        )
    )


def _month_number() -> Column:
    return F.year("YEAR_MONTH") * 12 + F.month("YEAR_MONTH")


def rolling_mean(
    monthly: DataFrame, *, by: tuple[str, ...] = ("ID", "ELEMENT"), months: int = 12
) -> DataFrame:
    """Add ROLLING_C: the mean of the last ``months`` months where all of them exist.

    The frame is a range over the month number, so a missing month leaves the window
    short and the result null; no filled-in grid is needed. A window partition is one
    station's monthly means, never its raw observations.
    """
    frame = Window.partitionBy(*by).orderBy(_month_number()).rangeBetween(-(months - 1), 0)
    full = F.count("TEMP_C").over(frame) == months
    return monthly.withColumn("ROLLING_C", F.when(full, F.avg("TEMP_C").over(frame)))


def dense_months(
    monthly: DataFrame,
    *,
    by: tuple[str, ...] = ("ID", "ELEMENT"),
    values: tuple[str, ...] = ("TEMP_C", "ROLLING_C"),
    first: Column | None = None,
    last: Column | None = None,
) -> DataFrame:
    """Every group on every month between the overall first and last one.

    Where ``first`` and ``last`` (dates) are not given they are looked up in
    ``monthly``, so land that small table before if it comes straight from observations.

    Each existing row also writes the empty months up to the group's next row; the
    group's first row writes those before it, its last row those after it. So the grid
    needs neither a cross join nor a join back, and a rolling mean computed by the
    same keys shares its shuffle. Values of months without data stay null.
    """
    first = monthly.agg(F.min("YEAR_MONTH")).scalar() if first is None else first
    last = monthly.agg(F.max("YEAR_MONTH")).scalar() if last is None else last
    in_group = Window.partitionBy(*by).orderBy("YEAR_MONTH")
    following = F.lead("YEAR_MONTH").over(in_group)
    starts = F.lag("YEAR_MONTH").over(in_group).isNull()
    spans = monthly.where(F.col("YEAR_MONTH").isNotNull()).select(
        *by,
        F.col("YEAR_MONTH").alias("own"),
        *values,
        starts.alias("starts"),
        F.add_months(following, F.lit(-1)).alias("before_next"),
    )
    grid = spans.withColumn(
        "YEAR_MONTH",
        F.explode(
            F.sequence(
                F.when(F.col("starts"), first).otherwise(F.col("own")),
                F.coalesce("before_next", last),
                F.expr("interval 1 month"),
            )
        ),
    )
    own = F.col("YEAR_MONTH") == F.col("own")
    return grid.select(*by, "YEAR_MONTH", *(F.when(own, F.col(v)).alias(v) for v in values))
