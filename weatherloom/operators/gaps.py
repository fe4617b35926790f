"""Missing years and days, runs of missing days, and coverage of a series.

Observations are reduced to one row per group and month before any window: the days seen
in a month are the bits of one number, combined on the map side. What is shuffled and
sorted is bounded by the calendar, not by the number of observations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.functions import columns as C


def missing_years(df: DataFrame, year_col: str = "YEAR") -> DataFrame:
    """Years between the first and the last one that do not occur; empty for no input."""
    years = df.select(F.col(year_col).alias("y")).distinct().agg(F.collect_set("y").alias("seen"))
    return years.select(
        F.explode(
            F.array_except(F.sequence(F.array_min("seen"), F.array_max("seen")), F.col("seen"))
        ).alias("YEAR")
    )


def gap_years(daily: DataFrame) -> DataFrame:
    """Years without any observation between the first and the last observed year."""
    return missing_years(daily.select(C.year_of(daily).alias("YEAR")))


def year_coverage(df: DataFrame, year_col: str = "YEAR") -> DataFrame:
    """First and last year, how many occur and how many are missing."""
    years = df.select(F.col(year_col).alias("y")).distinct()
    return years.agg(
        F.min("y").alias("FIRST_YEAR"), F.max("y").alias("LAST_YEAR"), F.count("y").alias("N_YEARS")
    ).withColumn("N_MISSING", F.col("LAST_YEAR") - F.col("FIRST_YEAR") + 1 - F.col("N_YEARS"))


def _months_seen(daily: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Rows, first and last day, and the days seen as bits, per group and month."""
    days = daily.select(*by, C.day_of(daily).alias("DAY"))
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth("DAY") - 1)
    return days.groupBy(*by, F.trunc("DAY", "month").alias("MONTH")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("DAY").alias("first"),
        F.max("DAY").alias("last"),
        F.bit_or(bit).alias("seen"),
    )


def gap_runs(daily: DataFrame, by: tuple[str, ...] = ("ID",)) -> DataFrame:
    """Runs of days without observation inside each group's span.

    A run lies between one observed day and the next, in the same month or at the start
    of the next month seen, so no calendar is built. An empty ``by`` takes the input as one group.
    """
    # Rows without a real date form a month of their own, which sorts first and has no days.
    months = _months_seen(daily, by)
    next_month = F.lead("first").over(Window.partitionBy(*by).orderBy("MONTH"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda bit: F.getbit("seen", bit) == 1)
    days = F.transform(bits, lambda bit: F.date_add("MONTH", bit))
    neighbours = F.arrays_zip("day", F.concat(F.slice("day", 2, 31), F.array("next_month")).alias("following"))
    # Most months have no gap; only the others are unpacked into days.
    hole = F.bit_count("seen") <= F.datediff("last", "first")
    return (
        months.withColumn("next_month", next_month)
        .where(hole | (F.datediff("next_month", "last") > 1))
        .withColumn("day", days)
        .select(*by, F.inline(neighbours).alias("day", "following"))
        .where(F.datediff("following", "day") > 1)
        .select(
            *by,
            F.date_add("day", 1).alias("GAP_START"),
            F.date_sub("following", 1).alias("GAP_END"),
            (F.datediff("following", "day") - 1).alias("N_DAYS"),
        )
    )


def missing_days(daily: DataFrame, by: tuple[str, ...] = ("ID",)) -> DataFrame:
    """Every single day of the gaps, per group."""
    days = F.explode(F.sequence("GAP_START", "GAP_END", F.expr("interval 1 day")))
    return gap_runs(daily, by).select(*by, days.alias("DAY"))


def coverage(daily: DataFrame, by: tuple[str, ...] = ("ID",)) -> DataFrame:
    """Observations, years, first and last day, expected, observed and missing days.

    Going by month, then by year, then by group gives the distinct counts from plain
    sums: each step combines on the map side and no row is expanded.
    """
    per_year = (
        _months_seen(daily, by)
        .groupBy(*by, F.year("MONTH").alias("YEAR"))
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.bit_count("seen")).alias("days"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
    )
    span = F.datediff(F.max("last"), F.min("first")) + 1
    return per_year.groupBy(*by).agg(
        F.sum("n").alias("N_OBSERVATIONS"),
        F.count("YEAR").alias("N_YEARS"),
        F.min("first").alias("FIRST_DAY"),
        F.max("last").alias("LAST_DAY"),
        span.alias("EXPECTED_DAYS"),
        F.sum("days").alias("OBSERVED_DAYS"),
        (span - F.sum("days")).alias("MISSING_DAYS"),
    )
