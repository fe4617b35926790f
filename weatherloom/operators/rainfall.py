"""Mean rainfall per country and year, and what is needed to judge each figure.

The country-year table is small whatever the number of observations (countries times
years), which is what bounds the exact percentiles and windows below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.functions import columns as C
from weatherloom.operators.sizing import BROADCAST_LIMIT, broadcast_if_small
from weatherloom.sources.observations import exclude_years, filter_quality

MEAN = "AVG_DAILY_PRCP_MM"


def country_year_means(
    daily: DataFrame,
    stations: DataFrame,
    *,
    element: str = "PRCP",
    quality: str = "any",
    without_years: tuple[int, ...] = (),
) -> DataFrame:
    """Mean, observation rows and stations per YEAR and COUNTRY_CODE.

    Observations are summed to one row per year and station before they meet the
    station list, so neither a country nor a station with a third of all rows makes a
    large task, and the join moves station-years instead of observations. Rows without
    a value count as observations but not in the mean. COUNTRY_NAME is carried along
    when the stations have it. Input may also be a rollup of the observations.
    """
    stations = C.with_country_code(stations)
    place = [c for c in ("COUNTRY_CODE", "COUNTRY_NAME") if c in stations.columns]
    rows = daily.where(F.col("ELEMENT") == element)
    if "N_OBSERVATIONS" in daily.columns:
        if quality != "any":
            raise ValueError("a rollup no longer has quality flags; filter before rolling up")
        counted, valued, total = F.sum("N_OBSERVATIONS"), F.sum("N_VALUES"), F.sum("SUM_VALUE")
    else:
        rows = filter_quality(rows, quality)
        counted, valued, total = F.count(F.lit(1)), F.count("VALUE"), F.sum("VALUE")
    per_station = (
        exclude_years(rows, without_years)
        .groupBy(C.year_of(daily).alias("YEAR"), "ID")
        .agg(counted.alias("n"), valued.alias("n_values"), total.alias("total"))
    )
    mean = F.try_divide(F.sum("total"), F.sum("n_values")) / C.element_divisor(element)
    # A station-year occurs once per place here, so counting rows counts stations.
    return (
        per_station.join(stations.select("ID", *place).distinct(), "ID")
        .groupBy("YEAR", *place)
        .agg(
            mean.alias(MEAN),
            F.sum("n").alias("N_OBSERVATIONS"),
            F.count(F.lit(1)).alias("N_STATIONS"),
        )
    )


def means_for_year(rainfall: DataFrame, year: int) -> DataFrame:
    return rainfall.where(F.col("YEAR") == year)


def describe_means(rainfall: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum as one row."""
    return rainfall.agg(
        F.count(MEAN).alias("N"),
        F.avg(MEAN).alias("MEAN"),
        F.stddev(MEAN).alias("STDDEV"),
        F.min(MEAN).alias("MIN"),
        F.percentile(MEAN, 0.25).alias("P25"),
        F.percentile(MEAN, 0.5).alias("P50"),
        F.percentile(MEAN, 0.75).alias("P75"),
        F.max(MEAN).alias("MAX"),
    )


def mean_percentiles(rainfall: DataFrame, percents: tuple[int, ...] = (90, 95, 99)) -> DataFrame:
    """Exact percentiles of the means as one row, columns ``P90`` and so on."""
    return rainfall.agg(*(F.percentile(MEAN, p / 100.0).alias(f"P{p}") for p in percents))


def sparse_counts(rainfall: DataFrame, limits: tuple[int, ...] = (3, 10, 30)) -> DataFrame:
    """How many country-years rest on at most so many observations."""
    return rainfall.agg(
        *(F.count_if(F.col("N_OBSERVATIONS") <= k).alias(f"N_AT_MOST_{k}") for k in limits)
    )


def sparse_rows(rainfall: DataFrame, limit: int = 10) -> DataFrame:
    """The country-years resting on at most ``limit`` observations, sparsest first."""
    return rainfall.where(F.col("N_OBSERVATIONS") <= limit).orderBy(
        "N_OBSERVATIONS", "COUNTRY_CODE", "YEAR"
    )


def highest_means(rainfall: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` highest country-years with their LABEL ``name (year)``."""
    named = "COUNTRY_NAME" if "COUNTRY_NAME" in rainfall.columns else "COUNTRY_CODE"
    place = F.coalesce(F.col(named), F.col("COUNTRY_CODE"))
    return (
        rainfall.where(F.col(MEAN).isNotNull())
        .orderBy(F.desc(MEAN), "YEAR", "COUNTRY_CODE")
        .limit(n)
        .withColumn("LABEL", C.year_label(place, F.col("YEAR")))
    )


def observations_behind(
    daily: DataFrame,
    stations: DataFrame,
    country_years: DataFrame,
    *,
    element: str = "PRCP",
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The observation rows from which the given country-years were computed.

    Spark knows the size of a limited result such as ``highest_means`` and broadcasts
    it without a hint, so the observations stream past both lookups.
    """
    places = C.with_country_code(stations).select("ID", "COUNTRY_CODE").distinct()
    wanted = country_years.select("COUNTRY_CODE", "YEAR")
    return (
        C.with_year(daily.where(F.col("ELEMENT") == element))
        .join(broadcast_if_small(places, broadcast_limit), "ID")
        .join(wanted, ["COUNTRY_CODE", "YEAR"], "left_semi")
    )


# Map table ----------------------------------------------------------------------


def countries_without_data(stations: DataFrame, rainfall_year: DataFrame) -> DataFrame:
    """Country codes that have stations but no row in the year's rainfall."""
    codes = C.with_country_code(stations).select("COUNTRY_CODE").distinct()
    return codes.join(rainfall_year.select("COUNTRY_CODE"), "COUNTRY_CODE", "left_anti")


def with_iso3(rainfall_year: DataFrame, mapping: DataFrame, *, on: str = "COUNTRY_CODE") -> DataFrame:
    """Attach ISO3 and mark codes shared by several rows.

    ``mapping`` has the key column and ISO3. Rows without a mapping are kept with a
    null ISO3. AMBIGUOUS is true where one ISO3 stands for more than one row of a year,
    so that a map can leave both out. A key with several ISO3 values gets none of them: they are
    listed in ISO3_CONFLICT, null elsewhere, and the row is AMBIGUOUS. The window runs over one
    year's countries.
    """
    key = F.upper(F.trim(on)).alias("map_key")
    values = F.array_sort(F.collect_set("ISO3"))
    several = F.size("all") > 1
    keyed = mapping.groupBy(key).agg(values.alias("all")).select("map_key", F.when(~several, F.get("all", F.lit(0))).alias("ISO3"), F.when(several, F.col("all")).alias("ISO3_CONFLICT"))
    shared = F.count("ISO3").over(Window.partitionBy("YEAR", "ISO3")) > 1
    return (
        rainfall_year.select("*", key)
        .join(keyed, "map_key", "left")
        .drop("map_key")
        .withColumn("AMBIGUOUS", (F.col("ISO3").isNotNull() & shared) | F.col("ISO3_CONFLICT").isNotNull())
    )


def mapping_summary(mapped: DataFrame) -> DataFrame:
    """Rows matched, unmatched, distinct codes, and rows a map can show."""
    matched = F.col("ISO3").isNotNull()
    return mapped.agg(
        F.count_if(matched).alias("N_MATCHED"),
        F.count_if(~matched).alias("N_UNMATCHED"),
        F.count_distinct("ISO3").alias("N_ISO3"),
        F.count_if(matched & ~F.col("AMBIGUOUS")).alias("N_SHOWN"),
    )


def with_display_cap(rainfall_year: DataFrame, percent: int = 95) -> DataFrame:
    """Add SHOWN: the mean capped at an upper percentile of its year. The true mean stays.

    The window runs over one year's countries and saves computing the means twice.
    """
    cap = F.percentile(MEAN, percent / 100.0).over(Window.partitionBy("YEAR"))
    capped = F.when(F.col(MEAN).isNotNull(), F.least(F.col(MEAN), cap))
    return rainfall_year.withColumn("SHOWN", capped)
