"""Counts of stations and observations. Scalars come back as one-row DataFrames.

Functions that take ``daily`` accept either the observations or the table made by
``rollup_observations``: a row then stands for N_OBSERVATIONS rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.functions import columns as C


def row_total(daily: DataFrame) -> Column:
    """Aggregate that counts observation rows, in either form of the input."""
    return F.sum("N_OBSERVATIONS") if "N_OBSERVATIONS" in daily.columns else F.count(F.lit(1))


# Stations -----------------------------------------------------------------------


def total_stations(stations: DataFrame) -> DataFrame:
    return stations.select("ID").distinct().agg(F.count(F.lit(1)).alias("N_STATIONS"))


def network_counts(stations: DataFrame) -> DataFrame:
    """Members of the three networks and their overlaps, in one pass."""
    gsn, hcn, crn = (C.in_network(name) for name in ("GSN", "HCN", "CRN"))
    groups = {
        "GSN": gsn,
        "HCN": hcn,
        "CRN": crn,
        "GSN_and_HCN": gsn & hcn,
        "GSN_and_CRN": gsn & crn,
        "HCN_and_CRN": hcn & crn,
        "GSN_and_HCN_and_CRN": gsn & hcn & crn,
        "IN_MORE_THAN_ONE": gsn.cast("int") + hcn.cast("int") + crn.cast("int") > 1,
    }
    return stations.agg(*(F.count_if(member).alias(name) for name, member in groups.items()))


def southern_count(stations: DataFrame) -> DataFrame:
    return stations.agg(F.count_if(C.is_southern()).alias("N_SOUTHERN"))


def country_stations(stations: DataFrame, code: str = "NZ") -> DataFrame:
    return C.with_country_code(stations).where(F.col("COUNTRY_CODE") == code)


def country_count(stations: DataFrame, code: str = "NZ") -> DataFrame:
    return country_stations(stations, code).agg(F.count(F.lit(1)).alias("N_STATIONS"))


def territory_stations(
    enriched: DataFrame, *, owner: str = "united states", home_code: str = "US"
) -> DataFrame:
    """Stations of the owner's territories. Needs COUNTRY_NAME, so an enriched table."""
    return enriched.where(C.is_territory(owner, home_code))


def territory_count(
    enriched: DataFrame, *, owner: str = "united states", home_code: str = "US"
) -> DataFrame:
    return total_stations(territory_stations(enriched, owner=owner, home_code=home_code))


def territory_totals(
    enriched: DataFrame, *, owner: str = "united states", home_code: str = "US"
) -> DataFrame:
    """Stations per territory and, under a null name with IS_TOTAL set, all together."""
    return (
        territory_stations(enriched, owner=owner, home_code=home_code)
        .rollup("COUNTRY_NAME")
        .agg(
            F.count_distinct("ID").alias("N_STATIONS"),
            (F.grouping("COUNTRY_NAME") == 1).alias("IS_TOTAL"),
        )
    )


def stations_per_country(stations: DataFrame, countries: DataFrame) -> DataFrame:
    """Every country with its number of stations; a country without any has 0."""
    counts = (
        C.with_country_code(stations)
        .groupBy(F.col("COUNTRY_CODE").alias("CODE"))
        .agg(F.count_distinct("ID").alias("n"))
    )
    return countries.join(counts, "CODE", "left").select(
        "CODE", "NAME", F.coalesce("n", F.lit(0)).alias("N_STATIONS")
    )


# Observations -------------------------------------------------------------------


def element_counts(daily: DataFrame, *, core_only: bool = True) -> DataFrame:
    """Rows per element, most frequent first, with the share of the listed total.

    The window runs over the aggregated rows, one per element type.
    """
    rows = daily.where(C.is_core()) if core_only else daily
    return (
        rows.groupBy("ELEMENT")
        .agg(row_total(daily).alias("N_OBSERVATIONS"))
        .withColumn("SHARE", F.col("N_OBSERVATIONS") / F.sum("N_OBSERVATIONS").over(Window.partitionBy()))
        .orderBy(F.desc("N_OBSERVATIONS"), "ELEMENT")
    )


def element_profile(daily: DataFrame) -> DataFrame:
    """Element types, all rows, core rows and the core share, as one row."""
    per_element = daily.groupBy("ELEMENT").agg(row_total(daily).alias("n"))
    core_rows = F.coalesce(F.sum(F.when(C.is_core(), F.col("n"))), F.lit(0))
    return per_element.agg(
        F.count("ELEMENT").alias("N_ELEMENTS"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("N_ROWS"),
        core_rows.alias("N_CORE_ROWS"),
        F.try_divide(core_rows, F.sum("n")).alias("CORE_SHARE"),
    )


def active_ids(daily: DataFrame, year: int) -> DataFrame:
    """Distinct IDs with any row in the year; prunes to one directory of landed data."""
    return daily.where(C.year_of(daily) == year).select("ID").distinct()


def active_count(daily: DataFrame, year: int) -> DataFrame:
    return active_ids(daily, year).agg(F.count(F.lit(1)).alias("N_ACTIVE"))


def activity_comparison(daily: DataFrame, enriched: DataFrame, year: int) -> DataFrame:
    """Active by observations against active by inventory, with both set differences.

    One union and one shuffle on ID answer all of it.
    """
    sources = (
        active_ids(daily, year)
        .select("ID", F.lit(True).alias("observed"), F.lit(False).alias("listed"))
        .unionByName(
            enriched.where(F.col(f"ACTIVE_IN_{year}")).select(
                "ID", F.lit(False).alias("observed"), F.lit(True).alias("listed")
            )
        )
    )
    per_id = sources.groupBy("ID").agg(
        F.bool_or("observed").alias("observed"), F.bool_or("listed").alias("listed")
    )
    observed, listed = F.col("observed"), F.col("listed")
    return per_id.agg(
        F.count_if(observed).alias("N_BY_OBSERVATIONS"),
        F.count_if(listed).alias("N_BY_INVENTORY"),
        (F.count_if(observed) - F.count_if(listed)).alias("DIFFERENCE"),
        F.count_if(observed & ~listed).alias("N_ONLY_OBSERVATIONS"),
        F.count_if(listed & ~observed).alias("N_ONLY_INVENTORY"),
    )


#: What each row of ``station_report`` counts, by the columns that it does not sum over.
REPORT_LEVELS = ("ALL", "COUNTRY", "TERRITORY", "NETWORK", "STATE", "HEMISPHERE")


def station_report(enriched: DataFrame, *, owner: str = "united states", home_code: str = "US") -> DataFrame:
    """LEVEL, CODE, N_STATIONS: stations in all, by country, territory, network, state and hemisphere, in one pass.

    Grouping sets over one scan take the place of a query for each level. A station in two networks counts in both
    and in all once. Stations outside a level (no state, no network, no territory, no latitude) have no row there.
    """
    networks = F.filter(F.array(*(F.when(C.in_network(n), n) for n in ("GSN", "HCN", "CRN"))), lambda n: n.isNotNull())
    marked = C.with_country_code(enriched).select(
        "ID",
        F.col("COUNTRY_CODE").alias("COUNTRY"),
        F.when(C.is_territory(owner, home_code), F.col("COUNTRY_NAME")).alias("TERRITORY"),
        F.explode_outer(F.when(F.size(networks) > 0, networks)).alias("NETWORK"),
        F.nullif(F.trim("STATE"), F.lit("")).alias("STATE"),
        F.when(F.col("LATITUDE").isNotNull(), F.when(C.is_southern(), "S").otherwise("N")).alias("HEMISPHERE"),
    )
    levels = [F.col(c) for c in REPORT_LEVELS[1:]]
    grouped = marked.groupingSets([[], *([c] for c in levels)], *levels).agg(F.count_distinct("ID").alias("N_STATIONS"), F.grouping_id().alias("summed"))
    everything = (1 << len(levels)) - 1
    level = F.when(F.col("summed") == everything, REPORT_LEVELS[0])
    for place, name in enumerate(REPORT_LEVELS[1:]):
        level = level.when(F.col("summed") == everything - (1 << (len(levels) - 1 - place)), name)
    code = F.coalesce(*levels)
    rows = grouped.select(level.alias("LEVEL"), code.alias("CODE"), "N_STATIONS")
    return rows.where((F.col("LEVEL") == REPORT_LEVELS[0]) | F.col("CODE").isNotNull())
