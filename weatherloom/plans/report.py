"""From the raw files to every published table.

``prepare`` reads the raw files once and lands what all questions share; ``answers``
builds one lazy DataFrame per question from that. Questions about whole stations, years
or elements read the rollup, a small fraction of the observations.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.operators import counts, enrich, gaps, integrity, pairs, rainfall, series, unpaired
from weatherloom.sources import dimensions, files, observations, sinks


@dataclass(frozen=True)
class Tables:
    """The landed tables; ``facts`` holds the raw files' paths and sizes, ``out`` is where all are."""

    daily: DataFrame
    rollup: DataFrame
    enriched: DataFrame
    countries: DataFrame
    inventory: DataFrame
    facts: DataFrame
    out: str

    def land(self, df: DataFrame, name: str) -> DataFrame:
        """Write what several answers share; a path of its own, as earlier answers may still read theirs."""
        path = sinks.save(df, f"{self.out}/{name}-{uuid.uuid4().hex}")
        return df.sparkSession.read.schema(df.schema).parquet(path)


def prepare(
    spark: SparkSession,
    *,
    daily: str,
    stations: str,
    countries: str,
    states: str,
    inventory: str,
    out: str,
    active_year: int = enrich.ACTIVE_YEAR,
) -> Tables:
    """Land observations by year, their rollup by year, and enriched stations by country."""
    raw = dimensions.read_dimensions(
        spark, stations=stations, countries=countries, states=states, inventory=inventory
    )
    facts = files.file_facts(spark, daily)
    landed_path = observations.land_observations(
        observations.read_observations(spark, daily), f"{out}/observations", facts=facts
    )
    landed = observations.read_landed(spark, landed_path)
    rollup_path = sinks.save(
        sinks.packed_by(observations.rollup_observations(landed), "YEAR"),
        f"{out}/rollup",
        by=["YEAR"],
    )
    enriched_path = sinks.save(
        sinks.packed_by(enrich.enrich_stations(**raw, active_year=active_year), "COUNTRY_CODE", 3),
        f"{out}/stations",
        by=["COUNTRY_CODE"],
    )
    return Tables(
        daily=landed,
        rollup=spark.read.parquet(rollup_path),
        enriched=spark.read.parquet(enriched_path),
        countries=raw["countries"],
        inventory=raw["inventory"],
        facts=facts,
        out=out,
    )


def station_answers(tables: Tables, *, active_year: int = enrich.ACTIVE_YEAR) -> dict[str, DataFrame]:
    """Counts of stations and the agreement of stations, inventory and observations."""
    enriched, rollup = tables.enriched, tables.rollup
    return {
        "total_stations": counts.total_stations(enriched),
        "network_counts": counts.network_counts(enriched),
        "southern_count": counts.southern_count(enriched),
        "territory_totals": counts.territory_totals(enriched),
        "stations_per_country": counts.stations_per_country(enriched, tables.countries),
        "flag_counts": enrich.flag_counts(enriched, active_year=active_year),
        "state_countries": enrich.state_countries(enriched),
        "inventory_integrity": integrity.inventory_integrity(enriched, tables.inventory),
        "missing_from_observations": integrity.missing_from_observations(enriched, rollup),
        "unknown_in_observations": integrity.unknown_in_observations(rollup, enriched),
        "activity_comparison": counts.activity_comparison(rollup, enriched, active_year),
    }


def observation_answers(tables: Tables) -> dict[str, DataFrame]:
    """File sizes, element counts and unpaired observations."""
    return {
        "sizes": files.size_shares(tables.facts, "year"),
        "year_coverage": gaps.year_coverage(tables.facts, "year"),
        "missing_years": gaps.missing_years(tables.facts, "year"),
        "element_counts": counts.element_counts(tables.rollup),
        "element_profile": counts.element_profile(tables.rollup),
        "unpaired_summary": unpaired.unpaired_summary(tables.daily),
    }


def country_answers(tables: Tables, country: str = "NZ") -> dict[str, DataFrame]:
    """One country's stations, distances and temperature series.

    The country's temperatures and their monthly means are landed first, so the
    observations are read once for all answers.
    """
    local = counts.country_stations(tables.enriched, country)
    temperatures = tables.land(
        series.temperature_observations(tables.daily, tables.enriched, country=country), f"temperatures-{country}"
    )
    monthly = tables.land(series.monthly_means(temperatures), f"monthly-{country}")
    return {
        "stations": local,
        "closest_pair": pairs.closest_pair(local),
        "coverage": gaps.coverage(temperatures, by=()),
        "gap_years": gaps.gap_years(temperatures),
        "gap_runs": gaps.gap_runs(temperatures, by=()),
        "missing_days": gaps.missing_days(temperatures, by=()),
        "monthly_means": monthly,
        "monthly_pivot": series.monthly_pivot(temperatures),
        "dense_months": series.dense_months(series.rolling_mean(monthly)),
        "country_rolling_mean": series.rolling_mean(
            series.country_monthly_means(temperatures), by=("ELEMENT",)
        ),
    }


def rainfall_answers(
    tables: Tables, *, year: int, without_years: tuple[int, ...] = (), mapping: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Country-year rainfall with its statistics, doubts and the map table of one year.

    The means, one row per country and year, are landed first.
    ``mapping`` (the key column and ISO3) is the caller's; without one the map table has no ISO3.
    """
    means = tables.land(
        rainfall.country_year_means(
            tables.rollup,
            tables.enriched.select("ID", "COUNTRY_CODE", "COUNTRY_NAME"),
            without_years=without_years,
        ),
        "rainfall-means",
    )
    highest = rainfall.highest_means(means)
    of_year = rainfall.means_for_year(means, year)
    mapped = of_year
    if mapping is not None:
        mapped = rainfall.with_iso3(of_year, mapping, on=next(c for c in mapping.columns if c != "ISO3"))
    return {
        "country_year_means": means,
        "describe": rainfall.describe_means(means),
        "highest": highest,
        "behind_the_highest": rainfall.observations_behind(tables.daily, tables.enriched, highest.limit(1)),
        "of_year": of_year,
        "describe_year": rainfall.describe_means(of_year),
        "percentiles": rainfall.mean_percentiles(of_year),
        "sparse_counts": rainfall.sparse_counts(of_year),
        "sparse_rows": rainfall.sparse_rows(of_year),
        "map_table": rainfall.with_display_cap(mapped),
        "without_data": rainfall.countries_without_data(tables.enriched, of_year).join(
            tables.countries.select(F.col("CODE").alias("COUNTRY_CODE"), "NAME"), "COUNTRY_CODE", "left"
        ),
    }
