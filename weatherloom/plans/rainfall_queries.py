"""Queries over country-year means and the map table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.operators import rainfall
from weatherloom.operators.enrich import with_name
from weatherloom.plans import standins as D
from weatherloom.plans.registry import query
from weatherloom.sources import observations, sinks

YEAR = 1997


def _means(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return rainfall.country_year_means(
        D.order_observations(spark, sf_dir), D.customer_stations(spark, sf_dir), **options
    )


def _year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.means_for_year(_means(spark, sf_dir), YEAR)


_COLUMNS = "YEAR, COUNTRY_CODE, round(AVG_DAILY_PRCP_MM, 6) AS AVG_DAILY_PRCP_MM, N_OBSERVATIONS, N_STATIONS"


@query("country_year_means", D.given("rainfall", then=f"SELECT {_COLUMNS} FROM rainfall"))
def country_year_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _means(spark, sf_dir)


@query(
    "country_year_means_named",
    D.given(
        "rainfall", "countries",
        then=f"""SELECT r.*, c.NAME AS COUNTRY_NAME FROM (SELECT {_COLUMNS} FROM rainfall) r
                 LEFT JOIN countries c ON r.COUNTRY_CODE = c.CODE""",
    ),
)
def country_year_means_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = with_name(D.customer_stations(spark, sf_dir), D.countries(spark, sf_dir), "COUNTRY_CODE", "COUNTRY_NAME")
    return rainfall.country_year_means(D.order_observations(spark, sf_dir), stations)


@query(
    "country_year_means_clean",
    D.given(
        "daily", "stations",
        then="""
        SELECT YEAR, COUNTRY_CODE, round(sum(VALUE) / count(VALUE) / 10e0, 6) AS AVG_DAILY_PRCP_MM,
               count(*) AS N_OBSERVATIONS, count(DISTINCT d.ID) AS N_STATIONS
        FROM daily d JOIN stations s ON d.ID = s.ID
        WHERE ELEMENT = 'PRCP' AND coalesce(trim(QUALITY_FLAG), '') = '' AND YEAR <> 1995
        GROUP BY YEAR, COUNTRY_CODE""",
    ),
)
def country_year_means_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _means(spark, sf_dir, quality="ok", without_years=(1995,))


@query(
    "country_year_means_from_rollup",
    D.given(
        "lines", "suppliers",
        then="""
        SELECT CAST(year(DATE) AS BIGINT) AS YEAR, COUNTRY_CODE,
               round(sum(VALUE) / count(VALUE) / 10e0, 6) AS AVG_DAILY_PRCP_MM,
               count(*) AS N_OBSERVATIONS, count(DISTINCT l.ID) AS N_STATIONS
        FROM lines l JOIN suppliers s ON l.ID = s.ID WHERE ELEMENT = 'PRCP' GROUP BY 1, 2""",
    ),
)
def country_year_means_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = observations.rollup_observations(D.line_observations(spark, sf_dir))
    path = sinks.save(rollup, sinks.shared_path(spark, "rollup"))
    return rainfall.country_year_means(
        spark.read.parquet(path), D.supplier_stations(spark, sf_dir)
    )


@query(
    "country_year_means_missing_values",
    D.given(
        "happened", "stations",
        then="""
        SELECT CAST(year(DATE) AS BIGINT) AS YEAR, COUNTRY_CODE,
               round(sum(VALUE) / count(VALUE) / 10e0, 6) AS AVG_DAILY_PRCP_MM,
               count(*) AS N_OBSERVATIONS, count(DISTINCT h.ID) AS N_STATIONS
        FROM happened h JOIN stations s ON h.ID = s.ID WHERE ELEMENT = 'PRCP' GROUP BY 1, 2""",
    ),
)
def country_year_means_missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.country_year_means(
        D.event_observations(spark, sf_dir), D.customer_stations(spark, sf_dir)
    )


@query("means_for_year", D.given("rainfall", then=f"SELECT {_COLUMNS} FROM rainfall WHERE YEAR = {YEAR}"))
def means_for_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _year(spark, sf_dir)


@query(
    "describe_means",
    D.given(
        "rainfall",
        then="""
        SELECT count(m) AS N, round(avg(m), 6) AS MEAN, round(stddev_samp(m), 6) AS STDDEV,
               round(min(m), 6) AS MIN, round(quantile_cont(m, 0.25), 6) AS P25,
               round(quantile_cont(m, 0.5), 6) AS P50, round(quantile_cont(m, 0.75), 6) AS P75,
               round(max(m), 6) AS MAX
        FROM (SELECT AVG_DAILY_PRCP_MM AS m FROM rainfall)""",
    ),
)
def describe_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.describe_means(_means(spark, sf_dir))


@query(
    "mean_percentiles",
    D.given(
        "rainfall",
        then=f"""
        SELECT round(quantile_cont(AVG_DAILY_PRCP_MM, 0.9), 6) AS P90,
               round(quantile_cont(AVG_DAILY_PRCP_MM, 0.95), 6) AS P95,
               round(quantile_cont(AVG_DAILY_PRCP_MM, 0.99), 6) AS P99
        FROM rainfall WHERE YEAR = {YEAR}""",
    ),
)
def mean_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.mean_percentiles(_year(spark, sf_dir))


@query(
    "sparse_counts",
    D.given(
        "rainfall",
        then="""
        SELECT count(*) FILTER (N_OBSERVATIONS <= 3) AS N_AT_MOST_3,
               count(*) FILTER (N_OBSERVATIONS <= 10) AS N_AT_MOST_10,
               count(*) FILTER (N_OBSERVATIONS <= 30) AS N_AT_MOST_30
        FROM rainfall""",
    ),
)
def sparse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.sparse_counts(_means(spark, sf_dir))


@query("sparse_rows", D.given("rainfall", then=f"SELECT {_COLUMNS} FROM rainfall WHERE N_OBSERVATIONS <= 12"))
def sparse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.sparse_rows(_means(spark, sf_dir), 12)


_HIGHEST = """
    SELECT *, COUNTRY_CODE || ' (' || CAST(YEAR AS VARCHAR) || ')' AS LABEL FROM rainfall
    ORDER BY AVG_DAILY_PRCP_MM DESC, YEAR, COUNTRY_CODE LIMIT {n}"""


@query(
    "highest_means",
    D.given("rainfall", then=f"SELECT {_COLUMNS}, LABEL FROM ({_HIGHEST.format(n=20)})"),
)
def highest_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.highest_means(_means(spark, sf_dir))


@query(
    "highest_mean",
    D.given("rainfall", then=f"SELECT {_COLUMNS}, LABEL FROM ({_HIGHEST.format(n=1)})"),
)
def highest_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.highest_means(_means(spark, sf_dir), 1)


@query(
    "observations_behind",
    D.given(
        "rainfall",
        then=f"""
        SELECT s.COUNTRY_CODE, d.YEAR, d.ID, d.DATE, d.VALUE
        FROM daily d JOIN stations s ON d.ID = s.ID
             JOIN ({_HIGHEST.format(n=3)}) h ON h.YEAR = d.YEAR AND h.COUNTRY_CODE = s.COUNTRY_CODE
        WHERE d.ELEMENT = 'PRCP'""",
    ),
)
def observations_behind(spark: SparkSession, sf_dir: str) -> DataFrame:
    highest = rainfall.highest_means(_means(spark, sf_dir), 3)
    rows = rainfall.observations_behind(
        D.order_observations(spark, sf_dir), D.customer_stations(spark, sf_dir), highest
    )
    return rows.select("COUNTRY_CODE", "YEAR", "ID", "DATE", "VALUE")


@query(
    "countries_without_data",
    D.given(
        "rainfall",
        then="""SELECT DISTINCT COUNTRY_CODE FROM stations WHERE COUNTRY_CODE NOT IN
                (SELECT COUNTRY_CODE FROM rainfall WHERE YEAR = 2001 AND N_OBSERVATIONS > 10)""",
    ),
)
def countries_without_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries with stations but no mean resting on more than ten observations."""
    solid = rainfall.means_for_year(_means(spark, sf_dir), 2001).where(F.col("N_OBSERVATIONS") > 10)
    return rainfall.countries_without_data(D.customer_stations(spark, sf_dir), solid)


def _iso_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region 3 shares one code, region 4 has none."""
    region, code = F.col("n_regionkey"), F.char(F.col("n_nationkey") + 65)
    return (
        D.table(spark, sf_dir, "nation")
        .where(region != 4)
        .select(
            F.concat(F.lit("N"), code).alias("COUNTRY_CODE"),
            F.when(region == 3, "SHA").otherwise(F.concat(F.lit("IS"), code)).alias("ISO3"),
        )
    )


_MAPPED = f"""
    SELECT r.*, m.ISO3,
           m.ISO3 IS NOT NULL AND count(m.ISO3) OVER (PARTITION BY m.ISO3) > 1 AS AMBIGUOUS,
           least(AVG_DAILY_PRCP_MM, (SELECT quantile_cont(AVG_DAILY_PRCP_MM, 0.95) FROM rainfall WHERE YEAR = {YEAR})) AS SHOWN
    FROM (SELECT * FROM rainfall WHERE YEAR = {YEAR}) r LEFT JOIN (
        SELECT 'N' || chr(n_nationkey + 65) AS CODE,
               CASE WHEN n_regionkey = 3 THEN 'SHA' ELSE 'IS' || chr(n_nationkey + 65) END AS ISO3
        FROM nation WHERE n_regionkey <> 4) m ON r.COUNTRY_CODE = m.CODE"""


@query(
    "map_table",
    D.given("rainfall", then=f"SELECT {_COLUMNS}, ISO3, AMBIGUOUS, round(SHOWN, 6) AS SHOWN FROM ({_MAPPED})"),
)
def map_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = rainfall.with_iso3(_year(spark, sf_dir), _iso_mapping(spark, sf_dir)).drop("ISO3_CONFLICT")
    return rainfall.with_display_cap(mapped)


@query(
    "mapping_summary",
    D.given(
        "rainfall",
        then=f"""
        SELECT count(ISO3) AS N_MATCHED, count(*) - count(ISO3) AS N_UNMATCHED,
               count(DISTINCT ISO3) AS N_ISO3,
               count(*) FILTER (ISO3 IS NOT NULL AND NOT AMBIGUOUS) AS N_SHOWN
        FROM ({_MAPPED})""",
    ),
)
def mapping_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.mapping_summary(
        rainfall.with_iso3(_year(spark, sf_dir), _iso_mapping(spark, sf_dir))
    )
