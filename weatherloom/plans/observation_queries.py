"""Queries over observations: integrity, counts, series, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.functions import columns as C
from weatherloom.operators import counts, enrich, gaps, integrity, series, unpaired
from weatherloom.plans import standins as D
from weatherloom.plans.registry import query
from weatherloom.sources import observations, sinks


# Columns ------------------------------------------------------------------------


@query(
    "calendar_columns",
    D.given(
        "daily",
        then="""
        SELECT YEAR, MONTH, YEAR_MONTH, count(*) AS N, count(DAY) AS N_DAYS
        FROM (SELECT YEAR, CAST(substr(D, 5, 2) AS BIGINT) AS MONTH,
                     CAST(strptime(substr(D, 1, 6) || '01', '%Y%m%d') AS DATE) AS YEAR_MONTH,
                     CAST(try_strptime(D, '%Y%m%d') AS DATE) AS DAY
              FROM (SELECT YEAR, CASE WHEN QUALITY_FLAG = 'X' THEN substr(DATE, 1, 6) || '31' ELSE DATE END AS D
                    FROM daily))
        GROUP BY YEAR, MONTH, YEAR_MONTH""",
    ),
)
def calendar_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates that do not exist lose their day, never their year or month."""
    damaged = F.when(F.col("QUALITY_FLAG") == "X", F.concat(F.substring("DATE", 1, 6), F.lit("31")))
    daily = D.order_observations(spark, sf_dir).withColumn("DATE", F.coalesce(damaged, F.col("DATE")))
    return (
        C.with_calendar(daily)
        .groupBy("YEAR", "MONTH", "YEAR_MONTH")
        .agg(F.count(F.lit(1)).alias("N"), F.count("DAY").alias("N_DAYS"))
    )


@query(
    "quality_filter",
    D.given(
        "daily",
        then="""SELECT ID, DATE, ELEMENT, VALUE, QUALITY_FLAG FROM daily
                WHERE QUALITY_FLAG IS NULL OR trim(QUALITY_FLAG) = ''""",
    ),
)
def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = observations.filter_quality(D.order_observations(spark, sf_dir), "ok")
    return kept.select("ID", "DATE", "ELEMENT", "VALUE", "QUALITY_FLAG")


@query(
    "scaled_values",
    D.given(
        "daily",
        then="""
        SELECT ID, DATE, ELEMENT,
               CASE WHEN ELEMENT IN ('PRCP', 'TMAX', 'TMIN') THEN VALUE / 10e0 ELSE VALUE END AS SCALED,
               CASE WHEN ELEMENT IN ('PRCP', 'SNOW', 'SNWD') THEN 'mm' ELSE '°C' END AS UNIT
        FROM daily""",
    ),
)
def scaled_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    element = F.col("ELEMENT")
    return D.order_observations(spark, sf_dir).select(
        "ID", "DATE", "ELEMENT",
        C.in_units(element, F.col("VALUE")).alias("SCALED"),
        C.unit_name(element).alias("UNIT"),
    )


# Integrity ----------------------------------------------------------------------


@query("distinct_ids", D.given("lines", then="SELECT DISTINCT ID FROM lines"))
def distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.distinct_ids(D.line_observations(spark, sf_dir))


@query(
    "known_ids",
    D.given("happened", "suppliers", then="SELECT DISTINCT ID FROM happened WHERE ID IN (SELECT ID FROM suppliers)"),
)
def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.known_ids(D.event_observations(spark, sf_dir), D.supplier_stations(spark, sf_dir))


@query(
    "missing_from_observations",
    D.given(
        "stations", "happened",
        then="SELECT DISTINCT ID FROM stations s WHERE NOT EXISTS (SELECT 1 FROM happened h WHERE h.ID = s.ID)",
    ),
)
def missing_from_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.missing_from_observations(
        D.customer_stations(spark, sf_dir), D.event_observations(spark, sf_dir)
    )


@query(
    "unknown_in_observations",
    D.given(
        "suppliers", "happened",
        then="SELECT DISTINCT ID FROM happened h WHERE NOT EXISTS (SELECT 1 FROM suppliers s WHERE h.ID = s.ID)",
    ),
)
def unknown_in_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.unknown_in_observations(
        D.event_observations(spark, sf_dir), D.supplier_stations(spark, sf_dir)
    )


@query(
    "unlabelled_documents",
    "SELECT DISTINCT doc_id AS ID FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def unlabelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = D.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ID"))
    labels = D.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ID"))
    return integrity.unknown_in_observations(documents, labels)


@query(
    "observations_of",
    D.given("happened", "suppliers", then="SELECT * FROM happened WHERE ID IN (SELECT ID FROM suppliers)"),
)
def observations_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.observations_of(D.event_observations(spark, sf_dir), D.supplier_stations(spark, sf_dir))


@query(
    "with_station_columns",
    D.given(
        "happened", "suppliers",
        then="SELECT h.*, s.NAME, s.COUNTRY_CODE FROM happened h LEFT JOIN suppliers s ON h.ID = s.ID",
    ),
)
def with_station_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = D.supplier_stations(spark, sf_dir).select("ID", "NAME", "COUNTRY_CODE")
    return integrity.with_station_columns(D.event_observations(spark, sf_dir), stations)


# Counts -------------------------------------------------------------------------


@query(
    "element_counts",
    D.given(
        "happened",
        then="""
        SELECT ELEMENT, count(*) AS N_OBSERVATIONS, round(count(*) / sum(count(*)) OVER (), 6) AS SHARE
        FROM happened WHERE ELEMENT <> 'WT01' GROUP BY ELEMENT""",
    ),
)
def element_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.element_counts(D.event_observations(spark, sf_dir))


@query(
    "element_profile",
    D.given(
        "happened",
        then="""
        SELECT count(DISTINCT ELEMENT) AS N_ELEMENTS, count(*) AS N_ROWS,
               count(*) FILTER (ELEMENT <> 'WT01') AS N_CORE_ROWS,
               round(count(*) FILTER (ELEMENT <> 'WT01') / count(*), 6) AS CORE_SHARE
        FROM happened""",
    ),
)
def element_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.element_profile(D.event_observations(spark, sf_dir))


_ROLLUP = """
    SELECT CAST(year(DATE) AS BIGINT) AS YEAR, ID, ELEMENT, count(*) AS N_OBSERVATIONS,
           count(VALUE) AS N_VALUES, sum(VALUE) AS SUM_VALUE,
           min(DATE) AS FIRST_DAY, max(DATE) AS LAST_DAY
    FROM lines GROUP BY 1, 2, 3"""


@query("rollup_observations", D.given("lines", then=_ROLLUP))
def rollup_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations.rollup_observations(D.line_observations(spark, sf_dir))


@query(
    "element_counts_from_rollup",
    D.given(
        "lines",
        then="""
        SELECT ELEMENT, count(*) AS N_OBSERVATIONS, round(count(*) / sum(count(*)) OVER (), 6) AS SHARE
        FROM lines GROUP BY ELEMENT""",
    ),
)
def element_counts_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the rollup once; counts then read a fraction of the observations."""
    rollup = observations.rollup_observations(D.line_observations(spark, sf_dir))
    path = sinks.save(rollup, sinks.shared_path(spark, "rollup"))
    return counts.element_counts(spark.read.parquet(path))


@query(
    "active_count",
    D.given("daily", then="SELECT count(DISTINCT ID) AS N_ACTIVE FROM daily WHERE YEAR = 2001"),
)
def active_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.active_count(D.order_observations(spark, sf_dir), 2001)


@query(
    "activity_comparison",
    D.given(
        "daily", "metrics",
        then="""
        SELECT count(o) AS N_BY_OBSERVATIONS, count(i) AS N_BY_INVENTORY, count(o) - count(i) AS DIFFERENCE,
               count(*) FILTER (i IS NULL) AS N_ONLY_OBSERVATIONS,
               count(*) FILTER (o IS NULL) AS N_ONLY_INVENTORY
        FROM (SELECT DISTINCT ID AS o FROM daily WHERE YEAR = 2001) a
             FULL JOIN (SELECT ID AS i FROM metrics WHERE ACTIVE) b ON a.o = b.i""",
    ),
)
def activity_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = enrich.inventory_metrics(D.inventory(spark, sf_dir), active_year=2001)
    return counts.activity_comparison(D.order_observations(spark, sf_dir), metrics, 2001)


# Unpaired -----------------------------------------------------------------------

_UNPAIRED = """
    SELECT ID, DATE FROM {facts} x WHERE ELEMENT = 'TMAX' AND NOT EXISTS
        (SELECT 1 FROM {facts} n WHERE n.ELEMENT = 'TMIN' AND n.ID = x.ID AND n.DATE = x.DATE)"""


@query(
    "unpaired_days",
    D.given(
        "lines",
        then=f"SELECT ID, DATE, count(*) AS N_OBSERVATIONS FROM ({_UNPAIRED.format(facts='lines')}) GROUP BY ID, DATE",
    ),
)
def unpaired_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpaired.unpaired_days(D.line_observations(spark, sf_dir))


@query(
    "unpaired_summary",
    D.given(
        "lines",
        then=f"SELECT count(*) AS N_OBSERVATIONS, count(DISTINCT ID) AS N_STATIONS FROM ({_UNPAIRED.format(facts='lines')})",
    ),
)
def unpaired_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpaired.unpaired_summary(D.line_observations(spark, sf_dir))


@query("unpaired_observations", D.given("happened", then=_UNPAIRED.format(facts="happened")))
def unpaired_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpaired.unpaired_observations(D.event_observations(spark, sf_dir))


# Series -------------------------------------------------------------------------


@query(
    "temperature_observations",
    D.given(
        "lines", "suppliers",
        then="""
        SELECT l.*, s.NAME, round(VALUE / 10e0, 6) AS TEMP_C
        FROM lines l JOIN suppliers s ON l.ID = s.ID
        WHERE ELEMENT IN ('TMIN', 'TMAX') AND COUNTRY_CODE = 'NP'""",
    ),
)
def temperature_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.temperature_observations(
        D.line_observations(spark, sf_dir), D.supplier_stations(spark, sf_dir), country="NP"
    )


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    temperatures = D.line_observations(spark, sf_dir).where(F.col("ELEMENT").isin(*series.TEMPERATURES))
    return series.monthly_means(temperatures, D.supplier_stations(spark, sf_dir))


@query(
    "monthly_means",
    D.given("monthly", then="SELECT ID, NAME, ELEMENT, YEAR_MONTH, round(TEMP_C, 6) AS TEMP_C FROM monthly"),
)
def monthly_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, sf_dir)


@query(
    "country_monthly_means",
    D.given(
        "temperatures",
        then="""SELECT ELEMENT, YEAR_MONTH, round(sum(VALUE) / count(VALUE) / 10e0, 6) AS TEMP_C
                FROM temperatures GROUP BY ELEMENT, YEAR_MONTH""",
    ),
)
def country_monthly_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.country_monthly_means(D.line_temperatures(spark, sf_dir))


@query(
    "country_monthly_means_by_station",
    D.given(
        "monthly",
        then="SELECT ELEMENT, YEAR_MONTH, round(avg(TEMP_C), 6) AS TEMP_C FROM monthly GROUP BY ELEMENT, YEAR_MONTH",
    ),
)
def country_monthly_means_by_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.country_monthly_means(D.line_temperatures(spark, sf_dir), weighting="station")


@query(
    "monthly_pivot",
    D.given(
        "monthly",
        then="""SELECT ID, YEAR_MONTH, round(max(TEMP_C) FILTER (ELEMENT = 'TMIN'), 6) AS TMIN,
                       round(max(TEMP_C) FILTER (ELEMENT = 'TMAX'), 6) AS TMAX
                FROM monthly GROUP BY ID, YEAR_MONTH""",
    ),
)
def monthly_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.monthly_pivot(D.line_temperatures(spark, sf_dir))


_DENSE = """,
    spine AS (
        SELECT ID, ELEMENT, CAST(m AS DATE) AS YEAR_MONTH
        FROM (SELECT DISTINCT ID, ELEMENT FROM monthly),
             (SELECT unnest(generate_series(min(YEAR_MONTH), max(YEAR_MONTH), INTERVAL 1 MONTH)) AS m FROM monthly)),
    dense AS (
        SELECT s.ID, s.ELEMENT, s.YEAR_MONTH, TEMP_C,
               CASE WHEN count(TEMP_C) OVER w = 12 THEN avg(TEMP_C) OVER w END AS ROLLING_C
        FROM spine s LEFT JOIN monthly m
             ON s.ID = m.ID AND s.ELEMENT = m.ELEMENT AND s.YEAR_MONTH = m.YEAR_MONTH
        WINDOW w AS (PARTITION BY s.ID, s.ELEMENT ORDER BY s.YEAR_MONTH ROWS 11 PRECEDING))"""


def _given_dense(then: str) -> str:
    # The spine builds on "monthly", so it follows the tables it needs.
    head, _, tail = D.given("monthly", then="@@").partition(" @@")
    return f"{head}{_DENSE} {then}{tail}"


@query(
    "rolling_mean",
    _given_dense(
        """SELECT ID, ELEMENT, YEAR_MONTH, round(TEMP_C, 6) AS TEMP_C, round(ROLLING_C, 6) AS ROLLING_C
           FROM dense WHERE TEMP_C IS NOT NULL"""
    ),
)
def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.rolling_mean(_monthly(spark, sf_dir)).drop("NAME")


@query(
    "dense_months",
    _given_dense(
        "SELECT ID, ELEMENT, YEAR_MONTH, round(TEMP_C, 6) AS TEMP_C, round(ROLLING_C, 6) AS ROLLING_C FROM dense"
    ),
)
def dense_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = _monthly(spark, sf_dir)
    path = sinks.save(monthly, sinks.shared_path(spark, "monthly"))
    return series.dense_months(series.rolling_mean(spark.read.parquet(path)))


@query(
    "country_rolling_mean",
    D.given(
        "temperatures",
        then="""
        SELECT ELEMENT, YEAR_MONTH, round(TEMP_C, 6) AS TEMP_C,
               round(CASE WHEN count(*) OVER w = 12 THEN avg(TEMP_C) OVER w END, 6) AS ROLLING_C
        FROM (SELECT ELEMENT, YEAR_MONTH, sum(VALUE) / count(VALUE) / 10e0 AS TEMP_C
              FROM temperatures GROUP BY ELEMENT, YEAR_MONTH)
        WINDOW w AS (PARTITION BY ELEMENT ORDER BY YEAR_MONTH
                     RANGE BETWEEN INTERVAL 11 MONTH PRECEDING AND CURRENT ROW)""",
    ),
)
def country_rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = series.country_monthly_means(D.line_temperatures(spark, sf_dir))
    return series.rolling_mean(means, by=("ELEMENT",))


# Gaps ---------------------------------------------------------------------------

_DAY_GAPS = """,
    days AS (SELECT DISTINCT {by}, DATE FROM {facts}),
    spans AS (SELECT {by}, min(DATE) AS lo, max(DATE) AS hi FROM days GROUP BY {by}),
    calendar AS (SELECT {by}, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS DAY FROM spans),
    missing AS (SELECT c.* FROM calendar c WHERE NOT EXISTS
        (SELECT 1 FROM days d WHERE d.{by} = c.{by} AND d.DATE = c.DAY))"""

_RUNS = """
    SELECT {by}, min(DAY) AS GAP_START, max(DAY) AS GAP_END, count(*) AS N_DAYS
    FROM (SELECT *, DAY - CAST(row_number() OVER (PARTITION BY {by} ORDER BY DAY) AS INTEGER) AS island FROM missing)
    GROUP BY {by}, island"""


def _given_gaps(facts: str, by: str, then: str) -> str:
    head, _, tail = D.given(facts, then="@@").partition(" @@")
    return f"{head}{_DAY_GAPS.format(by=by, facts=facts)} {then.format(by=by)}{tail}"


@query("missing_days", _given_gaps("happened", "ID", "SELECT {by}, DAY FROM missing"))
def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.missing_days(D.event_observations(spark, sf_dir))


@query("gap_runs", _given_gaps("lines", "ID", _RUNS))
def gap_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.gap_runs(D.line_observations(spark, sf_dir))


@query("gap_runs_by_element", _given_gaps("lines", "ELEMENT", _RUNS))
def gap_runs_by_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.gap_runs(D.line_observations(spark, sf_dir), by=("ELEMENT",))


_COVERAGE = """
    SELECT {by}, count(*) AS N_OBSERVATIONS, count(DISTINCT year(DATE)) AS N_YEARS,
           min(DATE) AS FIRST_DAY, max(DATE) AS LAST_DAY,
           max(DATE) - min(DATE) + 1 AS EXPECTED_DAYS, count(DISTINCT DATE) AS OBSERVED_DAYS,
           max(DATE) - min(DATE) + 1 - count(DISTINCT DATE) AS MISSING_DAYS
    FROM lines GROUP BY {by}"""


@query("coverage", D.given("lines", then=_COVERAGE.format(by="ID")))
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.coverage(D.line_observations(spark, sf_dir))


@query("coverage_by_element", D.given("lines", then=_COVERAGE.format(by="ELEMENT")))
def coverage_by_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.coverage(D.line_observations(spark, sf_dir), by=("ELEMENT",))


def _country_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.temperature_observations(
        D.line_observations(spark, sf_dir), D.supplier_stations(spark, sf_dir), country="NP"
    )


_COUNTRY_DAYS = """,
    country AS (SELECT DATE FROM temperatures t
                WHERE ID IN (SELECT ID FROM suppliers WHERE COUNTRY_CODE = 'NP')),
    missing AS (
        SELECT DAY FROM (SELECT CAST(unnest(generate_series(min(DATE), max(DATE), INTERVAL 1 DAY)) AS DATE) AS DAY
                         FROM country)
        WHERE DAY NOT IN (SELECT DATE FROM country))"""


def _given_country_days(then: str) -> str:
    head, _, tail = D.given("temperatures", then="@@").partition(" @@")
    return f"{head}{_COUNTRY_DAYS} {then}{tail}"


@query(
    "country_coverage",
    _given_country_days(
        """
        SELECT count(*) AS N_OBSERVATIONS, count(DISTINCT year(DATE)) AS N_YEARS,
               min(DATE) AS FIRST_DAY, max(DATE) AS LAST_DAY,
               max(DATE) - min(DATE) + 1 AS EXPECTED_DAYS, count(DISTINCT DATE) AS OBSERVED_DAYS,
               max(DATE) - min(DATE) + 1 - count(DISTINCT DATE) AS MISSING_DAYS
        FROM country"""
    ),
)
def country_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.coverage(_country_temperatures(spark, sf_dir), by=())


@query("country_missing_days", _given_country_days("SELECT DAY FROM missing"))
def country_missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which no station of the country reported."""
    return gaps.missing_days(_country_temperatures(spark, sf_dir), by=())


@query(
    "country_gap_runs",
    _given_country_days(
        """
        SELECT min(DAY) AS GAP_START, max(DAY) AS GAP_END, count(*) AS N_DAYS
        FROM (SELECT DAY, DAY - CAST(row_number() OVER (ORDER BY DAY) AS INTEGER) AS island FROM missing)
        GROUP BY island"""
    ),
)
def country_gap_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.gap_runs(_country_temperatures(spark, sf_dir), by=())


@query(
    "gap_years",
    D.given(
        "daily",
        then="""
        SELECT y AS YEAR
        FROM (SELECT unnest(generate_series(min(YEAR), max(YEAR))) AS y FROM daily WHERE YEAR NOT IN (1996, 1999))
        WHERE y NOT IN (SELECT YEAR FROM daily WHERE YEAR NOT IN (1996, 1999))""",
    ),
)
def gap_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = observations.exclude_years(D.order_observations(spark, sf_dir), (1996, 1999))
    return gaps.gap_years(daily)
