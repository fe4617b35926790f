"""The benchmark tables seen as stations, inventory and observations.

Each table exists twice: as a DataFrame for the library and as a SQL common table
expression for the comparison. Stored values are whole numbers, as in the real files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.operators.integrity import with_station_columns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _coded(column: str, codes: dict[str, str]) -> Column:
    result = None
    for key, code in codes.items():
        match = F.col(column) == key
        result = F.when(match, code) if result is None else result.when(match, code)
    return result


def _coded_sql(column: str, codes: dict[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN '{v}'" for k, v in codes.items()) + " END"


PRIORITY_ELEMENT = {
    "1-URGENT": "PRCP",
    "2-HIGH": "SNOW",
    "3-MEDIUM": "SNWD",
    "4-NOT SPECIFIED": "TMAX",
    "5-LOW": "TMIN",
}
EVENT_ELEMENT = {
    "click": "PRCP",
    "error": "SNOW",
    "purchase": "WT01",
    "signup": "TMIN",
    "view": "TMAX",
}
FLAG_ELEMENT = {"A": "TMIN", "N": "PRCP", "R": "TMAX"}
STATUS_QUALITY = {"O": " ", "P": "X"}
SEGMENT_STATE = {"AUTOMOBILE": "0", "BUILDING": "1", "FURNITURE": "2", "HOUSEHOLD": " "}


def _nation_code(column: str) -> Column:
    return F.concat(F.lit("N"), F.char(F.col(column) + 65))


# Scattered but reproducible positions. The key is reduced before squaring, so that no
# key is large enough to overflow.
def _latitude(key: str) -> Column:
    k, small = F.col(key), F.col(key) % 1000003
    return (small * small + k * 7919) % 1700000 / 10000.0 - 85.0


def _longitude(key: str) -> Column:
    k, small = F.col(key), F.col(key) % 999983
    return (small * small * 3 + k * 104729) % 3600000 / 10000.0 - 180.0


# Stations -----------------------------------------------------------------------


def customer_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ID"),
        F.when(balance >= -900, _latitude("c_custkey")).alias("LATITUDE"),
        _longitude("c_custkey").alias("LONGITUDE"),
        F.floor(balance).cast("double").alias("ELEVATION"),
        F.when(F.col("c_nationkey") < 16, _coded("c_mktsegment", SEGMENT_STATE)).alias("STATE"),
        F.col("c_name").alias("NAME"),
        F.when(F.col("c_mktsegment") == "BUILDING", "GSN").alias("GSN_FLAG"),
        F.when(balance < 0, "CRN").when(balance > 8000, "HCN").alias("HCN_CRN_FLAG"),
        F.lit(None).cast("string").alias("WMO_ID"),
        _nation_code("c_nationkey").alias("COUNTRY_CODE"),
    )


def shared_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of which those of one segment stand at one position for each nation."""
    crowded = F.col("GSN_FLAG") == "GSN"
    nation = F.ascii(F.substring("COUNTRY_CODE", 2, 1)) - 65
    return customer_stations(spark, sf_dir).withColumns(
        {
            "LATITUDE": F.when(crowded, nation * 2.5 - 30.0).otherwise(F.col("LATITUDE")),
            "LONGITUDE": F.when(crowded, nation * 7.0).otherwise(F.col("LONGITUDE")),
        }
    )


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ID"),
        _latitude("s_suppkey").alias("LATITUDE"),
        _longitude("s_suppkey").alias("LONGITUDE"),
        F.col("s_name").alias("NAME"),
        _nation_code("s_nationkey").alias("COUNTRY_CODE"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations; those of one region bear their owner's name, one with a wrong bracket."""
    name, key = F.col("n_name"), F.col("n_nationkey")
    owned = F.when(key == 16, F.concat(name, F.lit(" [United States}"))).otherwise(
        F.concat(name, F.lit(" [United States]"))
    )
    return table(spark, sf_dir, "nation").select(
        _nation_code("n_nationkey").alias("CODE"),
        F.when(F.col("n_regionkey") == 1, owned).otherwise(name).alias("NAME"),
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("CODE"), F.col("r_name").alias("NAME")
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and element, from all orders; pending ones give an element outside the core."""
    status = F.col("o_orderstatus")
    year = F.year("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .withColumn(
            "ELEMENT", F.when(status == "P", "TAVG").otherwise(_coded("o_orderpriority", PRIORITY_ELEMENT))
        )
        .groupBy(F.col("o_custkey").alias("ID"), "ELEMENT")
        .agg(F.min(year).alias("FIRSTYEAR"), F.max(year).alias("LASTYEAR"))
    )


# Observations -------------------------------------------------------------------


def order_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight columns, DATE as ``yyyyMMdd`` text."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ID"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("DATE"),
        _coded("o_orderpriority", PRIORITY_ELEMENT).alias("ELEMENT"),
        F.floor("o_totalprice").cast("double").alias("VALUE"),
        F.lit(None).cast("string").alias("MEASUREMENT_FLAG"),
        _coded("o_orderstatus", STATUS_QUALITY).alias("QUALITY_FLAG"),
        F.substring("o_orderpriority", 1, 1).alias("SOURCE_FLAG"),
        F.lit("0630").alias("OBSERVATION_TIME"),
    )


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DATE as a date; small values are missing."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("ID"),
        F.col("ts").cast("date").alias("DATE"),
        _coded("event_type", EVENT_ELEMENT).alias("ELEMENT"),
        F.when(F.col("value") >= 1, F.floor("value").cast("double")).alias("VALUE"),
    )


def line_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest table: daily values per supplier, DATE as a date."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("ID"),
        F.col("l_shipdate").cast("date").alias("DATE"),
        _coded("l_returnflag", FLAG_ELEMENT).alias("ELEMENT"),
        F.col("l_quantity").alias("VALUE"),
    )


def line_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TMIN and TMAX of every supplier with its NAME."""
    daily = line_observations(spark, sf_dir).where(F.col("ELEMENT").isin("TMIN", "TMAX"))
    return with_station_columns(daily, supplier_stations(spark, sf_dir).select("ID", "NAME"))


# The same tables as SQL ---------------------------------------------------------

_LAT = "((({k} % 1000003) * ({k} % 1000003) + {k} * 7919) % 1700000) / 10000e0 - 85e0"
_LON = "((({k} % 999983) * ({k} % 999983) * 3 + {k} * 104729) % 3600000) / 10000e0 - 180e0"

CTES = {
    "stations": f"""
        SELECT c_custkey AS ID,
               CASE WHEN c_acctbal >= -900 THEN {_LAT.format(k='c_custkey')} END AS LATITUDE,
               {_LON.format(k='c_custkey')} AS LONGITUDE,
               CAST(floor(c_acctbal) AS DOUBLE) AS ELEVATION,
               CASE WHEN c_nationkey < 16 THEN {_coded_sql('c_mktsegment', SEGMENT_STATE)} END AS STATE,
               c_name AS NAME,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'GSN' END AS GSN_FLAG,
               CASE WHEN c_acctbal < 0 THEN 'CRN' WHEN c_acctbal > 8000 THEN 'HCN' END AS HCN_CRN_FLAG,
               CAST(NULL AS VARCHAR) AS WMO_ID,
               'N' || chr(c_nationkey + 65) AS COUNTRY_CODE
        FROM customer""",
    "shared_stations": """
        SELECT * REPLACE (
            CASE WHEN GSN_FLAG = 'GSN' THEN (ascii(substr(COUNTRY_CODE, 2, 1)) - 65) * 2.5e0 - 30e0 ELSE LATITUDE END AS LATITUDE,
            CASE WHEN GSN_FLAG = 'GSN' THEN (ascii(substr(COUNTRY_CODE, 2, 1)) - 65) * 7e0 ELSE LONGITUDE END AS LONGITUDE)
        FROM stations""",
    "sites": """
        SELECT LATITUDE, LONGITUDE, min(ID) AS ID, arg_min(NAME, ID) AS NAME, count(*) AS N
        FROM shared_stations WHERE LATITUDE IS NOT NULL GROUP BY ALL""",
    "suppliers": f"""
        SELECT s_suppkey AS ID,
               {_LAT.format(k='s_suppkey')} AS LATITUDE,
               {_LON.format(k='s_suppkey')} AS LONGITUDE,
               s_name AS NAME,
               'N' || chr(s_nationkey + 65) AS COUNTRY_CODE
        FROM supplier""",
    "countries": """
        SELECT 'N' || chr(n_nationkey + 65) AS CODE,
               CASE WHEN n_regionkey <> 1 THEN n_name
                    WHEN n_nationkey = 16 THEN n_name || ' [United States}'
                    ELSE n_name || ' [United States]' END AS NAME
        FROM nation""",
    "states": "SELECT CAST(r_regionkey AS VARCHAR) AS CODE, r_name AS NAME FROM region",
    "inventory": f"""
        SELECT o_custkey AS ID,
               CASE WHEN o_orderstatus = 'P' THEN 'TAVG'
                    ELSE {_coded_sql('o_orderpriority', PRIORITY_ELEMENT)} END AS ELEMENT,
               CAST(min(year(o_orderdate)) AS BIGINT) AS FIRSTYEAR,
               CAST(max(year(o_orderdate)) AS BIGINT) AS LASTYEAR
        FROM orders
        GROUP BY 1, 2""",
    "daily": f"""
        SELECT o_custkey AS ID,
               strftime(o_orderdate, '%Y%m%d') AS DATE,
               {_coded_sql('o_orderpriority', PRIORITY_ELEMENT)} AS ELEMENT,
               CAST(floor(o_totalprice) AS DOUBLE) AS VALUE,
               CAST(NULL AS VARCHAR) AS MEASUREMENT_FLAG,
               {_coded_sql('o_orderstatus', STATUS_QUALITY)} AS QUALITY_FLAG,
               substr(o_orderpriority, 1, 1) AS SOURCE_FLAG,
               '0630' AS OBSERVATION_TIME,
               CAST(year(o_orderdate) AS BIGINT) AS YEAR
        FROM orders""",
    "happened": f"""
        SELECT user_id AS ID,
               CAST(ts AS DATE) AS DATE,
               {_coded_sql('event_type', EVENT_ELEMENT)} AS ELEMENT,
               CASE WHEN value >= 1 THEN CAST(floor(value) AS DOUBLE) END AS VALUE
        FROM events""",
    "lines": f"""
        SELECT l_suppkey AS ID,
               CAST(l_shipdate AS DATE) AS DATE,
               {_coded_sql('l_returnflag', FLAG_ELEMENT)} AS ELEMENT,
               l_quantity AS VALUE
        FROM lineitem""",
    "temperatures": """
        SELECT l.*, s.NAME, CAST(date_trunc('month', DATE) AS DATE) AS YEAR_MONTH
        FROM lines l LEFT JOIN suppliers s ON l.ID = s.ID
        WHERE ELEMENT IN ('TMIN', 'TMAX')""",
    "rainfall": """
        SELECT YEAR, COUNTRY_CODE,
               sum(VALUE) / count(VALUE) / 10e0 AS AVG_DAILY_PRCP_MM,
               count(*) AS N_OBSERVATIONS,
               count(DISTINCT d.ID) AS N_STATIONS
        FROM daily d JOIN stations s ON d.ID = s.ID
        WHERE ELEMENT = 'PRCP'
        GROUP BY YEAR, COUNTRY_CODE""",
    "metrics": """
        SELECT ID, min(FIRSTYEAR) AS FIRST_YEAR, max(LASTYEAR) AS LAST_YEAR,
               list_sort(list(DISTINCT ELEMENT)) AS SET_OF,
               count(DISTINCT CASE WHEN ELEMENT <> 'TAVG' THEN ELEMENT END) AS N_CORE,
               count(DISTINCT CASE WHEN ELEMENT = 'TAVG' THEN ELEMENT END) AS N_OTHER,
               min(FIRSTYEAR) <= 2001 AND max(LASTYEAR) >= 2001 AS ACTIVE
        FROM inventory GROUP BY ID""",
    "monthly": """
        SELECT ID, NAME, ELEMENT, YEAR_MONTH, sum(VALUE) / count(VALUE) / 10e0 AS TEMP_C
        FROM temperatures GROUP BY ID, NAME, ELEMENT, YEAR_MONTH""",
}

_NEEDS = {
    "temperatures": ["lines", "suppliers"],
    "rainfall": ["daily", "stations"],
    "metrics": ["inventory"],
    "monthly": ["temperatures"],
}


def given(*names: str, then: str) -> str:
    """A SQL text: the named tables, in the order they build on each other, then a query."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = ", ".join(f"{name} AS ({CTES[name]})" for name in ordered)
    return f"WITH {ctes} {then}"


def haversine_sql(a: str, b: str) -> str:
    """Great-circle distance between rows ``a`` and ``b`` with LATITUDE and LONGITUDE."""
    h = (
        f"(pow(sin(radians({b}.LATITUDE - {a}.LATITUDE) / 2), 2) + cos(radians({a}.LATITUDE)) * "
        f"cos(radians({b}.LATITUDE)) * pow(sin(radians({b}.LONGITUDE - {a}.LONGITUDE) / 2), 2))"
    )
    return f"12742e0 * atan2(sqrt({h}), sqrt(greatest(0e0, 1 - {h})))"
