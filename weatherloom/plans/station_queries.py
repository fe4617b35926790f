"""Queries over stations, countries and the inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.functions import columns as C
from weatherloom.functions.geo import haversine_km
from weatherloom.operators import counts, enrich, integrity, pairs
from weatherloom.plans import standins as D
from weatherloom.plans.registry import query
from weatherloom.sources import sinks

YEAR = 2001


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_stations(
        D.customer_stations(spark, sf_dir),
        D.countries(spark, sf_dir),
        D.states(spark, sf_dir),
        D.inventory(spark, sf_dir),
        active_year=YEAR,
    )


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_name(D.customer_stations(spark, sf_dir), D.countries(spark, sf_dir), "COUNTRY_CODE", "COUNTRY_NAME")


_METRICS = """FIRST_YEAR, LAST_YEAR, array_to_string(SET_OF, ',') AS ELEMENTS,
    N_CORE AS N_CORE_ELEMENTS, N_OTHER AS N_OTHER_ELEMENTS, N_CORE = 5 AS HAS_ALL_CORE,
    array_to_string(SET_OF, ',') = 'PRCP' AS PRECIP_ONLY, ACTIVE AS ACTIVE_IN_2001"""


@query("inventory_metrics", D.given("metrics", then=f"SELECT ID, {_METRICS} FROM metrics"))
def inventory_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.inventory_metrics(D.inventory(spark, sf_dir), active_year=YEAR)


@query(
    "enriched_stations",
    D.given(
        "stations", "countries", "states", "metrics",
        then=f"""
        SELECT s.ID, round(LATITUDE, 6) AS LATITUDE, round(LONGITUDE, 6) AS LONGITUDE, ELEVATION, STATE,
               s.NAME, GSN_FLAG, HCN_CRN_FLAG, WMO_ID, COUNTRY_CODE,
               c.NAME AS COUNTRY_NAME, t.NAME AS STATE_NAME, {_METRICS}
        FROM stations s LEFT JOIN countries c ON s.COUNTRY_CODE = c.CODE
             LEFT JOIN states t ON s.STATE = t.CODE LEFT JOIN metrics m ON s.ID = m.ID""",
    ),
)
def enriched_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)


@query(
    "flag_counts",
    D.given(
        "stations", "metrics",
        then="""
        SELECT count(*) FILTER (ACTIVE) AS N_ACTIVE, count(*) FILTER (N_CORE = 5) AS N_ALL_CORE,
               count(*) FILTER (array_to_string(SET_OF, ',') = 'PRCP') AS N_PRECIP_ONLY
        FROM stations s LEFT JOIN metrics m ON s.ID = m.ID""",
    ),
)
def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.flag_counts(_enriched(spark, sf_dir), active_year=YEAR)


@query(
    "state_countries",
    D.given(
        "stations", "countries",
        then="""
        SELECT DISTINCT COUNTRY_CODE, c.NAME AS COUNTRY_NAME, COUNTRY_CODE || ': ' || c.NAME AS LABEL
        FROM stations s LEFT JOIN countries c ON s.COUNTRY_CODE = c.CODE
        WHERE trim(STATE) <> ''""",
    ),
)
def state_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.state_countries(_named(spark, sf_dir))


@query(
    "inventory_integrity",
    D.given(
        "suppliers", "inventory",
        then="""
        SELECT (SELECT count(DISTINCT ID) FROM suppliers s
                WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE i.ID = s.ID)) AS N_WITHOUT_INVENTORY,
               (SELECT count(DISTINCT ID) FROM inventory i
                WHERE NOT EXISTS (SELECT 1 FROM suppliers s WHERE i.ID = s.ID)) AS N_ORPHAN_INVENTORY""",
    ),
)
def inventory_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.inventory_integrity(D.supplier_stations(spark, sf_dir), D.inventory(spark, sf_dir))


@query(
    "without_inventory",
    D.given(
        "inventory",
        then="SELECT p_partkey AS ID FROM part WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE i.ID = p_partkey)",
    ),
)
def without_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts are the stations here, as there are more of them than the orders name customers."""
    parts = D.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ID"))
    return integrity.without_inventory(parts, D.inventory(spark, sf_dir))


@query(
    "orphan_inventory",
    D.given(
        "suppliers", "inventory",
        then="SELECT DISTINCT ID FROM inventory i WHERE NOT EXISTS (SELECT 1 FROM suppliers s WHERE i.ID = s.ID)",
    ),
)
def orphan_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.orphan_inventory(D.supplier_stations(spark, sf_dir), D.inventory(spark, sf_dir))


@query(
    "network_counts",
    D.given(
        "stations",
        then="""
        SELECT count(*) FILTER (g) AS GSN, count(*) FILTER (h) AS HCN, count(*) FILTER (c) AS CRN,
               count(*) FILTER (g AND h) AS GSN_and_HCN, count(*) FILTER (g AND c) AS GSN_and_CRN,
               count(*) FILTER (h AND c) AS HCN_and_CRN,
               count(*) FILTER (g AND h AND c) AS GSN_and_HCN_and_CRN,
               count(*) FILTER ((g AND h) OR (g AND c) OR (h AND c)) AS IN_MORE_THAN_ONE
        FROM (SELECT coalesce(GSN_FLAG, '') = 'GSN' AS g, coalesce(HCN_CRN_FLAG, '') = 'HCN' AS h,
                     coalesce(HCN_CRN_FLAG, '') = 'CRN' AS c FROM stations)""",
    ),
)
def network_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.network_counts(D.customer_stations(spark, sf_dir))


_TERRITORY = "lower(c.NAME) LIKE '%united states%' AND COUNTRY_CODE <> 'NB'"


@query(
    "station_totals",
    D.given(
        "stations", "countries",
        then=f"""
        SELECT 'all' AS MEASURE, count(DISTINCT ID) AS N FROM stations
        UNION ALL SELECT 'southern', count(*) FROM stations WHERE LATITUDE < 0
        UNION ALL SELECT 'country NH', count(*) FROM stations WHERE COUNTRY_CODE = 'NH'
        UNION ALL SELECT 'territories', count(DISTINCT ID) FROM stations s
                  JOIN countries c ON s.COUNTRY_CODE = c.CODE WHERE {_TERRITORY}""",
    ),
)
def station_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = D.customer_stations(spark, sf_dir)
    measures = {
        "all": counts.total_stations(stations),
        "southern": counts.southern_count(stations),
        "country NH": counts.country_count(stations, "NH"),
        "territories": counts.territory_count(_named(spark, sf_dir), home_code="NB"),
    }
    rows = [df.toDF("N").select(F.lit(name).alias("MEASURE"), "N") for name, df in measures.items()]
    return reduce(DataFrame.unionByName, rows)


@query(
    "territory_totals",
    D.given(
        "stations", "countries",
        then=f"""
        SELECT c.NAME AS COUNTRY_NAME, count(DISTINCT ID) AS N_STATIONS, grouping(c.NAME) = 1 AS IS_TOTAL
        FROM stations s JOIN countries c ON s.COUNTRY_CODE = c.CODE
        WHERE {_TERRITORY} GROUP BY ROLLUP (c.NAME)""",
    ),
)
def territory_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.territory_totals(_named(spark, sf_dir), home_code="NB")


@query(
    "stations_per_country",
    D.given(
        "suppliers", "countries",
        then="""
        SELECT CODE, c.NAME, count(DISTINCT ID) AS N_STATIONS
        FROM countries c LEFT JOIN suppliers s ON s.COUNTRY_CODE = c.CODE GROUP BY CODE, c.NAME""",
    ),
)
def stations_per_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.stations_per_country(D.supplier_stations(spark, sf_dir), D.countries(spark, sf_dir))


@query(
    "stations_per_code_in_id",
    D.given(
        "stations", "countries",
        then="""
        SELECT CODE, c.NAME, count(DISTINCT ID) AS N_STATIONS
        FROM countries c LEFT JOIN stations s ON s.COUNTRY_CODE = c.CODE GROUP BY CODE, c.NAME""",
    ),
)
def stations_per_code_in_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country code is nowhere but in the first two characters of the ID."""
    text_ids = D.customer_stations(spark, sf_dir).select(
        F.concat(F.col("COUNTRY_CODE"), F.lpad(F.col("ID").cast("string"), 9, "0")).alias("ID")
    )
    return counts.stations_per_country(text_ids, D.countries(spark, sf_dir))


@query(
    "country_stations",
    D.given("stations", then="SELECT ID, NAME, COUNTRY_CODE FROM stations WHERE COUNTRY_CODE = 'NH'"),
)
def country_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counts.country_stations(D.customer_stations(spark, sf_dir), "NH")
    return found.select("ID", "NAME", "COUNTRY_CODE")


@query(
    "wrapped_longitude",
    D.given(
        "stations",
        then="""SELECT ID, round(LONGITUDE, 6) AS LONGITUDE,
                       round(CASE WHEN LONGITUDE < 0 THEN LONGITUDE + 360 ELSE LONGITUDE END, 6) AS SHOWN
                FROM stations""",
    ),
)
def wrapped_longitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    longitude = F.col("LONGITUDE")
    return D.customer_stations(spark, sf_dir).select(
        "ID", "LONGITUDE", C.wrapped_longitude(longitude).alias("SHOWN")
    )


@query(
    "distance_to_point",
    D.given(
        "stations",
        then=f"""SELECT a.ID, round({D.haversine_sql('a', 'b')}, 6) AS DISTANCE_KM
                 FROM stations a, (SELECT -41.3e0 AS LATITUDE, 174.8e0 AS LONGITUDE) b""",
    ),
)
def distance_to_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    distance = haversine_km(F.col("LATITUDE"), F.col("LONGITUDE"), F.lit(-41.3), F.lit(174.8))
    return D.customer_stations(spark, sf_dir).select("ID", distance.alias("DISTANCE_KM"))


def _landed_sites(spark: SparkSession, stations: DataFrame) -> DataFrame:
    return spark.read.parquet(sinks.save(pairs.fold_sites(stations), sinks.shared_path(spark, "sites")))


_PAIRS = f"""
    SELECT a.ID AS ID_A, a.LATITUDE AS LAT_A, a.LONGITUDE AS LON_A, a.NAME AS NAME_A,
           b.ID AS ID_B, b.LATITUDE AS LAT_B, b.LONGITUDE AS LON_B, b.NAME AS NAME_B,
           {D.haversine_sql('a', 'b')} AS DISTANCE_KM
    FROM stations a JOIN stations b ON a.ID < b.ID"""

_SITE_PAIRS = f"""
    SELECT a.ID AS ID_A, a.LATITUDE AS LAT_A, a.LONGITUDE AS LON_A, a.NAME AS NAME_A, a.N AS N_A,
           b.ID AS ID_B, b.LATITUDE AS LAT_B, b.LONGITUDE AS LON_B, b.NAME AS NAME_B, b.N AS N_B,
           {D.haversine_sql('a', 'b')} AS DISTANCE_KM
    FROM sites a JOIN sites b ON a.ID < b.ID"""

_PAIR_COLUMNS = """ID_A, round(LAT_A, 6) AS LAT_A, round(LON_A, 6) AS LON_A, NAME_A,
    ID_B, round(LAT_B, 6) AS LAT_B, round(LON_B, 6) AS LON_B, NAME_B, round(DISTANCE_KM, 6) AS DISTANCE_KM"""


@query(
    "pairs_within",
    D.given(
        "stations", "shared_stations", "sites",
        then=f"""
        SELECT {_PAIR_COLUMNS}, N_A, N_B FROM ({_SITE_PAIRS})
        WHERE DISTANCE_KM <= 0.5 * sqrt(4 * pi() * 6371e0 * 6371e0 / (SELECT count(*) FROM sites))
        UNION ALL
        SELECT {_PAIR_COLUMNS}, 1, 1
        FROM (SELECT s.ID AS ID_A, s.LATITUDE AS LAT_A, s.LONGITUDE AS LON_A, s.NAME AS NAME_A,
                     m.ID AS ID_B, m.LATITUDE AS LAT_B, m.LONGITUDE AS LON_B, m.NAME AS NAME_B, 0e0 AS DISTANCE_KM
              FROM sites s JOIN shared_stations m
                ON s.LATITUDE = m.LATITUDE AND s.LONGITUDE = m.LONGITUDE AND m.ID > s.ID)""",
    ),
)
def pairs_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites closer than half the mean spacing, so their number grows with the stations."""
    stations = D.shared_stations(spark, sf_dir)
    sites = _landed_sites(spark, stations)
    radius = pairs.mean_spacing_km(stations, sites=sites).scalar() * 0.5
    return pairs.pairs_within(stations, radius, sites=sites)


@query(
    "site_members",
    D.given(
        "stations", "shared_stations", "sites",
        then="""
        SELECT s.ID AS SITE_ID, m.ID
        FROM sites s JOIN shared_stations m ON s.LATITUDE = m.LATITUDE AND s.LONGITUDE = m.LONGITUDE""",
    ),
)
def site_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.site_members(D.shared_stations(spark, sf_dir))


@query(
    "closest_pair",
    D.given(
        "stations",
        then=f"""
        SELECT {_PAIR_COLUMNS} FROM ({_PAIRS}) p WHERE p.DISTANCE_KM IS NOT NULL
        ORDER BY p.DISTANCE_KM, ID_A, ID_B LIMIT 1""",
    ),
)
def closest_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = D.customer_stations(spark, sf_dir)
    return pairs.closest_pair(stations, sites=_landed_sites(spark, stations))
