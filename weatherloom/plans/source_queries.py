"""Queries over the readers, writers and file facts.

What is read is first written from the benchmark tables to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weatherloom import schema as S
from weatherloom.functions import columns as C
from weatherloom.operators import enrich, gaps, rainfall, report
from weatherloom.plans import standins as D
from weatherloom.plans.registry import query
from weatherloom.sources import dimensions, files, observations, sinks

_OBSERVATION = ["ID", "DATE", "ELEMENT", "VALUE", "MEASUREMENT_FLAG", "QUALITY_FLAG", "SOURCE_FLAG", "OBSERVATION_TIME"]
_NUMBER_FORMAT = {"LATITUDE": "%.4f", "LONGITUDE": "%.4f", "ELEVATION": "%.1f"}


def _fixed_width_lines(df: DataFrame, fields: tuple[S.Field, ...]) -> DataFrame:
    parts: list[Column] = []
    end = 0
    for field in fields:
        text = F.col(field.name).cast("string")
        if field.name in _NUMBER_FORMAT:
            shown = F.format_string(_NUMBER_FORMAT[field.name], F.col(field.name))
            text = F.when(F.col(field.name).isNotNull(), shown)
        parts += [F.lit(" " * (field.first - 1 - end)), F.rpad(F.coalesce(text, F.lit("")), field.width, " ")]
        end = field.last
    return df.select(F.concat(*parts).alias("value"))


def _written(spark: SparkSession, name: str, lines: DataFrame, compression: str = "none") -> str:
    path = sinks.shared_path(spark, name)
    lines.write.option("compression", compression).text(path)
    return path


def csv_lines(daily: DataFrame, *kept: str) -> DataFrame:
    texts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _OBSERVATION)
    return daily.select(*kept, F.concat_ws(",", *texts).alias("value"))


def _station_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = D.customer_stations(spark, sf_dir).withColumn(
        "ID", F.concat(F.col("COUNTRY_CODE"), F.lpad(F.col("ID").cast("string"), 9, "0"))
    )
    return _fixed_width_lines(located, S.STATIONS)


@query(
    "read_stations",
    D.given(
        "stations",
        then="""
        SELECT COUNTRY_CODE || lpad(CAST(ID AS VARCHAR), 9, '0') AS ID,
               round(LATITUDE, 6) AS LATITUDE, round(LONGITUDE, 6) AS LONGITUDE, ELEVATION,
               nullif(trim(STATE), '') AS STATE, NAME, GSN_FLAG, HCN_CRN_FLAG, WMO_ID
        FROM stations""",
    ),
)
def read_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(spark, "stations", _station_text(spark, sf_dir))
    return dimensions.read_stations(spark, path)


def _located_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory with the position of each station, as its file has it."""
    places = D.customer_stations(spark, sf_dir).select("ID", "LATITUDE", "LONGITUDE")
    return D.inventory(spark, sf_dir).join(places, "ID", "left")


@query(
    "read_inventory",
    D.given(
        "inventory", "stations",
        then="""SELECT CAST(i.ID AS VARCHAR) AS ID, round(LATITUDE, 6) AS LATITUDE, round(LONGITUDE, 6) AS LONGITUDE, ELEMENT, FIRSTYEAR, LASTYEAR
                FROM inventory i LEFT JOIN stations s ON s.ID = i.ID""",
    ),
)
def read_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(spark, "inventory", _fixed_width_lines(_located_inventory(spark, sf_dir), S.INVENTORY))
    return dimensions.read_inventory(spark, path)


@query(
    "dimension_row_counts",
    D.given(
        "stations", "countries", "states", "inventory",
        then="""
        SELECT 'stations' AS DATASET, count(*) AS N_ROWS FROM stations
        UNION ALL SELECT 'countries', count(*) FROM countries
        UNION ALL SELECT 'states', count(*) FROM states
        UNION ALL SELECT 'inventory', count(*) FROM inventory""",
    ),
)
def dimension_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = dimensions.read_dimensions(
        spark,
        stations=_written(spark, "stations", _station_text(spark, sf_dir)),
        countries=_written(spark, "countries", _fixed_width_lines(D.countries(spark, sf_dir), S.COUNTRIES)),
        states=_written(spark, "states", _fixed_width_lines(D.states(spark, sf_dir), S.STATES)),
        inventory=_written(spark, "inventory", _fixed_width_lines(_located_inventory(spark, sf_dir), S.INVENTORY)),
    )
    return dimensions.row_counts(tables)


@query(
    "read_observations",
    D.given(
        "daily",
        then=f"""SELECT * EXCLUDE (YEAR) REPLACE (CAST(ID AS VARCHAR) AS ID) FROM daily""",
    ),
)
def read_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(spark, "daily", csv_lines(D.order_observations(spark, sf_dir)), "gzip")
    return observations.read_observations(spark, path)


@query(
    "observation_columns",
    D.given(
        "daily",
        then=" UNION ALL ".join(
            f"SELECT {i} AS POSITION, '{c}' AS COLUMN_NAME, '{'double' if c == 'VALUE' else 'string'}' AS TYPE, count({'NULL' if c == 'MEASUREMENT_FLAG' else c}) AS N_VALUES FROM daily"
            for i, c in enumerate(_OBSERVATION)
        ),
    ),
)
def observation_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, type and number of values of each column of the files read back, in their order."""
    path = _written(spark, "daily", csv_lines(D.order_observations(spark, sf_dir)), "gzip")
    read = observations.read_observations(spark, path)
    counts = read.agg(*(F.count(name).alias(name) for name in read.columns))
    rows = (
        F.struct(F.lit(i).alias("POSITION"), F.lit(f.name).alias("COLUMN_NAME"), F.lit(f.dataType.simpleString()).alias("TYPE"), F.col(f.name).alias("N_VALUES"))
        for i, f in enumerate(read.schema.fields)
    )
    return counts.select(F.inline(F.array(*rows)))


@query(
    "report_order",
    D.given("rainfall", then="SELECT YEAR, COUNTRY_CODE, row_number() OVER (ORDER BY YEAR, COUNTRY_CODE) AS POSITION FROM rainfall"),
)
def report_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each row of a published table stands; as the other windows over whole tables, on an aggregate only."""
    means = rainfall.country_year_means(D.order_observations(spark, sf_dir), D.customer_stations(spark, sf_dir))
    placed = report.in_report_order(means).withColumn("AT", F.monotonically_increasing_id())
    return placed.select("YEAR", "COUNTRY_CODE", F.row_number().over(Window.orderBy("AT")).alias("POSITION"))


@query(
    "read_landed_years",
    D.given(
        "daily",
        then="""SELECT CAST(ID AS VARCHAR) AS ID, DATE, ELEMENT, VALUE, QUALITY_FLAG, YEAR
                FROM daily WHERE YEAR IN (1997, 1999)""",
    ),
)
def read_landed_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = D.order_observations(spark, sf_dir).withColumn("ID", F.col("ID").cast("string"))
    path = observations.land_observations(daily, sinks.shared_path(spark, "landed"))
    return observations.read_landed(spark, path, years=[1997, 1999]).select(
        "ID", "DATE", "ELEMENT", "VALUE", "QUALITY_FLAG", "YEAR"
    )


@query(
    "parquet_by_country",
    D.given(
        "stations", "countries",
        then="""
        SELECT s.ID, s.NAME, s.COUNTRY_CODE, c.NAME AS COUNTRY_NAME
        FROM stations s LEFT JOIN countries c ON s.COUNTRY_CODE = c.CODE
        WHERE s.COUNTRY_CODE IN ('NC', 'NH')""",
    ),
)
def parquet_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = enrich.with_name(D.customer_stations(spark, sf_dir), D.countries(spark, sf_dir), "COUNTRY_CODE", "COUNTRY_NAME")
    path = sinks.save(
        sinks.packed_by(named, "COUNTRY_CODE", 3),
        sinks.shared_path(spark, "stations-by-country"),
        by=["COUNTRY_CODE"],
    )
    return (
        spark.read.parquet(path)
        .where(F.col("COUNTRY_CODE").isin("NC", "NH"))
        .select("ID", "NAME", "COUNTRY_CODE", "COUNTRY_NAME")
    )


@query(
    "csv_gz_round_trip",
    D.given(
        "rainfall",
        then="SELECT YEAR, COUNTRY_CODE, round(AVG_DAILY_PRCP_MM, 6) AS AVG_DAILY_PRCP_MM, N_OBSERVATIONS, N_STATIONS FROM rainfall",
    ),
)
def csv_gz_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = rainfall.country_year_means(
        D.order_observations(spark, sf_dir), D.customer_stations(spark, sf_dir)
    )
    path = sinks.save(means, sinks.shared_path(spark, "rainfall"), "csv")
    return spark.read.schema(means.schema).option("header", True).csv(path)


_LINE_BYTES = """strlen(concat_ws(',', CAST(ID AS VARCHAR), DATE, ELEMENT,
                   CAST(CAST(VALUE AS BIGINT) AS VARCHAR) || '.0', '', coalesce(QUALITY_FLAG, ''),
                   SOURCE_FLAG, OBSERVATION_TIME)) + 1"""

_SIZE_TEXT = """CASE WHEN SIZE < 1024 THEN format('{:,.2f} B', SIZE / 1e0)
                    WHEN SIZE < 1048576 THEN format('{:,.2f} KB', SIZE / 1024e0)
                    WHEN SIZE < 1073741824 THEN format('{:,.2f} MB', SIZE / 1048576e0)
                    ELSE format('{:,.2f} GB', SIZE / 1073741824e0) END"""


@query(
    "file_sizes",
    D.given(
        "daily",
        then=f"""
        SELECT YEAR, SIZE, round(SIZE / sum(SIZE) OVER (), 6) AS SHARE, {_SIZE_TEXT} AS SIZE_TEXT
        FROM (SELECT YEAR, CAST(sum({_LINE_BYTES}) AS BIGINT) AS SIZE FROM daily GROUP BY YEAR)""",
    ),
)
def file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of the plain text files of each year; how many files there are is up to Spark."""
    daily = C.with_year(D.order_observations(spark, sf_dir))
    path = sinks.shared_path(spark, "text-by-year")
    sinks.packed_by(csv_lines(daily, "YEAR"), "YEAR").write.partitionBy("YEAR").text(path)
    of_year = F.regexp_extract("path", r"/YEAR=(\d+)/", 1).cast("bigint")
    return files.size_shares(files.file_facts(spark, path).select(of_year.alias("YEAR"), "size"), "YEAR").drop("N_FILES")


@query(
    "read_year_file",
    D.given("daily", then="SELECT * EXCLUDE (YEAR) REPLACE (CAST(ID AS VARCHAR) AS ID) FROM daily WHERE YEAR = 1997"),
)
def read_year_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One write puts every year into a folder, which then takes the name of that year's file; one year is read."""
    daily = C.with_year(D.order_observations(spark, sf_dir))
    root = sinks.shared_path(spark, "years")
    sinks.packed_by(csv_lines(daily, "YEAR"), "YEAR").write.option("compression", "gzip").partitionBy("YEAR").text(root)
    sinks.rename_folders(spark, root, "YEAR=", "", ".csv.gz")
    return observations.read_observations(spark, root, year=1997)


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing line per customer, in the regular, the short and an irregular form."""
    size = (F.col("c_custkey") * 1000 + 5000).cast("string")
    path = F.concat(F.lit("/data/daily/"), (F.col("c_nationkey") * 11 + 1750).cast("string"), F.lit(".csv.gz"))
    segment = F.col("c_mktsegment")
    return D.table(spark, sf_dir, "customer").select(
        F.when(segment == "BUILDING", F.concat_ws(" ", F.lit("-rw-r--r--  1"), size, F.lit("2024-01-01 00:00"), path))
        .when(segment == "MACHINERY", F.concat_ws(" ", size, path, F.lit("7")))
        .when(segment == "FURNITURE", F.concat_ws(" ", F.lit("-rw-r--r--  1 user group"), size, F.lit("2024-01-01 00:00 /data/readme.txt")))
        .otherwise(F.concat_ws(" ", F.lit("-rw-r--r--  1 user group"), size, F.lit("2024-01-01 00:00"), path))
        .alias("value")
    )


_LISTED = """listed AS (
    SELECT CAST(c_nationkey * 11 + 1750 AS BIGINT) AS year, c_custkey * 1000 + 5000 AS size
    FROM customer WHERE c_mktsegment <> 'FURNITURE')"""


@query(
    "parse_listing",
    f"WITH {_LISTED} SELECT year, size, CAST(year AS VARCHAR) || '.csv.gz' AS name FROM listed",
)
def parse_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.parse_listing(_listing(spark, sf_dir))


@query(
    "size_by_year",
    f"""WITH {_LISTED}, sums AS (
            SELECT year, count(*) AS N_FILES, CAST(sum(size) AS BIGINT) AS SIZE FROM listed GROUP BY year)
        SELECT year, N_FILES, SIZE, round(SIZE / sum(SIZE) OVER (), 6) AS SHARE,
               CASE WHEN SIZE < 1024 THEN format('{{:,.2f}} B', SIZE / 1e0)
                    WHEN SIZE < 1048576 THEN format('{{:,.2f}} KB', SIZE / 1024e0)
                    WHEN SIZE < 1073741824 THEN format('{{:,.2f}} MB', SIZE / 1048576e0)
                    ELSE format('{{:,.2f}} GB', SIZE / 1073741824e0) END AS SIZE_TEXT
        FROM sums""",
)
def size_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.size_shares(files.parse_listing(_listing(spark, sf_dir)), "year")


@query(
    "listed_year_coverage",
    f"""WITH {_LISTED}
        SELECT min(year) AS FIRST_YEAR, max(year) AS LAST_YEAR, count(DISTINCT year) AS N_YEARS,
               max(year) - min(year) + 1 - count(DISTINCT year) AS N_MISSING
        FROM listed""",
)
def listed_year_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.year_coverage(files.parse_listing(_listing(spark, sf_dir)), "year")


@query(
    "listed_missing_years",
    f"""WITH {_LISTED}
        SELECT y AS YEAR
        FROM (SELECT unnest(generate_series(min(year), max(year))) AS y FROM listed)
        WHERE y NOT IN (SELECT year FROM listed)""",
)
def listed_missing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.missing_years(files.parse_listing(_listing(spark, sf_dir)), "year")


@query(
    "expanded_bytes",
    D.given(
        "daily",
        then="""
        SELECT CAST(sum(strlen(concat_ws(',', CAST(ID AS VARCHAR), DATE, ELEMENT,
                   CAST(CAST(VALUE AS BIGINT) AS VARCHAR) || '.0', '', coalesce(QUALITY_FLAG, ''),
                   SOURCE_FLAG, OBSERVATION_TIME)) + 1) AS BIGINT) AS EXPANDED_SIZE
        FROM daily""",
    ),
)
def expanded_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(spark, "daily", csv_lines(D.order_observations(spark, sf_dir)), "gzip")
    return files.expanded_bytes(spark, path)


@query(
    "expansion_estimate",
    f"""WITH {_LISTED}
        SELECT CAST(sum(size) AS BIGINT) AS SIZE,
               round(1e9 / sum(CASE WHEN year = 1860 THEN size END), 6) AS RATIO,
               round(sum(size) * (1e9 / sum(CASE WHEN year = 1860 THEN size END)), 2) AS ESTIMATED_SIZE
        FROM listed""",
)
def expansion_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = files.parse_listing(_listing(spark, sf_dir))
    estimate = files.expansion_estimate(listed, sample_year=1860, sample_expanded=1_000_000_000)
    return estimate.withColumn("ESTIMATED_SIZE", F.round("ESTIMATED_SIZE", 2))


@query(
    "bytes_text",
    """
    WITH sized AS (
        SELECT o_orderkey,
               floor(o_totalprice) * pow(1024, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1) / 64 AS n
        FROM orders)
    SELECT o_orderkey,
           CASE WHEN n < pow(1024, 1) THEN format('{:,.2f} B', n)
                WHEN n < pow(1024, 2) THEN format('{:,.2f} KB', n / pow(1024, 1))
                WHEN n < pow(1024, 3) THEN format('{:,.2f} MB', n / pow(1024, 2))
                WHEN n < pow(1024, 4) THEN format('{:,.2f} GB', n / pow(1024, 3))
                WHEN n < pow(1024, 5) THEN format('{:,.2f} TB', n / pow(1024, 4))
                ELSE format('{:,.2f} PB', n / pow(1024, 5)) END AS SIZE_TEXT
    FROM sized""",
)
def bytes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    power = F.pow(F.lit(1024.0), F.substring("o_orderpriority", 1, 1).cast("int") - 1)
    n = F.floor("o_totalprice") * power / 64
    return D.table(spark, sf_dir, "orders").select("o_orderkey", C.bytes_text(n).alias("SIZE_TEXT"))
