"""Queries over what is landed and how: changes only, unread lines, buckets, curves, bitmaps, exact percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.functions import columns as C
from weatherloom.operators import counts, enrich, names, presence, selection, sizing, sketches, unpaired
from weatherloom.plans import standins as D
from weatherloom.plans.registry import query
from weatherloom.plans.source_queries import csv_lines
from weatherloom.sources import landing, sinks, storage

# Landing what changed -------------------------------------------------------------


def _grown(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """(landed folder, years of the second landing): every year landed, then the last one again with its later half."""
    daily = C.with_year(D.order_observations(spark, sf_dir))
    source, root = sinks.shared_path(spark, "by-year"), sinks.shared_path(spark, "current")
    last = daily.agg(F.max("YEAR")).first()[0]
    lines = csv_lines(daily, "YEAR", "DATE")

    def put(rows: DataFrame) -> None:
        sinks.packed_by(rows.select("YEAR", "value"), "YEAR").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("YEAR").text(source)

    put(lines.where((F.col("YEAR") < last) | (F.substring("DATE", 5, 2) <= "03")))
    landing.land_changes(spark, source, root)
    put(lines.where(F.col("YEAR") == last))
    return root, landing.land_changes(spark, source, root)


@query(
    "landed_changes",
    D.given("daily", then="SELECT * REPLACE (CAST(ID AS VARCHAR) AS ID) FROM daily"),
)
def landed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a year has grown and was landed again, what is landed is all of it."""
    return landing.read_current(spark, _grown(spark, sf_dir)[0])


@query(
    "landed_rollup",
    D.given(
        "daily",
        then="""SELECT YEAR, CAST(ID AS VARCHAR) AS ID, ELEMENT, count(*) AS N_OBSERVATIONS, count(VALUE) AS N_VALUES, sum(VALUE) AS SUM_VALUE,
                       CAST(strptime(min(DATE), '%Y%m%d') AS DATE) AS FIRST_DAY, CAST(strptime(max(DATE), '%Y%m%d') AS DATE) AS LAST_DAY
                FROM daily GROUP BY ALL""",
    ),
)
def landed_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_current(spark, _grown(spark, sf_dir)[0], "rollup").select(
        "YEAR", "ID", "ELEMENT", "N_OBSERVATIONS", "N_VALUES", "SUM_VALUE", "FIRST_DAY", "LAST_DAY"
    )


@query(
    "relanded_years",
    D.given("daily", then="SELECT YEAR, count(*) AS N_ROWS FROM daily WHERE YEAR = (SELECT max(YEAR) FROM daily) GROUP BY YEAR"),
)
def relanded_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second landing writes the one year that changed."""
    return _grown(spark, sf_dir)[1]


# Lines that cannot be read ----------------------------------------------------------

_LINE = """concat_ws(',', CAST(ID AS VARCHAR), DATE, ELEMENT, {value}, '', coalesce(QUALITY_FLAG, ''), SOURCE_FLAG{time})"""
_VALUE = "CAST(CAST(VALUE AS BIGINT) AS VARCHAR) || '.0'"
_BROKEN = f"""broken AS (
    SELECT YEAR, CASE WHEN SOURCE_FLAG = '1' THEN {_LINE.format(value=_VALUE, time='')}
                      WHEN SOURCE_FLAG = '2' THEN {_LINE.format(value="'n/a'", time=", OBSERVATION_TIME")}
                      WHEN SOURCE_FLAG = '3' THEN {_LINE.format(value=_VALUE, time=", OBSERVATION_TIME, 'x'")} END AS UNREAD
    FROM daily)"""


def _with_broken_lines(spark: SparkSession, sf_dir: str) -> str:
    """Files by year in which lines of three sources are broken: a field short, a value that is no number, a field too many."""
    daily = C.with_year(D.order_observations(spark, sf_dir))
    whole = csv_lines(daily, "YEAR", "SOURCE_FLAG")
    fields = F.split("value", ",")
    short = F.array_join(F.slice(fields, 1, 7), ",")
    worded = F.array_join(F.concat(F.slice(fields, 1, 3), F.array(F.lit("n/a")), F.slice(fields, 5, 4)), ",")
    source = F.col("SOURCE_FLAG")
    broken = F.when(source == "1", short).when(source == "2", worded).when(source == "3", F.concat("value", F.lit(",x"))).otherwise(F.col("value"))
    path = sinks.shared_path(spark, "broken")
    sinks.packed_by(whole.select("YEAR", broken.alias("value")), "YEAR").write.option("compression", "gzip").partitionBy("YEAR").text(path)
    return path


def _read_broken(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(read, unread) lines with the YEAR that their file stands for."""
    lines = landing.read_lines(spark, f"{_with_broken_lines(spark, sf_dir)}/*/*.gz")
    year = F.regexp_extract(landing.FILE, r"/YEAR=(\d+)/", 1).cast("int")
    read, unread = landing.split_lines(lines, sinks.shared_path(spark, "split"))
    return read.withColumn("YEAR", year), unread.withColumn("YEAR", year)


@query(
    "unread_lines",
    D.given("daily", then=f", {_BROKEN} SELECT YEAR, UNREAD FROM broken WHERE UNREAD IS NOT NULL").replace(") , broken", "), broken"),
)
def unread_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_broken(spark, sf_dir)[1].select("YEAR", landing.UNREAD)


@query(
    "line_counts",
    D.given("daily", then=f", {_BROKEN} SELECT YEAR, count(*) AS N_LINES, count(*) - count(UNREAD) AS N_READ, count(UNREAD) AS N_UNREAD FROM broken GROUP BY YEAR").replace(") , broken", "), broken"),
)
def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.line_counts(*_read_broken(spark, sf_dir), "YEAR")


@query(
    "read_lines_of_broken_files",
    D.given("daily", then="SELECT CAST(ID AS VARCHAR) AS ID, DATE, ELEMENT, VALUE, QUALITY_FLAG, YEAR FROM daily WHERE SOURCE_FLAG NOT IN ('1', '2', '3')"),
)
def read_lines_of_broken_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_broken(spark, sf_dir)[0].select("ID", "DATE", "ELEMENT", "VALUE", "QUALITY_FLAG", "YEAR")


# Stored by station ------------------------------------------------------------------

BUCKETS = 8


def by_station(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(observations, stations) as tables in buckets of the station."""
    daily = storage.save_by_station(D.order_observations(spark, sf_dir), "daily", BUCKETS)
    stations = storage.save_by_station(D.customer_stations(spark, sf_dir), "stations", BUCKETS)
    return spark.table(daily), spark.table(stations)


@query(
    "elements_by_station",
    D.given(
        "daily", "stations",
        then="""SELECT d.ID, s.NAME, d.ELEMENT, count(*) AS N_OBSERVATIONS, sum(VALUE) AS SUM_VALUE
                FROM daily d JOIN stations s ON d.ID = s.ID GROUP BY ALL""",
    ),
)
def elements_by_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily, stations = by_station(spark, sf_dir)
    sums = daily.groupBy("ID", "ELEMENT").agg(F.count(F.lit(1)).alias("N_OBSERVATIONS"), F.sum("VALUE").alias("SUM_VALUE"))
    return sums.join(stations.hint("merge").select("ID", "NAME"), "ID").select("ID", "NAME", "ELEMENT", "N_OBSERVATIONS", "SUM_VALUE")


@query(
    "unpaired_days_by_station",
    D.given(
        "daily",
        then="""SELECT ID, DATE, count(*) FILTER (ELEMENT = 'TMAX') AS N_UNPAIRED FROM daily
                GROUP BY ID, DATE HAVING count(*) FILTER (ELEMENT = 'TMAX') > 0 AND count(*) FILTER (ELEMENT = 'TMIN') = 0""",
    ),
)
def unpaired_days_by_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily, _ = by_station(spark, sf_dir)
    days = unpaired.unpaired_days(daily)
    return days.select("ID", "DATE", F.col("N_OBSERVATIONS").alias("N_UNPAIRED"))


# Stored along a curve ---------------------------------------------------------------


@query(
    "observations_in_box",
    D.given(
        "daily", "stations",
        then="""SELECT d.ID, DATE, ELEMENT, VALUE, round(LATITUDE, 6) AS LATITUDE, round(LONGITUDE, 6) AS LONGITUDE
                FROM daily d JOIN stations s ON d.ID = s.ID
                WHERE LATITUDE BETWEEN -40 AND 20 AND LONGITUDE BETWEEN -60 AND 100 AND DATE BETWEEN '19960301' AND '19960630'""",
    ),
)
def observations_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.save_along_curve(D.order_observations(spark, sf_dir), D.customer_stations(spark, sf_dir), sinks.shared_path(spark, "curve"), files=8)
    box = storage.in_box(spark.read.parquet(path), latitude=(-40, 20), longitude=(-60, 100), first_day="1996-03-01", last_day="1996-06-30")
    return box.select("ID", "DATE", "ELEMENT", "VALUE", "LATITUDE", "LONGITUDE")


# Percentiles of raw observations ------------------------------------------------------

SHARES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)
_SHARES = ", ".join(f"{s!r}::DOUBLE" for s in SHARES)


@query(
    "raw_percentiles",
    f"""SELECT l_returnflag, l_linestatus, SHARE, N_VALUES, round(PERCENTILE, 6) AS PERCENTILE FROM (
            SELECT l_returnflag, l_linestatus, unnest([{_SHARES}]) AS SHARE, count(l_extendedprice) AS N_VALUES,
                   unnest(quantile_disc(l_extendedprice, [{_SHARES}])) AS PERCENTILE
            FROM lineitem GROUP BY l_returnflag, l_linestatus)""",
)
def raw_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.percentiles(D.table(spark, sf_dir, "lineitem"), "l_extendedprice", SHARES, by=["l_returnflag", "l_linestatus"])


@query(
    "raw_percentiles_by_element",
    D.given(
        "lines",
        then=f"""SELECT ELEMENT, unnest([{_SHARES}]) AS SHARE, count(VALUE) AS N_VALUES, unnest(quantile_disc(VALUE, [{_SHARES}])) AS PERCENTILE
                 FROM lines GROUP BY ELEMENT""",
    ),
)
def raw_percentiles_by_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.percentiles(D.line_observations(spark, sf_dir), "VALUE", SHARES, by=["ELEMENT"])


@query(
    "raw_percentiles_of_all",
    f"""SELECT unnest([{_SHARES}]) AS SHARE, count(*) AS N_VALUES, unnest(quantile_disc(o_totalprice, [{_SHARES}])) AS PERCENTILE FROM orders""",
)
def raw_percentiles_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.percentiles(D.table(spark, sf_dir, "orders"), "o_totalprice", SHARES)


# Presence bitmaps ---------------------------------------------------------------------


def _bits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(numbers of the stations, their presence), landed; parts are stations here, as some of them have no orders."""
    parts = D.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ID"))
    numbers = sinks.save(presence.numbered(parts), sinks.shared_path(spark, "numbers"))
    numbers = spark.read.parquet(numbers)
    table = sinks.save(presence.presence(D.order_observations(spark, sf_dir), numbers), sinks.shared_path(spark, "presence"))
    return numbers, spark.read.parquet(table)


@query(
    "never_observed_from_bits",
    "SELECT p_partkey AS ID FROM part WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = p_partkey)",
)
def never_observed_from_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presence.never_observed(*_bits(spark, sf_dir))


@query(
    "absent_in_year_from_bits",
    "SELECT p_partkey AS ID FROM part WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = p_partkey AND year(o_orderdate) = 1997)",
)
def absent_in_year_from_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presence.absent_in(*_bits(spark, sf_dir), 1997)


@query(
    "stopped_stations_from_bits",
    """SELECT DISTINCT o_custkey AS ID FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1996
       AND NOT EXISTS (SELECT 1 FROM orders n WHERE n.o_custkey = orders.o_custkey AND year(n.o_orderdate) = 1997)""",
)
def stopped_stations_from_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presence.stopped(*_bits(spark, sf_dir), 1997, 2)


@query(
    "observed_stations_of_spans",
    """SELECT a.y AS FIRST_YEAR, b.y AS LAST_YEAR, count(DISTINCT o_custkey) AS N_STATIONS
       FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) a JOIN (SELECT DISTINCT year(o_orderdate) AS y FROM orders) b ON a.y <= b.y
       JOIN orders ON year(o_orderdate) BETWEEN a.y AND b.y GROUP BY a.y, b.y""",
)
def observed_stations_of_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every span of years from one table of bitmaps; the observations are read once."""
    _, table = _bits(spark, sf_dir)
    first, last = table.agg(F.min("YEAR"), F.max("YEAR")).first()
    if first is None:
        return spark.createDataFrame([], "FIRST_YEAR int, LAST_YEAR int, N_STATIONS long")
    # a year's bitmap belongs to every span around it: years times years rows of 4 KB, not observations
    spans = table.withColumnRenamed("YEAR", "of").withColumn("FIRST_YEAR", F.explode(F.sequence(F.lit(first), F.col("of")))).withColumn("LAST_YEAR", F.explode(F.sequence(F.col("of"), F.lit(last))))
    known = [r["YEAR"] for r in table.select("YEAR").distinct().collect()]
    united = presence.merged(spans.where(F.col("FIRST_YEAR").isin(known) & F.col("LAST_YEAR").isin(known)), "FIRST_YEAR", "LAST_YEAR")
    return presence.observed_counts(united, "FIRST_YEAR", "LAST_YEAR")


# The station report in one pass ---------------------------------------------------------


@query(
    "station_report",
    D.given(
        "stations", "countries",
        then="""
        SELECT 'ALL' AS LEVEL, CAST(NULL AS VARCHAR) AS CODE, count(DISTINCT ID) AS N_STATIONS FROM stations
        UNION ALL SELECT 'COUNTRY', COUNTRY_CODE, count(DISTINCT ID) FROM stations GROUP BY COUNTRY_CODE
        UNION ALL SELECT 'TERRITORY', c.NAME, count(DISTINCT ID) FROM stations s JOIN countries c ON s.COUNTRY_CODE = c.CODE
                  WHERE c.NAME LIKE '%[United States%' AND s.COUNTRY_CODE <> 'US' GROUP BY c.NAME
        UNION ALL SELECT 'NETWORK', n, count(DISTINCT ID) FROM (
                      SELECT ID, GSN_FLAG AS n FROM stations WHERE GSN_FLAG = 'GSN' UNION ALL SELECT ID, HCN_CRN_FLAG FROM stations WHERE HCN_CRN_FLAG IN ('HCN', 'CRN')) GROUP BY n
        UNION ALL SELECT 'STATE', trim(STATE), count(DISTINCT ID) FROM stations WHERE trim(STATE) <> '' GROUP BY trim(STATE)
        UNION ALL SELECT 'HEMISPHERE', CASE WHEN LATITUDE < 0 THEN 'S' ELSE 'N' END, count(DISTINCT ID) FROM stations WHERE LATITUDE IS NOT NULL GROUP BY ALL""",
    ),
)
def station_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = enrich.with_name(D.customer_stations(spark, sf_dir), D.countries(spark, sf_dir), "COUNTRY_CODE", "COUNTRY_NAME")
    return counts.station_report(named)


# Names spelled differently ----------------------------------------------------------------

#: Parts, whose names lack a letter, double one, swap their words, are shouted or carry a remark, by kind.
_SPELLED = """spelled AS (
    SELECT p_partkey AS ID, CASE p_type
        WHEN 'ECONOMY' THEN substr(p_name, 1, 2) || substr(p_name, 4)
        WHEN 'SMALL' THEN p_name || right(p_name, 1)
        WHEN 'LARGE' THEN split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1)
        WHEN 'PROMO' THEN upper(p_name) || ' [2nd]'
        WHEN 'STANDARD' THEN NULL
        ELSE p_name END AS NAME FROM part)"""


def _spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, kind = F.col("p_name"), F.col("p_type")
    return D.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ID"),
        F.when(kind == "ECONOMY", F.concat(F.substring(name, 1, 2), F.substr(name, F.lit(4))))
        .when(kind == "SMALL", F.concat(name, F.right(name, F.lit(1))))
        .when(kind == "LARGE", F.concat(F.split_part(name, F.lit(" "), F.lit(2)), F.lit(", "), F.split_part(name, F.lit(" "), F.lit(1))))
        .when(kind == "PROMO", F.concat(F.upper(name), F.lit(" [2nd]")))
        .when(kind == "STANDARD", F.lit(None).cast("string"))
        .otherwise(name)
        .alias("NAME"),
    )


_WORDS = "list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(NAME), '[\\[(][^\\])}]*[\\])}]', ' ', 'g'), '[^\\p{L}]+', ' ', 'g')), ' '), lambda w: w <> '')))"


@query(
    "matched_names",
    f"""WITH {_SPELLED}, l AS (
            SELECT NAME, {_WORDS} AS w FROM (SELECT DISTINCT NAME FROM spelled WHERE NAME IS NOT NULL)
        ), r AS (
            SELECT NAME, {_WORDS} AS w FROM (SELECT DISTINCT p_name AS NAME FROM part)
        ), b AS (
            SELECT l.NAME, upper(r.NAME) AS KEY, levenshtein(array_to_string(l.w, ' '), array_to_string(r.w, ' ')) AS d,
                   least(length(array_to_string(l.w, ' ')), length(array_to_string(r.w, ' '))) AS n
            FROM l, r
            WHERE list_has_any(l.w, r.w) OR left(array_to_string(l.w, ' '), 3) = left(array_to_string(r.w, ' '), 3)
               OR right(array_to_string(l.w, ' '), 3) = right(array_to_string(r.w, ' '), 3)
        ), m AS (
            SELECT NAME, KEY, d, min(d) OVER (PARTITION BY NAME) AS least FROM b WHERE d <= greatest(1, n // 5)
        ), f AS (
            SELECT NAME, least AS DISTANCE, list_sort(list(DISTINCT KEY)) AS c FROM m WHERE d = least GROUP BY NAME, least
        )
        SELECT s.ID, s.NAME, CAST(DISTANCE AS BIGINT) AS DISTANCE, array_to_string(c, ',') AS CANDIDATES,
               CASE WHEN c IS NULL THEN 'none' WHEN len(c) > 1 THEN 'tied' WHEN DISTANCE = 0 THEN 'equal' ELSE 'near' END AS MATCH,
               CASE WHEN len(c) = 1 THEN c[1] END AS KEY
        FROM spelled s LEFT JOIN f ON f.NAME = s.NAME""",
)
def matched_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = D.table(spark, sf_dir, "part").select(F.col("p_name").alias("NAME"), F.upper("p_name").alias("KEY"))
    return names.match_names(_spelled(spark, sf_dir), known)


# Distinct sketches ------------------------------------------------------------------------


def _sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches by year and element, landed: one row of a few KB each."""
    made = sketches.station_sketches(D.order_observations(spark, sf_dir), "ELEMENT")
    return spark.read.parquet(sinks.save(made, sinks.shared_path(spark, "sketches")))


def _within(estimate: str, exact: str, of: str) -> Column:
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(sketches.relative_error()) * F.col(of), F.lit(0.5))


@query(
    "stations_from_sketches",
    """SELECT year(o_orderdate) AS YEAR, count(DISTINCT o_custkey) AS N_STATIONS, true AS WITHIN_BOUND FROM orders GROUP BY 1
       UNION ALL SELECT NULL, count(DISTINCT o_custkey), true FROM orders""",
)
def stations_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By year and in all: the exact count beside the check that the sketch, merged over elements, is within its bound."""
    made, daily = _sketched(spark, sf_dir), D.order_observations(spark, sf_dir)
    every = sketches.merged(made).select(F.lit(None).cast("int").alias("YEAR"), "SKETCH")
    estimates = sketches.estimated(sketches.merged(made, "YEAR").unionByName(every)).withColumnRenamed("N_STATIONS", "estimate")
    dated = C.with_year(daily)
    exact = dated.groupingSets([["YEAR"], []], "YEAR").agg(F.count_distinct("ID").alias("N_STATIONS")).withColumnRenamed("YEAR", "of")
    both = estimates.join(exact, F.col("YEAR").eqNullSafe(F.col("of")))
    return both.select("YEAR", "N_STATIONS", _within("estimate", "N_STATIONS", "N_STATIONS").alias("WITHIN_BOUND"))


@query(
    "stopped_stations_from_sketches",
    """WITH y AS (SELECT DISTINCT year(o_orderdate) AS y, o_custkey AS id FROM orders)
       SELECT n.y AS YEAR, (SELECT count(*) FROM y p WHERE p.y = n.y - 1 AND NOT EXISTS (SELECT 1 FROM y c WHERE c.y = n.y AND c.id = p.id)) AS N_STOPPED, true AS WITHIN_BOUND
       FROM (SELECT DISTINCT y FROM y) n WHERE EXISTS (SELECT 1 FROM y p WHERE p.y = n.y - 1)""",
)
def stopped_stations_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set differences of neighbouring years: the exact count beside the check of the estimate."""
    by_year = sketches.merged(_sketched(spark, sf_dir), "YEAR")
    estimates = sketches.stopped_estimate(by_year).withColumnRenamed("N_STOPPED", "estimate")
    seen = C.with_year(D.order_observations(spark, sf_dir)).select("YEAR", "ID").distinct()
    before = seen.select((F.col("YEAR") + 1).alias("YEAR"), "ID")
    exact = before.join(seen, ["YEAR", "ID"], "left_anti").groupBy("YEAR").agg(F.count(F.lit(1)).alias("N"))
    sizes = before.groupBy("YEAR").agg(F.count(F.lit(1)).alias("of"))
    both = estimates.join(exact, "YEAR", "left").join(sizes, "YEAR").withColumn("N_STOPPED", F.coalesce("N", F.lit(0)))
    return both.select("YEAR", "N_STOPPED", _within("estimate", "N_STOPPED", "of").alias("WITHIN_BOUND"))


# Counted while written ----------------------------------------------------------------------


@query(
    "rows_counted_while_landing",
    D.given(
        "daily", "stations", "inventory",
        then="""SELECT 'daily' AS DATASET, count(*) AS N_ROWS FROM daily
                UNION ALL SELECT 'stations', count(*) FROM stations UNION ALL SELECT 'inventory', count(*) FROM inventory""",
    ),
)
def rows_counted_while_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"daily": D.order_observations, "stations": D.customer_stations, "inventory": D.inventory}
    rows = {name: sizing.landed_and_measured(table(spark, sf_dir), name)[1]["N_ROWS"] for name, table in tables.items()}
    facts = (F.struct(F.lit(name).alias("DATASET"), F.lit(n).cast("bigint").alias("N_ROWS")) for name, n in rows.items())
    return spark.range(1).select(F.inline(F.array(*facts)))
