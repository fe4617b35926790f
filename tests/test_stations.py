import pytest
from pyspark.sql import functions as F

from weatherloom.functions import columns as C
from weatherloom.operators import counts, enrich, integrity
from weatherloom.operators.sizing import bounded_collect, broadcast_if_small

INVENTORY = "ID string, ELEMENT string, FIRSTYEAR int, LASTYEAR int"
STATIONS = "ID string, LATITUDE double, LONGITUDE double, STATE string, NAME string, GSN_FLAG string, HCN_CRN_FLAG string"


@pytest.fixture
def stations(spark):
    return spark.createDataFrame(
        [
            ("US000000001", 40.0, -100.0, "CO", "one", "GSN", "HCN"),
            ("US000000002", 41.0, -101.0, "CO", "two", None, "CRN"),
            ("NZ000000001", -41.0, 174.0, None, "three", "GSN ", None),
            ("GQ000000001", 13.0, 144.0, "GU", "four", None, None),
            ("MQ000000001", 28.0, -177.0, " ", "five", None, "HCN"),
            ("XX000000001", None, None, None, "six", None, None),
        ],
        STATIONS,
    )


@pytest.fixture
def countries(spark):
    names = [("US", "United States"), ("NZ", "New Zealand"), ("GQ", "Guam [United States]"), ("MQ", "Midway Islands [United States}"), ("AF", "Afghanistan")]
    return spark.createDataFrame(names, "CODE string, NAME string")


@pytest.fixture
def states(spark):
    return spark.createDataFrame([("CO", "COLORADO"), ("GU", "GUAM")], "CODE string, NAME string")


@pytest.fixture
def inventory(spark):
    core = [("US000000001", e, 1900 + i, 2026) for i, e in enumerate(("PRCP", "SNOW", "SNWD", "TMAX", "TMIN"))]
    more = [("US000000002", e, 1950, 2020) for e in ("PRCP", "SNOW", "SNWD", "TMAX", "TMIN", "TAVG")]
    rest = [("NZ000000001", "PRCP", 1990, 2026), ("GQ000000001", "PRCP", 2027, 2030), ("GQ000000001", "TMAX", 2027, 2030), ("ZZ000000001", "PRCP", 1, 2)]
    return spark.createDataFrame(core + more + rest, INVENTORY)


def test_inventory_metrics(inventory):
    rows = {r.ID: r for r in enrich.inventory_metrics(inventory).collect()}
    one, two, nz, gq = (rows[i] for i in ("US000000001", "US000000002", "NZ000000001", "GQ000000001"))
    assert (one.FIRST_YEAR, one.LAST_YEAR, one.ELEMENTS) == (1900, 2026, ["PRCP", "SNOW", "SNWD", "TMAX", "TMIN"])
    assert (one.N_CORE_ELEMENTS, one.N_OTHER_ELEMENTS, one.HAS_ALL_CORE, one.PRECIP_ONLY, one.ACTIVE_IN_2026) == (5, 0, True, False, True)
    assert (two.N_CORE_ELEMENTS, two.N_OTHER_ELEMENTS, two.HAS_ALL_CORE, two.ACTIVE_IN_2026) == (5, 1, True, False)
    assert (nz.PRECIP_ONLY, nz.HAS_ALL_CORE, nz.ACTIVE_IN_2026) == (True, False, True)
    assert (gq.N_CORE_ELEMENTS, gq.PRECIP_ONLY, gq.ACTIVE_IN_2026) == (2, False, False)


def test_metrics_ignore_missing_elements(spark):
    df = spark.createDataFrame([("A", None, 1, 2), ("B", None, 1, 2), ("B", "PRCP", 1, 2), ("B", "PRCP", 1, 2)], INVENTORY)
    rows = {r.ID: r for r in enrich.inventory_metrics(df).collect()}
    assert (rows["A"].ELEMENTS, rows["A"].N_OTHER_ELEMENTS, rows["A"].PRECIP_ONLY) == ([], 0, False)
    assert (rows["B"].ELEMENTS, rows["B"].N_OTHER_ELEMENTS, rows["B"].PRECIP_ONLY) == (["PRCP"], 0, True)


def test_flag_counts_do_not_collect_the_element_sets(stations, countries, states, inventory, plan_of):
    enriched = enrich.enrich_stations(stations, countries, states, inventory)
    flags = enrich.flag_counts(enriched)
    assert tuple(flags.first()) == (2, 2, 1)
    assert "collect_set" not in plan_of(flags)


def test_enriched_stations_keep_every_station(stations, countries, states, inventory):
    enriched = enrich.enrich_stations(stations, countries, states, inventory)
    assert enriched.count() == stations.count()
    rows = {r.ID: r for r in enriched.collect()}
    assert rows["NZ000000001"].COUNTRY_NAME == "New Zealand"
    assert rows["US000000001"].STATE_NAME == "COLORADO"
    lost = rows["XX000000001"]
    assert (lost.COUNTRY_CODE, lost.COUNTRY_NAME, lost.ELEMENTS, lost.HAS_ALL_CORE, lost.PRECIP_ONLY) == ("XX", None, None, None, None)


def test_state_countries(stations, countries):
    named = enrich.with_name(C.with_country_code(stations), countries, "COUNTRY_CODE", "COUNTRY_NAME")
    assert [r.LABEL for r in enrich.state_countries(named).collect()] == ["GQ: Guam [United States]", "US: United States"]


def test_network_counts(stations, spark):
    row = counts.network_counts(stations).first().asDict()
    assert row == {
        "GSN": 2, "HCN": 2, "CRN": 1, "GSN_and_HCN": 1, "GSN_and_CRN": 0, "HCN_and_CRN": 0,
        "GSN_and_HCN_and_CRN": 0, "IN_MORE_THAN_ONE": 1,
    }
    assert set(counts.network_counts(spark.createDataFrame([], STATIONS)).first()) == {0}
    assert row["IN_MORE_THAN_ONE"] == row["GSN_and_HCN"] + row["GSN_and_CRN"] + row["HCN_and_CRN"] - 2 * row["GSN_and_HCN_and_CRN"]


def test_station_counts(stations, countries):
    assert counts.total_stations(stations.union(stations)).first()[0] == 6
    assert counts.southern_count(stations).first()[0] == 1
    assert counts.country_count(stations).first()[0] == 1
    named = enrich.with_name(C.with_country_code(stations), countries, "COUNTRY_CODE", "COUNTRY_NAME")
    assert counts.territory_count(named).first()[0] == 2
    totals = {(r.COUNTRY_NAME, r.IS_TOTAL): r.N_STATIONS for r in counts.territory_totals(named).collect()}
    assert totals == {("Guam [United States]", False): 1, ("Midway Islands [United States}", False): 1, (None, True): 2}


def test_stations_per_country_has_zeros(stations, countries):
    got = {r.CODE: r.N_STATIONS for r in counts.stations_per_country(stations, countries).collect()}
    assert got == {"US": 2, "NZ": 1, "GQ": 1, "MQ": 1, "AF": 0}


def test_inventory_integrity(stations, inventory):
    assert tuple(integrity.inventory_integrity(stations, inventory).first()) == (2, 1)
    assert sorted(r.ID for r in integrity.without_inventory(stations, inventory).collect()) == ["MQ000000001", "XX000000001"]
    assert [r.ID for r in integrity.orphan_inventory(stations, inventory).collect()] == ["ZZ000000001"]


@pytest.fixture
def facts(daily_of):
    ids = ["US000000001"] * 5 + ["NZ000000001"] * 2 + ["QQ000000001"] * 3
    return daily_of([(i, "20260101", "PRCP", 1.0) for i in ids])


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_integrity_both_ways(stations, facts, limit):
    known = integrity.known_ids(facts, stations, broadcast_limit=limit)
    unknown = integrity.unknown_in_observations(facts, stations, broadcast_limit=limit)
    assert sorted(r.ID for r in known.collect()) == ["NZ000000001", "US000000001"]
    assert [r.ID for r in unknown.collect()] == ["QQ000000001"]
    assert known.count() + unknown.count() == integrity.distinct_ids(facts).count()
    assert integrity.missing_from_observations(stations, facts).count() == 4
    assert integrity.observations_of(facts, stations, broadcast_limit=limit).count() == 7
    joined = integrity.with_station_columns(facts, stations, broadcast_limit=limit)
    assert joined.count() == 10 and joined.where("NAME is null").count() == 3


def test_known_ids_broadcast_a_checked_side_below_the_distinct(spark, stations, tmp_path, plan_of):
    """The observations are filtered while scanned; nothing but distinct IDs is shuffled."""
    path = str(tmp_path / "facts")
    spark.range(50_000).selectExpr("cast(id % 9000 as string) as ID", "id as VALUE").write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(integrity.known_ids(spark.read.parquet(path), stations))
        refused = plan_of(integrity.known_ids(spark.read.parquet(path), stations, broadcast_limit=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = plan.split("(1)")[0]
    assert "BroadcastHashJoin LeftSemi" in tree and "SortMergeJoin" not in tree
    assert tree.index("HashAggregate") < tree.index("BroadcastHashJoin")
    assert "ReadSchema: struct<ID:string>" in plan
    assert "BroadcastHashJoin" not in refused


@pytest.mark.parametrize("operator", [integrity.observations_of, integrity.with_station_columns])
def test_a_hot_station_is_split_when_stations_are_too_many_to_broadcast(spark, tmp_path, operator):
    facts, places = str(tmp_path / "facts"), str(tmp_path / "stations")
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000)
    spark.range(0, 300_000, 1, 4).select(hot.alias("ID"), F.col("id").alias("VALUE")).write.parquet(facts)
    spark.range(20_000).select(F.col("id").alias("ID"), F.lit("name").alias("NAME")).write.parquet(places)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = operator(spark.read.parquet(facts), spark.read.parquet(places), broadcast_limit=0)
        assert len(joined.collect()) == 300_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_broadcast_only_after_measuring(spark):
    wide = spark.range(1000).select(F.repeat(F.lit("x"), 10_000).alias("text"), "id")
    assert broadcast_if_small(wide, 1 << 20) is wide
    assert broadcast_if_small(wide, 1 << 30) is not wide
    nested = spark.range(1000).select(F.array_repeat(F.lit("TMAX"), 100).alias("ELEMENTS"))
    assert broadcast_if_small(nested, 1 << 10) is nested
    assert broadcast_if_small(nested) is not nested
    empty = spark.range(0)
    assert broadcast_if_small(empty) is not empty


def test_bounded_collect(spark):
    assert len(bounded_collect(spark.range(10), 10)) == 10
    with pytest.raises(RuntimeError, match="daily"):
        bounded_collect(spark.range(11), 10, "daily")


def test_activity_comparison(daily_of, inventory):
    daily = daily_of([("US000000001", "20260101", "PRCP", 1.0), ("US000000002", "20260101", "PRCP", 1.0), ("US000000002", "20250101", "PRCP", 1.0)])
    metrics = enrich.inventory_metrics(inventory)
    assert counts.active_count(daily, 2026).first()[0] == 2
    assert tuple(counts.activity_comparison(daily, metrics, 2026).first()) == (2, 2, 0, 1, 1)
