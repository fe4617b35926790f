"""Buckets, the curve, percentiles, bitmaps and the audit of plans."""

import math
import random

import pytest
from pyspark.sql import functions as F

from weatherloom.operators import names, presence, selection, sizing, sketches, unpaired
from weatherloom.plans import audit, layout_queries
from weatherloom.plans import standins as D
from weatherloom.sources import storage

SF = "/root/testdata/sf0.001"


# Buckets


@pytest.fixture(scope="module")
def bucketed(spark):
    return layout_queries.by_station(spark, SF)


def test_aggregates_and_joins_by_station_need_no_exchange(spark, bucketed):
    daily, stations = bucketed
    for df in (
        daily.groupBy("ID", "ELEMENT").count(),
        unpaired.unpaired_days(daily),
        daily.select("ID").distinct().join(stations.hint("merge").select("ID"), "ID", "left_anti"),
        daily.groupBy("ID").agg(F.sum("VALUE").alias("s")).join(stations.hint("merge"), "ID"),
    ):
        assert audit.exchanges(df) == 0
    plain = D.order_observations(spark, SF)
    assert audit.exchanges(plain.groupBy("ID", "ELEMENT").count()) == 1


def test_each_bucket_is_sorted_in_one_file(spark, bucketed):
    daily, _ = bucketed
    assert len(daily.inputFiles()) <= layout_queries.BUCKETS
    assert daily.count() == D.order_observations(spark, SF).count()


# Curve


def test_curve_takes_bits_in_turn(spark):
    rows = [(x, y) for x in range(8) for y in range(8)]
    df = spark.createDataFrame(rows, "x int, y int").withColumn("k", storage.curve_key(F.col("x"), F.col("y"), bits=3))
    for r in df.collect():
        assert r["k"] == int("".join(f"{a}{b}" for a, b in zip(f"{r['x']:03b}", f"{r['y']:03b}")), 2)
    assert df.select("k").distinct().count() == 64
    with pytest.raises(ValueError):
        storage.curve_key(F.col("x"), F.col("x"), F.col("x"), F.col("x"), bits=16)


def test_axis_ends(spark):
    df = spark.createDataFrame([(-999.0,), (-90.0,), (0.0,), (90.0,), (999.0,), (None,)], "v double")
    got = [r[0] for r in df.select(storage.on_axis(F.col("v"), -90, 90, 4)).collect()]
    assert got == [0, 0, 7, 15, 15, None]


def test_box_and_days_read_few_rows(spark, tmp_path):
    stations = spark.range(400).select(
        F.col("id").cast("string").alias("ID"), ((F.col("id") % 20) * 9 - 85.0).alias("LATITUDE"), (F.floor(F.col("id") / 20) * 18 - 175.0).alias("LONGITUDE")
    )
    days = spark.range(400).select(F.col("id").alias("d"))
    daily = stations.select("ID").join(days).select("ID", F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), F.col("d").cast("int")), "yyyyMMdd").alias("DATE"), F.lit(1.0).alias("VALUE"))
    daily = daily.where("ID <> '7'").union(spark.createDataFrame([("none", "19950101", 1.0), ("0", "bad", 2.0)], "ID string, DATE string, VALUE double"))
    path = storage.save_along_curve(daily, stations, str(tmp_path / "curve"), files=16, row_group_bytes=64 * 1024)
    by_day = str(tmp_path / "by-day")
    spark.read.parquet(path).repartitionByRange(16, "DAY").sortWithinPartitions("DAY").write.option("parquet.block.size", 64 * 1024).parquet(by_day)
    wanted = dict(latitude=(-50, -20), longitude=(-100, -40), first_day="1995-05-01", last_day="1995-05-31")
    here = dict(wanted, first_day="1990-01-01", last_day="2000-01-01")
    everywhere = dict(wanted, latitude=(-90, 90), longitude=(-180, 180))
    curve, plain = spark.read.parquet(path), spark.read.parquet(by_day)
    total = daily.count()
    assert curve.count() == total
    for box in (wanted, here, everywhere):
        assert sorted(map(tuple, storage.in_box(curve, **box).collect())) == sorted(map(tuple, storage.in_box(plain, **box).collect()))
        assert audit.scanned_rows(storage.in_box(curve, **box)) < total / 2
    assert audit.scanned_rows(storage.in_box(curve, **wanted)) < total / 8
    assert audit.scanned_rows(storage.in_box(plain, **here)) > total * 0.9
    over_the_date_line = storage.in_box(curve, latitude=(-90, 90), longitude=(160, -170), first_day="1995-01-01", last_day="1995-01-01")
    assert {r["LONGITUDE"] for r in over_the_date_line.select("LONGITUDE").distinct().collect()} == {167.0, -175.0}


# Percentiles


def ranked(values, share):
    n = len(values)
    return sorted(values)[max(n - math.floor(n - n * share), 1) - 1]


@pytest.mark.parametrize("bins", [2, 3, 1024])
def test_percentiles_are_exact(spark, bins):
    rng = random.Random(bins)
    groups = {
        "even": [float(i) for i in range(101)], "same": [4.0] * 50, "one": [7.5], "ties": [1.0] * 90 + [2.0] * 10,
        "wide": [-1e300, 1e-300, 0.0, 5e-324, 1e300, 12.0], "ends": [float("-inf"), 1.0, 2.0, float("inf")], None: [3.0, -3.0, -0.0, 0.0],
        "random": [rng.gauss(0, 1) * 10 ** rng.randrange(6) for _ in range(300)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("even", None), ("empty", None), ("even", float("nan"))]
    shares = (0.0, 0.25, 0.5, 0.9, 0.99, 1.0, 0.5)
    got = selection.percentiles(spark.createDataFrame(rows, "g string, v double").repartition(4), "v", shares, by=["g"], bins=bins)
    got = {(r["g"], r["SHARE"]): (r["N_VALUES"], r["PERCENTILE"]) for r in got.collect()}
    assert got == {(g, s): (len(v), ranked(v, s)) for g, v in groups.items() for s in shares}


def test_no_task_holds_a_group(spark):
    """One value in a million different ones of one group: what is shuffled is counts of bins."""
    df = spark.range(200_000).select(F.lit("hot").alias("g"), ((F.col("id") * 7919) % 200_003).cast("double").alias("v"))
    rows = df.withColumn("v", F.col("v"))
    state = spark.createDataFrame([("hot", 200_000, 0.0, 200_002.0, 0.5, 100_000)], "g string, n long, low double, high double, share double, rank long")
    narrowed = selection._narrowed(rows, state, ["g"], 64)
    low, high, rank = narrowed.select("low", "high", "rank").first()
    assert high - low < 200_003 / 64 and 1 <= rank <= 3200
    assert "collect_list" not in narrowed._jdf.queryExecution().toString()
    assert not any("Python" in f.kind for f in audit.findings(narrowed))


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert selection.percentiles(empty, "v", [0.5], by=["g"]).collect() == []
    assert selection.percentiles(empty, "v", [0.5]).collect() == []
    with pytest.raises(ValueError):
        selection.percentiles(empty, "v", [1.5])


# Bitmaps


@pytest.fixture(scope="module")
def seen(spark):
    stations = spark.range(100_000).select(F.format_string("S%06d", "id").alias("ID"))
    daily = spark.range(100_000).where("id % 3 = 0 OR id > 99000").select(
        F.format_string("S%06d", "id").alias("ID"), F.when(F.col("id") % 2 == 0, "19900101").otherwise("19920101").alias("DATE")
    )
    daily = daily.union(spark.createDataFrame([("S000000", "19920505"), ("unknown", "19900101"), (None, "19900101"), ("S000003", "bad")], "ID string, DATE string"))
    numbers = presence.numbered(stations.union(stations).union(spark.createDataFrame([(None,)], "ID string")))
    return daily, numbers, presence.presence(daily, numbers)


def test_numbers_are_dense_and_in_order(seen):
    _, numbers, _ = seen
    rows = sorted(map(tuple, numbers.collect()))
    assert [n for _, n in rows] == list(range(1, 100_001))


def test_bitmaps_give_what_the_observations_give(spark, seen):
    daily, numbers, table = seen
    known = {r["ID"] for r in numbers.collect()}
    observed = {(r["ID"], r["DATE"][:4]) for r in daily.collect() if r["ID"] in known}
    ever = {i for i, _ in observed}
    assert {r["ID"] for r in presence.never_observed(numbers, table).collect()} == known - ever
    assert {r["ID"] for r in presence.absent_in(numbers, table, 1990).collect()} == known - {i for i, y in observed if y == "1990"}
    assert presence.absent_in(numbers, table, 1950).count() == len(known)
    counts = {r["YEAR"]: r["N_STATIONS"] for r in presence.observed_counts(table, "YEAR").collect()}
    assert counts == {None: 1, 1990: len({i for i, y in observed if y == "1990"}), 1992: len({i for i, y in observed if y == "1992"})}
    assert presence.observed_counts(presence.in_span(table, 1990, 1992)).first()[0] == len({i for i, y in observed if y in ("1990", "1992")})
    assert {r["ID"] for r in presence.stopped(numbers, table, 1992, 2).collect()} == {i for i, y in observed if y == "1990"} - {i for i, y in observed if y == "1992"}


def test_tables_made_apart_merge(spark, seen):
    daily, numbers, table = seen
    halves = [presence.presence(daily.where(c), numbers) for c in ("ID < 'S050000'", "ID >= 'S050000'")]
    together = presence.merged(halves[0].union(halves[1]), "YEAR")
    assert sorted(map(repr, together.collect())) == sorted(map(repr, table.select("YEAR", "BUCKET", "BITS").collect()))
    assert presence.observed_counts(presence.presence(daily.limit(0), numbers)).first()[0] == 0


# Audit


def test_each_finding(spark, tmp_path):
    a, b = spark.range(50).toDF("x"), spark.range(60).toDF("y")
    spark.range(30).selectExpr("id", "id % 3 AS part").write.partitionBy("part").parquet(str(tmp_path / "parts"))
    parts = spark.read.parquet(str(tmp_path / "parts"))

    def kinds(df):
        return [f.kind for f in audit.findings(df)]

    assert kinds(a.hint("shuffle_replicate_nl").crossJoin(b)) == ["cross join"]
    assert kinds(a.join(F.broadcast(b), F.col("x") < F.col("y"))) == ["nested loop"]
    assert kinds(a.mapInArrow(lambda batches: batches, "x long")) == ["python stage"]
    assert kinds(a.select(F.udf(lambda v: v, "long")("x"))) == ["python stage"]
    assert kinds(parts) == ["all partitions"]
    assert kinds(parts.where("part = 1")) == []
    assert kinds(a.join(b, F.col("x") == F.col("y"))) == ["estimated broadcast"]
    assert kinds(a.join(F.broadcast(b), F.col("x") == F.col("y"))) == []
    assert kinds(a.hint("merge").join(b, F.col("x") == F.col("y"))) == []


def test_audit_sees_through_adaptive_plans(spark):
    a = spark.range(1000).withColumn("k", F.col("id") % 7)
    df = a.groupBy("k").count()
    before = audit.exchanges(df)
    df.collect()
    assert before == audit.exchanges(df) == 1


@pytest.mark.parametrize("name", ["station_report", "never_observed_from_bits", "raw_percentiles", "elements_by_station", "country_year_means", "enriched_stations"])
def test_registered_plans_have_no_loops_and_no_python(spark, name):
    from weatherloom.plans.catalog import QUERIES

    bad = {"cross join", "nested loop", "python stage"}
    assert not bad & {f.kind for f in audit.findings(QUERIES[name](spark, SF))}


def test_report_scans_the_stations_once(spark):
    from weatherloom.plans.catalog import QUERIES

    scans = [n for n in audit.nodes(QUERIES["station_report"](spark, SF)) if n.nodeName().startswith("Scan")]
    assert sum("c_custkey" in n.simpleString(50) for n in scans) == 1


# Names


def test_spellings_are_matched_and_ties_reported(spark):
    known = [("Saint Lucia", "LCA"), ("Saint Lucie", "XXX"), ("Korea, North", "PRK"), ("Korea, South", "KOR"), ("Mali", "MLI"), ("Malta", "MLT"), ("Côte d'Ivoire", "CIV"), ("Mali", "ML2"), ("Niger", "NER"), ("Nigeria", "NGA"), (None, "NIL")]
    rows = [
        (1, "saint lucia [France]"), (2, "Saint Luci"), (3, "North Korea"), (4, "Korea South"), (5, "Mali"), (6, "Malta "), (7, "COTE D IVOIRE"),
        (8, "Nigera"), (9, "Atlantis"), (10, None), (11, "123 [x]"), (12, "Maltta"), (12, "Maltta"), (13, ""),
    ]
    got = names.match_names(spark.createDataFrame(rows, "ID int, NAME string"), spark.createDataFrame(known, "NAME string, KEY string"))
    by_id = sorted((r["ID"], r["KEY"], r["DISTANCE"], r["MATCH"], tuple(r["CANDIDATES"] or ())) for r in got.collect())
    assert [r[0] for r in by_id] == sorted(r[0] for r in rows)
    found = {r[0]: r[1:] for r in by_id}
    assert found[1] == ("LCA", 0, "equal", ("LCA",))
    assert found[2] == (None, 1, "tied", ("LCA", "XXX"))
    assert found[3][0] == "PRK" and found[4][0] == "KOR"
    assert found[5] == (None, 0, "tied", ("ML2", "MLI"))
    assert found[6][2] == "equal" and found[7] == ("CIV", 1, "near", ("CIV",))
    assert found[8] == (None, 1, "tied", ("NER", "NGA")) and found[12] == ("MLT", 1, "near", ("MLT",))
    assert all(found[i] == (None, None, "none", ()) for i in (9, 10, 11, 13))
    bad = {"cross join", "nested loop", "python stage"}
    assert not bad & {f.kind for f in audit.findings(got)}


# Sketches


def test_sketches_merge_and_stay_within_their_bound(spark):
    daily = spark.range(60_000).select(
        (F.col("id") % 20_000).cast("string").alias("ID"), F.when(F.col("id") < 30_000, "19900101").otherwise("19910101").alias("DATE"), (F.col("id") % 3).alias("PART")
    )
    daily = daily.union(spark.createDataFrame([(None, "19900101", 0), ("x", "bad", 0)], "ID string, DATE string, PART long"))
    made = sketches.station_sketches(daily, "PART")
    bound = sketches.relative_error()
    by_year = {r["YEAR"]: r["N_STATIONS"] for r in sketches.estimated(sketches.merged(made, "YEAR")).collect()}
    assert by_year[None] == 1
    assert all(abs(by_year[y] - 20_000) <= 20_000 * bound for y in (1990, 1991))
    halves = [sketches.station_sketches(daily.where(c)) for c in ("PART = 0", "PART <> 0")]
    apart = {r["YEAR"]: r["N_STATIONS"] for r in sketches.estimated(sketches.merged(halves[0].union(halves[1]), "YEAR")).collect()}
    assert all(abs(apart[y] - 20_000) <= 20_000 * bound for y in (1990, 1991))
    assert sketches.estimated(sketches.merged(made)).first()["N_STATIONS"] > 19_000


def test_small_sketches_are_exact_and_differ_exactly(spark):
    daily = spark.createDataFrame([(str(i), "19900101") for i in range(900)] + [(str(i), "19910101") for i in range(300, 1000)] + [("1", "19930101")], "ID string, DATE string")
    made = sketches.station_sketches(daily)
    assert {tuple(r) for r in sketches.estimated(made).collect()} == {(1990, 900), (1991, 700), (1993, 1)}
    assert {tuple(r) for r in sketches.stopped_estimate(made).collect()} == {(1991, 300)}
    assert {tuple(r) for r in sketches.stopped_estimate(made, 2).collect()} == {(1993, 699 + 1)}
    assert sketches.estimated(sketches.station_sketches(daily.limit(0))).collect() == []


# Counted while written


def test_a_landed_table_is_measured_by_its_own_write(spark):
    context = spark.sparkContext
    tracker = context.statusTracker()
    df = D.customer_stations(spark, SF)

    def jobs(group, run):
        context.setJobGroup(group, group)
        out = run()
        context.setLocalProperty("spark.jobGroup.id", None)
        return out, len(tracker.getJobIdsForGroup(group))

    (landed, facts), measured = jobs("measured", lambda: sizing.landed_and_measured(df, "stations"))
    _, written = jobs("written", lambda: sizing.sinks.save(df, sizing.sinks.shared_path(spark, "plain")))
    assert measured == written
    assert facts["N_ROWS"] == df.count()
    assert facts["N_BYTES"] == df.agg(F.sum(sizing.row_bytes(df))).first()[0]
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, df.collect()))
    daily = D.order_observations(spark, SF)
    assert [f.kind for f in audit.findings(daily.join(landed, "ID"))] == []
    large, _ = sizing.landed_and_measured(df, "stations", limit_bytes=10)
    assert "strategy=broadcast" not in large._jdf.queryExecution().optimizedPlan().toString()
    assert sizing.landed_and_measured(df.limit(0), "none")[1] == {"N_ROWS": 0, "N_BYTES": 0}
