import math
import random

import pytest
from pyspark.sql import functions as F

from weatherloom.functions.geo import haversine_km
from weatherloom.operators import pairs

STATION = "ID string, LATITUDE double, LONGITUDE double, NAME string"


def km(a, b):
    (la, lo), (lb, lp) = [(math.radians(p[0]), math.radians(p[1])) for p in (a, b)]
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))


def distance(spark, *coordinates):
    values = [F.lit(c).cast("double") for c in coordinates]
    return spark.range(1).select(haversine_km(*values)).first()[0]


def test_pinned_distances(spark):
    assert distance(spark, -41.3, 174.8, -41.3, 174.8) == pytest.approx(0.0, abs=1e-9)
    assert distance(spark, -40.9, 174.983, -41.333, 174.8) == pytest.approx(50.5, abs=0.5)


def test_distance_is_that_of_the_law_of_cosines_both_ways(spark):
    for a, b in (((51.5, -0.12), (48.86, 2.35)), ((-33.9, 18.4), (64.1, -21.9)), ((0.0, 0.0), (0.0, 90.0))):
        (la, lo), (lb, lp) = [(math.radians(x), math.radians(y)) for x, y in (a, b)]
        angle = math.acos(math.sin(la) * math.sin(lb) + math.cos(la) * math.cos(lb) * math.cos(lp - lo))
        assert distance(spark, *a, *b) == pytest.approx(6371 * angle, abs=1e-6)
        assert distance(spark, *a, *b) == distance(spark, *b, *a)


@pytest.mark.parametrize("missing", range(4))
def test_missing_coordinate_gives_null(spark, missing):
    coordinates = [-41.3, 174.8, -40.0, 170.0]
    coordinates[missing] = None
    assert distance(spark, *coordinates) is None


def test_antipodes_and_meridian(spark):
    assert distance(spark, 10.0, 20.0, -10.0, -160.0) == pytest.approx(math.pi * 6371, abs=1e-3)
    assert distance(spark, 10.0, 179.9, 10.0, -179.9) == pytest.approx(km((10, 179.9), (10, -179.9)), abs=1e-6)


@pytest.fixture(scope="module")
def points():
    draw = random.Random(7)
    scattered = [(f"S{i:04d}", math.degrees(math.asin(draw.uniform(-1, 1))), draw.uniform(-180, 180), f"n{i}") for i in range(300)]
    crowded = [(f"C{i:04d}", 40 + draw.uniform(0, 0.5), 8 + draw.uniform(0, 0.5), None) for i in range(150)]
    edges = [("E1", 10.0, 179.95, "e"), ("E2", 10.0, -179.95, "w"), ("P1", 90.0, 12.0, "p"), ("P2", 89.9, -100.0, "q")]
    return scattered + crowded + edges


def expected_pairs(points, radius):
    found = {}
    for i, a in enumerate(points):
        for b in points[i + 1:]:
            d = km(a[1:3], b[1:3])
            if d <= radius:
                found[tuple(sorted((a[0], b[0])))] = d
    return found


@pytest.mark.parametrize("radius", [5, 60, 700])
def test_pairs_within_equals_brute_force(spark, points, radius, monkeypatch):
    monkeypatch.setattr(pairs, "_ROWS_PER_TASK", 20)  # so that the crowd is split over tasks
    rows = pairs.pairs_within(spark.createDataFrame(points, STATION), radius).collect()
    got = {(r.ID_A, r.ID_B): r.DISTANCE_KM for r in rows}
    expected = expected_pairs(points, radius)
    assert len(rows) == len(got)
    assert set(got) == set(expected)
    assert all(got[p] == pytest.approx(expected[p], abs=1e-6) for p in got)


def test_radius_of_half_the_globe_gives_every_pair(spark, points):
    some = points[:40]
    assert pairs.pairs_within(spark.createDataFrame(some, STATION), 20016.0).count() == 40 * 39 // 2


def test_closest_pair_equals_brute_force(spark, points):
    for subset in (points, points[:300], points[300:], points[-4:], points[:2]):
        row = pairs.closest_pair(spark.createDataFrame(subset, STATION)).first()
        (a, b), d = min(expected_pairs(subset, 1e9).items(), key=lambda item: (item[1], item[0]))
        assert (row.ID_A, row.ID_B) == (a, b)
        assert row.DISTANCE_KM == pytest.approx(d, abs=1e-6)


def test_two_far_apart_points_are_the_closest_pair(spark):
    df = spark.createDataFrame([("A", 10.0, 20.0, None), ("B", -10.0, -160.0, None)], STATION)
    assert pairs.closest_pair(df).first().DISTANCE_KM == pytest.approx(math.pi * 6371, abs=1e-3)


def test_a_task_compares_two_parts_at_most(spark, points, monkeypatch):
    monkeypatch.setattr(pairs, "_ROWS_PER_TASK", 20)
    stations = spark.createDataFrame(points[:200], STATION).withColumns({"LATITUDE": F.col("LATITUDE") / 1e4, "LONGITUDE": F.col("LONGITUDE") / 1e4})
    met = pairs._met(pairs.fold_sites(stations), F.lit(700.0), spread=True)
    sizes = met.groupBy("cx", "cy", "cz", "offset", "part", "part_other").agg(
        F.countDistinct("site.ID").alias("a"), F.countDistinct("other.ID").alias("b")
    )
    assert sizes.count() >= 100  # one cell in ten parts, each of them meeting each
    assert max(sizes.agg(F.max("a"), F.max("b")).first()) <= 50


def test_stations_at_one_position(spark):
    df = spark.createDataFrame(
        [("B", 1.0, 2.0, "b"), ("A", 1.0, 2.0, "a"), ("C", 1.0, 362.0, "c"), ("D", 1.0, 2.1, "d"), ("N", None, 3.0, "n")], STATION
    )
    rows = pairs.pairs_within(df, 50).select("ID_A", "ID_B", F.round("DISTANCE_KM", 3), "N_A", "N_B").collect()
    assert sorted(map(tuple, rows)) == [("A", "B", 0.0, 1, 1), ("A", "C", 0.0, 1, 1), ("A", "D", 11.118, 3, 1)]
    members = pairs.site_members(df).collect()
    assert sorted(map(tuple, members)) == [("A", "A"), ("A", "B"), ("A", "C"), ("D", "D")]
    first = pairs.closest_pair(df).first()
    assert (first.ID_A, first.ID_B, first.NAME_B) == ("A", "B", "b")


def test_radius_zero_gives_only_equal_positions(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0, None), ("B", 1.0, 2.0, None), ("C", 1.0, 2.000001, None)], STATION)
    assert [(r.ID_A, r.ID_B) for r in pairs.pairs_within(df, 0).collect()] == [("A", "B")]
    with pytest.raises(ValueError):
        pairs.pairs_within(df, -1)


def test_poles_are_one_position(spark):
    df = spark.createDataFrame([(f"P{i}", -90.0, i * 11.0, None) for i in range(30)] + [("Q", -80.0, 0.0, None)], STATION)
    assert pairs.pairs_within(df, 1).count() == 29
    assert pairs.closest_pair(df).first().ID_B == "P1"


def test_null_coordinates_and_empty_input(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0, "a"), ("B", None, 2.0, "b")], STATION)
    assert pairs.closest_pair(df).collect() == []
    empty = spark.createDataFrame([], STATION)
    assert pairs.closest_pair(empty).collect() == []
    assert pairs.pairs_within(empty, 10).collect() == []


def test_without_names(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 2.5)], "ID int, LATITUDE double, LONGITUDE double")
    assert pairs.closest_pair(df).first().NAME_A is None
