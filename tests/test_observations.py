from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from weatherloom.operators import counts, gaps, report, series, unpaired
from weatherloom.sources.observations import rollup_observations


def test_element_counts_and_profile(daily_of):
    daily = daily_of([("A", "20200101", e, 1.0) for e in ("PRCP", "PRCP", "PRCP", "TMAX", "WT01")])
    got = [tuple(r) for r in counts.element_counts(daily).collect()]
    assert got == [("PRCP", 3, 0.75), ("TMAX", 1, 0.25)]
    assert len(counts.element_counts(daily, core_only=False).collect()) == 3
    assert tuple(counts.element_profile(daily).first()) == (3, 5, 4, 0.8)
    rollup = rollup_observations(daily)
    assert [tuple(r) for r in counts.element_counts(rollup).collect()] == got
    assert tuple(counts.element_profile(rollup).first()) == (3, 5, 4, 0.8)


def test_profile_of_nothing(daily_of):
    assert tuple(counts.element_profile(daily_of([])).first()) == (0, 0, 0, None)


def test_rollup(daily_of):
    daily = daily_of([("A", "20200101", "PRCP", 1.0), ("A", "20200301", "PRCP", None), ("A", "20210101", "PRCP", 5.0)])
    rows = sorted(map(tuple, rollup_observations(daily).collect()))
    assert rows[0] == (2020, "A", "PRCP", 2, 1, 1.0, date(2020, 1, 1), date(2020, 3, 1))


@pytest.fixture
def mixed(daily_of):
    return daily_of(
        [
            ("A", "20200101", "TMAX", 1.0), ("A", "20200101", "TMIN", 1.0),
            ("A", "20200102", "TMAX", 1.0), ("A", "20200102", "TMAX", 2.0),
            ("A", "20200103", "TMIN", 1.0),
            ("B", "20200101", "TMAX", 1.0), ("B", "20200101", "PRCP", 1.0),
            ("C", None, "TMAX", 1.0), ("C", None, "TMIN", 1.0),
        ]
    )


def test_unpaired(mixed, rows_of):
    anti = mixed.where("ELEMENT = 'TMAX'").join(mixed.where("ELEMENT = 'TMIN'"), ["ID", "DATE"], "left_anti")
    assert rows_of(unpaired.unpaired_observations(mixed)) == rows_of(anti, "ID", "DATE")
    assert rows_of(unpaired.unpaired_days(mixed)) == [("A", "20200102", 2), ("B", "20200101", 1), ("C", None, 1)]
    assert tuple(unpaired.unpaired_summary(mixed).first()) == (4, 3)
    assert tuple(unpaired.unpaired_summary(mixed, "TMIN", "TMAX").first()) == (2, 2)


def test_unpaired_copies_are_written_in_chunks(daily_of, monkeypatch):
    monkeypatch.setattr(unpaired, "_CHUNK", 4)
    for n in (1, 4, 5, 11):
        daily = daily_of([("A", "20200101", "TMAX", 1.0)] * n)
        assert unpaired.unpaired_observations(daily).count() == n


def test_unpaired_scans_once_without_a_join(mixed, plan_of):
    plan = plan_of(unpaired.unpaired_days(mixed))
    assert "Join" not in plan
    assert plan.split("(1)")[0].count("Exchange") == 1


@pytest.fixture
def stations(spark):
    rows = [("NZ1", "one", "NZ"), ("NZ2", "two", "NZ"), ("AU1", "far", "AU")]
    return spark.createDataFrame(rows, "ID string, NAME string, COUNTRY_CODE string")


def test_temperature_observations(daily_of, stations):
    daily = daily_of([("NZ1", "20200101", "TMIN", 101.0), ("NZ1", "20200101", "PRCP", 5.0), ("AU1", "20200101", "TMAX", 3.0), ("QQ1", "20200101", "TMAX", 3.0)])
    for limit in (0, 1 << 26):
        rows = series.temperature_observations(daily, stations, broadcast_limit=limit).collect()
        assert [(r.ID, r.NAME, r.TEMP_C) for r in rows] == [("NZ1", "one", 10.1)]
    by_id = stations.drop("COUNTRY_CODE")
    assert series.temperature_observations(daily, by_id, country="AU").first().ID == "AU1"


def months(n, missing=(), station="NZ1", element="TMIN", start=2000):
    return [
        (station, f"{start + m // 12}{m % 12 + 1:02d}{day:02d}", element, float(10 * m + day))
        for m in range(n) if m not in missing for day in (1, 2)
    ]


def test_monthly_means_and_weighting(daily_of, stations, rows_of):
    rows = [("NZ1", "20200101", "TMIN", 100.0), ("NZ1", "20200102", "TMIN", 200.0), ("NZ1", "20200103", "TMIN", None), ("NZ2", "20200101", "TMIN", 300.0)]
    temps = series.temperature_observations(daily_of(rows), stations)
    assert rows_of(series.monthly_means(temps.drop("NAME"), stations)) == rows_of(series.monthly_means(temps))
    assert rows_of(series.monthly_means(temps)) == [
        ("NZ1", "one", "TMIN", date(2020, 1, 1), 15.0), ("NZ2", "two", "TMIN", date(2020, 1, 1), 30.0),
    ]
    assert series.country_monthly_means(temps).first().TEMP_C == 20.0
    assert series.country_monthly_means(temps, weighting="station").first().TEMP_C == 22.5
    with pytest.raises(ValueError):
        series.country_monthly_means(temps, weighting="area")


def test_pivot(daily_of, stations):
    rows = [("NZ1", "20200101", "TMIN", 100.0), ("NZ1", "20200101", "TMAX", 200.0), ("NZ1", "20200201", "TMAX", 210.0)]
    temps = series.temperature_observations(daily_of(rows), stations)
    got = {r.YEAR_MONTH: (r.TMIN, r.TMAX) for r in series.monthly_pivot(temps).collect()}
    assert got == {date(2020, 1, 1): (10.0, 20.0), date(2020, 2, 1): (None, 21.0)}


def test_rolling_mean_needs_all_twelve_months(daily_of, stations):
    temps = series.temperature_observations(daily_of(months(40, missing={20})), stations)
    rolled = series.rolling_mean(series.monthly_means(temps)).orderBy("YEAR_MONTH").collect()
    assert len(rolled) == 39
    number = [(r.YEAR_MONTH.year - 2000) * 12 + r.YEAR_MONTH.month - 1 for r in rolled]
    for m, r in zip(number, rolled):
        window = range(m - 11, m + 1)
        if min(window) < 0 or 20 in window:
            assert r.ROLLING_C is None
        else:
            assert r.ROLLING_C == pytest.approx(sum(m2 + 0.15 for m2 in window) / 12)


def test_dense_months(daily_of, stations):
    rows = months(14, missing={3, 4}) + months(2, station="NZ2", start=2002)
    temps = series.temperature_observations(daily_of(rows), stations)
    dense = series.dense_months(series.rolling_mean(series.monthly_means(temps)))
    got = dense.collect()
    assert len(got) == 2 * 26  # January 2000 to February 2002 for both stations
    assert len({(r.ID, r.ELEMENT, r.YEAR_MONTH) for r in got}) == len(got)
    assert sum(r.TEMP_C is not None for r in got) == 12 + 2
    assert all(r.ROLLING_C is None for r in got if r.TEMP_C is None)
    wider = series.dense_months(
        series.rolling_mean(series.monthly_means(temps)), first=F.lit(date(1999, 12, 1)), last=F.lit(date(2002, 3, 1))
    )
    assert wider.count() == 2 * 28


def test_series_share_one_shuffle_by_station(daily_of, stations, plan_of):
    monthly = series.monthly_means(daily_of(months(3)).withColumn("NAME", F.lit("x")))
    dense = series.dense_months(
        series.rolling_mean(monthly), first=F.lit(date(2000, 1, 1)), last=F.lit(date(2001, 1, 1))
    )
    tree = plan_of(dense).split("(1)")[0]
    assert tree.count("Exchange") == 2 and "Join" not in tree


def test_gap_years(daily_of):
    daily = daily_of([("A", f"{y}0101", "PRCP", 1.0) for y in (1999, 2000, 2004)])
    assert sorted(r.YEAR for r in gaps.gap_years(daily).collect()) == [2001, 2002, 2003]
    assert gaps.gap_years(daily_of([])).collect() == []
    assert tuple(gaps.year_coverage(daily.selectExpr("int(substring(DATE,1,4)) as YEAR")).first()) == (1999, 2004, 3, 3)


def test_gaps_of_days(daily_of, rows_of):
    start = date(2015, 4, 28)
    present = [0, 1, 1, 10, 11, 13]
    rows = [("A", f"{start + timedelta(d):%Y%m%d}", "TMIN", 1.0) for d in present]
    daily = daily_of(rows + [("B", "20150101", "TMIN", 1.0), ("A", "20150231", "TMIN", 1.0)])
    day = lambda n: start + timedelta(n)
    assert rows_of(gaps.gap_runs(daily)) == sorted([("A", day(2), day(9), 8), ("A", day(12), day(12), 1)], key=repr)
    missing = gaps.missing_days(daily)
    assert sorted(r.DAY for r in missing.collect()) == [day(n) for n in (2, 3, 4, 5, 6, 7, 8, 9, 12)]
    covered = {r.ID: tuple(r)[1:] for r in gaps.coverage(daily).collect()}
    assert covered["A"] == (7, 1, day(0), day(13), 14, 5, 9)
    assert covered["B"] == (1, 1, date(2015, 1, 1), date(2015, 1, 1), 1, 1, 0)


def test_the_whole_input_as_one_group(daily_of):
    daily = daily_of([("A", "20150101", "TMIN", 1.0), ("B", "20150102", "TMIN", 1.0), ("A", "20150105", "TMIN", 1.0)])
    assert [tuple(r) for r in gaps.gap_runs(daily, by=()).collect()] == [(date(2015, 1, 3), date(2015, 1, 4), 2)]
    assert gaps.missing_days(daily, by=()).count() == 2
    assert gaps.coverage(daily, by=()).first().MISSING_DAYS == 2


def test_coverage_over_several_years(daily_of):
    rows = [("A", f"{y}{m:02d}01", "TMIN", 1.0) for y in (2000, 2002) for m in (1, 2)] * 2
    row = gaps.coverage(daily_of(rows), by=("ELEMENT",)).first()
    assert (row.N_OBSERVATIONS, row.N_YEARS, row.OBSERVED_DAYS, row.EXPECTED_DAYS) == (8, 2, 4, 763)


def test_report_order(spark):
    df = spark.createDataFrame([(2001, "B"), (2000, "C"), (2001, "A")], "YEAR int, COUNTRY_CODE string")
    assert [tuple(r) for r in report.in_report_order(df).collect()] == [(2000, "C"), (2001, "A"), (2001, "B")]


def test_units_follow_the_element(spark, daily_of):
    stations = spark.createDataFrame([("NZ1", "a")], "ID string, NAME string")
    daily = daily_of([("NZ1", "20250101", "SNOW", 30.0), ("NZ1", "20250102", "TMAX", 30.0)])
    rows = series.temperature_observations(daily, stations, elements=("SNOW", "TMAX"))
    assert {r.ELEMENT: r.TEMP_C for r in rows.collect()} == {"SNOW": 30.0, "TMAX": 3.0}
    assert {r.ELEMENT: r.TEMP_C for r in series.monthly_means(rows).collect()} == {"SNOW": 30.0, "TMAX": 3.0}
    pivot = series.monthly_pivot(rows, ("SNOW", "TMAX")).first()
    assert (pivot.SNOW, pivot.TMAX) == (30.0, 3.0)
