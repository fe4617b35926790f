import pytest
from pyspark.sql import functions as F

from weatherloom.operators import rainfall
from weatherloom.sources.observations import rollup_observations


@pytest.fixture
def stations(spark):
    rows = [("EK1", "Malabo"), ("LI1", "Roberts"), ("LI2", "Monrovia"), ("NZ1", "Hokitika"), ("AF1", "Kabul")]
    return spark.createDataFrame(rows, "ID string, NAME string")


@pytest.fixture
def daily(daily_of):
    return daily_of(
        [
            ("EK1", "20000622", "PRCP", 4361.0),
            ("LI1", "20000101", "PRCP", 10.0), ("LI1", "20000102", "PRCP", None), ("LI2", "20000230", "PRCP", 30.0, "X"),
            ("LI2", "20010101", "PRCP", 0.0, " "),
            ("NZ1", "20000101", "TMAX", 99.0), ("NZ1", "20010101", "PRCP", None),
            ("QQ1", "20000101", "PRCP", 5.0),
        ]
    )


def table(df):
    return {(r.YEAR, r.COUNTRY_CODE): (r.AVG_DAILY_PRCP_MM, r.N_OBSERVATIONS, r.N_STATIONS) for r in df.collect()}


EXPECTED = {
    (2000, "EK"): (436.1, 1, 1),
    (2000, "LI"): (2.0, 3, 2),
    (2001, "LI"): (0.0, 1, 1),
    (2001, "NZ"): (None, 1, 1),
}


def test_country_year_means(daily, stations):
    assert table(rainfall.country_year_means(daily, stations)) == EXPECTED
    assert table(rainfall.country_year_means(daily, stations.union(stations))) == EXPECTED
    assert table(rainfall.country_year_means(rollup_observations(daily), stations)) == EXPECTED


def test_quality_and_excluded_years(daily, stations):
    clean = table(rainfall.country_year_means(daily, stations, quality="ok"))
    assert clean[2000, "LI"] == (1.0, 2, 1)
    assert set(table(rainfall.country_year_means(daily, stations, without_years=(2000,)))) == {(2001, "LI"), (2001, "NZ")}
    with pytest.raises(ValueError):
        rainfall.country_year_means(rollup_observations(daily), stations, quality="ok")


def test_country_name_is_carried(daily, stations):
    named = stations.withColumn("COUNTRY_CODE", F.substring("ID", 1, 2)).withColumn("COUNTRY_NAME", F.lower("COUNTRY_CODE"))
    means = rainfall.country_year_means(daily, named)
    assert means.columns == ["YEAR", "COUNTRY_CODE", "COUNTRY_NAME", "AVG_DAILY_PRCP_MM", "N_OBSERVATIONS", "N_STATIONS"]
    assert rainfall.highest_means(means, 1).first().LABEL == "ek (2000)"


def test_observations_are_summed_before_the_join(spark, tmp_path, stations, plan_of):
    path = str(tmp_path / "daily")
    spark.sql("select 'EK1' as ID, '20000622' as DATE, 'PRCP' as ELEMENT, 1.0D as VALUE, 'x' as SOURCE_FLAG").write.parquet(path)
    plan = plan_of(rainfall.country_year_means(spark.read.parquet(path), stations))
    assert "EqualTo(ELEMENT,PRCP)" in plan
    assert "ReadSchema: struct<ID:string,DATE:string,ELEMENT:string,VALUE:double>" in plan


def make(spark, values, n=1):
    rows = [(2025, f"C{i:02d}", float(v), i + n, 1) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "YEAR int, COUNTRY_CODE string, AVG_DAILY_PRCP_MM double, N_OBSERVATIONS long, N_STATIONS long")


def test_statistics(spark):
    means = make(spark, range(1, 101))
    row = rainfall.describe_means(means).first()
    assert (row.N, row.MEAN, row.MIN, row.P25, row.P50, row.P75, row.MAX) == (100, 50.5, 1.0, 25.75, 50.5, 75.25, 100.0)
    assert row.STDDEV == pytest.approx(29.0114919)
    assert rainfall.mean_percentiles(means).first().asDict() == pytest.approx({"P90": 90.1, "P95": 95.05, "P99": 99.01})
    assert tuple(rainfall.sparse_counts(means).first()) == (3, 10, 30)
    assert [r.N_OBSERVATIONS for r in rainfall.sparse_rows(means, 4).collect()] == [1, 2, 3, 4]


def test_highest_means_have_an_order_for_ties(spark):
    means = make(spark, [5, 9, 9, 1]).union(make(spark, [None and 0 or 9]).withColumn("YEAR", F.lit(2024)))
    top = rainfall.highest_means(means, 2).collect()
    assert [(r.YEAR, r.COUNTRY_CODE, r.LABEL) for r in top] == [(2024, "C00", "C00 (2024)"), (2025, "C01", "C01 (2025)")]
    assert rainfall.highest_means(means.where("false")).collect() == []


def test_observations_behind(daily, stations):
    means = rainfall.country_year_means(daily, stations)
    for limit in (0, 1 << 26):
        behind = rainfall.observations_behind(daily, stations, rainfall.highest_means(means, 1), broadcast_limit=limit)
        assert [(r.ID, r.DATE, r.VALUE) for r in behind.collect()] == [("EK1", "20000622", 4361.0)]


def test_countries_without_data(daily, stations):
    means = rainfall.country_year_means(daily, stations)
    without = rainfall.countries_without_data(stations, rainfall.means_for_year(means, 2001))
    assert sorted(r.COUNTRY_CODE for r in without.collect()) == ["AF", "EK"]


def test_iso3_and_ambiguity(spark):
    means = make(spark, range(4)).withColumn("COUNTRY_CODE", F.element_at(F.array(*map(F.lit, ["SV", "jn ", "NZ", "??"])), (F.col("N_OBSERVATIONS")).cast("int")))
    mapping = spark.createDataFrame([("SV", "SJM"), ("JN", "SJM"), ("NZ", "NZL")], "COUNTRY_CODE string, ISO3 string")
    mapped = rainfall.with_iso3(means, mapping)
    got = {r.COUNTRY_CODE: (r.ISO3, r.AMBIGUOUS) for r in mapped.collect()}
    assert got == {"SV": ("SJM", True), "jn ": ("SJM", True), "NZ": ("NZL", False), "??": (None, False)}
    assert tuple(rainfall.mapping_summary(mapped).first()) == (3, 1, 2, 1)


def test_iso3_by_name(spark):
    means = make(spark, [1]).withColumn("COUNTRY_NAME", F.lit("Burma"))
    mapping = spark.createDataFrame([("Burma", "MMR")], "COUNTRY_NAME string, ISO3 string")
    assert rainfall.with_iso3(means, mapping, on="COUNTRY_NAME").first().ISO3 == "MMR"


def test_conflicting_iso3_is_listed(spark):
    means = make(spark, [1]).withColumn("COUNTRY_CODE", F.lit("SX"))
    mapping = spark.createDataFrame([("SX", "BBB"), ("sx", "AAA"), ("SX", "AAA")], "COUNTRY_CODE string, ISO3 string")
    row = rainfall.with_iso3(means, mapping).first()
    assert (row.ISO3, row.ISO3_CONFLICT, row.AMBIGUOUS) == (None, ["AAA", "BBB"], True)


def test_display_cap_keeps_the_true_mean(spark):
    capped = rainfall.with_display_cap(make(spark, range(1, 101))).orderBy("AVG_DAILY_PRCP_MM").collect()
    assert [r.AVG_DAILY_PRCP_MM for r in capped] == [float(v) for v in range(1, 101)]
    assert capped[-1].SHOWN == pytest.approx(95.05) and capped[0].SHOWN == 1.0
