import gzip

import pytest
from pyspark.sql import functions as F

from weatherloom import schema as S
from weatherloom.operators import gaps
from weatherloom.sources import dimensions, files, observations, sinks

STATION_LINES = [
    "NZ000093417 -40.9000  174.9830    7.0    PARAPARAUMU AWS                GSN     93417",
    f"US1FLSL0019  xx.xxxx  -80.4333 -999.9 FL {'PORT ST. LUCIE 4.0 NE':<30}     CRN      ",
    "CA1AB000002  51.0     -114.0",
]


@pytest.fixture
def year_files(tmp_path):
    folder = tmp_path / "daily"
    folder.mkdir()
    contents = {
        1750: ["A0000000001,17500101,PRCP,25,,,E,"],
        2025: [
            "A0000000001,20250101,TMAX,101,,,S,0630",
            "A0000000001,20250230,TMIN,oops,, ,S,",
            "B0000000001,20250103,PRCP,0,T,X,S",
        ],
    }
    for year, lines in contents.items():
        with gzip.open(folder / f"{year}.csv.gz", "wt") as out:
            out.write("\n".join(lines) + "\n")
    return str(folder)


def test_read_observations(spark, year_files, rows_of):
    daily = observations.read_observations(spark, year_files)
    assert daily.schema == S.observations_schema()
    assert daily.count() == 4
    got = {(r.DATE, r.ELEMENT): r for r in daily.collect()}
    assert got["20250101", "TMAX"].OBSERVATION_TIME == "0630"
    assert got["20250230", "TMIN"].VALUE is None
    assert got["20250103", "PRCP"].OBSERVATION_TIME is None


def test_read_one_year(spark, year_files):
    assert observations.read_observations(spark, year_files, year=1750).count() == 1


def test_quality_and_year_filters(spark, year_files):
    daily = observations.read_observations(spark, year_files)
    assert observations.filter_quality(daily).count() == 4
    assert observations.filter_quality(daily, "ok").count() == 3
    assert observations.exclude_years(daily, (1750,)).count() == 3
    with pytest.raises(ValueError):
        observations.filter_quality(daily, "best")


def test_landing_keeps_every_row_and_prunes_years(spark, year_files, tmp_path, rows_of, plan_of):
    daily = observations.read_observations(spark, year_files)
    path = observations.land_observations(daily, str(tmp_path / "landed"))
    landed = observations.read_landed(spark, path)
    assert rows_of(landed.drop("YEAR")) == rows_of(daily)
    one = observations.read_landed(spark, path, years=1750)
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(YEAR" in plan_of(one) or "1750" in plan_of(one).split("PartitionFilters")[1][:120]


def _files_of(path, year):
    return len([f for f in (path / f"YEAR={year}").iterdir() if f.name.startswith("part-")])


@pytest.mark.parametrize("known", [True, False])
def test_a_year_in_one_gzip_file_is_landed_by_several_tasks(spark, tmp_path, known):
    folder = tmp_path / "daily"
    folder.mkdir()
    with gzip.open(folder / "2001.csv.gz", "wt") as out:
        out.writelines(f"S{n % 977:010},2001{n % 12 + 1:02}{n % 28 + 1:02},PRCP,{n},,,S,0630\n" for n in range(60000))
    with gzip.open(folder / "1750.csv.gz", "wt") as out:
        out.write("S0000000001,17500101,PRCP,1,,,S,0630\n")
    facts = files.file_facts(spark, str(folder)) if known else None
    daily = observations.read_observations(spark, str(folder))
    small = {"advisoryPartitionSizeInBytes": "100k", "coalescePartitions.minPartitionSize": "20k"}
    for name, value in small.items():
        spark.conf.set(f"spark.sql.adaptive.{name}", value)
    try:
        observations.land_observations(daily, str(tmp_path / "landed"), facts=facts, bucket_bytes=30_000, bucket_rows=5000)
    finally:
        for name in small:
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    assert observations.read_landed(spark, str(tmp_path / "landed")).count() == 60001
    assert _files_of(tmp_path / "landed", 2001) > 2
    assert _files_of(tmp_path / "landed", 1750) == 1


def test_land_a_row_without_a_year(spark, daily_of, tmp_path):
    daily = daily_of([("A", "bad", "PRCP", 1.0), ("A", "20010101", "PRCP", 2.0)])
    path = observations.land_observations(daily, str(tmp_path / "landed"))
    assert observations.read_landed(spark, path).where("YEAR is null").first().DATE == "bad"


def test_fixed_width_lines(spark):
    lines = spark.createDataFrame([(line,) for line in STATION_LINES], "value string")
    first, second, third = dimensions.parse_fixed_width(lines, S.STATIONS).collect()
    assert first.ID == "NZ000093417" and first.NAME == "PARAPARAUMU AWS"
    assert (first.LATITUDE, first.LONGITUDE, first.ELEVATION) == (-40.9, 174.983, 7.0)
    assert first.STATE is None and first.GSN_FLAG == "GSN" and first.WMO_ID == "93417"
    assert second.LATITUDE is None and second.ELEVATION == -999.9
    assert second.STATE == "FL" and second.HCN_CRN_FLAG == "CRN"
    assert third.LATITUDE == 51.0 and third.NAME is None and third.WMO_ID is None


def test_read_dimensions(spark, tmp_path):
    texts = {
        "stations": STATION_LINES,
        "countries": ["NZ New Zealand ", "US United States"],
        "states": ["FL FLORIDA"],
        "inventory": ["NZ000093417 -40.9000  174.9830 TMAX 1950 2026", "NZ000093417 -40.9000  174.9830 PRCP 1945 20x6"],
    }
    for name, lines in texts.items():
        (tmp_path / f"{name}.txt").write_text("\n".join(lines) + "\n")
    tables = dimensions.read_dimensions(spark, **{n: str(tmp_path / f"{n}.txt") for n in texts})
    assert tables["stations"].schema == S.station_schema()
    assert tables["inventory"].schema == S.inventory_schema()
    assert tables["countries"].first().NAME == "New Zealand"
    assert [r.LASTYEAR for r in tables["inventory"].orderBy("ELEMENT").collect()] == [None, 2026]
    counted = {r.DATASET: r.N_ROWS for r in dimensions.row_counts(tables).collect()}
    assert counted == {n: len(lines) for n, lines in texts.items()}


def test_parquet_by_country_prunes(spark, tmp_path, plan_of):
    df = spark.createDataFrame([("NZ1", "NZ", ["PRCP"]), ("US1", "US", ["TMAX", "TMIN"])], "ID string, COUNTRY_CODE string, ELEMENTS array<string>")
    for keys in (("COUNTRY_CODE",), ["COUNTRY_CODE"]):
        path = sinks.save(sinks.packed_by(df, "COUNTRY_CODE", 3), str(tmp_path / "t"), by=keys)
    back = spark.read.parquet(path).where("COUNTRY_CODE = 'NZ'")
    assert back.select("ID", "ELEMENTS").first() == ("NZ1", ["PRCP"])
    assert "PartitionFilters: [isnotnull(COUNTRY_CODE" in plan_of(back)


def test_coalesce_and_append(spark, tmp_path):
    df = spark.range(100).repartition(5)
    path = sinks.save(df, str(tmp_path / "t"), files=1)
    sinks.save(df, path, append=True)
    assert spark.read.parquet(path).count() == 200


def test_csv_gz(spark, tmp_path):
    df = spark.createDataFrame([(1997, "NZ", 1.25)], "YEAR int, COUNTRY_CODE string, M double")
    path = sinks.save(df, str(tmp_path / "c"), "csv", files=1)
    assert spark.read.schema(df.schema).option("header", True).csv(path).collect() == df.collect()
    assert len(list((tmp_path / "c").glob("*.csv.gz"))) == 1
    with pytest.raises(ValueError, match="ELEMENTS"):
        sinks.save(df.withColumn("ELEMENTS", F.array(F.lit("a"))), str(tmp_path / "d"), "csv")


def test_shared_path_uses_the_checkpoint_folder(spark):
    assert sinks.shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert sinks.shared_path(spark, "x") != sinks.shared_path(spark, "x")


def test_file_facts_and_shares(spark, year_files):
    facts = files.file_facts(spark, year_files, pattern="*.csv.gz")
    assert sorted(r.year for r in facts.collect()) == [1750, 2025]
    shares = files.size_shares(facts, "year").collect()
    assert sum(r.SHARE for r in shares) == pytest.approx(1.0)
    assert sorted(r.YEAR for r in gaps.missing_years(facts, "year").collect()) == list(range(1751, 2025))
    covered = gaps.year_coverage(facts, "year").first()
    assert (covered.N_YEARS, covered.N_MISSING) == (2, 274)


def test_expanded_bytes_and_estimate(spark, year_files):
    with gzip.open(f"{year_files}/2025.csv.gz", "rb") as f:
        size = len(f.read())
    assert files.expanded_bytes(spark, f"{year_files}/2025.csv.gz").first()[0] == size
    facts = spark.createDataFrame([(2025, 160283428), (2024, 100)], "year int, size long")
    row = files.expansion_estimate(facts, sample_year=2025, sample_expanded=1261472066).first()
    assert row.RATIO == pytest.approx(7.87, abs=0.005)
    assert row.ESTIMATED_SIZE == pytest.approx((160283428 + 100) * row.RATIO)


def test_listing_lines(spark):
    lines = [
        "Found 5 items",
        "-rw-r--r--  1 user group  12345 2024-01-01 00:00 hdfs://store/daily/1875.csv.gz",
        "-rw-r--r--  1          54321 2024-01-01 00:00 hdfs://store/daily/1763.csv.gz",
        "-rw-r--r--  1 user group  99999 2024-01-01 00:00 hdfs://store/readme.txt",
        "160283428 /daily/2025.csv.gz 3",
        "17 /daily/1999.csv.gz",
        "-rw-r--r--  1 user group  900 2024-01-01 00:00 hdfs://store/daily/1900.csv.gz",
        "unknown /daily/1901.csv.gz",
        "nothing here",
        "",
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    got = {year: size for year, size, name in files.parse_listing(df).collect() if name == f"{year}.csv.gz"}
    assert got == {1763: 54321, 1875: 12345, 1900: 900, 1901: None, 1999: 17, 2025: 160283428}
    assert tuple(files.unread_sizes(files.parse_listing(df)).first()) == (6, 1)
