from datetime import date

import pytest
from pyspark.sql import functions as F

from weatherloom import schema as S
from weatherloom.functions import columns as C


def test_core_elements_units_and_radius():
    assert S.CORE_ELEMENTS == ("PRCP", "SNOW", "SNWD", "TMAX", "TMIN")
    assert set(S.CORE_ELEMENTS) <= set(S.ELEMENT_UNITS)
    assert S.EARTH_RADIUS_KM == 6371.0


def test_schemas():
    assert S.observations_schema().names[4:] == [
        "MEASUREMENT_FLAG", "QUALITY_FLAG", "SOURCE_FLAG", "OBSERVATION_TIME",
    ]
    assert S.observations_schema_short().names[4:] == ["MEASUREMENT", "QUALITY", "SOURCE", "TIME"]
    assert S.station_schema()["ELEVATION"].dataType.simpleString() == "double"
    assert S.inventory_schema()["FIRSTYEAR"].dataType.simpleString() == "int"
    assert S.country_schema().names == S.state_schema().names == ["CODE", "NAME"]
    assert all(f.nullable for f in S.observations_schema())


def test_calendar_from_text_keeps_year_and_month_of_impossible_dates(daily_of, rows_of):
    daily = daily_of([("A", "20250230", "PRCP", 1.0), ("A", "17500105", "PRCP", 1.0), ("A", None, "PRCP", 1.0), ("A", "junk", "PRCP", 1.0)])
    got = rows_of(C.with_calendar(daily), "DATE", "YEAR", "MONTH", "YEAR_MONTH", "DAY")
    assert ("20250230", 2025, 2, date(2025, 2, 1), None) in got
    assert ("17500105", 1750, 1, date(1750, 1, 1), date(1750, 1, 5)) in got
    assert (None, None, None, None, None) in got
    assert ("junk", None, None, None, None) in got


def test_calendar_from_dates_and_existing_year(spark):
    df = spark.sql("select date'2024-02-29' as DATE")
    assert tuple(C.with_calendar(df).first()) == (date(2024, 2, 29), 2024, 2, date(2024, 2, 1), date(2024, 2, 29))
    landed = spark.sql("select '20240229' as DATE, 1999 as YEAR")
    assert C.with_year(landed).first()["YEAR"] == 1999


def test_quality_flag_blank_or_missing_passes(spark):
    df = spark.createDataFrame([(None,), (" ",), ("",), ("X",)], "QUALITY_FLAG string")
    assert [r[0] for r in df.select(C.quality_ok()).collect()] == [True, True, True, False]


def test_scaling_and_units(spark):
    df = spark.createDataFrame([("PRCP", 4361.0), ("SNOW", 12.0), ("TMIN", -15.0), ("WT01", 1.0)], "e string, v double")
    got = df.select("e", C.in_units(F.col("e"), F.col("v")), C.unit_name(F.col("e"))).collect()
    assert [tuple(r) for r in got] == [("PRCP", 436.1, "mm"), ("SNOW", 12.0, "mm"), ("TMIN", -1.5, "°C"), ("WT01", 1.0, None)]


def test_territories_by_either_bracket_but_not_the_mainland(spark):
    df = spark.createDataFrame(
        [("GQ", "Guam [United States]"), ("MQ", "Midway Islands [United States}"), ("US", "United States"), ("NZ", "New Zealand"), ("XX", None)],
        "COUNTRY_CODE string, COUNTRY_NAME string",
    )
    assert [r[0] for r in df.where(C.is_territory()).collect()] == ["GQ", "MQ"]


def test_longitude_and_label(spark):
    df = spark.createDataFrame([(-176.5,), (174.8,), (None,)], "x double")
    assert [r[0] for r in df.select(C.wrapped_longitude(F.col("x"))).collect()] == [183.5, 174.8, None]
    label = spark.range(1).select(C.year_label(F.lit("Laos"), F.lit(1974))).first()[0]
    assert label == "Laos (1974)"


@pytest.mark.parametrize(
    "n, text",
    [(0, "0.00 B"), (1023, "1,023.00 B"), (1024, "1.00 KB"), (11395086, "10.87 MB"), (14116195511, "13.15 GB"),
     (-2048, "-2.00 KB"), (1024**5, "1.00 PB"), (1024**6, "1,024.00 PB")],
)
def test_bytes_text(spark, n, text):
    assert spark.range(1).select(C.bytes_text(F.lit(float(n)))).first()[0] == text


def test_year_in_filename(spark):
    paths = [("s3://b/daily/1875.csv.gz",), ("1875.csv.gz",), ("/daily/x1875.csv.gz",), ("/daily/1875.csv",)]
    df = spark.createDataFrame(paths, "p string")
    assert [r[0] for r in df.select(C.year_in_filename(F.col("p"))).collect()] == [1875, 1875, None, None]
