"""Landing what changed, and lines that cannot be read."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from weatherloom.sources import landing, observations


def line(station, date, value="10", element="PRCP"):
    return f"{station},{date},{element},{value},,,S,0630"


@pytest.fixture
def folder(tmp_path):
    """put(name, *lines) writes a gzip file with a modification time of its own."""
    source = tmp_path / "source"
    source.mkdir()
    clock = [1_600_000_000]

    def put(name, *lines):
        clock[0] += 60
        with gzip.open(source / name, "wt") as out:
            out.writelines(f"{x}\n" for x in lines)
        os.utime(source / name, (clock[0], clock[0]))

    return source, str(tmp_path / "root"), put


def current(spark, root):
    return sorted((r["ID"], r["DATE"], r["VALUE"], r["YEAR"]) for r in landing.read_current(spark, root).collect())


def years(df):
    return {(r["YEAR"], r["N_ROWS"]) for r in df.collect()}


def full(spark, source):
    """What one landing of all files gives."""
    rows = observations.read_observations(spark, str(source))
    return sorted((r["ID"], r["DATE"], r["VALUE"], int(r["DATE"][:4])) for r in rows.collect())


def test_only_changed_years_are_written_again(spark, folder):
    source, root, put = folder
    put("1990.csv.gz", line("A", "19900101"), line("B", "19900102"))
    put("1991.csv.gz", line("A", "19910101"))
    assert years(landing.land_changes(spark, str(source), root)) == {(1990, 2), (1991, 1)}
    before = {f: f.stat().st_mtime_ns for f in __import__("pathlib").Path(root, "daily", "YEAR=1990").glob("*.parquet")}
    assert landing.land_changes(spark, str(source), root).count() == 0
    put("1991.csv.gz", line("A", "19910101"), line("C", "19910203", "7"))
    assert years(landing.land_changes(spark, str(source), root)) == {(1991, 2)}
    assert before == {f: f.stat().st_mtime_ns for f in __import__("pathlib").Path(root, "daily", "YEAR=1990").glob("*.parquet")}
    assert current(spark, root) == full(spark, source)
    rollup = landing.read_current(spark, root, "rollup")
    assert {(r["YEAR"], r["ID"], r["SUM_VALUE"]) for r in rollup.collect()} == {(1990, "A", 10), (1990, "B", 10), (1991, "A", 10), (1991, "C", 7)}


def test_a_year_spread_over_files_keeps_the_rows_of_the_others(spark, folder):
    source, root, put = folder
    put("one.csv.gz", line("A", "19900101"), line("A", "19910101"))
    put("two.csv.gz", line("B", "19910102"), line("B", "19920102"))
    landing.land_changes(spark, str(source), root)
    put("one.csv.gz", line("A", "19900101", "1"), line("A", "19930101"))
    assert years(landing.land_changes(spark, str(source), root)) == {(1990, 1), (1991, 1), (1993, 1)}
    assert current(spark, root) == full(spark, source)


def test_removed_files_and_empty_ones(spark, folder):
    source, root, put = folder
    put("1990.csv.gz", line("A", "19900101"))
    put("1991.csv.gz", line("A", "19910101"))
    put("1992.csv.gz")
    landing.land_changes(spark, str(source), root)
    (source / "1990.csv.gz").unlink()
    assert years(landing.land_changes(spark, str(source), root)) == {(1990, 0)}
    assert current(spark, root) == full(spark, source)
    assert {r["file"].rsplit("/", 1)[-1] for r in landing.manifest(spark, root).collect()} == {"1991.csv.gz", "1992.csv.gz"}
    put("1990.csv.gz", line("Z", "19900105"))
    landing.land_changes(spark, str(source), root)
    assert current(spark, root) == full(spark, source)


def test_a_landing_cut_short_is_done_again(spark, folder, monkeypatch):
    source, root, put = folder
    put("1990.csv.gz", line("A", "19900101"))
    landing.land_changes(spark, str(source), root)
    put("1990.csv.gz", line("A", "19900101"), line("B", "19900102"))

    def lost(daily):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(observations, "rollup_observations", lost)
        with pytest.raises(RuntimeError):
            landing.land_changes(spark, str(source), root)
    assert years(landing.land_changes(spark, str(source), root)) == {(1990, 2)}
    assert current(spark, root) == full(spark, source)
    assert landing.read_current(spark, root, "rollup").count() == 2


def test_unread_lines_are_counted_and_kept(spark, folder):
    source, root, put = folder
    put("1990.csv.gz", line("A", "19900101"), "A,19900102,PRCP", line("A", "19900103", "x"), line("A", "19900104") + ",more", "", 'B,"open,PRCP,1,,,S,')
    put("1991.csv.gz", line("A", "19910101"))
    read, unread = landing.split_lines(landing.read_lines(spark, str(source)), f"{root}-split")
    assert {r[landing.UNREAD] for r in unread.collect()} == {"A,19900102,PRCP", line("A", "19900103", "x"), line("A", "19900104") + ",more", 'B,"open,PRCP,1,,,S,'}
    counted = landing.line_counts(read, unread).select(F.regexp_extract(landing.FILE, r"(\d+)\.csv", 1), "N_LINES", "N_READ", "N_UNREAD")
    assert {tuple(r) for r in counted.collect()} == {("1990", 5, 1, 4), ("1991", 1, 1, 0)}
    landing.land_changes(spark, str(source), root)
    assert {(r["year"], r["n_rows"], r["n_unread"]) for r in landing.manifest(spark, root).collect()} == {(1990, 1, 4), (1991, 1, 0)}
    assert spark.read.parquet(f"{root}/unread").count() == 4
    assert current(spark, root) == [("A", "19900101", 10.0, 1990), ("A", "19910101", 10.0, 1991)]


def test_rows_without_a_year_are_landed(spark, folder):
    source, root, put = folder
    put("odd.csv.gz", line("A", "bad"), line("A", "19900101"))
    assert years(landing.land_changes(spark, str(source), root)) == {(None, 1), (1990, 1)}
    assert landing.read_current(spark, root).count() == 2
    put("odd.csv.gz", line("A", "bad"), line("B", "worse"))
    assert years(landing.land_changes(spark, str(source), root)) == {(None, 2), (1990, 0)}
    assert {r["DATE"] for r in landing.read_current(spark, root).collect()} == {"bad", "worse"}
