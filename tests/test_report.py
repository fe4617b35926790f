"""Raw files of the real formats through to every published table."""

import gzip
import random
from collections import defaultdict
from datetime import date, timedelta

import pytest

from weatherloom.plans import report

STATIONS = [
    # ID, latitude, longitude, state, name, GSN, HCN/CRN
    ("NZ000093417", -40.9, 174.983, "", "PARAPARAUMU AWS", "", ""),
    ("NZM00093439", -41.333, 174.8, "", "WELLINGTON AERO AWS", "GSN", ""),
    ("NZM00093781", -43.489, 172.532, "", "CHRISTCHURCH", "", ""),
    ("USW00000001", 40.0, -100.0, "CO", "ONE", "GSN", "HCN"),
    ("GQW00000001", 13.48, 144.8, "GU", "GUAM WFO", "", "CRN"),
    ("MQW00000001", 28.2, -177.4, "", "MIDWAY", "", ""),
    ("BE000000001", 50.8, 4.36, "", "NEVER REPORTED", "", ""),
]
COUNTRIES = ["BE Belgium", "GQ Guam [United States]", "MQ Midway Islands [United States}", "NZ New Zealand", "US United States", "ZZ Nowhere"]
YEARS = (2022, 2023, 2025)


@pytest.fixture(scope="module")
def observed():
    draw = random.Random(3)
    rows = []
    for sid, *_ in STATIONS[:-1]:
        for year in YEARS:
            day = date(year, 1, 1)
            while day.year == year:
                stamp = f"{day:%Y%m%d}"
                if sid[:2] == "NZ" and date(2025, 5, 4) <= day <= date(2025, 5, 11):
                    pass  # nobody in the country reports
                elif draw.random() < 0.9:
                    rows.append((sid, stamp, "TMAX", draw.randint(50, 300)))
                    if draw.random() < 0.95:
                        rows.append((sid, stamp, "TMIN", draw.randint(-50, 50)))
                    if sid[:2] != "MQ":
                        rows.append((sid, stamp, "PRCP", draw.randint(0, 200)))
                day += timedelta(days=1)
    rows.append(("MQW00000001", "20250622", "PRCP", 4361))
    return rows


@pytest.fixture(scope="module")
def tables(spark, observed, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    (root / "daily").mkdir()
    per_year = defaultdict(list)
    for sid, stamp, element, value in observed:
        per_year[stamp[:4]].append(f"{sid},{stamp},{element},{value},,,S,0630")
    for year, lines in per_year.items():
        with gzip.open(root / "daily" / f"{year}.csv.gz", "wt") as out:
            out.write("\n".join(lines) + "\n")
    (root / "stations.txt").write_text(
        "".join(
            f"{sid:<11} {lat:8.4f} {lon:9.4f} {12.0:6.1f} {state:<2} {name:<30} {gsn:<3} {hcn:<3} {'':5}\n"
            for sid, lat, lon, state, name, gsn, hcn in STATIONS
        )
    )
    (root / "countries.txt").write_text("\n".join(COUNTRIES) + "\n")
    (root / "states.txt").write_text("CO COLORADO\nGU GUAM\n")
    (root / "inventory.txt").write_text(
        "".join(
            f"{sid:<11} {lat:8.4f} {lon:9.4f} {element} {2022} {last}\n"
            for sid, lat, lon, *_ in STATIONS[:-2]
            for element, last in (("PRCP", 2025), ("TMAX", 2024))
        )
    )
    paths = {name: str(root / f"{name}.txt") for name in ("stations", "countries", "states", "inventory")}
    return report.prepare(spark, daily=str(root / "daily"), out=str(root / "out"), active_year=2025, **paths)


def test_landed_tables_are_whole(tables, observed):
    assert tables.daily.count() == len(observed)
    assert tables.enriched.count() == len(STATIONS)


def test_station_answers(tables):
    answers = report.station_answers(tables, active_year=2025)
    assert answers["total_stations"].first()[0] == 7
    assert answers["network_counts"].first().asDict()["IN_MORE_THAN_ONE"] == 1
    assert answers["southern_count"].first()[0] == 3
    assert {r.COUNTRY_NAME: r.N_STATIONS for r in answers["territory_totals"].collect()} == {
        "Guam [United States]": 1, "Midway Islands [United States}": 1, None: 2,
    }
    assert {r.CODE: r.N_STATIONS for r in answers["stations_per_country"].collect()}["ZZ"] == 0
    assert tuple(answers["flag_counts"].first()) == (5, 0, 0)
    assert [r.COUNTRY_CODE for r in answers["state_countries"].collect()] == ["GQ", "US"]
    assert tuple(answers["inventory_integrity"].first()) == (2, 0)
    assert [r.ID for r in answers["missing_from_observations"].collect()] == ["BE000000001"]
    assert answers["unknown_in_observations"].collect() == []
    assert tuple(answers["activity_comparison"].first()) == (6, 5, 1, 1, 0)


def test_observation_answers(tables, observed):
    answers = report.observation_answers(tables)
    assert [r.YEAR for r in answers["missing_years"].collect()] == [2024]
    assert answers["year_coverage"].first().N_YEARS == 3
    assert sum(r.N_FILES for r in answers["sizes"].collect()) == 3
    expected = defaultdict(int)
    for row in observed:
        expected[row[2]] += 1
    assert {r.ELEMENT: r.N_OBSERVATIONS for r in answers["element_counts"].collect()} == expected
    assert answers["element_profile"].first().N_ROWS == len(observed)
    tmin = {(s, d) for s, d, e, _ in observed if e == "TMIN"}
    alone = [s for s, d, e, _ in observed if e == "TMAX" and (s, d) not in tmin]
    assert tuple(answers["unpaired_summary"].first()) == (len(alone), len(set(alone)))


def test_country_answers(tables, observed):
    answers = report.country_answers(tables)
    assert answers["stations"].count() == 3
    assert not [n for n, df in answers.items() if any("/out/observations/" in f for f in df.inputFiles())]
    pair = answers["closest_pair"].first()
    assert (pair.ID_A, pair.ID_B) == ("NZ000093417", "NZM00093439")
    assert pair.DISTANCE_KM == pytest.approx(50.53, abs=0.01)
    local = [r for r in observed if r[0][:2] == "NZ" and r[2] in ("TMIN", "TMAX")]
    days = sorted({date(int(d[:4]), int(d[4:6]), int(d[6:])) for _, d, _, _ in local})
    covered = answers["coverage"].first()
    assert (covered.N_OBSERVATIONS, covered.N_YEARS, covered.FIRST_DAY, covered.LAST_DAY) == (len(local), 3, days[0], days[-1])
    missing = {days[0] + timedelta(n) for n in range((days[-1] - days[0]).days)} - set(days)
    assert {r.DAY for r in answers["missing_days"].collect()} == missing
    assert covered.MISSING_DAYS == len(missing)
    runs = {r.GAP_START: r.N_DAYS for r in answers["gap_runs"].collect()}
    assert runs[date(2025, 5, 4)] == 8 and sum(runs.values()) == len(missing)
    assert [r.YEAR for r in answers["gap_years"].collect()] == [2024]

    sums = defaultdict(list)
    for sid, d, e, v in local:
        sums[sid, e, date(int(d[:4]), int(d[4:6]), 1)].append(v)
    monthly = {(r.ID, r.ELEMENT, r.YEAR_MONTH): r.TEMP_C for r in answers["monthly_means"].collect()}
    assert monthly == pytest.approx({k: sum(v) / len(v) / 10 for k, v in sums.items()})
    dense = answers["dense_months"].collect()
    assert len(dense) == 3 * 2 * 48
    rolled = [r for r in dense if r.ROLLING_C is not None]
    assert {(r.YEAR_MONTH.year, r.YEAR_MONTH.month) for r in rolled} == {(2022, 12), (2025, 12)} | {(2023, m) for m in range(1, 13)}
    assert answers["monthly_pivot"].count() == 3 * 36
    assert answers["country_rolling_mean"].where("ROLLING_C is not null").count() == 2 * 14


def observed_mapping(tables):
    return tables.daily.sparkSession.createDataFrame([("NZ", "NZL"), ("US", "USA")], "COUNTRY_CODE string, ISO3 string")


def test_rainfall_answers(tables, observed):
    mapping = observed_mapping(tables)
    answers = report.rainfall_answers(tables, year=2025, without_years=(2022,), mapping=mapping)
    groups = defaultdict(list)
    for sid, d, e, v in observed:
        if e == "PRCP" and d[:4] != "2022":
            groups[int(d[:4]), sid[:2]].append(v)
    got = {(r.YEAR, r.COUNTRY_CODE): (r.AVG_DAILY_PRCP_MM, r.N_OBSERVATIONS) for r in answers["country_year_means"].collect()}
    assert {k: n for k, (_, n) in got.items()} == {k: len(v) for k, v in groups.items()}
    assert {k: m for k, (m, _) in got.items()} == pytest.approx({k: sum(v) / len(v) / 10 for k, v in groups.items()})
    top = answers["highest"].first()
    assert (top.LABEL, top.AVG_DAILY_PRCP_MM, top.N_OBSERVATIONS) == ("Midway Islands [United States} (2025)", 436.1, 1)
    assert [(r.ID, r.VALUE) for r in answers["behind_the_highest"].collect()] == [("MQW00000001", 4361.0)]
    assert tuple(answers["sparse_counts"].first()) == (1, 1, 1)
    assert [r.COUNTRY_CODE for r in answers["sparse_rows"].collect()] == ["MQ"]
    assert answers["describe"].first().MAX == 436.1
    assert answers["describe_year"].first().N == answers["of_year"].count() == 4
    mapped = {r.COUNTRY_CODE: r for r in answers["map_table"].collect()}
    assert mapped["NZ"].ISO3 == "NZL" and mapped["MQ"].ISO3 is None
    assert mapped["MQ"].SHOWN < mapped["MQ"].AVG_DAILY_PRCP_MM
    assert answers["percentiles"].first().P95 == pytest.approx(mapped["MQ"].SHOWN)
    assert [r.NAME for r in answers["without_data"].collect()] == ["Belgium"]
