"""Near station pairs and the closest pair, without comparing all stations.

Stations at the same position are folded into one site first. Positions become points
in space (chord length never exceeds arc length, and poles and the 180th meridian need
no special case), points become cubic cells, and only neighbouring cells are compared.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.functions.geo import haversine_km, on_sphere
from weatherloom.schema import EARTH_RADIUS_KM

_CELL = ["cx", "cy", "cz"]

# Half of the 26 neighbours and the cell itself: each pair of cells meets once.
_OFFSETS = [o for o in product((-1, 0, 1), repeat=3) if o >= (0, 0, 0)]

# Cells are halved from the whole sphere (level 0) down to about 6 micrometres.
_STRIDE = 7
_LEVELS = 42

# A crowded cell is divided into parts of about so many sites; a task meets one part with another.
_ROWS_PER_TASK = 1000

# Cells are no smaller than this, whatever the radius.
_LEAST_EDGE_KM = 1e-9


def _stations(stations: DataFrame) -> DataFrame:
    name = F.col("NAME") if "NAME" in stations.columns else F.lit(None).cast("string")
    located = F.col("LATITUDE").isNotNull() & F.col("LONGITUDE").isNotNull()
    pole = F.abs("LATITUDE") == 90
    return stations.where(located).select(
        "ID",
        F.col("LATITUDE").alias("LAT"),
        F.col("LONGITUDE").alias("LON"),
        name.alias("NAME"),
        F.col("LATITUDE").alias("site_lat"),
        F.when(pole, 0.0).otherwise(F.pmod("LONGITUDE", F.lit(360.0))).alias("site_lon"),
    )


def fold_sites(stations: DataFrame) -> DataFrame:
    """One row per position, named by its smallest ID; combines on the map side.

    The functions below take it as ``sites``: they use it several times, so a caller with
    many stations lands it first.
    """
    placed = _stations(stations)
    sites = placed.groupBy("site_lat", "site_lon").agg(
        F.min(F.struct("ID", "LAT", "LON", "NAME")).alias("site"),
        F.count(F.lit(1)).alias("N"),
    )
    return sites.withColumns(on_sphere(F.col("site_lat"), F.col("site_lon")))


def site_members(stations: DataFrame, *, sites: DataFrame | None = None) -> DataFrame:
    """``SITE_ID, ID``: which stations share a position; joins site pairs back to stations."""
    folded = fold_sites(stations) if sites is None else sites
    sites = folded.select("site_lat", "site_lon", F.col("site.ID").alias("SITE_ID"))
    return _stations(stations).join(sites, ["site_lat", "site_lon"]).select("SITE_ID", "ID").distinct()


def _same_position(stations: DataFrame, sites: DataFrame) -> DataFrame:
    """Each station sharing a position, paired with the smallest ID there."""
    shared = sites.where(F.col("N") > 1).select("site_lat", "site_lon", "site")
    return (
        _stations(stations)
        .join(shared, ["site_lat", "site_lon"])
        .where(F.col("ID") > F.col("site.ID"))
        .select(
            *_ends(F.col("site"), F.struct("ID", "LAT", "LON", "NAME")),
            F.lit(1).cast("bigint").alias("N_A"),
            F.lit(1).cast("bigint").alias("N_B"),
        )
        .withColumn("DISTANCE_KM", _distance())
    )


def _ends(a: Column, b: Column) -> list[Column]:
    return [
        end[field].alias(f"{field}_{side}")
        for side, end in (("A", a), ("B", b))
        for field in ("ID", "LAT", "LON", "NAME")
    ]


def _distance() -> Column:
    return haversine_km(F.col("LAT_A"), F.col("LON_A"), F.col("LAT_B"), F.col("LON_B"))


def _cells(edge_km: Column) -> dict[str, Column]:
    return {
        cell: F.floor((F.col(axis) + EARTH_RADIUS_KM) / edge_km)
        for cell, axis in zip(_CELL, "xyz")
    }


def _part_of(parts: str) -> Column:
    return F.pmod(F.xxhash64("site.ID"), F.col(parts))


def _every_part(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(parts) - 1))


def _met(sites: DataFrame, reach_km: Column, *, spread: bool) -> DataFrame:
    """Sites beside those of the same or a touching cell, cells as wide as the reach.

    The reach may be a scalar subquery; as a column of its own it is evaluated once.
    With ``spread`` a crowded cell is divided into parts on both sides: each part at home
    meets each visiting part of a neighbour on its own, so no task compares more than two
    parts. Sites are repeated only for cells that exist.
    """
    edge = F.greatest(F.col("reach_km"), F.lit(_LEAST_EDGE_KM)) * (1 + 1e-9)
    home = sites.withColumn("reach_km", reach_km).select(
        "site", "N", "reach_km", *(c.alias(n) for n, c in _cells(edge).items())
    )
    offsets = F.array(
        *(
            F.struct(*(F.lit(d).alias(n) for d, n in zip(o, _CELL)), F.lit(not any(o)).alias("inside"))
            for o in _OFFSETS
        )
    )
    shifted = [(F.col(c) + F.col("offset")[c]).alias(c) for c in _CELL]
    visitor = [F.col("site").alias("other"), F.col("N").alias("n_other")]
    keys = list(_CELL)
    if spread:
        parts = home.groupBy(*_CELL).agg(F.ceil(F.count(F.lit(1)) / _ROWS_PER_TASK).alias("parts"))
        calls = parts.select(F.col("parts").alias("parts_other"), *_CELL, F.explode(offsets).alias("offset"))
        blocks = parts.join(calls.select("parts_other", "offset", *shifted), _CELL)
        from_cells = blocks.select(
            "parts", "parts_other", "offset", *((F.col(c) - F.col("offset")[c]).alias(c) for c in _CELL)
        )
        visiting = home.join(from_cells, _CELL).select(
            *visitor, "offset", *shifted, _every_part("parts").alias("part"), _part_of("parts_other").alias("part_other")
        )
        home = home.join(blocks, _CELL).select(
            "site", "N", "reach_km", "offset", *_CELL,
            _part_of("parts").alias("part"), _every_part("parts_other").alias("part_other"),
        )
        keys += ["offset", "part", "part_other"]
    else:
        visiting = home.select("site", "N", *_CELL, F.explode(offsets).alias("offset")).select(
            *visitor, "offset", *shifted
        )
    return home.join(visiting, keys)


def _neighbours(sites: DataFrame, reach_km: Column, *, spread: bool) -> DataFrame:
    """Pairs of distinct sites in the same or in touching cells, with their distance."""
    # Inside a cell every pair meets in both orders, across cells only in one.
    met = _met(sites, reach_km, spread=spread).where(
        F.when(F.col("offset.inside"), F.col("site.ID") < F.col("other.ID")).otherwise(
            F.col("site.ID") != F.col("other.ID")
        )
    )
    swap = F.col("site.ID") > F.col("other.ID")
    a = F.when(swap, F.col("other")).otherwise(F.col("site"))
    b = F.when(swap, F.col("site")).otherwise(F.col("other"))
    return met.select(
        *_ends(a, b),
        F.when(swap, F.col("n_other")).otherwise(F.col("N")).alias("N_A"),
        F.when(swap, F.col("N")).otherwise(F.col("n_other")).alias("N_B"),
        "reach_km",
    ).withColumn("DISTANCE_KM", _distance())


def pairs_within(
    stations: DataFrame, max_km: float | Column, *, sites: DataFrame | None = None
) -> DataFrame:
    """Pairs of sites at most ``max_km`` apart, each once with ``ID_A < ID_B``, and their distance.

    A site is a position, under the smallest ID there; N_A and N_B tell how many stations
    stand at either. Stations at the very same position appear as one row each, paired with
    the smallest ID there. Joined with ``site_members`` on both sides this gives every pair
    of stations, without writing out the square of a crowded position. The number of pairs compared is within a constant factor of the
    number of pairs found, because a cell is only as wide as the radius.
    """
    if not isinstance(max_km, Column) and max_km < 0:
        raise ValueError("max_km must not be negative")
    reach = max_km if isinstance(max_km, Column) else F.lit(float(max_km))
    sites = fold_sites(stations) if sites is None else sites
    near = _neighbours(sites, reach, spread=True)
    near = near.where(F.col("DISTANCE_KM") <= F.col("reach_km")).drop("reach_km")
    return near.unionByName(_same_position(stations, sites))


def mean_spacing_km(stations: DataFrame, *, sites: DataFrame | None = None) -> DataFrame:
    """Edge of the square each position would have if all were spread evenly; one row.

    As a radius it keeps the number of near pairs proportional to the number of stations.
    """
    area = 4 * 3.141592653589793 * EARTH_RADIUS_KM**2
    sites = fold_sites(stations) if sites is None else sites
    return sites.agg(F.sqrt(F.lit(area) / F.count(F.lit(1))).alias("SPACING_KM"))


def _finest_shared_level(sites: DataFrame, steps: range, base: Column) -> Column:
    """The highest of the levels ``base + step`` at which some cell holds two sites."""
    scale = F.pow(F.lit(2.0), F.col("level")) / (2 * EARTH_RADIUS_KM)
    offsets = F.explode(F.array(*map(F.lit, steps)))
    cells = sites.select("x", "y", "z", offsets.alias("step")).select(
        "x", "y", "z", (base + F.col("step")).alias("level")
    ).select(
        "level",
        *(F.floor((F.col(axis) + EARTH_RADIUS_KM) * scale).alias(c) for c, axis in zip(_CELL, "xyz")),
    )
    shared = cells.groupBy("level", *_CELL).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return shared.agg(F.max("level")).scalar()


def closest_pair(stations: DataFrame, *, sites: DataFrame | None = None) -> DataFrame:
    """The closest pair as one row; empty when there are fewer than two located stations.

    Two sites sharing a cell of some size are at most its diagonal apart. The finest
    halving at which any two share a cell therefore bounds the least distance, while
    at the next halving every site is alone, so a cell as wide as that bound holds only
    a fixed number of sites. Comparing neighbouring cells is then exact and linear.
    Of equally close pairs the one with the smallest IDs is returned.
    """
    sites = fold_sites(stations) if sites is None else sites
    coarse = _finest_shared_level(sites, range(0, _LEVELS, _STRIDE), F.lit(0))
    level = _finest_shared_level(sites, range(_STRIDE), coarse)
    bound = F.sqrt(F.lit(3.0)) * (2 * EARTH_RADIUS_KM) / F.pow(F.lit(2.0), level)
    return (
        _neighbours(sites, bound, spread=False)
        .drop("reach_km")
        .unionByName(_same_position(stations, sites))
        .drop("N_A", "N_B")
        .orderBy(F.asc_nulls_last("DISTANCE_KM"), "ID_A", "ID_B")
        .limit(1)
    )
