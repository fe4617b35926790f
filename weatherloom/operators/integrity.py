"""Do stations, inventory and observations agree? Checked both ways.

The observations are projected to ID first. Distinct IDs combine on the map side, so a
station holding a third of all rows costs one row per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.operators.sizing import BROADCAST_LIMIT, broadcast_if_small


def distinct_ids(df: DataFrame, id_col: str = "ID") -> DataFrame:
    return df.select(id_col).distinct()


def known_ids(
    daily: DataFrame, stations: DataFrame, *, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Distinct observed IDs that belong to a station.

    With a broadcast station list the optimizer moves the semi join below the
    distinct, so rows are dropped while the observations stream past.
    """
    listed = broadcast_if_small(stations.select("ID"), broadcast_limit)
    return distinct_ids(daily).join(listed, "ID", "left_semi")


def missing_from_observations(stations: DataFrame, daily: DataFrame) -> DataFrame:
    """IDs of stations that never occur in the observations."""
    return distinct_ids(stations).join(distinct_ids(daily), "ID", "left_anti")


def unknown_in_observations(
    daily: DataFrame, stations: DataFrame, *, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Observed IDs that no station has."""
    listed = broadcast_if_small(stations.select("ID"), broadcast_limit)
    return distinct_ids(daily).join(listed, "ID", "left_anti")


def observations_of(
    daily: DataFrame, stations: DataFrame, *, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Observations of the listed stations only; no column is added."""
    listed = broadcast_if_small(stations.select("ID"), broadcast_limit)
    return daily.join(listed, "ID", "left_semi")


def with_station_columns(
    daily: DataFrame, stations: DataFrame, *, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Left join of an observation subset to the station columns."""
    return daily.join(broadcast_if_small(stations, broadcast_limit), "ID", "left")


def without_inventory(stations: DataFrame, inventory: DataFrame) -> DataFrame:
    """IDs of stations the inventory does not mention."""
    return distinct_ids(stations).join(distinct_ids(inventory), "ID", "left_anti")


def orphan_inventory(stations: DataFrame, inventory: DataFrame) -> DataFrame:
    """Inventory IDs that no station has."""
    return distinct_ids(inventory).join(distinct_ids(stations), "ID", "left_anti")


def inventory_integrity(stations: DataFrame, inventory: DataFrame) -> DataFrame:
    """Both anti joins as one row of counts, from a single shuffle on ID."""
    tagged = stations.select("ID", F.lit(True).alias("is_station")).unionByName(
        inventory.select("ID", F.lit(False).alias("is_station"))
    )
    sides = tagged.groupBy("ID").agg(
        F.bool_or("is_station").alias("in_stations"), F.bool_and("is_station").alias("stations_only")
    )
    return sides.agg(
        F.count_if("stations_only").alias("N_WITHOUT_INVENTORY"),
        F.count_if(~F.col("in_stations")).alias("N_ORPHAN_INVENTORY"),
    )
