"""Reading the fixed-width station, country, state and inventory files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom import schema as S
from weatherloom.functions import columns as C


def parse_fixed_width(lines: DataFrame, fields: tuple[S.Field, ...]) -> DataFrame:
    """Cut a one-column text DataFrame (``value``) into typed columns in one projection."""
    return lines.select(
        *(C.fixed_width_field(F.col("value"), f.first, f.width, f.kind).alias(f.name) for f in fields)
    )


def read_fixed_width(spark: SparkSession, path: str, fields: tuple[S.Field, ...]) -> DataFrame:
    return parse_fixed_width(spark.read.text(path), fields)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return read_fixed_width(spark, path, S.STATIONS)


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    return read_fixed_width(spark, path, S.COUNTRIES)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return read_fixed_width(spark, path, S.STATES)


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return read_fixed_width(spark, path, S.INVENTORY)


def read_dimensions(
    spark: SparkSession, *, stations: str, countries: str, states: str, inventory: str
) -> dict[str, DataFrame]:
    """The four dimension tables by name, each lazy."""
    return {
        "stations": read_stations(spark, stations),
        "countries": read_countries(spark, countries),
        "states": read_states(spark, states),
        "inventory": read_inventory(spark, inventory),
    }


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table, as one small DataFrame."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("N_ROWS")).select(F.lit(name).alias("DATASET"), "N_ROWS")
        for name, df in tables.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result
