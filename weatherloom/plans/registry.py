"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows can be checked."""

    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: comparable(run(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Types on which two engines agree: doubles to six places, wide integers, joined arrays."""

    def form(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return df.select(*(form(field) for field in df.schema.fields))
