"""Bounds: what may be broadcast and what may be collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherloom.sources import sinks

BROADCAST_LIMIT = 64 * 1024 * 1024
COLLECT_LIMIT = 5_000_000

_ROW_OVERHEAD = 32


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint ``df`` for broadcast only after measuring it.

    Statistics of text files and of join results say little about the true size, so
    one aggregate over the projected columns measures it (one row comes back). Above
    the limit ``df`` is returned as it is: Spark then plans a shuffle join, whose hot
    keys adaptive execution splits.
    """
    measured = df.agg(F.sum(row_bytes(df))).first()[0] or 0
    return F.broadcast(df) if measured <= limit_bytes else df


def row_bytes(df: DataFrame) -> Column:
    """About the bytes that a row takes in memory."""
    return reduce(Column.__add__, map(_width, df.schema.fields), F.lit(_ROW_OVERHEAD)).cast("bigint")


def landed_and_measured(df: DataFrame, name: str, *, limit_bytes: int = BROADCAST_LIMIT) -> tuple[DataFrame, dict[str, int]]:
    """(``df`` as a table in the shared folder, hinted for broadcast if it is small; its N_ROWS and N_BYTES).

    Rows and bytes are observed while the table is written, so neither a second scan nor a job of its own measures
    them. For tables that are landed anyway because several questions share them.
    """
    seen = Observation(name)
    counted = df.observe(seen, F.count(F.lit(1)).alias("N_ROWS"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("N_BYTES"))
    path = sinks.save(counted, sinks.shared_path(df.sparkSession, name))
    landed = df.sparkSession.read.schema(df.schema).parquet(path)
    facts = dict(seen.get)
    return (F.broadcast(landed) if facts["N_BYTES"] <= limit_bytes else landed), facts


def _width(field: T.StructField) -> Column:
    """Bytes of one field of a row, generously."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(column.cast("string")), F.lit(0)) * 8 + 64
    return F.lit(16)


def bounded_collect(df: DataFrame, limit: int = COLLECT_LIMIT, label: str = "result") -> list[Row]:
    """Collect, or fail as soon as there is one row more than allowed."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise RuntimeError(
            f"Refusing to collect {label!r}: more than {limit:,} rows. Aggregate or filter it first."
        )
    return rows
