"""Exact percentiles of raw observations, found by counting: no task ever holds or sorts a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.operators.sizing import broadcast_if_small
from weatherloom.sources import sinks

BINS = 1024


def percentiles(df: DataFrame, value: str, shares: Sequence[float], *, by: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """One row per group and share: the columns ``by``, SHARE, N_VALUES and PERCENTILE, exactly.

    The percentile is the smallest value that at least SHARE of the values do not exceed (SQL's
    ``percentile_disc``). Each round divides the range in which a wanted rank lies into bins, counts them with
    map-side sums, and goes on with the one bin that holds the rank, so a round shuffles ``bins`` rows per
    group, rank and task at most, however many rows the group has; ranks in one range share its counts. The
    ends of a bin are the least and greatest values in it, so a round always divides, and whole
    numbers in a range of ``bins`` steps need one. Null and NaN values do not count; a group
    without values has no rows; null groups are a group. Infinite values have their places at the ends.
    """
    if not shares or not all(0 <= s <= 1 for s in shares):
        raise ValueError("shares are numbers from 0 to 1")
    spark = df.sparkSession
    keys = list(by)
    rows = df.select(*keys, F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    # -0.0 and 0.0 are one value
    rows = rows.withColumn("v", F.col("v") + F.lit(0.0))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    sizes = sizes.where("n > 0")
    share = F.explode(F.array(*(F.lit(float(s)) for s in dict.fromkeys(shares)))).alias("share")
    state = sizes.select(*keys, "n", "low", "high", share)
    rank = F.greatest(F.col("n") - F.floor(F.col("n") - F.col("n") * F.col("share")), F.lit(1).cast("bigint"))
    state = _landed(state.withColumn("rank", rank))
    while not state.where("low < high").isEmpty():
        state = _landed(_narrowed(rows, state, keys, bins))
    return state.select(*keys, F.col("share").alias("SHARE"), F.col("n").alias("N_VALUES"), F.col("low").alias("PERCENTILE"))


def _landed(state: DataFrame) -> DataFrame:
    """One row per group and share, written so that a round is not computed again by the next."""
    path = sinks.shared_path(state.sparkSession, "ranks")
    state.write.parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def _bin(bins: int) -> Column:
    """Number of the bin of v between low and high; halved, as the range of two doubles may be no double."""
    finite = F.when(F.col("v") == F.col("low"), 0).when(F.col("v") == F.col("high"), bins - 1)
    low, high = (F.greatest(F.least(F.col(c), F.lit(1.7e308)), F.lit(-1.7e308)) / 2 for c in ("low", "high"))
    inner = F.floor((F.col("v") / 2 - low) / (high - low) * bins)
    return finite.otherwise(F.least(F.greatest(inner, F.lit(0)), F.lit(bins - 1))).cast("int")


def _narrowed(rows: DataFrame, state: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """``state`` with each open range replaced by the bin that holds its rank, and the rank counted from there."""
    opened = state.where("low < high")
    ranges = broadcast_if_small(opened.select(*keys, "low", "high").distinct().withColumnsRenamed({k: f"range_{k}" for k in keys}))
    same = F.col("v").between(F.col("low"), F.col("high"))
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"range_{key}"))
    names = [f"range_{k}" for k in keys]
    counted = (
        (rows.join(ranges, same) if keys else rows.join(ranges, same, "inner"))
        .withColumn("bin", _bin(bins))
        .groupBy(*names, "low", "high", "bin")
        .agg(F.count(F.lit(1)).alias("count"), F.min("v").alias("bin_low"), F.max("v").alias("bin_high"))
    )
    # at most ``bins`` rows in each of these windows
    below = Window.partitionBy(*names, "low", "high").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("below", F.coalesce(F.sum("count").over(below), F.lit(0))).withColumnsRenamed({"low": "l", "high": "h"})
    holds = (F.col("low") == F.col("l")) & (F.col("high") == F.col("h")) & (F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("below") + F.col("count"))
    for key in keys:
        holds = holds & F.col(key).eqNullSafe(F.col(f"range_{key}"))
    narrower = opened.join(counted, holds).select(
        *keys, "n", F.col("bin_low").alias("low"), F.col("bin_high").alias("high"), "share", (F.col("rank") - F.col("below")).alias("rank")
    )
    return state.where("low >= high").union(narrower)
