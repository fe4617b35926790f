"""Quality classifier: importance resampling towards labelled good text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm import ngrams
from weatherloom.llm.common import text_hash, tidy_map, without_rows, written

BUCKETS = 1 << 14
#: About so many rows labelled good are drawn as the target, by hash of doc_id.
TARGET_ROWS = 20_000
#: The n-grams of a text are not independent: whatever its length, it weighs as so many that are, with its mean log ratio.
EFFECTIVE_NGRAMS = 64.0
#: Rows whose log weight is lower do not count towards the size of the sample.
MIN_LOG_WEIGHT = -8.0
_SMOOTH = 1.0
_SEED = 20
_BINS = 4096


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", target_rows: int = TARGET_ROWS) -> np.ndarray:
    """Log ratios of two generative models, family x bucket: target (label 1) against raw (all rows).

    The raw model counts every n-gram of every row. The target is a sample of about ``target_rows``
    labelled rows. Counting is done in the tasks; families x buckets counts come to the driver.
    """
    good = labels.filter(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("id")).dropna().distinct()
    rate = min(1.0, target_rows / max(good.count(), 1))
    target = good.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(rate * (1 << 30))).withColumn("target", F.lit(True))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(target), "id", "left")
    size = len(ngrams.FAMILIES) * BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, wanted = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            data, offsets = ngrams.text_bytes(batch.column(0))
            chosen = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False)
            for own, found in ngrams.counted(data, offsets, BUCKETS):
                for f, (index, n) in enumerate(found):
                    part = slice(f * BUCKETS, (f + 1) * BUCKETS)
                    raw[part] += np.bincount(index, minlength=BUCKETS)
                    if chosen[own].any():
                        wanted[part] += np.bincount(index[np.repeat(chosen[own], n)], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(wanted[seen])], ["at", "raw", "target"])

    sums = rows.select("text", "target").mapInArrow(count, "at long, raw long, target long").groupBy("at").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    both = np.full((2, size), _SMOOTH)
    both[0, sums["at"].to_numpy(np.int64)] += sums["raw"].to_numpy(float)
    both[1, sums["at"].to_numpy(np.int64)] += sums["target"].to_numpy(float)
    models = np.log(both.reshape(2, len(ngrams.FAMILIES), BUCKETS))
    models -= np.log(both.reshape(2, len(ngrams.FAMILIES), BUCKETS).sum(axis=2))[:, :, None]
    return models[1] - models[0]


def weights(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = _SEED, effective_ngrams: float = EFFECTIVE_NGRAMS) -> DataFrame:
    """(doc_id, text_hash, log_ratio, log_weight, draw) of every row; ratios is broadcast, its size is fixed.

    log_ratio is that of the two generative models: the sum over all n-grams of the text, as the mean
    over the families. Rows are drawn by the tempered log_weight: the mean log ratio of an n-gram
    times ``effective_ngrams``, by one rule for every length. A null text or one without words
    is no text: its ratio is 0 and its weight minus a million. ``draw`` adds Gumbel noise that is a hash
    of seed and row, so a repeated row has the same draw and a lost task repeats it.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ngrams.text_bytes(batch.column(2))
            mean, n = ngrams.mean_weights(data, offsets, sent.value)
            ratio = (mean * n).sum(axis=0) / len(ngrams.FAMILIES)
            weight = mean.sum(axis=0) / len(ngrams.FAMILIES) * effective_ngrams
            spoken = n[0] > 0
            arrays = [batch.column(0), batch.column(1), pa.array(np.where(spoken, ratio, 0.0)), pa.array(np.where(spoken, weight, -1e6))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_hash", "log_ratio", "log_weight"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_hash"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return tidy_map(rows, run, "doc_id long, text_hash long, log_ratio double, log_weight double").withColumn("draw", F.col("log_weight") - F.log(-F.log(u)))


def kth_largest(table: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column: counts by bin, bin by bin; only _BINS counts come to the driver at a time."""
    rows = table.select(F.col(column).alias("v"))
    while True:
        low, high = rows.agg(F.min("v"), F.max("v")).first()
        if low is None:
            return float("inf")
        if low == high:
            return low
        place = F.least(F.floor((F.col("v") - low) / (high - low) * _BINS), F.lit(_BINS - 1)).cast("int")
        binned = rows.withColumn("bin", place)
        for bin_, n in binned.groupBy("bin").count().orderBy(F.desc("bin")).collect():
            if k <= n:
                break
            k -= n
        rows = binned.filter(F.col("bin") == bin_).select("v")


def resampled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int | None = None) -> DataFrame:
    """doc_id, text_hash, log_ratio, log_weight, draw and kept of every row: a sample of ``k`` rows without replacement.

    Rows are drawn in proportion to their importance by the Gumbel top-k trick. ``k`` is by default the
    number of rows with a log_weight of at least MIN_LOG_WEIGHT.
    Rows that tie with the k-th draw are all kept, so repeated rows stay together. Without labels
    the models differ by smoothing only. Null ids keep their rows; extra columns are ignored.
    """
    table = written(weights(docs, fit(docs, labels, id_col, text_col), id_col, text_col), "weights")
    if k is None:
        k = table.filter(F.col("log_weight") >= MIN_LOG_WEIGHT).count()
    least = kth_largest(table, "draw", k) if k > 0 else float("inf")
    return table.withColumn("kept", F.col("draw") >= F.lit(least))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Rows with a null, empty or blank text go. Rows repeated with id and text stay or go together, null ids
    count as equal. No rows give no rows. Extra columns stay as they are.
    """
    gone = written(resampled(docs, labels).filter("not kept").select("doc_id", "text_hash").distinct(), "rejected")
    return without_rows(docs, gone)
