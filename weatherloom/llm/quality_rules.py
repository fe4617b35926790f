"""Quality rules: counts of each text, and a calibrated logistic regression over hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm import ngrams
from weatherloom.llm.common import text_hash
from weatherloom.llm.linear import fit_logistic, fit_platt, sigmoid

BUCKETS = 1 << 16
#: About so many labelled rows of each class are drawn, by hash of doc_id.
ROWS_PER_CLASS = 1000
#: Texts with a lower probability of quality 1 are not kept.
MIN_PROBABILITY = 0.5
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8
#: Frequencies are given to the regression in percent.
_PERCENT = 100.0
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_WORDS_AT_ONCE = 1 << 18
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # family x bucket
    bias: float
    slope: float
    shift: float


def _repeat_words(hashes: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    """Adds to ``out`` the words of each row that lie in a window found twice or more in the row."""
    total = len(hashes) - WINDOW_WORDS + 1
    if total < 2:
        return
    window = np.zeros(total, np.uint64)
    for j in range(WINDOW_WORDS):
        window = ngrams.mix(window + hashes[j : j + total])
    window = ngrams.mix(window + rows[:total].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(rows[:total] == rows[WINDOW_WORDS - 1 :])
    order = at[np.argsort(window[at], kind="stable")]
    if len(order) < 2:
        return
    same = window[order[1:]] == window[order[:-1]]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    begin = order[twice]
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + WINDOW_WORDS, -1)
    out += np.bincount(rows[np.cumsum(change[:-1]) > 0], minlength=len(out))


def _dup_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    count = 0
    for line in text.split(b"\n"):
        if line.strip():
            if line in seen:
                count += 1
            else:
                seen.add(line)
    return count


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of every row. Words are compared by 64-bit hash, lines byte by byte."""
    rows = len(offsets) - 1
    out = {name: np.zeros(rows, np.int64) for name in COUNTS}
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> None:
        if held:
            _repeat_words(np.concatenate([h for h, _ in held]), np.concatenate([r for _, r in held]), out["n_repeat_words"])
            held.clear()

    last = -1
    for chunk, starts, own in ngrams.pieces(data, offsets):
        if size > _WORDS_AT_ONCE and own[0] != last:  # a row is never divided
            flush()
            size = 0
        last = own[-1]
        hashes, first, _ = ngrams.words(chunk, starts)
        n = ngrams.word_counts(first, starts, len(chunk))
        held.append((hashes, np.repeat(own, n)))
        size += len(hashes)
        out["n_words"][own] += n
        seen = ~ngrams.WHITE[chunk] & ((chunk & 0xC0) != 0x80)
        out["word_chars"][own] += np.add.reduceat(seen, starts, dtype=np.int64)
        out["n_symbols"][own] += np.add.reduceat(_SYMBOL[chunk], starts, dtype=np.int64)
    flush()
    for row in range(rows):
        out["n_dup_lines"][row] = _dup_lines(data[offsets[row] : offsets[row + 1]].tobytes())
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Learns from about ``rows_per_class`` labelled whole texts of each class, drawn by hash of doc_id.

    Their sparse n-gram frequencies are made in the tasks. A quarter of the rows calibrates the
    probabilities and is not learned from. Without rows of both classes every text gets
    probability one half or the share of the class there is. Rows equal in id and text count once.
    Where ids repeat with many texts, the texts are drawn by hash as well, about twice
    ``rows_per_class`` in all: no more come to the driver, however many rows a labelled id has.
    """
    known = labels.select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) > 0).cast("int").alias("label")).dropna().groupBy("id").agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    share = F.when(F.col("label") == 1, F.lit(min(1.0, rows_per_class / max(sizes.get(1, 0), 1)))).otherwise(F.lit(min(1.0, rows_per_class / max(sizes.get(0, 0), 1))))
    drawn = known.filter(part < share * (1 << 30)).withColumn("held", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(4)) == 0)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(drawn), "id")
    rows = rows.withColumn("text_hash", text_hash(F.col("text")))
    found = rows.select("id", "text_hash").distinct().count()
    place = F.pmod(F.xxhash64(F.lit(2), "id", "text_hash"), F.lit(1 << 30))
    rows = rows.filter(place < F.lit(min(1.0, 2 * rows_per_class / max(found, 1)) * (1 << 30))).dropDuplicates(["id", "text_hash"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ngrams.text_bytes(batch.column(2))
            n = len(batch)
            totals, keys = np.zeros((len(ngrams.FAMILIES), n)), []
            for own, found in ngrams.counted(data, offsets, BUCKETS):
                for f, (index, each) in enumerate(found):
                    keys.append((np.repeat(own, each) * len(ngrams.FAMILIES) + f) * BUCKETS + index)
                    totals[f, own] += each
            key, times = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_counts=True)
            row, rest = np.divmod(key, len(ngrams.FAMILIES) * BUCKETS)
            value = _PERCENT * times / totals[rest // BUCKETS, row]
            edges = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x)) for x in (rest.astype(np.int32), value.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), batch.column(1), batch.column(3), *lists], ["id", "text_hash", "label", "held", "at", "value"])

    schema = "id long, text_hash long, label int, held boolean, at array<int>, value array<float>"
    table = rows.select("id", "label", "text", "held", "text_hash").mapInArrow(features, schema).toArrow()
    table = table.sort_by([("id", "ascending"), ("text_hash", "ascending")])
    label = table["label"].to_numpy().astype(int) if len(table) else np.zeros(0, int)
    held = table["held"].to_numpy(zero_copy_only=False).astype(bool) if len(table) else np.zeros(0, bool)
    size = len(ngrams.FAMILIES) * BUCKETS
    if len(set(label[~held])) < 2:
        share = (label.sum() + 1) / (len(label) + 2) if len(label) else 0.5
        return Model(np.zeros((len(ngrams.FAMILIES), BUCKETS)), 0.0, 1.0, float(np.log(share / (1 - share))))
    lists = table["at"].combine_chunks()
    row = np.repeat(np.arange(len(label)), np.diff(lists.offsets.to_numpy()))
    index = lists.flatten().to_numpy()
    value = table["value"].combine_chunks().flatten().to_numpy().astype(float)
    learn = ~held[row]
    own = np.cumsum(~held) - 1
    weights, bias = fit_logistic(index[learn], value[learn], own[row[learn]], label[~held], size)
    score = bias + np.bincount(row, value * weights[index], len(label))
    check = held if len(set(label[held])) == 2 else np.ones(len(label), bool)
    slope, shift = fit_platt(score[check], label[check])
    return Model(weights.reshape(len(ngrams.FAMILIES), BUCKETS), bias, slope, shift)


def judged(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """doc_id, COUNTS, base_failed, p_quality and kept of every row.

    Words are `[^\\x20\\x09-\\x0D]+`; a null text has none. base_failed: fewer than 20 words, or more
    than 30 of 100 words in repeated windows. kept: not base_failed and a probability of at least
    ``min_probability``. Rows repeat as in the input, null ids stay null, extra columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = sent.value
            data, offsets = ngrams.text_bytes(batch.column(1))
            base = counts(data, offsets)
            failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])
            raw = m.bias + _PERCENT * ngrams.mean_weights(data, offsets, m.weights)[0].sum(axis=0)
            p = sigmoid(m.slope * raw + m.shift)
            arrays = [batch.column(0), *(pa.array(base[c]) for c in COUNTS), pa.array(failed), pa.array(p), pa.array(~failed & (p >= min_probability))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *COUNTS, "base_failed", "p_quality", "kept"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, p_quality double, kept boolean"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
