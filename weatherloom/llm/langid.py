"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom.llm import ngrams
from weatherloom.llm.common import written

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: About so many training rows are drawn per language, by hash.
ROWS_PER_LANGUAGE = 4000
#: So many languages are learned and scored at a time; no result depends on it.
LANGUAGES_AT_ONCE = 128
_SMOOTH = 0.5
#: Lower case for the code points below 65536 whose lower case is one code point.
_LOWER = np.array([ord(low) if len(low := chr(i).lower()) == 1 else i for i in range(1 << 16)], np.uint32)


def _buckets(data: np.ndarray, offsets: np.ndarray, limit: int = ngrams.PIECE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, buckets, n-grams of each row): every n-gram of every whole text once, those that span a cut between pieces last."""

    def of(order: int, chunk: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points, at = ngrams.code_points(chunk, starts)
        points = np.where(points < len(_LOWER), _LOWER[np.minimum(points, len(_LOWER) - 1)], points)
        return ngrams.grams(points, at, order, BUCKETS)

    for chunk, starts, own in ngrams.pieces(data, offsets, limit):
        for order in ORDERS:
            yield own, *of(order, chunk, starts)
    for row, before, after in ngrams.crossings(data, offsets, limit):
        for order in ORDERS:
            around = ngrams.crossing_grams(before, after, order)
            if len(around):
                yield np.array([row]), *of(order, around, np.zeros(1, np.int64))


@dataclass(frozen=True)
class Model:
    """Training rows (text, lang) and the rows of each language; the matrix is made block by block."""

    drawn: DataFrame
    sizes: DataFrame
    n_langs: int
    n_rows: int
    rows_per_language: int
    langs_at_once: int

    def blocks(self) -> Iterator[tuple[list[str], np.ndarray]]:
        """(languages, log probabilities: bucket x language, the last row the priors), languages in order, some at a time."""
        last = None
        while True:
            left = self.sizes if last is None else self.sizes.filter(F.col("lang") > last)
            block = left.orderBy("lang").limit(self.langs_at_once).collect()
            if not block:
                return
            langs = [r["lang"] for r in block]
            yield langs, np.vstack([_matrix(self, block), np.log([r["n"] / self.n_rows for r in block])])
            last = langs[-1]


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE, langs_at_once: int = LANGUAGES_AT_ONCE) -> Model:
    """What is learned from ``rows``, any number of languages.

    Rows without text or language teach nothing. About ``rows_per_language`` rows of each language
    are drawn by hash of the text, whole texts; their n-grams are counted in the tasks, so that
    only buckets x ``langs_at_once`` counts come to the driver at a time. The priors are from all rows.
    """
    known = rows.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = written(known.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    langs, total = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return Model(known, sizes, langs, total, rows_per_language, langs_at_once)


def _matrix(model: Model, block: list) -> np.ndarray:
    """Log probabilities, bucket x language, of some languages."""
    langs = [r["lang"] for r in block]
    share = F.create_map(*(x for r in block for x in (F.lit(r["lang"]), F.lit(min(1.0, model.rows_per_language / r["n"])))))
    drawn = model.drawn.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = {lang: i for i, lang in enumerate(langs)}
        total = np.zeros(len(langs) * BUCKETS, np.int64)
        for batch in batches:
            data, offsets = ngrams.text_bytes(batch.column(0))
            own = np.array([code[x] for x in batch.column(1).to_pylist()], np.int64)
            for at, index, n in _buckets(data, offsets):
                total += np.bincount(np.repeat(own[at], n) * BUCKETS + index, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen // BUCKETS), pa.array(seen % BUCKETS), pa.array(total[seen])], ["lang", "bucket", "n"])

    counts = drawn.mapInArrow(count, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    matrix = np.full((BUCKETS, len(langs)), _SMOOTH)
    matrix[counts["bucket"].to_numpy(), counts["lang"].to_numpy()] += counts["n"].to_numpy()
    return np.log(matrix / matrix.sum(axis=0))


def scores(data: np.ndarray, offsets: np.ndarray, matrix: np.ndarray, limit: int = ngrams.PIECE_BYTES) -> np.ndarray:
    """Joint log probabilities, row x language: sparse counts of a batch times the matrix."""
    out = np.tile(matrix[-1], (len(offsets) - 1, 1))
    for own, index, n in _buckets(data, offsets, limit):
        full = n > 0
        if full.any():
            out[own[full]] += np.add.reduceat(matrix[index], (np.cumsum(n) - n)[full], axis=0)
    return out


def predict(rows: DataFrame, model: Model, key_cols: list[str], text_col: str = "text") -> DataFrame:
    """``key_cols`` with lang_pred and score (the posterior, 0 to 1) of every whole text.

    The matrix of one block of languages at a time is broadcast, its size is fixed; with more than one
    block the rows are written with the best language so far and scored against the next. A text
    that is null or has no letter is ``und`` with score 0, as is every text if no language was learned.
    Ties go to the first language in order. Rows repeat as in the input; other columns are ignored.
    """
    spark = rows.sparkSession
    table = rows.select(*key_cols, F.col(text_col).alias("__text"), F.lit(None).cast("string").alias("__lang"), *(F.lit(float("-inf")).alias(c) for c in ("__best", "__total")))
    for block, (langs, matrix) in enumerate(model.blocks()):
        if block:
            table = written(table, "scored")
        more = (block + 1) * model.langs_at_once < model.n_langs
        table = _scored(table, langs, spark.sparkContext.broadcast(matrix), more)
    known = F.col("__lang").isNotNull()
    score = F.when(known, F.exp(F.col("__best") - F.col("__total"))).otherwise(0.0)
    return table.select(*key_cols, F.coalesce("__lang", F.lit("und")).alias("lang_pred"), score.alias("score"))


def _scored(table: DataFrame, langs: list[str], matrix: Broadcast, keep_text: bool) -> DataFrame:
    """``table`` with the best language, its joint log probability and the log of the sum of all, of these languages too."""
    fields = [f for f in table.schema.fields if keep_text or f.name != "__text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(langs, object)
        for batch in batches:
            column, lang, best, total = batch.columns[-4:]
            if len(batch):
                lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in column.to_pylist()], bool)
                joint = scores(*ngrams.text_bytes(column), matrix.value)
                top, before = joint.max(axis=1), best.to_numpy()
                sums = top + np.log(np.exp(joint - top[:, None]).sum(axis=1))
                better = lettered & (top > before)
                lang = pa.array(np.where(better, names[joint.argmax(axis=1)], np.array(lang.to_pylist(), object)).tolist(), pa.string())
                best, total = pa.array(np.where(better, top, before)), pa.array(np.logaddexp(total.to_numpy(), sums))
            arrays = [*batch.columns[: -3 if keep_text else -4], lang, best, total]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    return table.mapInArrow(run, StructType(fields))
