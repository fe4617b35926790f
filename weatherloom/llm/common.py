"""What the operators share: the shared folder, written tables, checked broadcasts, keys of rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only after its rows were counted; at most so many.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a local master gets a temporary folder; any other master is an error,
    as a folder of one machine would lose what other machines write.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="weatherloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it is.

    Counts the rows, so ``df`` should be a written table.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_hash(text: Column) -> Column:
    """Together with doc_id the key of a row; null texts count as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without_rows(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text_hash) is not in ``removed``; all columns of ``docs`` stay.

    Null ids compare equal. ``removed`` has the columns doc_id and text_hash and is a written table.
    """
    mark = uuid.uuid4().hex
    gone = removed.select(F.col("doc_id").alias(f"i{mark}"), F.col("text_hash").alias(f"h{mark}"))
    same = docs[id_col].eqNullSafe(gone[f"i{mark}"]) & (text_hash(docs[text_col]) == gone[f"h{mark}"])
    return docs.join(small(gone), same, "left_anti")


def tidy_map(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``rows.mapInArrow(run, schema)``; after each task the worker gives unused memory back, as it is used again."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(tidy, schema)


def crc_mod3(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3
