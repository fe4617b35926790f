"""Writing derived tables, and the folder they are shared in."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Writer options of each form a table can be saved in.
_FORMS = {"parquet": {}, "csv": {"header": True, "compression": "gzip"}}


def packed_by(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Bring the rows of a key together before a partitioned write.

    A fixed number of partitions suits a small table. Without one, adaptive
    execution picks the number and splits keys that are too large for one task.
    """
    return df.repartition(partitions, key) if partitions else df.hint("rebalance", key)


def save(df: DataFrame, path: str, form: str = "parquet", *, by: Sequence[str] = (), files: int | None = None, append: bool = False) -> str:
    """Save as Parquet or gzip CSV, in folders by the columns ``by``; returns ``path``.

    ``files=1`` gives a single file and is for small results only. CSV refuses nested columns.
    """
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    if form == "csv" and nested:
        raise ValueError(f"CSV cannot hold nested columns: {', '.join(nested)}")
    rows = df.coalesce(files) if files else df
    rows.write.options(**_FORMS[form]).save(path, form, "append" if append else "overwrite", list(by) or None)
    return path


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster shares: ``spark.checkpoint.dir``, else the warehouse.

    With several machines a folder of one of them would lose rows, so it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/weatherloom"
        if urlsplit(root).scheme in ("", "file") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def rename_folders(spark: SparkSession, path: str, prefix: str, new_prefix: str = "", suffix: str = "") -> None:
    """Rename the folders below ``path`` that begin with ``prefix``: it gives way to ``new_prefix``, and ``suffix`` is added."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in system.listStatus(place):
        name = found.getPath().getName()
        if name.startswith(prefix):
            system.rename(found.getPath(), spark._jvm.org.apache.hadoop.fs.Path(place, f"{new_prefix}{name.removeprefix(prefix)}{suffix}"))
