"""Landing only what changed, and keeping apart the lines that cannot be read.

Below ``root`` lie ``daily`` and ``rollup``, both by YEAR, and ``manifest``: one row per
file and year found in it, for each landing. The manifest is written last, so a landing that
was cut short is done again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherloom.functions import columns as C
from weatherloom.operators.sizing import bounded_collect
from weatherloom.schema import observations_schema
from weatherloom.sources import observations, sinks

_MANIFEST = "landing int, file string, path string, size long, modified timestamp, year int, n_rows long, n_unread long, gone boolean"
UNREAD = "UNREAD"
FILE = "FILE"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Observations with FILE and UNREAD: the text of a line that does not hold the eight fields, else null.

    Too few or too many fields and a VALUE that is no number make a line unread; its other columns are as far
    as they could be read. Blank lines are no lines. All columns have to be used or written together: a reader that
    is asked for some of them does not see what is wrong with the others.
    """
    schema = observations_schema().add(UNREAD, T.StringType())
    lines = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", UNREAD).csv(path)
    return lines.select("*", F.col("_metadata.file_path").alias(FILE))


def split_lines(lines: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(observations, unread lines with their FILE), after writing ``lines`` once below ``path``.

    The text is parsed once; both tables are read back from there, each in full.
    """
    lines.withColumn("IS_READ", F.col(UNREAD).isNull()).write.partitionBy("IS_READ").parquet(path)
    kept = lines.sparkSession.read.schema(T.StructType(lines.schema.fields + [T.StructField("IS_READ", T.BooleanType())])).parquet(path)
    return kept.where("IS_READ").drop("IS_READ", UNREAD), kept.where("NOT IS_READ").select(FILE, UNREAD)


def line_counts(read: DataFrame, unread: DataFrame, *by: str) -> DataFrame:
    """Lines, read and unread ones, by FILE or what else both tables of ``split_lines`` have."""
    keys = by or (FILE,)
    tagged = read.select(*keys, F.lit(True).alias("is_read")).unionByName(unread.select(*keys, F.lit(False).alias("is_read")))
    return tagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("N_LINES"), F.count_if("is_read").alias("N_READ"), F.count_if(~F.col("is_read")).alias("N_UNREAD")
    )


def present_files(spark: SparkSession, source: str, pattern: str | None = None) -> DataFrame:
    """``file, path, size, modified`` of every file below ``source``; none is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    facts = F.col("_metadata.file_path").alias("file"), F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    return reader.load(source).select(*facts)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """What the last landing that saw a file said about it, one row per file and year; files since removed are left out."""
    rows = _manifest_rows(spark, root)
    newest = Window.partitionBy("file")
    return rows.withColumn("newest", F.max("landing").over(newest)).where("landing = newest AND NOT gone").drop("newest")


def _manifest_rows(spark: SparkSession, root: str) -> DataFrame:
    if not _exists(spark, f"{root}/manifest"):
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def changes(spark: SparkSession, source: str, root: str, pattern: str | None = None) -> DataFrame:
    """``file, path, size, modified, change`` of files that are new, changed or removed since the last landing."""
    known = manifest(spark, root).select("file", F.col("size").alias("old_size"), F.col("modified").alias("old_modified")).distinct()
    both = present_files(spark, source, pattern).join(known, "file", "full_outer")
    same = (F.col("size") == F.col("old_size")) & (F.col("modified") == F.col("old_modified"))
    change = F.when(F.col("old_size").isNull(), "new").when(F.col("size").isNull(), "removed").when(~same, "changed")
    return both.withColumn("change", change).where("change IS NOT NULL").drop("old_size", "old_modified")


def land_changes(spark: SparkSession, source: str, root: str, *, pattern: str | None = None) -> DataFrame:
    """Bring ``root`` up to date with the files below ``source``; returns the years written: YEAR, N_ROWS.

    Only new and changed files are parsed, once, to a table in the shared folder. The years to be written are those
    that these files hold, and those that changed or removed files held before. Rows of such a year in
    other files are read again from those files, so a year may be spread over files. Years are replaced one by
    one (dynamic partition overwrite), and so is the rollup of the same years, from the landed rows.
    A year whose last file was removed stays in its folder but not in ``read_current``. Unread lines
    are counted in the manifest and go to ``root/unread``. Nothing changed: nothing is written.
    """
    found = changes(spark, source, root, pattern)
    changed = bounded_collect(found, label="changed files")  # one row per file
    if not changed:
        return spark.createDataFrame([], "YEAR int, N_ROWS long")
    rows = _manifest_rows(spark, root)
    number = (rows.agg(F.max("landing")).first()[0] or 0) + 1
    schema = "file string, path string, size long, modified timestamp, change string"
    listed = spark.createDataFrame(changed, schema)
    read = [r["path"] for r in changed if r["change"] != "removed"]
    staged = sinks.shared_path(spark, "staged")
    lines = read_lines(spark, read) if read else spark.createDataFrame([], read_schema())
    lines, unread = split_lines(C.with_year(lines), staged)
    unread.withColumn("landing", F.lit(number)).write.mode("append").parquet(f"{root}/unread")

    per_file = lines.groupBy(F.col(FILE).alias("file"), F.col("YEAR").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))
    bad = unread.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("n_unread"))
    entries = (
        listed.join(per_file, "file", "left").join(bad, "file", "left")
        .select(
            F.lit(number).alias("landing"), "file", "path", "size", "modified", "year",
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_unread", F.lit(0)).alias("n_unread"),
            (F.col("change") == "removed").alias("gone"),
        )
    )
    pending = sinks.shared_path(spark, "manifest")
    entries.write.parquet(pending)
    entries = spark.read.schema(_MANIFEST).parquet(pending)

    before = manifest(spark, root)
    touched = listed.select("file").join(before, "file").select("year").union(entries.where("n_rows > 0").select("year")).distinct()
    years = F.broadcast(touched.withColumnRenamed("year", "touched_year"))  # one row per year
    in_touched = F.col("YEAR").eqNullSafe(F.col("touched_year"))
    others = before.join(listed, "file", "left_anti").join(years, F.col("year").eqNullSafe(F.col("touched_year")), "left_semi")
    paths = [r["path"] for r in bounded_collect(others.select("path").distinct(), label="files of the same years")]
    rows = lines.drop(FILE)
    if paths:
        again = C.with_year(read_lines(spark, paths)).where(F.col(UNREAD).isNull()).select(*rows.columns)
        rows = rows.union(again.join(years, in_touched, "left_semi"))
    facts = entries.where("n_rows > 0").groupBy("year").agg(F.sum("size").alias("size"))
    observations.land_observations(rows, f"{root}/daily", facts=facts, replace_years=True)
    landed = observations.read_landed(spark, f"{root}/daily").join(years, in_touched, "left_semi")
    rollup = observations.rollup_observations(landed)
    rollup.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("YEAR").parquet(f"{root}/rollup")
    entries.write.mode("append").parquet(f"{root}/manifest")
    return touched.join(manifest(spark, root).groupBy(F.col("year").alias("known_year")).agg(F.sum("n_rows").alias("n")), F.col("year").eqNullSafe(F.col("known_year")), "left").select(
        F.col("year").alias("YEAR"), F.coalesce("n", F.lit(0)).alias("N_ROWS")
    )


def read_schema() -> T.StructType:
    """The columns of ``read_lines``."""
    return observations_schema().add(UNREAD, T.StringType()).add(FILE, T.StringType())


def read_current(spark: SparkSession, root: str, table: str = "daily") -> DataFrame:
    """The landed observations, or with ``table="rollup"`` their rollup, of the years that the manifest still has."""
    rows = observations.read_landed(spark, f"{root}/daily") if table == "daily" else spark.read.parquet(f"{root}/{table}")
    years = [r["year"] for r in bounded_collect(manifest(spark, root).where("n_rows > 0").select("year").distinct(), label="years")]
    known = F.col("YEAR").isin([y for y in years if y is not None])
    return rows.where(known | F.col("YEAR").isNull() if None in years else known)
