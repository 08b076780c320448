"""Keyed merge into a table of files: copy-on-write of only the folders that a batch touches.

The table has a folder for each (partition column, stretch of time). A batch
is merged by key: of equal keys the row of the greatest version stays, else
the batch's. Only folders that hold a row of the batch are read and replaced;
the others' files are not opened and keep their names and times, and the rows
of the whole table are never read.

A merge first writes the new contents of its folders beside the table
(``_merge``), then replaces the folders, then drops what it wrote. If it ends
in between, the next merge first replaces the folders again from there, so a
folder that was taken away and not yet put back is not lost. One writer at a
time; a batch that is merged twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.plans.segments import PREFIX, q, refuse_own_names

#: Name of the stretch folders, and seconds of a stretch.
STRETCH, SECONDS = "stretch", 86400 * 366 * 4
_STAGED = "_merge"


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _folder(spark, path)
    return fs.exists(at)


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the finished folders ``<name>=<number>`` in a folder."""
    fs, at = _folder(spark, path)
    if not fs.exists(at):
        return []
    found = [s.getPath().getName().split("=", 1) for s in fs.listStatus(at)]
    return sorted(int(x[1]) for x in found if x[0] == name and exists(spark, f"{path}/{'='.join(x)}/_SUCCESS"))


def _replace(rows: DataFrame, path: str, by: Sequence[str], order: str) -> None:
    """Replaces the folders that have rows; each is written by one task, in order."""
    dealt = rows.repartition(*[F.col(q(c)) for c in by]).sortWithinPartitions(*[F.col(q(c)) for c in [*by, order]])
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def recover(spark: SparkSession, path: str, by: Sequence[str], order: str) -> None:
    """Finishes a merge that ended after its new contents were written."""
    fs, staged = _folder(spark, f"{path}/{_STAGED}")
    if not fs.exists(staged):
        return
    if exists(spark, f"{path}/{_STAGED}/_SUCCESS"):
        _replace(spark.read.parquet(f"{path}/{_STAGED}"), path, by, order)
    fs.delete(staged, True)


def merge(
    batch: DataFrame,
    path: str,
    *,
    keys: Sequence[str] = ("symbol", "tstamp"),
    order: str = "tstamp",
    version: str | None = None,
    seconds: int = SECONDS,
) -> None:
    """Merge ``batch`` into the table at ``path``, which has the batch's columns.

    ``order`` is the key column of time; the other keys name folders.
    ``version``: a column that tells which of two rows with one key is newer,
    whichever batch came first.  Of rows alike in that, the batch's stays, and
    of several such in the batch the greatest.  Rows with a null key are keys
    like others.
    """
    refuse_own_names(batch, [STRETCH])
    spark = batch.sparkSession
    by = [*[k for k in keys if k != order], STRETCH]
    recover(spark, path, by, order)
    new = batch.withColumn(STRETCH, F.floor(F.col(q(order)) / int(seconds)).cast("long"))
    rank = PREFIX + "rank"
    rows = new.withColumn(rank, F.lit(1))
    if exists(spark, path):
        ends = new.agg(F.min(STRETCH).alias("lo"), F.max(STRETCH).alias("hi"), F.max(F.col(STRETCH).isNull()).alias("none")).first()
        # first by bounds that the folder names answer, then by the touched folders themselves
        reach = F.col(STRETCH).between(ends["lo"], ends["hi"]) | (F.col(STRETCH).isNull() if ends["none"] else F.lit(False))
        held = spark.read.schema(new.schema).parquet(path).where(F.coalesce(reach, F.lit(False)))
        touched = new.select(*[F.col(q(c)).alias(f"{PREFIX}{i}") for i, c in enumerate(by)]).distinct()
        same = F.lit(True)
        for i, c in enumerate(by):
            same = same & F.col(q(c)).eqNullSafe(F.col(f"{PREFIX}{i}"))
        rows = held.join(touched, same, "left_semi").withColumn(rank, F.lit(0)).unionByName(rows)
    whole = F.struct(*[F.col(q(c)) for c in new.columns])
    newest = F.struct(*([F.col(q(version))] if version else []), F.col(rank), whole)
    merged = rows.groupBy(*[F.col(q(k)) for k in keys], F.col(STRETCH)).agg(F.max(newest).alias(rank))
    last = 2 if version else 1
    name = merged.schema[rank].dataType.fieldNames()[last]
    staged = f"{path}/{_STAGED}"
    merged.select(*[F.col(f"{rank}.{name}.{q(c)}").alias(c) for c in new.columns]).write.mode("overwrite").parquet(staged)
    recover(spark, path, by, order)


def read_merged(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table, in the columns of its batches (``schema``); the stretch folders still serve filters on ``STRETCH`` through ``spark.read``."""
    return spark.read.schema(schema).parquet(path).select(*[F.col(q(f.name)) for f in schema.fields])
