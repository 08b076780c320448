"""Table sources and sinks: partitioned files and JDBC.

Connection settings are explicit arguments (no environment lookups).  The
JDBC paths need the database's driver jar on the classpath; they are not run
by the test suite here (no database may be started in this environment).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(
    df: DataFrame,
    path: str,
    *,
    partition_by: tuple[str, ...] = ("symbol",),
    order_by: str = "tstamp",
    stretch: int = 86400 * 366 * 4,
    mode: str = "overwrite",
    fmt: str = "parquet",
    max_records_per_file: int | None = None,
) -> None:
    """Write with one directory per key; overwrite replaces only the partitions present.

    ``partitionOverwriteMode=dynamic`` makes a reload of one symbol replace that
    symbol's directory and nothing else.  Rows are hashed by (partition
    columns, stretch of ``order_by``), which needs no sample and so computes
    the input once; a long series has a writer for each stretch.  Files come
    out ordered by ``order_by`` (tight min/max statistics for filters).
    """
    if order_by in df.columns:
        df = df.repartition(*partition_by, F.floor(F.col(order_by) / int(stretch))).sortWithinPartitions(*partition_by, order_by)
    writer = df.write.format(fmt).mode(mode).option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(int(max_records_per_file)))
    writer.partitionBy(*partition_by).save(path)


def read_partitioned(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read a partitioned table; with ``schema`` the partition columns keep their
    written types (otherwise Spark infers them from directory names, so a
    symbol like ``67`` would come back as an integer)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    partition_column: str | None = "tstamp",
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int = 8,
) -> DataFrame:
    """Table scan over JDBC, split into ``num_partitions`` range reads on ``partition_column``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column and lower_bound is not None and upper_bound is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    mode: str = "overwrite",
    properties: dict[str, str] | None = None,
    num_partitions: int | None = None,
) -> None:
    """Write a frame to a database table (default mode overwrite)."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
