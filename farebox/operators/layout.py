"""How tables lie in files: day folders, clustering, file counts and sizes."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from farebox.functions.times import in_half_open

DAY = "day"


def by_day(df: DataFrame, ts: str, cluster_by: str | None = None, day: str = DAY) -> DataFrame:
    """Add the day column and bring the rows of a day together for writing.

    ``rebalance`` lets adaptive execution split a day that is far larger than the others over several tasks and merge small
    days. With ``cluster_by`` tasks hold ranges of (day, cluster column, time), whose bounds Spark measures on a sample: each
    file of a day then has a narrow range of the cluster column, and a value that most rows carry is split by time.
    """
    df = df.withColumn(day, F.col(ts).cast("date"))
    if cluster_by is None:
        return df.hint("rebalance", F.col(day))
    return df.repartitionByRange(day, cluster_by, ts).sortWithinPartitions(day, cluster_by, ts)


def day_partitioned(df: DataFrame, ts: str, cluster_by: str | None = None, day: str = DAY) -> DataFrameWriter:
    """Writer for a table with one folder per day: finish with ``.parquet(path)`` or ``.saveAsTable(name)``."""
    return by_day(df, ts, cluster_by, day).write.partitionBy(day)


def with_day_range(df: DataFrame, ts: str, start, end, day: str = DAY) -> DataFrame:
    """Rows with start <= ts < end of a day-partitioned table; the added day predicate prunes folders."""
    last = F.lit(str(end)).cast("timestamp_ntz") - F.expr("interval 1 microsecond")
    return df.where(
        in_half_open(ts, start, end)
        & F.col(day).between(F.lit(str(start)[:10]).cast("date"), last.cast("date"))
    )


def write_in_files(df: DataFrame, n: int, path: str) -> None:
    """Overwrite ``path`` with ``n`` parquet files of equal row counts."""
    df.repartition(n).write.mode("overwrite").parquet(path)


def write_for_day(df: DataFrame, path: str, day: date | datetime | str) -> None:
    """Write (or rewrite) the output of one day, other days stay untouched."""
    df.withColumn(DAY, F.lit(str(day)[:10]).cast("date")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(DAY).parquet(path)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the parquet files below a path, from the listing alone."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        .load(path).select("path", "length")
    )


def mean_file_size(spark: SparkSession, path: str) -> DataFrame:
    """(files, mean_mb) of a stored table."""
    return file_sizes(spark, path).agg(
        F.count(F.lit(1)).alias("files"), F.round(F.avg("length") / (1024 * 1024), 2).alias("mean_mb")
    )
