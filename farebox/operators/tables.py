"""Stored tables: create, append, insert-only merge, interval overwrite, keyed upsert, load ledger.

Each operation exists twice where that helps: as a function from frames to a frame (what the table holds
afterwards) and as a write that touches only the files it has to. One writer per table at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, time, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions.times import in_half_open
from farebox.operators.dedup import keep_latest, keep_one
from farebox.operators.layout import DAY
from farebox.operators.versions import publish, stage, stage_partitions, stored_table
from farebox.session import scratch_path


# ---- create, replace, append ----

Audit = Callable[[DataFrame], None]


def replace_table(
    df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None, audit: Audit | None = None
) -> None:
    """Store the frame under a name, replacing what was there (also the full-refresh path of every build).

    The rows are written beside the former ones and the name is switched over in one action, so whatever fails before
    leaves the former table. ``audit`` gets the written rows first; if it raises, they are not published. The table lies in
    ``path`` (by default below its database).
    """
    version = stage(df, name, partition_by or (), path)
    if audit is not None:
        audit(df.sparkSession.table(version.table))
    publish(version, df.sparkSession)


def create_published(
    spark: SparkSession, name: str, schema: T.StructType, path: str | None = None, partition_by: list[str] | None = None
) -> None:
    """An empty published table with this schema, unless there is a table of that name."""
    if not spark.catalog.tableExists(name):
        replace_table(spark.createDataFrame([], schema), name, path, partition_by)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write the frame and read it back: what is used several times is computed once and survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_ddl(
    name: str, schema: T.StructType, path: str | None = None, partition_by: list[str] | None = None,
    compression: str | None = None,
) -> str:
    """CREATE TABLE text for a schema."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = f" OPTIONS (compression '{compression}')" if compression else ""
    partitions = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    location = f" LOCATION '{path}'" if path else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{options}{partitions}{location}"


def create_if_missing(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str | None = None,
    partition_by: list[str] | None = None,
    compression: str | None = None,
) -> None:
    """An empty table with this schema, unless the table exists; without ``path`` Spark manages its files."""
    spark.sql(table_ddl(name, schema, path, partition_by, compression))


def append_rows(df: DataFrame, name: str, derived: dict[str, Column] | None = None) -> None:
    """Append by column name. Repeating it repeats the rows; use the ledger or a later dedup for that.

    ``derived`` are columns that follow from the others. They are made after the rows are dealt out, which so move without
    them, but for those that the rows are dealt out by.
    """
    spark = df.sparkSession
    target = stored_table(spark, name)
    columns = spark.table(target).columns
    buckets, folders = bucketing(spark, target), partition_columns(spark, target)
    dealt_by = [buckets[0]] if buckets else folders
    later = {c: made for c, made in (derived or {}).items() if c not in dealt_by}
    rows = df.withColumns({c: made for c, made in (derived or {}).items() if c in dealt_by})
    rows = rows.drop(*later) if later else rows.select(*columns)
    if buckets:  # dealt out as the buckets are, so that a write makes one file per bucket
        rows = rows.repartition(buckets[1], buckets[0])
    elif folders:  # else every task writes a file into every folder; one that is far larger than others is split
        rows = rows.hint("rebalance", *[F.col(c) for c in folders])
    rows.withColumns(later).select(*columns).write.insertInto(target)


def with_lineage(
    df: DataFrame, extracted_at: Column | None = None, **labels: str
) -> DataFrame:
    """Add source file name, extraction time and constant labels."""
    stamped = df.select(
        "*", F.col("_metadata.file_name").alias("filename"),
        (extracted_at if extracted_at is not None else F.current_timestamp()).alias("extracted_at"),
    )
    return stamped.withColumns({k: F.lit(v) for k, v in labels.items()})


def create_bucketed(
    spark: SparkSession, name: str, schema: T.StructType, id_col: str, buckets: int, partition_by: list[str] | None = None
) -> None:
    """An empty table whose rows are stored in buckets by a hash of ``id_col``, unless the table exists.

    Merges by that id then read the table bucket by bucket instead of shuffling it. A bucket (of all partitions that are
    read) is one task's work, so take as many as the table will have gigabytes.
    """
    clustered = f" CLUSTERED BY (`{id_col}`) INTO {buckets} BUCKETS"
    spark.sql(table_ddl(name, schema, None, partition_by) + clustered)


def bucketing(spark: SparkSession, name: str) -> tuple[str, int] | None:
    """Column and number of the buckets of a stored table with one bucket column; None without buckets."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    columns = (about.get("Bucket Columns") or "").strip("[]").replace("`", "").split(", ")
    return (columns[0], int(about["Num Buckets"])) if "Num Buckets" in about and len(columns) == 1 else None


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """The columns that a stored table has folders for."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


# ---- insert-only merge ----

def _value_of(column: str, df: DataFrame) -> Column:
    """Condition: the column holds one of the frame's values of it, or NULL. As a scalar subquery it prunes folders."""
    values = df.agg(F.collect_set(column).alias("all")).scalar()
    return F.array_contains(values, F.col(column)) | F.col(column).isNull()


def rows_to_insert(
    target: DataFrame,
    source: DataFrame,
    id_col: str,
    within: str | None = None,
    dedup_source: bool = False,
    order: str | None = None,
) -> DataFrame:
    """Source rows whose id the target does not hold.

    Duplicates inside the source are all inserted unless ``dedup_source``. ``within`` names a column of few values that
    both sides share and the id is derived from (the day): of the target only the source's values are then read, not
    the days between them, which prunes folders when the target is partitioned by it. Of the target only the id is
    read. The source is read once more for its values; pass a stored one when it is costly.
    """
    if dedup_source:
        source = keep_one(source, [id_col], [F.col(order).asc_nulls_last()] if order else [])
    if within:
        target = target.where(_value_of(within, source))
    return source.join(target.select(id_col), id_col, "left_anti").select(*source.columns)


def insert_only_merge(target: DataFrame, source: DataFrame, id_col: str, **options) -> DataFrame:
    """The target after the merge."""
    return target.unionByName(rows_to_insert(target, source, id_col, **options))


def merge_into_table(spark: SparkSession, name: str, source: DataFrame, id_col: str, **options) -> None:
    """Insert-only merge into a stored table: existing files are never rewritten, a repeated run inserts nothing.

    A target that is bucketed by the id is not shuffled: the source's rows are dealt out as its buckets are.
    """
    append_rows(rows_for_table(spark, name, source, id_col, **options), name)


def merge_files_into_table(
    spark: SparkSession, name: str, source: DataFrame, id_col: str, derived: dict[str, Column], within: str | None = None
) -> None:
    """``merge_into_table`` for a source that lies in files and can be read again instead of being kept a second time.

    ``derived`` are columns that follow from the source's own, the id usually among them. First the bare ids are compared;
    rows move only if they are to be inserted, and without those columns. The source is read for its values of ``within``,
    for its ids and for its rows: only for its rows where the target holds nothing of its values, not for them if all its
    ids are held.
    """
    buckets = bucketing(spark, stored_table(spark, name))
    if buckets and buckets[0] == id_col:  # the target lies as it is needed
        merge_into_table(spark, name, source.withColumns(derived), id_col, within=within)
        return
    rows = _rows_by_id(spark, name, source, id_col, derived, within)
    if rows is not None:
        append_rows(rows, name, derived)


def _rows_by_id(
    spark: SparkSession, name: str, source: DataFrame, id_col: str, derived: dict[str, Column], within: str | None
) -> DataFrame | None:
    """Source rows whose id the target does not hold, without the derived columns; None if there are none."""
    target, whole = spark.table(name), source.withColumns(derived)
    if target.isEmpty():
        return source
    if within:
        values = stored(whole.select(within).distinct(), scratch_path(spark, "merge-values"))
        target = target.where(_value_of(within, values))
        if target.isEmpty():
            return source
    brief = target.schema[id_col].dataType == whole.schema[id_col].dataType == T.StringType()
    key = _brief_id(id_col) if brief else F.col(id_col)
    given, held = whole.select(key.alias("_id")), target.select(key.alias("_id"))
    missing = stored(given.join(held, "_id", "left_anti"), scratch_path(spark, "merge-ids")).toDF("_missing")
    if missing.isEmpty():
        return None
    rows = whole.withColumn("_id", key).drop(*derived)
    return rows.join(missing, F.col("_id").eqNullSafe(F.col("_missing")), "left_semi").drop("_id")


def _brief_id(id_col: str) -> Column:
    """The id as bytes, of an md5's text the 16 that it stands for; different ids stay different and NULL stays NULL."""
    digest = F.col(id_col).rlike(r"\A[0-9a-f]{32}\z")
    # other texts are 17 bytes at least, so that none is taken for a digest
    return F.when(digest, F.unhex(id_col)).otherwise(F.concat(F.col(id_col).cast("binary"), F.lit(bytes(17))))


def rows_for_table(spark: SparkSession, name: str, source: DataFrame, id_col: str, **options) -> DataFrame:
    """The rows that ``merge_into_table`` would append."""
    buckets = bucketing(spark, stored_table(spark, name))
    if buckets and buckets[0] == id_col:
        source = source.repartition(buckets[1], id_col)
    return rows_to_insert(spark.table(name), source, id_col, **options)


# ---- interval overwrite ----

def interval_overwrite(target: DataFrame, new: DataFrame, key: str, start, end) -> DataFrame:
    """The target with its rows of [start, end) replaced by ``new``; rows without key stay."""
    outside = ~in_half_open(key, start, end) | F.col(key).isNull()
    return target.where(outside).unionByName(new.select(*target.columns))


def overwrite_interval_in_table(
    spark: SparkSession, name: str, new: DataFrame, key: str, start: datetime, end: datetime, day: str = DAY,
    audit: Audit | None = None,
) -> None:
    """Replace [start, end) of a published, day-partitioned table, reading and writing only the days of the interval.

    Days that only partly fall into the interval keep their other rows. Days of the interval that got no new row end
    empty. New rows are written beside the old ones, ``audit`` sees the table as it would be (and may raise), and then all
    days are switched over in one action: a reader sees the whole old interval or the whole new one, and a crash leaves
    the old one.
    """
    last = end - timedelta(microseconds=1)
    edges = {m.date() for m, whole in ((start, start.time() == time.min), (last, end.time() == time.min)) if not whole}
    fresh = new.where(in_half_open(key, start, end)).withColumn(day, F.col(key).cast("date"))
    if edges:
        outside = spark.table(name).where(F.col(day).isin(sorted(edges)) & ~in_half_open(key, start, end))
        fresh = fresh.unionByName(outside.select(*fresh.columns))

    def inside(values: dict[str, str | None]) -> bool:
        # text order is date order
        return values[day] is not None and str(start.date()) <= values[day] <= str(last.date())

    version = stage_partitions(fresh.hint("rebalance", F.col(day)), name, inside)
    if audit is not None:
        audit(spark.table(version.table))
    publish(version, spark)


# ---- keyed upsert ----

def upsert_by_key(target: DataFrame, batch: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """The target with the batch's rows put in by key; NULL is a key like any other.

    With ``order`` the latest of several batch rows per key wins; without it the batch has to hold a key once.
    """
    if order:
        batch = keep_latest(batch, keys, order)
    replaced = batch.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    return target.join(replaced, same, "left_anti").unionByName(batch.select(*target.columns))


def upsert_into_table(
    spark: SparkSession, name: str, batch: DataFrame, keys: list[str], day: str = DAY, order: str | None = None
) -> None:
    """Keyed upsert into a published, day-partitioned table; rewrites only the days the batch touches, all switched over at
    once.

    The keys must determine the day. Running it again with the same batch changes nothing, also after a crash. The batch is
    read several times; pass a stored or cached one when it is costly. For many small batches see ``operators.keyed``,
    whose writes grow with the batch and not with its days.
    """
    touched = spark.table(name).where(_value_of(day, batch))
    publish(stage_partitions(upsert_by_key(touched, batch, keys, order).hint("rebalance", F.col(day)), name), spark)


# ---- load ledger ----

LEDGER = T.StructType([
    T.StructField("taxi_type", T.StringType()),
    T.StructField("month", T.DateType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("loaded_at", T.TimestampType()),
])


def pending_units(units: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Units the ledger does not list yet."""
    return units.join(ledger.select(*keys), keys, "left_anti")
