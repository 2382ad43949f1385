"""Incremental load of one time interval: month files, staging with latest-wins dedup, daily report."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions import double_text, in_half_open, row_id
from farebox.operators.checks import (
    assert_all,
    duplicate_count,
    non_negative,
    not_null,
    run_checks,
    scalar_equals,
)
from farebox.operators.conform import ingest_shape
from farebox.operators.dedup import keep_one
from farebox.operators.layout import DAY, by_day, with_day_range
from farebox.operators.tables import (
    LEDGER,
    append_rows,
    create_if_missing,
    create_published,
    overwrite_interval_in_table,
    pending_units,
)
from farebox.operators.versions import discard, publish, stage_partitions
from farebox.schemas import INGESTED_TRIP
from farebox.sources.files import UnitFile, month_units, read_unit_files, unit_files

NO_PAYMENT_NAME = "unknown"
STAGED_COLUMNS = (
    "trip_id pickup_datetime dropoff_datetime taxi_type vendor_id passenger_count trip_distance pickup_location_id "
    "dropoff_location_id payment_type payment_type_name fare_amount tip_amount total_amount extracted_at"
).split()


AMOUNTS = ["fare_amount", "tip_amount", "total_amount"]


def staging_trips(trips: DataFrame, payment_lookup: DataFrame, start, end) -> DataFrame:
    """Valid trips picked up in [start, end), one row per identity (the latest extraction), with id and payment name.

    The id hashes the amounts' text; equal text means equal value, so rows are matched by value, which sorts
    faster. Filters come first and reach the scan; the lookup join and the md5 run on the rows that are kept.
    """
    # Spark orders NaN above all numbers, so it has to be refused by name
    valid = trips.where(
        in_half_open("pickup_datetime", start, end)
        & (F.col("trip_distance") >= 0) & ~F.isnan("trip_distance")
        & (F.col("total_amount") >= 0) & ~F.isnan("total_amount")
    )
    places = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id"]
    identity = ["pickup_datetime", "dropoff_datetime", "vendor_id", "pu_location_id", "do_location_id", *AMOUNTS, "taxi_type"]
    latest = keep_one(valid, identity, [F.col("extracted_at").desc_nulls_last()])
    lookup = payment_lookup.select(F.col("payment_type_id").alias("_code"), "payment_type_name")
    return (
        latest.join(lookup, F.col("payment_type") == F.col("_code"), "left")
        .withColumn("trip_id", row_id(*places, *[double_text(c) for c in AMOUNTS], "taxi_type"))
        .withColumnsRenamed({"pu_location_id": "pickup_location_id", "do_location_id": "dropoff_location_id"})
        .select(*STAGED_COLUMNS)
    )


def trips_report(staged: DataFrame, start, end) -> DataFrame:
    """Daily totals per taxi type and payment name for pickups in [start, end)."""
    return staged.where(in_half_open("pickup_datetime", start, end)).groupBy(
        "taxi_type",
        F.col("pickup_datetime").cast("date").alias("pickup_date"),
        F.coalesce("payment_type_name", F.lit(NO_PAYMENT_NAME)).alias("payment_type_name"),
    ).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("passenger_count").alias("total_passengers"),
        F.avg("trip_distance").alias("avg_trip_distance"),
        F.sum("fare_amount").alias("total_fare"),
        F.sum("tip_amount").alias("total_tips"),
        F.sum("total_amount").alias("total_revenue"),
    )


def check_staging(staged: DataFrame) -> DataFrame:
    rows = run_checks(staged, [not_null("trip_id"), non_negative("trip_distance"), non_negative("total_amount")])
    return rows.unionByName(scalar_equals("no_duplicate_trips", duplicate_count(staged, "trip_id"), 0))


def check_report(report: DataFrame) -> DataFrame:
    return run_checks(report, [non_negative("total_trips")])


LOAD_MONTH = "load_month"
# Names of the pickup time in the files of each taxi type.
PICKUP_TIMES = ("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime")


def _file_key(path: Column) -> Column:
    """A file's path in one form, whether it is written as a URI or not."""
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.regexp_replace(plain, "^file:/+", "file:/")


def _shaped(spark: SparkSession, files: list[UnitFile], taxi_type: str, raw: DataFrame) -> DataFrame:
    """Rows of month files in the ingest shape, with the month they were loaded for."""
    months = spark.createDataFrame([(f.path, f.unit[1]) for f in files], "file string, month date").select(
        _file_key(F.col("file")).alias("_file"), F.col("month").alias("_month"))
    # a row per file, so this is broadcast by its size
    raw = raw.withColumn("_from", _file_key(F.col("_from"))).join(months, F.col("_from") == F.col("_file"), "left")
    shaped = ingest_shape(raw, taxi_type, F.current_timestamp(), keep=("_month",))
    for field in INGESTED_TRIP.fields:
        if field.name not in shaped.columns:
            shaped = shaped.withColumn(field.name, F.lit(None))
    return shaped.select(*[F.col(f.name).cast(f.dataType) for f in INGESTED_TRIP.fields], F.col("_month").alias(LOAD_MONTH))


def load_months(
    spark: SparkSession,
    table: str,
    ledger: str,
    path_of: Callable[[str, date], str],
    start: date,
    end: date,
    taxi_types: Iterable[str] = ("yellow", "green"),
    index: str | None = None,
) -> list[tuple[str, date]]:
    """Load the month files the ledger does not list into a table with partitions (type, month loaded, pickup day); returns
    the units loaded now.

    Months without a file are skipped and stay pending. What a unit had in the table is replaced by what its files hold,
    all units in one switch, so a run that dies between the rows and the ledger loads the same units again without
    repeating a row. The rows of every unit are counted before the switch and must be those that the files' footers state,
    which is what the ledger records, with the time of loading. ``index`` keeps the footers for later runs.
    """
    units = spark.createDataFrame(month_units(taxi_types, start, end), "taxi_type string, month date")
    todo = [tuple(r) for r in pending_units(units, spark.table(ledger), ["taxi_type", "month"]).collect()]
    files, missing = unit_files(spark, sorted(todo), path_of, index, PICKUP_TIMES)
    done = sorted(set(todo) - set(missing))
    if not done:
        return []
    frames = []
    for taxi_type in sorted({u[0] for u in done}):
        own = [f for f in files if f.unit[0] == taxi_type]
        raw = read_unit_files(spark, own, file_column="_from")
        if raw is not None:
            frames.append(_shaped(spark, own, taxi_type, raw))
    counts = dict.fromkeys(done, 0)
    for file in files:
        counts[file.unit] += file.n_rows
    if frames:
        loaded = {(taxi_type, str(month)) for taxi_type, month in done}
        rows = by_day(reduce(DataFrame.unionByName, frames), "pickup_datetime")
        version = stage_partitions(rows, table, lambda values: (values["taxi_type"], values[LOAD_MONTH]) in loaded)
        stored = spark.table(version.table).groupBy("taxi_type", LOAD_MONTH).count()
        found = {(r["taxi_type"], r[LOAD_MONTH]): r["count"] for r in stored.collect()}
        if any(found.get(unit, 0) != n for unit, n in counts.items()):
            discard(spark, version)
            raise ValueError(f"rows read differ from those the files' footers state: {found} instead of {counts}")
        publish(version, spark)
    now = datetime.now(timezone.utc)
    append_rows(spark.createDataFrame([(*u, counts[u], now) for u in done], LEDGER), ledger)
    return done


def run_interval(
    spark: SparkSession,
    database: str,
    root: str,
    path_of: Callable[[str, date], str],
    payment_lookup: DataFrame,
    start: datetime,
    end: datetime,
    taxi_types: Iterable[str] = ("yellow", "green"),
) -> None:
    """Ingest, stage, check and report one interval into ``database``, whose tables lie under ``root``.

    Running the same interval again leaves the same tables. Staged trips and report are checked before they are published:
    a failed check stops there, and both tables are as they were.
    """
    names = {t: f"{database}.{t}" for t in ("ingested_trips", "load_ledger", "staged_trips", "trips_report")}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    ingest = T.StructType([*INGESTED_TRIP.fields, T.StructField(LOAD_MONTH, T.DateType()), T.StructField(DAY, T.DateType())])
    create_published(spark, names["ingested_trips"], ingest, partition_by=["taxi_type", LOAD_MONTH, DAY])
    create_if_missing(spark, names["load_ledger"], LEDGER)
    first, after = datetime.combine(start.date(), datetime.min.time()), _next_midnight(end)
    load_months(
        spark, names["ingested_trips"], names["load_ledger"], path_of, first.date(), after.date(), taxi_types, f"{root}/file_index")

    ingested = with_day_range(spark.table(names["ingested_trips"]), "pickup_datetime", start, end).drop(DAY, LOAD_MONTH)
    staged = staging_trips(ingested, payment_lookup, start, end)
    _create_by_day(spark, names["staged_trips"], staged.schema)

    def judge_staged(rows: DataFrame) -> None:
        assert_all(check_staging(with_day_range(rows, "pickup_datetime", start, end).drop(DAY)))

    overwrite_interval_in_table(spark, names["staged_trips"], staged, "pickup_datetime", start, end, audit=judge_staged)

    # the report's unit is the day, so days the interval only partly covers are summed whole
    days = with_day_range(spark.table(names["staged_trips"]), "pickup_datetime", first, after)
    report = trips_report(days, first, after)
    _create_by_day(spark, names["trips_report"], report.schema)

    def judge_report(rows: DataFrame) -> None:
        assert_all(check_report(with_day_range(rows, "pickup_date", first, after)))

    overwrite_interval_in_table(spark, names["trips_report"], report, "pickup_date", first, after, audit=judge_report)


def _next_midnight(moment: datetime) -> datetime:
    midnight = datetime.combine(moment.date(), datetime.min.time())
    return midnight if midnight == moment else datetime.fromordinal(midnight.toordinal() + 1)


def _create_by_day(spark: SparkSession, name: str, schema: T.StructType) -> None:
    create_published(spark, name, T.StructType([*schema.fields, T.StructField(DAY, T.DateType())]), partition_by=[DAY])
