"""Monthly CSV files merged into one table per service by hashed row id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions import double_text, row_id
from farebox.operators.layout import DAY
from farebox.operators.tables import create_if_missing, merge_files_into_table
from farebox.schemas import GREEN_CSV, YELLOW_CSV
from farebox.sources.files import read_csv

# Declared schema of each service's files and the prefix of its time columns.
SERVICES = {"yellow": (YELLOW_CSV, "tpep"), "green": (GREEN_CSV, "lpep")}


def file_row_id(prefix: str) -> Column:
    """Unseparated id of vendor, times, places, fare and distance of a raw feed."""
    return row_id(
        "VendorID", f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime", "PULocationID", "DOLocationID",
        double_text("fare_amount"), double_text("trip_distance"), sep="")


def made_columns(service: str, filename: str) -> dict[str, Column]:
    """Columns that every row of a month file gets: its id and the name of the file."""
    return {"unique_row_id": file_row_id(SERVICES[service][1]), "filename": F.lit(filename)}


def staged_file(spark: SparkSession, service: str, path: str, filename: str) -> DataFrame:
    """Rows of a month file with ``unique_row_id`` and ``filename`` in front and the pickup day behind."""
    schema, prefix = SERVICES[service]
    rows = read_csv(spark, path, schema=schema)
    made = [column.alias(name) for name, column in made_columns(service, filename).items()]
    return rows.select(*made, "*", F.col(f"{prefix}_pickup_datetime").cast("date").alias(DAY))


def merge_month_file(spark: SparkSession, table: str, service: str, path: str, filename: str) -> None:
    """Insert the rows of a month file whose id ``table`` doesn't hold; a file merged before inserts nothing.

    The table has a folder per pickup day, which the id is made of, so only the file's days are read, and of them only
    the id. Rows without a pickup time lie in a folder of their own. The file is not stored a second time: its days and ids
    are read first, and its rows where some are to be inserted. These move once, by day, and get their id after that.
    """
    staged, made = staged_file(spark, service, path, filename), made_columns(service, filename)
    create_if_missing(spark, table, staged.schema, partition_by=[DAY], compression="zstd")
    merge_files_into_table(spark, table, staged.drop(*made), "unique_row_id", made, within=DAY)
