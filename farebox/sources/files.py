"""Parquet, CSV and JSON files as DataFrames."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from datetime import date, datetime
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions.times import next_month
from farebox.sources import file_index


def read_parquet(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet files, directories or globs; ``columns`` limits what the scan reads."""
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def external_view(df: DataFrame, name: str) -> DataFrame:
    """Give a file-backed DataFrame a name in SQL without storing anything."""
    df.createOrReplaceTempView(name)
    return df


def read_csv(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
    mode: str = "PERMISSIVE",
    spread_over: int | None = None,
) -> DataFrame:
    """CSV with one header line, plain or gzip, globs allowed.

    With a schema, columns beyond it are dropped and unreadable cells become NULL (``mode="FAILFAST"`` stops
    instead). Without one, everything is text unless ``infer``. A gzip file is one task whatever its size;
    ``spread_over`` redistributes the rows of few large ones.
    """
    reader = spark.read.option("header", True).option("timestampFormat", timestamp_format).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(list(paths))
    return df.repartition(spread_over) if spread_over else df


def read_json_list(
    spark: SparkSession, *paths: str, field: str, schema: T.StructType | None = None, one_per_line: bool = False
) -> DataFrame:
    """Rows of the array ``field`` inside JSON documents, one document per file or per line."""
    reader = spark.read.option("multiLine", not one_per_line)
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(field, T.ArrayType(schema))]))
    return reader.json(list(paths)).select(F.inline(field))


def month_units(kinds: Iterable[str], start: date, end: date) -> list[tuple[str, date]]:
    """(kind, first of month) for every month that begins before ``end``, starting with the month of ``start``."""
    units, month = [], start.replace(day=1)
    while month < end:
        units += [(kind, month) for kind in kinds]
        month = next_month(month)
    return units


def read_units(
    spark: SparkSession,
    units: Iterable[tuple[str, date]],
    path_of: Callable[[str, date], str],
    index: str | None = None,
    time_columns: Sequence[str] = (),
    between: tuple[datetime, datetime] | None = None,
) -> tuple[DataFrame | None, list[tuple[str, date]]]:
    """Read the files of all units at once; returns the rows and the units that had no file.

    Files are grouped by their own schema, so a column that only some files of a folder have is kept; files that share a
    schema become one multi-path scan, so the plan has one branch per distinct schema (a handful) and not one per file.
    Columns missing from a branch are NULL and a column that is integer in one branch and double in another widens.

    With ``index`` (a folder) what the footers say is kept, and only those of new files are read. ``between`` then leaves
    out files whose range of a time column lies outside; rows of other files are not filtered.
    """
    files, missing = unit_files(spark, units, path_of, index, time_columns, between)
    return read_unit_files(spark, files), missing


class UnitFile(NamedTuple):
    """A data file of a unit, its schema as text, its rows as the footer states them, and whether it may hold rows of the
    interval asked for."""

    unit: tuple[str, date]
    path: str
    schema: str
    n_rows: int
    wanted: bool


def unit_files(
    spark: SparkSession, units: Iterable[tuple[str, date]], path_of: Callable[[str, date], str], index: str | None = None,
    time_columns: Sequence[str] = (), between: tuple[datetime, datetime] | None = None,
) -> tuple[list[UnitFile], list[tuple[str, date]]]:
    """The data files of all units and the units that had no file; one distributed job reads the footers not indexed yet."""
    unit_at, paths, missing = {}, [], []
    for unit in units:
        path = path_of(*unit)
        places = _places(spark, path)
        unit_at.update(dict.fromkeys(map(_plain, places), unit))
        if places:
            paths.append(path)
        else:
            missing.append(unit)
    if not paths:
        return [], missing
    if index is None:
        known = file_index.footers(file_index.listed_files(spark, paths), time_columns)
    else:
        known = file_index.refresh(spark, index, paths, time_columns).files
    wanted = F.lit(True)
    for column in time_columns if between else ():
        wanted = wanted & file_index.may_hold(column, *between)
    files = []
    # a row per file, as the scan's own file listing has
    for row in known.select("path", "schema", "n_rows", wanted.alias("wanted")).collect():
        place = _plain(row["path"])
        while place and place not in unit_at:
            place = place.rpartition("/")[0]
        files.append(UnitFile(unit_at[place], row["path"], row["schema"], row["n_rows"], row["wanted"]))
    return files, missing


def read_unit_files(spark: SparkSession, files: Iterable[UnitFile], file_column: str | None = None) -> DataFrame | None:
    """The rows of the wanted files, one scan per distinct schema, with the file each came from as ``file_column``; None
    without files."""
    groups: dict[str, list[str]] = {}
    for file in files:
        if file.wanted:
            groups.setdefault(file.schema, []).append(file.path)
    return file_index.scans(spark, [(schema, sorted(groups[schema])) for schema in sorted(groups)], file_column)


def _plain(path: str) -> str:
    """A path in one form: unquoted, a local one with a single slash."""
    return re.sub("^file:/+", "file:/", unquote(path))


def _places(spark: SparkSession, path: str) -> list[str]:
    """Files and folders that a path or glob stands for; asks the file system alone and starts no job."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [f.getPath().toString() for f in found or []]


def first_rows(df: DataFrame, n: int | None = None) -> DataFrame:
    """At most ``n`` rows for looking at a feed while developing; everything by default."""
    return df if n is None else df.limit(n)


def profile(df: DataFrame) -> DataFrame:
    """(column_name, column_type, row_count, null_count) from a single pass over the table."""
    one = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.array(*[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                F.count_if(F.col(f"`{f.name}`").isNull()).alias("null_count"),
            )
            for f in df.schema.fields
        ]).alias("columns"),
    )
    return one.select("row_count", F.inline("columns")).select(
        "column_name", "column_type", "row_count", "null_count"
    )
