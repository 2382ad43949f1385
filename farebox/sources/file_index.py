"""A stored index of Parquet files: what their footers say, kept so that no footer is read twice.

One row per file: where it is, how long and how old, its schema as Spark would read it, its rows, and the range of each
column asked for. One distributed job per refresh reads the footers of new or changed files only. What a read needs to
know about its files (which of them hold an interval, which share a schema, how many rows they have) comes from the index.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterable, Iterator, Sequence
from datetime import date, datetime
from typing import NamedTuple
from urllib.parse import unquote

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# tasks receive this module's functions by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RANGE = "column string, least long, most long, least_real double, most_real double, least_text string, most_text string"
SCHEMA = f"path string, length long, modified timestamp, schema string, n_rows long, ranges array<struct<{_RANGE.replace(' ', ':').replace(',:', ',')}>>"
# Where Spark keeps its own schema in the files it writes, and the mark of a schema that has to be inferred by Spark.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
INFERRED = "arrow:"


def listed_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """``path``, ``length``, ``modified`` of the Parquet files below paths that exist; opens none of them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(paths))
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def _spark_schema(parquet) -> str:
    """The schema of an open Parquet file as Spark's JSON, all columns nullable; columns of one name and type always give
    one text, whoever wrote the file."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_type

    def nullable(data_type: T.DataType) -> T.DataType:
        if isinstance(data_type, T.StructType):
            return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in data_type.fields])
        if isinstance(data_type, T.ArrayType):
            return T.ArrayType(nullable(data_type.elementType), True)
        if isinstance(data_type, T.MapType):
            return T.MapType(nullable(data_type.keyType), nullable(data_type.valueType), True)
        return data_type

    own = (parquet.metadata.metadata or {}).get(_SPARK_SCHEMA)
    if own is not None:
        return nullable(T.StructType.fromJson(json.loads(own))).json()
    # unsigned numbers are read into the next larger signed type
    wider = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64(), pa.uint64(): pa.decimal128(20, 0)}
    legacy = {parquet.schema.column(i).path for i in range(len(parquet.schema)) if parquet.schema.column(i).physical_type == "INT96"}
    arrow = parquet.schema_arrow.remove_metadata()
    try:
        fields = []
        for field in arrow:
            kind = field.type.value_type if pa.types.is_dictionary(field.type) else field.type
            if field.name in legacy:
                fields.append(T.StructField(field.name, T.TimestampType()))
            else:
                fields.append(T.StructField(field.name, nullable(from_arrow_type(wider.get(kind, kind), prefer_timestamp_ntz=True))))
        return T.StructType(fields).json()
    except Exception:  # a type only Spark's reader knows: files of this very schema are grouped, Spark infers it
        return INFERRED + "; ".join(f"{f.name} {f.type}" for f in arrow)


def _range(parquet, column: str) -> dict | None:
    """Least and most value of a column from the statistics of all row groups; None if any lacks them or the file has no
    such column. Times are microseconds, days count as their midnight."""
    places = [i for i in range(len(parquet.schema)) if parquet.schema.column(i).path == column]
    # the statistics of the oldest kind of timestamps are in no order
    if not places or parquet.schema.column(places[0]).physical_type == "INT96":
        return None
    least = most = None
    for group in range(parquet.metadata.num_row_groups):
        part = parquet.metadata.row_group(group).column(places[0])
        stats = part.statistics
        if part.num_values == 0 or (stats is not None and stats.null_count == part.num_values):
            continue
        if stats is None or not stats.has_min_max:
            return None
        least = stats.min if least is None else min(least, stats.min)
        most = stats.max if most is None else max(most, stats.max)
    if least is None:
        return None
    if isinstance(least, (date, datetime)):
        least, most = as_micros(least), as_micros(most)
    out = dict.fromkeys(["least", "most", "least_real", "most_real", "least_text", "most_text"])
    kind = "" if isinstance(least, int) else "_real" if isinstance(least, float) else "_text" if isinstance(least, str) else None
    if kind is None:
        return None
    return {"column": column, **out, f"least{kind}": least, f"most{kind}": most}


def as_micros(moment: date | datetime) -> int:
    """Microseconds since 1970 of a wall-clock time (a UTC one if it has a zone)."""
    if not isinstance(moment, datetime):
        moment = datetime(moment.year, moment.month, moment.day)
    since = moment - datetime(1970, 1, 1, tzinfo=moment.tzinfo)
    return (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds


def footers(files: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """``files`` (``path``, ``length``, ``modified``) with ``schema``, ``n_rows`` and ``ranges`` from each file's footer."""
    columns = list(columns)

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        def of_file(path):
            local = path.startswith("file:")
            system, place = (fs.LocalFileSystem(), unquote(path[5:])) if local else fs.FileSystem.from_uri(path)
            with system.open_input_file(re.sub("^//+", "/", place)) as file:
                parquet = pq.ParquetFile(file)
                found = [_range(parquet, c) for c in columns]
                return _spark_schema(parquet), parquet.metadata.num_rows, [r for r in found if r]

        for batch in batches:
            read_ = [of_file(path) for path in batch.column(0).to_pylist()]
            kinds = {"column": pa.string(), "least": pa.int64(), "most": pa.int64(), "least_real": pa.float64(),
                     "most_real": pa.float64(), "least_text": pa.string(), "most_text": pa.string()}
            ranges = pa.list_(pa.struct(list(kinds.items())))
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([r[0] for r in read_], pa.string()), pa.array([r[1] for r in read_], pa.int64()),
                pa.array([r[2] for r in read_], ranges),
            ], names=["path", "length", "modified", "schema", "n_rows", "ranges"])

    return files.select("path", "length", "modified").mapInArrow(read, SCHEMA)


class Refreshed(NamedTuple):
    """The index rows of the files asked for, and how many footers had to be read for them."""

    files: DataFrame
    footers_read: int


def refresh(spark: SparkSession, index: str, paths: Iterable[str], columns: Sequence[str] = ()) -> Refreshed:
    """Bring the index in folder ``index`` up to date for the files below ``paths`` and return their rows.

    A file is known by path, length and modification time, so one that was replaced is read again; rows of files that are
    gone stay in the index and are not returned. ``columns`` are those to keep the range of; a file that was indexed
    without one of them counts as having no range for it. One writer at a time; a run that dies leaves what was appended
    before, and the next one reads the rest.
    """
    present = listed_files(spark, paths)
    known = _stored(spark, index)
    same = ["path", "length", "modified"]
    new = present if known is None else present.join(known.select(*same), same, "left_anti")
    before = 0 if known is None else known.count()
    footers(new, columns).write.mode("append").parquet(index)
    known = _stored(spark, index)
    return Refreshed(known.join(present, same, "left_semi").dropDuplicates(same), known.count() - before)


def _stored(spark: SparkSession, index: str) -> DataFrame | None:
    place = spark._jvm.org.apache.hadoop.fs.Path(index)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema(SCHEMA).parquet(index)


def may_hold(column: str, low, high, closed: bool = False) -> Column:
    """Condition on index rows: the file may hold values of ``column`` in [low, high), or [low, high] if ``closed``; a bound
    of None is open. Files without a range for the column are kept: nothing is known about them."""
    kind = ""
    if isinstance(low if low is not None else high, (date, datetime)):
        low, high = (None if x is None else as_micros(x) for x in (low, high))
    elif isinstance(low if low is not None else high, float):
        kind = "_real"
    elif isinstance(low if low is not None else high, str):
        kind = "_text"

    def apart(r: Column) -> Column:
        beyond = F.lit(False)
        if low is not None:
            beyond = beyond | F.coalesce(r[f"most{kind}"] < F.lit(low), F.lit(False))
        if high is not None:
            after = r[f"least{kind}"] > F.lit(high) if closed else r[f"least{kind}"] >= F.lit(high)
            beyond = beyond | F.coalesce(after, F.lit(False))
        return beyond

    return ~F.exists("ranges", lambda r: (r["column"] == column) & apart(r))


def read_indexed(spark: SparkSession, files: DataFrame) -> DataFrame | None:
    """The rows of the indexed files, one scan per distinct schema; None without files.

    Columns missing from a branch are NULL, and a column that is integer in one and double in another widens. The paths,
    which a scan lists anyway, are all that comes to the driver, and no footer is read here.
    """
    groups = files.groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("schema").collect()
    return scans(spark, [(g["schema"], g["paths"]) for g in groups])


def scans(spark: SparkSession, groups: Sequence[tuple[str, Sequence[str]]], file_column: str | None = None) -> DataFrame | None:
    """One scan per (schema, paths), put together by column name; ``file_column`` adds where each row came from."""
    out = None
    for schema, paths in groups:
        own = spark.read.parquet(paths[0]).schema if schema.startswith(INFERRED) else T.StructType.fromJson(json.loads(schema))
        frame = spark.read.schema(own).parquet(*paths)
        if file_column:
            frame = frame.select("*", F.col("_metadata.file_path").alias(file_column))
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out
