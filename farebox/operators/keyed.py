"""Keyed tables for many small changes: a base of day partitions, and deltas that are only appended.

A change writes its rows to a delta of its own, numbered by (run, batch); writing a batch again replaces its delta. Readers
use the table's name, a view: the latest delta row of each key, and the base rows whose key no delta has. So a change costs
what it holds, whatever the size of the days it falls in. Compaction puts the deltas' rows into the base days they touch and
switches base and deltas over in one metadata action; a batch that is written again after that changes nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.operators.layout import DAY
from farebox.operators.tables import table_ddl
from farebox.operators.versions import in_force, properties, publish, stage, stage_partitions

RUN, BATCH, GONE = "_run", "_batch", "_gone"
# Deltas that may pile up before a stream folds them into the base.
COMPACT_AFTER = 50


def deltas_of(name: str) -> str:
    return f"{name}__deltas"


def create_keyed(
    spark: SparkSession, name: str, schema: T.StructType, keys: list[str], path: str | None = None, day: str = DAY
) -> None:
    """An empty keyed table, unless it exists. ``schema`` has the column ``day``, which the keys determine."""
    if spark.catalog.tableExists(name):
        return
    deltas = T.StructType([
        *[f for f in schema.fields if f.name != day], schema[day], T.StructField(GONE, T.BooleanType()),
        T.StructField(RUN, T.IntegerType()), T.StructField(BATCH, T.LongType())])
    spark.sql(table_ddl(deltas_of(name), deltas, f"{path.rstrip('/')}/deltas" if path else None, [RUN, BATCH]))
    base = stage(spark.createDataFrame([], schema), name, [day], f"{path.rstrip('/')}/base" if path else None)
    _publish(spark, base, keys, (-1, -1))


def _publish(spark: SparkSession, base, keys: list[str], folded: tuple[int, int], noted: dict[str, str] | None = None) -> None:
    columns = ", ".join(f"`{c}`" for c in spark.table(base.table).columns)
    key_list = ", ".join(f"`{k}`" for k in keys)
    same = " AND ".join(f"d.`{k}` <=> b.`{k}`" for k in keys)
    latest = f"""SELECT {columns}, {GONE} FROM (
        SELECT *, row_number() OVER (PARTITION BY {key_list} ORDER BY {RUN} DESC, {BATCH} DESC) AS _turn
        FROM {deltas_of(base.name)} WHERE {RUN} > {folded[0]} OR ({RUN} = {folded[0]} AND {BATCH} > {folded[1]})) WHERE _turn = 1"""
    select = f"""SELECT {columns} FROM {base.table} b WHERE NOT EXISTS (SELECT 1 FROM ({latest}) d WHERE {same})
        UNION ALL SELECT {columns} FROM ({latest}) WHERE NOT {GONE}"""
    publish(base, spark, select, {"keys": ",".join(keys), "folded": f"{folded[0]}:{folded[1]}", **(noted or {})})


def keys_of(spark: SparkSession, name: str) -> list[str]:
    noted = properties(spark, name)
    if "keys" not in noted:
        raise ValueError(f"{name} is no keyed table")
    return noted["keys"].split(",")


def _folded(spark: SparkSession, name: str) -> tuple[int, int]:
    run, batch = properties(spark, name)["folded"].split(":")
    return int(run), int(batch)


def stored_deltas(spark: SparkSession, name: str) -> list[tuple[int, int]]:
    """(run, batch) of the deltas that are stored, in order; from the catalog alone."""
    rows = spark.sql(f"SHOW PARTITIONS {deltas_of(name)}").collect()
    return sorted(tuple(int(part.split("=")[1]) for part in r[0].split("/")) for r in rows)


def run_number(spark: SparkSession, name: str, label: str) -> int:
    """The number of a run (a stream's checkpoint, a batch job's name): the same for the same label, and greater than all
    others' for a new one, so that what it writes counts as later."""
    keys_of(spark, name)
    key = f"run.{hashlib.md5(label.encode()).hexdigest()}"
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {deltas_of(name)}").collect()}
    if key not in known:
        known[key] = str(1 + max((int(v) for k, v in known.items() if k.startswith("run.")), default=-1))
        spark.sql(f"ALTER TABLE {deltas_of(name)} SET TBLPROPERTIES ('{key}' = '{known[key]}')")
    return int(known[key])


def put_delta(rows: DataFrame, name: str, run: int, batch: int, order: str | None = None) -> None:
    """Store the rows as the delta (run, batch); a key's latest row, by delta, is the one the table shows.

    With ``order`` the latest of several rows of a key wins; without it the rows have to hold a key once. A boolean column
    ``_gone`` marks keys that the table is to show no longer. Repeating a delta replaces it.
    """
    spark = rows.sparkSession
    columns = spark.table(deltas_of(name)).columns
    if order:
        turn = F.row_number().over(Window.partitionBy(*keys_of(spark, name)).orderBy(F.col(order).desc_nulls_last()))
        rows = rows.withColumn("_turn", turn).where("_turn = 1").drop("_turn")
    gone = F.coalesce(F.col(GONE), F.lit(False)) if GONE in rows.columns else F.lit(False)
    numbered = rows.withColumns({GONE: gone, RUN: F.lit(run), BATCH: F.lit(batch).cast("long")}).select(*columns)
    # as few files as the rows fill; one statement, which also tells the catalog of the new partition
    numbered.hint("rebalance").write.option("partitionOverwriteMode", "dynamic").insertInto(deltas_of(name), overwrite=True)


def compact(spark: SparkSession, name: str, day: str = DAY) -> int:
    """Fold the stored deltas into the days of the base that they touch; returns how many there were.

    Readers see the same rows before, while and after. Folded deltas stay until the next compaction, for readers that
    have begun.
    """
    folded, stored = _folded(spark, name), stored_deltas(spark, name)
    open_ = [d for d in stored if d > folded]
    if not open_:
        return 0
    noted = properties(spark, name)
    since = spark.table(deltas_of(name)).where(
        (F.col(RUN) > folded[0]) | ((F.col(RUN) == folded[0]) & (F.col(BATCH) > folded[1])))
    days = since.agg(F.collect_set(day).alias("all")).scalar()
    touched = spark.table(name).where(F.array_contains(days, F.col(day)) | F.col(day).isNull())
    # days that end without a row: those a delta touches whose rows are all gone
    dates = {None if r[0] is None else str(r[0]) for r in since.select(day).distinct().collect()} | {None}
    base = stage_partitions(touched.hint("rebalance", F.col(day)), name, lambda values: values[day] in dates)
    _publish(spark, base, noted["keys"].split(","), open_[-1], {"folded_before": f"{folded[0]}:{folded[1]}"})
    _drop_deltas(spark, name, [d for d in stored if d <= folded])
    return len(open_)


def _drop_deltas(spark: SparkSession, name: str, deltas: list[tuple[int, int]]) -> None:
    """Drop deltas in one statement, their files too where the table has a folder of its own."""
    if not deltas:
        return
    location = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {deltas_of(name)}").collect() if r["col_name"] == "Location")
    spark.sql(f"ALTER TABLE {deltas_of(name)} DROP IF EXISTS " + ", ".join(
        f"PARTITION ({RUN} = {run}, {BATCH} = {batch})" for run, batch in deltas))
    for run, batch in deltas:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{location}/{RUN}={run}/{BATCH}={batch}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def base_table(spark: SparkSession, name: str) -> str:
    """The table that holds the base's rows, without deltas."""
    return in_force(spark, name).table
