"""Month files merged by hashed id: what is inserted, what is moved and what is kept beside the table."""

import hashlib
import re
from datetime import date

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from farebox.operators import tables
from farebox.plans import month_files
from farebox.schemas import YELLOW_CSV
from workloads import feeds

OLD = [
    "1,2024-01-01 10:00:00,2024-01-01 10:10:00,1,2.5,,N,10,20,1,10.0,0.5,0.5,1.0,0.0,0.3,12.3,0.0",
    "2,2024-01-01 11:00:00,2024-01-01 11:10:00,1,1.0,,N,11,21,1,1.0E7,0.5,0.5,1.0,0.0,0.3,9.3,0.0",
    "2,,2024-01-01 11:10:00,1,1.0,,N,11,21,1,8.0,0.5,0.5,1.0,0.0,0.3,9.3,0.0",
]
NEW = [
    "2,2024-01-03 11:00:00,2024-01-03 11:10:00,1,1.0,,N,12,22,1,7.0,0.5,0.5,1.0,0.0,0.3,9.3,0.0",
    "2,2024-01-01 12:00:00,2024-01-01 12:10:00,1,1.0,,N,13,23,1,6.0,0.5,0.5,1.0,0.0,0.3,9.3,0.0",
    "2,2024-01-01 12:00:00,2024-01-01 12:10:00,2,1.0,,N,13,23,1,6.0,0.5,0.5,1.0,0.0,0.3,9.3,0.0",  # the same id
    ",,2024-01-01 11:10:00,1,1.0,,N,,21,1,bad,0.5,0.5,1.0,0.0,0.3,9.3,0.0",  # a cell that can't be read
    "7,2024-01-01 13:00:00,2024-01-01 13:10:00,1",  # a line that ends early
]


def _file(tmp_path, name, lines):
    (tmp_path / name).write_text("\n".join([",".join(YELLOW_CSV.names), *lines]) + "\n")
    return f"file:{tmp_path}/{name}"


@pytest.fixture
def kept(monkeypatch, spark, tmp_path):
    """Schemas and row counts of what merges kept in the shared folder."""
    seen = []

    def path(_, name):
        seen.append(f"file:{tmp_path}/kept-{len(seen)}-{name}")
        return seen[-1]

    for module in (tables, month_files):
        monkeypatch.setattr(module, "scratch_path", path, raising=False)
    return lambda: [(spark.read.parquet(p).columns, spark.read.parquet(p).count()) for p in seen]


def test_merge_moves_rows_once_and_without_their_id(spark, database, tmp_path, monkeypatch, plan_of, kept):
    path, name, written = _file(tmp_path, "old.csv", OLD), f"{database}.yellow", []
    insert = DataFrameWriter.insertInto
    monkeypatch.setattr(DataFrameWriter, "insertInto", lambda self, *a: written.append(self._df) or insert(self, *a))
    for _ in range(3):
        month_files.merge_month_file(spark, name, "yellow", path, "old.csv")
    assert spark.table(name).count() == len(OLD)
    assert len(written) == 1  # a file whose ids are all held appends nothing
    moved = re.findall(r"\) Exchange\n(.*)\n", plan_of(written[0]))
    assert len(moved) == 1 and "fare_amount" in moved[0] and "unique_row_id" not in moved[0] and "filename" not in moved[0]
    # no row of the file is kept a second time: days, and ids that are not held
    assert {columns[0] for columns, _ in kept()} == {"day", "_id"} and all(len(columns) == 1 for columns, _ in kept())
    assert [n for columns, n in kept() if columns == ["_id"]] == [0, 0]


def test_merge_inserts_what_an_anti_join_would(spark, database, tmp_path):
    old, new = _file(tmp_path, "old.csv", OLD), _file(tmp_path, "new.csv", [*OLD, *NEW])
    name = f"{database}.yellow"
    month_files.merge_month_file(spark, name, "yellow", old, "old.csv")
    staged = month_files.staged_file(spark, "yellow", new, "new.csv")
    expected = rows(spark.table(name).select(*staged.columns)) + rows(tables.rows_to_insert(spark.table(name), staged, "unique_row_id"))
    assert len(expected) == len(OLD) + len(NEW)
    for _ in range(2):
        month_files.merge_month_file(spark, name, "yellow", new, "new.csv")
        assert rows(spark.table(name).select(*staged.columns)) == sorted(expected, key=repr)
    # days that the table has no row of need no comparison
    later = _file(tmp_path, "later.csv", [NEW[0].replace("2024-01-03", "2024-02-03")] * 2)
    for _ in range(2):
        month_files.merge_month_file(spark, name, "yellow", later, "later.csv")
        assert spark.table(name).where("filename = 'later.csv'").count() == 2


@pytest.mark.parametrize("buckets", (0, 2))
@pytest.mark.parametrize("kind", ("string", "binary"))
def test_ids_of_any_text_are_compared(spark, database, kind, buckets):
    digest = hashlib.md5(b"x").hexdigest()
    spelt = bytes.fromhex("61" * 16).decode()
    ids = [digest, digest.upper(), digest + "\n", digest[:-1] + "\n", digest[:-1], "61" * 16, spelt, spelt[:-1], "", "\0" * 17, "\0" * 16, None, "a", "é"]
    schema, name = "id string, v int, day date", f"{database}.t"

    def part(chosen):
        frame = spark.createDataFrame([(i, n, date(2024, 1, 1)) for n, i in enumerate(ids) if chosen(n)], schema)
        return frame.withColumn("id", F.col("id").cast(kind))

    for chosen in (lambda n: n % 2, lambda n: n % 3, lambda n: True):
        if not spark.catalog.tableExists(name):
            if buckets:
                tables.create_bucketed(spark, name, part(chosen).schema, "id", buckets)
            else:
                tables.create_if_missing(spark, name, part(chosen).schema, partition_by=["day"])
        given = part(chosen).withColumnRenamed("id", "key")
        expected = rows(spark.table(name)) + rows(tables.rows_to_insert(spark.table(name), part(chosen), "id"))
        tables.merge_files_into_table(spark, name, given, "id", {"id": F.col("key")}, within="day")
        assert rows(spark.table(name)) == sorted(expected, key=repr)


def test_columns_that_rows_are_dealt_by_are_made_first(spark, database):
    name, rows_in = f"{database}.t", spark.sql("select 1 as v, timestamp_ntz '2024-01-01 10:00:00' as at")
    tables.create_if_missing(spark, name, spark.sql("select 1 as v, now()::timestamp_ntz as at, '' as id, current_date() as day").schema, partition_by=["day"])
    tables.append_rows(rows_in, name, {"day": F.col("at").cast("date"), "id": F.md5(F.col("at").cast("string"))})
    assert rows(spark.table(name).select("v", "day", "id")) == [
        (1, date(2024, 1, 1), hashlib.md5(b"2024-01-01 10:00:00").hexdigest())]


def test_customers_are_joined_to_orders_and_not_to_lines(spark, plan_of):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = plan_of(feeds.feed(spark, SF_SMALL, ["pickup", "do", "fare"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = re.findall(r"\) Exchange\n(Input.*)\nArguments: hashpartitioning\((\w+)", plan)
    assert sorted(key for _, key in moved) == ["c_custkey", "l_orderkey", "o_custkey", "o_orderkey"]
    assert not any("l_" in columns for columns, key in moved if key == "o_custkey")
