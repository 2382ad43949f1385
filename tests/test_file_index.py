"""The stored footer index and the scans made from it."""

import os
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from farebox import sources
from farebox.sources import file_index, files


def _scans(plan):
    return plan[:plan.index("\n(1)")].count("Scan parquet")


def _month(spark, path, first, n=20, columns="id, ts", parts=4):
    df = spark.range(n).select("id", (F.lit(first).cast("timestamp_ntz") + F.expr("make_dt_interval(cast(id as int))")).alias("ts"))
    df = df.withColumn("note", F.lit("n")) if "note" in columns else df
    df.repartition(parts).write.mode("append").parquet(path)


@pytest.mark.parametrize("second, scans", [("id, ts", 1), ("id, ts, note", 2)])
def test_one_scan_per_schema(spark, tmp_path, plan_of, second, scans):
    """Six months of four equal files are one scan; a second schema among them makes a second."""
    units = sources.month_units(["y"], date(2024, 1, 1), date(2024, 7, 1))
    for _, month in units:
        _month(spark, f"file:{tmp_path}/y-{month:%m}", str(month), columns=second if month.month == 3 else "id, ts")
    path_of = lambda kind, m: f"file:{tmp_path}/{kind}-{m:%m}"
    for index in (None, f"file:{tmp_path}/index"):
        found, missing = files.unit_files(spark, units, path_of, index)
        assert missing == [] and len({f.schema for f in found}) == scans
        got, _ = sources.read_units(spark, units, path_of, index)
        assert got.count() == 120 and _scans(plan_of(got)) == scans


def test_footers_are_read_once(spark, tmp_path, monkeypatch):
    """A second refresh reads none; a new file, and one that was replaced, are read, and gone ones are left out."""
    root, index = f"file:{tmp_path}/in", f"file:{tmp_path}/index"
    _month(spark, root, "2024-01-01")
    first = file_index.refresh(spark, index, [root], ["ts"])
    assert first.footers_read == 4 and first.files.agg(F.sum("n_rows")).first()[0] == 20
    assert file_index.refresh(spark, index, [root], ["ts"]).footers_read == 0
    _month(spark, root, "2024-02-01", parts=1)
    again = file_index.refresh(spark, index, [root], ["ts"])
    assert again.footers_read == 1 and again.files.count() == 5
    paths = sorted(p for p in (tmp_path / "in").iterdir() if p.suffix == ".parquet")
    pq.write_table(pa.table({"id": pa.array([1], pa.int64())}), paths[0])
    (tmp_path / "in" / f".{paths[0].name}.crc").unlink(missing_ok=True)
    os.utime(paths[0], (1_800_000_000,) * 2)
    paths[1].unlink()
    last = file_index.refresh(spark, index, [root], ["ts"])
    assert last.footers_read == 1 and last.files.count() == 4
    assert last.files.where(F.col("path").endswith(paths[0].name)).first().n_rows == 1
    # the index alone answers: no footer job is made for files it knows
    monkeypatch.setattr(file_index, "_range", lambda *a: 1 / 0)
    assert file_index.refresh(spark, index, [root], ["ts"]).footers_read == 0


def test_files_outside_an_interval_are_not_opened(spark, tmp_path):
    units = sources.month_units(["y"], date(2024, 1, 1), date(2024, 7, 1))
    for _, month in units:
        _month(spark, f"file:{tmp_path}/y-{month:%m}", str(month), n=28, parts=2)
    path_of = lambda kind, m: f"file:{tmp_path}/{kind}-{m:%m}"
    between = (datetime(2024, 3, 1), datetime(2024, 4, 2))
    got, _ = sources.read_units(spark, units, path_of, f"file:{tmp_path}/index", ["ts"], between)
    opened = {f.split("/")[-2] for f in got.inputFiles()}
    assert opened == {"y-03", "y-04"} and len(got.inputFiles()) <= 4
    inside = (F.col("ts") >= F.lit("2024-03-01")) & (F.col("ts") < F.lit("2024-04-02"))
    assert got.where(inside).count() == 29
    # without an interval, or without a range for the column, every file is read
    assert len(sources.read_units(spark, units, path_of, f"file:{tmp_path}/index")[0].inputFiles()) == 12
    assert len(sources.read_units(spark, units, path_of, None, ["other"], between)[0].inputFiles()) == 12


def test_ranges_of_all_kinds(spark, tmp_path):
    """Numbers, reals, texts, days and times; a column of NULLs or without statistics has no range and excludes nothing."""
    df = spark.sql("""select * from values (1L, 0.5D, 'b', date '2024-01-05', timestamp_ntz '2024-01-05 10:00:00', cast(null as int)),
        (7L, 2.5D, 'f', date '2024-02-05', timestamp_ntz '2024-02-05 10:00:00', null) as t(n, r, t, d, ts, nothing)""")
    df.coalesce(1).write.parquet(f"file:{tmp_path}/in")
    known = file_index.footers(file_index.listed_files(spark, [f"file:{tmp_path}/in"]), ["n", "r", "t", "d", "ts", "nothing", "missing"])

    def holds(*condition):
        return known.where(file_index.may_hold(*condition)).count() == 1

    assert {r.column for r in known.first().ranges} == {"n", "r", "t", "d", "ts"}
    assert holds("n", 7, 9) and holds("n", 0, 2) and not holds("n", 8, 9) and not holds("n", 0, 1) and holds("n", 0, 1, True)
    assert holds("r", 2.5, 3.0) and not holds("r", 2.6, None) and not holds("r", None, 0.5)
    assert holds("t", "a", "c") and not holds("t", "g", "z")
    assert holds("d", date(2024, 2, 5), date(2024, 2, 6)) and not holds("d", date(2024, 2, 6), None)
    assert holds("ts", datetime(2024, 1, 1), datetime(2024, 1, 6)) and not holds("ts", datetime(2024, 2, 6), None)
    assert holds("nothing", 1, 2) and holds("missing", 1, 2)


def test_schema_text_is_canonical(spark, tmp_path):
    """The same columns written by two libraries are one scan; a schema Spark has to infer is a group of its own."""
    spark.sql("select 1L as a, 'x' as b, timestamp_ntz '2024-01-01 00:00:00' as c").write.parquet(f"file:{tmp_path}/in")
    table = pa.table({"a": pa.array([2], pa.int64()), "b": pa.array(["y"]).dictionary_encode(), "c": pa.array([datetime(2024, 1, 2)], pa.timestamp("us"))})
    pq.write_table(table, tmp_path / "in" / "own.parquet")
    pq.write_table(pa.table({"a": pa.array([3], pa.uint16()), "b": pa.array(["z"], pa.large_string())}), tmp_path / "in" / "small.parquet")
    known = file_index.footers(file_index.listed_files(spark, [f"file:{tmp_path}/in"]))
    assert known.select("schema").distinct().count() == 2
    got = file_index.read_indexed(spark, known)
    assert rows(got.select("a", "b", "c")) == [(1, "x", datetime(2024, 1, 1)), (2, "y", datetime(2024, 1, 2)), (3, "z", None)]
    assert file_index.read_indexed(spark, known.limit(0)) is None
