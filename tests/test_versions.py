"""Published tables, keyed tables, and what readers see when a writer stops in the middle."""

from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from farebox.operators import keyed, layout, tables, versions
from farebox.sources import file_index


REAL_SQL, REAL_WRITE = SparkSession.sql, versions._write


class Lost(RuntimeError):
    pass


def _days(spark, *items):
    return spark.createDataFrame([(k, v, None if d is None else date(2024, 1, d)) for k, v, d in items], "k int, v int, day date")


def _steps_of(monkeypatch, run, look):
    """Run ``run`` again and again, each time dying one step later (before a statement, behind a write), and look after each."""
    seen = []
    for last in range(1, 60):
        left = [last]

        def step(left=left):
            left[0] -= 1
            if left[0] == 0:
                raise Lost("stopped")

        def sql(self, text, *a, **k):
            step()
            return REAL_SQL(self, text, *a, **k)

        def write(*a):
            version = REAL_WRITE(*a)
            step()
            return version

        with monkeypatch.context() as m:
            m.setattr(SparkSession, "sql", sql)
            m.setattr(versions, "_write", write)
            try:
                run()
                done = True
            except Lost:
                done = False
        seen.append(look())
        if done:
            return seen
    raise AssertionError("never done")


def test_all_days_switch_at_once(spark, database, monkeypatch):
    """Stopped between any two steps, a replacement of many days shows all old days or all new ones, never a mixture."""
    name = f"{database}.trips"
    old = [(i, 0, 1 + i % 9) for i in range(30)] + [(99, 0, None)]
    tables.replace_table(_days(spark, *old), name, partition_by=["day"])
    fresh = [(i, 1, 3 + i % 5) for i in range(20)]
    new = _days(spark, *fresh).withColumn("ts", F.col("day").cast("timestamp_ntz"))
    wanted = sorted([r for r in old if r[2] is None or not 3 <= r[2] <= 8] + fresh, key=repr)

    def run():
        version = versions.stage_partitions(new.drop("ts"), name, lambda v: v["day"] is not None and "2024-01-03" <= v["day"] <= "2024-01-08")
        versions.publish(version, spark)

    def look():
        return sorted(((r.k, r.v, r.day and r.day.day) for r in spark.table(name).collect()), key=repr)

    seen = _steps_of(monkeypatch, run, look)
    assert len(seen) > 5 and seen[-1] == wanted
    assert all(s in (sorted(old, key=repr), wanted) for s in seen)
    assert seen[0] == sorted(old, key=repr)


def test_a_reader_beside_the_switch_sees_one_version(spark, database):
    """Queries planned before the switch read the former files, also after one more replacement has been published."""
    name = f"{database}.trips"
    tables.replace_table(_days(spark, (1, 0, 1), (2, 0, 2)), name, partition_by=["day"])
    begun = spark.table(name)
    files = begun.inputFiles()
    tables.upsert_into_table(spark, name, _days(spark, (1, 1, 1), (2, 1, 2)), ["k"])
    assert rows(spark.read.parquet(*files).select("v")) == [(0,), (0,)] and rows(spark.table(name).select("v")) == [(1,), (1,)]


def test_no_statement_is_made_per_day(spark, database, monkeypatch):
    name = f"{database}.trips"
    counts = []
    for days in (2, 25):
        tables.replace_table(_days(spark, *[(i, 0, 1 + i) for i in range(days)]), name, partition_by=["day"])
        made = []
        with monkeypatch.context() as m:
            m.setattr(SparkSession, "sql", lambda self, text, *a, **k: made.append(text) or REAL_SQL(self, text, *a, **k))
            tables.upsert_into_table(spark, name, _days(spark, *[(i, 1, 1 + i) for i in range(days)]), ["k"])
        counts.append(len(made))
        assert spark.table(name).where("v = 1").count() == days
    assert counts[1] <= counts[0] + 2  # the second table has an older version to drop


def test_old_folders_go(spark, database):
    """Beside the version in force the one before it is kept, nothing else."""
    name = f"{database}.trips"
    tables.replace_table(_days(spark, (1, 0, 1), (2, 0, 2), (3, 0, None)), name, partition_by=["day"])
    for turn in range(1, 5):
        tables.upsert_into_table(spark, name, _days(spark, (1, turn, 1)), ["k"])
        assert rows(spark.table(name).select("k", "v")) == [(1, turn), (2, 0), (3, 0)]
    root = Path(versions.in_force(spark, name).root.removeprefix("file:"))
    # an upsert also looks through the rows without a day
    assert len(list(root.glob("version=*/day=*"))) == 2 + 1 + 2
    assert len(list(root.glob("_manifests/*"))) == 2
    made = {r.tableName for r in spark.sql(f"show tables in {database}").collect()}
    assert len(made) == 3
    # an append goes to where a day lies now, and to a day of its own; both stay through a replacement
    tables.append_rows(_days(spark, (6, 6, 2), (7, 7, 9)), name)
    tables.upsert_into_table(spark, name, _days(spark, (1, 9, 1)), ["k"])
    assert rows(spark.table(name).select("k", "v")) == [(1, 9), (2, 0), (3, 0), (6, 6), (7, 7)]


def test_a_failed_replacement_leaves_the_table(spark, database, monkeypatch):
    """A row that cannot be written, an audit that refuses, a stop at any step: the former rows are there."""
    name = f"{database}.t"
    tables.replace_table(spark.createDataFrame([(1, "x")], "a int, b string"), name)
    broken = spark.createDataFrame([("1",), ("no number",)], "c string").select(F.col("c").cast("int").alias("a"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.replace_table(broken, name)
    assert rows(spark.table(name)) == [(1, "x")]

    def refuse(written):
        assert written.count() == 1
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        tables.replace_table(spark.createDataFrame([(2,)], "c int"), name, audit=refuse)
    assert rows(spark.table(name)) == [(1, "x")]
    seen = _steps_of(monkeypatch, lambda: tables.replace_table(spark.createDataFrame([(3,)], "z int"), name), lambda: rows(spark.table(name)))
    assert seen[0] == [(1, "x")] and seen[-1] == [(3,)] and {tuple(s) for s in seen} == {((1, "x"),), ((3,),)}
    # a plain table of the name is taken over
    spark.sql(f"create table {database}.plain using parquet as select 1 as a")
    for v in (2, 3):
        tables.replace_table(spark.createDataFrame([(v,)], "b int"), f"{database}.plain")
        assert rows(spark.table(f"{database}.plain")) == [(v,)]
    with pytest.raises(ValueError, match="no published table"):
        versions.stage_partitions(spark.createDataFrame([(1,)], "b int"), f"{database}.plain")


def test_partition_values_of_all_kinds(spark, database):
    """Several partition columns, with NULLs, slashes and quotes in their values."""
    name = f"{database}.p"
    given = [(1, "a/b", 1), (2, "it's", None), (3, None, 3), (4, "a=b c", 3), (5, "%2F", 4)]
    schema = "v int, kind string, n int"
    tables.replace_table(spark.createDataFrame(given, schema), name, partition_by=["kind", "n"])
    assert rows(spark.table(name)) == sorted(given, key=repr)
    new = [(9, "a/b", 1), (8, None, 3), (7, "new", None)]
    versions.publish(versions.stage_partitions(spark.createDataFrame(new, schema), name, lambda v: v["kind"] == "it's"), spark)
    assert rows(spark.table(name)) == sorted([(4, "a=b c", 3), (5, "%2F", 4), *new], key=repr)


# ---- keyed tables ----

def _keyed(spark, database, n=0):
    name = f"{database}.windows"
    base = spark.range(n).select(
        F.col("id").alias("k"), F.lit(0).alias("v"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("day"))
    keyed.create_keyed(spark, name, base.schema, ["k"])
    if n:
        keyed.put_delta(base, name, keyed.run_number(spark, name, "fill"), 0)
        keyed.compact(spark, name)
    return name


def _change(spark, *items):
    return spark.createDataFrame([(k, v, date(2024, 1, 1 + k % 3), g) for k, v, g in items], "k long, v int, day date, _gone boolean")


def _bytes(root):
    return sum(f.stat().st_size for f in Path(root).rglob("*.parquet"))


def test_a_change_writes_what_it_holds(spark, database, tmp_path):
    """Bytes written follow the changed keys, whatever the size of their days."""
    name = _keyed(spark, database, 60_000)
    root = tmp_path / "db"
    whole = _bytes(root)
    run = keyed.run_number(spark, name, "stream")
    grown = []
    for batch, n in enumerate((10, 2000, 10)):
        before = _bytes(root)
        keyed.put_delta(_change(spark, *[(k, batch + 1, False) for k in range(n)]), name, run, batch)
        grown.append(_bytes(root) - before)
    assert grown[0] < whole / 20 and grown[1] > 3 * grown[0] and grown[2] == pytest.approx(grown[0], rel=0.2)
    got = spark.table(name)
    assert got.count() == 60_000 and got.where("v = 3").count() == 10 and got.where("v = 2").count() == 1990


def test_deltas_replays_and_compaction(spark, database):
    """Later deltas win, also over those of an earlier run; gone keys vanish and may come back; a replay changes nothing,
    before and after compaction; readers see the same rows through it."""
    name = _keyed(spark, database, 9)
    first = keyed.run_number(spark, name, "first")
    batches = [[(0, 1, False), (20, 1, False)], [(0, 2, False), (1, 2, True)], [(20, 3, True), (1, 3, False)]]
    for i, batch in enumerate(batches):
        keyed.put_delta(_change(spark, *batch), name, first, i)
    wanted = sorted([(0, 2), (1, 3)] + [(k, 0) for k in range(2, 9)], key=repr)

    def look():
        return rows(spark.table(name).select("k", "v"))

    assert look() == wanted
    for i in (0, 2):
        keyed.put_delta(_change(spark, *batches[i]), name, first, i)
        assert look() == wanted
    begun = spark.table(name)
    assert keyed.compact(spark, name) == 3 and look() == wanted and rows(begun.select("k", "v")) == wanted
    assert keyed.compact(spark, name) == 0 and look() == wanted
    assert rows(spark.table(keyed.base_table(spark, name)).select("k", "v")) == wanted
    # written again after compaction: the base has it already
    keyed.put_delta(_change(spark, *batches[1]), name, first, 1)
    assert look() == wanted
    second = keyed.run_number(spark, name, "second")
    assert second > first == keyed.run_number(spark, name, "first")
    keyed.put_delta(_change(spark, (0, 7, False), (3, 7, True)), name, second, 0)
    wanted = sorted([(0, 7), (1, 3)] + [(k, 0) for k in range(2, 9) if k != 3], key=repr)
    assert look() == wanted
    keyed.compact(spark, name)
    assert look() == wanted and len(keyed.stored_deltas(spark, name)) == 1
    # a day whose last key is gone is no folder any more
    keyed.put_delta(_change(spark, *[(k, 0, True) for k in (2, 5, 8)]), name, second, 1)
    keyed.compact(spark, name)
    assert {r[0] for r in spark.sql(f"show partitions {keyed.base_table(spark, name)}").collect()} == {"day=2024-01-01", "day=2024-01-02"}


def test_compaction_stopped_anywhere(spark, database, monkeypatch):
    name = _keyed(spark, database, 9)
    run = keyed.run_number(spark, name, "r")
    keyed.put_delta(_change(spark, (0, 5, False), (1, 0, True), (30, 5, False)), name, run, 0)
    wanted = rows(spark.table(name))
    seen = _steps_of(monkeypatch, lambda: keyed.compact(spark, name), lambda: rows(spark.table(name)))
    assert len(seen) > 5 and all(s == wanted for s in seen)


def test_base_is_not_shuffled_for_few_changes(spark, database, plan_of):
    """The keys of small deltas are broadcast against the base, whose days are pruned."""
    name = _keyed(spark, database, 3000)
    keyed.put_delta(_change(spark, (0, 5, False)), name, keyed.run_number(spark, name, "r"), 0)
    plan = plan_of(spark.table(name).where("day = '2024-01-02'"), executed=True)
    assert "BroadcastHashJoin LeftAnti" in plan or ("BroadcastHashJoin" in plan and "LeftAnti" in plan)
    assert "PartitionFilters: [isnotnull(day" in plan


def test_latest_of_a_batch_and_null_keys(spark, database):
    name = f"{database}.w"
    batch = spark.createDataFrame([(None, 1, 1, None), (None, 2, 2, None), (1, 3, 1, date(2024, 1, 1))], "k int, v int, at int, day date")
    keyed.create_keyed(spark, name, batch.drop("at").schema, ["k"])
    for _ in range(2):
        keyed.put_delta(batch, name, keyed.run_number(spark, name, "x"), 0, order="at")
        assert rows(spark.table(name).select("k", "v")) == [(1, 3), (None, 2)]
        keyed.compact(spark, name)
    with pytest.raises(ValueError, match="no keyed table"):
        tables.replace_table(batch, f"{database}.other")
        keyed.keys_of(spark, f"{database}.other")


# ---- bucketed merge ----

@pytest.mark.parametrize("partition_by", [None, ["day"]])
def test_merge_into_buckets_shuffles_no_target_row(spark, database, plan_of, partition_by):
    name = f"{database}.trips"
    source = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("id"), F.col("id").cast("int").alias("v"),
                                      F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("day"))
    tables.create_bucketed(spark, name, source.schema, "id", 6, partition_by)
    tables.merge_into_table(spark, name, source.where("v < 3000"), "id")
    for _ in range(2):
        tables.merge_into_table(spark, name, source, "id")
        assert spark.table(name).count() == 4000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(tables.rows_for_table(spark, name, source, "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = plan[:plan.index("\n(1)")]
    target = tree[tree.index("Scan parquet"):] if tree.index("Scan parquet") > tree.index("Range") else tree[:tree.index("Range")]
    assert "Bucketed: true" in plan and tree.count("Exchange") == 1 and "Exchange" not in target
    # a write makes a file per bucket (and day) at most
    files = [p for p in spark.table(name).inputFiles()]
    assert len(files) <= 2 * 6 * (5 if partition_by else 1)


# ---- clustering over the files of a day ----

def test_files_of_a_day_have_narrow_ranges(spark, tmp_path):
    """Most rows fall on one day, and a third of them carry one value: still no file spans the day, and an index of the
    column's ranges leaves most files unopened."""
    settings = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    for key in settings:
        spark.conf.set(key, "32KB")
    try:
        events = spark.range(0, 200_000, 1, 8).select(
            F.expr("if(id % 3 = 0, 7, pmod(xxhash64(id), 1000))").cast("int").alias("zone"),
            F.timestamp_seconds(1_704_067_200 + F.col("id") % 80_000).cast("timestamp_ntz").alias("ts"))
        path = f"file:{tmp_path}/days"
        layout.day_partitioned(events, "ts", "zone").parquet(path)
    finally:
        for key in settings:
            spark.conf.unset(key)
    known = file_index.refresh(spark, f"file:{tmp_path}/index", [path], ["zone"]).files
    ranges = known.select("n_rows", F.inline("ranges"))
    assert ranges.count() > 4
    wide = ranges.where("most - least > 500").count()
    assert wide <= 1 and ranges.agg(F.max("n_rows")).first()[0] < 100_000
    chosen = known.where(file_index.may_hold("zone", 500, 510))
    assert 0 < chosen.count() <= ranges.count() / 3
    got = file_index.read_indexed(spark, chosen).where("zone between 500 and 509").count()
    assert got == events.where("zone between 500 and 509").count() > 0


def test_interval_audit_refuses_before_publishing(spark, database):
    name = f"{database}.events"
    rows_in = spark.createDataFrame([("a", datetime(2024, 1, 1, 5)), ("a", datetime(2024, 1, 2, 5))], "k string, ts timestamp_ntz")
    tables.replace_table(layout.by_day(rows_in, "ts"), name, partition_by=["day"])

    def refuse(written):
        assert rows(written.select("k")) == [("a",), ("b",)]
        raise ValueError("refused")

    new = spark.createDataFrame([("b", datetime(2024, 1, 2, 7))], "k string, ts timestamp_ntz")
    with pytest.raises(ValueError, match="refused"):
        tables.overwrite_interval_in_table(spark, name, new, "ts", datetime(2024, 1, 2), datetime(2024, 1, 3), audit=refuse)
    assert rows(spark.table(name).select("k")) == [("a",), ("a",)]
