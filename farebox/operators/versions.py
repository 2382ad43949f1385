"""Published tables: a name is a view on the version of its rows that is in force.

A version is written to fresh folders and registered as a table of its own, which nobody reads but checks. One metadata
action, ``CREATE OR REPLACE VIEW``, puts it in force: a reader that plans its query before sees all of the former version,
one that plans after it all of the new one, and whatever stops a writer earlier leaves the former version.

A version of a partitioned table is a list of partition folders, kept as a manifest beside them: those of replaced
partitions come from the new write, all others stay where they lie. So replacing many days is one write, one manifest, one
``ADD PARTITION`` for all of them and the switch, and no statement is made per day. The version before the present one is
kept for readers that have begun; what neither needs is deleted at the next switch. A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_PROPERTY = "farebox."
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Version(NamedTuple):
    """A version of the table ``name``: ``table`` is what it is registered as, ``root`` where all versions lie."""

    name: str
    id: str
    root: str
    partition_by: tuple[str, ...] = ()

    @property
    def table(self) -> str:
        return f"{self.name}__v_{self.id}"

    @property
    def folder(self) -> str:
        return f"{self.root}/version={self.id}"

    @property
    def manifest(self) -> str:
        return f"{self.root}/_manifests/{self.id}"


def _database_and_table(spark: SparkSession, name: str) -> tuple[str, str]:
    database, _, table = name.replace("`", "").rpartition(".")
    return database or spark.catalog.currentDatabase(), table


def _root(spark: SparkSession, name: str) -> str:
    # not where a plain table of the name would lie, which may be renamed
    database, table = _database_and_table(spark, name)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}__versions"


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    """What is noted on the view of a published table; empty if there is no such view."""
    if not spark.catalog.tableExists(name):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"].removeprefix(_PROPERTY): r["value"] for r in rows if r["key"].startswith(_PROPERTY)}


def in_force(spark: SparkSession, name: str) -> Version | None:
    """The version that the name stands for; None if nothing was published under it."""
    noted = properties(spark, name)
    if "version" not in noted:
        return None
    return Version(name, noted["version"], noted["root"], tuple(filter(None, noted["partition_by"].split(","))))


def stored_table(spark: SparkSession, name: str) -> str:
    """The table that rows appended to ``name`` have to go to: the version in force, or the name itself."""
    now = in_force(spark, name)
    return name if now is None else now.table


# ---- writing a version ----

def stage(df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None) -> Version:
    """Write the frame as a version of ``name`` that is not in force; it may be read under ``version.table``."""
    spark = df.sparkSession
    version = Version(name, uuid.uuid4().hex[:12], (path or _root(spark, name)).rstrip("/"), tuple(partition_by))
    return _write(df, version, {})


def stage_partitions(df: DataFrame, name: str, gone: Callable[[dict[str, str | None]], bool] | None = None) -> Version:
    """As ``stage``, for a partitioned table whose other partitions stay.

    Partitions the frame has rows for are replaced by those rows. Of the others, those for whose values (texts by column,
    None for NULL) ``gone`` holds are left out. The frame may read from the table itself.
    """
    spark = df.sparkSession
    now = in_force(spark, name)
    if now is None or not now.partition_by:
        raise ValueError(f"{name} is no published table with partitions: publish it with replace_table first")
    version = now._replace(id=uuid.uuid4().hex[:12])
    kept = {f: at for f, at in folders(spark, now).items() if gone is None or not gone(_values(f))}
    return _write(df.select(*spark.table(now.table).columns), version, kept)


def _write(df: DataFrame, version: Version, kept: dict[str, str]) -> Version:
    spark, name = df.sparkSession, version.table
    writer = df.write
    if version.partition_by:
        writer = writer.partitionBy(*version.partition_by)
    writer.parquet(version.folder)
    rest = [f for f in df.schema.fields if f.name not in version.partition_by]
    order = T.StructType([*rest, *[df.schema[c] for c in version.partition_by]])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in order.fields)
    partitioned = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in version.partition_by)})" if version.partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{partitioned} LOCATION '{version.folder}'")
    if version.partition_by:
        new = _listed(spark, version.folder, len(version.partition_by))
        all_ = kept | {f: f"{version.folder}/{f}" for f in new}
        rows = spark.createDataFrame(sorted(all_.items()), "folder string, location string")
        rows.coalesce(1).write.parquet(version.manifest)
        if all_:
            spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
                f"PARTITION ({_spec(folder)}) LOCATION '{location}'" for folder, location in sorted(all_.items())))
    return version


def _values(folder: str) -> dict[str, str | None]:
    """``a=1/b=x`` as values by column."""
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return {unquote(c): None if v == _NO_VALUE else unquote(v) for c, v in pairs}


def _spec(folder: str) -> str:
    def literal(value):
        return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return ", ".join(f"`{c}` = {literal(v)}" for c, v in _values(folder).items())


def folders(spark: SparkSession, version: Version) -> dict[str, str]:
    """Partition folders of a version and where they lie: the manifest's, and those that appends have added since."""
    if not version.partition_by:
        return {"": version.folder}
    listed = {r["folder"]: r["location"] for r in spark.read.parquet(version.manifest).collect()}
    known = {tuple(sorted(_values(f).items(), key=lambda x: x[0])) for f in listed}
    for row in spark.sql(f"SHOW PARTITIONS {version.table}").collect():
        values = _values(row[0])
        # the catalog's own text says null where a folder says that there is no value
        values = {c: None if v == "null" else v for c, v in values.items()}
        if tuple(sorted(values.items(), key=lambda x: x[0])) not in known:
            folder = "/".join(f"{p.split('=', 1)[0]}={_NO_VALUE}" if p.endswith("=null") else p for p in row[0].split("/"))
            listed[folder] = f"{version.folder}/{folder}"
    return listed


# ---- putting it in force ----

def publish(version: Version, spark: SparkSession, select: str | None = None, noted: dict[str, str] | None = None) -> None:
    """Let the name stand for this version. ``select`` is the view's query where it is more than the version's rows,
    ``noted`` are further properties, which change in the same action.

    A plain table of that name is renamed first, and dropped at the switch after this; only then is there a moment without
    the name.
    """
    name, about = version.name, properties(spark, version.name)
    now = in_force(spark, name)
    before = _before(name, about) if now is not None and now.id == version.id else now
    spared = None
    if now is None and spark.catalog.tableExists(name):
        database, table = _database_and_table(spark, name)
        # called as versions are, so that it is found when it is no longer needed
        spared = f"{table}__v_{uuid.uuid4().hex[:12]}"
        spark.sql(f"ALTER TABLE {name} RENAME TO {database}.{spared}")
    columns = ", ".join(f"`{c}`" for c in spark.table(version.table).columns)
    about = {
        "version": version.id, "root": version.root, "partition_by": ",".join(version.partition_by),
        "before": "" if before is None else "|".join([before.id, before.root, *before.partition_by]), **(noted or {})}
    listed = ", ".join(f"'{_PROPERTY}{k}' = '{v}'" for k, v in about.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS {select or f'SELECT {columns} FROM {version.table}'}")
    _clean_up(spark, version, before, spared)


def discard(spark: SparkSession, version: Version) -> None:
    """Remove a version that was never put in force. One that is left behind goes at the next switch of its table."""
    spark.sql(f"DROP TABLE IF EXISTS {version.table}")
    for path in (version.folder, version.manifest):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _before(name: str, about: dict[str, str]) -> Version | None:
    if not about.get("before"):
        return None
    id_, root, *partition_by = about["before"].split("|")
    return Version(name, id_, root, tuple(partition_by))


def _clean_up(spark: SparkSession, now: Version, before: Version | None, spared: str | None) -> None:
    """Drop versions, and delete folders, that neither the version in force nor the one before it needs."""
    kept = [v for v in (now, before) if v is not None]
    database, table = _database_and_table(spark, now.name)
    names = {_database_and_table(spark, v.table)[1] for v in kept} | {spared}
    for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{table}__v_*'").collect():
        if row["tableName"] not in names and not row["isTemporary"]:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{row['tableName']}")
    needed = {now.folder, now.manifest}
    for version in kept:
        needed |= {version.folder, version.manifest, *folders(spark, version).values()}
    alive = set()
    for path in map(_plain, needed):
        while "/" in path and path not in alive:
            alive.add(path)
            path = path.rpartition("/")[0]
    # outer folders first, so that what lies in a deleted one is not asked for
    for pattern in [now.root + "/version=*" + "/*=*" * n for n in range(len(now.partition_by) + 1)] + [f"{now.root}/_manifests/*"]:
        for found in _globbed(spark, pattern):
            if _plain(found) not in alive:
                place = spark._jvm.org.apache.hadoop.fs.Path(found)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _plain(path: str) -> str:
    return "file:/" + path.removeprefix("file:").lstrip("/") if path.startswith(("file:", "/")) else path


def _globbed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of a pattern, from one listing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [f.getPath().toString() for f in found or []]


def _listed(spark: SparkSession, folder: str, levels: int) -> list[str]:
    """Partition folders below a folder, as relative paths."""
    return ["/".join(p.split("/")[-levels:]) for p in _globbed(spark, folder + "/*=*" * levels)]
