"""Catalog sinks: parquet tables, partition overwrites and versioned snapshots."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.workspace import delete


def prepare_zones(spark: SparkSession, kept: list[str], rebuilt: list[str], location: str | None = None) -> None:
    """Create the databases that keep their tables; drop and recreate the others."""
    for name in rebuilt:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    for name in [*kept, *rebuilt]:
        where = f" LOCATION '{location.rstrip('/')}/{name}.db'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def build_zone(spark: SparkSession, zone: str, location: str | None = None, owner: str | None = None) -> str:
    """A new database in which the next contents of a zone are built, while readers use the present ones.

    It is marked as being built by ``owner`` (this application, unless named), and no other load takes it away.
    """
    built = f"{zone}_built_{uuid.uuid4().hex[:12]}"
    prepare_zones(spark, [built], [], location)
    _mark_zone(spark, built, load_owner=owner or spark.sparkContext.applicationId, load_state="building")
    return built


def switch_zone(spark: SparkSession, zone: str, built: str, location: str | None = None, keep: int = 1) -> None:
    """Point the zone's views to the tables of ``built``, and retire what was finished long before.

    Until here a load that fails leaves the zone as it was. Readers use ``zone.table``; whoever has begun to
    read goes on with the former tables, since the last ``keep`` finished databases stay beside the present
    one. Databases that are still being built are never touched.
    """
    prepare_zones(spark, [zone], [], location)
    names = [t.name for t in spark.catalog.listTables(built) if not t.isTemporary]
    for name in names:
        spark.sql(f"CREATE OR REPLACE VIEW {zone}.{name} AS SELECT * FROM {built}.{name}")
    for old in spark.catalog.listTables(zone):
        if not old.isTemporary and old.name not in names:
            spark.sql(f"DROP {'VIEW' if old.tableType == 'VIEW' else 'TABLE'} IF EXISTS {zone}.{old.name}")
    finished = {name: int(marks["load_number"]) for name, marks in zone_builds(spark, zone).items() if marks.get("load_state") == "finished"}
    _mark_zone(spark, built, load_state="finished", load_number=1 + max(finished.values(), default=0))
    former = sorted((name for name in finished if name != built), key=finished.get, reverse=True)
    for name in former[keep:]:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def zone_builds(spark: SparkSession, zone: str) -> dict[str, dict[str, str]]:
    """The databases built for a zone, with their marks."""
    found = {}
    for database in spark.catalog.listDatabases(f"{zone}_built_*"):
        described = {row[0]: row[1] for row in spark.sql(f"DESCRIBE DATABASE EXTENDED {database.name}").collect()}
        found[database.name] = dict(re.findall(r"\((load_\w+),([^()]*)\)", described.get("Properties") or ""))
    return found


def abandon_zones(spark: SparkSession, zone: str, owner: str | None = None) -> None:
    """Drop what ``owner`` (this application, unless named) has begun to build for a zone and not finished."""
    owner = owner or spark.sparkContext.applicationId
    for name, marks in zone_builds(spark, zone).items():
        if marks.get("load_state") == "building" and marks.get("load_owner") == owner:
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def _mark_zone(spark: SparkSession, database: str, **marks) -> None:
    listed = ", ".join(f"'{key}' = '{value}'" for key, value in marks.items())
    spark.sql(f"ALTER DATABASE {database} SET DBPROPERTIES ({listed})")


def write_table(df: DataFrame, name: str, mode: str = "overwrite", compression: str | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.option("compression", compression) if compression else writer).saveAsTable(name)


def write_table_partitioned(df: DataFrame, name: str, by: list[str], dynamic: bool = True) -> None:
    """Overwrite a partitioned table.

    ``dynamic`` replaces only the partitions present in ``df`` and keeps the
    rest; otherwise the whole table is replaced. Rows are rebalanced on the
    partition columns: few files per partition, and a partition that holds
    much of the data is split among tasks.
    """
    spark = df.sparkSession
    balanced = df.hint("rebalance", *by)
    if not dynamic or not spark.catalog.tableExists(name):
        balanced.write.mode("overwrite").partitionBy(*by).saveAsTable(name)
        return
    fields = spark.read.table(name).schema.fields
    rows = balanced.select(*[F.col(f.name).cast(f.dataType) for f in fields])
    # insertInto takes the mode from the session alone, and another thread's write would see it
    # changed. The writer's option does the same in the table's folder.
    about = table_facts(spark, name)
    writer = rows.write.mode("overwrite").format(about["Provider"]).partitionBy(*by)
    writer.option("partitionOverwriteMode", "dynamic").save(about["Location"])
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def replace_partition(df: DataFrame, name: str, values: dict[str, object]) -> None:
    """Make ``df`` the whole contents of one partition of a table, whatever it held before.

    The rows go to a folder that no other load uses, and the partition's location is then set to it, in one
    step. So a repeated load replaces its rows, other partitions stay as they are, and a load that breaks off
    leaves only files that nobody reads, as replaced ones are (see ``drop_unread``). An empty frame empties the
    partition. ``values`` holds all partition columns; ``df`` the others, matched by name.
    """
    spark = df.sparkSession
    about = table_facts(spark, name)
    fields = [f for f in spark.read.table(name).schema.fields if f.name not in values]
    rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in fields])
    spec = ", ".join(f"`{key}` = '{value}'" for key, value in values.items())
    folder = "/".join([about["Location"].rstrip("/"), *(f"{key}={value}" for key, value in values.items()), f"load-{uuid.uuid4().hex}"])
    whole = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"} if about["Provider"] == "csv" else {}
    rows.write.format(about["Provider"]).options(**whole, **_stored_options(about)).save(folder)
    if spark.sql(f"SHOW PARTITIONS {name} PARTITION ({spec})").isEmpty():
        spark.sql(f"ALTER TABLE {name} ADD PARTITION ({spec}) LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


def drop_unread(spark: SparkSession, name: str) -> int:
    """Delete the folders of replaced or broken-off loads, and return their number.

    Run it when no load of the table is under way and readers of replaced rows are done.
    """
    read = {where.rstrip("/").split("/")[-1] for where in partition_locations(spark, name).values()}
    old = [f for f in folders_below(spark, table_facts(spark, name)["Location"], "load-") if f.split("/")[-1] not in read]
    for folder in old:
        delete(spark, folder)
    return len(old)


def partition_locations(spark: SparkSession, name: str) -> dict[str, str]:
    """Where each partition lies, by its values joined with ``/``."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        parts = [part.split("=", 1) for part in row[0].split("/")]
        spec = ", ".join(f"`{key}` = '{value}'" for key, value in parts)
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({spec})").collect()
        found["/".join(value for _, value in parts)] = next(r["data_type"] for r in described if r["col_name"] == "Location")
    return found


def folders_below(spark: SparkSession, top: str, begins: str) -> list[str]:
    """All folders below ``top`` whose name begins as given; those inside them aren't looked at."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(top)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, left = [], [path] if system.exists(path) else []
    while left:
        for status in system.listStatus(left.pop()):
            if status.isDirectory():
                inner = status.getPath()
                found.append(inner.toString()) if inner.getName().startswith(begins) else left.append(inner)
    return found


def table_facts(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table: Provider, Location, Storage Properties and so on."""
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _stored_options(about: dict[str, str]) -> dict[str, str]:
    """The options that a table was declared with, as its readers use them."""
    return dict(re.findall(r"(?:^\[|, )(\w+)=(.*?)(?=, \w+=|\]$)", about.get("Storage Properties", "")))


def append_insert(df: DataFrame, name: str) -> None:
    """Append to an existing table, matching columns by name."""
    df.select(*df.sparkSession.read.table(name).columns).write.mode("append").insertInto(name)


def overwrite_insert(df: DataFrame, name: str) -> None:
    """Replace the rows of an existing table, matching columns by name.

    Spark refuses a plan that reads the table it overwrites; publish such a
    result with ``publish_snapshot``.
    """
    df.select(*df.sparkSession.read.table(name).columns).write.mode("overwrite").insertInto(name)


def load_file_overwrite(file_rows: DataFrame, name: str) -> None:
    """Replace a table, created on first use, with the rows read from a file."""
    if file_rows.sparkSession.catalog.tableExists(name):
        overwrite_insert(file_rows, name)
    else:
        write_table(file_rows, name)


def snapshot_tables(spark: SparkSession, database: str, name: str) -> list[tuple[int, str]]:
    """Version and table name of the stored snapshots, oldest first."""
    pattern = re.compile(rf"{re.escape(name.lower())}_v(\d+)_[0-9a-f]{{8}}")
    tables = [t.name for t in spark.catalog.listTables(database, f"{name}_v*")]
    found = [(pattern.fullmatch(t.lower()), t) for t in tables]
    return sorted((int(match.group(1)), table) for match, table in found if match)


def publish_snapshot(df: DataFrame, database: str, name: str, keep: int = 2) -> int:
    """Write ``df`` as the next version of a table and point its view there.

    Readers use the view ``database.name``. ``df`` may be computed from the
    current version: that one is left alone, and the view is switched only when
    the new files are complete. A load that failed half-way left files under a
    name no other load takes, so it can simply be repeated. The newest ``keep``
    versions remain.
    """
    spark = df.sparkSession
    stored = snapshot_tables(spark, database, name)
    version = (stored[-1][0] if stored else 0) + 1
    table = f"{database}.{name}_v{version}_{uuid.uuid4().hex[:8]}"
    df.write.saveAsTable(table)
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {table}")
    for _, old in stored[: max(0, len(stored) + 1 - keep)]:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{old}")
    return version
