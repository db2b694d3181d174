"""A dimension kept in buckets of its keys, of which a merge rewrites only those that it touches.

A snapshot is an external table partitioned by ``bucket``. The next one gets new files for the buckets that hold a key of the
batch; the others are attached to it where they already lie. So a small batch costs the size of its
buckets and not of the dimension, and earlier snapshots go on reading their own files. A view names the present one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.operators.dimensions import latest_per_key, scd1_merge, unique_or_fail
from tallylake.sinks.tables import folders_below, partition_locations, snapshot_tables, table_facts
from tallylake.workspace import delete, stage

BUCKET = "bucket"


def with_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Rows with the bucket of their key; a row with a NULL key, which matches nothing, goes by its own hash."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    missing = F.greatest(*[F.col(f"`{key}`").isNull() for key in keys], F.lit(False))
    return df.withColumn(BUCKET, F.pmod(F.when(missing, whole).otherwise(F.xxhash64(*keys)), F.lit(buckets)).cast("int"))


def merge_buckets(
    batch: DataFrame, database: str, name: str, keys: list[str], buckets: int = 64, latest_by: list[str] | None = None, keep: int = 2
) -> int:
    """``scd1_merge`` of the batch into the dimension ``database.name``, published as its next snapshot.

    The first call creates it. ``buckets`` counts only then: later ones read it off the table. The newest ``keep``
    snapshots remain, and files that none of them reads are deleted. Returns the snapshot's version.
    """
    spark = batch.sparkSession
    stored = snapshot_tables(spark, database, name)
    current = f"{database}.{stored[-1][1]}" if stored else None
    if current:
        buckets = int(spark.sql(f"SHOW TBLPROPERTIES {current} ('buckets')").first()["value"])
    source = latest_per_key(batch, keys, latest_by) if latest_by else unique_or_fail(batch, keys)
    source = stage(with_bucket(source, keys, buckets), "merge-batch")
    touched = [row[0] for row in source.select(BUCKET).distinct().collect()]  # one row per bucket at most
    held = partition_locations(spark, current) if current else {}
    merged = source
    if current:
        old = spark.read.table(current).filter(F.col(BUCKET).isin(touched))
        kept = old.join(source.select(*keys), keys, "left_anti").select(*source.columns)
        merged = kept.unionByName(source)
    version = (stored[-1][0] if stored else 0) + 1
    top = _top(spark, database, name)
    folder = f"{top}/load-{uuid.uuid4().hex}"
    merged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
    places = {k: where for k, where in held.items() if int(k) not in touched} | {str(k): f"{folder}/{BUCKET}={k}" for k in touched}
    table = f"{database}.{name}_v{version}_{uuid.uuid4().hex[:8]}"
    _declare(spark, table, merged, f"{top}/none", places, buckets)
    shown = ", ".join(f"`{c}`" for c in merged.columns if c != BUCKET)
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {shown} FROM {table}")
    for _, old_table in stored[: max(0, len(stored) + 1 - keep)]:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{old_table}")
    _drop_unread(spark, database, name, top)
    return version


def _top(spark: SparkSession, database: str, name: str) -> str:
    where = {row[0]: row[1] for row in spark.sql(f"DESCRIBE DATABASE {database}").collect()}["Location"]
    return f"{where.rstrip('/')}/{name}_buckets"


def _declare(spark: SparkSession, table: str, rows: DataFrame, location: str, places: dict[str, str], buckets: int) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({BUCKET}) LOCATION '{location}' TBLPROPERTIES ('buckets' = '{buckets}')"
    )
    if places:
        listed = " ".join(f"PARTITION ({BUCKET} = {k}) LOCATION '{where}'" for k, where in places.items())
        spark.sql(f"ALTER TABLE {table} ADD {listed}")


def _drop_unread(spark: SparkSession, database: str, name: str, top: str) -> None:
    """Delete the bucket folders that no remaining snapshot reads."""
    read = set()
    for _, table in snapshot_tables(spark, database, name):
        read |= {_tail(where) for where in partition_locations(spark, f"{database}.{table}").values()}
    for folder in folders_below(spark, top, f"{BUCKET}="):
        if _tail(folder) not in read:
            delete(spark, folder)


def _tail(folder: str) -> str:
    return "/".join(folder.rstrip("/").split("/")[-2:])
