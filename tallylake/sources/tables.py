"""Catalog tables and dated extracts."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.functions.dates import changed_since, day


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    """Whether the database holds the table; a temp view of that name does not count."""
    return spark.catalog.tableExists(f"{database}.{table}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_table_if_exists(spark: SparkSession, database: str, table: str) -> DataFrame | None:
    return read_table(spark, f"{database}.{table}") if table_exists(spark, database, table) else None


def external_delimited_table(
    spark: SparkSession,
    name: str,
    schema: str,
    location: str,
    delimiter: str = ",",
    multiline: bool = False,
    null_text: str = "",
    by: str | None = None,
) -> DataFrame:
    """Declare a delimited-text table over files that exist outside the catalog.

    Values may be quoted, so a comma inside one does no harm. Dropping the
    table leaves the files. ``by`` names a column of the schema that rows are loaded by (a load date): it
    is no part of the files, and ``sinks.tables.replace_partition`` loads one value at a time.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema))
    options = {"sep": delimiter, "quote": '"', "escape": '"', "multiLine": str(multiline).lower(), "nullValue": null_text}
    listed = ", ".join(f"'{key}' r'{value}'" for key, value in options.items())
    parted = f" PARTITIONED BY (`{by}`)" if by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING csv OPTIONS ({listed}){parted} LOCATION '{location}'")
    return spark.read.table(name)


def extract_since_mark(
    source: DataFrame,
    changed: str,
    as_of: date | str,
    mark: date | None = None,
    overlap: int = 0,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Rows changed up to ``as_of`` and after ``mark``, the date up to which earlier loads have read.

    A skipped load day is caught up with, since the mark (see ``sinks.loads``) moves only with a load that
    commits. Rows that reach the source late, dated before the mark, are found as far back as ``overlap`` days; what of
    those days is already among the ``loaded`` rows is left out, compared by all columns of the source (NULLs are
    equal). Without a mark everything up to ``as_of`` is read. Rows without a date are never extracted.
    """
    rows = source.filter(F.col(changed) <= day(as_of))
    if mark is None:
        return rows
    since = F.date_sub(day(mark), overlap)
    rows = rows.filter(F.col(changed) > since)
    if loaded is None or overlap == 0:
        return rows
    known = loaded.filter(F.col(changed) > since).select(*source.columns).distinct()
    known = known.withColumnsRenamed({name: f"_known_{name}" for name in source.columns})
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_known_{name}")) for name in source.columns])
    return rows.join(known, same, "left_anti")


def incremental_extract(
    source: DataFrame, changed: str, as_of: date | str | None = None, days: int = 1, inclusive: bool = False
) -> DataFrame:
    """Rows changed since ``as_of`` minus ``days``; exclusive unless ``inclusive``.

    On a DATE column with one day, exclusive means the load date itself and
    inclusive adds the day before. Without ``as_of`` the load date is today.
    """
    return source.filter(changed_since(F.col(changed), as_of, days, inclusive))
