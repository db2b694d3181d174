"""Appends that can be repeated, and a ledger of what has been loaded.

Rows appended by dated loads are kept by load: the table ``<name>_loads`` is partitioned by load date and part, and the
view ``<name>`` shows its rows without these columns. A load writes its partition as a whole, so the load key is
written with the data, in one step: a load that is repeated, or was broken off, leaves the rows of one run.

The ledger (a table ``load_ledger`` beside them, one partition per load date and part) is written after the data
of a part. It says which parts of a load are complete, how many rows they have, and up to which date of
its source a part has read (its mark).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.sinks.tables import replace_partition

LOAD_DATE, LOAD_PART = "load_date", "load_part"
LEDGER = "load_ledger"


def rows_before(spark: SparkSession, database: str, name: str, load_date: date, part: str) -> DataFrame | None:
    """All rows but those of this load, which it is about to replace; None before the first load.

    What later loads have appended rests on this load, so it can only be repeated while it is the last one.
    """
    table = f"{database}.{name}_loads"
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.read.table(table)
    loads = rows.filter((F.col(LOAD_DATE) > F.lit(load_date)) & (F.col(LOAD_PART) == part))
    if not loads.isEmpty():
        raise ValueError(f"{table}: loads after {load_date} rest on it and would have to be dropped first")
    own = (F.col(LOAD_DATE) == F.lit(load_date)) & (F.col(LOAD_PART) == part)
    return rows.filter(~own).drop(LOAD_DATE, LOAD_PART)


def write_load(df: DataFrame, database: str, name: str, load_date: date, part: str) -> None:
    """Append the rows of a load, in the place of what an earlier run of the same load has appended."""
    spark = df.sparkSession
    table = f"{database}.{name}_loads"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {LOAD_DATE} DATE, {LOAD_PART} STRING) USING parquet PARTITIONED BY ({LOAD_DATE}, {LOAD_PART})")
    replace_partition(df, table, {LOAD_DATE: load_date, LOAD_PART: part})
    shown = ", ".join(f"`{c}`" for c in spark.read.table(table).columns if c not in (LOAD_DATE, LOAD_PART))
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {shown} FROM {table}")


@dataclass(frozen=True)
class LoadLedger:
    """What has been loaded into the tables of a database."""

    spark: SparkSession
    database: str

    @property
    def table(self) -> str:
        return f"{self.database}.{LEDGER}"

    def _entries(self, part: str) -> DataFrame | None:
        if not self.spark.catalog.tableExists(self.table):
            return None
        return self.spark.read.table(self.table).filter(F.col(LOAD_PART) == part)

    def holds(self, load_date: date, part: str) -> bool:
        """Whether the part is complete for the date."""
        entries = self._entries(part)
        return entries is not None and not entries.filter(F.col(LOAD_DATE) == F.lit(load_date)).isEmpty()

    def mark(self, part: str, before: date) -> date | None:
        """How far the complete loads before a date have read the part's source."""
        entries = self._entries(part)
        return None if entries is None else entries.filter(F.col(LOAD_DATE) < F.lit(before)).agg(F.max("mark")).first()[0]

    def commit(self, load_date: date, part: str, rows: int, mark: date | None = None) -> None:
        """Enter a complete part; a repeated one replaces its entry."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (row_count BIGINT, mark DATE, {LOAD_DATE} DATE, {LOAD_PART} STRING) "
            f"USING parquet PARTITIONED BY ({LOAD_DATE}, {LOAD_PART})"
        )
        entry = self.spark.createDataFrame([(rows, mark)], "row_count bigint, mark date")
        replace_partition(entry.coalesce(1), self.table, {LOAD_DATE: load_date, LOAD_PART: part})
