"""Relational sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallylake.sources.jdbc import JdbcDatabase


def write_jdbc(
    df: DataFrame, database: JdbcDatabase, table: str, mode: str = "overwrite", connections: int = 8, truncate: bool = True
) -> None:
    """Write through at most ``connections`` parallel connections.

    An overwrite empties the existing table (keeping its definition and grants)
    unless ``truncate`` is off, which drops and recreates it.
    """
    options = {"numPartitions": str(connections), "truncate": str(truncate).lower()}
    df.write.options(**options).jdbc(database.url, table, mode=mode, properties=database.options)
