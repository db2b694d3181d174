"""Registration of this subpackage's queries and their comparison SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of session and table folder under ``name``, beside its SQL if there is one."""

    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return register


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has found it, whatever folder they start in.

    On a cluster the package is installed or sent with the job, and this path means nothing there.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
