"""The product indicators and severity levels as functions for SQL text, kept in the catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallylake.functions.kpis import DEMAND_MARGIN, MONEY, PROMOTION_MARGIN, STOCK_LIMIT
from tallylake.functions.levels import OTHER_LEVEL, SEVERITY_LEVELS

RESULT = f"STRUCT<profit: {MONEY}, profitpercent: {MONEY}, promoind: SMALLINT, demandind: SMALLINT>"


def create_functions(spark: SparkSession, database: str) -> list[str]:
    """Create ``product_kpis(buyprice, msrp, stock)`` and ``frustration_level(total)`` in a database.

    They are SQL expressions that Spark inlines into the plan, with the same results as the column functions of this
    package. Returns their full names.
    """
    margin = "try_divide(msrp - buyprice, buyprice) * 100"
    promote = f"stock > {STOCK_LIMIT} AND {margin} > {PROMOTION_MARGIN}"
    demand = f"stock > 0 AND stock < {STOCK_LIMIT} AND {margin} > {DEMAND_MARGIN}"
    known = f"{margin} IS NOT NULL AND stock IS NOT NULL"
    spark.sql(
        f"""
        CREATE OR REPLACE FUNCTION {database}.product_kpis(buyprice {MONEY}, msrp {MONEY}, stock BIGINT)
        RETURNS {RESULT}
        RETURN named_struct(
            'profit', try_cast(msrp - buyprice AS {MONEY}),
            'profitpercent', try_cast({margin} AS {MONEY}),
            'promoind', CASE WHEN {known} THEN CAST({promote} AS SMALLINT) END,
            'demandind', CASE WHEN {known} THEN CAST({demand} AS SMALLINT) END)
        """
    )
    levels = " ".join(f"WHEN total BETWEEN {low} AND {high} THEN '{level}'" for low, high, level in SEVERITY_LEVELS)
    spark.sql(
        f"CREATE OR REPLACE FUNCTION {database}.frustration_level(total BIGINT) RETURNS STRING RETURN CASE {levels} ELSE '{OTHER_LEVEL}' END"
    )
    return [f"{database}.product_kpis", f"{database}.frustration_level"]
