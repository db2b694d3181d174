"""Extracts from the retail databases, with joins and filters run by the database."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from tallylake.functions.dates import months
from tallylake.plans.curated import (
    CUSTOMER_COLUMNS,
    LINE_COLUMNS,
    ORDER_COLUMNS,
    PAYMENT_COLUMNS,
    PRODUCT_COLUMNS,
    stamped_lines,
    stamped_payments,
)
from tallylake.sources.jdbc import JdbcDatabase, derived_table, read_jdbc, read_jdbc_partitioned


def changed_rows(
    spark: SparkSession, database: JdbcDatabase, table: str, as_of: date, days: int = 1, inclusive: bool = False
) -> DataFrame:
    """Rows of a table whose ``upddt`` lies after (or from) ``as_of`` minus ``days``."""
    mark = as_of - timedelta(days=days)
    sign = ">=" if inclusive else ">"
    return read_jdbc(spark, database, derived_table(f"select * from {table} where upddt {sign} date '{mark}'", "changed"))


def join_text(tables: list[tuple[str, str | None, tuple[str, ...]]], where: str) -> str:
    """A select over tables that are joined one after another.

    Each table comes with the column it shares with those before it (None for the first) and
    the columns wanted of it. In ``where`` tables go by their names.
    """
    listed = ", ".join(f"{table}.{column}" for table, _, columns in tables for column in columns)
    text, owner = "", {}
    for table, shared, columns in tables:
        text += f" join {table} on {owner[shared]}.{shared} = {table}.{shared}" if shared else table
        for column in columns:
            owner.setdefault(column, table)
    return f"select {listed} from {text} where {where}"


def _between(column: str, year: int, first_month: int, last_month: int) -> str:
    start, end = months(year, first_month, last_month)
    return f"{column} >= date '{start}' and {column} < date '{end}'"


def payments_text(year: int, first_month: int, last_month: int = 12) -> str:
    tables = [("customers", None, CUSTOMER_COLUMNS), ("payments", "customernumber", PAYMENT_COLUMNS)]
    return join_text(tables, _between("payments.paymentdate", year, first_month, last_month))


def lines_text(year: int, first_month: int, last_month: int = 12) -> str:
    tables = [("orders", None, ORDER_COLUMNS), ("orderdetails", "ordernumber", LINE_COLUMNS)]
    return join_text(tables, _between("orders.orderdate", year, first_month, last_month))


def line_products_text(year: int, first_month: int, last_month: int = 12) -> str:
    tables = [
        ("orders", None, ORDER_COLUMNS),
        ("orderdetails", "ordernumber", LINE_COLUMNS),
        ("products", "productcode", PRODUCT_COLUMNS),
    ]
    return join_text(tables, _between("orders.orderdate", year, first_month, last_month))


def customer_payments(
    spark: SparkSession,
    database: JdbcDatabase,
    year: int,
    first_month: int,
    last_month: int = 12,
    partitions: int = 4,
    as_of: date | str | None = None,
) -> DataFrame:
    """``curated.customer_payments`` with the join left to the database, read in parallel."""
    joined = derived_table(payments_text(year, first_month, last_month), "paid")
    return stamped_payments(read_jdbc_partitioned(spark, database, joined, "customernumber", partitions), as_of)


def order_lines(
    spark: SparkSession,
    database: JdbcDatabase,
    year: int,
    first_month: int,
    last_month: int = 12,
    partitions: int = 4,
    as_of: date | str | None = None,
) -> DataFrame:
    """``curated.order_lines`` with the join left to the database, read in parallel."""
    joined = derived_table(lines_text(year, first_month, last_month), "lines")
    return stamped_lines(read_jdbc_partitioned(spark, database, joined, "ordernumber", partitions), as_of)


def order_line_products(
    spark: SparkSession, database: JdbcDatabase, year: int, first_month: int, last_month: int = 12, partitions: int = 4
) -> DataFrame:
    """``curated.order_line_products`` with both joins left to the database, read in parallel."""
    joined = derived_table(line_products_text(year, first_month, last_month), "lineproducts")
    return read_jdbc_partitioned(spark, database, joined, "ordernumber", partitions)
