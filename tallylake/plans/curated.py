"""Curated payments, order lines and orders with products.

Joins carry no broadcast hints: Spark broadcasts a side by its measured size
and otherwise sorts and merges, splitting skewed keys at run time.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.functions.dates import day, in_months

# The source columns of the extracts, in their order.
CUSTOMER_COLUMNS = ("customernumber", "customername", "country", "salesrepemployeenumber", "creditlimit")
PAYMENT_COLUMNS = ("checknumber", "paymentdate", "amount")
ORDER_COLUMNS = ("customernumber", "ordernumber", "orderdate", "shippeddate", "status", "comments")
LINE_COLUMNS = ("quantityordered", "priceeach", "orderlinenumber", "productcode")
PRODUCT_COLUMNS = (
    "productname",
    "productline",
    "productscale",
    "productvendor",
    "productdescription",
    "quantityinstock",
    "buyprice",
    "msrp",
)


def customer_payments(
    customers: DataFrame,
    payments: DataFrame,
    year: int,
    first_month: int,
    last_month: int = 12,
    as_of: date | str | None = None,
) -> DataFrame:
    """Customers joined with their payments of the given months, stamped with the load date."""
    paid = payments.filter(in_months(F.col("paymentdate"), year, first_month, last_month))
    return stamped_payments(customers.join(paid, "customernumber"), as_of)


def stamped_payments(joined: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """The payment columns of an already joined frame, with the load date."""
    names = {"customername": F.upper("customername").alias("custname")}
    return joined.select(*[names.get(c, c) for c in (*CUSTOMER_COLUMNS, *PAYMENT_COLUMNS)], day(as_of).alias("datadt"))


def order_lines(
    orders: DataFrame,
    details: DataFrame,
    year: int,
    first_month: int,
    last_month: int = 12,
    as_of: date | str | None = None,
) -> DataFrame:
    """Orders of the given months joined with their lines, stamped with the load date."""
    placed = orders.filter(in_months(F.col("orderdate"), year, first_month, last_month))
    return stamped_lines(placed.join(details, "ordernumber"), as_of)


def stamped_lines(joined: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """The line columns of an already joined frame, with the load date."""
    return joined.select(*ORDER_COLUMNS, *LINE_COLUMNS, day(as_of).alias("datadt"))


def orders_products(products: DataFrame, lines: DataFrame) -> DataFrame:
    """Order lines with all columns of their product; the key appears once."""
    return products.join(lines, "productcode")


def order_line_products(
    orders: DataFrame, details: DataFrame, products: DataFrame, year: int, first_month: int, last_month: int = 12
) -> DataFrame:
    """Orders of the given months with their lines and the lines' products, before any stamp.

    Orders are filtered ahead of both joins. Columns that the sources lack come as NULL.
    """
    placed = orders.filter(in_months(F.col("orderdate"), year, first_month, last_month))
    joined = placed.join(details, "ordernumber").join(products.drop("upddt"), "productcode")
    wanted = (*ORDER_COLUMNS, *LINE_COLUMNS, *PRODUCT_COLUMNS)
    return joined.select(*[c if c in joined.columns else F.lit(None).cast("string").alias(c) for c in wanted])
