"""Discovery marts: rewards, frustration, intent, reasons and product demand."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.functions.dates import day
from tallylake.functions.levels import frustration_level
from tallylake.operators.grouping import top_n, top_per_group
from tallylake.operators.keywords import match_keywords, severity_per_customer

# Misspelt or plural intents of the dictionary, and what they stand for.
INTENT_NAMES = {"compliant": "complaint", "purchases": "purchase"}

MONEY_TOTAL = "decimal(38,2)"


def payments_per_salesrep(payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Payment totals per sales representative, straight from the source tables.

    Payments shrink to one row per customer before they meet the customers, so
    only totals are shuffled.
    """
    totals = payments.groupBy("customernumber").agg(F.sum("amount").alias("amount"))
    return totals.join(customers.select("customernumber", "salesrepemployeenumber"), "customernumber")


def sales_per_employee(offices: DataFrame, employees: DataFrame, payments: DataFrame) -> DataFrame:
    """Total payments per employee with the office columns.

    ``payments`` needs ``salesrepemployeenumber`` and ``amount`` at any grain.
    It is summed per representative before the joins, whose results are then no
    larger than the employee table.
    """
    sums = (
        payments.filter(F.col("salesrepemployeenumber").isNotNull())
        .groupBy(F.col("salesrepemployeenumber").alias("employeenumber"))
        .agg(F.sum("amount").cast(MONEY_TOTAL).alias("sumamt"))
    )
    return employees.join(sums, "employeenumber").join(offices, "officecode")


def employee_rewards(
    offices: DataFrame, employees: DataFrame, payments: DataFrame, as_of: date | str | None = None, since: date | str | None = None
) -> DataFrame:
    """The best selling e-mail address of every state, ties included.

    ``employees`` should hold one row per employee (``scd2_current``): with the
    full history each version would count the payments again. Offices without
    a state compete with one another as one group. With ``since`` only
    payments loaded from that date on count.
    """
    if since is not None:
        payments = payments.filter(F.col("datadt") >= day(since))
    sales = sales_per_employee(offices, employees, payments)
    per_email = sales.groupBy("state", "email").agg(F.sum("sumamt").cast(MONEY_TOTAL).alias("sumamt"))
    best = top_per_group(per_email, ["state"], ["-sumamt"], n=1)
    return best.select("email", "sumamt", "rnk", day(as_of).alias("datadt"))


def customer_frustration(
    visits: DataFrame,
    dictionary: DataFrame,
    customer: str = "customernumber",
    text: str = "comments",
    literal: bool = False,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Total severity of the keywords in a customer's comments, and its level.

    Customers whose comments hold no keyword are left out, or, with ``keep_unmatched``, come with
    no total and the level for other values.
    """
    totals = severity_per_customer(match_keywords(visits, dictionary, text, literal=literal), customer)
    if keep_unmatched:
        # United and summed once more, map-side, instead of a join of the totals to all customers.
        every = visits.select(customer, F.lit(None).cast("bigint").alias("total_severity"))
        totals = totals.unionByName(every).groupBy(customer).agg(F.sum("total_severity").alias("total_severity"))
    return totals.withColumn("customer_frustration_level", frustration_level(F.col("total_severity")))


def customer_intent(
    visits: DataFrame, dictionary: DataFrame, customer: str = "customernumber", text: str = "comments", literal: bool = False
) -> DataFrame:
    """The intent matched most often per customer; the alphabetically first wins a tie."""
    intent = F.col("intent")
    for written, meant in INTENT_NAMES.items():
        intent = F.when(F.col("intent") == written, meant).otherwise(intent)
    counts = (
        match_keywords(visits, dictionary, text, literal=literal)
        .groupBy(customer, intent.alias("intent"))
        .agg(F.count("*").alias("matches"))
    )
    return top_per_group(counts, [customer], ["-matches", "intent"], n=1, ties=False).select(customer, "intent", "matches")


def contact_reasons(
    visits: DataFrame, dictionary: DataFrame, n: int = 5, customer: str = "customernumber", text: str = "comments", literal: bool = False
) -> DataFrame:
    """The n keywords raised by most customers, for either side (company or customer)."""
    counts = (
        match_keywords(visits, dictionary, text, literal=literal)
        .groupBy("comp_cust", "orddesc")
        .agg(F.countDistinct(customer).alias("customers"))
    )
    return top_per_group(counts, ["comp_cust"], ["-customers", "orddesc"], n=n, ties=False)


def severity_indicator(
    visits: DataFrame, dictionary: DataFrame, customer: str = "customernumber", text: str = "comments", literal: bool = False
) -> DataFrame:
    """Sums of the positive and of the negative severities per customer."""
    severity = F.col("severity")
    return (
        match_keywords(visits, dictionary, text, literal=literal)
        .groupBy(customer)
        .agg(
            F.sum(F.greatest(severity, F.lit(0))).alias("positive"),
            F.sum(F.greatest(-severity, F.lit(0))).alias("negative"),
        )
    )


def satisfaction_index(
    visits: DataFrame, dictionary: DataFrame, customer: str = "customernumber", text: str = "comments", literal: bool = False
) -> DataFrame:
    """Positive minus negative severity per customer."""
    sides = severity_indicator(visits, dictionary, customer, text, literal)
    return sides.select(customer, (F.col("positive") - F.col("negative")).alias("satisfaction"))


def customer_aggregates(payments: DataFrame) -> DataFrame:
    """Number, sum and maximum of the payments of each customer."""
    return payments.groupBy("customernumber").agg(
        F.count("*").alias("payments"),
        F.sum("amount").cast(MONEY_TOTAL).alias("total"),
        F.max("amount").alias("largest"),
    )


def demand_supply_ratio(products: DataFrame, details: DataFrame) -> DataFrame:
    """Quantity ordered over quantity in stock; NULL where nothing is in stock.

    Products never ordered have demand 0. Lines are summed before the join.
    """
    ordered = details.groupBy("productcode").agg(F.sum("quantityordered").alias("ordered"))
    demand = F.coalesce(F.col("ordered"), F.lit(0))
    return products.join(ordered, "productcode", "left").select(
        "productcode",
        demand.alias("ordered"),
        F.col("quantityinstock").cast("bigint").alias("stock"),
        F.try_divide(demand.cast("double"), F.col("quantityinstock").cast("double")).alias("ratio"),
    )


def top_n_orders(lines: DataFrame, n: int = 10) -> DataFrame:
    """The n orders of highest value, from order lines."""
    value = F.sum((F.col("quantityordered") * F.col("priceeach"))).cast(MONEY_TOTAL)
    return top_n(lines.groupBy("ordernumber").agg(value.alias("value")), ["-value", "ordernumber"], n)


def top_n_office_employees(offices: DataFrame, employees: DataFrame, payments: DataFrame, n: int = 3) -> DataFrame:
    """The n best selling employees of every office."""
    sales = sales_per_employee(offices, employees, payments)
    return top_per_group(sales, ["officecode"], ["-sumamt", "employeenumber"], n=n, ties=False).select(
        "officecode", "employeenumber", "email", "sumamt", "rnk"
    )
