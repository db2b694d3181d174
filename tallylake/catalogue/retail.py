"""The provided tables seen as retail tables, in Spark and in SQL.

customer -> customers, orders -> payments and orders, lineitem -> order lines,
part -> products, supplier -> employees, nation -> offices, events and
documents -> visits. Every frame has a SQL text of the same rows and types.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.sinks.tables import prepare_zones
from tallylake.workspace import session_dir

# The load date of every dated query.
AS_OF = "1998-01-01"

# Keywords that occur in the documents, in the form of an order-rate dictionary.
DICTIONARY_ROWS = """
    (1, 'the', 'cust', -1, 'offer'),
    (2, 'worthless', 'comp', -4, 'complaint'),
    (3, 'with', 'cust', 1, 'offer'),
    (4, 'tion', 'comp', -1, 'compliant'),
    (5, 'The', 'cust', 2, 'marketing'),
    (6, 'euxeau', 'cust', 3, 'purchases'),
    (7, 'ung', 'comp', 0, 'logistic'),
    (8, 'sch ', 'comp', -2, 'logistic'),
    (9, 'is the', 'cust', 5, 'marketing'),
    (10, 'Ver', 'comp', -3, 'complaint'),
    (11, 'que la', 'cust', 1, 'offer'),
    (12, 'ione', 'cust', 4, 'offer'),
    (13, 'copyright', 'comp', -5, 'complaint'),
    (14, 'password', 'cust', -2, 'compliant'),
    (15, 'en la', 'cust', 2, 'purchases'),
    (16, 'zzzz', 'comp', 5, 'marketing')
"""
DICTIONARY = f"(SELECT * FROM (VALUES {DICTIONARY_ROWS}) AS d(rid, orddesc, comp_cust, severity, intent))"

CUSTOMERS = """(
    SELECT c_custkey AS customernumber, c_name AS customername, c_nationkey AS country,
           CASE WHEN c_acctbal >= 0 THEN c_custkey % (SELECT count(*) FROM supplier) END AS salesrepemployeenumber,
           CAST(c_acctbal AS DECIMAL(10,2)) AS creditlimit
    FROM customer)"""

PAYMENTS = """(
    SELECT o_custkey AS customernumber, o_orderkey AS checknumber, CAST(o_orderdate AS DATE) AS paymentdate,
           CAST(o_totalprice AS DECIMAL(18,2)) AS amount
    FROM orders)"""

ORDERS = """(
    SELECT o_orderkey AS ordernumber, o_custkey AS customernumber, CAST(o_orderdate AS DATE) AS orderdate,
           CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS shippeddate,
           o_orderstatus AS status, o_orderpriority AS comments
    FROM orders)"""

ORDERDETAILS = """(
    SELECT l_orderkey AS ordernumber, l_partkey AS productcode, CAST(l_quantity AS INTEGER) AS quantityordered,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS priceeach, l_linenumber AS orderlinenumber
    FROM lineitem)"""

PRODUCTS = """(
    SELECT p_partkey AS productcode, p_name AS productname, p_type AS productline, p_brand AS productvendor,
           p_size * 100 AS quantityinstock,
           CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(50 + p_size AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2))
                AS DECIMAL(10,2)) AS buyprice,
           CAST(p_retailprice AS DECIMAL(10,2)) AS msrp,
           CAST(DATE '1997-12-28' + CAST(floor((p_size - 1) / 10) AS INTEGER) AS DATE) AS upddt
    FROM part)"""

EMPLOYEES = """(
    SELECT s_suppkey AS employeenumber, s_name AS email, s_nationkey AS officecode FROM supplier)"""

OFFICES = """(
    SELECT n_nationkey AS officecode, r_name AS territory, n_name AS city,
           CASE WHEN r_name <> 'ASIA' THEN n_name END AS state
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""

# Dated changes of employees: one per order of a customer.
CHANGES = """(
    SELECT o_custkey AS employeenumber, o_orderpriority AS jobtitle, o_orderstatus AS leaveflag,
           CAST(o_orderdate AS DATE) AS upddt, o_orderkey AS changenumber
    FROM orders)"""

# Stored versions of employees: one per customer, two in one segment, none in another.
HISTORY = """(
    SELECT c_custkey AS employeenumber, c_mktsegment AS jobtitle, 'N' AS leaveflag, DATE '1994-12-31' AS upddt,
           -c_custkey AS changenumber, ver
    FROM customer JOIN (VALUES (1), (2)) AS v(ver)
        ON ver <= CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 2 ELSE 1 END)"""

VISITS = """(
    SELECT CAST(floor(doc_id / 4) AS BIGINT) AS customernumber, text AS comments FROM documents)"""

NAVIGATION = """(
    SELECT user_id AS customernumber, CAST(ts AS DATE) AS visitday, event_type AS navigation_pg,
           row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS navigation_index
    FROM events)"""


# Employees with the day of their last change, for the daily load.
DATED_EMPLOYEES = """(
    SELECT s_suppkey AS employeenumber, s_name AS email, s_nationkey AS officecode,
           CAST(DATE '1997-12-28' + CAST(s_suppkey % 5 AS INTEGER) AS DATE) AS upddt
    FROM supplier)"""


class Tables:
    """The provided parquet tables of one scale, and their retail views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def new_database(self) -> str:
        """A fresh database in the shared folder, for queries that write tables."""
        name = f"tally_{uuid.uuid4().hex}"
        prepare_zones(self.spark, [name], [], session_dir(self.spark))
        return name

    @cached_property
    def dictionary(self) -> DataFrame:
        return self.spark.sql(DICTIONARY)

    @cached_property
    def customers(self) -> DataFrame:
        employees = self.read("supplier").agg(F.count("*")).scalar()
        rep = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey") % employees)
        return self.read("customer").select(
            F.col("c_custkey").alias("customernumber"),
            F.col("c_name").alias("customername"),
            F.col("c_nationkey").alias("country"),
            rep.alias("salesrepemployeenumber"),
            F.col("c_acctbal").cast("decimal(10,2)").alias("creditlimit"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_custkey").alias("customernumber"),
            F.col("o_orderkey").alias("checknumber"),
            F.col("o_orderdate").cast("date").alias("paymentdate"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        placed = F.col("o_orderdate").cast("date")
        return self.read("orders").select(
            F.col("o_orderkey").alias("ordernumber"),
            F.col("o_custkey").alias("customernumber"),
            placed.alias("orderdate"),
            F.when(F.col("o_orderstatus") != "O", placed).alias("shippeddate"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("comments"),
        )

    @cached_property
    def orderdetails(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("ordernumber"),
            F.col("l_partkey").alias("productcode"),
            F.col("l_quantity").cast("int").alias("quantityordered"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("priceeach"),
            F.col("l_linenumber").alias("orderlinenumber"),
        )

    @cached_property
    def products(self) -> DataFrame:
        msrp = F.col("p_retailprice").cast("decimal(10,2)")
        # Exact in decimal: MSRP times a whole percentage.
        percent = (50 + F.col("p_size")).cast("decimal(5,0)")
        buy = (msrp * percent * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")
        changed = F.date_add(F.lit("1997-12-28").cast("date"), F.floor((F.col("p_size") - 1) / 10).cast("int"))
        return self.read("part").select(
            F.col("p_partkey").alias("productcode"),
            F.col("p_name").alias("productname"),
            F.col("p_type").alias("productline"),
            F.col("p_brand").alias("productvendor"),
            (F.col("p_size") * 100).alias("quantityinstock"),
            buy.alias("buyprice"),
            msrp.alias("msrp"),
            changed.alias("upddt"),
        )

    @cached_property
    def employees(self) -> DataFrame:
        return self.read("supplier").select(
            F.col("s_suppkey").alias("employeenumber"),
            F.col("s_name").alias("email"),
            F.col("s_nationkey").alias("officecode"),
        )

    @cached_property
    def dated_employees(self) -> DataFrame:
        changed = F.date_add(F.lit("1997-12-28").cast("date"), (F.col("employeenumber") % 5).cast("int"))
        return self.employees.withColumn("upddt", changed)

    @cached_property
    def offices(self) -> DataFrame:
        nation = self.read("nation")
        return nation.join(self.read("region"), nation.n_regionkey == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("officecode"),
            F.col("r_name").alias("territory"),
            F.col("n_name").alias("city"),
            F.when(F.col("r_name") != "ASIA", F.col("n_name")).alias("state"),
        )

    @cached_property
    def changes(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_custkey").alias("employeenumber"),
            F.col("o_orderpriority").alias("jobtitle"),
            F.col("o_orderstatus").alias("leaveflag"),
            F.col("o_orderdate").cast("date").alias("upddt"),
            F.col("o_orderkey").alias("changenumber"),
        )

    @cached_property
    def history(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        versions = F.when(segment == "BUILDING", F.array().cast("array<int>")).when(
            segment == "MACHINERY", F.array(F.lit(1), F.lit(2))
        ).otherwise(F.array(F.lit(1)))
        return self.read("customer").select(
            F.col("c_custkey").alias("employeenumber"),
            F.col("c_mktsegment").alias("jobtitle"),
            F.lit("N").alias("leaveflag"),
            F.lit("1994-12-31").cast("date").alias("upddt"),
            (-F.col("c_custkey")).alias("changenumber"),
            F.explode(versions).alias("ver"),
        )

    @cached_property
    def visits(self) -> DataFrame:
        """Four documents are the comments of one customer."""
        return self.read("documents").select(
            F.floor(F.col("doc_id") / 4).alias("customernumber"), F.col("text").alias("comments")
        )

    @cached_property
    def paths(self) -> DataFrame:
        """Documents as visits: the words of the text are the pages of the path."""
        return self.read("documents").select("doc_id", F.split("text", " ").alias("pagevisit"))

    @cached_property
    def event_pages(self) -> DataFrame:
        """Events as pages: a visit is a user's day."""
        return self.read("events").select(
            F.col("user_id").alias("customernumber"),
            F.col("ts").cast("date").alias("visitday"),
            F.col("event_type").alias("navigation_pg"),
            "ts",
            "event_id",
        )
