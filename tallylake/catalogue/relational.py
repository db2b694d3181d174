"""Projection, cleansing, joins, aggregates, windows, limits and generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallylake.catalogue.registry import query
from tallylake.catalogue.retail import (
    AS_OF,
    CUSTOMERS,
    DICTIONARY,
    EMPLOYEES,
    HISTORY,
    NAVIGATION,
    OFFICES,
    ORDERDETAILS,
    ORDERS,
    PAYMENTS,
    PRODUCTS,
    VISITS,
    Tables,
)
from tallylake.functions.catalog import create_functions
from tallylake.functions.dates import day, in_months
from tallylake.functions.kpis import with_product_kpis
from tallylake.functions.levels import bucket
from tallylake.operators import navigation
from tallylake.operators.cleanse import munge as munge_rows
from tallylake.operators.grouping import rows_at_group_max, top_per_group
from tallylake.operators.grouping import top_n as first_n
from tallylake.operators.keywords import match_keywords, severity_per_customer
from tallylake.operators.layout import optimize_layout as lay_out
from tallylake.operators.numbering import number_rows, rank_rows
from tallylake.plans import curated

MONEY_TOTAL = "decimal(38,2)"

# --- projection and filters -------------------------------------------------


@query(
    "project_rename",
    f"SELECT customernumber, upper(customername) AS custname, country, salesrepemployeenumber AS rep FROM {CUSTOMERS}",
)
def project_rename(t: Tables):
    return t.customers.select(
        "customernumber", F.upper("customername").alias("custname"), "country", F.col("salesrepemployeenumber").alias("rep")
    )


KPI_SQL = f"""
    SELECT *, CAST(msrp - buyprice AS DECIMAL(10,2)) AS profit,
           CAST((msrp - buyprice) / buyprice * 100 AS DECIMAL(10,2)) AS profitpercent,
           CAST(CASE WHEN quantityinstock > 1500 AND (msrp - buyprice) / buyprice * 100 > 20 THEN 1 ELSE 0 END AS SMALLINT) AS promoind,
           CAST(CASE WHEN quantityinstock > 0 AND quantityinstock < 1500 AND (msrp - buyprice) / buyprice * 100 > 50
                THEN 1 ELSE 0 END AS SMALLINT) AS demandind
    FROM {PRODUCTS}
"""


@query("product_kpis", KPI_SQL)
def product_kpis(t: Tables):
    return with_product_kpis(t.products)


@query("product_kpis_sql", KPI_SQL)
def product_kpis_sql(t: Tables):
    """The indicators by a function that SQL text can call."""
    function, _ = create_functions(t.spark, t.new_database())
    return t.spark.sql(
        f"SELECT * EXCEPT (kpis), kpis.* FROM (SELECT *, {function}(buyprice, msrp, quantityinstock) AS kpis FROM {{products}})", products=t.products
    )


@query("struct_flatten", f"SELECT productcode, msrp, buyprice, CAST(msrp - buyprice AS DECIMAL(10,2)) AS gap FROM {PRODUCTS}")
def struct_flatten(t: Tables):
    gap = (F.col("msrp") - F.col("buyprice")).cast("decimal(10,2)").alias("gap")
    nested = t.products.select("productcode", F.struct("msrp", "buyprice", gap).alias("price"))
    return nested.select("productcode", "price.*")


@query("add_literal_column", f"SELECT *, CAST(1 AS INTEGER) AS ver, 'first load' AS reason FROM {EMPLOYEES}")
def add_literal_column(t: Tables):
    return t.employees.withColumns({"ver": F.lit(1), "reason": F.lit("first load")})


@query("stamp_load_date", f"SELECT *, DATE '{AS_OF}' AS datadt FROM {PAYMENTS}")
def stamp_load_date(t: Tables):
    return t.payments.withColumn("datadt", day(AS_OF))


@query("drop_column", f"SELECT ordernumber, customernumber, orderdate, shippeddate, status FROM {ORDERS}")
def drop_column(t: Tables):
    return t.orders.drop("comments")


@query("filter_year_month", f"SELECT * FROM {PAYMENTS} WHERE year(paymentdate) = 1997 AND month(paymentdate) >= 7")
def filter_year_month(t: Tables):
    return t.payments.filter(in_months(F.col("paymentdate"), 1997, 7))


@query("filter_since_date", f"SELECT * FROM {ORDERS} WHERE orderdate >= DATE '{AS_OF}'")
def filter_since_date(t: Tables):
    return t.orders.filter(F.col("orderdate") >= F.date_add(day(AS_OF), 0))


@query("filter_equals", f"SELECT * FROM {ORDERS} WHERE status = 'F'")
def filter_equals(t: Tables):
    return t.orders.filter(F.col("status") == "F")


@query(
    "case_bucket",
    """
    SELECT event_id, CASE WHEN value BETWEEN 0 AND 9.99 THEN 'low' WHEN value BETWEEN 10 AND 49.99 THEN 'middle'
                          WHEN value BETWEEN 50 AND 100 THEN 'high' ELSE 'unknown' END AS level
    FROM events
    """,
)
def case_bucket(t: Tables):
    ranges = ((0, 9.99, "low"), (10, 49.99, "middle"), (50, 100, "high"))
    return t.read("events").select("event_id", bucket(F.col("value"), ranges, "unknown").alias("level"))


# --- cleansing --------------------------------------------------------------

TWICE = "SELECT user_id, event_type, CAST(ts AS DATE) AS day, value FROM events"


@query("dedup", f"SELECT DISTINCT * FROM ({TWICE} UNION ALL {TWICE})")
def dedup(t: Tables):
    events = t.read("events").select("user_id", "event_type", F.col("ts").cast("date").alias("day"), "value")
    return munge_rows(events.unionByName(events), dedup=True)


LABELLED = "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _labelled(t: Tables):
    return t.read("documents").select("doc_id", "lang").join(t.read("labels"), "doc_id", "left")


@query("drop_null_rows_all", f"SELECT quality, toxic FROM ({LABELLED}) WHERE quality IS NOT NULL OR toxic IS NOT NULL")
def drop_null_rows_all(t: Tables):
    return munge_rows(_labelled(t).select("quality", "toxic"), drop_all_null=True)


@query("drop_null_rows_any", f"SELECT * FROM ({LABELLED}) WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def drop_null_rows_any(t: Tables):
    return munge_rows(_labelled(t), drop_any_null=True)


# Nulls in part of the subset: quality 0 counts as missing.
HALF_LABELLED = f"SELECT doc_id, lang, nullif(quality, 0) AS quality, toxic FROM ({LABELLED})"


def _half_labelled(t: Tables):
    return _labelled(t).withColumn("quality", F.nullif(F.col("quality"), F.lit(0)))


@query("drop_null_rows_subset_all", f"SELECT * FROM ({HALF_LABELLED}) WHERE quality IS NOT NULL OR toxic IS NOT NULL")
def drop_null_rows_subset_all(t: Tables):
    return munge_rows(_half_labelled(t), subset=["quality", "toxic"], drop_subset_all_null=True)


@query("drop_null_rows_subset_any", f"SELECT * FROM ({HALF_LABELLED}) WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def drop_null_rows_subset_any(t: Tables):
    return munge_rows(_half_labelled(t), subset=["quality", "toxic"], drop_subset_any_null=True)


@query(
    "munge",
    f"""
    SELECT DISTINCT * FROM (SELECT * FROM ({HALF_LABELLED}) UNION ALL SELECT * FROM ({HALF_LABELLED}))
    WHERE quality IS NOT NULL OR toxic IS NOT NULL
    """,
)
def munge(t: Tables):
    rows = _half_labelled(t)
    return munge_rows(
        rows.unionByName(rows), dedup=True, drop_all_null=True, subset=["quality", "toxic"], drop_subset_all_null=True
    )


# --- joins ------------------------------------------------------------------


@query(
    "join_customer_payments",
    f"""
    SELECT c.customernumber, c.customername, c.country, p.checknumber, p.paymentdate, p.amount
    FROM {CUSTOMERS} c JOIN {PAYMENTS} p ON c.customernumber = p.customernumber
        AND year(p.paymentdate) = 1997 AND month(p.paymentdate) >= 7
    """,
)
def join_customer_payments(t: Tables):
    paid = t.payments.filter(in_months(F.col("paymentdate"), 1997, 7))
    return t.customers.select("customernumber", "customername", "country").join(paid, "customernumber")


@query(
    "join_order_lines",
    f"""
    SELECT o.ordernumber, o.customernumber, o.orderdate, d.productcode, d.quantityordered, d.priceeach, d.orderlinenumber
    FROM {ORDERS} o JOIN {ORDERDETAILS} d ON o.ordernumber = d.ordernumber
        AND year(o.orderdate) = 1997 AND month(o.orderdate) >= 7
    """,
)
def join_order_lines(t: Tables):
    placed = t.orders.filter(in_months(F.col("orderdate"), 1997, 7)).select("ordernumber", "customernumber", "orderdate")
    return placed.join(t.orderdetails, "ordernumber")


@query(
    "join_order_lines_products",
    f"""
    SELECT customernumber, ordernumber, orderdate, shippeddate, status, comments, quantityordered, priceeach, orderlinenumber,
           productcode, productname, productline, CAST(NULL AS VARCHAR) AS productscale, productvendor,
           CAST(NULL AS VARCHAR) AS productdescription, quantityinstock, buyprice, msrp
    FROM {PRODUCTS} JOIN {ORDERDETAILS} USING (productcode) JOIN {ORDERS} USING (ordernumber)
    WHERE orderdate BETWEEN DATE '1997-10-01' AND DATE '1997-10-31'
    """,
)
def join_order_lines_products(t: Tables):
    """All eighteen columns; the tables hold neither scale nor description of a product."""
    return curated.order_line_products(t.orders, t.orderdetails, t.products, 1997, 10, 10)


@query(
    "lookup_left_join",
    f"""
    SELECT c.customernumber, c.customername, h.max_ver
    FROM {CUSTOMERS} c LEFT JOIN (SELECT employeenumber, max(ver) AS max_ver FROM {HISTORY} GROUP BY employeenumber) h
        ON c.customernumber = h.employeenumber
    """,
)
def lookup_left_join(t: Tables):
    highest = t.history.groupBy(F.col("employeenumber").alias("customernumber")).agg(F.max("ver").alias("max_ver"))
    return t.customers.select("customernumber", "customername").join(highest, "customernumber", "left")


@query(
    "join_products_orders",
    f"""
    SELECT p.productcode, p.productname, p.productline, p.msrp, d.ordernumber, d.quantityordered, d.priceeach, d.orderlinenumber,
           o.customernumber, o.orderdate
    FROM {PRODUCTS} p JOIN {ORDERDETAILS} d ON p.productcode = d.productcode JOIN {ORDERS} o ON d.ordernumber = o.ordernumber
    """,
)
def join_products_orders(t: Tables):
    lines = t.orderdetails.join(t.orders.select("ordernumber", "customernumber", "orderdate"), "ordernumber")
    return curated.orders_products(t.products.select("productcode", "productname", "productline", "msrp"), lines)


@query(
    "self_join_on_max",
    f"""
    SELECT customernumber, visitday, navigation_index, navigation_pg
    FROM (SELECT *, max(navigation_index) OVER (PARTITION BY customernumber) AS top FROM {NAVIGATION})
    WHERE navigation_index = top AND customernumber IS NOT NULL
    """,
)
def self_join_on_max(t: Tables):
    rows = navigation.index_events(t.event_pages, ["customernumber", "visitday"], ["ts", "event_id"]).drop("ts", "event_id")
    return rows_at_group_max(rows, ["customernumber"], "navigation_index")


@query(
    "join_three_way_star",
    f"""
    SELECT o.state, o.city, e.employeenumber, e.email, c.customernumber, c.customername
    FROM {OFFICES} o JOIN {EMPLOYEES} e ON o.officecode = e.officecode
    JOIN {CUSTOMERS} c ON e.employeenumber = c.salesrepemployeenumber
    """,
)
def join_three_way_star(t: Tables):
    customers = t.customers.select("customernumber", "customername", F.col("salesrepemployeenumber").alias("employeenumber"))
    staff = t.employees.join(t.offices.select("officecode", "state", "city"), "officecode").drop("officecode")
    return customers.join(staff, "employeenumber")


@query(
    "like_join",
    f"""
    SELECT v.customernumber, r.rid, r.orddesc, r.severity
    FROM (SELECT CAST(floor(doc_id / 4) AS BIGINT) AS customernumber, text AS comments FROM documents) v
    JOIN {DICTIONARY} r ON v.comments LIKE concat('%', r.orddesc, '%')
    """,
)
def like_join(t: Tables):
    return match_keywords(t.visits, t.dictionary).select("customernumber", "rid", "orddesc", "severity")


@query(
    "like_join_large",
    f"""
    SELECT w.orddesc, count(*) AS texts, count(DISTINCT v.customernumber) AS customers
    FROM {VISITS} v
    JOIN (SELECT DISTINCT unnest(string_split(text, ' ')) AS orddesc FROM benchmark) w ON contains(v.comments, w.orddesc)
    WHERE w.orddesc <> '' GROUP BY w.orddesc
    """,
)
def like_join_large(t: Tables):
    """Every word of the benchmark texts as a keyword: the way of a dictionary too large for one value."""
    words = t.read("benchmark").select(F.explode(F.split("text", " ")).alias("orddesc"))
    words = words.filter(F.col("orddesc") != "").distinct()
    return (
        match_keywords(t.visits, words, literal=True, small_entries=100)
        .groupBy("orddesc")
        .agg(F.count("*").alias("texts"), F.countDistinct("customernumber").alias("customers"))
    )


# Keywords with wildcards and with a backslash.
PATTERNS = r"(SELECT * FROM (VALUES (1, 'th_ %ing '), (2, '_nd the'), (3, 'a\b'), (4, 'ung%ung%ver'), (5, '%'), (6, 'zz_zz')) AS d(rid, orddesc))"


@query(
    "like_join_wildcards",
    f"""
    SELECT r.rid, count(*) AS texts, count(DISTINCT v.customernumber) AS customers
    FROM {VISITS} v JOIN {PATTERNS} r ON v.comments LIKE concat('%', r.orddesc, '%') GROUP BY r.rid
    """,
)
def like_join_wildcards(t: Tables):
    patterns = t.spark.sql(PATTERNS.replace("\\", "\\\\"))
    matched = match_keywords(t.visits, patterns, small_entries=3)
    return matched.groupBy("rid").agg(F.count("*").alias("texts"), F.countDistinct("customernumber").alias("customers"))


# --- aggregates -------------------------------------------------------------


@query("group_max", "SELECT l_suppkey, max(l_linenumber) AS max_line FROM lineitem GROUP BY l_suppkey")
def group_max(t: Tables):
    return t.read("lineitem").groupBy("l_suppkey").agg(F.max("l_linenumber").alias("max_line"))


@query(
    "group_sum_decimal",
    f"""
    SELECT status, comments, sum(amount) AS sumamt
    FROM {ORDERS} o JOIN {PAYMENTS} p ON ordernumber = checknumber GROUP BY status, comments
    """,
)
def group_sum_decimal(t: Tables):
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    return (
        t.read("orders")
        .groupBy(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("comments"))
        .agg(F.sum(amount).cast(MONEY_TOTAL).alias("sumamt"))
    )


@query(
    "group_sum_int",
    f"""
    SELECT customernumber, CAST(sum(severity) AS BIGINT) AS total_severity
    FROM {VISITS} v JOIN {DICTIONARY} r ON v.comments LIKE concat('%', r.orddesc, '%') GROUP BY customernumber
    """,
)
def group_sum_int(t: Tables):
    return severity_per_customer(match_keywords(t.visits, t.dictionary), "customernumber")


@query("group_count_distinct", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def group_count_distinct(t: Tables):
    return t.read("events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))


@query("count_rows", "SELECT count(*) AS row_count FROM lineitem")
def count_rows(t: Tables):
    return t.read("lineitem").agg(F.count("*").alias("row_count"))


# --- windows, limits --------------------------------------------------------

PAID_PER_NATION = f"""
    SELECT c.country, c.customernumber, sum(p.amount) AS paid
    FROM {CUSTOMERS} c JOIN {PAYMENTS} p ON c.customernumber = p.customernumber GROUP BY c.country, c.customernumber
"""


def _paid_per_nation(t: Tables):
    paid = t.payments.groupBy("customernumber").agg(F.sum("amount").cast(MONEY_TOTAL).alias("paid"))
    return t.customers.select("country", "customernumber").join(paid, "customernumber")


@query("rank_per_group", f"SELECT *, rank() OVER (PARTITION BY country ORDER BY paid DESC) AS rnk FROM ({PAID_PER_NATION})")
def rank_per_group(t: Tables):
    return rank_rows(_paid_per_nation(t), ["country"], ["-paid"])


@query(
    "rank_with_ties",
    """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity,
           rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS rnk, l_returnflag
    FROM lineitem
    """,
)
def rank_with_ties(t: Tables):
    """Three groups and fifty values: nearly all rows are ties."""
    lines = t.read("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return rank_rows(lines, ["l_returnflag"], ["-l_quantity"])


@query(
    "row_number_versioning",
    f"""
    SELECT o.customernumber, o.ordernumber,
           row_number() OVER (PARTITION BY o.customernumber ORDER BY o.orderdate, o.ordernumber) + coalesce(h.max_ver, 0) AS ver
    FROM {ORDERS} o LEFT JOIN (SELECT employeenumber, max(ver) AS max_ver FROM {HISTORY} GROUP BY employeenumber) h
        ON o.customernumber = h.employeenumber
    """,
)
def row_number_versioning(t: Tables):
    orders = t.orders.select("customernumber", "ordernumber", "orderdate")
    highest = t.history.groupBy(F.col("employeenumber").alias("customernumber")).agg(F.max("ver").alias("ver"))
    numbered = number_rows(orders, ["customernumber"], ["orderdate", "ordernumber"], "ver", start_after=highest)
    return numbered.select("customernumber", "ordernumber", "ver")


@query(
    "row_number_global",
    "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS rno FROM orders",
)
def row_number_global(t: Tables):
    """A number over the whole table, without bringing it into one partition."""
    orders = t.read("orders").select("o_orderkey", "o_orderdate")
    return number_rows(orders, [], ["-o_orderdate", "o_orderkey"], "rno")


@query(
    "top1_per_group",
    f"""
    SELECT * FROM (SELECT *, rank() OVER (PARTITION BY country ORDER BY paid DESC) AS rnk FROM ({PAID_PER_NATION}))
    WHERE rnk = 1
    """,
)
def top1_per_group(t: Tables):
    return top_per_group(_paid_per_nation(t), ["country"], ["-paid"], n=1)


@query("top_n", f"SELECT * FROM {PAYMENTS} ORDER BY amount DESC, checknumber LIMIT 25")
def top_n(t: Tables):
    return first_n(t.payments, ["-amount", "checknumber"], 25)


@query(
    "scalar_lookup",
    f"SELECT checknumber, amount, amount - (SELECT max(amount) FROM {PAYMENTS}) AS below_largest FROM {PAYMENTS}",
)
def scalar_lookup(t: Tables):
    largest = t.payments.agg(F.max("amount")).scalar()
    return t.payments.select("checknumber", "amount", (F.col("amount") - largest).alias("below_largest"))


# --- set operations and generators ------------------------------------------


@query(
    "union_all",
    """
    SELECT o_custkey AS k, 'order' AS side FROM orders
    UNION ALL SELECT c_custkey AS k, 'customer' AS side FROM customer
    """,
)
def union_all(t: Tables):
    ordered = t.read("orders").select(F.col("o_custkey").alias("k"), F.lit("order").alias("side"))
    return ordered.unionByName(t.read("customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("side")))


@query(
    "posexplode_pages",
    """
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS navigation_index, words[i] AS navigation_pg
    FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents), unnest(generate_series(1, len(words))) AS s(i)
    """,
)
def posexplode_pages(t: Tables):
    return navigation.explode_pages(t.paths, ["doc_id"])


@query(
    "array_item",
    "SELECT doc_id, string_split(text, ' ')[1] AS first_page, string_split(text, ' ')[1001] AS page_1000 FROM documents",
)
def array_item(t: Tables):
    return t.paths.select(
        "doc_id",
        navigation.array_item("pagevisit", 0).alias("first_page"),
        navigation.array_item("pagevisit", 1000).alias("page_1000"),
    )


# --- scalar functions and layout --------------------------------------------


@query(
    "scalar_upper_date_format",
    """
    SELECT o_orderkey, upper(o_orderpriority) AS priority, CAST(year(o_orderdate) AS INTEGER) AS y,
           CAST(month(o_orderdate) AS INTEGER) AS m, strftime(o_orderdate, '%Y%m%d') AS ymd,
           CAST(CAST(o_orderdate AS DATE) + 0 AS DATE) AS same_day, CAST(CAST(o_orderdate AS DATE) - 1 AS DATE) AS day_before
    FROM orders
    """,
)
def scalar_upper_date_format(t: Tables):
    day_of = F.col("o_orderdate").cast("date")
    return t.read("orders").select(
        "o_orderkey",
        F.upper("o_orderpriority").alias("priority"),
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"),
        F.date_format(day_of, "yyyyMMdd").alias("ymd"),
        F.date_add(day_of, 0).alias("same_day"),
        F.date_sub(day_of, 1).alias("day_before"),
    )


@query(
    "scalar_concat_coalesce_case",
    f"""
    SELECT customernumber, '%' || customername || '%' AS pattern, coalesce(salesrepemployeenumber, 0) AS rep,
           CASE WHEN creditlimit BETWEEN 0 AND 5000 THEN 'small' WHEN creditlimit > 5000 THEN 'large' ELSE 'none' END AS credit
    FROM {CUSTOMERS}
    """,
)
def scalar_concat_coalesce_case(t: Tables):
    limit = F.col("creditlimit")
    return t.customers.select(
        "customernumber",
        F.concat(F.lit("%"), "customername", F.lit("%")).alias("pattern"),
        F.coalesce("salesrepemployeenumber", F.lit(0)).alias("rep"),
        F.when(limit.between(0, 5000), "small").when(limit > 5000, "large").otherwise("none").alias("credit"),
    )


@query("optimize_layout", f"SELECT * FROM {PAYMENTS}")
def optimize_layout(t: Tables):
    return lay_out(t.payments, by=["customernumber", "checknumber"])
