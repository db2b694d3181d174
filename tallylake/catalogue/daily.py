"""The dated load over two days, one query per mart."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallylake.catalogue.discovery import CUSTOMER_PAYMENTS, FIRST_LAST, LEVEL, MATCHES
from tallylake.catalogue.registry import query
from tallylake.catalogue.relational import KPI_SQL
from tallylake.catalogue.retail import DATED_EMPLOYEES, OFFICES, Tables
from tallylake.plans import curated, daily
from tallylake.sinks.files import dated_path
from tallylake.sinks.tables import prepare_zones
from tallylake.sources.files import read_json
from tallylake.sources.tables import read_table
from tallylake.workspace import scratch_path, session_dir

DAYS = (date(1997, 12, 30), date(1998, 1, 1))


def _sources(t: Tables, day: date) -> daily.RetailSources:
    customer = F.floor(F.col("doc_id") / 4).cast("string").alias("customernumber")
    return daily.RetailSources(
        employees=t.dated_employees,
        offices=t.offices,
        customer_payments=curated.customer_payments(t.customers, t.payments, 1997, 7, as_of=day),
        order_lines=curated.order_lines(t.orders, t.orderdetails, 1997, 7, as_of=day),
        products=t.products,
        visits=t.read("documents").select(customer, F.col("text").alias("comments"), F.split("text", " ").alias("pagevisit")),
        dictionary=t.dictionary,
        employee_order=("employeenumber",),
    )


def _load(t: Tables, *parts: str) -> tuple[daily.Zones, str]:
    """Both days, with the named parts of the load only."""
    zones = daily.Zones(*(t.new_database() for _ in range(3)))
    report = scratch_path(t.spark, "report") + "_"
    for day in DAYS:
        sources = _sources(t, day)
        prepare_zones(t.spark, [zones.dim], [zones.curated, zones.discovery], session_dir(t.spark))
        if "dimensions" in parts:
            daily.load_dimensions(t.spark, sources, day, zones)
        if "payments" in parts:
            daily.load_payments(sources, zones)
        if "pages" in parts:
            daily.load_pages(t.spark, sources, day, report, zones)
        if "rewards" in parts:
            daily.load_rewards(t.spark, day, zones)
        if "frustration" in parts:
            daily.load_frustration(t.spark, sources, zones)
    return zones, report


STAFF = f"SELECT *, CAST(1 AS INTEGER) AS ver FROM {DATED_EMPLOYEES} WHERE upddt >= DATE '{DAYS[0]}'"


@query("daily_employees", f"{STAFF} UNION ALL SELECT *, CAST(2 AS INTEGER) AS ver FROM {DATED_EMPLOYEES} WHERE upddt >= DATE '{DAYS[1]}'")
def daily_employees(t: Tables):
    zones, _ = _load(t, "dimensions")
    return read_table(t.spark, f"{zones.dim}.hive_employees")


@query("daily_rerun", f"{STAFF} UNION ALL SELECT *, CAST(2 AS INTEGER) AS ver FROM {DATED_EMPLOYEES} WHERE upddt >= DATE '{DAYS[1]}'")
def daily_rerun(t: Tables):
    """Each day is broken off between two parts, run again, and then repeated as a whole; the rows are those of one run."""
    zones = daily.Zones(*(t.new_database() for _ in range(3)))
    for day in DAYS:
        sources = _sources(t, day)
        lost = t.offices.withColumn("state", F.raise_error(F.lit("the source is gone")))
        try:
            daily.load_dimensions(t.spark, replace(sources, offices=lost), day, zones)
        except PySparkException:
            daily.load_dimensions(t.spark, sources, day, zones)
        daily.load_dimensions(t.spark, sources, day, zones, daily.DimensionRules(repeat=True))
    return read_table(t.spark, f"{zones.dim}.hive_employees")


CAUGHT_UP = f"SELECT *, CAST(1 AS INTEGER) AS ver FROM {DATED_EMPLOYEES} WHERE upddt <= DATE '{DAYS[1]}'"


@query("daily_catch_up", CAUGHT_UP)
def daily_catch_up(t: Tables):
    """No load runs on the day between the two; the second one reads from the mark of the first, and only what changed."""
    zones = daily.Zones(*(t.new_database() for _ in range(3)))
    rules = daily.DimensionRules(only_changed=True, catch_up=2)
    for day in DAYS:
        daily.load_dimensions(t.spark, _sources(t, day), day, zones, rules)
    return read_table(t.spark, f"{zones.dim}.hive_employees")


@query("daily_products", f"SELECT * FROM ({KPI_SQL}) WHERE upddt >= DATE '{DAYS[0]}' - INTERVAL 1 DAY")
def daily_products(t: Tables):
    """The second day's products are among the first day's, and replace them."""
    zones, _ = _load(t, "dimensions")
    return read_table(t.spark, f"{zones.dim}.hive_products")


@query(
    "daily_rewards",
    f"""
    WITH paid AS (SELECT salesrepemployeenumber AS employeenumber, sum(amount) AS amount FROM ({CUSTOMER_PAYMENTS}) GROUP BY ALL),
    staff AS (SELECT employeenumber, email, state FROM ({STAFF}) JOIN {OFFICES} USING (officecode)),
    mailed AS (SELECT state, email, sum(amount) AS sumamt FROM staff JOIN paid USING (employeenumber) GROUP BY ALL),
    best AS (SELECT state, max(sumamt) AS sumamt FROM mailed GROUP BY state)
    SELECT email, m.sumamt, CAST(1 AS BIGINT) AS rnk, DATE '{DAYS[1]}' AS datadt
    FROM mailed m JOIN best b ON m.state IS NOT DISTINCT FROM b.state AND m.sumamt = b.sumamt
    """,
)
def daily_rewards(t: Tables):
    zones, _ = _load(t, "dimensions", "payments", "rewards")
    return read_table(t.spark, f"{zones.discovery}.employeerewards")


@query(
    "daily_frustration",
    f"""
    SELECT customernumber, total_severity, {LEVEL} AS frustration_level
    FROM (SELECT CAST(customernumber AS VARCHAR) AS customernumber, CAST(sum(severity) AS INTEGER) AS total_severity FROM {MATCHES} GROUP BY customernumber)
    """,
)
def daily_frustration(t: Tables):
    zones, _ = _load(t, "frustration")
    return read_table(t.spark, f"{zones.discovery}.cust_frustration_level")


PAGES = """(SELECT CAST(CAST(floor(doc_id / 4) AS BIGINT) AS VARCHAR) AS customernumber, CAST(i - 1 AS INTEGER) AS navigation_index, words[i] AS navigation_pg
    FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents), unnest(generate_series(1, len(words))) AS s(i))"""


@query("daily_pages", FIRST_LAST.format(nav=PAGES))
def daily_pages(t: Tables):
    """The report of the second day, read from its file."""
    _, report = _load(t, "pages")
    return read_json(t.spark, dated_path(report, DAYS[1]), "navigation_pg string, custcnt bigint, pagevisit string")
