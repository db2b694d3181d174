"""One dated load: from source frames to dimensions, curated tables and marts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.functions.dates import day
from tallylake.operators.dimensions import scd2_current
from tallylake.operators.navigation import explode_pages, first_last_pages
from tallylake.plans import curated, dimensions, discovery
from tallylake.sinks.files import dated_path, write_json
from tallylake.sinks.loads import LoadLedger, rows_before, write_load
from tallylake.sinks.tables import (
    abandon_zones,
    build_zone,
    load_file_overwrite,
    prepare_zones,
    publish_snapshot,
    switch_zone,
    write_table,
    write_table_partitioned,
)
from tallylake.sources.tables import extract_since_mark, incremental_extract, read_table, read_table_if_exists
from tallylake.workspace import owned, stage


@dataclass(frozen=True)
class RetailSources:
    """Source frames, from files or databases.

    ``employee_order`` names columns that settle the order of an employee's changes of one
    day; without it a hash of the row does. ``customer_payments`` and ``order_lines`` come from ``curated`` (joined by
    Spark) or from ``extracts`` (joined by the database). ``visits`` holds
    customernumber, comments and pagevisit.
    """

    employees: DataFrame
    offices: DataFrame
    customer_payments: DataFrame
    order_lines: DataFrame
    products: DataFrame
    visits: DataFrame
    dictionary: DataFrame
    employee_order: tuple[str, ...] = ()


# The names of the databases here and of the tables below, which their readers know.
@dataclass(frozen=True)
class Zones:
    """Databases: ``dim`` is kept between loads; the other two show what the last complete load has built."""

    dim: str = "retail_dim"
    curated: str = "retail_curated"
    discovery: str = "retail_discovery"


@dataclass(frozen=True)
class DimensionRules:
    """How the kept dimensions are loaded.

    ``repeat`` loads parts again that the ledger holds for the date (their rows are replaced). With
    ``only_changed`` an employee gets a version only where a column differs. ``catch_up`` reads employees from
    the mark of the last complete load instead of the day before the load date, and late rows as many
    days back; so a day without a load loses nothing.
    """

    repeat: bool = False
    only_changed: bool = False
    catch_up: int | None = None


def run_day(
    spark: SparkSession,
    sources: RetailSources,
    as_of: date,
    report_prefix: str,
    zones: Zones = Zones(),
    location: str | None = None,
    export: Callable[[DataFrame], None] | None = None,
    rules: DimensionRules = DimensionRules(),
) -> None:
    """Load everything for ``as_of``.

    Each result is written once and read back where it is used again, so no
    plan is computed twice. The rebuilt zones are built beside the present ones and
    switched when they are complete; staged files are deleted at the end. ``export``
    receives the frustration table, for example to send it to a database.

    A run that has failed, or a second one for the same date, can simply be repeated while no later date is loaded: parts of
    the dimensions that are complete are left as they are, and an incomplete one begins from the dimension
    as it was. A failed run takes the zones away that it has begun.
    """
    prepare_zones(spark, [zones.dim], [], location)
    owner = f"{spark.sparkContext.applicationId}_{uuid.uuid4().hex[:8]}"
    try:
        beside = Zones(zones.dim, *(build_zone(spark, zone, location, owner) for zone in (zones.curated, zones.discovery)))
        with owned(spark):
            load_dimensions(spark, sources, as_of, beside, rules)
            load_curated(spark, sources, as_of, report_prefix, beside)
            load_discovery(spark, sources, as_of, beside)
        switch_zone(spark, zones.curated, beside.curated, location)
        switch_zone(spark, zones.discovery, beside.discovery, location)
    finally:
        for zone in (zones.curated, zones.discovery):
            abandon_zones(spark, zone, owner)
    if export is not None:
        export(read_table(spark, f"{zones.discovery}.cust_frustration_level"))


def load_dimensions(
    spark: SparkSession, sources: RetailSources, as_of: date, zones: Zones, rules: DimensionRules = DimensionRules()
) -> None:
    """The three parts of the kept zone; each is entered in the ledger once it is complete."""
    ledger = LoadLedger(spark, zones.dim)
    for part, load in (("employees", load_employees), ("offices", load_offices), ("products", load_products)):
        if rules.repeat or not ledger.holds(as_of, part):
            load(spark, sources, as_of, zones, rules)


def load_employees(spark: SparkSession, sources: RetailSources, as_of: date, zones: Zones, rules: DimensionRules) -> None:
    ledger = LoadLedger(spark, zones.dim)
    history = rows_before(spark, zones.dim, "hive_employees", as_of, "employees")
    mark = ledger.mark("employees", as_of)
    if rules.catch_up is None:
        changed = incremental_extract(sources.employees, "upddt", as_of)
    else:
        changed = extract_since_mark(sources.employees, "upddt", as_of, mark, rules.catch_up, history)
    # Staged once: the plans below read the changes several times, and must see the same.
    changed = stage(changed, "employees")
    versions = dimensions.employee_versions(changed, history, list(sources.employee_order), rules.only_changed)
    write_load(versions, zones.dim, "hive_employees", as_of, "employees")
    rows, latest = changed.agg(F.count("*"), F.max(F.least("upddt", day(as_of)))).first()
    ledger.commit(as_of, "employees", rows, max((d for d in (mark, latest) if d is not None), default=None))


def load_offices(spark: SparkSession, sources: RetailSources, as_of: date, zones: Zones, rules: DimensionRules) -> None:
    write_table(dimensions.office_dimension(sources.offices), f"{zones.dim}.offices_raw")
    LoadLedger(spark, zones.dim).commit(as_of, "offices", read_table(spark, f"{zones.dim}.offices_raw").count())


def load_products(spark: SparkSession, sources: RetailSources, as_of: date, zones: Zones, rules: DimensionRules) -> None:
    products = stage(incremental_extract(sources.products, "upddt", as_of, inclusive=True), "products")
    existing = read_table_if_exists(spark, zones.dim, "hive_products")
    merged = dimensions.product_dimension(products, existing, as_of, latest_by=["-upddt"])
    publish_snapshot(merged, zones.dim, "hive_products")
    LoadLedger(spark, zones.dim).commit(as_of, "products", products.count())


def load_curated(spark: SparkSession, sources: RetailSources, as_of: date, report_prefix: str, zones: Zones) -> None:
    load_payments(sources, zones)

    products = read_table(spark, f"{zones.dim}.hive_products")
    joined = curated.orders_products(products, sources.order_lines)
    write_table_partitioned(joined, f"{zones.curated}.ordersproducts", ["datadt"])

    load_pages(spark, sources, as_of, report_prefix, zones)


def load_payments(sources: RetailSources, zones: Zones) -> None:
    write_table_partitioned(sources.customer_payments, f"{zones.curated}.custpayments", ["datadt"])


def load_pages(spark: SparkSession, sources: RetailSources, as_of: date, report_prefix: str, zones: Zones) -> None:
    navigation_table = f"{zones.curated}.cust_navigation"
    write_table(explode_pages(sources.visits, ["customernumber"]), navigation_table, compression="zstd")
    report = first_last_pages(read_table(spark, navigation_table))
    write_json(report, dated_path(report_prefix, as_of), compacted=True)


def load_discovery(spark: SparkSession, sources: RetailSources, as_of: date, zones: Zones) -> None:
    load_rewards(spark, as_of, zones)
    load_frustration(spark, sources, zones)


def load_rewards(spark: SparkSession, as_of: date, zones: Zones) -> None:
    rewards = discovery.employee_rewards(
        read_table(spark, f"{zones.dim}.offices_raw"),
        scd2_current(read_table(spark, f"{zones.dim}.hive_employees"), ["employeenumber"]),
        read_table(spark, f"{zones.curated}.custpayments"),
        as_of=as_of,
        since=as_of,
    )
    write_table_partitioned(rewards, f"{zones.discovery}.employeerewards", ["datadt"])


def load_frustration(spark: SparkSession, sources: RetailSources, zones: Zones) -> None:
    load_file_overwrite(sources.dictionary, f"{zones.discovery}.dim_order_rate")
    frustration = discovery.customer_frustration(
        sources.visits.select("customernumber", "comments"), read_table(spark, f"{zones.discovery}.dim_order_rate")
    ).select(
        "customernumber",
        F.col("total_severity").cast("int").alias("total_severity"),
        F.col("customer_frustration_level").alias("frustration_level"),
    )
    write_table(frustration, f"{zones.discovery}.cust_frustration_level")
