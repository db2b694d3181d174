from dataclasses import replace
from datetime import date
from decimal import Decimal as D

import pytest

from tallylake.plans import curated
from tallylake.plans.daily import DimensionRules, RetailSources, Zones, run_day
from tallylake.sinks.loads import LoadLedger
from tallylake.sinks.tables import abandon_zones, build_zone, switch_zone, write_table, zone_builds
from tallylake.sources.files import read_json
from tallylake.sources.tables import read_table
from tallylake.workspace import session_dir, shared_dir

DAY = date(2022, 11, 1)
NEXT = date(2022, 11, 2)


def sources(spark, day):
    make = spark.createDataFrame
    return RetailSources(
        employees=make(
            [(1, "ann@x", "1", day), (2, "bob@x", "1", day), (3, "old@x", "1", date(2020, 1, 1))],
            "employeenumber int, email string, officecode string, upddt date",
        ),
        offices=make([("1", "CA"), ("1", "CA")], "officecode string, state string"),
        customer_payments=curated.customer_payments(
            make(
                [(10, "Larch", "USA", 1, D("5.00")), (11, "Rowan", "France", 2, D("6.00"))],
                "customernumber int, customername string, country string, salesrepemployeenumber int, creditlimit decimal(10,2)",
            ),
            make(
                [(10, "A", date(2022, 10, 3), D("8.00")), (11, "B", date(2022, 10, 4), D("3.00"))],
                "customernumber int, checknumber string, paymentdate date, amount decimal(10,2)",
            ),
            2022, 7, as_of=day,
        ),
        order_lines=curated.order_lines(
            make(
                [(100, 10, date(2022, 10, 1), None, "Shipped", None)],
                "ordernumber int, customernumber int, orderdate date, shippeddate date, status string, comments string",
            ),
            make(
                [(100, "p1", 3, D("2.50"), 1)],
                "ordernumber int, productcode string, quantityordered int, priceeach decimal(10,2), orderlinenumber int",
            ),
            2022, 7, as_of=day,
        ),
        products=make(
            [("p1", 2000, D("10.00"), D("20.00"), day), ("p2", 10, D("1.00"), D("9.00"), DAY)],
            "productcode string, quantityinstock int, buyprice decimal(10,2), msrp decimal(10,2), upddt date",
        ),
        visits=make(
            [("10", "such a muddle", ["home", "exit"]), ("11", "all fine", ["home", "cart"])],
            "customernumber string, comments string, pagevisit array<string>",
        ),
        dictionary=make([(1, "muddle", "cust", -4, "complaint")], "rid int, orddesc string, comp_cust string, severity int, intent string"),
    )


def test_two_days(spark):
    base = f"{shared_dir(spark)}/daily"
    zones = Zones("day_dim", "day_curated", "day_discovery")
    exported = []
    for day in (DAY, NEXT):
        run_day(spark, sources(spark, day), day, f"{base}/first_last_page", zones, base, export=exported.append)

    def rows(name, *columns):
        return sorted(tuple(r) for r in read_table(spark, name).select(*(columns or "*")).collect())

    assert rows("day_dim.hive_employees", "employeenumber", "ver") == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert rows("day_dim.offices_raw", "officecode") == [("1",)]
    assert rows("day_dim.hive_products", "productcode", "promoind", "demandind") == [("p1", 1, 0), ("p2", 0, 1)]
    assert rows("day_curated.custpayments", "custname", "datadt") == [("LARCH", NEXT), ("ROWAN", NEXT)]
    assert rows("day_curated.ordersproducts", "ordernumber", "productcode", "promoind") == [(100, "p1", 1)]
    assert rows("day_discovery.employeerewards", "email", "sumamt", "rnk") == [("ann@x", D("8.00"), 1)]
    assert rows("day_discovery.cust_frustration_level") == [("10", -4, "highly frustrated")]
    assert len(exported) == 2 and exported[1].count() == 1
    for suffix in ("20221101", "20221102"):
        report = read_json(spark, f"{base}/first_last_page{suffix}", "navigation_pg string, custcnt bigint, pagevisit string")
        assert sorted((r.pagevisit, r.navigation_pg, r.custcnt) for r in report.collect()) == [
            ("first pagevisited", "home", 2), ("last pagevisited", "cart", 1), ("last pagevisited", "exit", 1),
        ]


def files_below(spark, path):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.listFiles(target, True)
    names = []
    while found.hasNext():
        names.append(found.next().getPath().toString())
    return names


def test_staged_files_go_with_the_load(spark):
    base = f"{shared_dir(spark)}/daily_clean"
    before = set(files_below(spark, session_dir(spark))) if exists(spark, session_dir(spark)) else set()
    run_day(spark, sources(spark, DAY), DAY, f"{base}/pages", Zones("clean_dim", "clean_curated", "clean_discovery"), base)
    after = set(files_below(spark, session_dir(spark))) if exists(spark, session_dir(spark)) else set()
    assert after <= before


def exists(spark, path):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def test_a_failed_load_leaves_the_zones_as_they_were(spark):
    base = f"{shared_dir(spark)}/daily_fails"
    zones = Zones("fail_dim", "fail_curated", "fail_discovery")
    run_day(spark, sources(spark, DAY), DAY, f"{base}/pages", zones, base)
    broken = replace(sources(spark, NEXT), dictionary=spark.sql("SELECT 1 AS rid, raise_error('lost') AS orddesc, 1 AS severity"))
    with pytest.raises(Exception, match="lost"):
        run_day(spark, broken, NEXT, f"{base}/pages", zones, base)
    assert {r.datadt for r in read_table(spark, "fail_curated.custpayments").collect()} == {DAY}
    assert read_table(spark, "fail_discovery.cust_frustration_level").count() == 1
    run_day(spark, sources(spark, NEXT), NEXT, f"{base}/pages", zones, base)
    assert {r.datadt for r in read_table(spark, "fail_curated.custpayments").collect()} == {NEXT}
    # The present contents and the former ones; what the failed load had begun is gone.
    assert {marks["load_state"] for marks in zone_builds(spark, "fail_curated").values()} == {"finished"}
    assert len(zone_builds(spark, "fail_curated")) == 2


def dimension_rows(spark, dim):
    staff = sorted((r.employeenumber, r.upddt, r.ver) for r in read_table(spark, f"{dim}.hive_employees").collect())
    return staff, sorted(r.productcode for r in read_table(spark, f"{dim}.hive_products").collect())


def test_a_day_run_twice_or_broken_off_gives_the_rows_of_one_run(spark):
    base = f"{shared_dir(spark)}/daily_again"
    once, again = Zones("once_dim", "once_curated", "once_discovery"), Zones("again_dim", "again_curated", "again_discovery")
    for day in (DAY, NEXT):
        run_day(spark, sources(spark, day), day, f"{base}/once", once, base)
        broken = replace(sources(spark, day), products=spark.sql("SELECT raise_error('lost') AS productcode, current_date() AS upddt"))
        with pytest.raises(Exception):
            run_day(spark, broken, day, f"{base}/again", again, base)
        assert LoadLedger(spark, "again_dim").holds(day, "offices") and not LoadLedger(spark, "again_dim").holds(day, "products")
        run_day(spark, sources(spark, day), day, f"{base}/again", again, base)
        run_day(spark, sources(spark, day), day, f"{base}/again", again, base)
        run_day(spark, sources(spark, day), day, f"{base}/again", again, base, rules=DimensionRules(repeat=True))
        assert dimension_rows(spark, "again_dim") == dimension_rows(spark, "once_dim")
    with pytest.raises(ValueError, match="rest on it"):
        run_day(spark, sources(spark, DAY), DAY, f"{base}/again", again, base, rules=DimensionRules(repeat=True))


def test_a_skipped_day_is_caught_up_with(spark):
    base = f"{shared_dir(spark)}/daily_skip"
    zones = Zones("skip_dim", "skip_curated", "skip_discovery")
    rules = DimensionRules(only_changed=True, catch_up=3)
    schema = "employeenumber int, email string, officecode string, upddt date"
    first = [(1, "ann@x", "1", date(2022, 10, 31)), (2, "bob@x", "1", DAY)]
    later = [*first, (1, "ann@y", "1", date(2022, 11, 2)), (2, "bob@x", "1", date(2022, 11, 3)), (3, "late@x", "1", date(2022, 10, 31))]
    for day, rows in ((DAY, first), (date(2022, 11, 3), later)):
        staff = replace(sources(spark, day), employees=spark.createDataFrame(rows, schema))
        run_day(spark, staff, day, f"{base}/pages", zones, base, rules=rules)
    found = sorted((r.employeenumber, r.email, r.ver) for r in read_table(spark, "skip_dim.hive_employees").collect())
    assert found == [(1, "ann@x", 1), (1, "ann@y", 2), (2, "bob@x", 1), (3, "late@x", 1)]
    assert LoadLedger(spark, "skip_dim").mark("employees", date(2022, 11, 4)) == date(2022, 11, 3)


def test_two_loads_at_once_and_a_reader_across_the_switch(spark):
    base = f"{shared_dir(spark)}/two_loads"
    one, two = (build_zone(spark, "two_zone", base, owner) for owner in ("first", "second"))
    write_table(spark.range(1), f"{one}.t")
    write_table(spark.range(2), f"{two}.t")
    switch_zone(spark, "two_zone", one, base)
    assert two in zone_builds(spark, "two_zone") and read_table(spark, "two_zone.t").count() == 1
    reader = read_table(spark, "two_zone.t")
    switch_zone(spark, "two_zone", two, base)
    assert reader.count() == 1 and read_table(spark, "two_zone.t").count() == 2
    third = build_zone(spark, "two_zone", base, "third")
    abandon_zones(spark, "two_zone", "second")
    write_table(spark.range(3), f"{third}.t")
    switch_zone(spark, "two_zone", third, base)
    assert set(zone_builds(spark, "two_zone")) == {two, third} and read_table(spark, "two_zone.t").count() == 3
    build_zone(spark, "two_zone", base, "third")
    abandon_zones(spark, "two_zone", "third")
    assert set(zone_builds(spark, "two_zone")) == {two, third}
