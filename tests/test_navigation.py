from datetime import date

import pytest
from pyspark.sql import functions as F

from tallylake.operators.distinct import count_bitmaps, distinct_bitmaps, merge_bitmaps
from tallylake.operators.navigation import (
    array_item,
    event_funnel,
    explode_pages,
    first_last_of_visits,
    first_last_pages,
    index_events,
    page_transitions,
    path_funnel,
)
from tallylake.workspace import stage

VISITS = [
    ("c1", ["home", "cart", "order", "exit"]),
    ("c1", ["search", "exit"]),
    ("c2", ["home", "cart"]),
    ("c2", ["home", "home"]),
    ("c3", ["home"]),
    ("c4", []),
    ("c5", None),
]


@pytest.fixture
def visits(spark):
    return spark.createDataFrame(VISITS, "customernumber string, pagevisit array<string>")


def test_explode_counts_from_zero_and_skips_empty_paths(visits):
    out = explode_pages(visits, ["customernumber"])
    rows = sorted((r.customernumber, r.navigation_index, r.navigation_pg) for r in out.collect())
    assert len(rows) == sum(len(p or []) for _, p in VISITS)
    assert rows[:2] == [("c1", 0, "home"), ("c1", 0, "search")]


def test_item(visits):
    out = visits.select(array_item("pagevisit", 0).alias("a"), array_item("pagevisit", 9).alias("b")).collect()
    assert [r.a for r in out] == ["home", "search", "home", "home", "home", None, None]
    assert {r.b for r in out} == {None}


def report(df):
    return {(r.pagevisit, r[0]): r.custcnt for r in df.collect()}


EXPECTED = {
    ("first pagevisited", "home"): 3,
    ("first pagevisited", "search"): 1,
    ("last pagevisited", "exit"): 1,
    ("last pagevisited", "cart"): 1,
    ("last pagevisited", "home"): 2,
}


def test_first_and_last_pages_with_ties(visits):
    assert report(first_last_pages(explode_pages(visits, ["customernumber"]))) == EXPECTED


def test_customers_without_a_number(spark):
    rows = [(None, 0, "home"), (None, 1, "exit"), ("c1", 0, "home")]
    nav = spark.createDataFrame(rows, "customernumber string, navigation_index int, navigation_pg string")
    assert report(first_last_pages(nav)) == {("first pagevisited", "home"): 1, ("last pagevisited", "home"): 1}


@pytest.fixture
def events(spark):
    rows, at = [], 0
    for number, (customer, path) in enumerate(VISITS):
        for page in path or []:
            rows.append((customer, date(2024, 1, 1 + number), page, at))
            at += 1
    return spark.createDataFrame(rows[::-1], "customernumber string, visitday date, navigation_pg string, at int")


def test_the_same_report_from_events(events):
    out = first_last_of_visits(events, "customernumber", ["visitday"], ["at"], "navigation_pg")
    assert report(out) == EXPECTED


def test_falling_order_swaps_first_and_last(events):
    out = first_last_of_visits(events.drop("at").withColumn("at", F.lit(0)), "customernumber", ["visitday"], ["-at"], "navigation_pg")
    assert sum(r.custcnt for r in out.collect() if r.pagevisit == "first pagevisited") > 0
    rising = first_last_of_visits(events, "customernumber", ["visitday"], ["at"], "navigation_pg")
    falling = first_last_of_visits(events.withColumn("at", -F.col("at")), "customernumber", ["visitday"], ["-at"], "navigation_pg")
    assert report(rising) == report(falling)


def test_the_same_report_from_indexed_events(events):
    rows = index_events(events, ["customernumber", "visitday"], ["at"])
    assert report(first_last_pages(rows)) == EXPECTED


def test_transitions(visits):
    out = {(r.page, r.next_page): r.transitions for r in page_transitions(visits).collect()}
    assert out == {
        ("home", "cart"): 2, ("cart", "order"): 1, ("order", "exit"): 1, ("search", "exit"): 1, ("home", "home"): 1,
    }


def test_funnels(visits, events):
    by_path = {r.stage: r.visits for r in path_funnel(visits, "order", "cart").collect()}
    assert by_path == {"order": 1, "cart only": 1, "neither": 5}
    by_event = {r.stage: r.visits for r in event_funnel(events, ["customernumber", "visitday"], "navigation_pg", "order", "cart").collect()}
    assert by_event == {"order": 1, "cart only": 1, "neither": 3}


def test_distinct_counts_are_kept_over_days(spark):
    """Day two reads its own events and the stored bitmaps, none of day one's events."""
    rows = [("home", 1), ("home", 1), ("home", 40_000), ("home", None), ("cart", -5), ("none", None), (None, 7)]
    again = [("home", 1), ("home", 2), ("cart", -5), ("cart", 10**12)]
    days = [spark.createDataFrame(r, "page string, who bigint") for r in (rows, again)]
    kept = [stage(distinct_bitmaps(df, ["page"], "who"), f"bitmaps{i}") for i, df in enumerate(days)]
    merged = stage(merge_bitmaps(kept[0].unionByName(kept[1]), ["page"]), "merged")
    out = count_bitmaps(merged, ["page"], "n")
    whole = days[0].unionByName(days[1]).groupBy("page").agg(F.countDistinct("who").alias("n"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    read = count_bitmaps(kept[0].unionByName(distinct_bitmaps(days[1], ["page"], "who")), ["page"], "n")
    assert sorted(map(tuple, read.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert all("bitmaps0" in f for f in read.inputFiles()) and "Python" not in read._jdf.queryExecution().optimizedPlan().toString()


def test_rows_within_paths_stay_out_of_the_shuffle(spark):
    """Only first and last pages go on, by a broadcast of the highest positions; NULL customers and positions, ties and shuffled rows count as ever."""
    rows = [(f"c{i % 5}", k, f"p{i % 7}.{k % 50}") for i in range(20) for k in range(400)]
    rows += [(None, 0, "home"), (None, 9, "x"), ("c1", None, "y"), ("only", 3, "late"), ("tie", 2, "a"), ("tie", 2, "b"), ("below", -1, "z")]
    nav = spark.createDataFrame(rows, "customernumber string, navigation_index int, navigation_pg string").repartition(3)
    first, last = {}, {}
    top = {c: max(k for o, k, _ in rows if o == c and k is not None) for c, _, _ in rows}
    for c, k, page in rows:
        if k == 0:
            first.setdefault(page, set()).update({c} - {None})
        if c is not None and k == top[c]:
            last.setdefault(page, set()).add(c)
    wanted = {("first pagevisited", p): len(c) for p, c in first.items()} | {("last pagevisited", p): len(c) for p, c in last.items()}
    assert report(first_last_pages(nav)) == wanted
    plan = first_last_pages(nav)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "_top" in plan
