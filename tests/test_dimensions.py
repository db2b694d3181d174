from datetime import date

import pytest
from pyspark.sql import functions as F

from tallylake.operators.dimensions import (
    merge_match,
    scd1_merge,
    scd2_append_versions,
    scd2_current,
    scd2_initial_load,
    unique_or_fail,
)
from tallylake.operators.grouping import rows_at_group_max, top_n, top_per_group
from tallylake.plans.dimensions import employee_dimension, office_dimension, product_dimension
from tallylake.sinks.buckets import merge_buckets, with_bucket
from tallylake.sinks.tables import folders_below, partition_locations, prepare_zones, snapshot_tables
from tallylake.workspace import scratch_path, shared_dir

HISTORY = "employeenumber int, title string, upddt date, ver int"
CHANGES = "employeenumber int, title string, upddt date"


def d(day):
    return date(2024, 1, day)


@pytest.fixture
def history(spark):
    return spark.createDataFrame([(1, "rep", d(1), 1), (1, "lead", d(2), 2), (2, "rep", d(1), 1)], HISTORY)


@pytest.fixture
def changes(spark):
    return spark.createDataFrame(
        [(1, "boss", d(9), ), (1, "vp", d(10)), (3, "new", d(9)), (2, "rep", d(9))], CHANGES
    )


def versions(df):
    return sorted(((r.employeenumber, r.title, r.ver) for r in df.collect()), key=lambda r: (r[0], str(r[1])))


def test_versions_continue_per_key(history, changes):
    out = scd2_append_versions(history, changes, ["employeenumber"], ["upddt"])
    assert versions(out) == [(1, "boss", 3), (1, "vp", 4), (2, "rep", 2), (3, "new", 1)]
    assert out.dtypes[-1] == ("ver", "int")


def test_null_keys_start_anew(spark, history):
    old = history.unionByName(spark.createDataFrame([(None, "x", d(1), 5)], HISTORY))
    batch = spark.createDataFrame([(None, "y", d(2))], CHANGES)
    out = scd2_append_versions(old, batch, ["employeenumber"], ["upddt"])
    assert [r.ver for r in out.collect()] == [1]


def test_versions_have_no_gaps_and_history_is_untouched(history, changes):
    appended = scd2_append_versions(history, changes, ["employeenumber"], ["upddt"])
    whole = history.unionByName(appended)
    seen = {}
    for r in whole.collect():
        seen.setdefault(r.employeenumber, []).append(r.ver)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in seen.values())
    assert whole.intersect(history).count() == history.count()


def test_tie_on_date_is_broken_by_the_next_column(spark):
    changes = spark.createDataFrame([(1, "b", d(1)), (1, "a", d(1))], CHANGES)
    assert versions(scd2_initial_load(changes, ["employeenumber"], ["upddt", "title"])) == [(1, "a", 1), (1, "b", 2)]


def test_empty_history_is_an_initial_load(spark, changes):
    empty = spark.createDataFrame([], HISTORY)
    first = versions(scd2_append_versions(empty, changes, ["employeenumber"], ["upddt"]))
    assert first == versions(scd2_append_versions(None, changes, ["employeenumber"], ["upddt"]))
    assert first[0] == (1, "boss", 1)


def test_hot_key_versions(spark):
    history = spark.createDataFrame([(0, "x", d(1), v) for v in range(1, 6)], HISTORY)
    rows = [(0 if i % 3 == 0 else i, f"t{i:04d}", d(1 + i % 28)) for i in range(900)]
    out = scd2_append_versions(
        history, spark.createDataFrame(rows, CHANGES), ["employeenumber"], ["upddt", "title"]
    )
    hot = sorted(r.ver for r in out.collect() if r.employeenumber == 0)
    assert hot == list(range(6, 306)) and out.count() == 900


def test_only_changes_become_versions(spark, history):
    """A to A, A to B to A, NULLs, and several changes of one day."""
    rows = [(1, "lead", d(9)), (1, "lead", d(10)), (2, "boss", d(9)), (2, "boss", d(9)), (2, "rep", d(10)), (3, None, d(9)), (3, None, d(10)), (3, "x", d(11)), (3, None, d(11))]
    changes = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], CHANGES + ", seq int")
    past = history.select("*").unionByName(spark.createDataFrame([(3, None, d(1), 7)], HISTORY))
    out = scd2_append_versions(past, changes, ["employeenumber"], ["upddt", "seq"], only_changed=True)
    assert versions(out) == [(2, "boss", 2), (2, "rep", 3), (3, None, 9), (3, "x", 8)]
    assert out.columns == [*changes.columns, "ver"] and out.dtypes[-1] == ("ver", "int")


def test_an_unchanged_batch_appends_nothing(spark, history, changes):
    how = {"only_changed": True, "tracked": ["title"]}
    first = scd2_append_versions(history, changes, ["employeenumber"], ["upddt"], **how)
    assert versions(first) == [(1, "boss", 3), (1, "vp", 4), (3, "new", 1)]
    whole = history.unionByName(first)
    latest = changes.filter("NOT (employeenumber = 1 AND title = 'boss')")
    assert scd2_append_versions(whole, latest, ["employeenumber"], ["upddt"], **how).count() == 0


@pytest.mark.parametrize("stored", [True, False])
def test_only_changed_without_history_and_null_keys(spark, stored):
    batch = spark.createDataFrame([(None, "y", d(2)), (None, "y", d(3)), (1, "a", d(2))], CHANGES)
    history = spark.createDataFrame([(None, "y", d(1), 5)], HISTORY) if stored else None
    out = scd2_append_versions(history, batch, ["employeenumber"], ["upddt"], only_changed=True)
    assert [(r.employeenumber, r.title, r.ver) for r in out.orderBy("title").collect()] == [(1, "a", 1), (None, "y", 1)]


def test_current_version(history):
    assert versions(scd2_current(history, ["employeenumber"])) == [(1, "lead", 2), (2, "rep", 1)]


def test_employee_dimension_takes_the_load_date_only_and_drops_copies(spark, history):
    source = spark.createDataFrame(
        [(1, "boss", d(10)), (1, "boss", d(10)), (2, "late", d(9)), (None, None, None)], CHANGES
    )
    assert versions(employee_dimension(source, history, d(10))) == [(1, "boss", 3)]


def test_office_dimension(spark):
    offices = spark.createDataFrame([(1, "CA"), (1, "CA"), (None, None), (2, None)], "officecode int, state string")
    assert sorted(tuple(r) for r in office_dimension(offices).collect()) == [(1, "CA"), (2, None)]


PRODUCT = "code string, price int, upddt date"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, d(1)), ("b", 2, d(1)), (None, 9, d(1))], PRODUCT)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_updates_inserts_and_keeps(spark, target):
    batch = spark.createDataFrame([("b", 20, d(2)), ("c", 30, d(2)), (None, 90, d(2))], PRODUCT)
    merged = scd1_merge(target, batch, ["code"])
    assert rows(merged) == rows(
        spark.createDataFrame([("a", 1, d(1)), ("b", 20, d(2)), ("c", 30, d(2)), (None, 9, d(1)), (None, 90, d(2))], PRODUCT)
    )


def test_merge_twice_equals_once(spark, target):
    batch = spark.createDataFrame([("b", 20, d(2)), ("c", 30, d(2))], PRODUCT)
    once = scd1_merge(target, batch, ["code"])
    assert rows(scd1_merge(once, batch, ["code"])) == rows(once)


def test_merge_takes_the_latest_of_several(spark, target):
    batch = spark.createDataFrame([("b", 20, d(2)), ("b", 21, d(3)), (None, 5, d(1)), (None, 6, d(1))], PRODUCT)
    merged = rows(scd1_merge(target, batch, ["code"], latest_by=["-upddt"]))
    assert ("b", 21, d(3)) in merged and ("b", 20, d(2)) not in merged
    assert sum(r[0] is None for r in merged) == 3


def test_merge_fails_on_several_rows_for_a_key(spark, target):
    batch = spark.createDataFrame([("b", 20, d(2)), ("b", 21, d(3))], PRODUCT)
    with pytest.raises(Exception, match="several rows"):
        scd1_merge(target, batch, ["code"]).collect()


@pytest.mark.parametrize("use", ["collect", "count", "one"])
def test_no_use_of_a_batch_with_two_rows_for_a_key_succeeds(spark, use):
    batch = spark.createDataFrame([("b", 1, d(2)), ("b", 2, d(2)), (None, 1, d(1)), (None, 1, d(1))], PRODUCT)
    uses = {"collect": lambda f: f.collect(), "count": lambda f: f.count(), "one": lambda f: f.select(F.lit(1)).collect()}
    with pytest.raises(Exception, match="several rows"):
        uses[use](unique_or_fail(batch, ["code"]))
    with pytest.raises(Exception, match="several rows"):
        uses[use](scd1_merge(None, batch, ["code"]))
    good = batch.filter("price = 1")
    assert len(uses["one"](unique_or_fail(good, ["code"]))) == 3


def test_merge_reads_the_target_once_and_the_batch_as_staged(spark, target):
    batch = spark.createDataFrame([("b", 20, d(2))], PRODUCT)
    leaves = scd1_merge(target, batch, ["code"])._jdf.queryExecution().optimizedPlan().collectLeaves().toString()
    assert leaves.count("merge-batch") + leaves.count("Relation") == 2 and "price" in leaves


def test_the_latest_of_equal_dates_is_settled(spark):
    rows = [("b", i, d(2)) for i in range(50)]
    runs = [scd1_merge(None, spark.createDataFrame(r, PRODUCT), ["code"], ["-upddt"]).collect() for r in (rows, rows[::-1])]
    assert runs[0] == runs[1] and len(runs[0]) == 1


def test_merge_needs_equal_columns(spark, target):
    with pytest.raises(ValueError):
        scd1_merge(target, target.drop("price"), ["code"])


def test_initial_merge_returns_the_batch(target):
    assert rows(scd1_merge(None, target, ["code"])) == rows(target)


def test_small_batch_leaves_the_target_unshuffled(spark):
    target = spark.range(1000).selectExpr("id as code", "id as price")
    batch = spark.createDataFrame([(5, 50)], "code bigint, price bigint")
    plan = scd1_merge(target, batch.limit(1), ["code"])._jdf.queryExecution().toString()
    assert "LeftAnti" in plan


def test_merge_match(spark, target):
    batch = spark.createDataFrame([("b", 20, d(2)), ("c", 30, d(2)), (None, 1, d(1))], PRODUCT)
    actions = sorted((str(r.code), r.merge_action) for r in merge_match(target, batch, ["code"]).collect())
    assert actions == [("None", "insert"), ("None", "keep"), ("a", "keep"), ("b", "update"), ("c", "insert")]


def test_product_dimension_merges_changes_since_the_day_before(spark):
    schema = "productcode string, quantityinstock int, buyprice decimal(10,2), msrp decimal(10,2), upddt date"
    from decimal import Decimal as D

    source = spark.createDataFrame(
        [("p1", 100, D("10"), D("20"), d(9)), ("p2", 100, D("10"), D("20"), d(8)), ("p3", 2000, D("10"), D("13"), d(10))], schema
    )
    first = product_dimension(source, None, d(10))
    assert sorted(r.productcode for r in first.collect()) == ["p1", "p3"]
    older = product_dimension(source, None, d(9))
    merged = {r.productcode: (r.promoind, r.demandind) for r in product_dimension(source, older, d(10)).collect()}
    assert merged == {"p1": (0, 1), "p2": (0, 1), "p3": (1, 0)}


def test_rows_at_group_max_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), (None, 9, "n")], "k string, i int, p string")
    assert sorted(r.p for r in rows_at_group_max(df, ["k"], "i").collect()) == ["y", "z"]


def test_top_per_group_ties_and_nulls(spark):
    df = spark.createDataFrame([(None, 5, "a"), (None, 7, "b"), ("CA", 3, "c"), ("CA", 3, "d"), ("CA", 1, "e")], "s string, v int, n string")
    assert sorted(r.n for r in top_per_group(df, ["s"], ["-v"]).collect()) == ["b", "c", "d"]
    assert sorted(r.n for r in top_per_group(df, ["s"], ["-v", "n"], ties=False).collect()) == ["b", "c"]
    assert [r.n for r in top_n(df, ["-v", "n"], 3).collect()] == ["b", "a", "c"]


def test_group_limit_is_below_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = top_per_group(df, ["k"], ["-v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.fixture
def db(spark):
    name = f"buckets_{scratch_path(spark, 'x')[-32:]}"
    prepare_zones(spark, [name], [], shared_dir(spark))
    return name


def bucket_files(spark, table):
    found = spark.read.table(table).select("bucket", "_metadata.file_path", "_metadata.file_modification_time").distinct().collect()
    return {r.file_path: (r.bucket, r.file_modification_time) for r in found}


def test_a_merge_rewrites_only_the_buckets_it_touches(spark, db):
    rows = [(f"k{i}" if i else None, i, d(1)) for i in range(200)]
    target = spark.createDataFrame(rows, PRODUCT)
    batch = spark.createDataFrame([("k3", 30, d(2)), ("new", 1, d(2))], PRODUCT)
    assert merge_buckets(target, db, "p", ["code"], buckets=16) == 1
    first = f"{db}.{snapshot_tables(spark, db, 'p')[-1][1]}"
    before = bucket_files(spark, first)
    reader = spark.read.table(f"{db}.p")
    assert merge_buckets(batch, db, "p", ["code"], buckets=99) == 2
    second = f"{db}.{snapshot_tables(spark, db, 'p')[-1][1]}"
    after = bucket_files(spark, second)
    touched = {r.bucket for r in with_bucket(batch, ["code"], 16).collect()}
    assert {f: v for f, v in before.items() if v[0] not in touched} == {f: v for f, v in after.items() if v[0] not in touched}
    assert not {f for f, v in before.items() if v[0] in touched} & set(after) and len(touched) <= 2
    expected = sorted(map(tuple, scd1_merge(target, batch, ["code"]).collect()), key=str)
    assert sorted(map(tuple, spark.read.table(f"{db}.p").collect()), key=str) == expected
    # The snapshot before still reads its own files, and so does a frame that was made from it.
    assert sorted(map(tuple, spark.read.table(first).select("code", "price", "upddt").collect()), key=str) == sorted(rows, key=str)
    assert reader.count() == 200


def test_snapshots_beyond_those_kept_leave_no_files(spark, db):
    for price in range(1, 5):
        batch = spark.createDataFrame([("a", price, d(1)), ("a", price, d(2)), (None, price, d(1))], PRODUCT)
        assert merge_buckets(batch, db, "p", ["code"], buckets=4, latest_by=["-upddt"]) == price
    assert [version for version, _ in snapshot_tables(spark, db, "p")] == [3, 4]
    found = sorted(map(tuple, spark.read.table(f"{db}.p").collect()), key=str)
    assert found == sorted([("a", 4, d(2)), *((None, price, d(1)) for price in range(1, 5))], key=str)
    top = spark.sql(f"DESCRIBE DATABASE {db}").filter("info_name = 'Location'").first()[1] + "/p_buckets"
    read = {place for _, table in snapshot_tables(spark, db, "p") for place in partition_locations(spark, f"{db}.{table}").values()}
    assert {"/".join(f.split("/")[-2:]) for f in folders_below(spark, top, "bucket=")} == {"/".join(p.split("/")[-2:]) for p in read}
    assert merge_buckets(spark.createDataFrame([], PRODUCT), db, "p", ["code"]) == 5 and spark.read.table(f"{db}.p").count() == 5


def test_buckets_need_a_batch_with_unique_keys(spark, db):
    with pytest.raises(Exception, match="several rows"):
        merge_buckets(spark.createDataFrame([("a", 1, d(1)), ("a", 2, d(1))], PRODUCT), db, "p", ["code"])
