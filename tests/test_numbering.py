from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallylake.operators import numbering
from tallylake.operators.numbering import number_changes, number_rows, rank_rows

SCHEMA = "k string, d int, id int"


def numbered_by_hand(rows, ties=False):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    expected = {}
    for members in groups.values():
        members.sort(key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[2]))
        for position, row in enumerate(members, 1):
            if ties:
                position = 1 + sum((r[1] is not None, r[1] or 0) < (row[1] is not None, row[1] or 0) for r in members)
            expected[row[2]] = position
    return expected


def skewed_rows(n=3000):
    """A third of the rows under one key, a third of those on one date, some NULL keys."""
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 10 == 1 else f"k{i % 40}")
        rows.append((key, 7 if i % 9 == 0 else (i * 37) % 101, i))
    return rows


def test_row_numbers_of_a_hot_key(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    out = number_rows(df, ["k"], ["d", "id"])
    assert {r.id: r.row_num for r in out.collect()} == numbered_by_hand(rows)
    assert out.columns == ["k", "d", "id", "row_num"]


def test_ranks_of_a_hot_key_with_ties(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    out = rank_rows(df, ["k"], ["d"])
    assert {r.id: r.rnk for r in out.collect()} == numbered_by_hand(rows, ties=True)
    assert out.columns == ["k", "d", "id", "rnk"]


def test_global_number_descending(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as d")
    out = number_rows(df, [], ["-d", "id"])
    expected = sorted(range(1000), key=lambda i: (-(i % 7), i))
    assert [r.id for r in sorted(out.collect(), key=lambda r: r.row_num)] == expected


def test_ties_are_put_in_the_same_order_by_every_run(spark):
    df = spark.createDataFrame([("a", 1, i) for i in range(500)], SCHEMA)
    runs = [{r.id: r.row_num for r in number_rows(df.repartition(n), ["k"], ["d"]).collect()} for n in (1, 7)]
    assert runs[0] == runs[1] and sorted(runs[0].values()) == list(range(1, 501))


@pytest.mark.parametrize("equal", [False, True])
def test_no_task_holds_more_than_its_share(spark, monkeypatch, equal):
    """One key and one order value, with rows that differ or are all the same."""
    staged = {}

    def keep(df, label):
        staged[label] = numbering_stage(df, label)
        return staged[label]

    numbering_stage = numbering.stage
    monkeypatch.setattr(numbering, "stage", keep)
    df = spark.range(40_000, numPartitions=8).selectExpr("'hot' AS k", "1 AS d", f"CAST({'0' if equal else 'id'} AS INT) AS id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = number_rows(df, ["k"], ["d"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out.agg(F.countDistinct("row_num"), F.max("row_num")).first() == (40_000, 40_000)
    sizes = [r["count"] for r in staged["numbered-parts"].groupBy("part").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 2 * 40_000 / 8


def test_ties_over_many_parts_share_a_rank(spark):
    df = spark.range(20_000, numPartitions=8).selectExpr("'hot' AS k", "id % 2 AS d", "id")
    out = rank_rows(df, ["k"], ["d"])
    assert {(r.d, r.rnk) for r in out.select("d", "rnk").distinct().collect()} == {(0, 1), (1, 10_001)}
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert number_rows(df, ["k"], ["d"]).count() == 0
    assert rank_rows(df, ["k"], ["d"]).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=60))
def test_numbers_by_hand(spark, pairs):
    rows = [(k, d, i) for i, (k, d) in enumerate(pairs)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.id: r.row_num for r in number_rows(df, ["k"], ["d", "id"]).collect()} == numbered_by_hand(rows)


@pytest.fixture
def many_parts(monkeypatch):
    """Parts of a few rows, so that groups and ties go on over several of them."""
    monkeypatch.setattr(numbering, "ROWS_PER_PART", 7)
    monkeypatch.setattr(numbering, "SAMPLED", 2)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-3, 3))), min_size=20, max_size=90))
def test_numbers_and_ranks_over_parts(spark, many_parts, pairs):
    rows = [(k, d, i) for i, (k, d) in enumerate(pairs)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.id: r.row_num for r in number_rows(df, ["k"], ["d", "id"]).collect()} == numbered_by_hand(rows)
    assert {r.id: r.rnk for r in rank_rows(df, ["k"], ["d"]).collect()} == numbered_by_hand(rows, ties=True)


def test_descending_order_and_nulls_over_parts(spark, many_parts):
    rows = [("a", None if i % 5 == 0 else i % 11, i) for i in range(120)]
    out = {r.id: r.rnk for r in rank_rows(spark.createDataFrame(rows, SCHEMA), ["k"], ["-d"]).collect()}
    value = lambda d: -1 if d is None else d
    assert out == {i: 1 + sum(value(e) > value(d) for _, e, _ in rows) for _, d, i in rows}


def test_columns_with_names_used_inside_and_maps(spark, many_parts):
    df = spark.range(40).selectExpr("id % 3 AS key0", "id AS part", "id + 77 AS number", "'x' AS row", "id AS last", "map('a', id) AS m", "id % 2 AS hash")
    out = number_rows(df, ["key0"], ["-part"], "total").collect()
    assert {r.part: r.total for r in out} == {i: 1 + len(range(i + 3, 40, 3)) for i in range(40)}
    assert all((r.number, r.row, r.last, r.m, r.hash) == (r.part + 77, "x", r.part, {"a": r.part}, r.part % 2) for r in out)
    assert rank_rows(df.drop("m"), ["hash"], ["key0"], "tie").count() == 40


def changes_by_hand(rows, known):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    kept = {}
    for key, members in groups.items():
        members.sort(key=lambda r: r[2])
        last = (known[key],) if key is not None and key in known else None
        number = 0
        for _, value, i in members:
            if last != (value,):
                number += 1
                kept[i] = number
            last = (value,)
    return kept


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["a", "a", "b", None]), st.sampled_from([1, 1, 2, None])), min_size=20, max_size=90),
    st.dictionaries(st.sampled_from(["a", "b"]), st.sampled_from([1, None])),
)
def test_changes_by_hand(spark, many_parts, pairs, known):
    rows = [(k, d, i) for i, (k, d) in enumerate(pairs)]
    df = spark.createDataFrame(rows, SCHEMA)
    before = spark.createDataFrame(list(known.items()), "k string, d int")
    out = number_changes(df, ["k"], ["id"], ["d"], before)
    assert out.columns == ["k", "d", "id", "row_num"]
    assert {r.id: r.row_num for r in out.collect()} == changes_by_hand(rows, known)


def test_changes_without_a_past(spark, many_parts):
    rows = [("a", i // 10 % 2, i) for i in range(100)] + [("b", None, 200 + i) for i in range(30)]
    out = number_changes(spark.createDataFrame(rows, SCHEMA), ["k"], ["id"], ["d"])
    assert {r.id: r.row_num for r in out.collect()} == changes_by_hand(rows, {})
    assert number_changes(spark.createDataFrame([], SCHEMA), ["k"], ["id"], ["d"]).count() == 0


def test_ranks_shuffle_ties_instead_of_rows(spark):
    """Many rows with few ties: no row is shuffled; NULLs in keys and order are ties like any other."""
    df = spark.range(30_000).selectExpr("nullif(id % 3, 2) as k", "nullif(id % 50, 7) as d", "id")
    out = rank_rows(df, ["k"], ["-d"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    window = df.selectExpr("k", "d", "id", "cast(rank() over (partition by k order by d desc) as bigint) as rnk")
    assert out.exceptAll(window).count() == 0 and out.count() == 30_000


def test_ranks_of_many_ties_over_parts(spark):
    df = spark.range(40_000).selectExpr("id % 2 as k", "cast(id % 15000 as double) * 0.0 + id % 15000 as d", "id")
    out = rank_rows(df, ["k"], ["d"])
    window = df.selectExpr("k", "d", "id", "cast(rank() over (partition by k order by d) as bigint) as rnk")
    assert out.exceptAll(window).count() == 0 and out.count() == 40_000
