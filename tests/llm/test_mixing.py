"""Pfair mixing: dates are met, deviation stays below a block, the rows are whole."""

from collections import Counter

import duckdb
import pytest

from tallylake.llm import catalogue, mixing


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}", i, "x") for i in range(3000)]
    rows += [(None, "hot", 0, "n"), (None, None, 0, "n")] + [(10_000 + i, None, 1, "y") for i in range(200)] + [(7, "s0", 7, "again"), (20_000, "rare", 1, "z")]
    return spark.createDataFrame(rows, "doc_id long, source string, key int, text string")


@pytest.mark.parametrize("units", [[1000], [1, 999], [333, 334, 333], [20] * 50, [7, 100, 393, 500]])
def test_schedule_meets_all_dates(spark, units):
    rows = mixing.schedule(spark, units).collect()
    assert sorted(r.slot for r in rows) == list(range(1000))
    for r in rows:
        u = units[r.grp]
        assert r.i * 1000 // u <= r.slot < -(-(r.i + 1) * 1000 // u)
    done = Counter()
    for t, r in enumerate(sorted(rows, key=lambda r: r.slot), 1):
        done[r.grp] += 1
        assert all(abs(done[k] - u * t / 1000) < 1 for k, u in enumerate(units))


def test_order_is_whole_and_within_a_block(docs):
    rows = mixing.mix_order(docs, block_rows=4).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    found = mixing.groups(docs)
    assert sum(g.units for g in found) == 1000 and [g.name for g in found] == sorted((g.name for g in found if not g.pooled), key=lambda n: (n is not None, n or "")) + [None]
    weight = {(g.pooled, None if g.pooled else g.name): g.units / 1000 for g in found}
    done = Counter()
    last = max(r.slot for r in rows if r.kept)
    blocks = {(r.slot, r.pooled, None if r.pooled else r.source) for r in rows if r.slot <= last}
    for slot, pooled, source in sorted(blocks, key=lambda b: b[0]):
        done[pooled, source] += 1
        assert all(abs(done[k] - w * (slot + 1)) < 1 for k, w in weight.items())
    assert len({r.position for r in rows}) == len(rows)
    assert all(r.release <= r.slot < r.deadline for r in rows)


def test_mix_keeps_what_the_order_says(docs):
    kept = mixing.mix(docs, block_rows=4, bucket_rows=50)
    assert kept.columns == docs.columns
    ordered = mixing.mix_order(docs, block_rows=4)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in ordered.collect() if r.kept)
    assert mixing.mix_order(docs, block_rows=4, bucket_rows=50).exceptAll(ordered).filter("doc_id IS NOT NULL AND doc_id <> 7").count() == 0


def test_given_weights(docs):
    kept = mixing.mix(docs, weights={"hot": 3, "s1": 1}, block_rows=1).groupBy("source").count().collect()
    count = {r["source"]: r["count"] for r in kept}
    assert set(count) == {"hot", "s1"} and abs(count["hot"] - 3 * count["s1"]) <= 4
    with pytest.raises(ValueError):
        mixing.groups(docs, weights={"hot": 0})


def test_empty_and_equal_tables(spark, docs):
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mix_order(docs.limit(0)).collect() == []
    same = spark.range(100).selectExpr("CAST(5 AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS source")
    assert mixing.mix(same).count() == 100 and mixing.mix_order(same).filter("kept").count() == 100


def test_units_are_the_weights_themselves(spark, docs):
    def units(weights):
        return {g.name: g.units for g in mixing.groups(docs, weights=weights)}

    even = units({"hot": 0.5} | {f"s{k}": 0.01 for k in range(50)})
    assert even.pop("hot") == 500 and set(even.values()) == {10}
    assert units({"hot": 0.9995, "s1": 0.0005}) == {"hot": 1999, "s1": 1}
    for weights in ({"hot": 1 / 3, "s1": 2 / 3}, {"hot": 3.7, "s1": 0.21, "s2": 1.13}):
        found = units(weights)
        assert all(abs(u - weights[k] / sum(weights.values()) * sum(found.values())) < 1 for k, u in found.items())
    rows = spark.range(60_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 60)) AS source")
    share = {g.name: g.rows**0.7 for g in mixing.groups(rows)}
    assert all(abs(g.units - 1000 * share[g.name] / sum(share.values())) < 1 for g in mixing.groups(rows))


def test_given_weights_are_met_within_a_block(spark):
    rows = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 1000 = 0, 'rare', 'hot') AS source")
    weight = {"hot": 0.9995, "rare": 0.0005}
    done = Counter()
    for r in mixing.mix_order(rows, weights=weight, block_rows=4).filter("kept").select("source", "slot").distinct().orderBy("slot").collect():
        done[r.source] += 1
        assert all(abs(done[k] - w * (r.slot + 1)) < 1 for k, w in weight.items())
    assert done["hot"] > 5000 and done["rare"] >= 2


def test_query_equals_sql_on_unequal_sources(spark, tmp_path):
    """Thirteen sources of very different sizes, a missing one and a pool of small ones."""
    sizes = [3000, 1700, 900, 640, 333, 250, 199, 150, 120, 90, 77, 61, 5]
    rows = [(None if j % 401 == 7 else 10_000 * i + j, f"s{i:02d}" if i != 3 else None) for i, n in enumerate(sizes) for j in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string").dropDuplicates(["doc_id"])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    frame = catalogue.queries()["op4_source_mixing"](spark, str(tmp_path))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        result = db.execute(catalogue.oracle_sql()["op4_source_mixing"])
        names = [c[0] for c in result.description]
        theirs = Counter(result.fetchall())
    assert Counter(map(tuple, frame.select(*names).collect())) == theirs and len({r.slot for r in frame.collect()}) > 900
