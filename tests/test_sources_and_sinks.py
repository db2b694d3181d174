import json
import os
from collections import Counter
from datetime import date

import pytest
from oracle import connect
from pyspark.sql import functions as F

from tallylake.catalogue import retail
from tallylake.plans import curated, extracts
from tallylake.sinks import files as out
from tallylake.sinks import tables as sinks
from tallylake.sinks.jdbc import write_jdbc
from tallylake.sinks.loads import LoadLedger, rows_before, write_load
from tallylake.sources import files as src
from tallylake.sources import jdbc
from tallylake.sources.tables import external_delimited_table, extract_since_mark, read_table, read_table_if_exists, table_exists
from tallylake.workspace import discard, forget_shuffles, scratch_path, shared_dir, stage

AWKWARD = [(1, 'line one\nline, two "quoted"'), (2, "  padded  "), (3, ""), (4, None), (5, "back\\slash")]


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(AWKWARD, "id int, txt string")


@pytest.fixture
def db(spark):
    name = f"db_{scratch_path(spark, 'x')[-32:]}"
    sinks.prepare_zones(spark, [name], [], shared_dir(spark))
    return name


def same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_csv_round_trip_of_awkward_text(spark, awkward, tmp_path):
    path = str(tmp_path / "csv")
    how = {"header": True, "delimiter": ";", "null_text": "\\N"}
    out.write_data("csv", awkward, path, **how)
    back = src.read_data("csv", spark, path, schema="id int, txt string", multiline=True, **how)
    assert same(back, awkward)


def test_csv_schema_is_honoured_and_inference_is_optional(spark, tmp_path):
    path = str(tmp_path / "csv")
    out.write_csv(spark.range(3), path, header=True)
    assert src.read_csv(spark, path, "n string", header=True).dtypes == [("n", "string")]
    assert src.read_csv(spark, path, header=True, infer=True).dtypes == [("id", "int")]
    assert src.read_csv(spark, path, header=True).dtypes == [("id", "string")]
    assert src.read_csv(spark, path).dtypes == [("_c0", "string")]


def test_unknown_formats_fail(spark, tmp_path):
    with pytest.raises(ValueError):
        src.read_data("xml", spark, str(tmp_path))
    with pytest.raises(ValueError):
        out.write_data("xml", spark.range(1), str(tmp_path))


def test_json_array_file_with_schema(spark, tmp_path):
    path = tmp_path / "nav.json"
    path.write_text(json.dumps([{"id": 112, "comments": "a\nb", "pagevisit": ["home", "exit"]}, {"id": 114}], indent=1))
    rows = src.read_json(spark, str(path), src.NAVIGATION_SCHEMA, multiline=True).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("112", "a\nb", ["home", "exit"]), ("114", None, None)]


def test_json_lines_round_trip_in_one_dated_file(spark, awkward, tmp_path):
    path = out.dated_path(str(tmp_path / "report"), date(2024, 3, 9))
    assert path.endswith("report20240309")
    out.write_json(awkward.repartition(4), path, compacted=True)
    assert len(list((tmp_path / "report20240309").glob("part-*"))) == 1
    assert same(src.read_json(spark, path, "id int, txt string"), awkward)


def test_rejects(spark, tmp_path):
    path = tmp_path / "tx.csv"
    path.write_text("1,2.50,ok\n2,abc,bad\n3,4.00,ok\n4,1.00,too,many\n")
    rows = src.read_csv_with_rejects(spark, str(path), "id int, price decimal(10,2), note string")
    good, bad = src.split_rejects(rows)
    assert sorted(r.id for r in good.collect()) == [1, 3] and "wrong_data" not in good.columns
    assert sorted(r.wrong_data for r in bad.collect()) == ["2,abc,bad", "4,1.00,too,many"]
    # Whatever columns the query needs, the same lines are rejected.
    assert good.count() == 2 and bad.count() == 2
    assert sorted(r.id for r in good.select("id").collect()) == [1, 3]
    assert [r.wrong_data for r in bad.select("wrong_data").filter("wrong_data like '%abc%'").collect()] == ["2,abc,bad"]


def test_table_exists_ignores_temp_views(spark, db):
    spark.range(1).createOrReplaceTempView("only_a_view")
    assert not table_exists(spark, db, "only_a_view")
    assert read_table_if_exists(spark, db, "t") is None
    sinks.write_table(spark.range(2), f"{db}.t")
    assert table_exists(spark, db, "t") and read_table_if_exists(spark, db, "t").count() == 2


def test_zones(spark):
    base = f"{shared_dir(spark)}/zones"
    sinks.prepare_zones(spark, ["z_kept"], ["z_rebuilt"], base)
    for zone in ("z_kept", "z_rebuilt"):
        sinks.write_table(spark.range(1), f"{zone}.t")
    sinks.prepare_zones(spark, ["z_kept"], ["z_rebuilt"], base)
    assert table_exists(spark, "z_kept", "t") and not table_exists(spark, "z_rebuilt", "t")


def test_partition_overwrite_leaves_the_setting_alone_meanwhile(spark, db):
    """Seen by another thread all the time that the write runs."""
    import threading

    setting, seen, over = "spark.sql.sources.partitionOverwriteMode", set(), threading.Event()

    def watch():
        while not over.is_set():
            seen.add(spark.conf.get(setting))

    name = f"{db}.watched"
    frame = spark.createDataFrame([(i, f"d{i % 3}") for i in range(30)], "x int, datadt string")
    sinks.write_table_partitioned(frame, name, ["datadt"])
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        sinks.write_table_partitioned(frame.filter("datadt = 'd1'").withColumn("x", -F.col("x")), name, ["datadt"])
    finally:
        over.set()
        watcher.join()
    assert {v.lower() for v in seen} == {"static"}
    assert sorted(r.x for r in spark.read.table(name).collect()) == sorted(-i if i % 3 == 1 else i for i in range(30))


def test_partition_overwrite_keeps_other_days(spark, db):
    frame = lambda rows: spark.createDataFrame(rows, "v int, datadt string")
    name = f"{db}.p"
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    sinks.write_table_partitioned(frame([(1, "d1"), (2, "d2")]), name, ["datadt"])
    sinks.write_table_partitioned(frame([(20, "d2"), (30, "d3")]), name, ["datadt"])
    assert sorted(r.v for r in read_table(spark, name).collect()) == [1, 20, 30]
    sinks.write_table_partitioned(frame([(9, "d9")]), name, ["datadt"], dynamic=False)
    assert [r.v for r in read_table(spark, name).collect()] == [9]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_insert_matches_columns_by_name(spark, db):
    name = f"{db}.i"
    sinks.write_table(spark.createDataFrame([(1, "a")], "n int, s string"), name)
    other = spark.createDataFrame([("b", 2)], "s string, n int")
    sinks.append_insert(other, name)
    assert sorted(r.n for r in read_table(spark, name).collect()) == [1, 2]
    sinks.overwrite_insert(other, name)
    assert [tuple(r) for r in read_table(spark, name).collect()] == [(2, "b")]


def test_overwriting_a_table_being_read_is_refused_but_a_snapshot_works(spark, db):
    sinks.write_table(spark.range(3), f"{db}.s")
    with pytest.raises(Exception):
        sinks.overwrite_insert(read_table(spark, f"{db}.s").filter("id > 0"), f"{db}.s")
    assert sinks.publish_snapshot(spark.range(3), db, "dim") == 1
    for expected in (2, 3, 4):
        current = read_table(spark, f"{db}.dim")
        assert sinks.publish_snapshot(current.withColumn("id", F.col("id") + 1), db, "dim") == expected
    assert sorted(r.id for r in read_table(spark, f"{db}.dim").collect()) == [3, 4, 5]
    assert [version for version, _ in sinks.snapshot_tables(spark, db, "dim")] == [3, 4]


def test_external_table_over_files(spark, db, awkward, tmp_path):
    path = str(tmp_path / "ext")
    out.write_csv(awkward, path, null_text="\\N")
    table = external_delimited_table(spark, f"{db}.ext", "id int, txt string", path, multiline=True, null_text="\\N")
    assert same(table, awkward)
    spark.sql(f"DROP TABLE {db}.ext")
    assert src.read_csv(spark, path, "id int, txt string", multiline=True).count() == 5


def test_a_dated_partition_is_replaced_by_location(spark, db, awkward, tmp_path):
    where = str(tmp_path / "dated")
    external_delimited_table(spark, f"{db}.dated", "id int, txt string, datadt date", where, delimiter=";", multiline=True, null_text="\\N", by="datadt")
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    sinks.replace_partition(awkward, f"{db}.dated", {"datadt": one})
    sinks.replace_partition(awkward.limit(2), f"{db}.dated", {"datadt": two})
    before = read_table(spark, f"{db}.dated").filter("datadt = '2024-01-02'")
    sinks.replace_partition(awkward.filter("id = 1"), f"{db}.dated", {"datadt": two})
    now = read_table(spark, f"{db}.dated")
    assert same(now.filter(F.col("datadt") == F.lit(one)).drop("datadt"), awkward)
    assert [tuple(r) for r in now.filter(F.col("datadt") == F.lit(two)).collect()] == [(*AWKWARD[0], two)]
    assert before.count() in (1, 2)  # a reader of the replaced rows isn't disturbed
    assert sinks.drop_unread(spark, f"{db}.dated") == 1 and now.count() == 6
    sinks.replace_partition(awkward.limit(0), f"{db}.dated", {"datadt": one})
    assert read_table(spark, f"{db}.dated").count() == 1


def test_loads_replace_themselves_and_guard_what_rests_on_them(spark, db):
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    ledger = LoadLedger(spark, db)
    assert rows_before(spark, db, "t", one, "p") is None and ledger.mark("p", two) is None and not ledger.holds(one, "p")
    for day, n in ((one, 3), (one, 4), (two, 2), (two, 1)):
        before = rows_before(spark, db, "t", day, "p")
        assert before is None or before.count() == (0 if day == one else 4)
        write_load(spark.range(n), db, "t", day, "p")
        ledger.commit(day, "p", n, day)
    assert read_table(spark, f"{db}.t").columns == ["id"] and read_table(spark, f"{db}.t").count() == 5
    assert ledger.holds(two, "p") and not ledger.holds(two, "q") and ledger.mark("p", two) == one
    assert read_table(spark, ledger.table).count() == 2
    with pytest.raises(ValueError):
        rows_before(spark, db, "t", one, "p")
    assert rows_before(spark, db, "t", one, "q").count() == 5


def test_extract_from_a_mark(spark):
    day = lambda d: date(2024, 1, d)
    rows = [(1, "a", day(1)), (2, "b", day(3)), (3, None, day(3)), (4, "new", day(5)), (5, "ahead", day(9)), (6, "undated", None)]
    source = spark.createDataFrame(rows, "k int, v string, d date")
    loaded = spark.createDataFrame([(7, 2, "b", day(3)), (7, 3, None, day(3))], "ver int, k int, v string, d date")
    found = lambda **how: sorted(r.k for r in extract_since_mark(source, "d", day(5), **how).collect())
    assert found() == [1, 2, 3, 4]
    assert found(mark=day(3)) == [4]
    assert found(mark=day(4), overlap=2, loaded=loaded) == [4]
    assert found(mark=day(4), overlap=9, loaded=loaded) == [1, 4]


def test_stage_reads_back_the_same(awkward):
    assert same(stage(awkward, "t"), awkward)


def test_staged_files_can_be_discarded(spark, awkward):
    staged = stage(awkward, "gone")
    folder = staged.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    discard(staged)
    assert not os.path.exists(folder)
    forget_shuffles(spark)
    assert same(stage(awkward, "t"), awkward)


DB = jdbc.JdbcDatabase("jdbc:mysql://host/db", {"user": "u", "password": "secret", "driver": "d"})


def test_jdbc_options():
    query = jdbc.derived_table(" select * from t where x > 1; ", "q")
    assert query == "(select * from t where x > 1) q"
    options = DB.reader_options(query)
    assert options["dbtable"] == query and options["url"] == DB.url and options["password"] == "secret"
    assert "secret" not in repr(DB) and "secret" not in DB.url
    assert jdbc.partition_options("k", 103, 496, 4) == {
        "partitionColumn": "k", "lowerBound": "103", "upperBound": "496", "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        jdbc.partition_options("k", 1, 2, 0)


class Recorder:
    """Stands in for Spark's reader and writer and keeps the options given."""

    def __init__(self, row=None, rows=None):
        self.calls, self.row, self.rows = [], row, rows

    @property
    def read(self):
        return self

    write = read

    def format(self, name):
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def load(self):
        """The bounds query comes first where a row is given; the data after it."""
        return self.rows if self.rows is not None and len(self.calls) > 1 else self

    def first(self):
        return self.row

    def jdbc(self, url, table, **options):
        self.calls.append({"url": url, "table": table, **options})


def test_partitioned_read_asks_for_the_key_range():
    spark = Recorder((103, 496))
    jdbc.read_jdbc_partitioned(spark, DB, "payments", "customernumber", 4)
    bounds, read = spark.calls
    assert bounds["dbtable"] == "(select min(customernumber) as lo, max(customernumber) as hi from payments) bounds"
    assert (read["lowerBound"], read["upperBound"], read["numPartitions"]) == ("103", "496", "4")


def test_extracts_leave_joins_and_filters_to_the_database(spark):
    rows = spark.createDataFrame(
        [(1, "Larch", "USA", 7, "A", date(2022, 7, 1))],
        "customernumber int, customername string, country string, salesrepemployeenumber int, checknumber string, paymentdate date",
    ).withColumns({"creditlimit": F.lit(1), "amount": F.lit(2)})
    reader = Recorder((103, 496), rows)
    out_rows = extracts.customer_payments(reader, DB, 2022, 7, as_of="2022-11-01").collect()
    bounds, read = reader.calls
    assert read["partitionColumn"] == "customernumber" and (read["lowerBound"], read["upperBound"]) == ("103", "496")
    assert "payments.paymentdate >= date '2022-07-01' and payments.paymentdate < date '2023-01-01'" in read["dbtable"]
    assert bounds["dbtable"].startswith("(select min(customernumber)") and read["dbtable"] in bounds["dbtable"]
    assert (out_rows[0].custname, out_rows[0].datadt) == ("LARCH", date(2022, 11, 1))

    reader = Recorder()
    extracts.changed_rows(reader, DB, "employees", date(2022, 11, 1))
    extracts.changed_rows(reader, DB, "products", date(2022, 11, 1), inclusive=True)
    assert [call["dbtable"] for call in reader.calls] == [
        "(select * from employees where upddt > date '2022-10-31') changed",
        "(select * from products where upddt >= date '2022-10-31') changed",
    ]


def test_extract_texts_give_what_spark_joins_itself(spark):
    """The statements sent to a database, run by an engine of this process."""
    sf_dir = "/root/testdata/sf0.001"
    t = retail.Tables(spark, sf_dir)
    with connect(sf_dir) as db:
        for name in ("CUSTOMERS", "PAYMENTS", "ORDERDETAILS"):
            db.execute(f"CREATE TABLE {name.lower()} AS SELECT * FROM {getattr(retail, name)}")
        db.execute(f"CREATE OR REPLACE TABLE placed AS SELECT * FROM {retail.ORDERS}")
        db.execute("DROP VIEW orders")
        db.execute("ALTER TABLE placed RENAME TO orders")
        db.execute(f"CREATE TABLE products AS SELECT *, CAST(NULL AS VARCHAR) AS productscale, CAST(NULL AS VARCHAR) AS productdescription FROM {retail.PRODUCTS}")
        rows = {text: Counter(map(str, db.execute(text).fetchall())) for text in (extracts.payments_text(1997, 7), extracts.lines_text(1997, 7), extracts.line_products_text(1997, 10, 10))}
    joined = (
        curated.customer_payments(t.customers, t.payments, 1997, 7),
        curated.order_lines(t.orders, t.orderdetails, 1997, 7),
        curated.order_line_products(t.orders, t.orderdetails, t.products, 1997, 10, 10),
    )
    for (text, theirs), frame in zip(rows.items(), joined, strict=True):
        assert theirs.total() == frame.count() > 0, text
    assert rows[extracts.line_products_text(1997, 10, 10)] == Counter(str(tuple(r)) for r in joined[2].collect())


def test_partitioned_read_of_an_empty_table():
    spark = Recorder((None, None))
    jdbc.read_jdbc_partitioned(spark, DB, "payments", "customernumber", 4)
    assert "partitionColumn" not in spark.calls[-1]


def test_jdbc_write_keeps_credentials_out_of_the_url():
    writer = Recorder()
    write_jdbc(writer, DB, "marts", connections=3)
    assert writer.calls[0] == {"numPartitions": "3", "truncate": "true"}
    assert writer.calls[1]["url"] == DB.url and writer.calls[1]["mode"] == "overwrite"
    assert writer.calls[1]["properties"]["password"] == "secret"


def test_json_array_files_stay_small(spark, tmp_path):
    from tallylake.catalogue.ingest import DOCUMENT_SCHEMA, write_json_arrays

    rows = [(None if i % 2 else i, "x" * 900, "en", "s", 900) for i in range(2000)] + [(8, "again", "en", "s", 5)] * 2
    docs = spark.createDataFrame(rows, DOCUMENT_SCHEMA)
    write_json_arrays(docs, str(tmp_path / "arrays"), part_bytes=50_000)
    sizes = [p.stat().st_size for p in (tmp_path / "arrays").glob("part-*")]
    assert len(sizes) > 30 and max(sizes) < 100_000
    found = src.read_json(spark, str(tmp_path / "arrays"), DOCUMENT_SCHEMA, multiline=True).collect()
    assert sorted(map(tuple, found), key=str) == sorted(rows, key=str)


@pytest.mark.parametrize("column", ["customernumber", "paymentdate"])
def test_balanced_ranges_hold_every_row_once(column):
    """The texts sent to a database, run by an engine of this process, on a table with a frequent key and NULLs."""
    with connect("/root/testdata/sf0.001") as db:
        db.execute(f"CREATE TABLE paid AS SELECT * REPLACE (CASE WHEN checknumber % 3 = 0 THEN 7 WHEN checknumber % 50 = 1 THEN NULL ELSE customernumber END AS customernumber) FROM {retail.PAYMENTS}")
        n = db.execute("SELECT count(*) FROM paid").fetchone()[0]
        bounds = [r[0] for r in db.execute(jdbc.bounds_text("paid", column, -(-n // 8))).fetchall()]
        sizes = [db.execute(f"SELECT count(*) FROM paid WHERE {p}").fetchone()[0] for p in jdbc.range_predicates(column, bounds)]
        hot = db.execute(f"SELECT max(c) FROM (SELECT count(*) AS c FROM paid GROUP BY {column})").fetchone()[0]
    assert sum(sizes) == n and len(sizes) <= 9 and max(sizes) <= max(hot, 2 * n / 8) + n / 8


def test_balanced_read_sends_predicates(spark):
    class Database(Recorder):
        def load(self):
            text = self.calls[-1]["dbtable"]
            return spark.createDataFrame([(10,)], "n long") if "count(*)" in text else spark.createDataFrame([("b'c",), ("a",)], "k string")

    reader = Database()
    jdbc.read_jdbc_balanced(reader, DB, "payments", "name", 4)
    assert reader.calls[1]["dbtable"].startswith("(select distinct k from (select name as k,") and "mod(place, 3) = 0" in reader.calls[1]["dbtable"]
    assert reader.calls[2]["predicates"] == ["name < 'a' or name is null", "name >= 'a' and name < 'b''c'", "name >= 'b''c'"]
    assert reader.calls[2]["properties"]["password"] == "secret" and "secret" not in reader.calls[2]["url"]
    assert jdbc.range_predicates("d", []) == ["1 = 1"]
    assert jdbc.range_predicates("d", [date(2024, 1, 2)])[1] == "d >= date '2024-01-02'"


@pytest.mark.parametrize("step", [1, 3, 40])
def test_bounds_put_distinct_values_in_order_only(spark, step):
    rows = spark.range(2000).selectExpr("case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 90 end as k")
    values = sorted(r.k for r in rows.collect() if r.k is not None)
    text = jdbc.bounds_text("{rows}", "k", step)
    found = spark.sql(text, rows=rows)
    assert [r.k for r in found.collect()] == sorted({v for place, v in enumerate(values, 1) if place % step == 0})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert step == 1 or "Aggregate" in plan[plan.index("Window") :]
