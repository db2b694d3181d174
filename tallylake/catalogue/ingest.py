"""Sources and sinks: whole tables written to shared storage and read back."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.catalogue.registry import query
from tallylake.catalogue.retail import AS_OF, CUSTOMERS, ORDERS, PAYMENTS, PRODUCTS, Tables
from tallylake.functions.dates import in_months
from tallylake.operators.dimensions import scd1_merge
from tallylake.sinks import files as file_sinks
from tallylake.sinks import tables as table_sinks
from tallylake.sinks.loads import LoadLedger, rows_before, write_load
from tallylake.sources import files as file_sources
from tallylake.sources import tables as table_sources
from tallylake.sources.jdbc import bounds_text, derived_table, range_predicates
from tallylake.workspace import scratch_path, session_dir

DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PAYMENT_SCHEMA = "customernumber bigint, checknumber bigint, paymentdate date, amount decimal(18,2)"


@query("read_json_schema", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def read_json_schema(t: Tables):
    path = scratch_path(t.spark, "json")
    file_sinks.write_json(t.read("documents"), path)
    return file_sources.read_json(t.spark, path, DOCUMENT_SCHEMA)


@query("read_csv", f"SELECT * FROM {PAYMENTS}")
def read_csv(t: Tables):
    path = scratch_path(t.spark, "csv")
    file_sinks.write_csv(t.payments, path, header=True)
    return file_sources.read_csv(t.spark, path, PAYMENT_SCHEMA, header=True)


@query("write_csv", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def write_csv(t: Tables):
    """Text with delimiters, quotes and line breaks inside values."""
    path = scratch_path(t.spark, "csv")
    file_sinks.write_csv(t.read("documents"), path, delimiter="|", header=True, null_text="\\N")
    return file_sources.read_csv(
        t.spark, path, DOCUMENT_SCHEMA, delimiter="|", header=True, multiline=True, null_text="\\N"
    )


@query("write_json", "SELECT event_type AS navigation_pg, count(DISTINCT user_id) AS custcnt FROM events GROUP BY event_type")
def write_json(t: Tables):
    """A report in a single file under a dated path."""
    report = t.event_pages.groupBy("navigation_pg").agg(F.countDistinct("customernumber").alias("custcnt"))
    path = file_sinks.dated_path(scratch_path(t.spark, "report") + "_", date.fromisoformat(AS_OF))
    file_sinks.write_json(report, path, compacted=True)
    return file_sources.read_json(t.spark, path, "navigation_pg string, custcnt bigint")


@query(
    "read_csv_corrupt_record",
    """
    WITH line AS (
        SELECT o_orderkey, o_orderpriority = '1-URGENT' AS bad, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
               concat(o_orderkey, ',', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), ',', o_custkey, ',',
                      CASE WHEN o_orderpriority = '1-URGENT' THEN 'unknown' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END,
                      ',', o_orderpriority) AS txt
        FROM orders)
    SELECT o_orderkey AS id, CASE WHEN NOT bad THEN price END AS price, CASE WHEN bad THEN txt END AS wrong_data
    FROM line
    """,
)
def read_csv_corrupt_record(t: Tables):
    """Lines of urgent orders carry a word in the place of the price."""
    price = F.when(F.col("o_orderpriority") == "1-URGENT", "unknown").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    line = F.concat_ws(",", "o_orderkey", F.col("o_orderdate").cast("date"), "o_custkey", price, "o_orderpriority")
    path = scratch_path(t.spark, "transactions")
    t.read("orders").select(line).write.text(path)
    schema = "id bigint, purchase_date date, txn_id bigint, price decimal(18,2), prod_cat string"
    return file_sources.read_csv_with_rejects(t.spark, path, schema).select("id", "price", "wrong_data")


@query("read_table", f"SELECT * FROM {CUSTOMERS}")
def read_table(t: Tables):
    name = f"{t.new_database()}.customers"
    table_sinks.write_table(t.customers, name)
    return table_sources.read_table(t.spark, name)


@query("write_table", f"SELECT * FROM {ORDERS}")
def write_table(t: Tables):
    """The second write replaces the first."""
    name = f"{t.new_database()}.orders"
    table_sinks.write_table(t.orders, name)
    table_sinks.write_table(t.orders, name)
    return table_sources.read_table(t.spark, name)


@query(
    "write_table_partitioned",
    f"""
    SELECT customernumber, checknumber, paymentdate,
           CAST(CASE WHEN year(paymentdate) = 1997 THEN -amount ELSE amount END AS DECIMAL(18,2)) AS amount,
           CAST(year(paymentdate) * 100 + month(paymentdate) AS INTEGER) AS paymentmonth
    FROM {PAYMENTS}
    """,
)
def write_table_partitioned(t: Tables):
    """All months, then the months of 1997 again with the sign changed."""
    name = f"{t.new_database()}.payments"
    month = (F.year("paymentdate") * 100 + F.month("paymentdate")).cast("int")
    payments = t.payments.withColumn("paymentmonth", month)
    table_sinks.write_table_partitioned(payments, name, ["paymentmonth"])
    again = payments.filter(in_months(F.col("paymentdate"), 1997)).withColumn("amount", (-F.col("amount")).cast("decimal(18,2)"))
    table_sinks.write_table_partitioned(again, name, ["paymentmonth"])
    return table_sources.read_table(t.spark, name)


@query("append_insert", f"SELECT * FROM {PAYMENTS} UNION ALL SELECT * FROM {PAYMENTS}")
def append_insert(t: Tables):
    name = f"{t.new_database()}.payments"
    table_sinks.write_table(t.payments, name)
    table_sinks.append_insert(t.payments.select("amount", "paymentdate", "checknumber", "customernumber"), name)
    return table_sources.read_table(t.spark, name)


@query("overwrite_insert", f"SELECT customernumber, checknumber, paymentdate, CAST(2 * amount AS DECIMAL(18,2)) AS amount FROM {PAYMENTS}")
def overwrite_insert(t: Tables):
    name = f"{t.new_database()}.payments"
    table_sinks.write_table(t.payments, name)
    doubled = t.payments.withColumn("amount", (2 * F.col("amount")).cast("decimal(18,2)"))
    table_sinks.overwrite_insert(doubled, name)
    return table_sources.read_table(t.spark, name)


@query("load_file_overwrite", f"SELECT * FROM {PAYMENTS}")
def load_file_overwrite(t: Tables):
    """Loading the file twice leaves its rows once."""
    path = scratch_path(t.spark, "load")
    file_sinks.write_csv(t.payments, path)
    name = f"{t.new_database()}.payments"
    for _ in range(2):
        table_sinks.load_file_overwrite(file_sources.read_csv(t.spark, path, PAYMENT_SCHEMA), name)
    return table_sources.read_table(t.spark, name)


@query("external_delimited_table", f"SELECT * FROM {PAYMENTS}")
def external_delimited_table(t: Tables):
    path = scratch_path(t.spark, "external")
    file_sinks.write_csv(t.payments, path)
    return table_sources.external_delimited_table(t.spark, f"{t.new_database()}.payments", PAYMENT_SCHEMA, path)


@query("write_versioned_snapshot", f"SELECT *, CAST(2 AS INTEGER) AS loads FROM {PRODUCTS}")
def write_versioned_snapshot(t: Tables):
    """The second version is computed from the first and replaces it."""
    database = t.new_database()
    table_sinks.publish_snapshot(t.products.withColumn("loads", F.lit(1)), database, "products")
    current = table_sources.read_table(t.spark, f"{database}.products")
    merged = scd1_merge(current, current.withColumn("loads", F.col("loads") + 1), ["productcode"])
    table_sinks.publish_snapshot(merged, database, "products")
    return table_sources.read_table(t.spark, f"{database}.products")


@query(
    "read_pushdown_query",
    f"""
    SELECT c.customernumber, c.customername, p.checknumber, p.amount
    FROM {CUSTOMERS} c JOIN {PAYMENTS} p ON c.customernumber = p.customernumber
    WHERE p.amount >= 100000 AND p.paymentdate >= DATE '1997-07-01'
    """,
)
def read_pushdown_query(t: Tables):
    """A join and a filter given as a derived table over the sources, as a database would get it."""
    text = """
        SELECT c.customernumber, c.customername, p.checknumber, p.amount
        FROM {customers} c JOIN {payments} p ON c.customernumber = p.customernumber
        WHERE p.amount >= 100000 AND p.paymentdate >= DATE '1997-07-01';
    """
    return t.spark.sql(f"SELECT * FROM {derived_table(text, 'joined')}", customers=t.customers, payments=t.payments)


PARTS = 6


@query(
    "read_partition_ranges",
    f"""
    WITH k AS (SELECT CASE WHEN checknumber % 3 = 0 THEN 7 ELSE customernumber END AS k FROM {PAYMENTS}),
    bounds AS (SELECT DISTINCT k AS bound FROM (SELECT k, row_number() OVER (ORDER BY k) AS place, count(*) OVER () AS n FROM k)
        WHERE place % ((n + {PARTS - 1}) // {PARTS}) = 0)
    SELECT CAST((SELECT count(*) FROM bounds WHERE bound <= k) AS INTEGER) AS part, count(*) AS n_rows FROM k GROUP BY part
    """,
)
def read_partition_ranges(t: Tables):
    """The ranges of a balanced parallel read, each sent as its own condition; a third of the rows have one key."""
    key = F.when(F.col("checknumber") % 3 == 0, 7).otherwise(F.col("customernumber"))
    payments = t.payments.withColumn("customernumber", key)
    step = -(-payments.count() // PARTS)
    bounds = [row[0] for row in t.spark.sql(bounds_text("{payments}", "customernumber", step), payments=payments).collect()]
    parts = [
        t.spark.sql(f"SELECT {part} AS part FROM {{payments}} WHERE {condition}", payments=payments)
        for part, condition in enumerate(range_predicates("customernumber", bounds))
    ]
    return reduce(DataFrame.unionAll, parts).groupBy("part").agg(F.count("*").alias("n_rows"))


@query("incremental_extract", f"SELECT * FROM {PRODUCTS} WHERE upddt > DATE '{AS_OF}' - INTERVAL 1 DAY")
def incremental_extract(t: Tables):
    return table_sources.incremental_extract(t.products, "upddt", AS_OF)


@query("incremental_extract_inclusive", f"SELECT * FROM {ORDERS} WHERE orderdate >= DATE '{AS_OF}' - INTERVAL 30 DAY")
def incremental_extract_inclusive(t: Tables):
    return table_sources.incremental_extract(t.orders, "orderdate", AS_OF, days=30, inclusive=True)


MARK_DAYS = (date(1997, 12, 30), date(1998, 1, 1))
#: One payment in seven reaches the source two days late.
ARRIVED = "paymentdate + CAST(CASE WHEN checknumber % 7 = 0 THEN 2 ELSE 0 END AS INTEGER)"


@query(
    "incremental_extract_marked",
    f"""
    SELECT *, CASE WHEN {ARRIVED} <= DATE '{MARK_DAYS[0]}' THEN DATE '{MARK_DAYS[0]}' ELSE DATE '{MARK_DAYS[1]}' END AS load_date
    FROM {PAYMENTS} WHERE {ARRIVED} <= DATE '{MARK_DAYS[1]}'
    """,
)
def incremental_extract_marked(t: Tables):
    """Three days, the middle one without a load: its rows come with the next load, late rows too, none twice."""
    database = t.new_database()
    ledger = LoadLedger(t.spark, database)
    for load_date in MARK_DAYS:
        arrived = F.date_add("paymentdate", F.when(F.col("checknumber") % 7 == 0, 2).otherwise(0))
        source = t.payments.filter(arrived <= F.lit(load_date))
        loaded = rows_before(t.spark, database, "payments", load_date, "payments")
        rows = table_sources.extract_since_mark(source, "paymentdate", load_date, ledger.mark("payments", load_date), 5, loaded)
        write_load(rows, database, "payments", load_date, "payments")
        written = t.spark.read.table(f"{database}.payments_loads").filter(F.col("load_date") == F.lit(load_date))
        ledger.commit(load_date, "payments", *written.agg(F.count("*"), F.max("paymentdate")).first())
    return t.spark.read.table(f"{database}.payments_loads").drop("load_part")


@query(
    "external_table_dated",
    f"""
    SELECT customernumber, checknumber, paymentdate, amount, DATE '{MARK_DAYS[0]}' AS datadt FROM {PAYMENTS}
    UNION ALL SELECT customernumber, checknumber, paymentdate, CAST(2 * amount AS DECIMAL(18,2)), DATE '{MARK_DAYS[1]}' FROM {PAYMENTS}
    """,
)
def external_table_dated(t: Tables):
    """A delimited table outside the catalog, loaded by date: the second date twice, which replaces its rows and keeps the first date's."""
    path = scratch_path(t.spark, "external")
    name = f"{t.new_database()}.payments"
    table_sources.external_delimited_table(t.spark, name, f"{PAYMENT_SCHEMA}, datadt date", path, by="datadt", delimiter="|")
    doubled = t.payments.withColumn("amount", (2 * F.col("amount")).cast("decimal(18,2)"))
    for load_date, rows in ((MARK_DAYS[0], t.payments), (MARK_DAYS[1], t.payments), (MARK_DAYS[1], doubled)):
        table_sinks.replace_partition(rows, name, {"datadt": load_date})
    return t.spark.read.table(name)


def write_json_arrays(docs, path: str, part_bytes: int = 32 << 20) -> None:
    """Documents in files of one JSON array each, of about ``part_bytes``; rows are dealt by a hash that equal and NULL ids don't share."""
    rows = docs.select("doc_id", F.to_json(F.struct("doc_id", "text", "lang", "source", "n_chars")).alias("j"))
    size = rows.agg(F.sum(F.octet_length("j").cast("long"))).first()[0] or 0
    parts = max(8, -(-size // part_bytes))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("j", F.monotonically_increasing_id()), F.lit(parts)))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "j"))), lambda x: x["j"])
    arrays = rows.groupBy("part").agg(F.concat(F.lit("[\n"), F.array_join(listed, ",\n"), F.lit("\n]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


@query("read_json_array", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def read_json_array(t: Tables):
    """Files that hold one JSON array each, over several lines."""
    path = scratch_path(t.spark, "json-array")
    write_json_arrays(t.read("documents"), path)
    return file_sources.read_json(t.spark, path, DOCUMENT_SCHEMA, multiline=True)


@query("table_exists", f"SELECT customernumber, checknumber, paymentdate, amount, CAST(2 AS INTEGER) AS loads FROM {PAYMENTS}")
def table_exists(t: Tables):
    """A first load creates the table, a second one finds it and continues from its rows."""
    database = t.new_database()
    for _ in range(2):
        if table_sources.table_exists(t.spark, database, "payments"):
            stored = table_sources.read_table(t.spark, f"{database}.payments")
            table_sinks.write_table(stored.withColumn("loads", F.col("loads") + 1), f"{database}.payments_next")
        else:
            table_sinks.write_table(t.payments.withColumn("loads", F.lit(1)), f"{database}.payments")
    return table_sources.read_table(t.spark, f"{database}.payments_next")


@query("prepare_zones", f"SELECT 'kept' AS zone, customernumber, amount FROM {PAYMENTS}")
def prepare_zones(t: Tables):
    """Of two filled zones, the kept one holds its rows after the zones are prepared, the rebuilt one is empty."""
    kept, rebuilt = t.new_database(), t.new_database()
    rows = t.payments.select("customernumber", "amount")
    for zone in (kept, rebuilt):
        table_sinks.write_table(rows, f"{zone}.payments")
    table_sinks.prepare_zones(t.spark, [kept], [rebuilt], session_dir(t.spark))
    found = None
    for name, zone in (("kept", kept), ("rebuilt", rebuilt)):
        table = table_sources.read_table_if_exists(t.spark, zone, "payments")
        if table is not None:
            part = table.select(F.lit(name).alias("zone"), "customernumber", "amount")
            found = part if found is None else found.unionByName(part)
    return found


@query("external_table_append", f"SELECT * FROM {PAYMENTS} UNION ALL SELECT * FROM {PAYMENTS}")
def external_table_append(t: Tables):
    """Rows inserted twice into a delimited table outside the catalog; its files hold both."""
    path = scratch_path(t.spark, "external")
    name = f"{t.new_database()}.payments"
    table_sources.external_delimited_table(t.spark, name, PAYMENT_SCHEMA, path, delimiter="|")
    for _ in range(2):
        table_sinks.append_insert(t.payments, name)
    return file_sources.read_csv(t.spark, path, PAYMENT_SCHEMA, delimiter="|")


@query("external_table_overwrite", f"SELECT customernumber, checknumber, paymentdate, CAST(2 * amount AS DECIMAL(18,2)) AS amount FROM {PAYMENTS}")
def external_table_overwrite(t: Tables):
    path = scratch_path(t.spark, "external")
    name = f"{t.new_database()}.payments"
    table_sources.external_delimited_table(t.spark, name, PAYMENT_SCHEMA, path)
    table_sinks.append_insert(t.payments, name)
    doubled = t.payments.withColumn("amount", (2 * F.col("amount")).cast("decimal(18,2)"))
    table_sinks.overwrite_insert(doubled, name)
    return file_sources.read_csv(t.spark, path, PAYMENT_SCHEMA)
