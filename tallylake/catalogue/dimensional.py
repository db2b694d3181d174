"""Slowly changing dimensions and the dimension pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallylake.catalogue.registry import query
from tallylake.catalogue.relational import KPI_SQL
from tallylake.catalogue.retail import AS_OF, CHANGES, HISTORY, OFFICES, Tables
from tallylake.functions.dates import day
from tallylake.functions.kpis import with_product_kpis
from tallylake.operators import dimensions as ops
from tallylake.plans import dimensions as plans
from tallylake.sinks.buckets import merge_buckets
from tallylake.sources.tables import incremental_extract

VERSIONED = """
    SELECT c.*, CAST(row_number() OVER (PARTITION BY c.employeenumber ORDER BY c.upddt, c.changenumber)
                     + coalesce(h.max_ver, 0) AS INTEGER) AS ver
    FROM {changes} c LEFT JOIN (SELECT employeenumber, max(ver) AS max_ver FROM {history} GROUP BY employeenumber) h
        ON c.employeenumber = h.employeenumber
"""


@query("scd2_append_versions", VERSIONED.format(changes=CHANGES, history=HISTORY))
def scd2_append_versions(t: Tables):
    return ops.scd2_append_versions(t.history, t.changes, ["employeenumber"], ["upddt", "changenumber"])


@query("scd2_append_versions_split", VERSIONED.format(changes=f"(SELECT *, 1 AS part FROM {CHANGES})", history=f"(SELECT *, 1 AS part FROM {HISTORY})").replace(
    "c.*,", "c.employeenumber, c.jobtitle, c.leaveflag, c.upddt, c.changenumber,"
))
def scd2_append_versions_split(t: Tables):
    """The same for a key of two columns, one of them the same in all rows."""
    part = F.lit(1).alias("part")
    rows = ops.scd2_append_versions(t.history.select("*", part), t.changes.select("*", part), ["part", "employeenumber"], ["upddt", "changenumber"])
    return rows.drop("part")


# A third of the changes under one key, and flags that come back, stay or are missing.
KEYED = "CASE WHEN employeenumber % 3 = 0 THEN 0 ELSE employeenumber END AS employeenumber"
FLAGGED = f"(SELECT * REPLACE ({KEYED}, nullif(leaveflag, 'P') AS leaveflag) FROM {CHANGES})"
FLAG_HISTORY = f"(SELECT * REPLACE (CASE WHEN employeenumber % 2 = 1 THEN 'F' END AS leaveflag) FROM {HISTORY} WHERE employeenumber % 3 > 0)"


@query(
    "scd2_only_changed",
    f"""
    WITH stored AS (SELECT employeenumber, leaveflag AS known, ver, ver = max(ver) OVER (PARTITION BY employeenumber) AS latest FROM {FLAG_HISTORY}),
    lined AS (SELECT c.*, s.known, s.ver AS highest, lag(leaveflag) OVER w AS prior, row_number() OVER w AS place
        FROM {FLAGGED} c LEFT JOIN (SELECT * FROM stored WHERE latest) s ON c.employeenumber = s.employeenumber
        WINDOW w AS (PARTITION BY c.employeenumber ORDER BY upddt, changenumber)),
    kept AS (SELECT * FROM lined WHERE CASE WHEN place > 1 THEN leaveflag IS DISTINCT FROM prior ELSE highest IS NULL OR leaveflag IS DISTINCT FROM known END)
    SELECT employeenumber, jobtitle, leaveflag, upddt, changenumber,
           CAST(row_number() OVER (PARTITION BY employeenumber ORDER BY upddt, changenumber) + coalesce(highest, 0) AS INTEGER) AS ver
    FROM kept
    """,
)
def scd2_only_changed(t: Tables):
    """Versions only where the leave flag changes; one key holds a third of the changes."""
    key = F.when(F.col("employeenumber") % 3 == 0, 0).otherwise(F.col("employeenumber"))
    changes = t.changes.withColumns({"employeenumber": key, "leaveflag": F.nullif("leaveflag", F.lit("P"))})
    history = t.history.filter("employeenumber % 3 > 0").withColumn("leaveflag", F.when(F.col("employeenumber") % 2 == 1, "F"))
    return ops.scd2_append_versions(
        history, changes, ["employeenumber"], ["upddt", "changenumber"], only_changed=True, tracked=["leaveflag"]
    )


@query(
    "scd2_initial_load",
    f"SELECT *, CAST(row_number() OVER (PARTITION BY employeenumber ORDER BY upddt, changenumber) AS INTEGER) AS ver FROM {CHANGES}",
)
def scd2_initial_load(t: Tables):
    return ops.scd2_initial_load(t.changes, ["employeenumber"], ["upddt", "changenumber"])


ALL_VERSIONS = f"SELECT * FROM {HISTORY} UNION ALL {VERSIONED.format(changes=CHANGES, history=HISTORY)}"


@query(
    "scd2_current",
    f"""
    SELECT employeenumber, jobtitle, leaveflag, upddt, changenumber, ver
    FROM (SELECT *, row_number() OVER (PARTITION BY employeenumber ORDER BY ver DESC) AS latest FROM ({ALL_VERSIONS}))
    WHERE latest = 1
    """,
)
def scd2_current(t: Tables):
    appended = ops.scd2_append_versions(t.history, t.changes, ["employeenumber"], ["upddt", "changenumber"])
    return ops.scd2_current(t.history.unionByName(appended), ["employeenumber"])


# Stored: products of the days before the load date. Batch: of the day before and the
# load date, with another price, so that some replace and some are new.
STORED = f"SELECT * FROM ({KPI_SQL}) WHERE upddt < DATE '{AS_OF}'"
BATCH = f"""
    SELECT productcode, productname, productline, productvendor, quantityinstock, buyprice,
           CAST(msrp + 1 AS DECIMAL(10,2)) AS msrp, upddt, profit, profitpercent, promoind, demandind
    FROM ({KPI_SQL}) WHERE upddt >= DATE '{AS_OF}' - INTERVAL 1 DAY
"""


def _stored(t: Tables):
    return with_product_kpis(t.products).filter(F.col("upddt") < day(AS_OF))


def _batch(t: Tables):
    changed = incremental_extract(t.products, "upddt", AS_OF, inclusive=True)
    return with_product_kpis(changed).withColumn("msrp", (F.col("msrp") + 1).cast("decimal(10,2)"))


@query("scd1_merge", f"SELECT * FROM ({BATCH}) UNION ALL SELECT * FROM ({STORED}) WHERE upddt < DATE '{AS_OF}' - INTERVAL 1 DAY")
def scd1_merge(t: Tables):
    return ops.scd1_merge(_stored(t), _batch(t), ["productcode"], latest_by=["-upddt"])


@query(
    "scd1_merge_buckets",
    f"SELECT * FROM ({BATCH}) UNION ALL SELECT * FROM ({STORED}) WHERE upddt < DATE '{AS_OF}' - INTERVAL 1 DAY",
)
def scd1_merge_buckets(t: Tables):
    """The same merge into a dimension kept in buckets."""
    database = t.new_database()
    merge_buckets(_stored(t), database, "products", ["productcode"], buckets=8)
    merge_buckets(_batch(t), database, "products", ["productcode"], latest_by=["-upddt"])
    return t.spark.read.table(f"{database}.products")


@query("scd1_initial_load", BATCH)
def scd1_initial_load(t: Tables):
    return ops.scd1_merge(None, _batch(t), ["productcode"])


@query(
    "merge_match",
    f"""
    SELECT coalesce(s.productcode, b.productcode) AS productcode,
           CASE WHEN s.productcode IS NULL THEN 'insert' WHEN b.productcode IS NULL THEN 'keep' ELSE 'update' END AS merge_action
    FROM ({STORED}) s FULL JOIN ({BATCH}) b ON s.productcode = b.productcode
    """,
)
def merge_match(t: Tables):
    return ops.merge_match(_stored(t), _batch(t), ["productcode"])


@query(
    "employee_dimension",
    VERSIONED.format(
        changes=f"(SELECT DISTINCT * FROM {CHANGES} WHERE upddt > DATE '{AS_OF}' - INTERVAL 180 DAY)", history=HISTORY
    ),
)
def employee_dimension(t: Tables):
    return plans.employee_dimension(t.changes, t.history, AS_OF, days=180, tie_break=["changenumber"])


@query("office_dimension", f"SELECT DISTINCT * FROM {OFFICES}")
def office_dimension(t: Tables):
    return plans.office_dimension(t.offices)


CHANGED_PRODUCTS = f"SELECT * FROM ({KPI_SQL}) WHERE upddt >= DATE '{AS_OF}' - INTERVAL 1 DAY"
OLD_PRODUCTS = f"SELECT * REPLACE (CAST(0 AS SMALLINT) AS promoind, CAST(0 AS SMALLINT) AS demandind) FROM ({KPI_SQL})"
MERGED_PRODUCTS = f"""
    SELECT * FROM ({CHANGED_PRODUCTS})
    UNION ALL SELECT * FROM ({OLD_PRODUCTS}) WHERE productcode NOT IN (SELECT productcode FROM ({CHANGED_PRODUCTS}))
"""


def merged_products(t: Tables):
    """All products stored without indicators; those changed since yesterday come again with them."""
    stored = with_product_kpis(t.products).withColumns(
        {"promoind": F.lit(0).cast("smallint"), "demandind": F.lit(0).cast("smallint")}
    )
    return plans.product_dimension(t.products, stored, AS_OF, latest_by=["-upddt"])


@query("product_dimension_kpi", MERGED_PRODUCTS)
def product_dimension_kpi(t: Tables):
    return merged_products(t)
