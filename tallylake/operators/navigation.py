"""Page paths of customer visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.operators.grouping import top_per_group
from tallylake.operators.numbering import number_rows
from tallylake.workspace import stage


def explode_pages(visits: DataFrame, keep: list[str], pages: str = "pagevisit") -> DataFrame:
    """One row per page with its position from 0; an empty or NULL path gives none."""
    return visits.select(*keep, F.posexplode(pages).alias("navigation_index", "navigation_pg"))


def array_item(values: str, position: int) -> Column:
    """Item at a position from 0; NULL beyond the end instead of an error."""
    return F.get(F.col(values), F.lit(position))


def index_events(events: DataFrame, visit: list[str], order_by: list[str], out: str = "navigation_index") -> DataFrame:
    """Position from 0 of every event within its visit, for paths kept as event rows."""
    return number_rows(events, visit, order_by, out).withColumn(out, F.col(out) - 1)


def first_last_pages(
    navigation: DataFrame, customer: str = "customernumber", index: str = "navigation_index", page: str = "navigation_pg"
) -> DataFrame:
    """Distinct customers per first page and per last page of their visits.

    The last page is taken at a customer's highest position over all visits,
    ties included. These highest positions are few numbers, which are found first and written, so Spark
    broadcasts them while its threshold allows; of the rows only those at such a position, or at position 0, go
    on, and are reduced, map-side, to one per customer and page.
    """
    rows = navigation.select(F.col(customer).alias("_customer"), F.col(index).alias("_index"), F.col(page).alias("_page"))
    tops = rows.filter("_customer IS NOT NULL").groupBy(F.col("_customer").alias("_owner")).agg(F.max("_index").alias("_top"))
    rows = rows.join(stage(tops, "last-positions", "zstd"), F.col("_customer") == F.col("_owner"), "left")
    rows = rows.filter("_index = 0 OR _index = _top")
    rows = rows.select(F.col("_customer").alias(customer), F.col("_index").alias(index), F.col("_page").alias(page))
    reach = rows.groupBy(customer, page).agg(F.min(index).alias("_from"), F.max(index).alias("_to"))
    first = F.when(F.col("_from") == 0, _end(FIRST_PAGE, page, F.lit(0)))
    last = F.when(F.col("_to").isNotNull() & F.col(customer).isNotNull(), _end(LAST_PAGE, page, F.col("_to")))
    return _count_ends(reach, customer, page, first, last)


def first_last_of_visits(events: DataFrame, customer: str, visit: list[str], order_by: list[str], page: str) -> DataFrame:
    """``first_last_pages`` straight from event rows, without numbering them.

    One aggregate reduces every visit to its first page, last page and length; map tasks
    combine before the shuffle, so a huge visit gathers nowhere. For strings and structs Spark
    sorts to combine. ``order_by`` takes a leading ``-`` as elsewhere; pages whose moments are
    equal are put in the order of the page.
    """
    ordered = [_rising(events, name) for name in order_by]
    moment = F.struct(*ordered, page)
    visits = events.groupBy(customer, *visit).agg(
        F.min_by(page, moment).alias("_first"), F.max_by(page, moment).alias("_last"), F.count("*").alias("_length")
    )
    first = _end(FIRST_PAGE, "_first", F.lit(0))
    last = F.when(F.col(customer).isNotNull(), _end(LAST_PAGE, "_last", F.col("_length")))
    return _count_ends(visits, customer, page, first, last)


def _rising(events: DataFrame, name: str) -> Column:
    """A column that rises in the wanted order; falling order is for numbers, dates and times."""
    if not name.startswith("-"):
        return F.col(name)
    kind = events.schema[name[1:]].dataType.typeName()
    column = F.col(name[1:])
    if kind in ("timestamp", "timestamp_ntz"):
        column = F.unix_micros(column.cast("timestamp"))
    elif kind == "date":
        column = F.unix_date(column)
    elif kind == "string":
        raise ValueError(f"{name}: text has no falling order here")
    return F.struct(column.isNull(), -column)


# The two report labels.
FIRST_PAGE = "first pagevisited"
LAST_PAGE = "last pagevisited"


def _end(label: str, page: str, reach: Column) -> Column:
    return F.struct(F.lit(label).alias("pagevisit"), F.col(page).alias("_page"), reach.cast("bigint").alias("_reach"))


def _count_ends(rows: DataFrame, customer: str, page: str, first: Column, last: Column) -> DataFrame:
    """Customers per label and page. First pages all have reach 0, so all of them rank first;
    of the last pages those at the customer's highest reach do."""
    ends = (
        rows.select(customer, F.inline(F.array_compact(F.array(first, last))))
        .groupBy(customer, "pagevisit", "_page")
        .agg(F.max("_reach").alias("_reach"))
    )
    best = top_per_group(ends, [customer, "pagevisit"], ["-_reach"], n=1)
    counts = best.groupBy("_page", "pagevisit").agg(F.count(customer).alias("custcnt"))
    return counts.select(F.col("_page").alias(page), "custcnt", "pagevisit")


def page_transitions(visits: DataFrame, pages: str = "pagevisit") -> DataFrame:
    """How often each page is followed by each other page, within a path.

    Each page steps to the one at its own place in the path without its first page; the
    path is taken apart once, and pairs are counted map-side.
    """
    rest = F.slice(pages, F.lit(2), F.greatest(F.size(pages) - 1, F.lit(0)))
    pairs = visits.select(pages, rest.alias("_rest")).select("_rest", F.posexplode(pages).alias("_at", "page"))
    return (
        pairs.select("page", F.get("_rest", "_at").alias("next_page"), F.size("_rest").alias("_steps"), "_at")
        .filter(F.col("_at") < F.col("_steps"))
        .groupBy("page", "next_page")
        .agg(F.count("*").alias("transitions"))
    )


def funnel_stage(ordered: Column, carted: Column) -> Column:
    """How far a visit came, from whether it reached the order and the cart page."""
    return F.when(ordered, "order").when(carted, "cart only").otherwise("neither")


def path_funnel(visits: DataFrame, order_page: str, cart_page: str, pages: str = "pagevisit") -> DataFrame:
    """Visits per funnel stage, where each row holds a whole path."""
    ordered = F.coalesce(F.array_contains(pages, order_page), F.lit(False))
    carted = F.coalesce(F.array_contains(pages, cart_page), F.lit(False))
    return visits.groupBy(funnel_stage(ordered, carted).alias("stage")).agg(F.count("*").alias("visits"))


def event_funnel(events: DataFrame, visit: list[str], page: str, order_page: str, cart_page: str) -> DataFrame:
    """Visits per funnel stage, where each row holds one page of a visit."""
    reached = events.groupBy(*visit).agg(
        F.max(F.col(page).eqNullSafe(order_page)).alias("_ordered"),
        F.max(F.col(page).eqNullSafe(cart_page)).alias("_carted"),
    )
    stage = funnel_stage(F.col("_ordered"), F.col("_carted"))
    return reached.groupBy(stage.alias("stage")).agg(F.count("*").alias("visits"))
