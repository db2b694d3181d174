"""Per-group selection: the rows at a group's maximum, and the best n."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallylake.operators.numbering import order_columns


def top_per_group(
    df: DataFrame, keys: list[str], order_by: list[str], n: int = 1, ties: bool = True, out: str = "rnk"
) -> DataFrame:
    """The first ``n`` rows of each group; with ``ties`` all rows of rank <= n.

    Catalyst turns the rank filter into a group limit below the shuffle, so
    only about n rows per group leave each map task, however large the group.
    """
    window = Window.partitionBy(*keys).orderBy(*order_columns(order_by))
    number = F.rank() if ties else F.row_number()
    return df.withColumn(out, number.over(window)).filter(F.col(out) <= n).withColumn(out, F.col(out).cast("bigint"))


def rows_at_group_max(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """All rows whose ``value`` equals the maximum of their group, ties included.

    The maxima are combined map-side and joined back, so rows that share a hot group's
    maximum stay where the join puts them, and a skewed join may split them. NULL keys and
    values match nothing.
    """
    best = df.groupBy(*keys).agg(F.max(value).alias(value))
    return df.join(best, [*keys, value], "left_semi")


def top_n(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    """The first ``n`` rows overall: each task keeps n, the driver side merges them."""
    return df.orderBy(*order_columns(order_by)).limit(n)
