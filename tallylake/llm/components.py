"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.workspace import stage


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Every node sends its neighbours (the larger ones, or itself and the smaller ones) to the least node it knows."""
    if larger:
        seen = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = seen.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    if larger:
        out = seen.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = seen.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = moved.unionAll(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the least node it is linked to; only nodes that aren't their own root.

    Each round is written to the shared folder, so a lost executor costs one round. Rounds
    grow with the logarithm of the longest chain; nothing but two sums reaches the driver.
    """
    now = stage(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "links")
    seen = None
    while True:
        now = stage(_star(_star(now, True), False), "links")
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
