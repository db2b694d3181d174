"""Exact distinct counts that are kept and merged instead of counted again.

The distinct values of a group are the bits of bitmaps, one for every 32,768 consecutive numbers that occur, made by Spark's bitmap
functions. Bitmaps of different days are united by OR, so a day's rows are read once, on that day, and a count over any
days is one over their bitmaps. Tasks combine before the shuffle, and one group's bitmaps are spread by their number.

Values are whole numbers; NULLs don't count, and a group of nothing else counts 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """The groups, the number ``bucket`` of each bitmap, and the ``bitmap``."""
    number = F.col(value).cast("bigint")
    return df.groupBy(*groups, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap")
    )


def merge_bitmaps(bitmaps: DataFrame, groups: list[str]) -> DataFrame:
    """One bitmap for each group and bucket."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_bitmaps(bitmaps: DataFrame, groups: list[str], out: str) -> DataFrame:
    """Distinct values of each group over all its bitmaps."""
    counted = F.when(F.col("bucket").isNull(), F.lit(0).cast("bigint")).otherwise(F.bitmap_count("bitmap"))
    return merge_bitmaps(bitmaps, groups).groupBy(*groups).agg(F.sum(counted).alias(out))
