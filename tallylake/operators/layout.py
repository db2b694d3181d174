"""Physical layout a caller may ask for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel


def optimize_layout(
    df: DataFrame, partitions: int | None = None, by: list[str] | None = None, shuffle: bool = True, cache: bool = False
) -> DataFrame:
    """Repartition (``shuffle``) or coalesce, and optionally keep for reuse.

    ``by`` brings rows of equal values together by rebalancing, which splits a value that
    holds much of the data; ``partitions`` is then where adaptive execution starts from.
    Without ``partitions`` the count is left to it. Session settings are never changed. The
    cached copy may spill to disk; Spark recomputes blocks that are lost with an executor.
    """
    if not shuffle:
        if partitions is None or by:
            raise ValueError("coalesce takes a partition count and no columns")
        df = df.coalesce(partitions)
    elif by:
        df = df.hint("rebalance", *([partitions] if partitions is not None else []), *by)
    elif partitions is not None:
        df = df.repartition(partitions)
    return df.persist(StorageLevel.MEMORY_AND_DISK) if cache else df
