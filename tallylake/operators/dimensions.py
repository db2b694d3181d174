"""Slowly changing dimensions on plain tables.

Type 2 appends a version per change; type 1 replaces the row of a key. Both are
ordinary joins, so the result is a frame the caller appends or publishes (see
``sinks.tables``); nothing here needs a table format with its own merge.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.operators.grouping import top_per_group
from tallylake.operators.numbering import number_changes, number_rows
from tallylake.workspace import stage


def scd2_initial_load(
    changes: DataFrame, keys: list[str], order_by: list[str], ver: str = "ver", start_after: DataFrame | None = None
) -> DataFrame:
    """First load: versions from 1 up per key (always 1 where the key is unique)."""
    return number_rows(changes, keys, order_by, ver, start_after).withColumn(ver, F.col(ver).cast("int"))


def scd2_append_versions(
    history: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    order_by: list[str],
    ver: str = "ver",
    only_changed: bool = False,
    tracked: list[str] | None = None,
) -> DataFrame:
    """The rows to append: each change numbered on from the key's highest version.

    Only the key and version columns of ``history`` are read, and combined map-side to one
    row per key. History rows are never altered; an empty or missing history is an initial
    load.

    With ``only_changed`` a row is appended only if its ``tracked`` columns (by default all but the
    keys and the order) differ from the key's version before it, stored or of the same batch: a batch loaded
    again, or a value that comes back to what it is, adds nothing; A, B, A adds B and A. NULLs are
    equal. The tracked columns of ``history`` are then read too.
    """
    if only_changed:
        tracked = tracked or [c for c in changes.columns if c not in {*keys, *(name.lstrip("-") for name in order_by)}]
        latest = None if history is None else latest_versions(history, keys, tracked, ver)
        return number_changes(changes, keys, order_by, tracked, latest, ver).withColumn(ver, F.col(ver).cast("int"))
    highest = None if history is None else history.groupBy(*keys).agg(F.max(ver).alias(ver))
    return scd2_initial_load(changes, keys, order_by, ver, highest)


def latest_versions(history: DataFrame, keys: list[str], columns: list[str], ver: str = "ver") -> DataFrame:
    """The keys, some columns and the number of every key's latest version, combined map-side."""
    latest = F.max_by(F.struct(*columns), ver)
    return history.groupBy(*keys).agg(F.max(ver).alias(ver), latest.alias("_latest")).select(*keys, "_latest.*", ver)


def scd2_current(history: DataFrame, keys: list[str], ver: str = "ver") -> DataFrame:
    """The latest version of every key."""
    return top_per_group(history, keys, [f"-{ver}"], n=1, ties=False, out="_latest").drop("_latest")


def latest_per_key(batch: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key, the first by ``order_by`` (then by a hash of the row); rows with a NULL key are all kept."""
    rows = batch.withColumns({"_alone": _alone(keys), "_tie": F.xxhash64(*batch.columns)})
    best = top_per_group(rows, [*keys, "_alone"], [*order_by, "_tie"], n=1, ties=False, out="_first")
    return best.select(*batch.columns)


def unique_or_fail(batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch itself; any use of it fails when a (non-NULL) key occurs twice.

    The check is a filter on the count, so a plan that needs no column still makes it.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in batch.columns])
    counted = (
        batch.withColumn("_alone", _alone(keys))
        .groupBy(*keys, "_alone")
        .agg(F.any_value(row).alias("_row"), F.count("*").alias("_copies"))
    )
    failure = F.raise_error(F.lit(f"merge source has several rows for one {', '.join(keys)}")).cast("boolean")
    return counted.filter(F.when(F.col("_copies") == 1, True).otherwise(failure)).select("_row.*")


def _alone(keys: list[str]):
    """Tells rows with a NULL key apart, which match nothing; the same for all others."""
    return F.when(_any_null(keys), F.monotonically_increasing_id())


def scd1_merge(target: DataFrame | None, batch: DataFrame, keys: list[str], latest_by: list[str] | None = None) -> DataFrame:
    """The whole dimension after the merge: batch rows replace or join the target's.

    Every non-key column is updated, so a matched target row is simply dropped
    and the batch row taken: an anti-join and a union. A small batch is then
    broadcast by size and the dimension is not shuffled at all, which a full
    outer join could not do. NULL keys match nothing; both sides' rows stay.

    Several batch rows for a key: the first by ``latest_by``, or failure when
    no order is given. The batch is read once, here, and staged as it is to be merged; so a
    failure shows at the call.
    """
    source = latest_per_key(batch, keys, latest_by) if latest_by else unique_or_fail(batch, keys)
    source = stage(source, "merge-batch")
    if target is None:
        return source
    if {name.lower() for name in target.columns} != {name.lower() for name in batch.columns}:
        raise ValueError("merge source and target must have the same columns")
    kept = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(source)


def merge_match(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """What a merge would do with every key: ``update``, ``insert`` or ``keep``.

    Keys of both sides are united and combined map-side, so copies of a key and
    a mass of NULL keys (which match nothing, one row each) gather nowhere.
    """
    sides = target.select(*keys, F.lit(1).alias("_target"), F.lit(0).alias("_batch")).unionByName(
        batch.select(*keys, F.lit(0).alias("_target"), F.lit(1).alias("_batch"))
    )
    missing = _any_null(keys)
    per_key = sides.filter(~missing).groupBy(*keys).agg(F.max("_target").alias("_target"), F.max("_batch").alias("_batch"))
    action = F.when(F.col("_batch") == 0, "keep").when(F.col("_target") == 0, "insert").otherwise("update")
    return per_key.unionByName(sides.filter(missing)).select(*keys, action.alias("merge_action"))


def _any_null(keys: list[str]):
    return reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
