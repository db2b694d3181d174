"""Row numbers, ranks and changes, one way for groups of every size.

A window function sorts each of its groups in a single task. Here rows are dealt to parts by (keys,
order) instead, so a large group covers many parts: a sample gives the bounds, every row finds
its part by a binary search, and one shuffle by part brings the rows of a part together, in order. What a window says within
a part is written once to shared storage. Only the group at a part's edge goes on in the next
part, so one row per part, its last, tells all later ones what they must add. No size is looked at, and nothing gathers
in one task: rows that agree in keys and order are put in a fixed order by a hash of the
whole row, equal rows by their position in the input.

The input is counted, sampled, and then read once more for the shuffle; bounds of other rows, should the input
change between, shift the parts' sizes only. Columns are carried inside a struct, so no name of the input can
clash with one used here.

Order columns are named; a leading ``-`` means descending. NULLs sort first
ascending and last descending, as in Spark windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.workspace import stage

#: Rows of a part, on average, as long as there are not more parts than a few per shuffle partition.
ROWS_PER_PART = 5_000
PARTS_PER_TASK = 4
#: Sampled rows per part.
SAMPLED = 20


def order_columns(order_by: list[str]) -> list[Column]:
    return [F.col(name[1:]).desc() if name.startswith("-") else F.col(name).asc() for name in order_by]


def order_names(order_by: list[str]) -> list[str]:
    return [name.lstrip("-") for name in order_by]


def number_rows(
    df: DataFrame, keys: list[str], order_by: list[str], out: str = "row_num", start_after: DataFrame | None = None
) -> DataFrame:
    """``row_number() over (partition by keys order by order_by)`` as a bigint.

    The order is made total by a hash of all columns, so only equal rows may change places.
    With ``start_after`` (columns: the keys and ``out``, one row per group) a group
    continues from the number given there; other groups start at 1.
    """
    parts = _Parts(_wrapped(df), keys, order_by)
    staged = parts.write({"number": F.row_number().over(parts.by_group)})
    edges = parts.edges(staged).select("part", "group", "number")
    total = F.sum("number").over(_through_group())
    numbered = parts.beside_edges(staged, edges.withColumn("total", total), "total")
    number = F.col("number") + F.when(F.col("goes_on"), F.col("total")).otherwise(0)
    if start_after is not None:
        numbered = _with_start(numbered, keys, start_after.withColumnRenamed(out, "start"))
        number = number + F.coalesce(F.col("start"), F.lit(0))
    return _unwrapped(numbered, df, out, number)


def rank_rows(df: DataFrame, keys: list[str], order_by: list[str], out: str = "rnk") -> DataFrame:
    """``rank() over (partition by keys order by order_by)`` as a bigint; ties share a rank.

    Rows are staged, so that both readings see the same, and counted by (keys, order); only these counts are dealt to
    parts and summed up. A row's rank is one more than the rows before its tie, and is joined back to
    it: by broadcast where there are few ties, and where there are many by a shuffle, in which Spark splits frequent ones.
    """
    staged = stage(_wrapped(df), "ranked-rows")
    names = list(dict.fromkeys([*keys, *order_names(order_by)]))
    tie = [F.col(f"row.`{name}`") for name in names]
    counts = staged.groupBy(*[value.alias(f"tie{i}") for i, value in enumerate(tie)]).agg(F.count("*").alias("rows"))
    own = {name: f"tie{i}" for i, name in enumerate(names)}
    falling = [f"-{own[name[1:]]}" if name.startswith("-") else own[name] for name in order_by]
    parts = _Parts(_wrapped(stage(counts, "tie-counts")), [own[key] for key in keys], falling)
    summed = parts.write({"number": F.sum("row.rows").over(parts.by_group.rowsBetween(Window.unboundedPreceding, 0))})
    edges = parts.edges(summed).withColumn("total", F.sum("number").over(_through_group()))
    placed = parts.beside_edges(summed, edges, "total")
    before = F.col("number") - F.col("row.rows") + F.when(F.col("goes_on"), F.col("total")).otherwise(0)
    ranks = stage(placed.select(*[f"row.tie{i}" for i in range(len(names))], (before + 1).alias("rank")), "tie-ranks")
    same = reduce(Column.__and__, [value.eqNullSafe(F.col(f"tie{i}")) for i, value in enumerate(tie)], F.lit(True))
    return _unwrapped(staged.join(ranks, same), df, out, F.col("rank"))


def number_changes(
    df: DataFrame, keys: list[str], order_by: list[str], tracked: list[str], before: DataFrame | None = None, out: str = "row_num"
) -> DataFrame:
    """The rows that change something, numbered from 1 by group.

    A row is kept if its ``tracked`` columns differ (NULLs are equal) from those of the row before it in its
    group, kept or not; for the first row of a group, from its row in ``before`` (the keys,
    ``tracked``, and in ``out`` the number to go on from; one row per group), if it has one. NULL keys have none.
    """
    rows = _wrapped(df)
    own = F.struct(*[F.col(f"row.`{name}`") for name in tracked])
    if before is None:
        rows = rows.withColumn("known", F.lit(None).cast(df.select(*tracked).schema))
    else:
        kinds = dict(df.dtypes)
        known = before.select(*keys, F.struct(*[F.col(name).cast(kinds[name]).alias(name) for name in tracked]).alias("known"))
        rows = _with_start(rows, keys, known)
    parts = _Parts(rows, keys, order_by)
    starts = F.lag(F.lit(1)).over(parts.by_group).isNull()
    prior = F.when(starts, F.col("known")).otherwise(F.lag(own).over(parts.by_group))
    new = (starts & F.col("known").isNull()) | ~own.eqNullSafe(prior)
    counted = F.sum("changed").over(parts.by_group.rowsBetween(Window.unboundedPreceding, 0))
    first = F.lag(F.lit(1)).over(parts.by_part).isNull()
    staged = parts.write({"changed": new.cast("int"), "first": first}, {"number": counted})
    # The first row of a part was compared as if its group began there; the last row before it says what it should be.
    heads = staged.filter("first").select("part", parts.group.alias("head_group"), own.alias("head"), F.col("changed").alias("said"))
    ends = parts.edges(staged).withColumn("own", own).drop("row", "changed", "first").join(heads, "part")
    follows = F.lag(F.struct("group")).over(_in_order()).eqNullSafe(F.struct("head_group"))
    truth = (~F.lag("own").over(_in_order()).eqNullSafe(F.col("head"))).cast("int")
    ends = ends.withColumn("delta", F.when(follows, truth - F.col("said")).otherwise(0))
    alone = F.when(F.col("group").eqNullSafe(F.col("head_group")), F.col("delta")).otherwise(0)
    ends = ends.withColumn("number", F.col("number") + alone)
    ends = ends.withColumns({"total": F.sum("number").over(_through_group()), "add": F.lead("delta").over(_in_order())})
    numbered = parts.beside_edges(staged, ends, "total", "add")
    moved = F.when(F.col("goes_on"), F.col("add")).otherwise(0)
    kept = numbered.filter(F.col("changed") + F.when(F.col("first"), moved).otherwise(0) == 1)
    number = F.col("number") + moved + F.when(F.col("goes_on"), F.col("total")).otherwise(0)
    if before is not None and out in before.columns:
        kept = _with_start(kept, keys, before.select(*keys, F.col(out).alias("start")))
        number = number + F.coalesce(F.col("start"), F.lit(0))
    return _unwrapped(kept, df, out, number)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match each other; keeps the left key columns."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    return left.join(renamed, same, how).drop(*[f"_right_{key}" for key in keys])


def _in_order():
    return Window.orderBy("part")


def _through_group():
    """A group's parts follow each other; each but the last ends with the group."""
    return Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)


def _wrapped(df: DataFrame) -> DataFrame:
    return df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row"))


def _unwrapped(rows: DataFrame, df: DataFrame, out: str, value: Column) -> DataFrame:
    kept = [F.col(f"row.`{name}`") for name in df.columns if name != out]
    return rows.select(*kept, value.cast("bigint").alias(out))


def _with_start(rows: DataFrame, keys: list[str], start: DataFrame) -> DataFrame:
    """Rows with what ``start`` says of their group beside them; NULL keys match nothing."""
    named = start.withColumnsRenamed({key: f"start_key{i}" for i, key in enumerate(keys)})
    same = [F.col(f"row.`{key}`") == F.col(f"start_key{i}") for i, key in enumerate(keys)]
    return rows.join(named, reduce(Column.__and__, same, F.lit(True)), "left").drop(*[f"start_key{i}" for i in range(len(keys))])


class _Parts:
    """Rows, each in the struct ``row``, dealt to parts by keys and order."""

    def __init__(self, rows: DataFrame, keys: list[str], order_by: list[str]):
        self.group = F.struct(F.lit(0), *[F.col(f"row.`{key}`") for key in keys])
        self.tie = F.struct(F.lit(0), *[F.col(f"row.`{name}`") for name in order_names(order_by)])
        own = {f"key{i}": F.col(f"row.`{key}`") for i, key in enumerate(keys)}
        sorts = {f"order{i}": F.col(f"row.`{name}`") for i, name in enumerate(order_names(order_by))}
        # Maps have no hash of their own; a row that holds any is hashed as text.
        text = "map<" in rows.schema["row"].dataType.simpleString()
        settled = {"hash": F.xxhash64(F.to_json("row") if text else F.col("row")), "copy": F.monotonically_increasing_id()}
        falling = {f"order{i}" for i, name in enumerate(order_by) if name.startswith("-")}
        columns = {name: F.col(name).desc() if name in falling else F.col(name).asc() for name in [*own, *sorts, *settled]}
        self.rows = _dealt(rows.withColumns({**own, **sorts, **settled}), columns, falling)
        in_order = [columns[name] for name in sorts]
        self.by_part = Window.partitionBy("part").orderBy(*own, *in_order, "hash", "copy")
        self.by_group = Window.partitionBy("part", *own).orderBy(*in_order, "hash", "copy")
        self.by_order = Window.partitionBy("part", *own).orderBy(*(in_order or [F.lit(0)]))

    def write(self, *steps: dict[str, Column]) -> DataFrame:
        """``row``, ``part``, the columns of all steps, and whether a row is the ``last`` of its part."""
        rows = self.rows.repartition("part")
        for step in steps:
            rows = rows.withColumns(step)
        names = [name for step in steps for name in step]
        rows = rows.withColumn("last", F.lead(F.lit(1)).over(self.by_part).isNull())
        return stage(rows.select("row", "part", *names, "last"), "numbered-parts")

    def edges(self, staged: DataFrame) -> DataFrame:
        """The last row of each part, with its ``group``."""
        return staged.filter("last").withColumn("group", self.group)

    def beside_edges(self, staged: DataFrame, edges: DataFrame, *told: str) -> DataFrame:
        """All rows, with what the last row before their part tells them, and whether its group ``goes_on`` in theirs."""
        edges = edges.select(F.lead("part").over(_in_order()).alias("at"), F.col("group").alias("edge_group"), *told)
        edges = stage(edges.filter("at IS NOT NULL"), "part-edges")
        beside = staged.join(edges, F.col("part") == F.col("at"), "left")
        return beside.withColumn("goes_on", F.col("at").isNotNull() & self.group.eqNullSafe(F.col("edge_group")))


def _dealt(rows: DataFrame, columns: dict[str, Column], falling: set[str]) -> DataFrame:
    """Rows with the number of the ``part`` they belong to: how many sampled bounds aren't after them."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    initial = rows.sparkSession.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    count = rows.count()
    parts = min(-(-count // ROWS_PER_PART), PARTS_PER_TASK * max(tasks, int(initial or 0)))
    if parts <= 1:
        return rows.withColumn("part", F.lit(0))
    sampled = rows.select(*columns).sample(min(1.0, parts * SAMPLED / count), seed=1)
    placed = sampled.withColumn("place", F.row_number().over(Window.orderBy(*columns.values())))
    bounds = placed.filter(F.col("place") % SAMPLED == 0).agg(F.array_sort(F.collect_list(F.struct("place", F.struct(*columns).alias("bound"))))).scalar()
    rows = rows.withColumn("bounds", bounds)
    strides = [1 << k for k in reversed(range((2 * parts).bit_length()))]

    def step(at: Column, stride: Column) -> Column:
        bound = F.get("bounds", at + stride - 1)["bound"]
        return F.when((at + stride <= F.size("bounds")) & _not_after(bound, list(columns), falling), at + stride).otherwise(at)

    return rows.withColumn("part", F.aggregate(F.array(*map(F.lit, strides)), F.lit(0), step)).drop("bounds")


def _not_after(bound: Column, names: list[str], falling: set[str]) -> Column:
    """Whether a bound is a row's equal or comes before it, NULLs where sorting puts them."""
    if not falling:
        return bound <= F.struct(*names)  # structs compare field by field, NULLs first
    found = F.lit(True)
    for name in reversed(names):
        a, b = (F.col(name), bound[name]) if name in falling else (bound[name], F.col(name))
        found = F.when(a.eqNullSafe(b), found).otherwise(b.isNotNull() & (a.isNull() | (a < b)))
    return found
