"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

A source's documents, in the order of a hash of their ids, are cut into blocks of
``block_rows``. With weight w the block i of a source is released at floor(i / w) and due at
ceil((i + 1) / w). In every slot the released block that is due first is taken (then the
source that comes first by name). Weights add up to one, so this meets all dates, and after t
slots every source has given w * t blocks, to less than one block.

Weights are rounded to whole multiples of 1 / ``slots`` by largest remainder, so the schedule
repeats: it is worked out once for that many slots, whatever the data, and any block finds its
slot by a lookup. Rounding adds less than a block in every period to the deviation from a weight
that is no such multiple. For weights that are given, ``slots`` is raised to up to ten times as
many, the first that meets all weights or else the one that comes closest; a weight that would
still be rounded to none has one slot, at the cost of the largest. The mix
ends where the first source has no block left for its slot; later documents are left
out. They are given their slots all the same.

Documents are numbered in buckets of about ``bucket_rows`` by hash range, so a source with a
third of all rows is spread like the rest; only ids and sources are shuffled. Sources are
known to the driver one by one only if they hold at least ``min_share`` of the rows.

Defined cases: a NULL source is a source; rows with equal ids (or NULL ones) follow each
other in no defined order, and at the end of the mix are left out together; an empty table
gives an empty result; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Slots before the schedule repeats, and so the finest weight; for weights that are given, at least.
SLOTS = 1000


@dataclass(frozen=True)
class Group:
    """One source, or all those without a group of their own (``pooled``)."""

    name: str | None
    rows: int
    units: int
    pooled: bool = False


def _whole(weights: list[float], slots: int) -> list[int]:
    """Weights as whole units that add up to ``slots``: largest remainders are rounded up. What comes to none is given one of the most."""
    share = [round(w * slots / sum(weights), 9) for w in weights]
    units = [int(x) for x in share]
    by_rest = sorted(range(len(share)), key=lambda k: (int(share[k]) - share[k], k))
    for k in by_rest[: slots - sum(units)]:
        units[k] += 1
    for k in range(len(units)):
        if not units[k]:
            units[units.index(max(units))] -= 1
            units[k] = 1
    return units


def _closest(weights: list[float], slots: int) -> list[int]:
    """Whole units of the number of slots, one to ten times ``slots``, that comes closest to the weights; the smallest of equals."""
    total = sum(weights)

    def off(units: list[int]) -> float:
        return round(max(abs(u / sum(units) - w / total) for u, w in zip(units, weights, strict=True)), 12)

    return min((_whole(weights, slots * k) for k in range(1, 11)), key=off)


def groups(docs: DataFrame, source_col: str = "source", weights: dict[str | None, float] | None = None, power: float = 0.7, min_share: float = 0.01, slots: int = SLOTS) -> list[Group]:
    """The groups with their units, by name (NULL first, the pool last).

    With ``weights``, those sources and no others. Without, sources of at least ``min_share``
    of the rows; the rest are pooled, and if the pool is smaller than that, with the smallest
    source. Weights are then the numbers of rows to the ``power``.
    """
    counts = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("n"))
    by_name = lambda x: (x[0] is not None, x[0] or "")
    if weights is not None:
        if not all(w > 0 for w in weights.values()) or not 0 < len(weights) <= slots:
            raise ValueError(f"between 1 and {slots} weights above zero")
        named = counts.filter(F.col("source").isin([k for k in weights if k is not None]) | F.col("source").isNull())
        rows = {r["source"]: r["n"] for r in named.collect()}
        listed = sorted(weights.items(), key=by_name)
        units = _closest([w for _, w in listed], slots)
        return [Group(k, rows.get(k, 0), u) for (k, _), u in zip(listed, units, strict=True)]
    total = docs.count()
    large = sorted(((r["source"], r["n"]) for r in counts.filter(F.col("n") >= F.lit(min_share) * total).collect()), key=lambda x: (-x[1], by_name(x)))
    pool = total - sum(n for _, n in large)
    if 0 < pool < min_share * total and large:
        pool += large.pop()[1]
    found = [Group(k, n, 0) for k, n in sorted(large, key=by_name)] + ([Group(None, pool, 0, True)] if pool else [])
    units = _whole([g.rows**power for g in found], slots) if found else []
    return [Group(g.name, g.rows, u, g.pooled) for g, u in zip(found, units, strict=True)]


def schedule(spark: SparkSession, units: list[int], slots: int = SLOTS) -> DataFrame:
    """``grp``, ``i`` (the block within the period) and ``slot`` of one period, by earliest deadline first."""
    u, last = f"array({', '.join(map(str, units))})", len(units) - 1
    due = f"CAST(ceil((s.next[g] + 1) * {slots} / {u}[g]) AS INT)"
    ready = f"s.next[g] < {u}[g] AND s.next[g] * {slots} < (t + 1) * {u}[g]"
    first = f"array_min(filter(transform(sequence(0, {last}), g -> IF({ready}, named_struct('due', {due}, 'g', g), NULL)), x -> x IS NOT NULL)).g"
    step = f"transform(array({first}), b -> named_struct('next', transform(s.next, (x, k) -> IF(k = b, x + 1, x)), 'taken', concat(s.taken, array(b))))[0]"
    start = f"named_struct('next', array_repeat(0, {len(units)}), 'taken', CAST(array() AS ARRAY<INT>))"
    taken = f"aggregate(sequence(0, {slots - 1}), {start}, (s, t) -> {step}, s -> s.taken)"
    rows = spark.range(1, numPartitions=1).select(F.posexplode(F.expr(taken)).alias("slot", "grp"))
    return rows.select("grp", (F.row_number().over(Window.partitionBy("grp").orderBy("slot")) - 1).alias("i"), "slot")


def _group_of(source: Column, found: list[Group]) -> Column:
    """The number of a source's group; NULL if it has none."""
    out = F.lit(next((k for k, g in enumerate(found) if g.pooled), None)).cast("int")
    for k, g in enumerate(found):
        if not g.pooled:
            out = F.when(source.isNull() if g.name is None else source.eqNullSafe(F.lit(g.name)), k).otherwise(out)
    return out


def _key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def _per_group(found: list[Group], value, grp: Column) -> Column:
    return F.get(F.array(*[F.lit(value(g)).cast("long") for g in found]), grp)


def _numbered(docs: DataFrame, found: list[Group], id_col: str, source_col: str, bucket_rows: int) -> DataFrame:
    """``id``, ``source``, ``grp``, ``key`` and ``nr``, the place of a row in its group."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"))
    rows = rows.withColumn("grp", _group_of(F.col("source").cast("string"), found)).withColumn("key", _key(F.col("id")))
    buckets = _per_group(found, lambda g: -(-g.rows // bucket_rows), F.col("grp"))
    head = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = rows.filter("grp IS NOT NULL").withColumn("bucket", F.floor(head * buckets / (1 << 32)))
    sizes = rows.groupBy("grp", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("grp").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("grp", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("grp", "bucket").orderBy("key", "id"))
    return rows.withColumn("within", within).join(sizes, ["grp", "bucket"]).withColumn("nr", F.col("before") + F.col("within") - 1)


def _placed(spark, found: list[Group], slots: int, block_rows: int):
    """The schedule, and the slot at which the mix ends."""
    table = schedule(spark, [g.units for g in found], slots).collect()  # one row per slot
    place = {(r["grp"], r["i"]): r["slot"] for r in table}

    def slot(k: int, block: int) -> int:
        period, i = divmod(block, found[k].units)
        return period * slots + place[k, i]

    end = min((slot(k, -(-g.rows // block_rows)) for k, g in enumerate(found)), default=0)
    return spark.createDataFrame(table, "grp int, i int, slot int"), end


def _ends(numbered: DataFrame, found: list[Group], slots: int, block_rows: int, table: DataFrame, end: int) -> list:
    """By group, the key of the first row that is left out; None if all stay."""
    kept = {r["grp"]: 0 for r in table.select("grp").distinct().collect()}
    for r in table.collect():
        whole, rest = divmod(end, slots)
        kept[r["grp"]] += (whole + (r["slot"] < rest)) * block_rows
    cut = {k: n for k, n in kept.items() if n < found[k].rows}
    limits = F.get(F.array(*[F.lit(cut.get(k)).cast("long") for k in range(len(found))]), F.col("grp"))
    return {r["grp"]: r["key"] for r in numbered.filter(F.col("nr") == limits).select("grp", "key").collect()}


def _stays(key: Column, grp: Column, ends: dict[int, str], found: list[Group]) -> Column:
    end = F.get(F.array(*[F.lit(ends.get(k)).cast("string") for k in range(len(found))]), grp)
    return grp.isNotNull() & (end.isNull() | (key < end))


def mix_order(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights=None, block_rows: int = 8, slots: int = SLOTS, bucket_rows: int = 10_000, **options) -> DataFrame:
    """Every document's group, block, its dates and slot, its place in the mix, and whether the mix reaches it.

    Documents of a source without a weight aren't returned.
    """
    spark = docs.sparkSession
    found = groups(docs, source_col, weights, slots=slots, **options)
    if not sum(g.rows for g in found):
        found = [Group(None, 0, slots, True)]
    slots = sum(g.units for g in found)
    numbered = _numbered(docs, found, id_col, source_col, bucket_rows)
    table, end = _placed(spark, found, slots, block_rows)
    ends = _ends(numbered, found, slots, block_rows, table, end)
    units = _per_group(found, lambda g: g.units, F.col("grp"))
    blocks = numbered.withColumn("block", F.floor(F.col("nr") / block_rows)).withColumn("units", units)
    blocks = blocks.withColumn("i", F.col("block") % F.col("units")).withColumn("base", F.floor(F.col("block") / F.col("units")) * slots)
    placed = blocks.join(F.broadcast(table), ["grp", "i"])
    return placed.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        F.when(F.get(F.array(*[F.lit(g.pooled) for g in found]), "grp"), F.lit(True)).otherwise(False).alias("pooled"),
        "block",
        (F.col("base") + F.floor(F.col("i") * slots / F.col("units"))).alias("release"),
        (F.col("base") + F.ceil((F.col("i") + 1) * slots / F.col("units"))).alias("deadline"),
        (F.col("base") + F.col("slot")).alias("slot"),
        ((F.col("base") + F.col("slot")) * block_rows + F.col("nr") % block_rows).alias("position"),
        _stays(F.col("key"), F.col("grp"), ends, found).alias("kept"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights=None, block_rows: int = 8, slots: int = SLOTS, bucket_rows: int = 10_000, **options) -> DataFrame:
    """The documents that the mix reaches, as they are. Their texts aren't shuffled: where a source ends is known by its hash."""
    found = groups(docs, source_col, weights, slots=slots, **options)
    if not sum(g.rows for g in found):
        return docs.limit(0)
    slots = sum(g.units for g in found)
    numbered = _numbered(docs, found, id_col, source_col, bucket_rows)
    table, end = _placed(docs.sparkSession, found, slots, block_rows)
    ends = _ends(numbered, found, slots, block_rows, table, end)
    return docs.filter(_stays(_key(F.col(id_col)), _group_of(F.col(source_col).cast("string"), found), ends, found))
