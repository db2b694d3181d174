"""Files whose records hold line breaks, read by as many tasks as they have splits.

A JSON array, or CSV with line breaks inside quotes, can't be cut at a line end without knowing what came before it. So the
text is read in pieces (up to a closing brace, or up to a line end), which Spark's text source splits among tasks at any
place. What a piece does is worked out for either state it may begin in, outside or inside quotes; the sums
over a split are combined by split, and say in which state, and how deep in brackets, each split begins. A
running sum within the split then tells where each record ends, and its pieces are put together. Only records that
cross from one split to the next are brought together by a second, small shuffle. Each whole record is parsed by
``from_json`` or ``from_csv``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPLIT = ["file", "start"]


def _pieces(spark: SparkSession, path: str | list[str], until: str) -> DataFrame:
    """``file``, ``start`` of the split, ``at`` (rises within a split), and ``text``, without its last character ``until``."""
    return spark.read.text(path, lineSep=until).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("text"),
    )


def json_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``record``, the text of each object of files that hold one JSON array of objects, or objects one after another.

    Strings stand in double quotes and a record may hold any braces, quotes and line breaks. An array that isn't
    closed loses its last, unfinished object.
    """
    pieces = _pieces(spark, path, "}")
    plain = F.regexp_replace("text", r"(?s)\\.", "")  # without escaped characters
    quotes = _count(plain, '"')
    outside = _depth(plain, quotes % 2 == 0)
    inside = _depth(F.regexp_replace(plain, r'^[^"]*("|$)', ""), quotes % 2 == 1)
    array = F.ltrim(F.regexp_replace("text", "^\ufeff", "")).startswith("[") | F.regexp_like("text", F.lit(r"^[\s\ufeff]*\["))
    steps = pieces.select(*_SPLIT, "at", "text", quotes.alias("quotes"), outside.alias("outside"), inside.alias("inside"), array.cast("int").alias("base"))
    lead = r"^[\s,\[\ufeff]+"
    return _records(steps, "}").select(F.concat(F.regexp_replace("record", lead, ""), F.lit("}")).alias("record"))


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``record``, the text of each record, and whether it is the ``first`` of its file.

    A value that holds a quote stands in quotes, and the quote is doubled. A record whose quotes aren't closed by the end
    of its file is lost. Blank lines between records are left out.
    """
    pieces = _pieces(spark, path, "\n")
    zero = F.lit(0)
    steps = pieces.select(*_SPLIT, "at", "text", _count(F.col("text"), '"').alias("quotes"), zero.alias("outside"), zero.alias("inside"), zero.alias("base"))
    whole = _records(steps, "\n").select(F.regexp_replace("record", "\r$", "").alias("record"), "first")
    return whole.filter(F.trim("record") != "")


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _depth(plain: Column, closes: Column) -> Column:
    """Brackets opened less those closed outside quotes, the brace that ends a piece included if it isn't quoted."""
    bare = F.regexp_replace(plain, r'"[^"]*("|$)', "")
    return _count(bare, r"[\[{]") - _count(bare, r"[\]}]") - closes.cast("int")


def _records(steps: DataFrame, until: str) -> DataFrame:
    """``record`` and whether it is the ``first`` of its file.

    ``steps`` are pieces with their number of ``quotes``, how far they go down in brackets if they begin ``outside``
    and ``inside`` quotes, and the ``base``, which counts for the first piece of a file: a record ends with a
    piece that ends outside quotes, at the depth of the base. Pieces of an array's file go on after its last record.
    """
    running = Window.partitionBy(*_SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    odd = F.sum("quotes").over(running)
    steps = steps.withColumns({"odd": F.pmod(odd, F.lit(2)), "before": F.pmod(odd - F.col("quotes"), F.lit(2))})
    # For a split that begins outside (0) or inside (1) quotes, the depth gained up to the end of each piece.
    gains = {s: F.when(F.col("before") == s, F.col("outside")).otherwise(F.col("inside")) for s in (0, 1)}
    steps = steps.withColumns({f"depth{s}": F.sum(gains[s]).over(running) for s in (0, 1)})
    # One row per split: its sums for both states, and in which it begins, from the splits before it in its file.
    last = F.max(F.struct("at", "odd", "depth0", "depth1")).alias("last")
    splits = steps.groupBy(*_SPLIT).agg(last, F.min(F.struct("at", "base"))["base"].alias("base"))
    in_file = Window.partitionBy("file").orderBy("start")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("state", F.pmod(F.coalesce(F.sum("last.odd").over(earlier), F.lit(0)), F.lit(2)))
    gain = F.when(F.col("state") == 0, F.col("last.depth0")).otherwise(F.col("last.depth1"))
    splits = splits.withColumn("gain", gain).select(
        *_SPLIT, "state", F.coalesce(F.sum("gain").over(earlier), F.lit(0)).alias("depth"),
        F.first("base").over(in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("file_base"),
        F.when(F.lead("start").over(in_file).isNull(), F.col("last.at")).alias("final"),
    )
    placed = steps.drop("base").join(splits, _SPLIT)
    depth = F.col("depth") + F.when(F.col("state") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    outside = F.pmod(F.col("state") + F.col("odd"), F.lit(2)) == 0
    tail = (F.col("file_base") > 0) & F.col("at").eqNullSafe(F.col("final"))
    placed = placed.select(*_SPLIT, "at", "text", (outside & (depth == F.col("file_base")) & ~tail).cast("int").alias("ends"))
    numbered = placed.withColumn("nr", F.sum("ends").over(running) - F.col("ends"))
    part = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda piece: piece["text"]), until)
    found = numbered.groupBy(*_SPLIT, "nr").agg(part.alias("part"), F.max("ends").alias("ends"))
    inner = found.filter("nr > 0 AND ends = 1").select(F.col("part").alias("record"), F.lit(False).alias("first"))
    return inner.unionByName(_across_splits(found.filter("nr = 0 OR ends = 0"), until))


def _across_splits(parts: DataFrame, until: str) -> DataFrame:
    """Records that begin or end at the edge of a split, from the first and the last, open part of each split.

    An open part belongs to the next part of its file that ends, which is the first part of a later split.
    """
    order = Window.partitionBy("file").orderBy("start", "nr").rowsBetween(Window.unboundedPreceding, 0)
    chained = parts.withColumn("chain", F.sum("ends").over(order) - F.col("ends"))
    record = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "nr", "part"))), lambda p: p["part"]), until)
    tied = chained.groupBy("file", "chain").agg(record.alias("record"), F.max("ends").alias("ends"))
    return tied.filter("ends = 1").select("record", (F.col("chain") == 0).alias("first"))


def ddl(schema: str | T.StructType) -> str:
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
