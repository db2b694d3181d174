"""JSON and CSV sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.sources.records import csv_records, ddl, json_records

# Fixed value: the schema of the navigation files.
NAVIGATION_SCHEMA = "id string, comments string, pagevisit array<string>"


def read_json(spark: SparkSession, path: str, schema: str | T.StructType, multiline: bool = False) -> DataFrame:
    """JSON with an explicit schema.

    JSON Lines files are split among tasks. ``multiline`` is for files that hold one JSON array of objects each, or
    objects over several lines; they are split among tasks too (see ``sources.records``).
    """
    if not multiline:
        return spark.read.schema(schema).json(path)
    return json_records(spark, path).select(F.from_json("record", schema).alias("row")).select("row.*")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    delimiter: str = ",",
    header: bool = False,
    infer: bool = False,
    multiline: bool = False,
    null_text: str = "",
) -> DataFrame:
    """Delimited text.

    Give a schema where there is one: without it every column is a string, and
    ``infer`` reads all files a second time to find the types. Columns without
    a header or schema are called ``_c0``, ``_c1`` and so on.

    ``multiline`` reads quoted values that hold line breaks; files are split among tasks all the same (see
    ``sources.records``; ``infer`` alone reads each file in one). ``null_text`` is what stands for NULL: with the default,
    an empty string cannot be told from NULL.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    plain = reader.csv(
        path, sep=delimiter, header=header, inferSchema=infer if schema is None else None,
        multiLine=multiline, quote='"', escape='"', nullValue=null_text,
    )
    if not multiline:
        return plain
    how = {"sep": delimiter, "quote": '"', "escape": '"', "nullValue": null_text}
    return _csv_rows(spark, path, plain.schema, header, how).select("row.*")


def _csv_rows(spark: SparkSession, path: str, schema: T.StructType, header: bool, how: dict[str, str]) -> DataFrame:
    records = csv_records(spark, path)
    if header:
        records = records.filter("NOT first")
    return records.select(F.from_csv("record", ddl(schema), how).alias("row"))


def read_csv_with_rejects(
    spark: SparkSession,
    path: str,
    schema: str,
    delimiter: str = ",",
    header: bool = False,
    reject_column: str = "wrong_data",
    multiline: bool = False,
) -> DataFrame:
    """Permissive read: a line that does not fit the schema is kept whole in ``wrong_data``.

    With ``multiline``, values may hold line breaks, and a rejected record is kept with them.

    Spark parses only the columns a query needs, and would then miss a bad value
    in any other. The always true test over all columns makes every use of the
    reject column parse the whole line.
    """
    data = T.StructType.fromDDL(schema)
    if multiline:
        whole = T.StructType(data.fields).add(reject_column, "string")
        how = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": reject_column}
        return _csv_rows(spark, path, whole, header, how).select("row.*")
    rows = spark.read.schema(T.StructType(data.fields).add(reject_column, "string")).csv(
        path, sep=delimiter, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=reject_column,
        quote='"', escape='"',
    )
    all_parsed = F.concat_ws("", *[F.col(name).cast("string") for name in data.names]) >= ""
    return rows.withColumn(reject_column, F.when(all_parsed, F.col(reject_column)))


def split_rejects(rows: DataFrame, reject_column: str = "wrong_data") -> tuple[DataFrame, DataFrame]:
    """Good rows without the reject column, and the rows that carry a rejected line."""
    good = rows.filter(F.col(reject_column).isNull()).drop(reject_column)
    return good, rows.filter(F.col(reject_column).isNotNull())


READERS = {"json": read_json, "csv": read_csv}


def read_data(kind: str, spark: SparkSession, path: str, **options) -> DataFrame:
    """Read by format name; an unknown format is an error."""
    if kind not in READERS:
        raise ValueError(f"unknown format {kind!r}, expected one of {sorted(READERS)}")
    return READERS[kind](spark, path, **options)
