"""Relational sources over JDBC. Credentials arrive as options, never in a URL or file here."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcDatabase:
    """Where a database is; ``options`` holds user, password, driver, fetchsize and the like."""

    url: str
    options: dict[str, str] = field(default_factory=dict, repr=False)

    def reader_options(self, table: str) -> dict[str, str]:
        return {**self.options, "url": self.url, "dbtable": table}


def derived_table(sql: str, alias: str = "src") -> str:
    """A query in the place of a table, so that the database runs its joins and filters."""
    return f"({sql.strip().rstrip(';')}) {alias}"


def read_jdbc(spark: SparkSession, database: JdbcDatabase, table: str) -> DataFrame:
    """A table, or a ``derived_table``, over one connection. For small tables only."""
    return spark.read.format("jdbc").options(**database.reader_options(table)).load()


def partition_options(column: str, lower, upper, partitions: int) -> dict[str, str]:
    """Options of a range-split read. Bounds split the rows; they never drop any."""
    if partitions < 1:
        raise ValueError("at least one partition")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def key_range(spark: SparkSession, database: JdbcDatabase, table: str, column: str) -> tuple:
    """Lowest and highest value of a column, computed by the database."""
    sql = f"select min({column}) as lo, max({column}) as hi from {table}"
    row = read_jdbc(spark, database, derived_table(sql, "bounds")).first()
    return row[0], row[1]


def read_jdbc_partitioned(
    spark: SparkSession, database: JdbcDatabase, table: str, column: str, partitions: int, lower=None, upper=None
) -> DataFrame:
    """Parallel read in ``partitions`` ranges of ``column``.

    Without bounds the real key range is asked for first: guessed bounds far
    from the keys would leave all rows to one task. An empty table (no range)
    is read plainly.
    """
    if lower is None or upper is None:
        lower, upper = key_range(spark, database, table, column)
        if lower is None:
            return read_jdbc(spark, database, table)
    options = {**database.reader_options(table), **partition_options(column, lower, upper, partitions)}
    return spark.read.format("jdbc").options(**options).load()


def bounds_text(table: str, column: str, step: int) -> str:
    """Every ``step``-th value of a column in its order, numbered by the database; NULLs have no place.

    Equal values are counted first, so only one row per distinct value is put in order; its ``place`` is 0 where a
    step ends within its rows.
    """
    upto = f"sum(count({column})) over (order by {column} rows unbounded preceding)"
    place = f"case when mod({upto}, {step}) < count({column}) then 0 else 1 end"
    ranked = f"select {column} as k, {place} as place from {table} where {column} is not null group by {column}"
    return f"select distinct k from ({ranked}) ranked where mod(place, {step}) = 0 order by k"


def range_predicates(column: str, bounds: list) -> list[str]:
    """Conditions that split a table at ascending bounds; every row, NULLs too, meets exactly one."""
    texts = [_literal(b) for b in bounds]
    if not texts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} and {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [f"{column} < {texts[0]} or {column} is null", *inner, f"{column} >= {texts[-1]}"]


def _literal(value) -> str:
    if isinstance(value, date):
        return f"{'timestamp' if isinstance(value, datetime) else 'date'} '{value}'"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def read_jdbc_balanced(spark: SparkSession, database: JdbcDatabase, table: str, column: str, partitions: int) -> DataFrame:
    """Parallel read in up to ``partitions`` ranges of ``column`` that hold about as many rows each.

    Equal ranges of keys, as ``read_jdbc_partitioned`` takes, leave most rows to one task where keys lie close together or one
    is frequent. Here the database names the keys at equal steps of its rows; a key that holds several steps gets a
    range of its own. The column may be of any ordered type. Two small queries come first.
    """
    if partitions < 1:
        raise ValueError("at least one partition")
    count = read_jdbc(spark, database, derived_table(f"select count(*) as n from {table}", "counted")).first()[0]
    step = max(1, -(-int(count) // partitions))
    found = read_jdbc(spark, database, derived_table(bounds_text(table, column, step).removesuffix(" order by k"), "bounds"))
    bounds = sorted(row[0] for row in found.collect())  # at most one per partition
    return spark.read.jdbc(database.url, table, predicates=range_predicates(column, bounds), properties=database.options)
