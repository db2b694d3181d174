"""JSON and CSV sinks. A path may be on any file system Spark can write to."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame


def dated_path(prefix: str, as_of: date) -> str:
    """The prefix followed by the date as yyyyMMdd."""
    return f"{prefix}{as_of:%Y%m%d}"


def compact(df: DataFrame) -> DataFrame:
    """Let adaptive execution size the output: one file for a small report, more for a large one."""
    return df.hint("rebalance")


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compacted: bool = False) -> None:
    """JSON Lines."""
    (compact(df) if compacted else df).write.mode(mode).json(path)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    delimiter: str = ",",
    header: bool = False,
    compacted: bool = False,
    null_text: str = "",
) -> None:
    """Delimited text. Quotes are doubled and blanks kept, so values read back unchanged.

    Give a ``null_text`` (to the reader too) where empty strings must not become NULL.
    """
    (compact(df) if compacted else df).write.mode(mode).csv(
        path, sep=delimiter, header=header, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, nullValue=null_text,
    )


WRITERS = {"json": write_json, "csv": write_csv}


def write_data(kind: str, df: DataFrame, path: str, **options) -> None:
    """Write by format name; an unknown format is an error."""
    if kind not in WRITERS:
        raise ValueError(f"unknown format {kind!r}, expected one of {sorted(WRITERS)}")
    WRITERS[kind](df, path, **options)
