"""Texts staged in blocks, and tables written so that a task reads just its block's part.

An operator that needs what the whole corpus says about the strings of a text sends out each
block's distinct strings and gets the answers back by block. So texts stay where they are: the
task that reads a block opens its part of the answers from the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallylake.llm.shared_files import locate
from tallylake.workspace import scratch_path, stage

#: Bytes of text after which a new block begins.
BLOCK_BYTES = 24 << 20


def _number(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, row, held = TaskContext.get().partitionId() << 24, 0, 0
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                blocks, rows = [], []
                for text in part.column(part.num_columns - 1).fill_null(b""):
                    blocks.append(block)
                    rows.append(row)
                    row += 1
                    held += len(text.as_buffer())
                    if held >= block_bytes:
                        block, row, held = block + 1, 0, 0
                columns = [pa.array(blocks, pa.int64()), pa.array(rows, pa.int32()), *part.columns]
                yield pa.RecordBatch.from_arrays(columns, ["block", "row", *part.schema.names])

    return run


def stage_blocks(rows: DataFrame, label: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``rows``, whose last column is a binary text, written with the ``block`` and ``row`` they get."""
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("row", T.IntegerType()), *rows.schema.fields])
    return stage(rows.mapInArrow(_number(block_bytes), schema), label, "zstd")


def write_by_block(df: DataFrame, label: str) -> str:
    """The folder of ``df``, written by its column ``block``."""
    folder = scratch_path(df.sparkSession, label)
    df.repartition("block").write.partitionBy("block").parquet(folder, compression="zstd")
    return folder


def read_block(folder: str, block: int, columns: list[str]) -> list[pa.Table]:
    """One block's part, file by file; nothing if it has none."""
    system, path = locate(f"{folder}/block={block}")
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    files = [f.path for f in found if f.is_file and f.base_name.endswith(".parquet")]
    return [pq.ParquetFile(system.open_input_file(f)).read(columns=columns) for f in files]


def parts_of(column: pa.BinaryArray) -> tuple[memoryview, np.ndarray]:
    """The bytes of a column without nulls one after another, and the length of each value."""
    if not len(column):
        return memoryview(b""), np.zeros(0, np.int64)
    _, ends, data = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(ends, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return memoryview(data or b"")[ends[0] : ends[-1]], np.diff(ends)
