"""Token ids as binary shards: frequency ranks in bytes, lengths in separate control bytes.

Ids are replaced by their rank in the whole corpus (the most frequent id is 0), so most take
one byte. A rank is written in one to four bytes, low byte first; a control byte holds the
lengths of four ranks, two bits each. Control bytes and data bytes lie apart, so a reader
finds all positions of a block with one running sum, of lengths that a table has by control byte, and gathers the bytes.

A shard file is a sequence of blocks (number of ids, of control bytes and of data bytes as
three unsigned 32-bit numbers, control bytes, data bytes), then the documents (id, null flag,
number of ids), and a fixed-size trailer. The id of every rank is in a file beside the shards, which
their trailers name; so the files alone give back the ids. Shards follow each other in ascending document
order. A task writes under a name of its own and reports it in its result, so an attempt
that is lost or runs twice leaves at most a file that nobody reads.

Defined cases: a NULL or empty text is the end id alone; documents with a NULL id come
first; documents with equal ids follow each other, ordered by a hash of their token ids; an
empty table gives no shard; ids are 64-bit numbers; other columns aren't written.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallylake.llm.blocks import parts_of
from tallylake.llm.shared_files import create, open_file
from tallylake.llm.word_ids import REMEMBERED, default_vocabulary, shared
from tallylake.workspace import scratch_path, stage

MAGIC = b"TOKSHRD2"
#: Magic, place of the document table, number of documents, number of ids, name of the ranks.
TRAILER = struct.Struct("<8sQQQ16s")
BLOCK = struct.Struct("<III")
BLOCK_IDS = 1 << 18

#: By control byte: how many more bytes than one each of its four ranks has; four small numbers that are read as one.
_MORE = (np.arange(256, dtype=np.uint8)[:, None] >> np.array([0, 2, 4, 6], np.uint8) & 3).view("<u4").ravel()


def encode(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of some ranks."""
    ranks = ranks.astype("<u4", copy=False)
    more = (ranks > 0xFF).view(np.uint8)
    for most in (0xFFFF, 0xFFFFFF):
        if (over := ranks > most).any():
            more = more + over
    data = np.empty(len(ranks) + int(more.sum(dtype=np.int64)), np.uint8)
    starts = _starts(more)
    data[starts] = ranks.view(np.uint8)[::4]
    at = np.flatnonzero(more)
    for byte in (1, 2, 3):
        data[starts[at] + byte] = ranks.view(np.uint8)[byte::4][at]
        at = at[more[at] > byte]
    padded = np.zeros(-(-len(more) // 4) * 4, np.uint8)
    padded[: len(more)] = more
    one, two, three, four = padded.reshape(-1, 4).T
    return (one | two << 2 | three << 4 | four << 6).tobytes(), data.tobytes()


def _starts(more: np.ndarray) -> np.ndarray:
    """Where each rank's first byte is."""
    return np.cumsum(more, dtype=np.int64) - more + np.arange(len(more))


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks; the last control byte may stand for fewer than four."""
    more = _MORE[np.frombuffer(control, np.uint8)].view(np.uint8)[:n]
    data, starts = np.frombuffer(data, np.uint8), _starts(more)
    ranks = data[starts].astype("<u4")
    at = np.flatnonzero(more)
    for byte in (1, 2, 3):
        ranks[at] |= data[starts[at] + byte].astype("<u4") << np.uint32(8 * byte)
        at = at[more[at] > byte]
    return ranks


def _block(ranks: np.ndarray) -> bytes:
    control, data = encode(ranks)
    return BLOCK.pack(len(ranks), len(control), len(data)) + control + data


def _document(doc: int | None, n: int) -> bytes:
    return struct.pack("<qBQ", doc or 0, doc is None, n)


def _trailer(table: int, n_docs: int, n_tokens: int, ranks: uuid.UUID) -> bytes:
    return TRAILER.pack(MAGIC, table, n_docs, n_tokens, ranks.bytes)


def _ranks_name(ranks: uuid.UUID) -> str:
    return f"ranks-{ranks.hex}.bin"


@lru_cache(4)
def read_ranks(path: str) -> np.ndarray:
    """The id of every rank."""
    with open_file(path) as source:
        return np.frombuffer(source.read(), "<u4").astype(np.uint32)


@dataclass(frozen=True)
class Shards:
    """``table`` has a row per file: shard (their order), path, first id's place, numbers of documents and ids."""

    table: DataFrame


def _encode_texts(path: str, end_id: int | None, remembered: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared(path, remembered)
        end = b"" if end_id is None else np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                ids = [x + end for x in encoder.texts(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    return run


def _count(dtype: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = np.frombuffer(parts_of(batch.column(0))[0], dtype)
            for k in range(0, len(ids), 1 << 20):  # many documents at once
                total += np.bincount(ids[k : k + (1 << 20)], minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["token", "n"])

    return run


def _write(folder: str, dtype: str, rank_of, ranks: uuid.UUID):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, docs, held, size, tokens = None, [], [], 0, 0
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.bin"

        ranks_of = rank_of.value
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                out = out or create(folder, name)
                own = ranks_of.take(np.frombuffer(ids.as_buffer(), dtype))
                docs.append(_document(doc, len(own)))
                held.append(own)
                size += len(own)
                tokens += len(own)
                if size >= BLOCK_IDS:
                    row = np.concatenate(held)
                    cut = size - size % BLOCK_IDS
                    for k in range(0, cut, BLOCK_IDS):
                        out.write(_block(row[k : k + BLOCK_IDS]))
                    held, size = [row[cut:]], size - cut
        if out is None:
            return
        if size:
            out.write(_block(np.concatenate(held)))
        out.write(b"".join([*docs, _trailer(out.tell(), len(docs), tokens, ranks)]))
        out.close()
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{folder}/{name}"], "n_docs": [len(docs)], "n_tokens": [tokens]})

    return run


def write_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int | None = 2, folder: str | None = None, remembered: int = REMEMBERED) -> Shards:
    """Encode every whole text, rank the ids by their counts in all texts, and write the shards.

    A task keeps the ids of about ``remembered`` words, at some 200 bytes each.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    own = shared(vocabulary, remembered)
    size, dtype = max(own.size, (end_id or 0) + 1), own.dtype.str
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    encoded = stage(rows.mapInArrow(_encode_texts(vocabulary, end_id, remembered), "id long, ids binary"), "token-ids", "zstd")
    counts = encoded.select("ids").mapInArrow(_count(dtype, size), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    total = np.zeros(size, np.int64)
    for row in counts.collect():  # at most a row per id of the vocabulary
        total[row["token"]] = row["n"]
    ranked = np.lexsort((np.arange(size), -total)).astype(np.uint32)
    rank_of = np.empty(size, np.uint32)
    rank_of[ranked] = np.arange(size, dtype=np.uint32)
    tied = encoded.withColumn("tie", F.xxhash64("ids"))
    sorted_rows = tied.repartitionByRange(F.asc_nulls_first("id"), "tie").sortWithinPartitions(F.asc_nulls_first("id"), "tie", "ids")
    folder, ranks = folder or scratch_path(spark, "token-shards"), uuid.uuid4()
    with create(folder, _ranks_name(ranks)) as out:  # as many numbers as the vocabulary has ids
        out.write(ranked.astype("<u4").tobytes())
    write = _write(folder, dtype, spark.sparkContext.broadcast(rank_of), ranks)
    files = sorted_rows.select("id", "ids").mapInArrow(write, "shard long, path string, n_docs long, n_tokens long")
    files = stage(files, "token-manifest")
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return Shards(files.withColumn("start", F.coalesce(before, F.lit(0))))


def read_file(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of a shard file with their ids, one block in memory at a time."""
    with open_file(path) as source:
        end = source.size() - TRAILER.size
        magic, table, _, _, ranks = TRAILER.unpack(source.read_at(TRAILER.size, end))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token shard")
        ranked = read_ranks(f"{path.rpartition('/')[0]}/{_ranks_name(uuid.UUID(bytes=ranks))}")
        documents = source.read_at(end - table, table)
        source.seek(0)
        held = np.empty(0, np.uint32)
        for doc, missing, n in struct.iter_unpack("<qBQ", documents):
            parts, size = [held], len(held)
            while size < n:
                count, control, data = BLOCK.unpack(source.read(BLOCK.size))
                parts.append(ranked.take(decode(source.read(control), source.read(data), count)))
                size += count
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield None if missing else doc, held[:n]
            held = held[n:]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows = []
            for doc, ids in read_file(path):
                rows.append((doc, start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4"))))
                start += len(ids)
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_shards(shards: Shards) -> DataFrame:
    """From the files: every document's id, place and number of ids, and the CRC-32 of its ids as 32-bit numbers."""
    files = shards.table.select("path", "start")
    tasks = max(1, min(10_000, shards.table.count()))
    return files.repartition(tasks).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    return read_shards(write_shards(docs, id_col, text_col, **options)).withColumnRenamed("doc_id", id_col)
