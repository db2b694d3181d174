"""Benchmark decontamination with a broadcast hash set of normalised test n-grams.

Words are runs of digits, letters a-z (A-Z in lower case) and anything beyond ASCII. A
window is ``size`` consecutive words of a benchmark item, or all words of a shorter item.
Tasks hold the windows as hashes of word numbers; runs of benchmark words in a document
are hashed the same way, and every hash hit is verified word by word before its words
are marked.

The benchmark is small, but that is checked and not assumed: it goes out in slices of at
most ``slice_bytes`` of item text (one item at least). The driver reads one slice after another, and
broadcasts it by itself; where more than one is needed, the documents are staged with the hits of each
before the next, and its broadcast is taken back. An item that is larger than a slice is the one thing that is broadcast whole. Nothing is
shuffled, and Python gets the texts and gives back the hits, while the rows stay where they are.

Defined cases: a NULL or empty text or item has no words; an item with a NULL id marks
words but isn't listed; items with equal ids count as one; an empty benchmark marks
nothing; repeated documents are judged each on its own; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.workspace import stage

#: Each byte as part of a word, in lower case, or as a space.
_FOLD = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_MIX = 0x9E3779B97F4A7C15

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


_HITS_ARROW = pa.struct(
    [("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class Windows:
    """The windows of some items: word numbers, and by window length a sorted array of hashes with what they stand for."""

    def __init__(self, items: list[tuple[str | None, bytes]], size: int):
        self.numbers: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set]] = {}
        for item, text in items:
            row = [self.numbers.setdefault(w, len(self.numbers)) for w in words_of(text)]
            length = min(size, len(row))
            if length:
                windows = by_length.setdefault(length, {})
                for i in range(len(row) - length + 1):
                    windows.setdefault(tuple(row[i : i + length]), set()).add(item)
        self.tables = []
        for length, windows in sorted(by_length.items()):
            rows = np.array(list(windows), np.int64).reshape(len(windows), length)
            hashes = rolling(rows.ravel(), length)[::length]
            order = np.argsort(hashes, kind="stable")
            self.tables.append((length, hashes[order], rows[order], [sorted(x for x in s if x is not None) for s in (list(windows.values())[k] for k in order)]))


def rolling(numbers: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` word numbers."""
    n = len(numbers) - length + 1
    total = np.zeros(max(n, 0), np.uint64)
    for k in range(length):
        total *= np.uint64(_MIX)
        total += numbers[k : k + n].astype(np.uint64) + np.uint64(1)
        total ^= total >> np.uint64(29)
    return total


def find(windows: Windows, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
    """Which words are inside a window, and the ids of the items whose windows occur."""
    hit, items = np.zeros(len(words), bool), set()
    number = windows.numbers.get
    row = np.array([number(w, -1) for w in words], np.int64)
    known = np.concatenate([[0], np.cumsum(row >= 0)])
    for length, hashes, rows, names in windows.tables:
        starts = np.flatnonzero(known[length:] - known[:-length] == length) if len(words) >= length else []
        if not len(starts):
            continue
        own = row[starts[:, None] + np.arange(length)]
        sums = rolling(own.ravel(), length)[::length]
        at = np.searchsorted(hashes, sums)
        while True:  # equal hashes of different windows stand side by side
            some = at < len(hashes)
            some[some] = hashes[at[some]] == sums[some]
            starts, own, sums, at = starts[some], own[some], sums[some], at[some]
            if not len(starts):
                break
            same = (rows[at] == own).all(1)
            for i, k in zip(starts[same].tolist(), at[same].tolist(), strict=True):
                hit[i : i + length] = True
                items.update(names[k])
            at = at + 1
    return hit, items


def _spans(hit: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edges[::2].tolist(), edges[1::2].tolist()


def _scan(windows: Broadcast):
    """The hits of some texts, with those found before."""

    @F.arrow_udf(HITS)
    def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
        found = []
        for text, old in zip(texts, before, strict=True):
            words = words_of(text.as_py())
            hit, items = find(windows.value, words)
            if (old := old.as_py()) is not None:
                items |= set(old["items"])
                for a, b in zip(old["starts"], old["ends"], strict=True):
                    hit[a:b] = True
            starts, ends = _spans(hit)
            found.append({"n_words": len(words), "starts": starts, "ends": ends, "items": sorted(items)})
        return pa.array(found, _HITS_ARROW)

    return scan


def slices(benchmark: DataFrame, id_col: str, text_col: str, slice_bytes: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items with a text, in slices that the driver holds one at a time."""
    items = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("binary")).filter(F.octet_length(text_col) > 0)
    now, held = [], 0
    for item, text in items.toLocalIterator():
        if now and held + len(text) > slice_bytes:
            yield now
            now, held = [], 0
        now.append((item, bytes(text)))
        held += len(text)
    if now:
        yield now


def mark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 13, slice_bytes: int = 8 << 20) -> DataFrame:
    """``doc`` (the row), ``t`` (its text as bytes) and ``hits``: number of words, hit spans of words, ids of the items found."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).cast("binary").alias("t"), F.lit(None).cast(HITS).alias("hits"))
    context, sent = docs.sparkSession.sparkContext, None
    for items in slices(benchmark, item_col, item_text_col, slice_bytes):
        if sent is not None:
            rows = stage(rows, "decontaminate-hits", "zstd")
            sent.destroy()
        sent = context.broadcast(Windows(items, size))
        rows = rows.withColumn("hits", _scan(sent)("t", "hits"))
    return rows if sent is not None else rows.withColumn("hits", _scan(context.broadcast(Windows([], size)))("t", "hits"))


def _n_hit(hits):
    return F.aggregate(F.zip_with(hits["starts"], hits["ends"], lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda t, n: t + n)


def _contaminated(share: float = 0.05):
    """Hit words make up at least a ``share`` of all, and are at least one."""
    n, of = F.col("n_hit"), F.col("n_words")
    return (n > 0) & (n * 100 >= of * round(share * 100))


def judge_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Every document's words, hit words, items found (with a digest of their ids) and whether it counts as contaminated."""
    rows = mark(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("x")), benchmark, "x", **options)
    items = F.col("hits.items")
    found = rows.select(
        F.col("doc.id").alias(id_col),
        F.col("hits.n_words").alias("n_words"),
        _n_hit(F.col("hits")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
    )
    return found.withColumn("contaminated", _contaminated())


def drop_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that aren't contaminated, as they are."""
    rows = mark(docs, benchmark, text_col, **options).select("doc", F.col("hits.n_words").alias("n_words"), _n_hit(F.col("hits")).alias("n_hit"))
    return rows.filter(~_contaminated()).select("doc.*")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for text, hits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if text is None or not hits["starts"]:
                kept.append(text)
                continue
            word = np.frombuffer(text.translate(_FOLD), np.uint8) != 32
            first, last = (np.array(x) for x in _spans(word))
            parts, at = [], 0
            for a, b in zip(hits["starts"], hits["ends"], strict=True):
                parts.append(text[at : first[a]])
                at = last[b - 1]
            kept.append(b"".join([*parts, text[at:]]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], ["doc", "t"])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All documents, their texts without the hit spans (from the first hit word's start to the last one's end)."""
    rows = mark(docs, benchmark, text_col, **options)
    cut = rows.mapInArrow(_cut, T.StructType([rows.schema["doc"], T.StructField("t", T.BinaryType())]))
    return cut.select(*[F.col("t").cast("string").alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns])
