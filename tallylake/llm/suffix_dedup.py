"""Removal of repeated substrings by prefix-free parsing.

A byte is removed if it lies in a string of ``LENGTH`` bytes that also starts in a document
with a smaller id. Texts are bytes, and strings never cross documents.

Triggers: of the ``GRAM``-byte strings in each window of ``LENGTH`` bytes, the one with the least
hash (the first of equals). So equal windows have equal triggers at equal places, wherever they
are. Triggers cut a text into phrases; each owns the run of windows it is the trigger of,
and these windows are all its own: every window belongs to one phrase.

Dictionary: the trigger strings of all texts. One that is in a single document is shared with
no other, and its phrase is done. Only the phrases of shared triggers go on. For one trigger,
what stands left of it (the phrases' suffixes, sorted backwards) and what follows from it on
(the parse, sorted forwards) are put in order; a window is a suffix rank at its own length
and a parse rank at the length that is left, so both orders together give the order, and so
the classes, of all windows without sorting the windows themselves. The least id of a
class tells which of its windows are repeats.

Whole copies of a text meet by their SHA-256 first and take no part in the rest. Triggers with
more than ``list_rows`` phrases are left to Spark window by window (by a 128-bit hash, combined
before the shuffle), so no list is larger than that. Texts aren't shuffled (see ``blocks``).

Defined cases: a NULL text is empty; a NULL id counts as larger than any other; rows with
equal ids don't affect each other; empty tables give empty results; columns besides id and
text aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm.blocks import BLOCK_BYTES, read_block, stage_blocks, write_by_block
from tallylake.workspace import discard, forget_shuffles, stage

LENGTH, GRAM = 50, 16
REACH = LENGTH - GRAM  #: Most bytes of a window before its trigger.
CONTEXT = REACH + LENGTH
LIST_ROWS = 100_000
#: Bytes of text parsed at a time.
PARSE_BYTES = 1 << 21

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_PLACES = np.uint64((1 << 24) - 1)


# Parsing


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place of ``data`` on (padded at its end)."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(GRAM + 16, np.uint8)])
    words = np.empty(-(-(n + 8) // 8) * 8, np.uint64)
    for o in range(8):
        part = padded[o : o + (len(padded) - o) // 8 * 8].view("<u8")
        own = words[o::8]
        own[: len(part)] = part[: len(own)]
    h = words[:n] * _M1
    h ^= h >> np.uint64(32)
    h += words[8 : n + 8]
    h *= _M2
    h ^= h >> np.uint64(29)
    h *= _M1
    h ^= h >> np.uint64(32)
    return h


def parse(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """The phrases of some texts: number of the text, hash of the trigger, its place, and the first and last window it owns.

    Places are in the joined texts; ``PARSE_BYTES`` and one text more fit the packed order.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum(sizes) - sizes
    if len(data) < LENGTH or sizes.max() < LENGTH:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    h = _gram_hashes(data)
    if len(data) <= int(_PLACES):
        least = _leftmost(h)
    else:  # a single very long text, in overlapping pieces
        step = int(_PLACES) // 2
        least = np.concatenate([_leftmost(h[k : k + step + LENGTH - 1])[:step] + k for k in range(0, len(data), step)])[: len(data) - LENGTH + 1]
    windows = np.concatenate([np.arange(s, s + n - LENGTH + 1) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True) if n >= LENGTH])
    trigger = least[windows]
    new = np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (windows[1:] != windows[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows)) - 1
    place = trigger[first]
    return np.searchsorted(starts, place, side="right") - 1, h[place], place, windows[first], windows[last]


def _leftmost(h: np.ndarray) -> np.ndarray:
    """For each window start, the place of its least hash (the first of equals, by the upper 40 bits)."""
    n, reach = len(h) - LENGTH + 1, REACH + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least = (h & ~_PLACES) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[: width - reach], least[reach - width :])
    return (least[:n] & _PLACES).astype(np.int64)


def _parts(batch: pa.RecordBatch, text_at: int, skip) -> Iterator[tuple[list[int], list[bytes]]]:
    """Rows of a batch with their texts, ``PARSE_BYTES`` at a time; all of one block."""
    rows, texts, held, now = [], [], 0, None
    blocks = batch.column(0).to_pylist()
    for k, text in enumerate(batch.column(text_at)):
        if rows and (held >= PARSE_BYTES or blocks[k] != now):
            yield rows, texts
            rows, texts, held = [], [], 0
        now = blocks[k]
        own = text.as_py() or b""
        if len(own) >= LENGTH and not skip(k):
            if held + len(own) > int(_PLACES) and rows:
                yield rows, texts
                rows, texts, held = [], [], 0
            rows.append(k)
            texts.append(own)
            held += len(own)
    if rows:
        yield rows, texts


class _Side:
    """One block's rows of a side table, as a set or an array."""

    def __init__(self, folder: str, columns: list[str]):
        self.folder, self.columns, self.block, self.found = folder, columns, None, None

    def of(self, block: int) -> list[np.ndarray]:
        if block != self.block:
            tables = read_block(self.folder, block, self.columns)
            self.found = [np.concatenate([np.empty(0, np.int64), *(t[c].to_numpy() for t in tables)]) for c in self.columns]
            self.block = block
        return self.found


def _skipping(copies: _Side, batch: pa.RecordBatch):
    blocks, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    sets: dict[int, set] = {}

    def skip(k: int) -> bool:
        block = blocks[k]
        if block not in sets:
            sets[block] = set(copies.of(block)[0].tolist())
        return rows[k] in sets[block]

    return skip


def _dictionary(copies: str):
    """Every block's trigger strings, once each: its hash, the block, and whether two of its documents have it."""

    def rows(block, grams, docs):
        grams, docs = np.concatenate(grams), np.concatenate(docs)
        order = np.lexsort((docs, grams))
        grams, docs = grams[order], docs[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        last = np.append(first[1:], len(grams)) - 1
        several = docs[first] != docs[last]
        for k in range(0, len(first), 100_000):
            own = grams[first[k : k + 100_000]]
            marks = np.full(len(own), block) * 2 + several[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(marks)], ["gram", "mark"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side, now, grams, docs = _Side(copies, ["row"]), None, [], []
        for batch in batches:
            blocks, numbers = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for own, texts in _parts(batch, 2, _skipping(side, batch)):
                if blocks[own[0]] != now:
                    if grams:
                        yield from rows(now, grams, docs)
                    now, grams, docs = blocks[own[0]], [], []
                doc, gram, *_ = parse(texts)
                if len(doc):
                    grams.append(gram)
                    docs.append(numbers[np.array(own)[doc]])
        if grams:
            yield from rows(now, grams, docs)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by trigger, those of triggers that are in two documents; a task holds back one row."""
    rest, rest_seen = None, False
    for batch in batches:
        gram, mark = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(gram):
            continue
        if rest is not None:
            gram, mark = np.concatenate([rest[0], gram]), np.concatenate([rest[1], mark])
        same = gram[1:] == gram[:-1]
        shared = (mark & 1).astype(bool)
        shared[1:] |= same
        shared[:-1] |= same
        if rest is not None and rest_seen:
            shared[0] = True
        keep = shared[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(gram[:-1][keep]), pa.array(mark[:-1][keep] >> 1)], ["gram", "block"])
        rest, rest_seen = (gram[-1:], mark[-1:]), bool(shared[-1])
    if rest is not None and rest_seen:
        yield pa.RecordBatch.from_arrays([pa.array(rest[0]), pa.array(rest[1] >> 1)], ["gram", "block"])


def _needed(least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which of the ``CONTEXT`` bytes around its trigger a phrase's own windows hold."""
    at = np.arange(CONTEXT)
    return (at >= REACH - most[:, None]) & (at < REACH + LENGTH - least[:, None])


def _around(least: np.ndarray, most: np.ndarray, held: pa.Array) -> np.ndarray:
    """The bytes around the triggers, zero where a phrase doesn't need them."""
    around = np.zeros((len(least), CONTEXT), np.uint8)
    around[_needed(least, most)] = np.frombuffer(b"".join(held.to_pylist()), np.uint8)
    return around


def _phrases(copies: str, dictionary: str):
    """The phrases of shared triggers, with what stands around the trigger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side, live, sorted_for, known = _Side(copies, ["row"]), _Side(dictionary, ["gram"]), None, None
        for batch in batches:
            blocks, numbers = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            ids = batch.column(3).to_numpy()
            for own, texts in _parts(batch, 2, _skipping(side, batch)):
                block = blocks[own[0]]
                if sorted_for != block:
                    sorted_for, known = block, np.unique(live.of(block)[0].view(np.uint64))
                if not len(known):
                    continue
                doc, gram, place, first, last = parse(texts)
                if not len(doc):
                    continue
                at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
                some = np.flatnonzero(known[at] == gram)
                sizes = np.array([len(t) for t in texts])
                starts = np.cumsum(sizes) - sizes
                data = np.concatenate([np.zeros(REACH, np.uint8), np.frombuffer(b"".join(texts), np.uint8), np.zeros(LENGTH, np.uint8)])
                for k in range(0, len(some), 20_000):
                    part = some[k : k + 20_000]
                    least, most = place[part] - last[part], place[part] - first[part]
                    needed = _needed(least, most)
                    around = data[place[part, None] + np.arange(CONTEXT)][needed]
                    offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(needed.sum(1))]).astype(np.int32))
                    rows = np.array(own)[doc[part]]
                    columns = [
                        pa.array(gram[part].view(np.int64)),
                        pa.array(np.full(len(part), block)),
                        pa.array(numbers[rows].astype(np.int32)),
                        pa.array(ids[rows]),
                        pa.array((place[part] - starts[doc[part]]).astype(np.int32)),
                        pa.array(least.astype(np.int16)),
                        pa.array(most.astype(np.int16)),
                        pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, offsets, pa.py_buffer(around.tobytes())]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, _PHRASE.names)

    return run


_PHRASE = T.StructType(
    [T.StructField("gram", T.LongType()), T.StructField("block", T.LongType()), T.StructField("row", T.IntegerType()), T.StructField("id", T.LongType())]
    + [T.StructField("place", T.IntegerType()), T.StructField("least", T.ShortType()), T.StructField("most", T.ShortType()), T.StructField("around", T.BinaryType())]
)
_SPAN = "block long, row int, start int, end int"


# Orders of suffixes and of the parse


def _classes(strings: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of some byte strings within their lists, and how far each agrees with the one before (-1: another list)."""
    width = -(-strings.shape[1] // 8) * 8
    padded = np.zeros((len(strings), width), np.uint8)
    padded[:, : strings.shape[1]] = strings
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((*(words[:, k] for k in range(words.shape[1] - 1, -1, -1)), lists))
    own = strings[order]
    same = own[1:] == own[:-1]
    agree = np.where(same.all(1), strings.shape[1], same.argmin(1))
    agree[lists[order][1:] != lists[order][:-1]] = -1
    return order, np.concatenate([[-1], agree])


def _class_at(order: np.ndarray, agree: np.ndarray, depth: int) -> np.ndarray:
    """Number of each string's class when only ``depth`` bytes count."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(agree < depth)
    return out


def repeats(lists: np.ndarray, ids: np.ndarray, least: np.ndarray, most: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each phrase the smallest and the largest number of bytes before its trigger of a window that an earlier document has too.

    (REACH + 1, -1) if there is none. ``least`` and ``most`` bound the windows that the phrase owns.
    """
    suffixes = _classes(around[:, :REACH][:, ::-1], lists)
    parses = _classes(around[:, REACH:], lists)
    low, high = np.full(len(ids), REACH + 1), np.full(len(ids), -1)
    for before in range(REACH + 1):
        rows = np.flatnonzero((least <= before) & (before <= most))
        if len(rows) < 2:
            continue
        key = _class_at(*suffixes, before)[rows] * (len(ids) + 1) + _class_at(*parses, LENGTH - before)[rows]
        order = np.lexsort((ids[rows], key))
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        first = ids[rows][order][np.flatnonzero(new)]
        found = np.empty(len(rows), bool)
        found[order] = first[np.cumsum(new) - 1] < ids[rows][order]
        hit = rows[found]
        low[hit] = np.minimum(low[hit], before)
        high[hit] = before
    return low, high


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated spans of phrases that are sorted by trigger."""

    def emit(table: pa.Table):
        columns = [table[c].to_numpy() for c in ("gram", "block", "row", "id", "place", "least", "most")]
        gram, block, row, ids, place, least, most = columns
        around = _around(least, most, table["around"])
        lists = np.cumsum(np.concatenate([[True], gram[1:] != gram[:-1]]))
        low, high = repeats(lists, ids, least, most, around)
        hit = high >= 0
        start, end = (place - high)[hit], (place - low)[hit] + LENGTH
        yield pa.RecordBatch.from_arrays([pa.array(block[hit]), pa.array(row[hit]), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["block", "row", "start", "end"])

    rest, held = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        gram = batch.column(0).to_numpy()
        cut = len(gram) - int(np.argmin((gram == gram[-1])[::-1])) if gram[0] != gram[-1] else 0
        if cut == 0 and rest and rest[-1].column(0)[-1].as_py() != gram[0]:
            yield from emit(pa.Table.from_batches(rest))
            rest, held = [], 0
        if cut:
            yield from emit(pa.Table.from_batches([*rest, batch.slice(0, cut)]))
            rest, held = [], 0
        rest.append(batch.slice(cut))
        held += batch.num_rows - cut
    if rest:
        yield from emit(pa.Table.from_batches(rest))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of some phrases, as a 128-bit hash."""
    for batch in batches:
        for k in range(0, batch.num_rows, 2000):
            block, row, ids, place, least, most = (batch.column(c).slice(k, 2000).to_numpy() for c in range(1, 7))
            around = _around(least, most, batch.column(7).slice(k, 2000))
            for before in range(REACH + 1):
                some = np.flatnonzero((least <= before) & (before <= most))
                if not len(some):
                    continue
                own = around[some, REACH - before : REACH - before + LENGTH].astype(np.uint64)
                one, two = np.zeros(len(some), np.uint64), np.full(len(some), 7, np.uint64)
                for c in range(LENGTH):
                    one = (one ^ own[:, c]) * _M1
                    one ^= one >> np.uint64(32)
                    two = (two + own[:, c]) * _M2
                    two ^= two >> np.uint64(31)
                columns = [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(block[some]), pa.array(row[some]), pa.array(ids[some]), pa.array((place[some] - before).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["one", "two", "block", "row", "id", "start"])


def _cut(copies: str, spans: str):
    """What is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone, found = _Side(copies, ["row"]), _Side(spans, ["row", "start", "end"])
        now, whole, order, rows, starts, ends = None, set(), None, None, None, None
        for batch in batches:
            out = []
            for block, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if block != now:
                    now, whole = block, set(gone.of(block)[0].tolist())
                    rows, starts, ends = found.of(block)
                    order = np.argsort(rows, kind="stable")
                    rows, starts, ends = rows[order], starts[order], ends[order]
                own = text.as_py() or b""
                data = np.frombuffer(own, np.uint8)
                edge = np.zeros(len(own) + 1, np.int64)
                if row in whole and len(own) >= LENGTH:
                    edge[0], edge[-1] = 1, -1
                else:
                    part = slice(*np.searchsorted(rows, [row, row + 1]))
                    np.add.at(edge, starts[part], 1)
                    np.add.at(edge, ends[part], -1)
                removed = np.cumsum(edge[:-1]) > 0
                runs = int((np.diff(np.concatenate([[0], removed.astype(np.int8)])) == 1).sum())
                out.append((len(own), int(removed.sum()), runs, data[~removed].tobytes()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(3), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, list_rows: int = LIST_ROWS) -> DataFrame:
    """Every row's ``id``, bytes, removed bytes, maximal removed runs, and the ``kept`` bytes."""
    none = (1 << 63) - 1
    rows = docs.select(F.col(id_col).alias("given"), F.coalesce(F.col(id_col).cast("long"), F.lit(none)).alias("id"), F.col(text_col).cast("binary").alias("text"))
    texts = stage_blocks(rows, "suffix-texts", block_bytes).select("block", "row", "text", "id", "given")

    prints = texts.select("block", "row", "id", F.sha2(F.coalesce("text", F.lit(b"")), 256).alias("of"))
    firsts = prints.groupBy("of").agg(F.min("id").alias("least"), F.max("id").alias("greatest")).filter("least < greatest")
    copies = write_by_block(prints.join(firsts, "of").filter("id > least").select("block", "row"), "suffix-copies")

    words = texts.select("block", "row", "text").mapInArrow(_dictionary(copies), "gram long, mark long")
    shared = words.repartition("gram").sortWithinPartitions("gram").mapInArrow(_shared, "gram long, block long")
    dictionary = write_by_block(shared, "suffix-dictionary")

    phrases = stage(texts.select("block", "row", "text", "id").mapInArrow(_phrases(copies, dictionary), _PHRASE), "suffix-phrases", "zstd")
    del words, shared
    forget_shuffles(docs.sparkSession)
    hot = stage(phrases.groupBy("gram").count().filter(F.col("count") > list_rows).select("gram"), "suffix-hot")  # at most rows / list_rows
    long_lists = not hot.isEmpty()
    listed = phrases.join(hot, "gram", "left_anti").select(*_PHRASE.names) if long_lists else phrases
    spans = listed.repartition("gram").sortWithinPartitions("gram").mapInArrow(_spans, _SPAN)
    if long_lists:
        windows = phrases.join(hot, "gram", "left_semi").select(*_PHRASE.names)
        windows = windows.mapInArrow(_windows, "one long, two long, block long, row int, id long, start int")
        least = windows.groupBy("one", "two").agg(F.min("id").alias("least"))
        found = windows.join(least, ["one", "two"]).filter("id > least")
        spans = spans.unionByName(found.select("block", "row", "start", (F.col("start") + LENGTH).alias("end")))
    spans = write_by_block(spans, "suffix-spans")
    discard(phrases)
    kept = T.StructType([T.StructField("id", texts.schema["given"].dataType), *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())])
    return texts.select("block", "row", "text", "given").mapInArrow(_cut(copies, spans), kept)


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``remove_repeats`` with the SHA-256 of the kept bytes in their place."""
    found = remove_repeats(docs, id_col, text_col, **options)
    return found.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
