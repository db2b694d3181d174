"""Two tokenizations of each text, aligned where tokens of both end.

A token ends at a byte offset of its text, so each tokenizer gives a rising list of ends. The
shorter list drives a galloping search into the longer one: from where the last end was found,
strides double until they pass the wanted end, and a binary search finishes inside the last
stride. Ends in both lists cut the tokens into groups; and the rank of every short end in the
long list says which long tokens overlap the token that ends there, since it runs from one rank to the next. Lists of
many texts are laid behind each other (a text's last end is common to both) and searched in lanes,
all lanes at once in numpy.

How often two ids are linked is counted over the whole corpus: tasks count the pairs of a block of
texts, pairs are summed by a shuffle, and each block gets its pairs' sums back as files that the task
that reads the block opens from the shared folder. Texts and tokens aren't shuffled, and nothing but the highest
count of each id of the second vocabulary passes through the driver.

Byte-level ids come from the vocabulary's own library or, several times faster and with the same result, from another one given the
same vocabulary, where a text has only characters that both put in the same class, and no overlong word.

Defined cases: a NULL or empty text, bytes that aren't UTF-8, and a text that either side doesn't give back byte
for byte have no tokens; very long texts are searched in the same lanes; NULL and repeated ids are rows
like any other; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm.blocks import read_block, stage_blocks, write_by_block

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Beyond these characters, or for longer words, texts are left to the vocabulary's own library.
_UNUSUAL = re.compile(r"[^\x00-\u024f]|[^ \n\r\t]{1000}")
#: Ends that a lane of the galloping search places one after another.
LANE = 64
#: Bytes of text (or of ids) in work at a time.
WORK_BYTES = 1 << 20


def _byte_of_char() -> dict[str, int]:
    """The characters of a byte-level vocabulary: printable bytes stand for themselves, the others for code points from 256 up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TwoTokenizers:
    """Ids of both tokenizers."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        chars = _byte_of_char()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.bytes_a[k] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        n = self.b.get_piece_size()
        named = [self.b.id_to_piece(k) for k in range(n)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(named)]
        self.lengths_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.type_a = np.dtype("<u2" if len(self.bytes_a) <= 1 << 16 else "<u4")
        self.type_b = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.fast = self._fast(byte_level, vocabulary)

    def _fast(self, path: str, vocabulary: dict[str, int]):
        """The same vocabulary by ranks; None where its merges aren't in the order of their ids, or its pattern is another."""
        import tiktoken

        with open(path, encoding="utf-8") as source:
            own = json.load(source)
        split = own.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, str) else "".join(m) for m in own["model"].get("merges", [])]
        made = [vocabulary.get(m.replace(" ", "")) for m in merges]
        if own.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            return None
        if None in made or made != sorted(made):
            return None
        special = {token["content"] for token in own.get("added_tokens", [])}
        ranks = {self.bytes_a[k]: k for token, k in vocabulary.items() if token not in special}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _first(self, texts: list[str]) -> list[list[int]]:
        usual = [self.fast is not None and not _UNUSUAL.search(t) for t in texts]
        others = iter(self.a.encode_batch_fast([" " + t for t, u in zip(texts, usual, strict=True) if not u], add_special_tokens=False))
        return [self.fast.encode_ordinary(" " + t) if u else next(others).ids for t, u in zip(texts, usual, strict=True)]

    def texts(self, texts: list[bytes | None]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of both sides as bytes, empty where there are no tokens."""
        plain = []
        for text in texts:
            try:
                plain.append((text or b"").decode())
            except UnicodeDecodeError:
                plain.append("")
        for text, a, b in zip(plain, self._first(plain), self.b.encode(plain, num_threads=1), strict=True):
            whole = b" " + text.encode()
            same = text and b"".join(map(self.bytes_a.__getitem__, a)) == whole == b"".join(map(self.bytes_b.__getitem__, b))
            yield (np.array(a, self.type_a).tobytes(), np.array(b, self.type_b).tobytes()) if same else (b"", b"")


@lru_cache(1)
def shared(byte_level: str, pieces: str) -> TwoTokenizers:
    """One for the process, so that a Python worker's next task finds the words of the last one."""
    return TwoTokenizers(byte_level, pieces)


def gallop(short: np.ndarray, long: np.ndarray, lane: int = LANE) -> np.ndarray:
    """For every value of the rising list ``short``, how many of the rising list ``long`` lie below it.

    Lanes of ``lane`` consecutive values start by a binary search each and then gallop, value by value.
    """
    n, m = len(short), len(long)
    ranks = np.empty(n, np.int64)
    fenced = np.append(long, np.iinfo(np.int64).max)
    starts = np.arange(0, n, lane)
    cursor = np.searchsorted(long, short[starts])
    for step in range(min(lane, n)):
        at = starts + step
        if at[-1] >= n:
            starts, cursor, at = starts[:-1], cursor[:-1], at[:-1]
        wanted = short[at]
        low = cursor - 1  # below the wanted value, or before the list
        high = cursor.copy()
        stride = 1
        behind = np.flatnonzero(fenced[high] < wanted)
        while len(behind):
            low[behind] = high[behind]
            high[behind] = np.minimum(high[behind] + stride, m)
            stride *= 2
            behind = behind[fenced[high[behind]] < wanted[behind]]
        apart = np.flatnonzero(high - low > 1)
        while len(apart):
            middle = (low[apart] + high[apart]) // 2
            below = fenced[middle] < wanted[apart]
            low[apart[below]] = middle[below]
            high[apart[~below]] = middle[~below]
            apart = apart[high[apart] - low[apart] > 1]
        ranks[at] = cursor = high
    return ranks


def _cuts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


class Aligned:
    """The alignment of some texts, given the ids of both sides text by text (neither or both empty)."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], lengths_a: np.ndarray, lengths_b: np.ndarray):
        self.a, self.b = np.concatenate([*a, np.empty(0, np.int64)]).astype(np.int64), np.concatenate([*b, np.empty(0, np.int64)]).astype(np.int64)
        self.at_a, self.at_b = _cuts([len(x) for x in a]), _cuts([len(x) for x in b])
        ends_a, ends_b = np.cumsum(lengths_a[self.a]), np.cumsum(lengths_b[self.b])
        texts = range(len(a))
        part_a, part_b = [slice(*self.at_a[i : i + 2]) for i in texts], [slice(*self.at_b[i : i + 2]) for i in texts]
        drives = [len(a[i]) <= len(b[i]) for i in texts]  # whether a text's first side is the shorter one

        def dealt(x, y):
            """By text: of the driving side, of the other."""
            pairs = [(x[p], y[q]) if d else (y[q], x[p]) for d, p, q in zip(drives, part_a, part_b, strict=True)]
            return [np.concatenate([*side, np.empty(0, np.int64)]).astype(np.int64) for side in zip(*pairs, strict=True)] if pairs else [np.empty(0, np.int64)] * 2

        short, long = dealt(ends_a, ends_b)
        at_short = _cuts([min(len(a[i]), len(b[i])) for i in texts])
        ranks = gallop(short, long) if len(short) else np.empty(0, np.int64)
        common = long[ranks] == short if len(short) else np.empty(0, bool)
        first = np.concatenate([[0], ranks + common])[: len(ranks)]
        counts = ranks - first + 1
        self.at_links = _cuts(counts)[at_short]
        self.at_groups = _cuts(common)[at_short]
        by_short = np.repeat(np.arange(len(short)), counts)
        by_long = np.arange(counts.sum()) - np.repeat(_cuts(counts)[:-1] - first, counts)
        ids_short, ids_long = dealt(self.a, self.b)
        flipped = np.repeat(~np.array(drives, bool), np.diff(self.at_links))
        one, two = ids_short[by_short], ids_long[by_long]
        self.link_a, self.link_b = np.where(flipped, two, one), np.where(flipped, one, two)
        #: Group of every token of either side.
        ends = np.zeros(len(long), np.int64)
        ends[ranks[common]] = 1
        group_short, group_long = np.cumsum(common) - common, np.cumsum(ends) - ends
        at_long = _cuts([max(len(a[i]), len(b[i])) for i in texts])
        parts = [(group_short[slice(*at_short[i : i + 2])], group_long[slice(*at_long[i : i + 2])]) for i in texts]
        sides = [p if d else p[::-1] for d, p in zip(drives, parts, strict=True)]
        none = np.empty(0, np.int64)
        self.group_a = np.concatenate([*(s[0] for s in sides), none]).astype(np.int64)
        self.group_b = np.concatenate([*(s[1] for s in sides), none]).astype(np.int64)

    def groups(self, names: tuple[list[bytes], list[bytes]]) -> Iterator[str]:
        """Text by text: ids of a group joined by commas, the sides by ``|``, groups by ``;``."""
        n = int(self.at_groups[-1]) if len(self.at_groups) else 0
        of_a, of_b = np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)
        last_a = np.append(self.group_a[1:] != self.group_a[:-1], True)[: len(self.a)]
        last_b = np.append(self.group_b[1:] != self.group_b[:-1], True)[: len(self.b)]
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[np.arange(len(self.a)) + _cuts(of_b)[self.group_a]] = 2 * self.a + last_a
        order[np.arange(len(self.b)) + _cuts(of_a)[self.group_b + 1]] = len(names[0]) + 2 * self.b + last_b
        written = [*map((names[0] + names[1]).__getitem__, order.tolist())]
        for i, start in enumerate((self.at_a + self.at_b)[:-1].tolist()):
            yield b"".join(written[start : int(self.at_a[i + 1] + self.at_b[i + 1])])[:-1].decode()


def _encode(byte_level: str, pieces: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = shared(byte_level, pieces)
        for batch in batches:
            for k, end in work(batch.column(1)):
                part = batch.slice(k, end - k)
                a, b = zip(*both.texts(part.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["id", "a", "b"])

    return run


def work(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``WORK_BYTES``."""
    start, held = 0, 0
    for k, value in enumerate(column):
        held += 0 if not value.is_valid else len(value.as_buffer())
        if held >= WORK_BYTES:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(column):
        yield start, len(column)


def token_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """Staged rows ``block``, ``row``, ``id``, and the ids of both sides, ``a`` and ``b``, as little-endian numbers."""
    byte_level, pieces = _paths(byte_level, pieces)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = T.StructType([rows.schema["id"], T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    return stage_blocks(rows.mapInArrow(_encode(byte_level, pieces), kind), "token-pairs")


def _paths(byte_level, pieces):
    return byte_level or public_tokenizers.path(BYTE_LEVEL), pieces or public_tokenizers.path(PIECES)


def _chunks(batches, both: TwoTokenizers):
    """Rows of one block, some at a time, with their alignment."""
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(start, stop - start)
            for k, end in work(part.column("b")):
                rows = part.slice(k, end - k)
                a = [np.frombuffer(x.as_buffer(), both.type_a) for x in rows.column("a")]
                b = [np.frombuffer(x.as_buffer(), both.type_b) for x in rows.column("b")]
                yield int(blocks[start]), rows, Aligned(a, b, both.lengths_a, both.lengths_b)


def _count(byte_level: str, pieces: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = shared(byte_level, pieces)
        now, held, size = None, [], 0

        def merged():
            pairs, at = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            return pairs, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        def emit():
            if held:
                pairs, n = merged()
                for k in range(0, len(pairs), 1 << 18):
                    cut = slice(k, k + (1 << 18))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs[cut]), now)), pa.array(pairs[cut]), pa.array(n[cut])], ["block", "pair", "n"])

        for block, _, aligned in _chunks(batches, both):
            if block != now:
                yield from emit()
                now, held, size = block, [], 0
            held.append(np.unique(aligned.link_a * len(both.bytes_b) + aligned.link_b, return_counts=True))
            size += len(held[-1][0])
            if size > 4 << 20:
                held = [merged()]
                size = 0
        yield from emit()

    return run


def _judge(byte_level: str, pieces: str, folder: str, highest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = shared(byte_level, pieces)
        n_b = len(both.bytes_b)
        names = [], []
        for k in range(len(both.bytes_a)):
            names[0].extend((b"%d," % k, b"%d|" % k))
        for k in range(n_b):
            names[1].extend((b"%d," % k, b"%d;" % k))
        best = highest.value
        now, pairs, total = None, np.empty(0, np.int64), np.empty(0, np.int64)
        for block, rows, aligned in _chunks(batches, both):
            if block != now:
                tables = read_block(folder, block, ["pair", "total"])
                pairs, total = (np.concatenate([np.empty(0, np.int64), *(t.column(c).to_numpy() for t in tables)]).astype(np.int64) for c in ("pair", "total"))
                order = np.argsort(pairs)
                pairs, total, now = pairs[order], total[order], block
            found = np.empty(0, np.int64)
            if len(aligned.link_a):
                found = total[np.searchsorted(pairs, aligned.link_a * n_b + aligned.link_b)]
            columns = [
                rows.column("id"),
                *(pa.array(np.diff(x).astype(np.int64)) for x in (aligned.at_a, aligned.at_b, aligned.at_groups, aligned.at_links)),
                *(pa.array(np.diff(_cuts(x)[aligned.at_links]).astype(np.int64)) for x in (found == best[aligned.link_b], found)),
                pa.array(list(aligned.groups(names)), pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", *COLUMNS, "groups"])

    return run


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """Every row's id, numbers of tokens, groups and links, links of the highest count of their second id, the sum of all counts,
    and the ``groups`` themselves as text (ids of a group by commas, sides by ``|``, groups by ``;``)."""
    byte_level, pieces = _paths(byte_level, pieces)
    both = shared(byte_level, pieces)
    n_b = len(both.bytes_b)
    staged = token_pairs(docs, id_col, text_col, byte_level, pieces)
    counted = staged.mapInArrow(_count(byte_level, pieces), "block long, pair long, n long")
    # A pair has a row per block at most, so its window is small beside a block.
    summed = counted.withColumn("total", F.sum("n").over(Window.partitionBy("pair"))).select("block", "pair", "total")
    folder = write_by_block(summed, "pair-counts")
    spark = docs.sparkSession
    totals = spark.read.schema("pair long, total long").parquet(folder)
    best = np.zeros(n_b, np.int64)
    for row in totals.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("total").alias("total")).collect():  # a row per id of the vocabulary
        best[row["b"]] = row["total"]
    kind = T.StructType([staged.schema["id"], *(T.StructField(c, T.LongType()) for c in COLUMNS), T.StructField("groups", T.StringType())])
    judged = staged.mapInArrow(_judge(byte_level, pieces, folder, spark.sparkContext.broadcast(best)), kind)
    return judged.withColumnRenamed("id", id_col)


def align_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``align`` with the SHA-256 of the groups in their place ('' where a text has no tokens)."""
    found = align(docs, id_col, text_col, **options)
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.select(id_col, *COLUMNS, sha.alias("groups_sha256"))
