"""Edit-aware token counts: a segment tree over the pre-tokens of each document.

A text is cut before a word, every ``LEAF_WORDS`` words, into leaves; the vocabulary drops
white space, so no token crosses a cut. A leaf keeps its length and number of tokens, and the
tree the sums. An edit re-encodes the leaves it touches and, as boundary context, the leaf
that holds the byte after it, to which a shortened word may now be joined. Then only
the sums above those leaves are added up anew; all other leaves keep their counts unseen.

Trees travel as columns beside the texts, so they can be written with them and edited again.

Defined cases: a NULL or empty text has one empty leaf and no token, and a NULL text stays
NULL unless it is edited; edits may touch or be empty, but not overlap or leave the text;
repeated rows are counted each; an empty table gives an empty result; columns besides id and
text aren't kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm.word_ids import WordIds, default_vocabulary, shared

LEAF_WORDS = 16

#: Place of the first byte that goes, of the first that stays, and what is put there; places are bytes of the text before all edits.
Edit = tuple[int, int, bytes]

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Tree:
    """``sums[1]`` is the total, ``sums[width + k]`` leaf k; ``lengths`` are the leaves' bytes."""

    def __init__(self, lengths: np.ndarray, sums: np.ndarray):
        self.lengths, self.sums = lengths, sums
        self.width = len(sums) // 2

    @classmethod
    def of(cls, lengths: np.ndarray, counts: np.ndarray) -> Tree:
        width = 1 << max(0, len(counts) - 1).bit_length()
        sums = np.zeros(2 * width, np.int64)
        sums[width : width + len(counts)] = counts
        level = width
        while level > 1:
            level //= 2
            sums[level : 2 * level] = sums[2 * level : 4 * level : 2] + sums[2 * level + 1 : 4 * level : 2]
        return cls(lengths, sums)

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def update(self, leaves: list[int], counts: list[int]) -> None:
        """Set the counts of some leaves and the sums above them."""
        at = np.array(leaves, np.int64) + self.width
        self.sums[at] = counts
        while len(at) and at[0] > 1:
            at = np.unique(at // 2)
            self.sums[at] = self.sums[2 * at] + self.sums[2 * at + 1]

    def packed(self) -> tuple[bytes, bytes]:
        return self.lengths.astype("<u4").tobytes(), self.sums.astype("<u4").tobytes()

    @classmethod
    def unpacked(cls, lengths: bytes, sums: bytes) -> Tree:
        return cls(np.frombuffer(lengths, "<u4").astype(np.int64), np.frombuffer(sums, "<u4").astype(np.int64))


def _tokens(encoder: WordIds, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, encoder.words(words)), np.int64, len(words)) // encoder.dtype.itemsize


def build(encoder: WordIds, text: bytes, words: list[bytes]) -> Tree:
    """The tree of a text whose ``words`` the encoder knows."""
    if not words:
        return Tree.of(np.array([len(text)]), np.zeros(1, np.int64))
    space = _SPACE[np.frombuffer(text, np.uint8)]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))[::LEAF_WORDS]
    starts[0] = 0
    lengths = np.diff(np.append(starts, len(text)))
    return Tree.of(lengths, np.add.reduceat(_tokens(encoder, words), np.arange(0, len(words), LEAF_WORDS)))


def apply(encoder: WordIds, text: bytes, tree: Tree, edits: list[Edit]) -> tuple[bytes, Tree, int]:
    """The edited text, its tree, and how many words were encoded for it."""
    edits = sorted(edits, key=lambda e: e[:2])
    if any(a > b or a < 0 or b > len(text) for a, b, _ in edits) or any(x[1] > y[0] for x, y in zip(edits, edits[1:], strict=False)):
        raise ValueError("edits overlap or leave the text")
    ends = np.cumsum(tree.lengths)
    last = len(ends) - 1
    leaf = lambda place: min(last, int(np.searchsorted(ends, place, side="right")))
    regions: list[tuple[int, int, list[Edit]]] = []
    for edit in edits:
        first, final = leaf(edit[0]), leaf(edit[1])
        if regions and first <= regions[-1][1]:
            regions[-1] = (regions[-1][0], max(final, regions[-1][1]), [*regions[-1][2], edit])
        else:
            regions.append((first, final, [edit]))
    lengths, leaves, counts, parts, at, encoded = tree.lengths.copy(), [], [], [], 0, 0
    for first, final, own in regions:
        start, end = int(ends[first] - tree.lengths[first]), int(ends[final])
        parts.append(text[at:start])
        pieces, place = [], start
        for a, b, new in own:
            pieces += [text[place:a], new]
            place = b
        region = b"".join([*pieces, text[place:end]])
        parts.append(region)
        at = end
        words = encoder.split(region)
        encoder.learn(set(words))
        encoded += len(words)
        lengths[first : final + 1] = 0
        lengths[first] = len(region)
        leaves += range(first, final + 1)
        counts += [int(_tokens(encoder, words).sum()), *[0] * (final - first)]
    tree = Tree(lengths, tree.sums.copy())
    tree.update(leaves, counts)
    return b"".join([*parts, text[at:]]), tree, encoded


def tidy_edits(text: bytes) -> list[Edit]:
    """Edits that drop every line equal to an earlier one and mask e-mail addresses."""
    edits, seen, at = [], set(), 0
    for line in text.split(b"\n"):
        end = min(len(text), at + len(line) + 1)
        if line.strip() and line in seen:
            edits.append((at, end, b""))
        else:
            seen.add(line)
            edits += [(at + m.start(), at + m.end(), b"<email>") for m in _MAIL.finditer(line)]
        at = end
    return edits


_MAIL = re.compile(rb"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def _build(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                texts = [t or b"" for t in part.column(1).to_pylist()]
                trees = []
                for text in texts:
                    words = encoder.split(text)
                    encoder.learn(set(words))
                    trees.append(build(encoder, text, words))
                packed = list(zip(*(t.packed() for t in trees), strict=True)) or [[], []]
                columns = [*part.columns, pa.array([t.total for t in trees], pa.int64()), *(pa.array(c, pa.binary()) for c in packed)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text", "n_tokens", "lengths", "sums"])

    return run


def trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``id``, ``text`` (bytes), ``n_tokens`` and the tree (``lengths``, ``sums``) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([*rows.schema.fields, T.StructField("n_tokens", T.LongType()), *(T.StructField(n, T.BinaryType()) for n in ("lengths", "sums"))])
    return rows.mapInArrow(_build(vocabulary or default_vocabulary()), schema)


def _recount(path: str, edits_of: Callable[[bytes], list[Edit]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                rows = []
                for _, text, before, lengths, sums in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    edits = edits_of(text or b"")
                    if edits:
                        text, tree, encoded = apply(encoder, text or b"", Tree.unpacked(lengths, sums), edits)
                        rows.append((text, tree.total, *tree.packed(), before, len(edits), encoded))
                    else:
                        rows.append((text, before, lengths, sums, before, 0, 0))
                kinds = [pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["id", "text", "n_tokens", "lengths", "sums", "n_before", "n_edits", "n_encoded"])

    return run


def recount(held: DataFrame, edits_of: Callable[[bytes], list[Edit]] = tidy_edits, vocabulary: str | None = None) -> DataFrame:
    """``held`` (from ``trees``) after the edits that ``edits_of`` gives for a text; with the count before, the edits, and the words encoded for them."""
    schema = T.StructType([*held.schema.fields, *(T.StructField(n, T.LongType()) for n in ("n_before", "n_edits", "n_encoded"))])
    return held.mapInArrow(_recount(vocabulary or default_vocabulary(), edits_of), schema)


def count_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits_of: Callable[[bytes], list[Edit]] = tidy_edits) -> DataFrame:
    """Every row's tokens before and after its edits."""
    found = recount(trees(docs, id_col, text_col), edits_of)
    return found.select(F.col("id").alias(id_col), F.col("n_before").alias("n_tokens"), "n_edits", F.col("n_tokens").alias("n_tokens_edited"), "n_encoded")
