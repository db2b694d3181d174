"""Vectors as product codes in whole numbers; nearest entries found through LAESA pivots.

Components become whole numbers, vectors are cut into equal parts, and every part position has a
codebook that starts from the first vectors and is refined for some rounds. The distances of all
parts to a few fixed pivots (of the first codebook, far from each other) are computed once and
kept beside the vectors. A round computes the pivots' distances to its entries only; the largest
difference of the two is, by the triangle inequality, a lower bound of the distance to an entry.
Entries are tried in the order of their bounds, and none whose bound exceeds the best distance
so far. Distances that decide are whole numbers; bounds allow for the rounding of the stored ones.

A round is one pass over the staged vectors; tasks return the sums of each entry, and the driver
holds one codebook (parts x entries x width numbers) whatever the size of the table.

Defined cases: vectors that are NULL, hold a NULL, or hold a component that isn't finite or not
below ``LARGEST`` in size are left out; so are vectors of another length than the first kept one;
a length that ``parts`` doesn't divide is filled up with zeros. First vectors are in the order of
id (NULLs last), then components. Fewer vectors than entries give smaller codebooks. Repeated rows
count each; labels may be NULL, which are one label; an empty table gives an empty result; other
columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.workspace import stage

#: Components of this size or more would leave the range in which squares are exact.
LARGEST = 16_384.0
#: Far above the relative rounding of a stored distance (2 ** -24).
SLACK = 2.0**-21
#: Vectors in work at a time.
CHUNK = 4_096


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``id``, ``label`` and ``v``, the components times ``scale`` rounded down, of usable rows."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    usable = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    scaled = F.transform("x", lambda x: F.floor(x * scale).cast("int"))
    return rows.filter(F.col("x").isNotNull() & F.coalesce(usable, F.lit(False))).select("id", "label", scaled.alias("v"))


def first_vectors(rows: DataFrame, entries: int) -> tuple[DataFrame, np.ndarray]:
    """Rows of one length, and the first ``entries`` of them as a matrix."""
    ordered = [F.asc_nulls_last("id"), "v"]
    first = rows.orderBy(*ordered).limit(1).collect()
    if not first:
        return rows, np.empty((0, 0), np.int64)
    rows = rows.filter(F.size("v") == len(first[0]["v"]))
    return rows, np.array([r["v"] for r in rows.orderBy(*ordered).limit(entries).collect()], np.int64)


def cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """Row, part, position within the part; filled up with zeros where the length isn't a multiple."""
    missing = -vectors.shape[1] % parts
    if missing:
        vectors = np.hstack([vectors, np.zeros((len(vectors), missing), vectors.dtype)])
    return vectors.reshape(len(vectors), parts, vectors.shape[1] // parts)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances along the last axis."""
    step = a.astype(np.int64) - b
    return np.einsum("...w,...w->...", step, step)


def far_apart(codebook: np.ndarray, pivots: int) -> np.ndarray:
    """Part, pivot, position: by part the first entry, then always the entry farthest from those chosen."""
    chosen = []
    for entries in codebook:
        own = [0]
        nearest = squared(entries, entries[0])
        while len(own) < min(pivots, len(entries)):
            own.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, squared(entries, entries[own[-1]]))
        chosen.append(entries[own])
    return np.array(chosen)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Row (or entry), part, pivot."""
    return np.sqrt(squared(x[:, :, None, :], pivots[None])).astype(np.float32)


def nearest_entries(x: np.ndarray, to_pivots: np.ndarray, codebook: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry and squared distance for row and part, and how many distances were evaluated."""
    n, parts, _ = x.shape
    entry = np.empty((n, parts), np.int64)
    error = np.empty((n, parts), np.int64)
    evaluated = 0
    of_entries = pivot_distances(codebook.transpose(1, 0, 2), pivots).transpose(1, 0, 2)
    for part in range(parts):
        own = to_pivots[:, part, None, :].astype(np.float64)
        theirs = of_entries[part].astype(np.float64)
        bound = (np.abs(own - theirs) - SLACK * (own + theirs)).max(2)
        order = np.argsort(bound, axis=1, kind="stable")
        rows = np.arange(n)
        best = np.full(n, np.iinfo(np.int64).max)
        where = np.zeros(n, np.int64)
        for place in range(order.shape[1]):
            tried = order[rows, place]
            least = np.maximum(bound[rows, tried], 0.0)
            open_ = least * least <= best[rows]
            rows, tried = rows[open_], tried[open_]
            if not len(rows):
                break
            evaluated += len(rows)
            distance = squared(x[rows, part], codebook[part, tried])
            better = (distance < best[rows]) | ((distance == best[rows]) & (tried < where[rows]))
            best[rows[better]] = distance[better]
            where[rows[better]] = tried[better]
        entry[:, part], error[:, part] = where, best
    return entry, error, evaluated


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def _with_distances(pivots: np.ndarray, parts: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(k, CHUNK)
                x = cut(_matrix(rows.column("v"), length), parts)
                found = pivot_distances(x, pivots).reshape(rows.num_rows, -1)
                listed = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*rows.columns, listed], [*rows.schema.names, "d"])

    return run


def _assigned(batches, codebook, pivots, length):
    parts = len(codebook)
    for batch in batches:
        for k in range(0, batch.num_rows, CHUNK):
            rows = batch.slice(k, CHUNK)
            x = cut(_matrix(rows.column("v"), length), parts)
            to_pivots = _matrix(rows.column("d"), pivots.shape[0] * pivots.shape[1]).reshape(len(x), parts, pivots.shape[1])
            yield rows, x, *nearest_entries(x, to_pivots, codebook, pivots)[:2]


def _sums(codebook: np.ndarray, pivots: np.ndarray, length: int):
    parts, entries, width = codebook.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for _, x, entry, _ in _assigned(batches, codebook, pivots, length):
            for part in range(parts):
                np.add.at(total[part, :, :width], entry[:, part], x[:, part].astype(np.int64))
                total[part, :, width] += np.bincount(entry[:, part], minlength=entries)
        used = np.argwhere(total[:, :, width:].repeat(width + 1, 2))
        columns = [pa.array(used[:, i], pa.int32()) for i in range(3)] + [pa.array(total[tuple(used.T)])]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "at", "total"])

    return run


def refine(staged: DataFrame, codebook: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The codebook after a round: every used entry is the mean of its parts, rounded down."""
    width = codebook.shape[2]
    found = staged.mapInArrow(_sums(codebook, pivots, length), "part int, entry int, at int, total long")
    total = np.zeros((*codebook.shape[:2], width + 1), np.int64)
    for row in found.groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).collect():  # a codebook's size at most
        total[row["part"], row["entry"], row["at"]] = row["total"]
    count = total[:, :, width:]
    return np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), codebook)


def _codes(codebook: np.ndarray, pivots: np.ndarray, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, entry, error in _assigned(batches, codebook, pivots, length):
            codes = ["".join(f"{e:02x}" for e in row) for row in entry.tolist()]
            columns = [rows.column("id"), rows.column("label"), pa.array(codes), pa.array(error.sum(1))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    return run


def digest(codebook: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebook.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 8, entries: int = 16,
    rounds: int = 6, scale: int = 4096, pivots: int = 4,
) -> DataFrame:
    """Every usable row's id, ``code``, ``error``, the error of all rows of its label, and the codebooks' digest.

    ``entries`` is at most 256, as a code has two hex digits a part. One job for the first vectors, one for the
    pivots' distances, one a round, and one for the codes.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits holds 1 to 256 entries")
    rows, first = first_vectors(whole_numbers(vectors, id_col, vector_col, label_col, scale), entries)
    length = first.shape[1]
    codebook = cut(first, parts).transpose(1, 0, 2)
    if len(first):
        fixed = far_apart(codebook, pivots)
        schema = T.StructType([*rows.schema.fields, T.StructField("d", T.ArrayType(T.FloatType()))])
        staged = stage(rows.mapInArrow(_with_distances(fixed, parts, length), schema), "vector-parts")
        for _ in range(rounds):
            codebook = refine(staged, codebook, fixed, length)
        kind = T.StructType([*rows.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
        coded = stage(staged.mapInArrow(_codes(codebook, fixed, length), kind), "vector-codes")
    else:
        coded = rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    by_label = coded.groupBy(F.col("label").alias("own")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("own")))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(codebook)).alias("codebooks_sha256"))
