"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Fingerprints that differ in at most k bits
differ in at most k bytes, so they share at least 8 - k positional bytes. The index
therefore posts each distinct fingerprint under groups of positional bytes, chosen such that
whichever k bytes differ, one group is untouched; single bytes would give lists that grow
with the corpus. Within a posting list the shared positional bytes of a pair are tallied,
pairs below 8 - k are dropped, and the bits of the rest are counted.

Documents of equal fingerprint meet in one node before the index is built, and a list
gives a spanning forest of its links, never all its pairs. Long lists (many near copies of
one text) are linked through common neighbours instead of by pairs, in time that grows
linearly with the list. A list holds distinct fingerprints that share its bytes, at eight
bytes each.

Defined cases: a NULL or wordless text has fingerprint zero, linked like any other; NULL
ids belong to their component but name it only when no other id does; repeated rows share a
fingerprint; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm.components import components
from tallylake.workspace import stage

#: Lists up to this length compare pairs; longer ones go through common neighbours. Both are exact.
PAIRED = 256
#: Shingles hashed before their bits are summed.
BLOCK = 1 << 20

_ONES = np.uint64(0x0101010101010101)


def _hashes(text: bytes | None, shingle: int, seed: int) -> list[int]:
    words = (text or b"").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, seed)]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: 1 - shingle].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each run of ``sizes`` hashes, the bits set in over half of them (zero for an empty run)."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    n = sizes[some]
    starts = np.cumsum(n) - n
    pieces = -(-n // 255)  # a byte lane counts up to 255
    first = np.cumsum(pieces) - pieces
    cuts = np.repeat(starts, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    bits = np.zeros(len(some), np.uint64)
    for b in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(b)) & _ONES, cuts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for j in range(8):
            bits |= (2 * counts[:, j] > n).astype(np.uint64) << np.uint64(8 * j + b)
    out[some] = bits
    return out


def _fingerprint_batches(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, hashes, sizes = [], [], []
            for text in batch.column(1):
                found = _hashes(text.as_py(), shingle, seed)
                hashes += found
                sizes.append(len(found))
                if len(hashes) >= BLOCK:
                    parts.append(majority(np.array(hashes, np.uint64), np.array(sizes)))
                    hashes, sizes = [], []
            parts.append(majority(np.array(hashes, np.uint64), np.array(sizes, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts).view(np.int64))], ["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``id`` and ``fp`` (the 64 bits as a long) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("fp", T.LongType())])
    return rows.mapInArrow(_fingerprint_batches(shingle, seed), kind)


def byte_groups(max_bits: int) -> list[tuple[int, ...]]:
    """Groups of byte positions of which one stays clear of any ``max_bits`` differing bytes.

    For up to three, the fourteen planes of the cube 0..7 (four positions whose xor is
    zero): any three points lie in a plane, and its complement is a plane too.
    """
    if not 0 <= max_bits < 8:
        raise ValueError("a byte index serves 0 to 7 differing bits")
    if max_bits <= 3:
        return [g for g in combinations(range(8), 4) if not g[0] ^ g[1] ^ g[2] ^ g[3]]
    return list(combinations(range(8), 8 - max_bits))


def _mask(group: tuple[int, ...]) -> int:
    mask = sum(0xFF << 8 * p for p in group)
    return mask - (1 << 64) if mask >> 63 else mask


def union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of ``a[i]`` and ``b[i]``; every entry of ``parent`` is the smallest member of its set."""
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(parent, up := parent[parent]):
            parent = up


def _pairs(fps: np.ndarray, lists: np.ndarray, max_bits: int) -> np.ndarray:
    """Parents within short lists (runs of equal ``lists``), by comparing every pair."""
    parent = np.arange(len(fps))
    at = np.arange(len(fps))
    for step in range(1, len(fps)):
        at = at[at + step < len(fps)]
        at = at[lists[at] == lists[at + step]]
        if not len(at):
            break
        differ = fps[at] ^ fps[at + step]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(1)
        near = (shared >= 8 - max_bits) & (np.bitwise_count(differ) <= max_bits)
        parent = union(parent, at[near], at[near] + step)
    return parent


def _flips(bits: list[int], most: int) -> list[int]:
    return [sum(1 << b for b in chosen) for r in range(most + 1) for chosen in combinations(bits, r)]


def _neighbours(fps: np.ndarray, group: tuple[int, ...], max_bits: int) -> np.ndarray:
    """Parents within one long list of sorted fingerprints.

    Two members at distance d <= k have a value between them, at most k // 2 bits from one
    and k - k // 2 from the other, that agrees with the list's bytes. All values near a member
    go to a table that names the first such member; every member then looks up its own wider
    surroundings. Whoever meets in a value is linked, since the distances add up to k at most.
    """
    bits = [8 * p + b for p in range(8) if p not in group for b in range(8)]
    near = np.array(_flips(bits, max_bits // 2), np.uint64)
    values = (fps[:, None] ^ near).ravel()
    owner = np.repeat(np.arange(len(fps)), len(near))
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    first = owner[np.flatnonzero(new)]
    parent = union(np.arange(len(fps)), owner, first[np.cumsum(new) - 1])
    values = values[new]
    for flip in _flips(bits, max_bits - max_bits // 2):
        wanted = fps ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
        hit = np.flatnonzero(values[at] == wanted)
        parent = union(parent, hit, first[at[hit]])
    return parent


def _link_batches(groups: list[tuple[int, ...]], max_bits: int):
    def links(group: np.ndarray, key: np.ndarray, fps: np.ndarray):
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
        number = np.cumsum(new) - 1
        sizes = np.bincount(number)
        short = (sizes > 1) & (sizes <= PAIRED)
        rows = np.flatnonzero(short[number])
        parent = _pairs(fps[rows], number[rows], max_bits)
        yield fps[rows], fps[rows][parent]
        starts = np.cumsum(sizes) - sizes
        for k in np.flatnonzero(sizes > PAIRED):
            part = slice(starts[k], starts[k] + sizes[k])
            own = fps[part]
            parent = _neighbours(own, groups[group[starts[k]]], max_bits)
            yield own, own[parent]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))
        rest = [empty]  # the list that the next batch may continue

        def emit(parts):
            if len(parts[0]):
                for a, b in links(*parts):
                    own = a != b
                    if own.any():
                        yield pa.RecordBatch.from_arrays([pa.array(x[own].view(np.int64)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            now = (
                batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64),
                batch.column(1).to_numpy(),
                batch.column(2).to_numpy().view(np.uint64),
            )
            if not len(now[0]):
                continue
            same = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            if same.all() and rest[0][0].size and rest[0][0][0] == now[0][0] and rest[0][1][0] == now[1][0]:
                rest.append(now)
                continue
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            whole = [np.concatenate(x) for x in zip(*rest, tuple(x[:cut] for x in now), strict=True)]
            rest = [tuple(x[cut:] for x in now)]
            yield from emit(whole)
        yield from emit([np.concatenate(x) for x in zip(*rest, strict=True)])

    return run


def links(nodes: DataFrame, max_bits: int = 3) -> DataFrame:
    """A spanning set of links ``a``, ``b`` between the distinct ``fp`` values of ``nodes``."""
    groups = byte_groups(max_bits)
    posted = nodes.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("grp"), F.col("fp").bitwiseAND(F.lit(_mask(g))).alias("key"), "fp") for i, g in enumerate(groups)])).alias("p")
    ).select("p.*")
    lists = posted.repartition("grp", "key").sortWithinPartitions("grp", "key", "fp")
    return lists.mapInArrow(_link_batches(groups, max_bits), "a long, b long")


def _grouped(prints: DataFrame, max_bits: int) -> DataFrame:
    """``fp``, ``root`` and the ``first`` (smallest id, then fingerprint) of its component, one row per fingerprint."""
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "fp"))
    nodes = stage(prints.groupBy("fp").agg(first.alias("first")), "simhash-nodes")
    roots = components(links(nodes, max_bits), "a", "b")
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = placed.groupBy("root").agg(F.min("first").alias("first"))
    return placed.drop("first").join(firsts, "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, seed: int = 42) -> DataFrame:
    """Every row's id, its ``fingerprint`` in hex, and ``component_id``, the smallest id it is linked to."""
    prints = stage(fingerprints(docs, id_col, text_col, shingle, seed), "simhash")
    placed = _grouped(prints, max_bits).select("fp", F.col("first.id").alias("component_id"))
    return prints.join(placed, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, seed: int = 42) -> DataFrame:
    """One row of every component: that with the smallest id (NULL last); of rows with one id and fingerprint, the smallest row."""
    prints = stage(fingerprints(docs, id_col, text_col, shingle, seed), "simhash")
    placed = _grouped(prints, max_bits)
    kept = stage(placed.select("first").distinct().select("first.id", "first.fp"), "simhash-kept")
    lost = prints.join(kept, prints["id"].eqNullSafe(kept["id"]) & (prints["fp"] == kept["fp"]), "left_anti").select("id")
    ids = prints.groupBy("id").count().filter((F.col("count") > 1) | F.col("id").isNull()).select("id")
    if ids.isEmpty():
        return docs.join(lost, docs[id_col] == lost["id"], "left_anti")
    ids = stage(ids, "simhash-repeated")
    once = docs.join(ids, docs[id_col].eqNullSafe(ids["id"]), "left_anti")
    once = once.join(lost, once[id_col] == lost["id"], "left_anti")
    again = docs.join(ids, docs[id_col].eqNullSafe(ids["id"]), "left_semi")
    rows = again.select(F.struct("*").alias("id"), F.col(text_col).alias("text"))
    rows = fingerprints(rows, "id", "text", shingle, seed).withColumnRenamed("id", "doc")
    rows = rows.groupBy(F.col("doc").getField(id_col).alias("id"), "fp").agg(F.min("doc").alias("doc"))
    rows = rows.join(kept, rows["id"].eqNullSafe(kept["id"]) & (rows["fp"] == kept["fp"]), "left_semi")
    return once.unionByName(rows.select("doc.*"))
