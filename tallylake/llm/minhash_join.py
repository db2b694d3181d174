"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

Equal sets of shingles are one node. A node's signature is a row of ``chunks * symbols`` b-bit minimum
hashes. If two signatures differ in fewer than ``chunks * (errors + 1)`` symbols, then by the
pigeonhole principle some chunk differs in at most ``errors`` symbols; so every choice of ``errors``
symbols that may be wrong is left out of a chunk in turn, and what remains is a key under which the
node is posted. Signatures within the distance share a key for certain; of sets that are as alike
as ``percent`` asks, a share of some 2e-8 misses all keys with the default sizes. Nodes that share a key are
candidates; lengths and a longer sketch of two bits a hash (passed by all but one link in 1e9) sift them, and the full
sets confirm what is left.

A key can be shared by a great many near copies, so their pairs are never listed. Each key names a hub (the node that
shares most keys) and only hubs are compared with the nodes of their keys: for copies of one text that
joins nearly all. A node that isn't joined with its hub is too far from it; what it can share with any other
node beyond what it shares with the hub are shingles outside the hub. So it is looked up by these alone, by its rarest ones, as many
as leave too few for a link; most such nodes have none that another node has. How many it looks up depends on the partner's size,
so partners are met by bands of sizes, and only at shingles that are among the partner's rarest ones too. Partners so much smaller that they need none
are found by their sizes. As long as that would give many pairs a node, further hubs are compared first,
while each round halves what is left. So no link between two components is missed, and links inside a
component aren't looked for.

Texts are staged in blocks and stay there; the full sets of candidates are made again where the text lies.

Defined cases: texts without words are linked with nothing, themselves excepted; a text of fewer words than a shingle is one
shingle; very long texts are one set each; NULL ids belong to their component but name it only when no other id
does; repeated rows share a node; an empty table gives an empty result; other columns are left alone. Shingles are
told apart by 64-bit hashes, sets by 128-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm.blocks import read_block, stage_blocks, write_by_block
from tallylake.llm.components import components
from tallylake.workspace import stage

#: Minimum hashes of the sketch, of two bits each; the first of them also give the signature.
HASHES = 128
#: Shingles in work at a time.
WORK = 1 << 16
#: Nodes that one salted group of the last comparison holds.
SALTED = 64
#: Pairs a node of a hub that the last comparison may meet before further hubs are tried.
FEW = 64
#: Bands of sizes by which the nodes of a hub are looked up.
BANDS = 16

_EVEN = 0x5555555555555555


def _odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    weights = _odd_numbers(size + 1, 11)
    used = min(size, len(words))
    count = len(words) - used + 1
    total = np.full(count, used, np.uint64) * weights[size]
    for i in range(used):
        total += hashes[i : i + count] * weights[i]
    return np.unique(mixed(total))


def minimum_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``HASHES`` 16-bit symbols for every (non-empty) set."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint64)
    for j, (factor, shift) in enumerate(zip(_odd_numbers(HASHES, 12), _odd_numbers(HASHES, 13), strict=True)):
        out[:, j] = np.minimum.reduceat(values * factor + shift, starts)
    return mixed(out) >> np.uint64(48)


def signature_keys(symbols: np.ndarray, chunks: int, size: int, errors: int) -> np.ndarray:
    """By row: for every chunk and every choice of ``errors`` of its symbols, a hash of the others."""
    keys = []
    for chunk in range(chunks):
        for kept in combinations(range(size), size - errors):
            key = np.full(len(symbols), len(keys) + 1, np.uint64)
            for place in kept:
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + symbols[:, chunk * size + place])
            keys.append(key)
    return np.stack(keys, 1).view(np.int64)


def sketches(symbols: np.ndarray) -> np.ndarray:
    """Two bits of every symbol, 32 symbols a long."""
    pairs = (symbols & np.uint64(3)).reshape(len(symbols), -1, 32)
    return (pairs << (2 * np.arange(32, dtype=np.uint64))).sum(2, dtype=np.uint64).view(np.int64)


def most_differing(percent: int, chance: float = 1e-9) -> int:
    """Two-bit symbols in which sets of the least similarity differ at most, but for ``chance``."""
    p = (1 - percent / 100) * 0.75
    beyond = 0.0
    for k in range(HASHES, -1, -1):
        beyond += math.comb(HASHES, k) * p**k * (1 - p) ** (HASHES - k)
        if beyond > chance:
            return k
    return 0


def _print_batches(shingle: int, chunks: int, size: int, errors: int):
    def flush(places, sets):
        some = [s for s in sets if len(s)]
        symbols = minimum_hashes(some) if some else np.empty((0, HASHES), np.uint64)
        where = np.cumsum([len(s) > 0 for s in sets]) - 1
        keys, sketch = signature_keys(symbols, chunks, size, errors), sketches(symbols)
        filled = [len(s) > 0 for s in sets]
        listed = [keys[k].tolist() if f else [] for k, f in zip(where, filled, strict=True)]
        bits = [[sketch[k, i] if f else 0 for k, f in zip(where, filled, strict=True)] for i in range(sketch.shape[1])]
        block, row, ids = places
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(block), pa.concat_arrays(row), pa.concat_arrays(ids), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
             pa.array([len(s) for s in sets], pa.int64()), *(pa.array(b, pa.int64()) for b in bits), pa.array(listed, pa.list_(pa.int64()))],
            ["block", "row", "id", "set", "n", *SKETCH, "keys"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, sets, held = 0, [], 0
            for k, text in enumerate(batch.column(3)):
                sets.append(shingle_set(text.as_py(), shingle))
                held += len(sets[-1])
                if held >= WORK or k + 1 == batch.num_rows:
                    yield flush([[batch.column(c).slice(start, k + 1 - start)] for c in range(3)], sets)
                    start, sets, held = k + 1, [], 0

    return run


SKETCH = [f"s{i}" for i in range(HASHES // 32)]


def prints(texts: DataFrame, shingle: int, chunks: int, size: int, errors: int) -> DataFrame:
    """``block``, ``row``, ``id``, hash of the ``set``, its size ``n``, sketch and keys, of staged texts."""
    kind = T.StructType(
        [*texts.schema.fields[:3], T.StructField("set", T.BinaryType()), T.StructField("n", T.LongType()),
         *(T.StructField(s, T.LongType()) for s in SKETCH), T.StructField("keys", T.ArrayType(T.LongType()))]
    )
    return stage(texts.mapInArrow(_print_batches(shingle, chunks, size, errors), kind), "minhash-prints", "zstd")


def _set_batches(folder: str, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, wanted = None, {}
        for batch in batches:
            nodes, sets, held = [], [], 0
            blocks, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, (block, row) in enumerate(zip(blocks, rows, strict=True)):
                if block != now:
                    now, wanted = block, {}
                    for part in read_block(folder, block, ["row", "node"]):
                        wanted.update(zip(part["row"].to_pylist(), part["node"].to_pylist(), strict=True))
                if row in wanted:
                    nodes.append(wanted[row])
                    sets.append(shingle_set(batch.column(2)[k].as_py(), shingle).view(np.int64))
                    held += len(sets[-1])
                if nodes and (held >= WORK or k + 1 == batch.num_rows):
                    cuts = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
                    listed = pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(sets)))
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), listed], ["node", "shingles"])
                    nodes, sets, held = [], [], 0

    return run


def full_sets(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``node`` and all its ``shingles``, for every node of ``wanted``; made in the task that reads the node's text."""
    folder = write_by_block(nodes.join(wanted, "node", "left_semi").select("block", "row", "node"), "minhash-wanted")
    found = texts.select("block", "row", "text").mapInArrow(_set_batches(folder, shingle), "node long, shingles array<long>")
    return stage(found, "minhash-sets")


def _near(left: str, right: str, percent: int) -> Column:
    """Whether sizes and sketches let two sets be alike enough."""
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    differ = F.lit(0)
    for name in SKETCH:
        both = F.col(f"{left}.{name}").bitwiseXOR(F.col(f"{right}.{name}"))
        differ = differ + F.bit_count(both.bitwiseOR(F.shiftrightunsigned(both, 1)).bitwiseAND(F.lit(_EVEN)))
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (differ <= most_differing(percent))


def sets_of(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    return full_sets(texts, nodes, wanted, shingle)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` of nodes whose full sets are alike enough."""
    beside = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("theirs")), "b")
    beside = beside.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("own")), "a")
    shared = F.size(F.array_intersect("own", "theirs"))
    either = F.size("own") + F.size("theirs") - shared
    return stage(beside.filter(100 * shared >= percent * either).select("a", "b"), "minhash-links")


def _required(a: Column, b: Column, percent: int) -> Column:
    """Shingles that two sets of these sizes must share to be alike enough."""
    return F.ceil(percent * (a + b) / (100 + percent))


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


class Search:
    """The search for links among the nodes that share keys."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, shingle: int, percent: int):
        self.texts, self.nodes, self.shingle, self.percent = texts, nodes, shingle, percent
        # A set that a single shingle more or less makes too different has no links.
        least = next(n for n in range(1, 101 * 100) if 100 * n >= percent * (n + 1)) if percent < 100 else 1 << 62
        posts = nodes.filter(F.col("n") >= least).select("node", F.explode("keys").alias("key"))
        shared = posts.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
        met = stage(posts.join(shared, "key"), "minhash-met")
        self.weights = stage(met.groupBy("node").agg(F.sum("size").alias("weight")), "minhash-weights")
        self.members = stage(met.select("key", "node").join(self.weights, "node"), "minhash-members")
        self.links: list[DataFrame] = []
        self.sets: DataFrame | None = None
        self.used: list[DataFrame] = []

    def labels(self) -> DataFrame:
        """``node`` and a ``comp`` it is known to belong to, for linked nodes: the heaviest node it is linked to, and that one's, and again.

        Not yet the components, which are found once at the end; nodes of one label are linked for certain.
        """
        links = reduce(DataFrame.unionAll, self.links)
        sides = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(self.weights.withColumnRenamed("node", "b"), "b")
        best = sides.groupBy("a").agg(F.max(F.struct("weight", F.col("b").alias("node"))).alias("best"))
        own = best.join(self.weights.withColumnRenamed("node", "a"), "a")
        up = F.greatest(F.col("best"), F.struct("weight", F.col("a").alias("node")))["node"]
        found = stage(own.select(F.col("a").alias("node"), up.alias("comp")), "minhash-labels")
        for _ in range(2):
            above = found.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
            found = found.join(above, "comp").select("node", F.col("top").alias("comp"))
        return found

    def roots(self) -> DataFrame:
        """``node`` and ``root`` of all linked nodes: their labels, joined by the links that are left between labels."""
        labels = stage(self.labels(), "minhash-joined")
        ends = [labels.select(F.col("node").alias(side), F.col("comp").alias(f"top_{side}")) for side in "ab"]
        between = reduce(DataFrame.unionAll, self.links).join(ends[0], "a").join(ends[1], "b").filter("top_a <> top_b")
        between = stage(between.select("top_a", "top_b").distinct(), "minhash-between")
        if between.isEmpty():
            return labels.select("node", F.col("comp").alias("root"))
        tops = components(between, "top_a", "top_b").withColumnRenamed("node", "comp")
        return labels.join(tops, "comp", "left").select("node", F.coalesce("root", "comp").alias("root"))

    def open_members(self) -> DataFrame:
        """Members, with their component, of the keys that hold several components."""
        placed = self.members.join(self.labels(), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        placed = stage(placed, "minhash-placed")
        apart = placed.groupBy("key").agg((F.min("comp") < F.max("comp")).alias("open")).filter("open").select("key")
        return stage(placed.join(apart, "key", "left_semi").select("key", "node", "comp"), "minhash-open")

    def left(self, members: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Nodes by the hubs of their keys, their shared shingles outside the hub, and the nodes that may still have a link.

        ``groups``: ``hub``, ``node``, ``comp``, size ``n`` and its ``band``, ``inside`` (shared with the hub) and ``held`` (outside it, and
        in another node of the hub). ``index``: hub, node, ``shingle`` and its ``place`` among the node's (rarest first). ``live``:
        the groups' rows of other components than their hub's. Partners of a size up to ``bound`` need nothing outside the
        hub, larger ones share at least ``needed`` there.
        """
        own = self.used[0].select("key", F.col("node").alias("hub"))
        met = members.join(own, "key").select("hub", "node", "comp").distinct()
        sets = self.sets.select("node", F.col("shingles").alias("own"))
        both = met.join(sets, "node").join(sets.select(F.col("node").alias("hub"), F.col("own").alias("theirs")), "hub")
        outside = F.array_except("own", "theirs")
        rows = both.select("hub", "node", "comp", F.size("own").cast("long").alias("n"), outside.alias("outside"))
        rows = stage(rows, "minhash-outside", "zstd")
        each = rows.select("hub", "node", F.explode("outside").alias("shingle"))
        shared = each.groupBy("hub", "shingle").agg(F.count("*").alias("nodes")).filter("nodes > 1")
        place = F.row_number().over(Window.partitionBy("hub", "node").orderBy("nodes", "shingle"))
        index = stage(each.join(shared, ["hub", "shingle"]).select("hub", "node", "shingle", place.alias("place")), "minhash-index")
        held = index.groupBy("hub", "node").agg(F.count("*").alias("held"))
        by_hub = rows.groupBy("hub").agg(F.min("n").alias("smallest"), F.max("n").alias("largest"), F.max(F.when(F.col("node") == F.col("hub"), F.col("comp"))).alias("main"))
        inside = F.col("n") - F.size("outside")
        groups = rows.join(held, ["hub", "node"], "left").join(by_hub, "hub")
        groups = groups.select("hub", "node", "comp", "n", inside.alias("inside"), F.coalesce("held", F.lit(0)).alias("held"), "smallest", "largest", "main")
        groups = groups.withColumn("band", self._band(F.col("n")))
        groups = stage(groups, "minhash-groups")
        least = F.greatest("smallest", F.ceil(F.col("n") * self.percent / 100))
        bound = F.floor(F.col("inside") * (100 + self.percent) / self.percent) - F.col("n")
        live = groups.filter("comp <> main").withColumns({"least": least, "bound": bound})
        live = live.withColumn("needed", _required(F.col("n"), F.greatest("least", F.col("bound") + 1), self.percent) - F.col("inside"))
        return groups, index, live.filter("least <= bound OR held >= needed")

    def hubs(self, members: DataFrame) -> DataFrame:
        """By key the heaviest node that has not been its hub."""
        for used in self.used:
            members = members.join(used.select("key", "node"), ["key", "node"], "left_anti")
        best = members.groupBy("key").agg(F.max(F.struct("weight", "node", "comp")).alias("hub"))
        found = stage(best.select("key", "hub.node", "hub.comp"), "minhash-hubs")
        self.used.append(found)
        return found

    def compare(self, pairs: DataFrame) -> None:
        """Sift pairs by length and sketch, and confirm what is left by the full sets."""
        facts = self.nodes.select("node", "n", *SKETCH)
        sifted = pairs.alias("p").join(facts.alias("x"), F.col("p.a") == F.col("x.node")).join(facts.alias("y"), F.col("p.b") == F.col("y.node"))
        pairs = stage(sifted.filter(_near("x", "y", self.percent)).select("p.a", "p.b"), "minhash-pairs")
        sets = self.sets if self.sets is not None else sets_of(pairs, self.texts, self.nodes, self.shingle)
        self.links.append(confirm(pairs, sets, self.percent))

    def star(self, members: DataFrame, hubs: DataFrame) -> None:
        met = members.join(hubs.select("key", F.col("node").alias("hub"), F.col("comp").alias("hub_comp")), "key")
        met = met.filter("comp <> hub_comp")
        self.compare(met.select(*_ordered(F.col("node"), F.col("hub"))).distinct())

    @staticmethod
    def _band(n: Column) -> Column:
        """The band, of its hub's, that a size falls into."""
        return F.floor((n - F.col("smallest")) * BANDS / (F.col("largest") - F.col("smallest") + 1))

    def looked_up(self, groups: DataFrame, index: DataFrame, live: DataFrame) -> DataFrame:
        """By band of partners' sizes the rarest shingles of live nodes, by which every partner above their bound is found."""
        first = F.greatest("least", F.col("bound") + 1)
        last = F.least("largest", F.floor(F.col("n") * 100 / self.percent))
        asked = live.filter((F.col("held") >= F.col("needed")) & (first <= last)).withColumn("first", first)
        asked = asked.withColumn("band", F.explode(F.sequence(self._band(F.col("first")), self._band(last))))
        asked = asked.join(groups.select("hub", "band").distinct(), ["hub", "band"])
        lowest = F.col("smallest") + F.ceil(F.col("band") * (F.col("largest") - F.col("smallest") + 1) / BANDS)
        needed = _required(F.col("n"), F.greatest("first", lowest), self.percent) - F.col("inside")
        asked = asked.select("hub", "node", "comp", "n", "inside", "held", "first", "band", (F.col("held") - needed + 1).alias("upto"))
        return asked.join(index, ["hub", "node"]).filter("place <= upto")

    def posted(self, groups: DataFrame, index: DataFrame) -> DataFrame:
        return groups.select("hub", "node", "comp", "n", "inside", "held", "band").join(index, ["hub", "node"])

    def to_meet(self, groups: DataFrame, index: DataFrame, live: DataFrame) -> int:
        """Rows that the looked up shingles meet."""
        there = self.posted(groups, index).groupBy("hub", "shingle", "band").agg(F.count("*").alias("there"))
        return self.looked_up(groups, index, live).join(there, ["hub", "shingle", "band"]).agg(F.sum("there")).first()[0] or 0

    def rest(self, groups: DataFrame, index: DataFrame, live: DataFrame) -> None:
        """Live nodes beside the nodes that hold their rarest shingles, and beside those small enough to need none."""
        x, y = self.looked_up(groups, index, live).alias("x"), self.posted(groups, index).alias("y")
        same = reduce(lambda p, q: p & q, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("hub", "shingle", "band")])
        # Of what two nodes share outside the hub, the rarest leaves either of them enough places for the others.
        needed = _required(F.col("x.n"), F.col("y.n"), self.percent) - F.least("x.inside", "y.inside")
        enough = reduce(lambda p, q: p & q, [F.col(f"{s}.place") <= F.col(f"{s}.held") - needed + 1 for s in "xy"])
        met = x.join(y, same & (F.col("x.comp") != F.col("y.comp")) & (F.col("y.n") >= F.col("x.first")) & enough)
        found = met.select(*_ordered(F.col("x.node"), F.col("y.node")))
        # By sizes: small partners only, in salted groups.
        loose = live.filter("least <= bound")
        limits = loose.groupBy("hub").agg(F.max("bound").alias("limit"), F.ceil(F.count("*") / SALTED).cast("int").alias("salts"))
        small = groups.join(limits, "hub").filter(F.col("n") <= F.col("limit"))
        small = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("b")
        own = loose.join(limits, "hub").withColumn("salt", F.pmod(F.hash("node"), "salts")).alias("a")
        same = (F.col("a.hub") == F.col("b.hub")) & (F.col("a.salt") == F.col("b.salt")) & (F.col("a.comp") != F.col("b.comp"))
        sized = own.join(small, same & (F.col("b.n") <= F.col("a.bound")) & self._possible("a", "b"))
        self.compare(found.unionAll(sized.select(*_ordered(F.col("a.node"), F.col("b.node")))).distinct())

    def _possible(self, a: str, b: str) -> Column:
        """Whether what two nodes share inside and outside their hub can be enough."""
        most = F.least(f"{a}.inside", f"{b}.inside") + F.least(f"{a}.held", f"{b}.held")
        return most >= _required(F.col(f"{a}.n"), F.col(f"{b}.n"), self.percent)

    def run(self) -> DataFrame | None:
        """``node`` and ``root`` of all linked nodes; None where nothing is shared."""
        if self.members.isEmpty():
            return None
        members = self.members.withColumn("comp", F.col("node"))
        self.star(members, self.hubs(members))
        members = self.open_members()
        # All further pairs are among these nodes.
        self.sets = full_sets(self.texts, self.nodes, members.select("node").distinct(), self.shingle)
        before = None
        while True:
            groups, index, live = self.left(members)
            now = live.count()
            met = self.to_meet(groups, index, live)
            if met <= FEW * groups.count() or before is not None and 2 * now > before:
                self.rest(groups, index, live)
                return self.roots()
            before = now
            weighted = members.join(live.select("node").distinct(), "node", "left_semi").join(self.members, ["key", "node"])
            own = self.used[0].select("key", F.col("node").alias("hub"))
            main = members.join(own, "key").filter("node = hub").select("key", F.col("comp").alias("main"))
            self.star(members, self.hubs(weighted.join(main, "key").filter("comp <> main")))
            members = self.open_members()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 85, chunks: int = 8, symbols: int = 4, errors: int = 1
) -> DataFrame:
    """Every row's id, ``n_shingles``, ``component_id`` (the smallest id it is linked to), and whether it is that row (``kept``)."""
    if chunks * symbols > HASHES or not 0 <= errors < symbols:
        raise ValueError("a signature has at most 128 symbols, and a chunk more symbols than errors")
    texts = stage_blocks(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")), "minhash-texts")
    rows = prints(texts, shingle, chunks, symbols, errors)
    facts = F.any_value(F.struct("n", *SKETCH, "keys"))
    grouped = rows.filter("n > 0").groupBy("set").agg(
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id")).alias("first"), F.min(F.struct("block", "row")).alias("place"), facts.alias("facts")
    )
    nodes = stage(grouped.select(F.monotonically_increasing_id().alias("node"), "set", "first", "place.*", "facts.*"), "minhash-nodes", "zstd")
    roots = Search(texts, nodes, shingle, percent).run()
    named = nodes.select("set", "node", "first")
    if roots is None:
        placed = named.select("set", F.col("first.id").alias("least"))
    else:
        linked = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = linked.groupBy("root").agg(F.min("first").alias("least"))
        placed = linked.join(least, "root").select("set", F.col("least.id").alias("least"))
    found = rows.select("id", "n", "set").join(placed, "set", "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id"))
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
