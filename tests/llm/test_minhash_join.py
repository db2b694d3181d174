"""MinHash near-duplicates against every pair of sets, and the index against every pair of signatures."""

import random
from itertools import combinations

import numpy as np
import pytest

from tallylake.llm import minhash_join as mh
from tallylake.llm.catalogue import queries

SF = "/root/testdata/sf0.001"


def shingles(text, size=3):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows, size=3, percent=85):
    sets = [shingles(text, size) for _, text in rows]
    distinct = sorted({s for s in sets if s}, key=len)
    parent = list(range(len(distinct)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(distinct)), 2):
        x, y = distinct[i], distinct[j]
        if 100 * len(x) >= percent * len(y):
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                parent[find(j)] = find(i)
    root = {s: find(i) for i, s in enumerate(distinct)}
    least = {}
    for (doc, _), s in zip(rows, sets, strict=True):
        if s and doc is not None:
            least[root[s]] = min(least.get(root[s], doc), doc)
    out = []
    for (doc, _), s in zip(rows, sets, strict=True):
        component = least.get(root[s]) if s else doc
        out.append((doc, len(s), component, doc == component))
    return sorted(out, key=str)


def check(spark, rows, **options):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, keys string, n int").repartition(4)
    found = mh.near_duplicates(docs, **options)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    limits = {k: v for k, v in options.items() if k == "percent"}
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, options.get("shingle", 3), **limits)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = queries()["op13_minhash_near_dedup"](spark, SF)
    assert sorted(map(tuple, found.collect()), key=str) == brute([tuple(r) for r in docs.collect()])


def changed(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"n{rng.randrange(10_000)}"
    return " ".join(out)


def test_odd_rows_equal_brute_force(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(200)]
    rows = [(100 + i, changed(rng, base, i % 8)) for i in range(60)]
    rows += [(1, None), (2, ""), (3, " \t\n"), (None, "a b"), (None, "A  B"), (4, "a b"), (4, "a b"), (5, "x " * 60_000), (6, "Ünï code ﬁ"), (7, "a"), (8, "a b c")]
    rows += [(9, "ab c"), (10, "a bc"), (11, "a b c d e f g h"), (12, "a b c d e f g h i"), (None, changed(rng, base, 1)), (13, changed(rng, base, 0)), (13, changed(rng, base, 2))]
    check(spark, rows)


def test_chains_and_stars_without_a_common_middle(spark):
    """A chain of texts that drift away, and copies that are near to some others only."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(40):
        words[3 * i % 150] = f"c{i}"
        rows.append((i, " ".join(words)))
    base = [f"b{i}" for i in range(120)]
    rows += [(1000 + i, changed(rng, base, 3)) for i in range(80)]
    check(spark, rows)


@pytest.mark.parametrize(("salted", "few"), [(1, 10**9), (64, 8), (3, 0)])
def test_nodes_left_after_the_hubs(spark, monkeypatch, salted, few):
    """Near copies at the limit: hubs leave many apart, and the last comparison finds the rest."""
    monkeypatch.setattr(mh, "SALTED", salted)
    monkeypatch.setattr(mh, "FEW", few)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(100)]
    check(spark, [(i, changed(rng, base, rng.choice([2, 3, 4]))) for i in range(150)])


def cut(rng, words, n):
    out = list(words)
    for _ in range(n):
        del out[rng.randrange(len(out))]
    return " ".join(out)


def test_copies_that_share_their_edits(spark):
    """Words left out give equal new shingles and smaller sets, so links exist that no hub sees."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, cut(rng, base, rng.choice([1, 2, 3, 4]))) for i in range(120)]
    rows += [(1000 + i, cut(rng, base[::-1], rng.choice([2, 3]))) for i in range(60)]
    check(spark, rows)


def test_nodes_that_cannot_be_linked_are_not_met(spark, monkeypatch):
    """Near copies that all share a line beside their hub: what a pair needs depends on both, and few pairs have it among their rarest."""
    met = []
    compare = mh.Search.compare

    def counted(self, pairs):
        met.append(pairs.count())
        compare(self, pairs)

    monkeypatch.setattr(mh.Search, "compare", counted)
    monkeypatch.setattr(mh.Search, "_possible", lambda self, a, b, outside=None: mh.F.lit(True) if outside is not None else mh.F.lit(False))
    rng = random.Random(6)
    base = [f"b{i}" for i in range(140)]
    line = " ".join(f"l{i}" for i in range(6))
    near = [(i, f"{changed(rng, base, 3)} {line}") for i in range(40)]
    far = [(100 + i, f"{changed(rng, base, 5)} {line}") for i in range(120)]
    check(spark, near + far + [(1000 + i, changed(rng, base, rng.choice([0, 1]))) for i in range(60)])
    assert met[-1] < 6000


def test_other_limits(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, changed(rng, base, rng.choice([0, 1, 2, 8]))) for i in range(40)] + [(90, "a b"), (91, "a b c")]
    check(spark, rows, percent=95, shingle=2)
    check(spark, rows, percent=100)


def test_empty_table(spark):
    assert mh.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_index_finds_every_pair_within_the_distance():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 1 << 16, (60, mh.HASHES), np.uint64)
    near = np.repeat(symbols, 6, 0)
    for row in near:
        places = rng.choice(32, rng.integers(0, 24), replace=False)
        row[places] = rng.integers(0, 1 << 16, len(places), np.uint64)
    keys = mh.signature_keys(near, 8, 4, 1)
    for i, j in combinations(range(len(near)), 2):
        distance = int((near[i, :32] != near[j, :32]).sum())
        if distance < 8 * 2:
            assert (keys[i] == keys[j]).any()


def test_symbols_estimate_similarity_and_the_sketch_lets_links_pass():
    rng = np.random.default_rng(2)
    distances = []
    for _ in range(300):
        shared, own, theirs = (mh.mixed(rng.integers(0, 1 << 63, n, np.uint64)) for n in (170, 15, 15))
        one, two = mh.minimum_hashes([np.concatenate([shared, own]), np.concatenate([shared, theirs])])
        distances.append(int(((one & np.uint64(3)) != (two & np.uint64(3))).sum()))
    assert abs(np.mean(distances) / mh.HASHES - 0.15 * 0.75) < 0.01
    assert max(distances) <= mh.most_differing(85) < 45
