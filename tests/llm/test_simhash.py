"""SimHash near-duplicates against every pair of fingerprints."""

import random

import numpy as np
import pytest
import xxhash

from tallylake.llm import simhash
from tallylake.llm.catalogue import queries

SF = "/root/testdata/sf0.001"


def brute(rows, shingle=3, max_bits=3):
    prints = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    values = sorted(set(prints))
    own = np.array(values, np.uint64)
    parent = np.arange(len(values))
    for i in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(own ^ own[i]) <= max_bits)
        parent = simhash.union(parent, near, np.full(len(near), i))
    root = dict(zip(values, parent.tolist(), strict=True))
    least = {}
    for (doc, _), fp in zip(rows, prints, strict=True):
        if doc is not None:
            least[root[fp]] = min(least.get(root[fp], doc), doc)
    return sorted(((doc, f"{fp:016x}", least.get(root[fp])) for (doc, _), fp in zip(rows, prints, strict=True)), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = queries()["op3_simhash_near_dedup"](spark, SF)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == brute([tuple(r) for r in docs.collect()])


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(200)]
    rows = [(100 + i, " ".join(base[: i % 7] + [rng.choice(words)] + base[i % 7 + 1 :])) for i in range(40)]
    rows += [(1, None), (2, ""), (3, " \t\n"), (None, "a b"), (None, "A  B"), (4, "a b"), (4, "a b"), (5, "x " * 60_000), (6, "Ünï code ﬁ")]
    rows += [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(7, 60)]
    return rows


def test_odd_rows_equal_brute_force(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string")
    found = simhash.near_duplicates(docs)
    assert sorted(map(tuple, found.collect()), key=str) == brute(odd_rows)
    found = simhash.near_duplicates(docs, max_bits=5)
    assert sorted(map(tuple, found.collect()), key=str) == brute(odd_rows, max_bits=5)


def test_one_row_of_each_component_stays(spark, odd_rows):
    rows = [(*r, "x", 1) for r in odd_rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, id int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    roots = {(d, c) for d, _, c in brute(odd_rows)}
    assert {r.doc_id for r in kept} == {c for _, c in roots}
    assert len(kept) == len({c for _, c in roots})


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.keep_one(docs).collect() == []


@pytest.mark.parametrize("max_bits", [1, 2, 3, 4])
def test_every_group_of_bits_leaves_a_byte_group(max_bits):
    from itertools import combinations

    groups = simhash.byte_groups(max_bits)
    for lost in combinations(range(8), max_bits):
        assert any(not set(g) & set(lost) for g in groups)


@pytest.mark.parametrize("max_bits", [1, 2, 3, 4])
def test_long_lists_link_like_pairs(max_bits):
    rng = np.random.default_rng(5)
    group = simhash.byte_groups(max_bits)[3 % len(simhash.byte_groups(max_bits))]
    free = [8 * p + b for p in range(8) if p not in group for b in range(8)]
    own = set()
    for center in range(40):
        start = sum(1 << int(b) for b in rng.choice(free, 9, replace=False))
        for _ in range(10):
            own.add(start ^ sum(1 << int(b) for b in rng.choice(free, rng.integers(0, 4), replace=False)))
    fps = np.array(sorted(own), np.uint64)
    one = simhash._neighbours(fps, group, max_bits)
    two = simhash._pairs(fps, np.zeros(len(fps), int), max_bits)
    assert one.tolist() == two.tolist() and len(set(one.tolist())) > 1
