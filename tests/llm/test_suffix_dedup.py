"""Removal of repeated substrings against a dictionary of every 50-byte string."""

import hashlib
import random

import numpy as np
import pytest

from tallylake.llm import suffix_dedup as sd
from tallylake.llm.catalogue import queries

SF = "/root/testdata/sf0.001"


def brute(rows):
    order = lambda d: (d is None, d or 0)
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49):
            s = data[i : i + 50]
            if s not in first or order(doc) < first[s]:
                first[s] = order(doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < order(doc):
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and not before for g, before in zip(gone, b"\0" + bytes(gone), strict=False))
        out.append((doc, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = queries()["op6_suffix_dedup"](spark, SF)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows == brute([tuple(r) for r in docs.collect()]) and any(r[2] for r in rows)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(9)
    text = lambda n, letters="abcdeé \n\0": "".join(rng.choice(letters) for _ in range(n))
    passages = [text(rng.choice([49, 50, 51, 80, 200])) for _ in range(12)]
    rows = [(i, text(rng.randint(0, 60)) + rng.choice(passages) + text(rng.randint(0, 90)) + rng.choice(passages)) for i in range(150)]
    rows += [(200 + i, text(300, "ab")) for i in range(30)] + [(300 + i, "a" * (40 + 7 * i)) for i in range(8)]
    rows += [(i, passages[5] * 3) for i in (400, 401, 401, None, None)] + [(402, None), (403, ""), (404, passages[0][:49]), (405, "xy" * 40_000 + passages[3])]
    rows += [(500 + i, rows[7][1]) for i in range(20)] + [(-1, rows[8][1])]
    return rows


@pytest.mark.parametrize("options", [{}, {"block_bytes": 500}, {"list_rows": 2}, {"list_rows": 20, "block_bytes": 3000}])
def test_odd_rows_equal_brute_force(spark, odd, options):
    docs = spark.createDataFrame([(*r, 1, "k") for r in odd], "doc_id long, text string, row int, kept string").repartition(3)
    found = sorted(map(tuple, sd.judge_documents(docs, **options).collect()), key=str)
    wanted = brute(odd)
    assert [f for f, w in zip(found, wanted, strict=True) if f != w] == []


def test_empty_table(spark):
    assert sd.judge_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_every_window_has_one_phrase_and_content_decides():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 101, 5000).astype(np.uint8).tobytes()
    doc, gram, place, first, last = sd.parse([b"", text, b"short", text[1000:3000]])
    own = [(d, w) for d, a, b in zip(doc, first, last, strict=True) for w in range(a, b + 1)]
    assert len(own) == len(set(own)) == 4951 + 1951 and set(doc.tolist()) == {1, 3}
    assert ((place >= last) & (place - first <= sd.REACH)).all()
    trigger = {w: p - w for a, b, p in zip(first, last, place, strict=True) for w in range(a, b + 1)}
    for w in range(1000, 2951, 50):
        assert trigger[w] == trigger[5005 + w - 1000]


def test_a_text_longer_than_the_packed_places(monkeypatch):
    rng = np.random.default_rng(2)
    text = rng.integers(97, 101, 3000).astype(np.uint8).tobytes()
    whole = [x.tolist() for x in sd.parse([text])]
    h = sd._gram_hashes(np.frombuffer(text, np.uint8))
    pieces = np.concatenate([sd._leftmost(h[k : k + 500 + sd.LENGTH - 1])[:500] + k for k in range(0, 3000, 500)])
    assert pieces.tolist() == sd._leftmost(h).tolist() and len(whole[0]) > 100
