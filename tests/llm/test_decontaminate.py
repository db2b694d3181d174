"""Decontamination against a plain search of every window."""

import hashlib
import random
import re

import pytest

from tallylake.llm import decontaminate


def words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def brute(docs, items, size=13):
    out = []
    for doc, text in docs:
        own, hit, names = words(text), set(), set()
        for item, item_text in items:
            of = words(item_text)
            n = min(size, len(of))
            if not n:
                continue
            windows = {tuple(of[i : i + n]) for i in range(len(of) - n + 1)}
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    names.add(item)
        ids = sorted(str(x) for x in names if x is not None)
        out.append((doc, len(own), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(1)
    vocabulary = ["alpha", "Beta", "γάμμα", "d9", "e"]
    item = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, item(n)) for i, n in enumerate([3, 13, 14, 40, 2, 25])] + [(None, item(15)), (7, None), (8, " ..."), (9, "e"), (3, item(20))]
    docs = [(i, item(30) + "! " + rng.choice([x for _, x in items if x]) + ", " + item(i * 5)) for i in range(20)]
    docs += [(20, None), (21, ""), (22, "--"), (23, items[3][1].upper()), (23, items[3][1].upper()), (None, items[1][1].replace(" ", "-")), (24, "zzz " * 50_000 + items[3][1])]
    return docs, items


def frames(spark, tables):
    docs, items = tables
    docs = spark.createDataFrame([(*d, 5, "y") for d in docs], "doc_id long, text string, n_words int, t string")
    return docs, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("slice_bytes", [8 << 20, 1, 300])
def test_equals_brute_force_whatever_the_slices(spark, tables, slice_bytes):
    docs, items = frames(spark, tables)
    found = decontaminate.judge_documents(docs, items, slice_bytes=slice_bytes)
    assert sorted(map(tuple, found.collect()), key=str) == brute(*tables)


def test_one_slice_is_broadcast_at_a_time(spark, tables, monkeypatch):
    docs, items = frames(spark, tables)
    alive, most = [], []
    send = type(spark.sparkContext).broadcast

    def broadcast(context, value):
        sent = send(context, value)
        alive.append(sent)
        most.append(sum(b._jbroadcast is not None and b._jbroadcast.isValid() for b in alive))
        return sent

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    found = decontaminate.judge_documents(docs, items, slice_bytes=300)
    assert len(alive) > 1 and max(most) == 1
    assert sorted(map(tuple, found.collect()), key=str) == brute(*tables)


def test_contaminated_documents_go_and_columns_stay(spark, tables):
    docs, items = frames(spark, tables)
    kept = decontaminate.drop_documents(docs, items)
    assert kept.columns == docs.columns
    clean = [r[0] for r in brute(*tables) if not r[-1]]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_spans_are_removed(spark, tables):
    docs, items = frames(spark, tables)
    cut = decontaminate.remove_spans(docs, items)
    assert cut.columns == docs.columns
    before = {(r[0], r[1] - r[2]) for r in brute(*tables)}
    assert {(r.doc_id, len(words(r.text))) for r in cut.collect()} == before
    one = spark.createDataFrame([(1, "Before, one two THREE. after")], "doc_id long, text string")
    item = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert decontaminate.remove_spans(one, item).first().text == "Before, . after"


def test_empty_tables(spark, tables):
    docs, items = frames(spark, tables)
    assert decontaminate.judge_documents(docs.limit(0), items).collect() == []
    assert decontaminate.drop_documents(docs, items.limit(0)).count() == docs.count()


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontaminate, "rolling", lambda row, n: __import__("numpy").zeros(max(0, len(row) - n + 1), "uint64"))
    windows = decontaminate.Windows([("a", b"one two"), ("b", b"two one")], 13)
    hit, items = decontaminate.find(windows, [b"two", b"one", b"one"])
    assert hit.tolist() == [True, True, False] and items == {"b"}
