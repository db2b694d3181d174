"""Language identification: held-out accuracy, whole texts, odd rows."""

import zlib

import numpy as np
import pytest

from tallylake.llm import language_id as li
from tallylake.llm.catalogue import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def net(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return li.fit(docs.filter(~li.held_out(docs["doc_id"])))


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries()["op1_language_id"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    judged = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out and docs[r.doc_id].lang is not None]
    assert len(judged) > 150 and sum(judged) >= 0.95 * len(judged)


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    windows, answers = rng.integers(0, 256, (64, li.WINDOW)).astype(np.uint8), rng.integers(0, 3, 64)
    windows[answers == 1, 30] = 7
    windows[answers == 1, 31] = 8
    windows[answers == 2, 99] = 9
    net = li.train(["a", "b", "c"], windows, answers, epochs=150)
    assert (net.chances(windows, net.tables()).argmax(1) == answers).mean() > 0.95


@pytest.fixture(scope="module")
def samples(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars > 500").orderBy("doc_id").collect()
    return {lang: next(r.text for r in docs if r.lang == lang) for lang in ("de", "en")}


def test_odd_rows(spark, net, samples):
    texts = [None, "", "12 .. 3", "\n", "²³", "é", "the and of with that", samples["de"] * 300]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "the of and", "y"), (6, texts[6], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = sorted(map(tuple, li.predict(docs, net).collect()), key=str)
    assert [(i, s) for i, p, s in found if p == "und"] == [(i, 0.0) for i in range(5)]
    assert {p for i, p, _ in found if i == 7} == {"de"}
    assert len(found) == len(rows) and len({f for f in found if f[0] == 6}) == 1
    assert li.predict(docs.limit(0), net).collect() == []


def test_the_end_of_a_text_counts(net, samples):
    one, two = net.labels.index("de"), net.labels.index("en")
    german, english = samples["de"].encode(), samples["en"].encode() * 20
    found = li.scores(net, [german, german + english])
    assert found[0].argmax() == one and found[1].argmax() == two
    assert np.allclose(li.scores(net, [german]), found[:1])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en"), (3, "1", "en")], "doc_id long, text string, lang string")
    assert [tuple(r) for r in li.identify(docs).orderBy("doc_id").collect()] == [(i, zlib.crc32(str(i).encode()) % 4 == 2, "und", 0.0) for i in (1, 2, 3)]
    assert li.identify(docs.limit(0)).collect() == []
