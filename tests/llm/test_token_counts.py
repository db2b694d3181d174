"""Token counts after edits against encoding the edited text from scratch."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallylake.llm import token_counts as tc
from tallylake.llm.catalogue import queries
from tallylake.llm.word_ids import WordIds, default_vocabulary

SF = "/root/testdata/sf0.001"
TOKENIZER = Tokenizer.from_file(default_vocabulary())
ENCODER = WordIds(default_vocabulary(), capacity=1_000_000)


def tokens(text):
    return len(TOKENIZER.encode((text or b"").decode(), add_special_tokens=False).ids)


def edited(text, edits):
    for a, b, new in reversed(sorted(edits, key=lambda e: e[:2])):
        text = text[:a] + new + text[b:]
    return text


@st.composite
def edited_texts(draw):
    words = draw(st.lists(st.sampled_from(["a", "the", "wording", "x,y", "é", "don't", "<|endoftext|>", "1234"]), max_size=120))
    gaps = draw(st.lists(st.sampled_from([" ", "\n", "  ", "\t\r"]), min_size=len(words), max_size=len(words)))
    text = draw(st.sampled_from(["", " "])) + "".join(w + g for w, g in zip(words, gaps, strict=True))
    places = sorted(draw(st.lists(st.integers(0, len(text)), max_size=8)))
    pairs = list(zip(places[::2], places[1::2], strict=False))
    size = lambda k: len(text[:k].encode())
    new = st.sampled_from([b"", b" ", b"new", b" two words ", b"\n"])
    return text.encode(), [(size(a), size(b), draw(new)) for a, b in pairs]


@settings(deadline=None, max_examples=400)
@given(edited_texts(), st.integers(0, 3))
def test_edits_count_like_a_fresh_encoding(case, again):
    text, edits = case
    ENCODER.learn(set(text.split()))
    tree = tc.build(ENCODER, text, text.split())
    assert tree.total == tokens(text) and tree.lengths.sum() == len(text)
    for _ in range(1 + again):
        wanted = edited(text, edits)
        text, tree, _ = tc.apply(ENCODER, text, tc.Tree.unpacked(*tree.packed()), edits)
        assert text == wanted and tree.total == tokens(text)
        width = tree.width
        assert tree.lengths.sum() == len(text) and tree.sums[width:].sum() == tree.total
        edits = [(0, 0, b"start")] if text else []


def test_only_touched_leaves_are_encoded():
    text = b"word " * 16_000
    ENCODER.learn({b"word"})
    tree = tc.build(ENCODER, text, text.split())
    _, after, encoded = tc.apply(ENCODER, text, tree, [(40_000, 40_004, b"other")])
    assert encoded == tc.LEAF_WORDS and after.total == 16_000
    assert (after.sums != tree.sums).sum() == 0
    with pytest.raises(ValueError):
        tc.apply(ENCODER, text, tree, [(0, 5, b""), (4, 6, b"")])


def test_query_equals_fresh_counts(spark):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries()["op8_token_counts"](spark, SF)
    assert found.columns == ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_encoded"]
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs) and any(r.n_edits for r in rows)
    for r in rows:
        edits = tc.tidy_edits(docs[r.doc_id])
        assert (r.n_tokens, r.n_edits, r.n_tokens_edited) == (tokens(docs[r.doc_id]), len(edits), tokens(edited(docs[r.doc_id], edits)))


def test_odd_rows(spark):
    texts = [None, "", " \n", "one\none\none", "a@b.cd " * 60_000, "same line x\n" * 5 + "é", "x"]
    rows = [(i, t, 1, "y") for i, t in enumerate(texts)] + [(None, "null id", 2, "z"), (6, "x", 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, sums string")
    found = tc.count_edited(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        text = ("null id" if r.doc_id is None else texts[r.doc_id] or "").encode()
        after = edited(text, tc.tidy_edits(text))
        assert (r.n_tokens, r.n_tokens_edited) == (tokens(text), tokens(after))
    assert tc.count_edited(docs.limit(0)).collect() == []
    kept = {r.id: r.text for r in tc.recount(tc.trees(docs)).collect()}
    assert kept[0] is None and kept[5].decode() == "same line x\né" and np.frombuffer(kept[1], np.uint8).size == 0
