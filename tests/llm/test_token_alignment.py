"""Alignments against whole-text encodings compared token by token."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, pre_tokenizers

from tallylake.llm import token_alignment as ta
from tallylake.llm.catalogue import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def spans(ids, lengths):
    ends = np.cumsum(lengths).tolist()
    return list(zip(ids, [0, *ends[:-1]], ends, strict=True))


def plain(both, rows):
    """Whole texts encoded at once, every pair of tokens compared within a sliding range, sums by counters."""
    one, two = both
    # A byte's character in the vocabulary, as its pre-tokenizer writes it.
    alphabet = sorted(pre_tokenizers.ByteLevel.alphabet())
    plain_bytes = {ch: ord(ch) for ch in alphabet if ord(ch) < 256}
    rest = sorted(set(range(256)) - set(plain_bytes.values()))
    chars = plain_bytes | dict(zip([ch for ch in alphabet if ord(ch) >= 256], rest, strict=True))
    docs = []
    for key, text in rows:
        whole = (" " + (text or "")).encode()
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        bytes_a = [bytes(chars[c] for c in one.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            docs.append((key, [], [], "", 0))
            continue
        sa, sb = spans(a, [len(x) for x in bytes_a]), spans(b, [len(x) for x in bytes_b])
        links = [(x, y) for x, s, e in sa for y, t, f in sb if s < f and t < e]
        cuts = sorted({e for *_, e in sa} & {f for *_, f in sb})
        groups = []
        for low, high in zip([0, *cuts[:-1]], cuts, strict=True):
            groups.append("|".join(",".join(str(x) for x, s, e in side if low <= s and e <= high) for side in (sa, sb)))
        docs.append((key, sa, sb, ";".join(groups), links))
    count = Counter(link for d in docs if d[4] for link in d[4])
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for key, sa, sb, groups, links in docs:
        links = links or []
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((key, len(sa), len(sb), groups.count(";") + 1 if groups else 0, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), sha))
    return sorted(out, key=str)


def test_short_documents_of_the_tables_equal_brute_force(spark, both):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter("length(text) < 1500 or text is null")
    found = ta.align_digests(docs)
    assert sorted(map(tuple, found.collect()), key=str) == plain(both, [tuple(r) for r in docs.collect()])


def test_query_counts_whole_texts(spark, both):
    found = {r.doc_id: r for r in queries()["op12_token_alignment"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for doc, text in docs:
        row = found[doc]
        assert row.n_a == (len(both[0].encode(" " + text, add_special_tokens=False).ids) if text else 0)
        assert row.n_b == (len(both[1].encode(text)) if text else 0)
        assert row.n_links == row.n_a + row.n_b - row.n_groups


ODD = [
    (1, None), (2, ""), (3, " "), (4, "   "), (None, "two words"), (None, "two words"), (5, "two words"), (6, " lead and trail "),
    (7, "tabs\tand\nlines\n\n x  y z"), (8, "<|endoftext|> <s> </s> <unk> <0x41> a<|endoftext|>b"), (9, "has ▁ its own mark"),
    (10, "Ünïcödé 漢字かな 🙂🙂 ﬁ é"), (11, "it's they'll WE'D 'tis"), (12, "a" * 3000), (13, "nul\x00inside \x1c x\x1cy"), (14, "x" + " " * 40 + "y"),
    (15, "1234567890 3.14 -- ... !!!"), (16, "​ zero​width"),
]


def test_odd_texts_equal_brute_force(spark, both):
    docs = spark.createDataFrame([(k, t, "n", 1) for k, t in ODD], "doc_id long, text string, groups string, pair int").repartition(4)
    found = ta.align_digests(docs)
    assert found.columns == ["doc_id", *ta.COLUMNS, "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(both, ODD)


def test_bytes_that_are_no_text_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, bytearray(b"ab \xff"))], "doc_id long, text binary")
    assert [tuple(r) for r in ta.align_digests(docs).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]
    assert ta.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_groups_are_real_ids(spark, both):
    row = ta.align(spark.createDataFrame([(1, "unbelievable alignments")], "doc_id long, text string")).first()
    groups = [[[int(i) for i in side.split(",")] for side in g.split("|")] for g in row.groups.split(";")]
    assert [i for a, _ in groups for i in a] == both[0].encode(" unbelievable alignments", add_special_tokens=False).ids
    assert [i for _, b in groups for i in b] == both[1].encode("unbelievable alignments")


def test_fast_ids_equal_the_vocabularys_own(both):
    two = ta.shared(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    assert two.fast is not None
    # Every character that the fast way takes, in several neighbourhoods.
    chars = [chr(c) for c in range(0x250)]
    texts = [f"ab{c}cd {c} {c}{c}1{c} {c}'s\n{c}" for c in chars] + ["".join(chars), " ".join(chars)]
    assert not any(ta._UNUSUAL.search(t) for t in texts[:-2])
    assert [two.fast.encode_ordinary(" " + t) for t in texts] == [both[0].encode(" " + t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 3000), min_size=1), st.sets(st.integers(0, 3000)), st.integers(1, 70))
def test_galloping_equals_counting(short, long, lane):
    short, long = np.array(sorted(short)), np.array(sorted(long), np.int64)
    assert ta.gallop(short, long, lane).tolist() == [int((long < x).sum()) for x in short]
