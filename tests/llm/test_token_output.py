"""Token shards: exact round trips against the tokenizer itself."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallylake.llm import token_output, word_ids
from tallylake.llm.catalogue import queries
from tallylake.llm.word_ids import WordIds, default_vocabulary

SF = "/root/testdata/sf0.001"
TOKENIZER = Tokenizer.from_file(default_vocabulary())
WORDS = WordIds(default_vocabulary(), capacity=50)


def brute(rows):
    ids = {}
    for doc, text in rows:
        found = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]
        ids.setdefault(doc, []).append(found)
    out, start = [], 0
    for doc in sorted(ids, key=lambda d: (d is not None, d)):
        for found in ids[doc]:
            out.append((doc, start, len(found), zlib.crc32(np.array(found, "<u4").tobytes())))
            start += len(found)
    return out


@given(st.lists(st.integers(0, (1 << 32) - 1) | st.sampled_from([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24])))
def test_ranks_round_trip(ranks):
    ranks = np.array(ranks, np.uint32)
    assert token_output.decode(*token_output.encode(ranks), len(ranks)).tolist() == ranks.tolist()


@settings(deadline=None, max_examples=300)
@given(st.text() | st.text("aBIÅK.,!'<|endoftextEND|> \n\x0b\x1c\x85́ é１"))
def test_words_encode_like_texts(text):
    wanted = TOKENIZER.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(next(iter(WORDS.texts([text.encode()]))), WORDS.dtype).tolist() == wanted


@pytest.mark.parametrize("letter", ["H\u0331", "T\u0308", "J\u030c", "W\u030a", "Y\u030a", "H\u1dce\u0331"])
def test_small_letters_that_compose_where_capitals_do_not(letter):
    for text in (letter, letter + "x", f"AB{letter}C the {letter}. {letter.lower()}x É{letter}", letter + " <|endoftext|>"):
        wanted = TOKENIZER.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(next(iter(WORDS.texts([text.encode()]))), WORDS.dtype).tolist() == wanted


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = queries()["op7_token_output"](spark, SF)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    wanted = brute(sorted(tuple(r) for r in docs.collect()))
    found = [tuple(r) for r in found.collect()]
    totals = lambda rows: sorted((d, n, c) for d, _, n, c in rows)
    assert totals(found) == totals(wanted)
    assert sorted(r[1] for r in found) == np.cumsum([0, *(r[2] for r in sorted(found, key=lambda r: r[1]))])[:-1].tolist()
    assert [r[0] for r in sorted(found, key=lambda r: r[1])] == [r[0] for r in wanted]


def test_odd_rows(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(5, None), (4, ""), (3, "Hello, <|endoftext|> <|EndOfText|> World!"), (2, "é ﬁ \x1c ok's"), (None, "null id"), (-7, "x y " * 150_000), (3, "again"), (3, "again")]
    rows += [(i, " ".join(rng.choice("abcdefg") * rng.randint(1, 9) for _ in range(i))) for i in range(10, 60)]
    docs = spark.createDataFrame([(*r, "p", 1) for r in rows], "doc_id long, text string, path string, start int")
    found = [tuple(r) for r in token_output.write_and_read(docs).collect()]
    totals = lambda rows: sorted(((d, n, c) for d, _, n, c in rows), key=str)
    wanted = brute(rows)
    assert totals(found) == totals(wanted)
    found.sort(key=lambda r: r[1])
    assert [r[0] for r in found] == [r[0] for r in wanted]
    assert [r[1] for r in found] == np.cumsum([0, *(r[2] for r in found)])[:-1].tolist()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_output.write_and_read(docs).collect() == []


def test_frequent_ids_take_one_byte(spark):
    docs = spark.createDataFrame([(i, "the of and " * 500) for i in range(8)], "doc_id long, text string")
    shards = token_output.write_shards(docs)
    paths = [r.path for r in shards.table.collect()]
    size = sum(token_output.open_file(p).size() for p in paths)
    ids = sum(r.n_tokens for r in shards.table.collect())
    assert ids == 8 * 1501 and size < 1.3 * ids + 400 * len(paths)
    with pytest.raises(ValueError):
        list(token_output.read_file(__file__))


def test_files_alone_give_back_the_ids(spark, tmp_path):
    """Two corpora in one folder, moved elsewhere; nothing but the files is used."""
    texts = {1: "the cat sat", 2: None, 3: "a dog, the dog!"}
    for part in ({1: texts[1], 2: texts[2]}, {3: texts[3]}):
        docs = spark.createDataFrame(list(part.items()), "doc_id long, text string")
        token_output.write_shards(docs, folder=str(tmp_path / "one"))
    (tmp_path / "one").rename(tmp_path / "two")
    found = {}
    for path in (tmp_path / "two").glob("shard-*"):
        found |= {doc: ids.tolist() for doc, ids in token_output.read_file(str(path))}
    plain = Tokenizer.from_file(default_vocabulary())
    assert found == {k: [*plain.encode(t or "", add_special_tokens=False).ids, 2] for k, t in texts.items()}


def test_plain_words_are_encoded_many_at_once(monkeypatch):
    """The same ids as the tokenizer gives each word, of fewer texts than words."""
    rng = random.Random(3)
    letters = "abcZ019'.,#<|>/w'st" + "".join(map(chr, range(0xC0, 0x180))) + "\u0301\u212b\u4e00\u00b2\x1f\x00"
    ways = ["aeblrstvmd'", "aeblrstvmd'.#0", letters]
    words = sorted({"".join(rng.choices(rng.choice(ways), k=rng.randrange(1, 9))) for _ in range(4000)} | {"<|endoftext|>", "</w>", "\u0130", "\u1e9e", "'RE", "\u00e9's"})
    encoder, given = WordIds(default_vocabulary(), capacity=100_000), []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return TOKENIZER.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counted()
    found = encoder.texts([w.encode() for w in words])
    for word, ids in zip(words, found, strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == TOKENIZER.encode(word, add_special_tokens=False).ids, word
    assert len(given) < len(words) / 2


def test_pieces_of_plain_words():
    """As many as the vocabulary's own cut has; none for words that aren't plain."""
    rng = random.Random(4)
    letters = "abcZ019.,#<|>/_" + "".join(c for c in map(chr, range(0xC0, 0x180)) if c not in "\u00d7\u00f7\u0130")
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(3000)]
    words = [w for w in words if "<|" not in w]
    cut = TOKENIZER.pre_tokenizer.pre_tokenize_str
    assert word_ids._pieces([w.encode() for w in words]).tolist() == [len(cut(w.lower())) for w in words]
    odd = ["it's", "2\u00d72", "\u00f7", "\u0130x", "a\u0301", "\u00b2", "\u4e00", "x\x7f", "\x1f", "<|a", "\u01c5"]
    assert word_ids._pieces([w.encode() for w in odd]).tolist() == [0] * len(odd)


def test_plain_words_are_not_normalized_again(monkeypatch):
    """They compose with nothing and come in small letters, so just the others go to the whole tokenizer."""
    encoder = WordIds(default_vocabulary(), capacity=1000)
    monkeypatch.setattr(encoder, "tokenizer", None)
    words = ["plain", "\u00c9cole,", "x1y2", "ABC"]
    found = encoder.learn({w.encode() for w in words})
    for word in words:
        assert np.frombuffer(found[word.encode()], encoder.dtype).tolist() == TOKENIZER.encode(word, add_special_tokens=False).ids, word
