"""Quality rules against a plain version; the order of the cascade doesn't show."""

import re
from collections import Counter

import pytest

from tallylake.llm import quality_rules as q

GOOD = " ".join(f"word{i % 37}x{i}" for i in range(60))
TEXTS = [
    GOOD,
    None,
    "",
    " \n\t ",
    "a b c " * 40,
    ("a b c d\n" * 20) + GOOD,
    "\n".join(["same line here", "same line here", GOOD, "", "", " "]),
    GOOD.replace(" ", " # $ "),
    "é" * 2000 + " " + GOOD,
    "one two three one two three" + " " + GOOD,
    "x " * 40_000,
    GOOD + "\r\n" + GOOD,
    "y\x0bz\x0cw \x1c v",
]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    repeat = len({p for i, g in enumerate(grams) if count[g] > 1 for p in (i, i + 1, i + 2)})
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars, symbols = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or ""))
    dup = len(lines) - len(set(lines))
    base = n < 50 or 100 * repeat > 50 * n
    kept = not (base or 10 * symbols > n or chars < 2 * n or chars > 15 * n or 2 * dup > len(lines))
    return n, chars, symbols, len(lines), dup, repeat, base, kept


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 9, "z") for i, t in enumerate(TEXTS)] + [(None, GOOD, 1, None), (0, GOOD, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, t string")


def test_measures_and_verdicts(docs):
    found = q.judge_documents(docs)
    assert found.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    wanted = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=str)
    assert sorted(map(tuple, found.collect()), key=str) == wanted


def test_kept_documents_are_whole(docs):
    kept = q.keep_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((tuple(r) for r in docs.collect() if brute(r.text)[-1]), key=str)


def test_any_order_gives_the_same(docs, monkeypatch):
    whole = sorted(map(tuple, q.keep_documents(docs).collect()), key=str)
    monkeypatch.setattr(q, "order_rules", lambda d, rules, *a: list(reversed(rules)))
    assert sorted(map(tuple, q.keep_documents(docs).collect()), key=str) == whole


def test_cheap_rules_that_reject_go_first(spark):
    junk = spark.range(400).selectExpr("'a # b # c' AS text")
    ordered = [r.name for r in q.order_rules(junk)]
    assert sorted(ordered) == sorted(r.name for r in q.RULES)
    assert ordered[0] in ("few_words", "symbols", "word_length")  # the others reject nothing here
    assert [r.name for r in q.order_rules(junk.limit(0))] == [r.name for r in q.RULES]


def test_empty_table(docs):
    assert q.judge_documents(docs.limit(0)).collect() == [] and q.keep_documents(docs.limit(0)).collect() == []
