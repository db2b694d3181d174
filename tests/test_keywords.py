import re

import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallylake.operators import keywords
from tallylake.operators.keywords import match_keywords
from tallylake.plans.discovery import (
    contact_reasons,
    customer_frustration,
    customer_intent,
    satisfaction_index,
    severity_indicator,
)

VISITS = [
    ("g1", "all tulips wilted, even the bulbs wilted"),
    ("g1", "WILTED"),
    ("g2", "free seeds again; what a lovely hedge"),
    ("g2", "free seeds again; what a lovely hedge"),
    ("g3", None),
    ("g4", "good morning"),
    ("g5", "parcel torn, 50% of_it"),
]
DICTIONARY = [
    (40, "wilted", "comp", -7, "compliant"),
    (41, "again; what", "cust", 2, "marketing"),
    (42, "lovely", "cust", -3, "marketing"),
    (43, "parcel", "comp", 0, "logistic"),
    (44, "orchid", "cust", 6, "purchases"),
]
DICTIONARY_SCHEMA = "rid int, orddesc string, comp_cust string, severity int, intent string"
WAYS = {"in the row": {}, "by piece": {"small_entries": 2}, "by piece for its bytes": {"small_bytes": 10}}


@pytest.fixture
def visits(spark):
    return spark.createDataFrame(VISITS, "customernumber string, comments string")


@pytest.fixture
def dictionary(spark):
    return spark.createDataFrame(DICTIONARY, DICTIONARY_SCHEMA)


def by_hand(visits, dictionary):
    return sorted((c, e[0]) for c, text in visits for e in dictionary if text is not None and e[1] in text)


@pytest.mark.parametrize("way", WAYS)
def test_matches(visits, dictionary, way):
    out = match_keywords(visits, dictionary, **WAYS[way])
    assert sorted((r.customernumber, r.rid) for r in out.collect()) == by_hand(VISITS, DICTIONARY)
    assert out.columns == ["customernumber", "comments", "rid", "orddesc", "comp_cust", "severity", "intent"]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("abé%_\\ \n", max_size=12), min_size=1, max_size=8),
    st.lists(st.text("abé %_\\", min_size=0, max_size=5), min_size=3, max_size=8),
)
@example(texts=['', 'a', 'ab%'], words=['', '', '%', 'b%'])
def test_both_ways_equal_brute_force(spark, texts, words):
    visits = [(str(i), text) for i, text in enumerate(texts)]
    entries = [(i, word, "c", 1, "x") for i, word in enumerate(words)]
    v = spark.createDataFrame(visits, "customernumber string, comments string")
    d = spark.createDataFrame(entries, DICTIONARY_SCHEMA)
    for way in WAYS.values():
        assert sorted((r.customernumber, r.rid) for r in match_keywords(v, d, literal=True, **way).collect()) == by_hand(visits, entries)


def like(text, keyword):
    pattern = "".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in keyword)
    return re.search(pattern, text, re.DOTALL) is not None


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("ab%_\\ \n", max_size=12), min_size=1, max_size=8),
    st.lists(st.text("ab%_\\ ", min_size=0, max_size=6), min_size=3, max_size=8),
)
@example(texts=['', 'a_b', 'ab%\n\\'], words=['', '%', '_', 'a%b', '\\', '_\n'])
def test_wildcards_in_both_ways(spark, texts, words):
    v = spark.createDataFrame([(str(i), text) for i, text in enumerate(texts)], "customernumber string, comments string")
    d = spark.createDataFrame([(i, word, "c", 1, "x") for i, word in enumerate(words)], DICTIONARY_SCHEMA)
    wanted = sorted((str(i), k) for i, text in enumerate(texts) for k, word in enumerate(words) if like(text, word))
    for way in WAYS.values():
        assert sorted((r.customernumber, r.rid) for r in match_keywords(v, d, **way).collect()) == wanted


@pytest.mark.parametrize("small", [100, 2])
def test_wildcards_and_backslashes(spark, visits, small):
    entries = [(1, "wil%ed", "c", 1, "x"), (2, "of_it", "c", 1, "x"), (3, "p_rc", "c", 1, "x"), (4, "a\\b", "c", 1, "x"), (5, None, "c", 1, "x")]
    d = spark.createDataFrame(entries, DICTIONARY_SCHEMA)
    more = visits.unionByName(spark.createDataFrame([("g6", "x a\\b y")], visits.schema))
    literal = match_keywords(more, d, literal=True, small_entries=small).collect()
    acting = match_keywords(more, d, small_entries=small).collect()
    assert sorted((r.customernumber, r.rid) for r in literal) == [("g5", 2), ("g6", 4)]
    assert sorted((r.customernumber, r.rid) for r in acting) == [("g1", 1), ("g5", 2), ("g5", 3), ("g6", 4)]


def test_no_python_and_no_nested_loop_for_a_large_dictionary(visits, dictionary):
    out = match_keywords(visits, dictionary, small_entries=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "NestedLoop", "Cartesian"))


def test_no_join_for_a_small_dictionary(visits, dictionary):
    plan = match_keywords(visits, dictionary)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def staged_texts(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "text long, body string")


def pieces(spark, words, literal=True):
    entries = spark.createDataFrame(list(enumerate(words)), "entry long, w string")
    return entries.select("entry", keywords._keyword_pieces(F.col("w"), literal).alias("pieces"))


def test_a_common_beginning_gives_no_pairs(spark):
    """Pairs stay within a multiple of the matches, however many words begin with what all texts hold."""
    bodies = [f"the end of the week number {i} and the zqa{i % 50:03d}x" for i in range(200)]
    words = [f"the zq{chr(97 + i % 26)}{i:03d}" for i in range(1500)]
    matches = sum(word in body for body in bodies for word in words)
    pairs = keywords.candidate_pairs(staged_texts(spark, bodies), pieces(spark, words))
    assert 0 < matches <= pairs.count() <= 4 * matches


@pytest.mark.parametrize("hot", [7, 100_000])
def test_frequent_and_hot_pieces(spark, monkeypatch, hot):
    monkeypatch.setattr(keywords, "FREQUENT", 3)
    monkeypatch.setattr(keywords, "HOT", hot)
    bodies = ["abcabd" if i % 3 else "abdx abc" for i in range(40)] + ["abc only", "abd only", "x"]
    words = ["abcabd", "abc", "ab", "zzz", "abdx%c", ""]
    found = keywords.candidate_pairs(staged_texts(spark, bodies), pieces(spark, words, literal=False)).collect()
    assert len(found) == len(set(found))
    matched = {(i, k) for i, body in enumerate(bodies) for k, word in enumerate(words) if like(body, word)}
    assert matched <= {tuple(p) for p in found}
    # The rarest pieces of the first word are those across its middle.
    assert {t for t, k in found if k == 0} == {i for i in range(40) if i % 3}


def test_columns_named_like_those_inside(spark):
    v = spark.createDataFrame([("a", "big cat", 1), ("b", "dog", 2)], "text string, comments string, entry int")
    d = spark.createDataFrame([("cat", "x", 5), ("😀b", "y", 6)], "orddesc string, piece string, salt int")
    out = match_keywords(v.unionByName(spark.createDataFrame([("c", "a😀b", 3)], v.schema)), d, small_entries=1)
    assert sorted(map(tuple, out.collect())) == [("a", "big cat", 1, "cat", "x", 5), ("c", "a😀b", 3, "😀b", "y", 6)]


def test_empty_dictionary(spark, visits):
    assert match_keywords(visits, spark.createDataFrame([], DICTIONARY_SCHEMA)).count() == 0


def test_frustration(visits, dictionary):
    out = {r.customernumber: (r.total_severity, r.customer_frustration_level) for r in customer_frustration(visits, dictionary).collect()}
    assert out == {"g1": (-7, "highly frustrated"), "g2": (-2, "low frustrated"), "g5": (0, "neutral")}


def test_customers_without_a_match_can_be_kept(visits, dictionary):
    out = customer_frustration(visits, dictionary, keep_unmatched=True).collect()
    found = {r.customernumber: (r.total_severity, r.customer_frustration_level) for r in out}
    assert found == {
        "g1": (-7, "highly frustrated"), "g2": (-2, "low frustrated"), "g3": (None, "unknown"), "g4": (None, "unknown"), "g5": (0, "neutral")
    }


def test_intent_and_reasons(visits, dictionary):
    intents = {r.customernumber: (r.intent, r.matches) for r in customer_intent(visits, dictionary).collect()}
    assert intents == {"g1": ("complaint", 1), "g2": ("marketing", 4), "g5": ("logistic", 1)}
    reasons = sorted((r.comp_cust, r.orddesc, r.customers, r.rnk) for r in contact_reasons(visits, dictionary, n=1).collect())
    assert reasons == [("comp", "parcel", 1, 1), ("cust", "again; what", 1, 1)]


def test_sides_and_satisfaction(visits, dictionary):
    sides = {r.customernumber: (r.positive, r.negative) for r in severity_indicator(visits, dictionary).collect()}
    assert sides == {"g1": (0, 7), "g2": (4, 6), "g5": (0, 0)}
    index = {r.customernumber: r.satisfaction for r in satisfaction_index(visits, dictionary).collect()}
    assert index == {"g1": -7, "g2": -2, "g5": 0}


@pytest.mark.parametrize("size", [0, 1, 2, 3])
def test_pieces_are_cut_from_the_text_itself(spark, size):
    """Every run once, over line breaks and characters outside the first plane; no array of single characters is made."""
    bodies = ["", "a", "ab", "abcabcab", "a\nb\r\nc\u2028d", "😀b😀b😀", "ünï\x00 ", "xxxxxxx"]
    cut = staged_texts(spark, bodies).select("text", keywords._pieces_of("body", size).alias("pieces"))
    for row in cut.collect():
        body = bodies[row.text]
        wanted = {body[i : i + size] for i in range(len(body) - size + 1)}
        assert sorted(row.pieces) == sorted(wanted)
    assert "lambda" not in cut._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("few", [0, 50])
def test_few_and_many_pieces_give_the_same_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(keywords, "FEW_PIECES", few)
    bodies = ["", "a", "ab", "a\nbc", "😀b cd", "xabcx", "abcd abcd"]
    words = ["", "%", "a_b", "abc", "abcd", "😀b", "\nbc", "zzz", "cd"]
    v = spark.createDataFrame([(str(i), body) for i, body in enumerate(bodies)], "customernumber string, comments string")
    d = spark.createDataFrame([(i, word, "c", 1, "x") for i, word in enumerate(words)], DICTIONARY_SCHEMA)
    wanted = sorted((str(i), k) for i, body in enumerate(bodies) for k, word in enumerate(words) if like(body, word))
    assert sorted((r.customernumber, r.rid) for r in match_keywords(v, d, small_entries=1).collect()) == wanted


def without_joins(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return not any(x in plan for x in ("Join", "Exchange", "Cartesian", "Python")) and plan.count("regexp_extract_all") == 1


def test_a_large_dictionary_neither_shuffles_nor_stages_texts(monkeypatch, visits, dictionary):
    """Disk holds the dictionary only, and texts are gone through once."""
    staged = []
    monkeypatch.setattr(keywords, "stage", lambda df, label, stage=keywords.stage: (staged.append(label), stage(df, label))[1])
    assert without_joins(match_keywords(visits, dictionary, small_entries=2))
    wild = dictionary.withColumn("orddesc", F.concat("orddesc", F.lit("%")))
    assert without_joins(match_keywords(visits, wild, small_entries=2))
    assert set(staged) == {"keywords", "keyword-table", "keyword-rows"}


BODIES = ["", "a", "abcabcab", "xaabbab", "a\nbc", "😀b cd", "caféé ñ", "x^$.|?*+()[]{}\\-", "中文字 中", "the then theme", "\x00q", None]
KEYS = ["", "a", "ab", "abc", "abcab", "abcabcab", "bb", "b", "bc", "\nb", "😀", "😀b", "é", "éé", "ñ", "^$", ".|", "?*", "+(", ")[", "]{", "}\\-", "-"]
KEYS += ["中", "文字", "字 中", "the", "then", "them", "theme", "th", "\x00", "zz", "ab", "d", "c", "f", " ", "%", "a%c", "_b", "a_c%", "%%", "t_e%m", "中%中", "�"]


@pytest.mark.parametrize("limits", [{}, {"LEAF": 1, "RANGE": 2}, {"LEAF": 1, "RANGE": 1, "DEPTH": 2}, {"DEPTH": 0}, {"TRIE_BYTES": 0}])
@pytest.mark.parametrize("literal", [True, False])
def test_overlapping_and_nested_keywords(spark, monkeypatch, limits, literal):
    """Every keyword of a place is found, also where a longer one begins; as by pieces, for dictionaries beyond the limit."""
    for name, value in limits.items():
        monkeypatch.setattr(keywords, name, value)
    v = spark.createDataFrame([(str(i), body) for i, body in enumerate(BODIES)], "customernumber string, comments string")
    d = spark.createDataFrame([(i, word, "c", 1, "x") for i, word in enumerate([*KEYS, None])], DICTIONARY_SCHEMA)
    hit = (lambda body, word: word in body) if literal else like
    wanted = sorted((str(i), k) for i, body in enumerate(BODIES) if body is not None for k, word in enumerate(KEYS) if hit(body, word))
    out = match_keywords(v, d, literal=literal, small_entries=1)
    assert sorted((r.customernumber, r.rid) for r in out.collect()) == wanted


def test_broken_bytes_in_keywords_and_texts(spark):
    """A byte that is no character stands for itself only, in both ways."""
    v = spark.createDataFrame([(1, b"a\xc3b"), (2, "aéb".encode()), (3, b"a\xffb"), (4, "a�b".encode())], "id int, t binary")
    d = spark.createDataFrame([(1, b"\xc3b"), (2, b"\xff"), (3, b"b"), (4, "�".encode())], "rid int, w binary")
    v, d = v.withColumn("t", F.expr("CAST(t AS STRING)")), d.withColumn("w", F.expr("CAST(w AS STRING)"))
    ways = [sorted((r.id, r.rid) for r in match_keywords(v, d, "t", "w", literal=True, small_entries=n).select("id", "rid").collect()) for n in (9, 1)]
    assert ways[0] == ways[1]
