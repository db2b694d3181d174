"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a condition over measures of a text. The cost of a rule is timed on a
sample, and the sample's rows tell which rules fail together; the rule that rejects most
of what is still alive per second goes first. A document is measured only until a rule
rejects it. The order decides the work, never the verdict, so the sample's size (a
parameter) doesn't show in the result.

Defined cases: a NULL text counts as empty, has no words and fails; an empty table gives
an empty result; repeated rows are judged each on its own; other columns of the input
pass through untouched, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.workspace import stage

WHITE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Rejects a document when ``fails`` holds for its measures."""

    name: str
    fails: Callable[[dict[str, Column]], Column]


#: The two rules every caller agrees on, and those of the default set after them.
BASE_RULES = (
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_words", lambda m: m["n_repeat_words"] * 100 > m["n_words"] * 50),
)
MORE_RULES = (
    Rule("symbols", lambda m: m["n_symbols"] * 10 > m["n_words"]),
    Rule("word_length", lambda m: (m["word_chars"] < m["n_words"] * 2) | (m["word_chars"] > m["n_words"] * 15)),
    Rule("repeated_lines", lambda m: m["n_dup_lines"] * 2 > m["n_lines"]),
)
RULES = BASE_RULES + MORE_RULES


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once; a lambda would evaluate it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _word_array(text: Column) -> Column:
    return F.filter(F.split(text, WHITE + "+", -1), lambda w: w != "")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^" + WHITE[1:]))


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Distinct hashes prove distinct windows, so most texts stop there; the others sort
    their windows with the positions and compare neighbours.
    """
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    at = lambda i, k: F.get(words, i + k)
    hashes = F.transform(starts, lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2)))
    windows = F.transform(starts, lambda i: F.struct(F.concat_ws(" ", at(i, 0), at(i, 1), at(i, 2)).alias("w"), i.alias("i")))
    repeated = _let(
        F.sort_array(windows),
        lambda s: F.sort_array(
            F.transform(
                F.filter(
                    s,
                    lambda e, k: F.coalesce(e["w"] == F.get(s, k - 1)["w"], F.lit(False))
                    | F.coalesce(e["w"] == F.get(s, k + 1)["w"], F.lit(False)),
                ),
                lambda e: e["i"],
            )
        ),
    )
    covered = _let(
        repeated,
        lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        ),
    )
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).when(
        F.size(F.array_distinct(hashes)) == F.size(words) - 2, F.lit(0).cast("long")
    ).otherwise(covered)


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The measures of a non-null text, given its words; each is computed only where it is used."""
    lines = _lines(text)
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeat_words(words),
    }


def _with_words(docs: DataFrame, text_col: str) -> DataFrame:
    """``doc`` (the row), ``t`` and ``words``. The generator keeps the optimizer from copying the split into every use."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("doc"), text.alias("t"))
    return rows.select("doc", "t", F.inline(F.array(F.struct(_word_array(F.col("t")).alias("words")))))


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = 2000, seed: int = 7) -> list[Rule]:
    """The rules by what they reject of the documents still alive, per second, on about ``sample_rows`` rows."""
    texts = docs.select(F.col(text_col).cast("string").alias("t"))
    rows = texts.count()
    if not rows:
        return list(rules)
    sample = stage(texts.sample(min(1.0, sample_rows / rows), seed), "cascade-sample")
    seen = _with_words(sample, "t")
    found = measures(F.col("t"), F.col("words"))

    def seconds(condition: Column) -> float:
        start = time.perf_counter()
        seen.agg(F.count_if(condition)).collect()
        return time.perf_counter() - start

    seconds(F.size("words") < 0)
    idle = seconds(F.size("words") < 0)
    cost = {r.name: max(seconds(r.fails(found)) - idle, 1e-3) for r in rules}
    mask = F.lit(0)
    for k, rule in enumerate(rules):
        mask = mask + F.when(rule.fails(found), 1 << k).otherwise(0)
    alive = {row["mask"]: row["count"] for row in seen.groupBy(mask.alias("mask")).count().collect()}
    ordered, left = [], dict(enumerate(rules))
    while left:
        rejected = {k: sum(n for m, n in alive.items() if m >> k & 1) for k in left}
        best = max(left, key=lambda k: (rejected[k] / cost[left[k].name], -cost[left[k].name]))
        ordered.append(left.pop(best))
        alive = {m: n for m, n in alive.items() if not m >> best & 1}
    return ordered


def _rejects(ordered: Sequence[Rule], found: dict[str, Column]) -> Column:
    """True at the first rule that fails; later rules aren't evaluated."""
    verdict = F.lit(False)
    for rule in reversed(ordered):
        verdict = F.when(rule.fails(found), True).otherwise(verdict)
    return verdict


def keep_documents(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = 2000) -> DataFrame:
    """The documents that no rule rejects, with their columns as they are."""
    ordered = order_rules(docs, rules, text_col, sample_rows)
    seen = _with_words(docs, text_col)
    return seen.filter(~_rejects(ordered, measures(F.col("t"), F.col("words")))).select("doc.*")


def judge_documents(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 2000) -> DataFrame:
    """Every document's measures, whether a base rule rejects it, and the verdict of all ``rules``."""
    ordered = order_rules(docs, rules, text_col, sample_rows)
    seen = _with_words(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("x")), "x")
    found = [value.alias(name) for name, value in measures(F.col("t"), F.col("words")).items()]
    rows = seen.select(F.col("doc.id").alias(id_col), F.inline(F.array(F.struct(*found))))
    known = {name: F.col(name) for name in measures(F.col("t"), F.col("words"))}
    base = _rejects(BASE_RULES, known)
    return rows.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~_rejects(ordered, known))
