"""Matching free text against a keyword dictionary.

A match is ``text LIKE '%keyword%'``: case-sensitive, ``%`` and ``_`` inside a keyword act as
wildcards, a backslash is a plain character. With ``literal`` nothing is a wildcard. Each
(text row, dictionary row) pair counts once, however often the keyword occurs; a text
without any match, or a NULL text, yields nothing.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from functools import reduce
from itertools import takewhile
from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.workspace import stage

SMALL_ENTRIES = 1_000
SMALL_BYTES = 1_000_000
#: Bytes of a dictionary's rows, as JSON, that every task can well hold as a pattern and a table.
TRIE_BYTES = 12_000_000
#: Words that a branch of the pattern lists instead of dividing them by their next character.
LEAF = 6
#: How often the pattern's words are divided at most.
DEPTH = 32
#: Characters that a branch tries one after the other; further ones are tried by ranges of as many.
RANGE = 8
#: Characters of the pieces by which dictionaries beyond that are looked up.
PIECE = 3
#: Texts from which on a piece alone is no key, and a second piece of the keyword must be there too.
FREQUENT = 100
#: Pieces up to which each is looked for in every text, instead of cutting the texts.
FEW_PIECES = 50
#: Texts of one piece that one group of the join holds.
HOT = 100_000


def match_keywords(
    texts: DataFrame,
    dictionary: DataFrame,
    text: str = "comments",
    keyword: str = "orddesc",
    literal: bool = False,
    small_entries: int = SMALL_ENTRIES,
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """Every text row beside every dictionary row whose keyword it contains.

    The dictionary's size is probed first (at most ``small_entries`` + 1 rows are read). One
    within both limits becomes a single array value, tested row by row without any join or
    shuffle. A larger one of up to ``TRIE_BYTES`` becomes a pattern by which each text is gone through once (see
    ``_match_by_trie``): no text or pair is shuffled or staged. Any other is joined with the texts on each keyword's rarest
    piece (see ``candidate_pairs``), and the pairs found are tested in full. The result is the same.
    """
    shared = set(texts.columns) & set(dictionary.columns)
    if shared:
        raise ValueError(f"texts and dictionary share the columns {sorted(shared)}")
    probe = dictionary.limit(small_entries + 1).agg(
        F.count("*").alias("entries"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")
    )
    size = probe.first()
    if size["entries"] <= small_entries and (size["bytes"] or 0) <= small_bytes:
        return _match_in_row(texts, dictionary, text, keyword, literal)
    # Numbered and written, since the numbers must be the same in all uses; columns stay in a struct, apart from them.
    entries = dictionary.filter(F.col(keyword).isNotNull()).select(F.monotonically_increasing_id().alias("entry"), F.struct("*").alias("row"))
    entries = stage(entries, "keywords")
    held = entries.agg(F.sum(F.octet_length(F.to_json("row")))).first()[0]
    if held is None:
        return texts.limit(0).crossJoin(dictionary.limit(0))
    if held <= TRIE_BYTES:
        return _match_by_trie(texts, entries, text, keyword, literal)
    return _match_by_piece(texts, entries, text, keyword, literal)


def contained(text: Column, keyword: Column, literal: bool = False) -> Column:
    """Whether the text holds the keyword; patterns are only built for keywords with a wildcard."""
    plain = F.contains(text, keyword)
    if literal:
        return plain
    escaped = F.replace(keyword, F.lit("\\"), F.lit("\\\\"))
    return F.when(keyword.rlike("[%_]"), F.like(text, F.concat(F.lit("%"), escaped, F.lit("%")))).otherwise(plain)


def _match_in_row(texts, dictionary, text, keyword, literal):
    entries = dictionary.agg(F.collect_list(F.struct(*dictionary.columns))).scalar()
    return (
        texts.withColumn("_entries", entries)
        .withColumn("_hit", F.explode(F.filter("_entries", lambda entry: contained(F.col(text), entry[keyword], literal))))
        .select(*texts.columns, "_hit.*")
    )


def _match_by_trie(texts, entries, text, keyword, literal):
    """Every keyword has a key that its texts must hold: itself, or its longest run between wildcards.

    A pattern of all keys finds the longest one at every place of a text (see ``_longest_key``). Other keys of the place are
    beginnings of that one, and listed with it in a table whose slots are numbers of ``crc32``; so a text is gone
    through once, however many keywords there are. A keyword that is its own key is found thereby, any other is tested where its key is. One
    without a key, or with a character that may stand for broken bytes, is tested in all texts.
    """
    words = [row[0] for row in entries.orderBy("entry").select(f"row.`{keyword}`").collect()]
    owners, always, tests = defaultdict(list), [], []
    for number, word in enumerate(words):
        runs = [word] if literal else word.replace("_", "%").split("%")
        key = max(runs, key=len)
        if not key or "\ufffd" in key:
            always.append(number)
        else:
            owners[key].append(number)
        broken = "\ufffd" in word
        tests.append([run for run in {*runs} - {key, ""} if not broken] if broken or key != word else None)
    slots = [[] for _ in range(2 * len(owners) + 1)]
    sizes = sorted(set(map(len, owners)))
    for key in owners:
        begun = [number for size in takewhile(len(key).__ge__, sizes) for number in owners.get(key[:size], ())]
        slots[zlib.crc32(key.encode()) % len(slots)].append((key, begun))
    kinds = "pattern string, slots array<array<struct<key: string, numbers: array<int>>>>, always array<int>, tests array<array<string>>"
    table = stage(texts.sparkSession.createDataFrame([(_longest_key(owners), slots, always, tests)], kinds), "keyword-table")
    numbered = F.array_sort(F.collect_list(F.struct("entry", "row")), lambda a, b: F.signum(a["entry"] - b["entry"]).cast("int"))
    rows = stage(entries.agg(F.transform(numbered, lambda entry: entry["row"]).alias("rows")), "keyword-rows")

    # Each value of the table is used in one place, so that projections are merged and no row is written with it.
    own = [f"column {k}" for k in range(len(texts.columns))]
    found = texts.select("*", F.col(text)).toDF(*own, "body").filter("body IS NOT NULL")
    found = found.withColumn("keys", F.array_distinct(F.regexp_extract_all("body", table.select("pattern").scalar(), F.lit(1))))
    found = found.withColumn("slots", table.select("slots").scalar())
    slot = lambda key: F.get("slots", F.pmod(F.crc32(key.cast("binary")), F.lit(len(slots))).cast("int"))
    begun = lambda key: F.flatten(F.transform(F.filter(slot(key), lambda held: held["key"] == key), lambda held: held["numbers"]))
    found = found.select(*own, "body", F.array_distinct(F.flatten(F.transform("keys", begun))).alias("numbers"))
    if always:
        found = found.withColumn("always", table.select("always").scalar()).withColumn("numbers", F.concat("numbers", "always"))
    if any(test is not None for test in tests):
        found = found.withColumn("tests", table.select("tests").scalar()).withColumn("words", rows.select(f"rows.`{keyword}`").scalar())
        entry = lambda number: F.struct(number.alias("number"), F.get("tests", number).alias("runs"), F.get("words", number).alias("word"))
        runs = lambda one: F.forall(one["runs"], lambda run: F.contains(F.col("body"), run))  # cheaper than LIKE
        test = lambda one: one["runs"].isNull() | (runs(one) & contained(F.col("body"), one["word"], literal))
        held = F.filter(F.transform("numbers", entry), test)
        found = found.select(*own, F.transform(held, lambda one: one["number"]).alias("numbers"))
    # Not explode: Spark would filter the texts by all the above first, and so work it out several times.
    hits = found.select(*own, F.explode_outer("numbers").alias("number")).filter("number IS NOT NULL")
    hits = hits.select(*own, F.get(rows.scalar(), "number").alias("row"))
    return hits.select(*[F.col(k).alias(name) for k, name in zip(own, texts.columns)], "row.*")


def _longest_key(keys) -> str:
    """A pattern whose first group is the longest of the keys at every place where one begins.

    The keys are a trie: what several begin with stands once, and they are divided by the next character, so a place is
    compared with few of them. The group is looked ahead for, so that keys may overlap.
    """
    return f"(?=({_branch(list(keys), DEPTH)}))" if keys else "(?!)()"


def _branch(words: list[str], depth: int) -> str:
    """What matches the longest of the words; they are divided ``depth`` times at most, by which Java's stack is bounded."""
    shared = commonprefix(words)
    if shared and len(words) > 1:
        return f"{_escaped(shared)}(?:{_branch([word[len(shared) :] for word in words], depth - 1)})"
    if len(words) <= LEAF or depth <= 0:
        return "|".join(map(_escaped, sorted(words, key=len, reverse=True)))
    by = defaultdict(list)
    for word in words:
        by[word[:1]].append(word)
    ended = by.pop("", [])
    order = sorted(by, key=lambda first: len(by[first]), reverse=True)
    ways = [_branch(by[first], depth - 1) for first in order[:RANGE]]
    others = sorted(order[RANGE:])
    for k in range(0, len(others), RANGE):
        some = others[k : k + RANGE]
        inner = "|".join(_branch(by[first], depth - 1) for first in some)
        ways.append(f"(?=[{_escaped(some[0])}-{_escaped(some[-1])}])(?:{inner})")
    if len(order) >= LEAF:
        # Most places have none of these characters. Java keeps those up to U+00FF in one bitmap, but asks for others one by one.
        narrow = "".join(_escaped(first) for first in sorted(by) if first < "\u0100")
        wide = "\\x{100}-\\x{10ffff}" if max(by) >= "\u0100" else ""
        return f"(?=[{narrow}{wide}])(?:{'|'.join(ways)})" + "|" * len(ended)
    return "|".join(ways + ended)


def _escaped(word: str) -> str:
    return "".join(c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):x}}}" for c in word)


def _keyword_pieces(keyword: Column, literal: bool) -> Column:
    """What every text that matches must hold: all runs of ``PIECE`` characters between wildcards, or the longest shorter one."""
    runs = F.array(keyword) if literal else F.split(keyword, "[%_]", -1)
    starts = lambda run: F.sequence(F.lit(1), F.greatest(F.length(run) - PIECE + 1, F.lit(1)))
    cut = F.flatten(F.transform(runs, lambda run: F.transform(starts(run), lambda i: run.substr(i, F.lit(PIECE)))))
    whole = F.filter(cut, lambda piece: F.length(piece) == PIECE)
    longest = F.array_max(F.transform(runs, lambda run: F.struct(F.length(run).alias("size"), run.alias("run"))))["run"]
    return F.when(F.size(whole) > 0, F.array_distinct(whole)).otherwise(F.array(longest))


def _pieces_of(body: str, size: int) -> Column:
    """All runs of ``size`` characters of a text, each once: the text is cut into runs from each of its first places on."""
    if size == 0:
        return F.array(F.lit(""))
    cuts = [F.regexp_extract_all(F.col(body).substr(F.lit(i + 1), F.length(body)), F.lit(f"(?s).{{{size}}}"), F.lit(0)) for i in range(size)]
    return F.array_distinct(F.concat(*cuts))


def _match_by_piece(texts, entries, text, keyword, literal):
    numbered = texts.filter(F.col(text).isNotNull()).select(F.monotonically_increasing_id().alias("text"), F.struct("*").alias("of"))
    numbered = stage(numbered, "texts")
    words = entries.select("entry", _keyword_pieces(F.col(f"row.`{keyword}`"), literal).alias("pieces"))
    pairs = candidate_pairs(numbered.select("text", F.col(f"of.`{text}`").alias("body")), words)
    matched = numbered.join(pairs, "text").join(entries, "entry")
    held = contained(F.col(f"of.`{text}`"), F.col(f"row.`{keyword}`"), literal)
    return matched.filter(held).select("of.*", "row.*")


def candidate_pairs(texts: DataFrame, words: DataFrame) -> DataFrame | None:
    """``text`` and ``entry`` of the pairs worth testing; None without any words.

    ``texts`` holds numbers and bodies, ``words`` the entries' numbers and ``pieces``, which a matching body must all
    hold. Pieces that no word has are dropped at once, and the texts of each other piece are counted. A word is looked up by
    its rarest piece, so a common beginning costs nothing; one that no text holds is done with. Where even that
    piece is ``FREQUENT``, the second rarest must be in the text as well. The texts of a piece that very many
    have are spread over several groups of the join.
    """
    wanted = stage(words.select("entry", F.explode("pieces").alias("piece")), "keyword-pieces")
    sizes = [row[0] for row in wanted.select(F.length("piece")).distinct().collect()]  # 0 to PIECE
    if not sizes:
        return None
    known = [row[0] for row in wanted.select("piece").distinct().limit(FEW_PIECES + 1).collect()]
    if len(known) <= FEW_PIECES:
        held = F.array(*[F.when(F.contains(F.col("body"), F.lit(piece)), F.lit(piece)) for piece in known])
        found = texts.select("text", F.explode(F.array_compact(held)).alias("piece"))
    else:
        cut = [texts.select("text", F.explode(_pieces_of("body", size)).alias("piece")) for size in sizes]
        found = reduce(DataFrame.unionAll, cut)
    found = stage(found.join(wanted.select("piece").distinct(), "piece", "left_semi"), "found-pieces")
    counts = stage(found.groupBy("piece").agg(F.count("*").alias("texts")), "piece-counts")
    ranked = wanted.join(counts, "piece", "left").groupBy("entry")
    ranked = ranked.agg(F.array_sort(F.collect_list(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "piece"))).alias("rarest"))
    keys = ranked.select(
        "entry", F.col("rarest")[0]["piece"].alias("piece"), F.col("rarest")[0]["texts"].alias("texts"), F.get("rarest", F.lit(1))["piece"].alias("second")
    )
    keys = stage(keys.filter("texts > 0"), "keyword-keys")
    groups = F.ceil(F.col("texts") / HOT)
    hot = counts.filter(F.col("texts") > HOT).select("piece", groups.alias("groups"))
    one = F.lit(0).cast("long")
    spread = found.join(hot, "piece", "left").select("text", "piece", F.coalesce(F.pmod("text", "groups"), one).alias("salt"))
    pairs = spread.join(keys.withColumn("salt", F.explode(F.sequence(one, groups - 1))), ["piece", "salt"])
    frequent = F.col("second").isNotNull() & (F.col("texts") > FREQUENT)
    doubtful = pairs.filter(frequent).select("text", "entry", F.col("second").alias("piece"))
    sure = pairs.filter(~frequent).select("text", "entry")
    return sure.unionAll(doubtful.join(found, ["text", "piece"], "left_semi").select("text", "entry"))


def severity_per_customer(matches: DataFrame, customer: str, severity: str = "severity") -> DataFrame:
    """Sum of the matched severities; summed map-side before the shuffle."""
    return matches.groupBy(customer).agg(F.sum(severity).alias("total_severity"))
