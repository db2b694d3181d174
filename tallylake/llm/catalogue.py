"""The dealt operators as queries over the provided tables."""

from __future__ import annotations

from tallylake.llm import attention_lm, decontaminate, language_id, minhash_join, mixing, quality_rules, simhash, suffix_dedup, token_alignment, token_counts, token_output, vector_codes, warc
from tallylake.llm.registry import QUERIES, SQL, query, table


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)


_TEXTS = "SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents"
_WORDS = r"list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

QUALITY_SQL = rf"""
WITH d AS ({_TEXTS}),
w AS (SELECT r, doc_id, t, {_WORDS} AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, i, concat(words[i], ' ', words[i + 1], ' ', words[i + 2]) AS gram
      FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN rep USING (r)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT *, NOT base_failed AND NOT (10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
       OR 2 * n_dup_lines > n_lines) AS kept FROM b
"""

_RUNS = r"list_filter(string_split_regex(lower_ascii, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii"

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_LOWER} FROM documents),
dw AS (SELECT r, doc_id, {_RUNS} AS words FROM d),
b AS (SELECT item_id::VARCHAR AS item, {_LOWER} FROM benchmark),
bw AS (SELECT item, words, least(13, len(words)) AS size FROM (SELECT item, {_RUNS} AS words FROM b) WHERE len(words) > 0),
win AS (SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS gram
        FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM bw)),
sizes AS (SELECT DISTINCT size FROM win),
pos AS (SELECT r, size, i, array_to_string(words[i:i + size - 1], ' ') AS gram
        FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM dw, sizes WHERE len(words) >= size)),
found AS (SELECT r, i, size, item FROM pos JOIN win USING (size, gram)),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT r, i, size FROM found)) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(words) AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


@query("op10_quality_rules", QUALITY_SQL)
def op10(spark, sf_dir):
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"))


@query("op3_simhash_near_dedup")
def op3(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3, seed=42)


@query("op5_decontamination", DECONTAMINATION_SQL)
def op5(spark, sf_dir):
    return decontaminate.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=13)


@query("op7_token_output")
def op7(spark, sf_dir):
    return token_output.write_and_read(table(spark, sf_dir, "documents"), end_id=2)


# Weights, then the schedule of one period slot by slot, then every document's place.
MIXING_SQL = """
WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
tot AS (SELECT sum(n) AS total FROM c),
ranked AS (SELECT source, n, n >= 0.01 * total AS large, row_number() OVER (ORDER BY n >= 0.01 * total, n, source DESC NULLS LAST) AS up,
  sum(CASE WHEN n >= 0.01 * total THEN 0 ELSE n END) OVER () AS small, total FROM c, tot),
flagged AS (SELECT source, n, NOT large OR (small > 0 AND small < 0.01 * total AND up = 1 + (SELECT count(*) FROM c, tot WHERE n < 0.01 * total)) AS pooled FROM ranked),
g0 AS (SELECT CASE WHEN pooled THEN NULL ELSE source END AS source, pooled, sum(n)::BIGINT AS n FROM flagged GROUP BY ALL),
g1 AS (SELECT *, row_number() OVER (ORDER BY pooled, source NULLS FIRST) AS k, n ** 0.7 AS w FROM g0),
g2 AS (SELECT *, round(w * 1000 / sum(w) OVER (), 9) AS share FROM g1),
g3 AS (SELECT *, floor(share)::BIGINT AS base, row_number() OVER (ORDER BY floor(share) - share, k) AS place,
  1000 - sum(floor(share)::BIGINT) OVER () AS spare FROM g2),
g AS (SELECT source, pooled, n, k, base + (place <= spare)::BIGINT AS units FROM g3),
u AS (SELECT list(units ORDER BY k) AS units, count(*) AS m FROM g),
s AS (SELECT 0 AS t, list_transform(units, lambda x: 0::BIGINT) AS nxt, NULL::BIGINT AS k FROM u
  UNION ALL
  SELECT t + 1, list_transform(nxt, lambda x, i: x + (i = best)::BIGINT), best
  FROM (SELECT t, nxt, list_min(list_transform(range(1, m + 1), lambda i: CASE WHEN nxt[i] < units[i] AND nxt[i] * 1000 < (t + 1) * units[i]
          THEN (((nxt[i] + 1) * 1000 + units[i] - 1) // units[i]) * 10000 + i END)) % 10000 AS best FROM s, u WHERE t < 1000)),
slots AS (SELECT k, t - 1 AS slot, row_number() OVER (PARTITION BY k ORDER BY t) - 1 AS i FROM s WHERE t > 0),
ends AS (SELECT min(((n + 7) // 8) // units * 1000 + slot) AS stop FROM g JOIN slots ON slots.k = g.k AND i = ((n + 7) // 8) % units),
kept AS (SELECT k, 8 * sum(stop // 1000 + (slot < stop % 1000)::BIGINT) AS rows FROM slots, ends GROUP BY k),
d AS (SELECT doc_id, d.source, g.k, g.pooled, units, md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents d
  JOIN flagged f ON d.source IS NOT DISTINCT FROM f.source JOIN g ON (f.pooled AND g.pooled) OR (NOT f.pooled AND NOT g.pooled AND f.source IS NOT DISTINCT FROM g.source)),
nr AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY key, doc_id) - 1 AS nr FROM d),
cut AS (SELECT nr.k, key AS stop_key FROM nr JOIN kept ON kept.k = nr.k AND nr.nr = kept.rows),
b AS (SELECT *, nr // 8 AS block, (nr // 8) % units AS i, (nr // 8) // units * 1000 AS base FROM nr)
SELECT doc_id, source, pooled, block, base + i * 1000 // units AS release, base + ((i + 1) * 1000 + units - 1) // units AS deadline,
  (base + slot)::BIGINT AS slot, ((base + slot) * 8 + nr % 8)::BIGINT AS position, stop_key IS NULL OR key < stop_key AS kept
FROM b JOIN slots USING (k, i) LEFT JOIN cut USING (k)
"""


@query("op4_source_mixing", MIXING_SQL)
def op4(spark, sf_dir):
    return mixing.mix_order(table(spark, sf_dir, "documents"), power=0.7, block_rows=8)


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
r AS (SELECT page_id, h, CASE WHEN strlen(h) >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS whole FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN whole IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN whole IS NOT DISTINCT FROM page_id THEN NULL ELSE whole END AS refers_to
FROM r
"""


@query("op2_warc_index", WARC_SQL)
def op2(spark, sf_dir):
    return warc.write_and_read(table(spark, sf_dir, "pages"), shared_bytes=1000)


@query("op1_language_id")
def op1(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"), sample_docs=2000)


@query("op9_lm_scoring")
def op9(spark, sf_dir):
    return attention_lm.score(table(spark, sf_dir, "documents"))


@query("op8_token_counts")
def op8(spark, sf_dir):
    return token_counts.count_edited(table(spark, sf_dir, "documents"))


@query("op6_suffix_dedup")
def op6(spark, sf_dir):
    return suffix_dedup.judge_documents(table(spark, sf_dir, "documents"))


def _codes_sql(rounds: int) -> str:
    """Every round spelled out: nearest entries, then the means of their parts."""
    text = """
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, vec_id, part, v[part * (len(v) // 8) + 1 : (part + 1) * (len(v) // 8)] AS x FROM k, range(8) AS t(part)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS y
  FROM p WHERE r IN (SELECT r FROM k ORDER BY vec_id LIMIT 16))"""
    for i in range(rounds + 1):
        text += f""",
a{i} AS MATERIALIZED (SELECT r, part, any_value(x) AS x, min({{'d': d, 'entry': entry}}) AS best FROM (SELECT r, p.part, x, entry,
    list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM p JOIN c{i} USING (part)) GROUP BY r, part)"""
        if i < rounds:
            text += f""",
m{i} AS (SELECT part, best.entry AS entry, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS n FROM a{i}, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY ALL),
u{i} AS (SELECT part, entry, list((s - ((s % n + n) % n)) // n ORDER BY i) AS y FROM m{i} GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(u{i}.y, c{i}.y) AS y FROM c{i} LEFT JOIN u{i} USING (part, entry))"""
    return text + f""",
f AS (SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM k JOIN f USING (r), h
"""


@query("op11_vector_codes", _codes_sql(6))
def op11(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)


@query("op12_token_alignment")
def op12(spark, sf_dir):
    return token_alignment.align_digests(table(spark, sf_dir, "documents"))


@query("op13_minhash_near_dedup")
def op13(spark, sf_dir):
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
