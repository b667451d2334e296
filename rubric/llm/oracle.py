"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from rubric.llm import mixing, quality
from rubric.llm.url_filter import URL_FILTER_SQL

WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
LINES = "list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]'))"

QUALITY_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, text, {WORDS} AS w, {LINES} AS lines FROM documents),
grams AS (SELECT id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT id, i, count(*) OVER (PARTITION BY id, a, b, c) AS n FROM grams),
covered AS (SELECT id, count(DISTINCT i + k) AS n FROM (SELECT id, i, unnest([0, 1, 2]) AS k FROM twice WHERE n > 1) GROUP BY id),
f AS (SELECT d.id, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
             len(lines) AS n_lines, len(regexp_extract_all(coalesce(text, ''), '\\p{{Lu}}')) AS n_upper
      FROM d LEFT JOIN covered USING (id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words
            OR n_symbols * 100 > n_words * {quality.MAX_SYMBOLS_PER_100_WORDS}
            OR word_chars < n_words * {quality.MIN_WORD_CHARS} OR word_chars > n_words * {quality.MAX_WORD_CHARS}
            OR n_dup_lines * 100 > n_lines * {quality.MAX_DUP_LINE_PERCENT}
            OR n_upper * 100 > word_chars * {quality.MAX_UPPER_PERCENT}) AS kept
FROM f
"""

_EPOCHS = f"{mixing.MAX_EPOCHS}::DOUBLE"

MIX_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, source, len({WORDS})::BIGINT AS size, len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS symbols,
         (('0x' || substr(md5('{mixing.SEED}' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / {2 ** 52}::DOUBLE AS unit
  FROM documents),
k AS (SELECT id, doc_id, source, size, -ln(unit) / (1.0::DOUBLE / (1.0::DOUBLE + symbols::DOUBLE / greatest(size, 1)::DOUBLE)) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, ({mixing.WEIGHTS})[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}) + 1] AS w FROM s),
l AS (SELECT *, {_EPOCHS} * source_size / w AS level FROM w),
f AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size) OVER (ORDER BY level, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {mixing.MAX_EPOCHS})::DOUBLE
                / sum(w) OVER (ORDER BY level, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fill FROM l),
t AS (SELECT source, source_size, w, least({_EPOCHS} * source_size,
               coalesce((SELECT arg_min(fill, level) FROM f WHERE fill <= level), 0) * w) AS target FROM f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), {mixing.MAX_EPOCHS}) ELSE 0 END::BIGINT AS epochs FROM t),
b AS (SELECT *, target - epochs * source_size AS budget FROM p),
r AS (SELECT k.*, b.source_size, b.target, b.epochs, b.budget, sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id) AS upto
      FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source),
g AS (SELECT source, any_value(budget) - coalesce(max(upto) FILTER (WHERE upto <= budget), 0) AS gap FROM r GROUP BY source),
m AS (SELECT r.source, arg_min(r.id, (abs(size - gap), key, doc_id)) AS edge FROM r JOIN g ON r.source IS NOT DISTINCT FROM g.source
      WHERE upto > budget AND abs(size - gap) < gap GROUP BY r.source)
SELECT r.doc_id, size, source_size, target, (size * (epochs + CASE WHEN upto <= budget OR id IS NOT DISTINCT FROM edge THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r LEFT JOIN m ON r.source IS NOT DISTINCT FROM m.source
"""

ORACLE_SQL: dict[str, str] = {"op1_quality_rules": QUALITY_SQL, "op10_source_mix": MIX_SQL, "op12_url_filter": URL_FILTER_SQL}
