"""DuckDB SQL for the correctness oracle (same semantics as the Spark plans).

The driver runs these strings on DuckDB over the same parquet tables; they
are written independently of the Spark code (RE2 regexes, 1-based lambdas).
DuckDB's ``levenshtein`` counts bytes, so edit distances map each distinct
symbol of a pair to a one-byte character first (exact while a pair has at
most 127 distinct characters, which holds for the checked tables).
"""

from __future__ import annotations

NON_WORD = r"[^\pL\pN_\s]"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def normalize_answer(x: str) -> str:
    t = trim(f"coalesce({x}, '')")
    t = f"regexp_replace({t}, '{NON_WORD}', ' ', 'g')"
    t = f"regexp_replace({t}, '\\s+', ' ', 'g')"
    return f"lower({trim(t)})"


COLON = r"^([^:]+):\s*(\S+)"
PREFIX_WORDS = "answer|response|result|choice|option|الإجابة|الجواب"


def first_word_or_line_cte(src: str, col: str, out: str, keys: str) -> str:
    """SQL select computing T1 of ``col`` into ``out`` (two nested steps)."""
    text = trim(f"coalesce({col}, '')")
    return f"""
    SELECT {keys}, {out}_text, {out}_line,
      CASE WHEN {out}_text = '' THEN ''
           WHEN regexp_matches({out}_line, '{COLON}')
                AND regexp_matches(lower({trim(f"regexp_extract({out}_line, '{COLON}', 1)")}), '{PREFIX_WORDS}')
             THEN {trim(f"regexp_replace({trim(f"regexp_extract({out}_line, '{COLON}', 2)")}, '{NON_WORD}', '', 'g')")}
           WHEN len(list_filter(regexp_split_to_array({trim(f'{out}_line')}, '\\s+'), lambda w: w <> '')) <= 3 THEN {out}_line
           ELSE {trim(f"regexp_replace(list_filter(regexp_split_to_array({trim(f'{out}_line')}, '\\s+'), lambda w: w <> '')[1], '{NON_WORD}', '', 'g')")}
      END AS {out}
    FROM (SELECT *, regexp_replace({trim(f"split_part({out}_text, chr(10), 1)")}, '{NON_WORD}+$', '') AS {out}_line
          FROM (SELECT *, {text} AS {out}_text FROM {src}))"""


def asr_text(x: str) -> str:
    """T5 for plain-text answers: JSON object text / JSON string / quote strip."""
    p = trim(f"coalesce({x}, '')")
    return f"""(CASE
      WHEN json_valid({p}) AND json_type({p}::JSON) = 'OBJECT' AND json_type({p}::JSON, '$.text') = 'VARCHAR'
        THEN json_extract_string({p}::JSON, '$.text')
      WHEN json_valid({p}) AND json_type({p}::JSON) = 'VARCHAR' THEN json_extract_string({p}::JSON, '$')
      WHEN starts_with({p}, '"') AND ends_with({p}, '"') AND length({p}) >= 2 THEN substr({p}, 2, length({p}) - 2)
      WHEN starts_with({p}, '''') AND ends_with({p}, '''') AND length({p}) >= 2 THEN substr({p}, 2, length({p}) - 2)
      ELSE {p} END)"""


def char_alphabet(a: str, b: str) -> str:
    """Distinct characters of a pair (compute once per row, then encode)."""
    return f"list_distinct(string_split({a}, '') || string_split({b}, ''))"


def char_levenshtein(a: str, b: str, alphabet: str) -> str:
    """Code-point edit distance via a per-pair one-byte alphabet column."""
    enc = lambda s: (f"array_to_string(list_transform(string_split({s}, ''), "
                     f"lambda ch: chr(list_position({alphabet}, ch)::INTEGER)), '')")
    return f"levenshtein({enc(a)}, {enc(b)})"


def word_levenshtein(a: str, b: str) -> str:
    """Word edit distance over word lists ``a`` and ``b``.  Words only in one
    side are never compared with each other, so they share one symbol per side;
    shared words get their own symbol (exact up to 125 shared words)."""
    shared = f"list_intersect(list_distinct({a}), list_distinct({b}))"
    code = (lambda lst, other_sym: f"array_to_string(list_transform({lst}, lambda w: "
            f"CASE WHEN list_position({shared}, w) IS NULL THEN chr({other_sym}) "
            f"ELSE chr((list_position({shared}, w) + 2)::INTEGER) END), '')")
    return f"levenshtein({code(a, 1)}, {code(b, 2)})"


def conversation_items_sql() -> str:
    return """
    SELECT q.conv_id, q.turn, q.text AS question,
           replace(a.text, chr(10), '\\n') AS gold, a.text AS answer_raw,
           't' || (q.conv_id % 8)::VARCHAR AS task, 'c' || (q.conv_id % 4)::VARCHAR AS category
    FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
    WHERE q.role = 'user' AND a.role = 'assistant'"""


def conversation_pairs_sql() -> str:
    return f"""
    SELECT 'm' || k::VARCHAR AS model, conv_id, turn, question, gold, task, category,
           array_to_string(list_filter(string_split(answer_raw, ' '), lambda w, i: (i - 1) % (k + 3) <> 2), ' ') AS response
    FROM (SELECT *, unnest([0, 1, 2]) AS k FROM ({conversation_items_sql()}))"""


PUNCT = "[\\pP`÷×<>^~¦+|ـ]"


def space_punct(x: str, braces: bool = False, diacritics: bool = False) -> str:
    """Pad punctuation (minus backslash, which is parked on chr(1)) with spaces."""
    t = f"replace(coalesce({x}, ''), '\\', chr(1))"
    t = f"regexp_replace({t}, '({PUNCT})', ' \\1 ', 'g')"
    t = f"replace({t}, chr(1), '\\')"
    if braces:
        t = f"translate({t}, '{{}}', '[]')"
    if diacritics:
        t = f"regexp_replace({t}, '[\\x{{064B}}-\\x{{0652}}]', '', 'g')"
    return t


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({trim(x)}, '\\s+'), lambda w: w <> '')"


def ngram_list(t: str, n: int) -> str:
    return f"list_transform(range(1, len({t}) - {n} + 2), lambda i: array_to_string({t}[i:i + {n} - 1], ' '))"


def ngram_matches_sql(src: str, keys: list[str], max_n: int) -> str:
    """Rows (keys..., m1..m{max_n}) of clipped n-gram matches between the token
    lists ``rt`` and ``pt`` of ``src`` (pairs without matches get 0)."""
    k = ", ".join(keys)
    sides = []
    for n in range(1, max_n + 1):
        sides.append(f"SELECT {k}, {n} AS n, unnest({ngram_list('rt', n)}) AS g, 1 AS r FROM {src}")
        sides.append(f"SELECT {k}, {n} AS n, unnest({ngram_list('pt', n)}) AS g, 0 AS r FROM {src}")
    grams = " UNION ALL ".join(sides)
    per = f"""SELECT {k}, n, sum(least(cr, cp)) AS matches FROM (
        SELECT {k}, n, g, sum(r) AS cr, sum(1 - r) AS cp FROM ({grams}) GROUP BY {k}, n, g)
      GROUP BY {k}, n"""
    cols = ", ".join(f"coalesce(sum(CASE WHEN x.n = {n} THEN x.matches END), 0) AS m{n}" for n in range(1, max_n + 1))
    on = " AND ".join(f"s.{c} IS NOT DISTINCT FROM x.{c}" for c in keys)
    sk = ", ".join(f"s.{c}" for c in keys)
    return f"SELECT {sk}, {cols} FROM {src} s LEFT JOIN ({per}) x ON {on} GROUP BY {sk}"


def f1(m: str, nr: str, np_: str) -> str:
    p = f"({m} / greatest({np_}, 1))"
    r = f"({m} / greatest({nr}, 1))"
    return f"(CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END)"


def bleu_from(m: list[str], lr: str, lp: str) -> str:
    precs = [f"(CASE WHEN {lp} - {n} + 1 > 0 THEN {m[n - 1]} / ({lp} - {n} + 1) ELSE 0.0 END)" for n in range(1, 5)]
    geo = (f"(CASE WHEN least({', '.join(precs)}) > 0 THEN exp(({' + '.join(f'ln({p})' for p in precs)}) / 4) "
           f"ELSE 0.0 END)")
    bp = f"(CASE WHEN {lp} > {lr} THEN 1.0 ELSE exp(1 - {lr} / {lp}) END)"
    return f"({geo} * {bp})"


def passage_pairs_sql() -> str:
    return """
    SELECT b.item_id, d.doc_id, d.source, d.lang, b.text AS passage, d.text AS document
    FROM benchmark b JOIN documents d ON contains(d.text, b.text)"""


def judge_attempts_sql(mcq: bool = False, judges: tuple[str, ...] = ("j1", "j2")) -> str:
    """Raw judge replies per (sample, judge, attempt); mirrors the Spark fixture."""
    s1 = "quality" if mcq else "(quality + 2 * toxic)"
    s2 = "(1 - toxic)" if mcq else "(3 * quality)"

    def verdict(score: str, who: str) -> str:
        return (f"""('{{"score": ' || {score}::VARCHAR || ', "explanation": "{who} graded document ' """
                f"""|| doc_id::VARCHAR || '"}}')""")

    def fenced(v: str) -> str:
        return f"('```json' || chr(10) || {v} || chr(10) || '```')"

    broken = """'{"score": "unfinished'"""
    v1, v2 = verdict(s1, "j1"), verdict(s2, "j2")
    rows = {
        "j1": [f"CASE WHEN doc_id % 5 = 0 THEN {broken} ELSE {v1} END",
               f"CASE WHEN doc_id % 10 <> 0 THEN {fenced(v1)} ELSE 'I cannot grade this.' END",
               f"CASE WHEN doc_id % 10 <> 0 THEN {fenced(v1)} ELSE {broken} END"],
        "j2": [f"CASE WHEN doc_id % 3 <> 0 AND doc_id % 7 <> 0 THEN {v2} ELSE '' END",
               f"CASE WHEN doc_id % 7 <> 0 THEN {v2} ELSE 'no json here' END",
               f"CASE WHEN doc_id % 7 <> 0 THEN {v2} ELSE {broken} END"],
    }
    src = "(SELECT l.doc_id, l.quality, l.toxic, d.source FROM labels l JOIN documents d USING (doc_id))"
    parts = []
    for j in judges:
        for a, expr in enumerate(rows[j], start=1):
            parts.append(f"SELECT doc_id AS sample_id, source AS task, '{j}' AS judge, {a} AS attempt, {expr} AS raw FROM {src}")
    return " UNION ALL ".join(parts)


def judge_samples_sql(mcq: bool = False, judges: tuple[str, ...] = ("j1",), method: str = "mean") -> str:
    """Per-sample judge result: task, sample_id, score, raw_score, valid."""
    c = trim(f"replace(replace({trim('raw')}, '```json', ''), '```', '')")
    norm = ("greatest(0.0, least(1.0, raw_value))" if mcq else "round(raw_value / 3.0, 5)")
    agg = "median" if method == "median" else "avg"
    return f"""
    SELECT task, sample_id, {agg}(score) AS score, {agg}(raw_score) AS raw_score,
           count(raw_score) > 0 AS valid
    FROM (
      SELECT task, sample_id, judge,
             CASE WHEN raw_value IS NULL THEN 0.0 ELSE {norm} END AS score, raw_value AS raw_score
      FROM (
        SELECT task, sample_id, judge, arg_min(raw_value, attempt) FILTER (WHERE ok) AS raw_value
        FROM (
          SELECT task, sample_id, judge, attempt,
                 CASE WHEN json_valid(c) THEN json_type(c::JSON) = 'OBJECT' AND json_exists(c::JSON, '$.score')
                      AND json_exists(c::JSON, '$.explanation') ELSE false END AS ok,
                 CASE WHEN json_valid(c) THEN TRY_CAST(json_extract_string(c::JSON, '$.score') AS DOUBLE) END AS raw_value
          FROM (SELECT *, {c} AS c FROM ({judge_attempts_sql(mcq, judges)}) WHERE attempt <= 3))
        GROUP BY task, sample_id, judge))
    GROUP BY task, sample_id"""


def text(x: str) -> str:
    """A string literal."""
    return "'" + x.replace("'", "''") + "'"


def judge_requests_sql(mcq: bool = False) -> str:
    """model, task, prompt_key of the conversation samples that are judged."""
    from rubric.operators.judge import GENERATIVE_RUBRIC, MCQ_RUBRIC
    place = "(conv_id + turn)"
    words = "string_split(gold, ' ')"
    if mcq:
        samples = f"""SELECT model, task, conv_id, turn, question, chr(({place} % 4 + 65)::INTEGER) AS gold, {words}[1:4] AS mcq,
            CASE model WHEN 'm0' THEN lower(chr(({place} % 4 + 65)::INTEGER))
                       WHEN 'm1' THEN chr((({place} + 1) % 4 + 65)::INTEGER) || ') so it is' ELSE {words}[1] END AS response
          FROM ({conversation_pairs_sql()}) WHERE substr(task, 2)::INTEGER >= 4"""
        sides = f"{normalize_mcq('gold', 'mcq')} AS gold, {normalize_mcq('response', 'mcq')} AS response"
    else:
        samples = f"SELECT * FROM ({conversation_pairs_sql()}) WHERE substr(task, 2)::INTEGER <= 5"
        sides = "gold, response"
    rubric = text(MCQ_RUBRIC if mcq else GENERATIVE_RUBRIC)
    nl = "chr(10)"
    return f"""
    SELECT model, task, md5({rubric} || {nl} || {nl} || '[PROMPT]' || {nl} || question || {nl} || '[/PROMPT]' || {nl}
        || '[GROUND TRUTH]' || {nl} || gold || {nl} || '[/GROUND TRUTH]' || {nl}
        || '[GENERATED OUTPUT]' || {nl} || response || {nl} || '[/GENERATED OUTPUT]') AS prompt_key
    FROM (SELECT model, task, question, {sides} FROM ({samples}) WHERE {place} % 11 <> 0)
    WHERE gold <> '' AND response <> ''"""


def prompt_scores_sql(mcq: bool = False) -> str:
    """model, task, score, raw_score, valid of every judged sample."""
    value = "(h % 4 - 1)" if mcq else "(h % 5)"
    norm = f"greatest(0, least(1, {value}))::DOUBLE" if mcq else f"round({value} / 3.0, 5)"
    return f"""
    SELECT model, task, h % 10 <> 0 AND form NOT IN (0, 2) AS valid,
           CASE form WHEN 1 THEN 0.0 ELSE {norm} END AS score, CASE form WHEN 1 THEN 0.0 ELSE {value}::DOUBLE END AS raw_score
    FROM (SELECT *, (h // 5) % 9 AS form FROM (
      SELECT *, ('0x' || substr(prompt_key, 1, 4))::INTEGER AS h FROM ({judge_requests_sql(mcq)})))"""


def mcq_samples_sql() -> str:
    return """
    WITH opts AS (SELECT list(r_name ORDER BY r_regionkey) AS mcq FROM region),
    reg AS (SELECT r_regionkey, r_name, chr((row_number() OVER (ORDER BY r_regionkey) + 64)::INTEGER) AS gold_letter FROM region),
    nat AS (SELECT n.n_nationkey, n.n_name, reg.gold_letter, reg.r_name FROM nation n JOIN reg ON n.n_regionkey = reg.r_regionkey)
    SELECT c.c_custkey AS sample_id, 'In which region is ' || nat.n_name || '?' AS question, opts.mcq,
           nat.gold_letter AS gold,
           CASE c.c_custkey % 6 WHEN 0 THEN gold_letter WHEN 1 THEN lower(gold_letter)
                WHEN 2 THEN gold_letter || ') ' || r_name WHEN 3 THEN 'Answer: ' || r_name WHEN 4 THEN r_name
                ELSE opts.mcq[((ascii(gold_letter) - 65 + 1) % len(opts.mcq)) + 1] END AS response,
           'region_' || (nat.n_nationkey % 3)::VARCHAR AS task
    FROM customer c JOIN nat ON c.c_nationkey = nat.n_nationkey, opts"""


def option_for_letter(mcq: str, letter: str) -> str:
    idx = f"(ascii(upper({letter})) - 65)"
    return f"(CASE WHEN length({letter}) = 1 AND {idx} >= 0 AND {idx} < len({mcq}) THEN {mcq}[{idx} + 1] END)"


def normalize_mcq(x: str, mcq: str) -> str:
    s = trim(x)
    letter = f"regexp_extract({s}, '^([A-Za-z])\\)', 1)"
    return f"""(CASE WHEN {x} IS NULL THEN ''
      WHEN {mcq} IS NULL OR len({mcq}) = 0 THEN {x}
      WHEN length({s}) = 1 AND {option_for_letter(mcq, s)} IS NOT NULL THEN {option_for_letter(mcq, s)}
      WHEN {letter} <> '' AND {option_for_letter(mcq, letter)} IS NOT NULL THEN {option_for_letter(mcq, letter)}
      ELSE {s} END)"""


SIMPLE_SPLIT = '\\s+|[,.!?;:"()\\[\\]{}]'


def simple_token_count(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({x}, ''), '{SIMPLE_SPLIT}'), lambda t: t <> ''))"


def capitalize(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


# ---------------------------------------------------------------------------
# Sequence tables by recursion: one step a symbol of ``a``, all pairs at once
# ---------------------------------------------------------------------------

def _least_prefixes(name: str, src: str, keep: str) -> str:
    """CTEs ``{name}_at`` (places of each symbol of ``b``) and ``{name}_t`` (id, i, t):
    for each length, the least prefix of ``b`` that holds a common subsequence of that
    length with the first i symbols of ``a``; a symbol moves each entry to its next
    place in ``b`` after the entry before, if that is nearer."""
    far = 1 << 30
    return f"""
{name}_at AS MATERIALIZED (
  SELECT id, token, list(j ORDER BY j) AS js FROM (SELECT id, unnest(b) AS token, generate_subscripts(b, 1) AS j FROM {src}) GROUP BY ALL),
{name}_t(id, i, t) {keep} (
  SELECT id, 0, [0] FROM {src}
  {'UNION' if 'KEY' in keep else 'UNION ALL'}
  SELECT x.id, x.i + 1, CASE WHEN q.js IS NULL THEN x.t ELSE list_filter(list_transform(list_append(x.t, {far}),
      lambda t, k: CASE WHEN k = 1 THEN 0 ELSE least(t, coalesce(list_filter(q.js, lambda j: j > x.t[k - 1])[1], {far})) END), lambda t: t < {far}) END
  FROM {name}_t x JOIN {src} p ON p.id = x.id LEFT JOIN {name}_at q ON q.id = x.id AND q.token = p.a[x.i + 1] WHERE x.i < len(p.a))"""


def lcs_cte(name: str, src: str) -> str:
    """CTE ``name`` (id, v): length of the longest common subsequence of the lists
    ``a`` and ``b`` of each row (id, a, b) of ``src``."""
    return f"""{_least_prefixes(name, src, 'USING KEY (id) AS')},
{name} AS (SELECT id, len(t) - 1 AS v FROM {name}_t)"""


def edit_cte(name: str, src: str) -> str:
    """CTE ``name`` (id, v): edit distance of the lists ``a`` and ``b``.

    A row's state after e steps is, for each diagonal k, how much of ``a`` e edits can
    reach there; a step adds one edit and then follows the run of equal symbols."""
    return f"""
{name}_m AS (SELECT x.id, x.i, y.j - x.i AS k
  FROM (SELECT id, unnest(a) AS token, generate_subscripts(a, 1) - 1 AS i FROM {src}) x
  JOIN (SELECT id, unnest(b) AS token, generate_subscripts(b, 1) - 1 AS j FROM {src}) y ON x.id = y.id AND x.token = y.token),
{name}_runs AS MATERIALIZED (
  SELECT id, k, i, max(i) OVER (PARTITION BY id, k, g) + 1 AS stop
  FROM (SELECT *, i - row_number() OVER (PARTITION BY id, k ORDER BY i) AS g FROM {name}_m)),
{name}_f(id, e, k, f) AS (
  SELECT p.id, 0, 0::BIGINT, coalesce(r.stop, 0)::BIGINT FROM {src} p LEFT JOIN {name}_runs r ON r.id = p.id AND r.k = 0 AND r.i = 0
  UNION ALL
  SELECT c.id, c.e, c.k, coalesce(r.stop, c.f)::BIGINT FROM (
    SELECT o.id, o.e + 1 AS e, o.k + d.k AS k, max(least(o.f + d.f, len(p.a), len(p.b) - o.k - d.k)) AS f
    FROM (SELECT *, bool_or(reached) OVER (PARTITION BY id) AS done
          FROM (SELECT x.*, x.k = len(q.b) - len(q.a) AND x.f = len(q.a) AS reached FROM {name}_f x JOIN {src} q ON q.id = x.id)) o
    JOIN {src} p ON p.id = o.id CROSS JOIN (VALUES (0, 1), (1, 0), (-1, 1)) d(k, f)
    WHERE NOT o.done AND o.k + d.k BETWEEN -len(p.a) AND len(p.b) GROUP BY ALL) c
  LEFT JOIN {name}_runs r ON r.id = c.id AND r.k = c.k AND r.i = c.f),
{name} AS (SELECT x.id, min(x.e) AS v FROM {name}_f x JOIN {src} p ON p.id = x.id
           WHERE x.k = len(p.b) - len(p.a) AND x.f = len(p.a) GROUP BY x.id)"""


def union_lcs_cte(name: str, src: str) -> str:
    """CTE ``name`` (pair, hits): summary-level LCS of ``src`` (pair, rs, ps), lists of
    token lists.  A second recursion walks each pair of sentences back from the end,
    leaving a candidate token out when that keeps a strictly longer prefix and else a
    reference token; lengths of prefixes are counted in the kept states."""
    return f"""
{name}_s AS MATERIALIZED (
  SELECT pair || '/' || r || '/' || p AS id, pair, r, rs[r] AS a, ps[p] AS b
  FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS p FROM (SELECT *, unnest(range(1, len(rs) + 1)) AS r FROM {src}))
  WHERE len(list_intersect(rs[r], ps[p])) > 0),
{_least_prefixes(name, f'{name}_s', 'AS')},
{name}_w(id, i, j, pos) AS (
  SELECT id, len(a), len(b), 0 FROM {name}_s
  UNION ALL
  SELECT id, CASE WHEN same OR l <= u THEN i - 1 ELSE i END, CASE WHEN same OR l > u THEN j - 1 ELSE j END, CASE WHEN same THEN i ELSE 0 END
  FROM (SELECT w.id, w.i, w.j, s.a[w.i] = s.b[w.j] AS same, len(list_filter(x.t, lambda t: t <= w.j - 1)) AS l,
               len(list_filter(y.t, lambda t: t <= w.j)) AS u
        FROM {name}_w w JOIN {name}_s s ON s.id = w.id JOIN {name}_t x ON x.id = w.id AND x.i = w.i
             JOIN {name}_t y ON y.id = w.id AND y.i = w.i - 1
        WHERE w.i > 0 AND w.j > 0)),
{name}_p AS (SELECT DISTINCT s.pair, s.r, w.pos, s.a[w.pos] AS token FROM {name}_w w JOIN {name}_s s USING (id) WHERE w.pos > 0),
{name}_b AS (SELECT pair, token, count(*) AS n FROM (SELECT pair, unnest(flatten(ps)) AS token FROM {src}) GROUP BY ALL),
{name} AS (SELECT pair, sum(least(c, n))::BIGINT AS hits
           FROM (SELECT pair, token, count(*) AS c FROM {name}_p GROUP BY ALL) JOIN {name}_b USING (pair, token) GROUP BY pair)"""


def sentences(x: str) -> str:
    """Non-empty lines of a stripped text, each as its tokens."""
    return f"list_transform(list_filter(string_split({trim(x)}, chr(10)), lambda s: s <> ''), lambda s: {tokens('s')})"


def jiwer_words(x: str) -> str:
    t = trim(f"regexp_replace(coalesce({x}, ''), '\\s\\s+', ' ', 'g')")
    return f"list_filter(string_split({t}, ' '), lambda w: w <> '')"
