"""Named evaluation queries over the shared tables, and their DuckDB oracles.

Every query is ``(spark, sf_dir) -> DataFrame``; ``ORACLE_SQL`` holds the
equivalent DuckDB SQL where one exists (column names match).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rubric.operators import rollup
from rubric.operators.prepare import join_responses
from rubric.operators.metrics import score_pairs, to_long
from rubric.plans import fixtures as fx
from rubric.plans import oracle as o

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _r(c, digits: int = 6):
    return F.round(c, digits)


# ---------------------------------------------------------------------------
# Flagship: exact accuracy + CER per model, two-level mean
# ---------------------------------------------------------------------------

AVG_SCORES_SQL = f"""
WITH pairs AS ({o.conversation_pairs_sql()}),
ans AS ({o.first_word_or_line_cte(
    f"({o.first_word_or_line_cte('pairs', 'gold', 'gold_x', 'model, task, gold, response')})",
    'response', 'resp_x', 'model, task, gold, response, gold_x')}),
acc AS (
  SELECT model, task,
         {o.normalize_answer('gold_x')} AS a, {o.normalize_answer('resp_x')} AS b
  FROM ans),
acc_task AS (
  SELECT model, task, 'exact_accuracy' AS metric,
         coalesce(avg(CASE WHEN a = b THEN 1.0 ELSE 0.0 END) FILTER (WHERE a <> '' AND b <> ''), 0.0) AS value
  FROM acc GROUP BY model, task),
asr AS (
  SELECT model, task, gold, {o.asr_text('response')} AS pred FROM pairs),
cer_rows AS (
  SELECT *, {o.char_alphabet('r', 'p')} AS alpha
  FROM (SELECT model, task, gold, pred, {o.trim('gold')} AS r, {o.trim('pred')} AS p FROM asr)),
cer_task AS (
  SELECT model, task, 'cer' AS metric,
         coalesce(avg({o.char_levenshtein('r', 'p', 'alpha')} / length(r))
                  FILTER (WHERE gold <> '' AND pred <> '' AND length(r) > 0), 1.0) AS value
  FROM cer_rows GROUP BY model, task),
tasks AS (SELECT * FROM acc_task UNION ALL SELECT * FROM cer_task)
SELECT model, metric, round(avg(value), 4) AS average_score, count(*) AS n_tasks,
       round(min(value), 6) AS min_score, round(max(value), 6) AS max_score
FROM tasks GROUP BY model, metric
"""


@query("avg_scores_by_model", AVG_SCORES_SQL)
def avg_scores_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fx.conversation_pairs(spark, sf_dir)
    scored = score_pairs(pairs, ["exact_accuracy", "cer"], keep=["model", "task"])
    long = to_long(scored, ["model", "task"], ["exact_accuracy", "cer"])
    tasks = rollup.task_metric(long, ["model", "task"])
    avg = rollup.average_scores(tasks, ["model"])
    return avg.select("model", "metric", "average_score", "n_tasks",
                      _r(F.col("min_score")).alias("min_score"), _r(F.col("max_score")).alias("max_score"))


# ---------------------------------------------------------------------------
# N-gram metrics on conversation samples
# ---------------------------------------------------------------------------

_FA_KEYS = ["model", "conv_id", "turn"]

BLEU_SQL = f"""
WITH pairs AS ({o.conversation_pairs_sql()}),
prep AS (
  SELECT model, conv_id, turn, task,
         {o.tokens(o.space_punct('gold', braces=False, diacritics=True))} AS rt,
         {o.tokens(o.space_punct('response', braces=True, diacritics=True))} AS pt
  FROM pairs),
m AS ({o.ngram_matches_sql('prep', _FA_KEYS, 4)}),
scored AS (
  SELECT p.model, p.task, len(p.rt) AS lr, len(p.pt) AS lp,
         {o.bleu_from(['m.m1', 'm.m2', 'm.m3', 'm.m4'], 'len(p.rt)', 'len(p.pt)')} AS bleu
  FROM prep p JOIN m USING (model, conv_id, turn))
SELECT model, task,
       round(coalesce(avg(CASE WHEN lr > 0 AND lp > 0 THEN bleu END), 0.0), 6) AS bleu,
       count(*) FILTER (WHERE lr > 0 AND lp > 0) AS n_samples
FROM scored GROUP BY model, task
"""


@query("bleu_by_task", BLEU_SQL)
def bleu_by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fx.conversation_pairs(spark, sf_dir)
    long = to_long(score_pairs(pairs, ["bleu"], keep=["model", "task"]), ["model", "task"], ["bleu"])
    t = rollup.task_metric(long, ["model", "task"])
    return t.select("model", "task", _r(F.col("value")).alias("bleu"), "n_samples")


ROUGE_N_SQL = f"""
WITH pairs AS ({o.conversation_pairs_sql()}),
prep AS (
  SELECT model, conv_id, turn, task,
         {o.tokens(o.space_punct('gold'))} AS rt,
         {o.tokens(o.space_punct('response', braces=True))} AS pt
  FROM pairs),
m AS ({o.ngram_matches_sql('prep', _FA_KEYS, 2)}),
scored AS (
  SELECT p.model, p.task,
         {o.f1('m.m1', 'len(p.rt)', 'len(p.pt)')} AS r1,
         {o.f1('m.m2', 'greatest(len(p.rt) - 1, 0)', 'greatest(len(p.pt) - 1, 0)')} AS r2
  FROM prep p JOIN m USING (model, conv_id, turn))
SELECT model, task, round(avg(r1), 6) AS rouge1, round(avg(r2), 6) AS rouge2, count(*) AS n_samples
FROM scored GROUP BY model, task
"""


@query("rouge_n_by_task", ROUGE_N_SQL)
def rouge_n_by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fx.conversation_pairs(spark, sf_dir)
    scored = score_pairs(pairs, ["rouge"], keep=["model", "task"], only={"rouge": ("rouge1", "rouge2")})
    return scored.groupBy("model", "task").agg(
        _r(F.avg("rouge1.value")).alias("rouge1"), _r(F.avg("rouge2.value")).alias("rouge2"),
        F.count("*").alias("n_samples"))


WER_SQL = f"""
WITH RECURSIVE pairs AS (SELECT *, row_number() OVER () AS id, {o.asr_text('response')} AS pred FROM ({o.conversation_pairs_sql()})),
w AS MATERIALIZED (SELECT id, model, task, gold <> '' AND pred <> '' AS ok, {o.jiwer_words('gold')} AS a, {o.jiwer_words('pred')} AS b FROM pairs),
v AS MATERIALIZED (SELECT id, a, b FROM w WHERE ok AND len(a) > 0),
{o.edit_cte('d', 'v')}
SELECT model, task, round(coalesce(avg(d.v / len(w.a)), 1.0), 6) AS wer, count(d.v) AS n_samples
FROM w LEFT JOIN d USING (id) GROUP BY model, task
"""


@query("wer_by_task", WER_SQL)
def wer_by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WER per (model, task)."""
    pairs = fx.conversation_pairs(spark, sf_dir)
    long = to_long(score_pairs(pairs, ["wer"], keep=["model", "task"]), ["model", "task"], ["wer"])
    t = rollup.task_metric(long, ["model", "task"])
    return t.select("model", "task", _r(F.col("value")).alias("wer"), "n_samples")


# ---------------------------------------------------------------------------
# Passage recovery: benchmark passages inside documents (F-B)
# ---------------------------------------------------------------------------

PASSAGE_SQL = f"""
WITH pairs AS ({o.passage_pairs_sql()}),
prep AS (
  SELECT item_id, doc_id, source, passage, document,
         {o.tokens(o.space_punct('passage'))} AS rt,
         {o.tokens(o.space_punct('document', braces=True))} AS pt
  FROM pairs),
m AS ({o.ngram_matches_sql('prep', ['item_id', 'doc_id'], 2)}),
c AS (
  SELECT *, {o.char_alphabet('r', 'p')} AS alpha
  FROM (SELECT item_id, doc_id, passage, {o.trim('passage')} AS r, {o.trim(o.asr_text('document'))} AS p FROM prep)),
scored AS (
  SELECT p.source,
         {o.f1('m.m1', 'len(p.rt)', 'len(p.pt)')} AS r1,
         {o.f1('m.m2', 'greatest(len(p.rt) - 1, 0)', 'greatest(len(p.pt) - 1, 0)')} AS r2,
         {o.char_levenshtein('c.r', 'c.p', 'c.alpha')} / length(c.r) AS cer
  FROM prep p JOIN m USING (item_id, doc_id) JOIN c USING (item_id, doc_id))
SELECT source, count(*) AS n_pairs, round(avg(r1), 6) AS rouge1, round(avg(r2), 6) AS rouge2,
       round(avg(cer), 6) AS cer
FROM scored GROUP BY source
"""


@query("passage_recovery", PASSAGE_SQL)
def passage_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fx.passage_pairs(spark, sf_dir)
    scored = score_pairs(pairs, ["rouge", "cer"], gold="passage", response="document", keep=["source"],
                         only={"rouge": ("rouge1", "rouge2")})
    return scored.groupBy("source").agg(
        F.count("*").alias("n_pairs"), _r(F.avg("rouge1.value")).alias("rouge1"),
        _r(F.avg("rouge2.value")).alias("rouge2"), _r(F.avg("cer.value")).alias("cer"))


# ---------------------------------------------------------------------------
# Judge verdicts (F-C)
# ---------------------------------------------------------------------------

def _judge_samples(spark: SparkSession, sf_dir: str, mcq: bool, judges: tuple[str, ...],
                   method: str = "mean", threshold: float = 0.5) -> DataFrame:
    from rubric.operators import judge as J
    attempts = fx.judge_attempts(spark, sf_dir, mcq=mcq).filter(F.col("judge").isin(*judges))
    verdicts = J.first_valid_verdict(attempts, ["task", "sample_id"])
    scores = J.judge_scores(verdicts, ["task", "sample_id"], mcq=mcq, threshold=threshold)
    return J.aggregate_judges(scores, ["task", "sample_id"], method=method, threshold=threshold)


def _taskwise_sql(prefix: str, mcq: bool) -> str:
    return f"""
WITH s AS ({o.judge_samples_sql(mcq=mcq)})
SELECT task, round(avg(score), 4) AS {prefix}llm_judge_score, round(avg(raw_score), 4) AS {prefix}llm_judge_score_raw,
       0.0::DOUBLE AS {prefix}llm_judge_score_stderr, count(*) AS num_samples
FROM s WHERE valid GROUP BY task
"""


@query("judge_generation", _taskwise_sql("", False))
def judge_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1-G4 + A2: generative judge (one judge, threshold 0.5) per task."""
    from rubric.operators import judge as J
    return J.taskwise(_judge_samples(spark, sf_dir, False, ("j1",)))


@query("judge_mcq", _taskwise_sql("mcq_", True))
def judge_mcq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiple-choice judge: scores clamped to [0, 1], ``mcq_`` prefix."""
    from rubric.operators import judge as J
    return J.taskwise(_judge_samples(spark, sf_dir, True, ("j1",)), prefix="mcq_")


JUDGE_OVERALL_SQL = f"""
WITH s AS ({o.judge_samples_sql(mcq=False)})
SELECT count(*) AS total_samples, round(avg(score), 4) AS average_score, min(score) AS min_score,
       max(score) AS max_score, round(avg(raw_score), 4) AS average_score_raw,
       min(raw_score) AS min_score_raw, max(raw_score) AS max_score_raw
FROM s WHERE valid
"""


@query("judge_overall", JUDGE_OVERALL_SQL)
def judge_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: overall judge statistics over every judged sample."""
    from rubric.operators import judge as J
    return J.overall(_judge_samples(spark, sf_dir, False, ("j1",)))


JUDGE_BATCH_SQL = f"""
WITH s AS ({o.judge_samples_sql(mcq=False, judges=("j1", "j2"))})
SELECT count(*) AS total_test_cases, round(avg(score), 6) AS average_score, round(median(score), 6) AS median_score,
       round(avg(raw_score), 6) AS average_raw_score, round(median(raw_score), 6) AS median_raw_score,
       round(coalesce(avg(CASE WHEN score >= 0.7 THEN 1.0 ELSE 0.0 END), 0.0), 6) AS pass_rate
FROM s WHERE valid
"""


@query("judge_batch_stats", JUDGE_BATCH_SQL)
def judge_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 + G6: two judges averaged per sample, then batch statistics."""
    from rubric.operators import judge as J
    st = J.batch_statistics(_judge_samples(spark, sf_dir, False, ("j1", "j2"), threshold=0.7), threshold=0.7)
    return st.select("total_test_cases", *[_r(F.col(c)).alias(c) for c in st.columns if c != "total_test_cases"])


JUDGE_PANEL_SQL = f"""
WITH s AS ({o.judge_samples_sql(mcq=False, judges=("j1", "j2"), method="median")})
SELECT task, count(*) FILTER (WHERE valid) AS num_samples, count(*) AS n_samples_all,
       round(avg(score) FILTER (WHERE valid), 6) AS median_panel_score,
       round(avg(raw_score) FILTER (WHERE valid), 6) AS median_panel_raw
FROM s GROUP BY task
"""


@query("judge_panel", JUDGE_PANEL_SQL)
def judge_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 with the median method over two judges, per task."""
    s = _judge_samples(spark, sf_dir, False, ("j1", "j2"), method="median")
    return s.groupBy("task").agg(
        F.count_if(F.col("valid")).alias("num_samples"), F.count("*").alias("n_samples_all"),
        _r(F.avg(F.when(F.col("valid"), F.col("score")))).alias("median_panel_score"),
        _r(F.avg(F.when(F.col("valid"), F.col("raw_score")))).alias("median_panel_raw"))


def _judge_pipeline_sql(mcq: bool) -> str:
    return f"""
WITH s AS ({o.prompt_scores_sql(mcq)})
SELECT model, task, count(*) AS n_judged, count(*) FILTER (WHERE valid) AS num_samples,
       round(avg(score) FILTER (WHERE valid), 4) AS llm_judge_score, round(avg(raw_score) FILTER (WHERE valid), 4) AS llm_judge_score_raw,
       min(raw_score) FILTER (WHERE valid) AS min_raw, max(raw_score) FILTER (WHERE valid) AS max_raw,
       count(*) FILTER (WHERE valid AND score >= 0.5) AS n_passed
FROM s GROUP BY model, task
"""


def _judge_pipeline(spark: SparkSession, sf_dir: str, mcq: bool) -> DataFrame:
    from rubric.operators import judge as J
    keys = ["model", "task", "conv_id", "turn"]
    requests = J.judge_requests(fx.conversation_judge_samples(spark, sf_dir, mcq=mcq), keys, mcq=mcq,
                                tasks=fx.conversation_tasks(spark, sf_dir, mcq=mcq))
    replies = fx.prompt_replies(J.distinct_prompts(requests), mcq=mcq)
    judged = J.judge_pipeline(requests, replies, keys, mcq=mcq)
    of_valid = lambda c: F.when(F.col("valid"), F.col(c))
    return judged.groupBy("model", "task").agg(
        F.count("*").alias("n_judged"), F.count_if("valid").alias("num_samples"),
        _r(F.avg(of_valid("score")), 4).alias("llm_judge_score"), _r(F.avg(of_valid("raw_score")), 4).alias("llm_judge_score_raw"),
        F.min(of_valid("raw_score")).alias("min_raw"), F.max(of_valid("raw_score")).alias("max_raw"),
        F.count_if(of_valid("passed")).alias("n_passed"))


@query("judge_pipeline_generation", _judge_pipeline_sql(False))
def judge_pipeline_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 with allow-list, T10, replies by prompt key, G1, G2, G5 over the
    conversation samples; the prompts' own digests decide the replies."""
    return _judge_pipeline(spark, sf_dir, False)


@query("judge_pipeline_mcq", _judge_pipeline_sql(True))
def judge_pipeline_mcq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7 in its multiple-choice form: T6 on both sides, scores clamped."""
    return _judge_pipeline(spark, sf_dir, True)


TEST_CASES_SQL = f"""
WITH s AS (SELECT *, conv_id + turn AS place, CASE WHEN (conv_id + turn) % 5 <> 0 THEN response ELSE '' END AS answer
           FROM ({o.conversation_pairs_sql()}) WHERE model = 'm0')
SELECT conv_id::VARCHAR || '-' || turn::VARCHAR AS id, (place % 3)::INTEGER AS shape, md5(question) AS question, md5(gold) AS reference_answer,
       md5(answer) AS given_answer,
       CASE WHEN place % 3 = 0 OR (place % 3 = 2 AND place % 2 = 0) THEN task ELSE category || chr(10) || task END AS context,
       CASE WHEN place % 3 = 0 OR (place % 3 = 2 AND place % 2 = 0) THEN '{{"category":"' || category || '"}}' END AS metadata
FROM s
"""


@query("test_cases", TEST_CASES_SQL)
def test_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test cases of three shapes as one, one row a case (texts by digest)."""
    from rubric.operators import judge as J
    cases = J.normalise_variant_cases(fx.conversation_test_cases(spark, sf_dir))
    return cases.select("id", "shape", *[F.md5(c).alias(c) for c in ("question", "reference_answer", "given_answer")], "context", "metadata")


# ---------------------------------------------------------------------------
# Multiple choice (F-D)
# ---------------------------------------------------------------------------

MCQ_ACCURACY_SQL = f"""
WITH s AS ({o.mcq_samples_sql()}),
ans AS ({o.first_word_or_line_cte(
    f"({o.first_word_or_line_cte('s', 'gold', 'gold_x', 'task, sample_id, gold, response')})",
    'response', 'resp_x', 'task, sample_id, gold, response, gold_x')}),
n AS (SELECT task, {o.normalize_answer('gold_x')} AS a, {o.normalize_answer('resp_x')} AS b FROM ans)
SELECT task,
       round(avg(CASE WHEN a = b OR contains(a, b) OR contains(b, a) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(CASE WHEN a = b THEN 1.0 ELSE 0.0 END), 6) AS exact_accuracy,
       count(*) AS n_samples
FROM n WHERE a <> '' AND b <> '' GROUP BY task
"""


@query("mcq_accuracy", MCQ_ACCURACY_SQL)
def mcq_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 (fuzzy by default) and M2 on answer extraction (T1) of region MCQs."""
    s = fx.mcq_samples(spark, sf_dir)
    scored = score_pairs(s, ["accuracy", "exact_accuracy"], keep=["task"])
    ok = scored.filter(F.col("accuracy.valid"))
    return ok.groupBy("task").agg(_r(F.avg("accuracy.value")).alias("accuracy"),
                                  _r(F.avg("exact_accuracy.value")).alias("exact_accuracy"),
                                  F.count("*").alias("n_samples"))


MCQ_NORMALIZED_SQL = f"""
WITH s AS ({o.mcq_samples_sql()}),
n AS (SELECT task, {o.normalize_mcq('gold', 'mcq')} AS g, {o.normalize_mcq('response', 'mcq')} AS r FROM s)
SELECT task, count(*) AS n_samples, count(*) FILTER (WHERE g = r) AS n_agree,
       round(avg(CASE WHEN g = r THEN 1.0 ELSE 0.0 END), 6) AS agreement
FROM n WHERE g <> '' AND r <> '' GROUP BY task
"""


@query("mcq_normalized", MCQ_NORMALIZED_SQL)
def mcq_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 + J4 + F3: letters / "X)" answers mapped to option text on both sides
    (the judge's MCQ path), agreement per task."""
    from rubric.operators.judge import judgeable
    s = judgeable(fx.mcq_samples(spark, sf_dir), "gold", "response", mcq_col="mcq")
    agree = F.col("gold") == F.col("response")
    return s.groupBy("task").agg(F.count("*").alias("n_samples"), F.count_if(agree).alias("n_agree"),
                                 _r(F.avg(agree.cast("double"))).alias("agreement"))


# ---------------------------------------------------------------------------
# LCS family (Arrow batches; rows-only check, brute-force unit tests)
# ---------------------------------------------------------------------------

def _fuzzy_ctes(src: str) -> str:
    """CTEs ending in ``fz`` (id, value, valid): fuzzy accuracy of ``src`` (id, gold, response)."""
    x, y = o.normalize_answer('gold_x'), o.normalize_answer('resp_x')
    windows = [f"""
      SELECT id, s, substr(l, 1, k) AS w FROM (SELECT *, unnest(range(1, length(s))) AS k FROM {t})
      UNION ALL SELECT id, s, substr(l, k, length(s)) FROM (SELECT *, unnest(range(1, length(l) - length(s) + 2)) AS k FROM {t})
      UNION ALL SELECT id, s, substr(l, k) FROM (SELECT *, unnest(range(length(l) - length(s) + 2, length(l) + 1)) AS k FROM {t})""" for t in ("open", "swapped")]
    answers = o.first_word_or_line_cte(f"({o.first_word_or_line_cte(src, 'gold', 'gold_x', 'id, gold, response')})",
                                       'response', 'resp_x', 'id, gold, response, gold_x')
    return f"""
n AS MATERIALIZED (SELECT id, x, y, x <> '' AND y <> '' AS valid, x = y OR contains(x, y) OR contains(y, x) AS settled
                   FROM (SELECT id, {x} AS x, {y} AS y FROM ({answers}))),
open AS MATERIALIZED (SELECT id, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS s, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS l
                      FROM n WHERE valid AND NOT settled),
swapped AS (SELECT id, l AS s, s AS l FROM open WHERE length(s) = length(l)),
tests AS MATERIALIZED (
  SELECT row_number() OVER () AS id, pair, string_split(s, '') AS a, string_split(w, '') AS b FROM (
    SELECT id AS pair, s, l AS w FROM open UNION ALL SELECT id, s, w FROM ({windows[0]}) UNION ALL SELECT id, s, w FROM ({windows[1]}))),
{o.lcs_cte('cf', 'tests')},
best AS (SELECT pair, max(2.0 * cf.v / (len(t.a) + len(t.b))) AS ratio FROM cf JOIN tests t USING (id) GROUP BY pair),
fz AS (SELECT n.id, CASE WHEN settled OR ratio >= 0.85 THEN 1.0 ELSE 0.0 END AS value, valid FROM n LEFT JOIN best ON best.pair = n.id)"""


FUZZY_ACCURACY_SQL = f"""
WITH RECURSIVE pairs AS MATERIALIZED (SELECT row_number() OVER () AS id, * FROM ({o.conversation_pairs_sql()})),
{_fuzzy_ctes('pairs')}
SELECT model, task, round(coalesce(avg(value) FILTER (WHERE valid), 0.0), 6) AS fuzzy_accuracy, count(*) FILTER (WHERE valid) AS n_samples
FROM pairs JOIN fz USING (id) GROUP BY model, task
"""


@query("fuzzy_accuracy", FUZZY_ACCURACY_SQL)
def fuzzy_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3-M5: fuzzy accuracy of extracted answers per (model, task)."""
    pairs = fx.conversation_pairs(spark, sf_dir)
    long = to_long(score_pairs(pairs, ["fuzzy_accuracy"], keep=["model", "task"]), ["model", "task"],
                   ["fuzzy_accuracy"])
    t = rollup.task_metric(long, ["model", "task"])
    return t.select("model", "task", _r(F.col("value")).alias("fuzzy_accuracy"), "n_samples")


ROUGE_L_SQL = f"""
WITH RECURSIVE prep AS MATERIALIZED (
  SELECT row_number() OVER () AS id, model, task, {o.tokens(o.space_punct('gold'))} AS a, {o.tokens(o.space_punct('response', braces=True))} AS b
  FROM ({o.conversation_pairs_sql()})),
{o.lcs_cte('c', 'prep')}
SELECT model, task, round(avg({o.f1('c.v', 'len(p.a)', 'len(p.b)')}), 6) AS "rougeL", count(*) AS n_samples
FROM prep p JOIN c USING (id) GROUP BY model, task
"""


@query("rouge_l", ROUGE_L_SQL)
def rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: token-LCS ROUGE-L per (model, task)."""
    pairs = fx.conversation_pairs(spark, sf_dir)
    scored = score_pairs(pairs, ["rouge"], keep=["model", "task"], only={"rouge": ("rougeL",)})
    return scored.groupBy("model", "task").agg(_r(F.avg("rougeL.value")).alias("rougeL"),
                                               F.count("*").alias("n_samples"))


ROUGE_LSUM_SQL = f"""
WITH RECURSIVE prep AS MATERIALIZED (
  SELECT row_number() OVER () AS id, source, passage, document, {o.tokens(o.space_punct('passage'))} AS a,
         {o.tokens(o.space_punct('document', braces=True))} AS b FROM ({o.passage_pairs_sql()})),
lines AS MATERIALIZED (SELECT id AS pair, {o.sentences(o.space_punct('passage'))} AS rs, {o.sentences(o.space_punct('document', braces=True))} AS ps FROM prep),
{o.lcs_cte('c', 'prep')},
{o.union_lcs_cte('u', 'lines')}
SELECT source, round(avg({o.f1('c.v', 'len(p.a)', 'len(p.b)')}), 6) AS "rougeL",
       round(avg({o.f1('coalesce(u.hits, 0)', 'len(flatten(l.rs))', 'len(flatten(l.ps))')}), 6) AS "rougeLsum", count(*) AS n_pairs
FROM prep p JOIN c USING (id) JOIN lines l ON l.pair = p.id LEFT JOIN u ON u.pair = p.id GROUP BY source
"""


@query("rouge_lsum", ROUGE_LSUM_SQL)
def rouge_lsum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: summary-level ROUGE-Lsum of passages against the (multi-line)
    documents that contain them, per source."""
    pairs = fx.passage_pairs(spark, sf_dir)
    scored = score_pairs(pairs, ["rouge"], gold="passage", response="document", keep=["source"],
                         only={"rouge": ("rougeL", "rougeLsum")})
    return scored.groupBy("source").agg(_r(F.avg("rougeL.value")).alias("rougeL"),
                                        _r(F.avg("rougeLsum.value")).alias("rougeLsum"),
                                        F.count("*").alias("n_pairs"))


# ---------------------------------------------------------------------------
# Chat messages and tokens
# ---------------------------------------------------------------------------

_SEGMENT = f"{o.capitalize('role')} || ': ' || text || chr(10) || chr(10)"

CHAT_PROMPTS_SQL = f"""
SELECT conv_id, count(*) AS n_messages, (sum(length({_SEGMENT})) + length('Assistant:'))::BIGINT AS prompt_chars,
       sum(('0x' || substr(md5(turn::VARCHAR || ':' || {_SEGMENT}), 1, 8))::BIGINT)::BIGINT AS prompt_digest
FROM conversations GROUP BY conv_id
"""


@query("chat_prompts", CHAT_PROMPTS_SQL)
def chat_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered chat prompt per conversation (as ordered segments): length,
    message count and digest of the segments at their places."""
    from rubric.operators import chat
    msgs = fx.table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    seg = chat.render_segments(msgs, ["conv_id"], content="text")
    return chat.prompt_lengths(seg, ["conv_id"])


CLEAN_MESSAGES_SQL = """
SELECT coalesce(role, 'user') AS role, count(*) AS n_messages, sum(length(text))::BIGINT AS n_chars
FROM conversations GROUP BY ALL
"""


@query("clean_messages", CLEAN_MESSAGES_SQL)
def clean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message cleaning (role default, block content to text) per role."""
    from rubric.operators import chat
    msgs = chat.clean_messages(fx.table(spark, sf_dir, "conversations", "role", "text"), content="text")
    return msgs.groupBy("role").agg(F.count("*").alias("n_messages"), F.sum(F.length("text")).alias("n_chars"))


MESSAGE_BLOCKS_SQL = """
SELECT conv_id, turn, CASE WHEN turn % 5 = 0 THEN 'user' ELSE role END AS role,
       md5(CASE turn % 4 WHEN 0 THEN text || ' and more' WHEN 1 THEN '' WHEN 2 THEN 'first ' || text ELSE text END) AS text
FROM conversations
"""


@query("message_blocks", MESSAGE_BLOCKS_SQL)
def message_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 on messages whose content is a list of blocks (texts, media, plain strings,
    a text block without text) or plain, some without a role."""
    from rubric.operators import chat
    return chat.clean_messages(fx.block_messages(spark, sf_dir)).select("conv_id", "turn", "role", F.md5("content").alias("text"))


ASR_TEXTS_SQL = f"""
SELECT conv_id, turn, md5(CASE (conv_id + turn) % 8 WHEN 4 THEN '[' || conv_id::VARCHAR || '.0, "it''s", True, None]'
         WHEN 5 THEN conv_id::VARCHAR || '.5' WHEN 6 THEN '' ELSE answer_raw END) AS text
FROM ({o.conversation_items_sql()})
"""


@query("asr_texts", ASR_TEXTS_SQL)
def asr_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 on answers in every form the rule knows, by digest."""
    from rubric.functions.text import extract_asr_text
    return fx.asr_answers(spark, sf_dir).select("conv_id", "turn", F.md5(extract_asr_text("answer")).alias("text"))


TOKEN_USAGE_SQL = f"""
WITH pairs AS ({o.conversation_pairs_sql()})
SELECT model, sum({o.simple_token_count('response')})::BIGINT AS tokens, count(*) AS n_texts
FROM pairs GROUP BY model
"""


@query("token_usage", TOKEN_USAGE_SQL)
def token_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 + A8: simple token counts of every model's responses."""
    from rubric.operators import chat
    return chat.token_counts(fx.conversation_responses(spark, sf_dir), ["model"], "response")


FIRST_ATTEMPT_SQL = f"""
WITH r AS ({o.conversation_pairs_sql()}),
h AS (SELECT model, conv_id, turn, response, conv_id + turn + substr(model, 2)::INTEGER AS h FROM r),
a AS (
  SELECT model, conv_id, turn, 1 AS attempt, CASE WHEN h % 4 = 0 THEN '' ELSE response END AS response FROM h
  UNION ALL SELECT model, conv_id, turn, 2, CASE WHEN h % 8 = 0 THEN '   ' ELSE response END FROM h
  UNION ALL SELECT model, conv_id, turn, 3, CASE WHEN h % 16 = 0 THEN '' ELSE response END FROM h),
f AS (SELECT model, conv_id, turn, min(attempt) FILTER (WHERE {o.trim('response')} <> '' AND attempt <= 3) AS used
      FROM a GROUP BY ALL)
SELECT model, count(*) AS n_samples, count(*) FILTER (WHERE used = 1) AS n_first,
       count(*) FILTER (WHERE used = 2) AS n_second, count(*) FILTER (WHERE used = 3) AS n_third,
       count(*) FILTER (WHERE used IS NULL) AS n_failed
FROM f GROUP BY model
"""


@query("first_valid_attempt", FIRST_ATTEMPT_SQL)
def first_valid_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + J1: first non-blank attempt (<= 3) per request, joined to every
    request (failed ones become "")."""
    from rubric.operators.prepare import first_valid_attempt as first_valid
    first = first_valid(fx.response_attempts(spark, sf_dir), ["model", "conv_id", "turn"])
    items = fx.conversation_items(spark, sf_dir).select("conv_id", "turn")
    per_model = items.withColumn("model", F.explode(F.array(*[F.lit(m) for m in fx.MODELS])))
    s = join_responses(per_model, first, ["model", "conv_id", "turn"])
    return s.groupBy("model").agg(
        F.count("*").alias("n_samples"),
        F.count_if(F.col("used") == 1).alias("n_first"), F.count_if(F.col("used") == 2).alias("n_second"),
        F.count_if(F.col("used") == 3).alias("n_third"), F.count_if(F.col("used").isNull()).alias("n_failed"))


# ---------------------------------------------------------------------------
# Job log (F-E)
# ---------------------------------------------------------------------------

_JOB_SQL = """
SELECT user_id AS job_id, ts, event_id,
       CASE event_type WHEN 'signup' THEN 'starting' WHEN 'view' THEN 'running' WHEN 'click' THEN 'running'
            WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' END AS status,
       CASE WHEN event_type = 'error' THEN 'API request failed with error message: {"error": ' || props || '}' END AS error
FROM events"""

LATEST_STATUS_SQL = f"""
WITH j AS ({_JOB_SQL})
SELECT job_id, l.s AS status, coalesce(l.e, '') AS error, n_events
FROM (SELECT job_id, arg_max(struct_pack(s := status, e := error), (ts, event_id)) AS l, count(*) AS n_events
      FROM j GROUP BY job_id)
"""


@query("latest_job_status", LATEST_STATUS_SQL)
def latest_job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest status and error per job from the lifecycle log."""
    from rubric.operators import jobs
    return jobs.latest_status(jobs.check_status(fx.job_events(spark, sf_dir)))


ERROR_TRIAGE_SQL = f"""
WITH j AS ({_JOB_SQL}),
f AS (SELECT job_id, regexp_extract(error, '\\{{(?:[^{{}}]|\\{{[^{{}}]*\\}})*\\}}', 0) AS js FROM j WHERE status = 'failed')
SELECT TRY_CAST(json_extract_string(js::JSON, '$.error.k') AS INTEGER) AS error_k,
       count(*) AS n_failures, count(DISTINCT job_id) AS n_jobs
FROM f GROUP BY ALL
"""


@query("error_triage", ERROR_TRIAGE_SQL)
def error_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error objects extracted from failure messages, grouped by payload."""
    from rubric.operators import jobs
    p = jobs.failure_payloads(fx.job_events(spark, sf_dir))
    k = F.try_variant_get(F.try_parse_json("payload"), "$.error.k", "int")
    return p.groupBy(k.alias("error_k")).agg(F.count("*").alias("n_failures"),
                                             F.count_distinct("job_id").alias("n_jobs"))


# ---------------------------------------------------------------------------
# Roll-ups across pipelines: final score records and result payloads
# ---------------------------------------------------------------------------

def task_metric_lists(task: F.Column) -> F.Column:
    """Metric list of each conversation task (M12: metrics are carried per
    task): even tasks use ROUGE and BLEU, odd ones BLEU, every third adds
    accuracy."""
    n = F.substr(task, F.lit(2)).cast("int")
    base = F.when(n % 2 == 0, F.array(F.lit("rouge"), F.lit("bleu"))).otherwise(F.array(F.lit("bleu")))
    return F.when(n % 3 == 0, F.array_append(base, F.lit("accuracy"))).otherwise(base)


def _generation_task_results(spark: SparkSession, sf_dir: str, rouge_parts: tuple[str, ...] | None = None) -> DataFrame:
    """Task results of every model: model, task, category, metric, value."""
    from rubric.operators.metrics import ROUGE_PARTS
    parts = rouge_parts or ROUGE_PARTS
    pairs = fx.conversation_pairs(spark, sf_dir)
    lists = task_metric_lists(F.col("task"))
    pairs = pairs.select("*", *[F.array_contains(lists, m).alias(f"_need_{m}") for m in ("bleu", "accuracy", "rouge")])
    outputs, keys = ["bleu", "accuracy", *parts], ["model", "task", "category"]
    scored = score_pairs(pairs, ["bleu", "accuracy", "rouge"], keep=keys, only={"rouge": parts},
                         needed={m: f"_need_{m}" for m in ("bleu", "accuracy", "rouge")})
    long = to_long(scored, keys, outputs)
    family = F.when(F.col("metric").isin(*ROUGE_PARTS), F.lit("rouge")).otherwise(F.col("metric"))
    long = long.filter(F.array_contains(task_metric_lists(F.col("task")), family))
    return rollup.task_metric(long, keys)


def _judge_task_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge means of the same (model, task) samples that the metrics score."""
    from rubric.operators import judge as J
    out = None
    for mcq, prefix in ((False, ""), (True, "mcq_")):
        verdicts = J.first_valid_verdict(fx.conversation_judge_attempts(spark, sf_dir, mcq=mcq), ["task", "sample_id"])
        scores = J.judge_scores(verdicts, ["task", "sample_id"], mcq=mcq, threshold=0.5)
        samples = J.aggregate_judges(scores, ["task", "sample_id"], method="mean", threshold=0.5)
        name = f"{prefix}llm_judge_score"
        one = J.taskwise(samples, prefix=prefix).select(
            F.split_part("task", F.lit("|"), F.lit(1)).alias("model"), F.split_part("task", F.lit("|"), F.lit(2)).alias("task"),
            F.lit(name).alias("metric"), F.col(name).alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


def _final_records(results: DataFrame, judged: DataFrame) -> DataFrame:
    both = results.select("model", "task", "metric", "value").unionByName(judged)
    out = rollup.final_scores(both, ["model", "task"])
    return out.select("model", "task", *[_r(F.col(c)).alias(c) for c in rollup.FINAL_SCORES],
                      F.transform_values("record", lambda k, v: _r(v)).alias("record"))


_TASK = "substr(task, 2)::INTEGER"


def _task_values_ctes() -> str:
    """CTEs ending in ``vals`` (model, task, category, the metrics of the task's list, judge means)."""
    h = "(conv_id + turn + substr(model, 2)::INTEGER)"
    return f"""
pairs AS MATERIALIZED (SELECT row_number() OVER () AS id, * FROM ({o.conversation_pairs_sql()})),
prep AS MATERIALIZED (SELECT id, {o.tokens(o.space_punct('gold', diacritics=True))} AS rt,
                             {o.tokens(o.space_punct('response', braces=True, diacritics=True))} AS pt FROM pairs),
m AS ({o.ngram_matches_sql('prep', ['id'], 4)}),
bl AS (SELECT id, {o.bleu_from(['m.m1', 'm.m2', 'm.m3', 'm.m4'], 'len(p.rt)', 'len(p.pt)')} AS bleu, len(p.rt) > 0 AND len(p.pt) > 0 AS valid FROM prep p JOIN m USING (id)),
rg AS MATERIALIZED (SELECT id, {o.tokens(o.space_punct('gold'))} AS a, {o.tokens(o.space_punct('response', braces=True))} AS b,
                           {o.sentences(o.space_punct('gold'))} AS rs, {o.sentences(o.space_punct('response', braces=True))} AS ps
                    FROM pairs WHERE {_TASK} % 2 = 0),
grams AS (SELECT id, a AS rt, b AS pt FROM rg),
gm AS ({o.ngram_matches_sql('grams', ['id'], 2)}),
sents AS (SELECT id AS pair, rs, ps FROM rg),
{o.lcs_cte('lc', 'rg')},
{o.union_lcs_cte('un', 'sents')},
rouge AS (SELECT rg.id, {o.f1('gm.m1', 'len(a)', 'len(b)')} AS r1, {o.f1('gm.m2', 'greatest(len(a) - 1, 0)', 'greatest(len(b) - 1, 0)')} AS r2,
                 {o.f1('lc.v', 'len(a)', 'len(b)')} AS rl, {o.f1('coalesce(un.hits, 0)', 'len(flatten(rs))', 'len(flatten(ps))')} AS rs
          FROM rg JOIN gm USING (id) JOIN lc USING (id) LEFT JOIN un ON un.pair = rg.id),
{_fuzzy_ctes('pairs')},
vals AS (
  SELECT model, task, category, CASE WHEN {_TASK} % 3 = 0 THEN round(coalesce(avg(fz.value) FILTER (WHERE fz.valid), 0.0), 6) END AS accuracy,
         round(coalesce(avg(bleu) FILTER (WHERE bl.valid), 0.0), 6) AS bleu,
         round(avg(r1), 6) AS rouge1, round(avg(r2), 6) AS rouge2, round(avg(rl), 6) AS rougel, round(avg(rouge.rs), 6) AS rougelsum,
         round(avg(round(({h} % 5) / 3.0, 5)) FILTER (WHERE {h} % 10 <> 0), 4) AS judge,
         round((avg(greatest(0, least(1, {h} % 3 - 1))) FILTER (WHERE {h} % 10 <> 0))::DOUBLE, 4) AS judge_mcq
  FROM pairs JOIN bl USING (id) JOIN fz USING (id) LEFT JOIN rouge USING (id) GROUP BY model, task, category)"""


FINAL_SCORES_SQL = f"""
WITH RECURSIVE {_task_values_ctes()}
SELECT model, task, CASE WHEN {_TASK} % 2 = 0 THEN rougelsum ELSE bleu END AS "nGramScore", accuracy AS "mcqScore",
       judge AS "llmAsJudgeScore", judge_mcq AS "MCQllmAsJudgeScore" FROM vals
"""

_NUMBER = "regexp_replace({}::DOUBLE::VARCHAR, '\\.0$', '')"

RESULT_PAYLOADS_SQL = f"""
WITH RECURSIVE {_task_values_ctes()},
parts AS (
  SELECT *, concat_ws(',', '"accuracy,none":' || {_NUMBER.format('accuracy')}, '"bleu,none":' || {_NUMBER.format('bleu')},
           CASE WHEN {_TASK} % 2 = 0 THEN '"rouge,none":{{"rouge1":' || {_NUMBER.format('rouge1')} || ',"rouge2":' || {_NUMBER.format('rouge2')}
             || ',"rougeL":' || {_NUMBER.format('rougel')} || ',"rougeLsum":' || {_NUMBER.format('rougelsum')} || '}}' END) AS results,
         concat_ws(',', '"nGramScore":' || CASE WHEN {_TASK} % 2 = 0 THEN rougelsum ELSE bleu END::DOUBLE::VARCHAR, '"mcqScore":' || accuracy::DOUBLE::VARCHAR,
           '"llmAsJudgeScore":' || judge::DOUBLE::VARCHAR, '"MCQllmAsJudgeScore":' || judge_mcq::DOUBLE::VARCHAR) AS scores
  FROM vals)
SELECT model, task, category, '{{"job_id":"job-' || model || '","task_id":"' || task || '","results":{{' || results || '}},"scores":{{' || scores
       || '}},"status":"completed","category":"' || category || '","benchmark":"conversations"}}' AS payload
FROM parts
"""


@query("final_scores", FINAL_SCORES_SQL)
def final_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 per (model, task): nGramScore (ROUGE-Lsum when the task has ROUGE,
    else BLEU), mcqScore and the judge scores of the same samples."""
    # the final record reads ROUGE through its rougeLsum only
    return _final_records(_generation_task_results(spark, sf_dir, ("rougeLsum",)), _judge_task_results(spark, sf_dir)).drop("record")


@query("result_payloads", RESULT_PAYLOADS_SQL)
def result_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record per (model, task): metric results ("<name>,none",
    ROUGE as one object) and the final record as ``scores``."""
    from rubric.operators import jobs
    t = _generation_task_results(spark, sf_dir)
    t = t.select("model", "task", "category", "metric", _r(F.col("value")).alias("value"))
    scores = _final_records(t, _judge_task_results(spark, sf_dir))
    return jobs.result_payloads(t, ["model", "task", "category"], scores, ["model", "task"], benchmark="conversations")


AVERAGE_BY_CATEGORY_SQL = f"""
WITH pairs AS ({o.conversation_pairs_sql()}),
prep AS (
  SELECT model, conv_id, turn, task, category,
         {o.tokens(o.space_punct('gold', braces=False, diacritics=True))} AS rt,
         {o.tokens(o.space_punct('response', braces=True, diacritics=True))} AS pt
  FROM pairs),
m AS ({o.ngram_matches_sql('prep', _FA_KEYS, 4)}),
scored AS (
  SELECT p.model, p.task, p.category, len(p.rt) AS lr, len(p.pt) AS lp,
         {o.bleu_from(['m.m1', 'm.m2', 'm.m3', 'm.m4'], 'len(p.rt)', 'len(p.pt)')} AS bleu
  FROM prep p JOIN m USING (model, conv_id, turn)),
tasks AS (
  SELECT model, category, task, coalesce(avg(CASE WHEN lr > 0 AND lp > 0 THEN bleu END), 0.0) AS value
  FROM scored GROUP BY model, category, task)
SELECT model, category, 'bleu' AS metric, round(avg(value), 4) AS average_score, count(*) AS n_tasks
FROM tasks GROUP BY model, category
"""


@query("average_by_category", AVERAGE_BY_CATEGORY_SQL)
def average_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A4 + A6: BLEU task means averaged per (model, category)."""
    pairs = fx.conversation_pairs(spark, sf_dir)
    long = to_long(score_pairs(pairs, ["bleu"], keep=["model", "task", "category"]),
                   ["model", "task", "category"], ["bleu"])
    t = rollup.task_metric(long, ["model", "category", "task"])
    return rollup.average_scores(t, ["model", "category"]).select(
        "model", "category", "metric", "average_score", "n_tasks")


# ---------------------------------------------------------------------------
# Dataset catalog derived from documents (P, F, J3)
# ---------------------------------------------------------------------------

from rubric.plans import catalog as cat  # noqa: E402

IMG_RE = r"(?s).\.(png|jpg|jpeg|gif|bmp|webp)$"
AUD_RE = r"(?s).\.(wav|mp3|flac|ogg|m4a|aac|wma)$"


def _last_sql(v: str) -> str:
    return f"string_split(rtrim(lower({v}), '/'), '/')[-1]"


def _render_sql(x: str) -> str:
    return (f"array_to_string(list_transform({x}, lambda v: CASE WHEN regexp_matches({_last_sql('v')}, '{IMG_RE}') THEN '<image>' "
            f"WHEN regexp_matches({_last_sql('v')}, '{AUD_RE}') THEN '<audio>' ELSE v END), chr(10))")


NORMALIZED_ITEMS_SQL = f"""
WITH i AS ({cat.catalog_items_sql()})
SELECT dataset, split, count(*) AS n_items,
       count(*) FILTER (WHERE len(output) > 1) AS n_list_outputs,
       sum(length(replace(output[1], chr(10), '\\n')))::BIGINT AS first_output_chars,
       sum(length(array_to_string(list_transform(input, lambda v: replace(v, chr(10), '\\n')), '')))::BIGINT AS input_chars,
       count(*) FILTER (WHERE mcq IS NOT NULL) AS n_mcq,
       count(*) FILTER (WHERE coalesce(instruction, '') = '') AS n_no_instruction
FROM i GROUP BY dataset, split
"""


@query("normalized_items", NORMALIZED_ITEMS_SQL)
def normalized_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2 + P5: newline escaping, core-field defaults, first output."""
    from rubric.operators import prepare as P
    items = P.normalize_items(P.escape_item_newlines(cat.catalog_items(spark, sf_dir)))
    return items.groupBy("dataset", "split").agg(
        F.count("*").alias("n_items"),
        F.count_if(F.size("output") > 1).alias("n_list_outputs"),
        F.sum(F.length(P.first_output("output"))).alias("first_output_chars"),
        F.sum(F.length(F.array_join("input", ""))).alias("input_chars"),
        F.count_if(F.col("mcq").isNotNull()).alias("n_mcq"),
        F.count_if(F.col("instruction") == "").alias("n_no_instruction"))


_ESCAPED = "list_transform(input, lambda v: replace(v, chr(10), '\\n'))"
_HAS = "bool_or({}) OVER (PARTITION BY dataset, split)"

ITEM_EXPORT_SQL = f"""
WITH i AS (
  SELECT *, list_filter(input, lambda v: regexp_matches({_last_sql('v')}, '{IMG_RE}')) AS im,
         list_filter(input, lambda v: regexp_matches({_last_sql('v')}, '{AUD_RE}')) AS au,
         CASE WHEN id_order % 4 = 0 THEN 'l' || (id_order % 3)::VARCHAR END AS lv,
         CASE WHEN id_order % 6 = 0 AND instruction = 'Answer the question.' THEN 'see ' || id END AS hi
  FROM ({cat.catalog_items_sql()})),
k AS (
  SELECT *, {_HAS.format('len(im) > 0')} AS h_im, {_HAS.format('len(au) > 0')} AS h_au,
         {_HAS.format('lv IS NOT NULL')} AS h_lv, {_HAS.format('hi IS NOT NULL')} AS h_hi FROM i)
SELECT dataset, split, id, id_order AS pos,
       array_to_string(list_sort(list_filter(['id', 'input', 'output', 'instruction', 'source_link', 'difficulty', 'source',
         CASE WHEN mcq IS NOT NULL THEN 'mcq' END, CASE WHEN h_im THEN 'images' END, CASE WHEN h_au THEN 'audio' END,
         CASE WHEN h_lv THEN 'level' END, CASE WHEN h_hi THEN 'hint' END], lambda x: x IS NOT NULL)), ',') AS keys,
       md5({_render_sql(_ESCAPED)}) AS input, md5(replace(output[1], chr(10), '\\n')) AS output, coalesce(instruction, '') AS instruction,
       CASE WHEN h_im THEN CASE WHEN len(im) > 0 THEN '["' || array_to_string(im, '","') || '"]' ELSE '' END END AS images,
       CASE WHEN h_au THEN CASE WHEN len(au) > 0 THEN '["' || array_to_string(au, '","') || '"]' ELSE '' END END AS audio,
       CASE WHEN h_lv THEN coalesce(lv, '') END AS level, CASE WHEN h_hi THEN coalesce(hi, '') END AS hint
FROM k
"""


@query("item_export", ITEM_EXPORT_SQL)
def item_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + P1-P6: every item's export record, read back key by key (long texts by
    digest), with the keys that other items of its split bring along."""
    from rubric.operators import prepare as P
    items = P.normalize_items(P.escape_item_newlines(cat.catalog_item_extras(spark, sf_dir)))
    rec = P.item_records(items)
    at = lambda name: F.get_json_object("record", f"$.{name}")
    return rec.select("dataset", "split", at("id").alias("id"), "pos",
                      F.array_join(F.array_sort(F.json_object_keys("record")), ",").alias("keys"),
                      F.md5(at("input")).alias("input"), F.md5(at("output")).alias("output"),
                      *[at(c).alias(c) for c in ("instruction", "images", "audio", "level", "hint")])


_QUOTED = """CASE WHEN contains(x, '''') AND NOT contains(x, '"') THEN '"' || x || '"' ELSE '''' || replace(x, '''', '\\''') || '''' END"""
_LIST_TEXT = f"'[' || array_to_string(list_transform(gold, lambda x: {_QUOTED}), ', ') || ']'"

LIST_ANSWERS_SQL = f"""
WITH i AS (SELECT dataset, id, output AS gold, CASE WHEN id_order % 17 = 0 THEN '' ELSE
             array_to_string(list_filter(string_split(output[1], ' '), lambda w, k: (k - 1) % 3 <> 2), ' ') END AS response
           FROM ({cat.catalog_items_sql()})),
prep AS (SELECT dataset, id, {o.tokens(o.space_punct('gold[1]', diacritics=True))} AS rt,
                {o.tokens(o.space_punct('response', braces=True, diacritics=True))} AS pt FROM i),
m AS ({o.ngram_matches_sql('prep', ['dataset', 'id'], 4)}),
b AS (SELECT dataset, avg({o.bleu_from(['m.m1', 'm.m2', 'm.m3', 'm.m4'], 'len(p.rt)', 'len(p.pt)')}) FILTER (WHERE len(p.rt) > 0 AND len(p.pt) > 0) AS bleu,
             count(*) FILTER (WHERE len(p.rt) > 0 AND len(p.pt) > 0) AS n_bleu
      FROM prep p JOIN m USING (dataset, id) GROUP BY dataset),
t AS (SELECT dataset, id, response, {_LIST_TEXT} AS gold FROM i),
ans AS ({o.first_word_or_line_cte(
    f"({o.first_word_or_line_cte('t', 'gold', 'gold_x', 'dataset, id, gold, response')})",
    'response', 'resp_x', 'dataset, id, gold, response, gold_x')}),
a AS (SELECT dataset, avg(CASE WHEN g = r THEN 1.0 ELSE 0.0 END) FILTER (WHERE g <> '' AND r <> '') AS exact_accuracy,
             count(*) FILTER (WHERE g <> '' AND r <> '') AS n_accuracy
      FROM (SELECT dataset, {o.normalize_answer('gold_x')} AS g, {o.normalize_answer('resp_x')} AS r FROM ans) GROUP BY dataset),
w AS (SELECT dataset, count(*) FILTER (WHERE len(gold) = 1 AND gold[1] <> '' AND response <> '' AND {o.trim('gold[1]')} <> '') AS n_cer
      FROM i GROUP BY dataset)
SELECT dataset, round(bleu, 6) AS bleu, n_bleu, round(exact_accuracy, 6) AS exact_accuracy, n_accuracy, n_cer
FROM b JOIN a USING (dataset) JOIN w USING (dataset)
"""


@query("list_answers", LIST_ANSWERS_SQL)
def list_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics over list golds and list responses, each by its own rule."""
    scored = score_pairs(cat.catalog_answers(spark, sf_dir), ["bleu", "exact_accuracy", "cer"], keep=["dataset"])
    of = lambda m: F.avg(F.when(F.col(f"{m}.valid"), F.col(f"{m}.value")))
    n = lambda m: F.count_if(F.col(f"{m}.valid"))
    return scored.groupBy("dataset").agg(
        _r(of("bleu")).alias("bleu"), n("bleu").alias("n_bleu"), _r(of("exact_accuracy")).alias("exact_accuracy"),
        n("exact_accuracy").alias("n_accuracy"), n("cer").alias("n_cer"))


RENDERED_INPUTS_SQL = f"""
WITH i AS ({cat.catalog_items_sql()})
SELECT dataset, count(*) AS n_items, sum(length({_render_sql('input')}))::BIGINT AS rendered_chars,
       sum(len(list_filter(input, lambda v: regexp_matches({_last_sql('v')}, '{IMG_RE}'))))::BIGINT AS n_images,
       sum(len(list_filter(input, lambda v: regexp_matches({_last_sql('v')}, '{AUD_RE}'))))::BIGINT AS n_audio
FROM i GROUP BY dataset
"""


@query("rendered_inputs", RENDERED_INPUTS_SQL)
def rendered_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + P4 + P6: list inputs rendered with media placeholders."""
    from rubric.operators import prepare as P
    items = cat.catalog_items(spark, sf_dir)
    return items.groupBy("dataset").agg(
        F.count("*").alias("n_items"),
        F.sum(F.length(P.render_input("input"))).alias("rendered_chars"),
        F.sum(F.coalesce(F.size(P.media_paths("input", "image")), F.lit(0))).alias("n_images"),
        F.sum(F.coalesce(F.size(P.media_paths("input", "audio")), F.lit(0))).alias("n_audio"))


DATASET_MODALITY_SQL = f"""
WITH i AS ({cat.catalog_items_sql()})
SELECT dataset, bool_or(len(list_filter(input, lambda v: regexp_matches({_last_sql('v')}, '{IMG_RE}'))) > 0) AS has_images,
       bool_or(len(list_filter(input, lambda v: regexp_matches({_last_sql('v')}, '{AUD_RE}'))) > 0) AS has_audio
FROM i GROUP BY dataset
"""


@query("dataset_modality", DATASET_MODALITY_SQL)
def dataset_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image / audio presence per dataset."""
    from rubric.operators import prepare as P
    return P.dataset_modality(cat.catalog_items(spark, sf_dir))


PROMPT_TEMPLATES_SQL = f"""
WITH i AS ({cat.catalog_items_sql()}),
f AS (SELECT dataset, arg_min(coalesce(instruction, ''), (CASE split WHEN 'test' THEN 0 WHEN 'dev' THEN 1 ELSE 2 END, id_order)) AS ins
      FROM i GROUP BY dataset),
t AS (SELECT dataset, CASE WHEN ins <> '' AND NOT contains(ins, 'not_ins') THEN 'instruction_input' ELSE 'input' END AS template,
             ins FROM f)
SELECT i.dataset, t.template, count(*) AS n_items,
       sum(length(CASE WHEN t.template = 'instruction_input' THEN t.ins || chr(10) || {_render_sql('i.input')}
                       ELSE {_render_sql('i.input')} END))::BIGINT AS prompt_chars
FROM i JOIN t USING (dataset) GROUP BY i.dataset, t.template
"""


@query("prompt_templates", PROMPT_TEMPLATES_SQL)
def prompt_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 + P9: dataset prompt template from its first test item, applied to
    every item."""
    from rubric.operators import prepare as P
    items = cat.catalog_items(spark, sf_dir).withColumn("instruction", F.coalesce("instruction", F.lit("")))
    rendered = P.render_prompt(items, P.prompt_templates(items))
    return rendered.groupBy("dataset", "template").agg(F.count("*").alias("n_items"),
                                                       F.sum(F.length("prompt")).alias("prompt_chars"))


def _metric_list_sql(x: str) -> str:
    return f"""(CASE
      WHEN json_valid({x}) AND json_type({x}::JSON) = 'ARRAY'
        THEN list_filter(json_transform({x}::JSON, '["VARCHAR"]'), lambda m: m IS NOT NULL)
      WHEN json_valid({x}) AND json_type({x}::JSON) = 'OBJECT'
        THEN CASE WHEN json_extract_string({x}::JSON, '$.metric') IS NOT NULL THEN [json_extract_string({x}::JSON, '$.metric')] ELSE [] END
      WHEN json_valid({x}) AND json_type({x}::JSON) = 'VARCHAR' THEN [json_extract_string({x}::JSON, '$')]
      WHEN {x} IS NULL OR {x} = '' THEN []::VARCHAR[]
      ELSE [{x}] END)"""


def _resolve_sql(x: str) -> str:
    from rubric.operators.metrics import REGISTRY
    whens = " ".join(f"WHEN contains(lower({x}), '{m.lower()}') THEN '{m}'" for m in REGISTRY.names())
    return f"(CASE {whens} ELSE {x} END)"


METRIC_RESOLUTION_SQL = f"""
WITH d AS ({cat.catalog_datasets_sql()}),
m AS (SELECT *, {_metric_list_sql('metric_spec')} AS metrics FROM d),
r AS (SELECT *, list_transform(metrics, lambda x: {_resolve_sql('x')}) AS resolved FROM m)
SELECT dataset, array_to_string(metrics, ',') AS metrics, array_to_string(resolved, ',') AS resolved,
       CASE WHEN resolved[1] = 'accuracy' THEN 'mcq' ELSE 'generation' END AS kind,
       coalesce(task, CASE WHEN len(string_split(name, '_')) >= 5 THEN string_split(name, '_')[1] END, name) AS task,
       coalesce(resolved[1] NOT IN ('wer', 'cer'), true) AS higher_is_better,
       replace(concat_ws('_', coalesce(task, name), category,
                         CASE WHEN resolved[1] = 'accuracy' THEN 'mcq' ELSE 'generation' END, array_to_string(resolved, '_'))
               || '_' || substr(sha256(concat_ws('_', coalesce(task, name), category,
                         CASE WHEN resolved[1] = 'accuracy' THEN 'mcq' ELSE 'generation' END, array_to_string(resolved, '_'))), 1, 10),
               ':', '_') AS dataset_name
FROM r
"""


@query("metric_resolution", METRIC_RESOLUTION_SQL)
def metric_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 + P11 + F4 + J3 + U2 + P12 on the derived dataset catalog."""
    from rubric.operators import prepare as P
    d = cat.catalog_datasets(spark, sf_dir)
    m = d.withColumn("metrics", P.metric_list("metric_spec"))
    r = m.withColumn("resolved", F.transform("metrics", P.resolve_metric))
    kind = P.split_kind("resolved")
    task = P.assign_task(F.col("task"), F.col("name"))
    return r.select(
        "dataset",
        F.array_join("metrics", ",").alias("metrics"),
        F.array_join("resolved", ",").alias("resolved"),
        kind.alias("kind"),
        task.alias("task"),
        F.coalesce(P.metric_higher_is_better(F.get("resolved", 0)), F.lit(True)).alias("higher_is_better"),
        P.dataset_name(F.coalesce("task", "name"), F.col("category"), kind, F.col("resolved")).alias("dataset_name"),
    )


CATEGORY_GROUPS_SQL = f"""
WITH d AS ({cat.catalog_datasets_sql()}), r AS (SELECT DISTINCT category, coalesce(task, name) AS task, dataset FROM d)
SELECT category, task, dataset, count(*) OVER (PARTITION BY category, task) AS n_datasets FROM r
"""


@query("category_groups", CATEGORY_GROUPS_SQL)
def category_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + F5: datasets grouped per (category, task), one row a dataset."""
    from rubric.operators import prepare as P
    d = P.drop_empty_groups(cat.catalog_datasets(spark, sf_dir)).withColumn("task", F.coalesce("task", "name"))
    return rollup.group_by_category_task(d)


CATALOG_SELECTION_SQL = f"""
WITH d AS ({cat.catalog_datasets_sql()}),
c AS (SELECT dataset, category, CASE WHEN {_resolve_sql('m[1]')} = 'accuracy' THEN 'mcq' ELSE 'generation' END AS type
      FROM (SELECT *, {_metric_list_sql('metric_spec')} AS m FROM d)),
i AS ({cat.catalog_items_sql()})
SELECT dataset, type, bool_or(id_order % 4 = 0) AS has_level, bool_or(id_order % 6 = 0 AND instruction = 'Answer the question.') IS TRUE AS has_hint
FROM c JOIN i USING (dataset) WHERE category IN ('cat0', 'cat1') AND type = 'generation' GROUP BY dataset, type
"""


@query("catalog_selection", CATALOG_SELECTION_SQL)
def catalog_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + F1 + A7: generation datasets of two categories that have items, and the
    keys beyond the core that their items use."""
    from rubric.operators import prepare as P
    from rubric.sources.datasets import select_catalog
    d = cat.catalog_datasets(spark, sf_dir)
    kind = P.split_kind(F.transform(P.metric_list("metric_spec"), P.resolve_metric))
    catalog = d.select("dataset", "category", kind.alias("type"))
    items = cat.catalog_item_extras(spark, sf_dir)
    chosen = P.valid_datasets(select_catalog(catalog, "cat0", " generation, none").unionByName(select_catalog(catalog, "cat1")), items)
    keys = P.schema_keys(items.select(F.col("dataset"), "extras"), by=["dataset"]).groupBy("dataset").agg(
        F.bool_or(F.col("key") == "level").alias("has_level"), F.bool_or(F.col("key") == "hint").alias("has_hint"))
    has = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return chosen.join(keys, "dataset", "left").select("dataset", "type", has("has_level"), has("has_hint"))


KEY_FORMS_SQL = f"""
WITH d AS ({cat.catalog_items_sql()}),
t AS (SELECT id, dataset, coalesce(output[1], '') AS line, 'Task-' || lang || ' ' AS alias FROM d JOIN (SELECT doc_id::VARCHAR AS id, lang FROM documents) USING (id))
SELECT id, md5(translate(substr({o.trim("replace(lower(nfc_normalize(line)), chr(0), '')")}, 1, 255), ' ./', '___')) AS key,
       md5(translate(lower({o.trim('line')}), ' -', '__')) AS clean, 'language ' || substr(alias, 6, 2) AS task
FROM t
"""


@query("key_forms", KEY_FORMS_SQL)
def key_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 + P14 + P15: normalised keys and sanitised texts of first lines (by digest),
    and tasks by alias."""
    from rubric.functions.text import sanitize_text
    from rubric.operators import prepare as P
    lang = fx.table(spark, sf_dir, "documents", "doc_id", "lang").select(F.col("doc_id").cast("string").alias("id"), "lang")
    lines = cat.catalog_items(spark, sf_dir).select("id", F.coalesce(F.get("output", 0), F.lit("")).alias("line")).join(lang, "id")
    aliased = lines.select("id", "line", F.concat(F.lit("Task-"), "lang", F.lit(" ")).alias("alias"))
    mapping = lang.select(F.concat(F.lit("task "), "lang").alias("alias"), F.concat(F.lit("language "), "lang").alias("task")).distinct()
    mapped = P.map_alias(aliased, mapping, "alias")
    keyed = P.normalize_keys(mapped, "line")
    return keyed.select("id", F.md5("key").alias("key"), F.md5(sanitize_text("line")).alias("clean"), "task")
