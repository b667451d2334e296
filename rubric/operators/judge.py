"""Judge-model verdicts as tables.

Raw judge replies arrive as rows ``(sample keys..., judge, attempt, raw)``; no
model is called here.  The plan is:

parse (T11, narrow) -> first valid attempt per (sample, judge) (G1, hash
aggregate with map-side combine) -> normalise (G2/G3) -> aggregate judges per
sample (G5) -> task / overall / batch statistics (A2, A3, G6).

Null rules of the evaluated system are kept: an unparseable judge counts 0 in
the normalised mean but is left out of the raw mean; a sample with no raw
score at all (or a numeric *string* score, whose raw mean cannot be formed)
drops out of every average.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rubric.functions.text import normalize_mcq_answer, trim_ws

# Attempts, section tags of a prompt, texts that results carry.
MAX_ATTEMPTS = 3
SECTIONS = {"question": ("[PROMPT]", "[/PROMPT]"), "context": ("[CONTEXT]", "[/CONTEXT]"),
            "reference": ("[GROUND TRUTH]", "[/GROUND TRUTH]"), "answer": ("[GENERATED OUTPUT]", "[/GENERATED OUTPUT]")}
NO_VERDICT = "Error: Unable to parse a valid response after retries"
EXPLANATION_LEAD = "Aggregated ({method}) score: "

#: Equal-width bins in which a median's place is looked up.
MEDIAN_BINS = 4096
NUMERIC_KINDS = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "BOOLEAN")

# Rubric texts of this library (own wording).
GENERATIVE_RUBRIC = (
    "You grade a generated answer against a ground-truth answer. Score 0 (wrong or "
    "irrelevant), 1 (partly right), 2 (mostly right) or 3 (fully right). Reply only with "
    'JSON: {"score": <0-3>, "explanation": "<one sentence>"}.'
)
MCQ_RUBRIC = (
    "You check a multiple-choice answer against the correct option. Score 1 when the "
    "answer selects the correct option (letter or text), else 0. Reply only with JSON: "
    '{"score": <0 or 1>, "explanation": "<one sentence>"}.'
)


def judge_prompt(question: Column, reference: Column, answer: Column, context: Column | None = None,
                 rubric: str = GENERATIVE_RUBRIC) -> Column:
    """Rubric + tagged sections; the context section only when non-empty."""
    def section(name: str, text: Column) -> Column:
        start, end = SECTIONS[name]
        return F.concat(F.lit(f"{start}\n"), text, F.lit(f"\n{end}"))

    parts = [F.lit(rubric + "\n\n"), section("question", question), F.lit("\n")]
    if context is not None:
        parts.append(F.when(F.coalesce(context, F.lit("")) != "", F.concat(F.lit("\n"), section("context", context), F.lit("\n")))
                     .otherwise(F.lit("")))
    return F.concat(*parts, section("reference", reference), F.lit("\n"), section("answer", answer))


def parse_verdict(raw: Column) -> Column:
    """Strip code fences, parse JSON; valid when both ``score`` and
    ``explanation`` keys are present (a null value still counts).

    Returns struct(valid, kind, score, explanation) where ``kind`` is the JSON
    type of the score and ``score`` its numeric value when it has one.
    """
    cleaned = trim_ws(F.replace(F.replace(trim_ws(F.coalesce(raw, F.lit(""))), F.lit("```json"), F.lit("")),
                                F.lit("```"), F.lit("")))
    v = F.try_parse_json(cleaned)
    score_v = F.variant_get(v, "$.score", "variant")
    expl_v = F.variant_get(v, "$.explanation", "variant")
    valid = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)) & score_v.isNotNull() & expl_v.isNotNull()
    return F.struct(
        valid.alias("valid"),
        F.schema_of_variant(score_v).alias("kind"),
        F.try_variant_get(v, "$.score", "double").alias("score"),
        F.try_variant_get(v, "$.explanation", "string").alias("explanation"),
    )


def first_valid_verdict(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """G1: per (keys..., judge) the first attempt (<= 3) that parses.

    ``attempts``: keys..., judge, attempt, raw.  Groups without any valid
    attempt keep a null score and the fixed failure explanation.
    """
    parsed = attempts.filter(F.col("attempt") <= MAX_ATTEMPTS).select(
        *keys, "judge", "attempt", parse_verdict(F.col("raw")).alias("v"))
    first = parsed.groupBy(*keys, "judge").agg(
        F.min_by(F.col("v"), F.when(F.col("v.valid"), F.col("attempt"))).alias("v"),
        F.min(F.when(F.col("v.valid"), F.col("attempt"))).alias("attempt"),
    )
    found = F.col("attempt").isNotNull()
    return first.select(
        *keys, "judge",
        F.when(found, F.col("attempt")).alias("attempt"),
        F.when(found, F.col("v.kind")).alias("kind"),
        F.when(found, F.col("v.score")).alias("raw_value"),
        F.when(found, F.coalesce(F.col("v.explanation"), F.lit("None"))).otherwise(F.lit(NO_VERDICT)).alias("explanation"),
    )


def normalize_generative(raw: Column) -> Column:
    """0-3 scale to 0-1, rounded to 5 digits, not clamped; null -> 0."""
    return F.when(raw.isNull(), F.lit(0.0)).otherwise(F.round(raw / 3.0, 5))


def normalize_mcq(raw: Column) -> Column:
    """Clamp to [0, 1]; null -> 0."""
    return F.when(raw.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))


def judge_scores(verdicts: DataFrame, keys: list[str], mcq: bool = False, threshold: float = 0.5) -> DataFrame:
    """Per-judge normalised score, raw score and pass flag.

    * no verdict: score 0, raw null;
    * numeric score: normalised, raw = the number;
    * numeric string: normalised, but flagged ``raw_unusable`` (its raw mean
      fails, so the sample drops out);
    * any other value: score 0 and raw 0.
    """
    kind = F.col("kind")
    numeric = kind.isin(*NUMERIC_KINDS) | kind.startswith("DECIMAL")
    num_string = (kind == "STRING") & F.col("raw_value").isNotNull()
    has_number = numeric | num_string
    norm = normalize_mcq if mcq else normalize_generative
    score = F.when(kind.isNull() | (kind == "VOID"), F.lit(0.0)) \
        .when(has_number, norm(F.col("raw_value"))).otherwise(F.lit(0.0))
    raw = F.when(kind.isNull() | (kind == "VOID"), F.lit(None).cast("double")) \
        .when(numeric, F.col("raw_value")).when(num_string, F.lit(None).cast("double")).otherwise(F.lit(0.0))
    return verdicts.select(
        *keys, "judge", "attempt", "explanation",
        score.alias("score"), raw.alias("raw_score"),
        num_string.alias("raw_unusable"),
        (score >= threshold).alias("passed"),
    )


def aggregate_judges(scores: DataFrame, keys: list[str], method: str = "mean",
                     threshold: float = 0.5) -> DataFrame:
    """Combine judges per sample (mean or median of normalised and raw).

    ``valid`` is false when no judge has a raw score, or one has an unusable
    raw string: such a sample ends with null scores.
    """
    agg = F.median if method == "median" else F.avg
    per = scores.groupBy(*keys).agg(
        agg("score").alias("_score"),
        agg("raw_score").alias("_raw"),
        F.count("raw_score").alias("_n_raw"),
        F.bool_or("raw_unusable").alias("_bad"),
        F.count("*").alias("n_judges"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("judge", "explanation"))),
                                 lambda e: F.concat(e["judge"], F.lit(": "), e["explanation"])), "; ").alias("_expl"),
    )
    valid = (F.col("_n_raw") > 0) & ~F.col("_bad")
    return per.select(
        *keys, "n_judges",
        F.when(valid, F.col("_score")).alias("score"),
        F.when(valid, F.col("_raw")).alias("raw_score"),
        F.when(valid, F.col("_score") >= threshold).alias("passed"),
        F.concat(F.lit(EXPLANATION_LEAD.format(method=method)), F.format_number(F.col("_score"), 4),
                 F.lit(". "), F.col("_expl")).alias("explanation"),
        valid.alias("valid"),
    )


def taskwise(samples: DataFrame, task_col: str = "task", prefix: str = "") -> DataFrame:
    """A2: per task mean score and mean raw (4 digits), zero stderr, count."""
    ok = samples.filter(F.col("valid"))
    return ok.groupBy(task_col).agg(
        F.round(F.avg("score"), 4).alias(f"{prefix}llm_judge_score"),
        F.round(F.avg("raw_score"), 4).alias(f"{prefix}llm_judge_score_raw"),
        F.lit(0.0).alias(f"{prefix}llm_judge_score_stderr"),
        F.count("*").alias("num_samples"),
    )


def overall(samples: DataFrame) -> DataFrame:
    """A3: count, mean (4 digits), min and max of score and raw over all samples."""
    ok = samples.filter(F.col("valid"))
    return ok.agg(
        F.count("*").alias("total_samples"),
        F.round(F.avg("score"), 4).alias("average_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.round(F.avg("raw_score"), 4).alias("average_score_raw"),
        F.min("raw_score").alias("min_score_raw"),
        F.max("raw_score").alias("max_score_raw"),
    )


def _medians(counts: DataFrame) -> DataFrame:
    """(measure, median) from rows (measure, value, n) of distinct values.

    No task orders all values: they fall into ``MEDIAN_BINS`` equal-width bins,
    bin sums show where the middle ranks lie, and only those bins are ordered.
    """
    known = counts.filter(F.col("value").isNotNull())
    bounds = known.groupBy("measure").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("total"))
    at = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * MEDIAN_BINS)
    binned = known.join(bounds, "measure").select(
        "measure", "value", "n", F.floor((F.col("total") + 1) / 2).alias("first"), (F.floor(F.col("total") / 2) + 1).alias("second"),
        F.when(F.col("high") > F.col("low"), F.least(at, F.lit(MEDIAN_BINS - 1))).otherwise(0).alias("bin"))
    sums = binned.groupBy("measure", "bin", "first", "second").agg(F.sum("n").alias("in_bin"))
    upto = F.sum("in_bin").over(Window.partitionBy("measure").orderBy("bin"))
    middle = (sums.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("in_bin"))
              .filter(((F.col("before") < F.col("first")) & (F.col("upto") >= F.col("first")))
                      | ((F.col("before") < F.col("second")) & (F.col("upto") >= F.col("second"))))
              .select("measure", "bin", "before"))
    running = F.col("before") + F.sum("n").over(Window.partitionBy("measure", "bin").orderBy("value"))
    ranked = binned.join(middle, ["measure", "bin"]).withColumn("rank", running)
    pick = lambda r: F.min(F.when(F.col("rank") >= F.col(r), F.col("value")))
    return ranked.groupBy("measure").agg(((pick("first") + pick("second")) / 2).alias("median"))


def batch_statistics(samples: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Count, mean / exact median of score and raw, pass rate."""
    measures = F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in ("score", "raw_score")]))
    counts = (samples.filter(F.col("valid")).select(measures.alias("m")).select("m.*")
              .groupBy("measure", "value").agg(F.count("*").alias("n")))
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    passed = F.when(F.col("value") >= threshold, F.col("n")).otherwise(0)
    per_measure = counts.groupBy("measure").agg(
        F.sum("n").alias("rows"), (F.sum(F.col("value") * F.col("n")) / F.sum(known)).alias("mean"),
        (F.sum(passed) / F.sum(known)).alias("passed"))
    stats = per_measure.join(_medians(counts), "measure", "left")
    of = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c)))
    return stats.agg(
        F.coalesce(of("score", "rows"), F.lit(0)).cast("long").alias("total_test_cases"),
        of("score", "mean").alias("average_score"),
        of("score", "median").alias("median_score"),
        of("raw_score", "mean").alias("average_raw_score"),
        of("raw_score", "median").alias("median_raw_score"),
        F.coalesce(of("score", "passed"), F.lit(0.0)).alias("pass_rate"),
    )


def judgeable(samples: DataFrame, expected: str, response: str, mcq_col: str | None = None,
              tasks: DataFrame | None = None) -> DataFrame:
    """F3 (+ T6 for multiple choice): keep the samples of the allowed tasks whose
    expected and response are both non-empty.

    ``tasks`` (column task) is the allow-list, null for all.  A response given as a
    list counts by its first entry, an empty list is no response.  With ``mcq_col``,
    answers are turned into option texts before they are tested.
    """
    if tasks is not None:
        samples = samples.join(tasks.select("task"), "task", "left_semi")
    if dict(samples.dtypes)[response].startswith("array"):
        samples = samples.withColumn(response, F.get(F.col(response), 0))
    if mcq_col:
        # a lambda binds the answer, so that the rule's many uses of it evaluate it once
        option = lambda c: F.get(F.transform(F.array(c), lambda x: normalize_mcq_answer(x, F.col(mcq_col))), F.lit(0))
        samples = samples.withColumns({expected: option(expected), response: option(response)})
    return samples.filter((F.coalesce(F.col(expected), F.lit("")) != "")
                          & (F.coalesce(F.col(response), F.lit("")) != ""))


# ---------------------------------------------------------------------------
# The judge pipeline, from samples to judged samples
# ---------------------------------------------------------------------------

def judge_requests(samples: DataFrame, keys: list[str], mcq: bool = False, tasks: DataFrame | None = None,
                   question: str = "question", expected: str = "gold", response: str = "response",
                   mcq_col: str = "mcq") -> DataFrame:
    """F3 -> T6 -> T10: ``keys``, prompt_key and prompt of every sample to judge.

    The question is the sample's input alone: no instruction, no context."""
    ready = judgeable(samples, expected, response, mcq_col if mcq else None, tasks)
    prompt = judge_prompt(F.coalesce(F.col(question), F.lit("")), F.col(expected), F.col(response),
                          rubric=MCQ_RUBRIC if mcq else GENERATIVE_RUBRIC)
    return ready.select(*keys, prompt.alias("prompt")).select(*keys, F.md5("prompt").alias("prompt_key"), "prompt")


def distinct_prompts(requests: DataFrame) -> DataFrame:
    """What the judges are asked: each prompt once, however many samples share it."""
    return requests.groupBy("prompt_key").agg(F.min("prompt").alias("prompt"))


def judge_pipeline(requests: DataFrame, replies: DataFrame, keys: list[str], mcq: bool = False,
                   method: str = "mean", threshold: float = 0.5) -> DataFrame:
    """``requests`` with the judges' aggregate of the ``replies`` to their prompts.

    ``replies``: prompt_key, judge, attempt, raw.  G1, G2/G3 and G5 run once a
    prompt; the samples take the result by prompt key.  A sample whose prompt has no
    reply at all is not valid, like one that no judge could be parsed for.
    """
    prompt = ["prompt_key"]
    scores = judge_scores(first_valid_verdict(replies, prompt), prompt, mcq=mcq, threshold=threshold)
    judged = aggregate_judges(scores, prompt, method=method, threshold=threshold)
    return (requests.select(*keys, "prompt_key").join(judged, "prompt_key", "left")
            .select(*keys, "prompt_key", "n_judges", "score", "raw_score", "passed", "explanation",
                    F.coalesce("valid", F.lit(False)).alias("valid")))


# ---------------------------------------------------------------------------
# Test cases
# ---------------------------------------------------------------------------

#: Fields of a test case and the names under which the shapes carry them.
CASE_FIELDS = {"question": ("question", "input"), "reference_answer": ("reference_answer", "expected_output"),
               "given_answer": ("given_answer", "actual_output")}


def normalise_variant_cases(cases: DataFrame, column: str = "case") -> DataFrame:
    """G8 on VARIANT test cases of any shape, told apart by their keys row by row:

    * judge record: question, reference_answer, given_answer, context;
    * evaluation record: input, expected_output, actual_output, context as a list;
    * either of them nested one level down under ``test_case``.

    Returns the other columns and id, question, reference_answer, given_answer
    (null or absent: ""), context (a list joined by newlines; null when absent or
    empty), metadata (JSON text).  Anything but a record stops the job.
    """
    whole = F.col(column)
    body = F.coalesce(F.variant_get(whole, "$.test_case", "variant"), whole)

    def get(path: str, kind: str = "string") -> Column:
        return F.try_variant_get(F.col("_body"), f"$.{path}", kind)

    is_record = F.coalesce(F.schema_of_variant(F.col("_body")).startswith("OBJECT"), F.lit(False))
    no_case = F.raise_error(F.concat(F.lit("not a test case: "), F.coalesce(F.to_json("_body"), F.lit("null"))))
    fields = {out: F.coalesce(*[get(n) for n in names], F.lit("")) for out, names in CASE_FIELDS.items()}
    fields["question"] = F.when(is_record, fields["question"]).otherwise(no_case)
    context = F.variant_get(F.col("_body"), "$.context", "variant")
    joined = F.when(F.schema_of_variant(context).startswith("ARRAY"), F.array_join(get("context", "array<string>"), "\n")) \
              .otherwise(get("context"))
    rest = [c for c in cases.columns if c != column]
    return cases.select(*rest, body.alias("_body")).select(
        *rest, get("id").alias("id"), *[c.alias(n) for n, c in fields.items()], F.nullif(joined, F.lit("")).alias("context"),
        F.to_json(F.variant_get(F.col("_body"), "$.metadata", "variant")).alias("metadata"))


def normalise_test_cases(df: DataFrame) -> DataFrame:
    """One test-case shape: list context joined by newline, nulls -> ""."""
    cols = {c: F.coalesce(F.col(c).cast("string"), F.lit(""))
            for c in ("question", "reference_answer", "given_answer") if c in df.columns}
    if "context" in df.columns:
        ctx = F.col("context")
        cols["context"] = ctx if dict(df.dtypes)["context"] == "string" else F.array_join(ctx, "\n")
        cols["context"] = F.coalesce(cols["context"], F.lit(""))
    return df.select(*[c for c in df.columns if c not in cols], *[v.alias(k) for k, v in cols.items()])
