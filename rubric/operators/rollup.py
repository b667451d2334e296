"""Roll-ups: sample -> task -> category / model.

All are hash aggregates, so Spark combines map-side before the shuffle: each
task sends at most one partial row per group, and a hot group never lands on
one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubric.operators.metrics import REGISTRY, ROUGE_PARTS  # noqa: F401


def empty_default(metric: Column) -> Column:
    """Task value when no sample of the task is valid: 1.0 for error rates."""
    ones = [m for m in REGISTRY.names() if REGISTRY.get(m).empty_value == 1.0]
    return F.when(metric.isin(*ones), F.lit(1.0)).otherwise(F.lit(0.0))


def higher_is_better(metric: Column) -> Column:
    lower = [m for m in REGISTRY.names() if not REGISTRY.get(m).higher_is_better]
    return ~metric.isin(*lower)


def task_metric(long_scores: DataFrame, keys: list[str]) -> DataFrame:
    """A1: macro mean of valid per-sample values per (keys, metric).

    Input columns: keys..., metric, value, valid.  Output: keys..., metric,
    value, n_samples (valid ones), higher_is_better.
    """
    agg = long_scores.groupBy(*keys, "metric").agg(
        F.avg(F.when(F.col("valid"), F.col("value"))).alias("_mean"),
        F.count_if(F.col("valid")).alias("n_samples"),
    )
    return agg.select(
        *keys, "metric",
        F.coalesce(F.col("_mean"), empty_default(F.col("metric"))).alias("value"),
        "n_samples",
        higher_is_better(F.col("metric")).alias("higher_is_better"),
    )


def average_scores(task_results: DataFrame, keys: list[str], digits: int = 4) -> DataFrame:
    """A4: unweighted mean over tasks per (keys, metric), rounded; with the
    number of tasks and the task minimum / maximum.  A ROUGE task contributes
    as ``rouge``, by its rougeLsum alone."""
    one = task_results.withColumn("metric", representative_metric(F.col("metric"))).where(F.col("metric").isNotNull())
    return one.groupBy(*keys, "metric").agg(
        F.round(F.avg("value"), digits).alias("average_score"),
        F.count("*").alias("n_tasks"),
        F.min("value").alias("min_score"),
        F.max("value").alias("max_score"),
    )


def representative_metric(metric: Column) -> Column:
    """A4 for dict-valued results: a ROUGE task contributes its rougeLsum only."""
    return F.when(metric == "rougeLsum", F.lit("rouge")).when(metric.isin(*ROUGE_PARTS), F.lit(None)).otherwise(metric)


#: Names of a final record's scores, in order.
FINAL_SCORES = ("nGramScore", "mcqScore", "llmAsJudgeScore", "MCQllmAsJudgeScore")


def final_scores(task_results: DataFrame, keys: list[str]) -> DataFrame:
    """A5: wide record per task and the same as ``record``, a map that holds only the
    scores the task has.

    * nGramScore: ROUGE when the task has any (its rougeLsum, 0 if that part is
      missing, or a ROUGE of one number), else BLEU;
    * mcqScore: accuracy;
    * llmAsJudgeScore, MCQllmAsJudgeScore: the judge's summary (``llm_as_judge``,
      ``mcq_llm_as_judge``; 0 when it has no average), else the numeric score
      (``llm_judge_score``, ``mcq_llm_judge_score``) if it is a number.

    Input: keys..., metric, value.  A score the task lacks is null in its column
    and no key of the record; error rates and fuzzy accuracy are not exported.
    """
    def of(name: str) -> Column:
        return F.max(F.when(F.col("metric") == name, F.col("value")))

    def has(*names: str) -> Column:
        return F.bool_or(F.col("metric").isin(*names))

    wide = task_results.groupBy(*keys).agg(
        F.when(has("rouge", *ROUGE_PARTS), F.coalesce(of("rougeLsum"), of("rouge"), F.lit(0.0))).otherwise(of("bleu")).alias("nGramScore"),
        of("accuracy").alias("mcqScore"),
        F.when(has("llm_as_judge"), F.coalesce(of("llm_as_judge"), F.lit(0.0))).otherwise(of("llm_judge_score")).alias("llmAsJudgeScore"),
        F.when(has("mcq_llm_as_judge"), F.coalesce(of("mcq_llm_as_judge"), F.lit(0.0)))
         .otherwise(of("mcq_llm_judge_score")).alias("MCQllmAsJudgeScore"),
        F.array(has("rouge", "bleu", *ROUGE_PARTS), has("accuracy"), F.lit(None).cast("boolean"), F.lit(None).cast("boolean")).alias("_named"))
    # n-gram and accuracy entries exist even without a value, judge entries only with one
    entries = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value"),
                                 F.coalesce(F.get("_named", k), F.col(n).isNotNull()).alias("has")) for k, n in enumerate(FINAL_SCORES)])
    present = F.transform(F.filter(entries, lambda e: e["has"]), lambda e: F.struct(e["key"], e["value"]))
    return wide.select(*keys, *FINAL_SCORES, F.map_from_entries(present).alias("record"))


def group_by_category_task(catalog: DataFrame) -> DataFrame:
    """One row a dataset of each (category, task), with the group's number of
    datasets; rows without category dropped.  Groups are never gathered: the counts are
    an aggregate, joined back by group."""
    rows = catalog.filter(F.col("category").isNotNull() & (F.col("category") != "")).select("category", "task", "dataset").distinct()
    counts = rows.groupBy("category", "task").agg(F.count("*").alias("n_datasets"))
    same = F.col("r.category").eqNullSafe(F.col("c.category")) & F.col("r.task").eqNullSafe(F.col("c.task"))
    return rows.alias("r").join(counts.alias("c"), same).select("r.category", "r.task", "r.dataset", "n_datasets")


AGGREGATES = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min, "median": F.median}


def custom_task_metric(long_scores: DataFrame, keys: list[str], aggregation: str = "mean",
                       empty_value: float = 0.0) -> DataFrame:
    """Aggregate a user metric's per-sample values with a named Spark
    aggregate (partial aggregation keeps hot tasks off a single task).  A
    whole-list Python aggregate is deliberately not offered: it would gather
    every sample of a task into one worker call."""
    agg = AGGREGATES[aggregation]
    out = long_scores.groupBy(*keys, "metric").agg(
        agg(F.when(F.col("valid"), F.col("value"))).alias("_v"), F.count_if(F.col("valid")).alias("n_samples"))
    return out.select(*keys, "metric", F.coalesce(F.col("_v"), F.lit(empty_value)).alias("value"), "n_samples")
