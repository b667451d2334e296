"""Job lifecycle log (S12), failure triage (T12) and result payloads.

The status log is an append-only table ``(job_id, ts, event_id, status,
error)``; the current state of a job is its latest row (ties on ``ts``
broken by ``event_id``), found with ``max_by`` in a hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rubric.functions.text import error_payload

STATUSES = ["starting", "running", "completed", "failed"]


def latest_status(log: DataFrame, key: str = "job_id") -> DataFrame:
    """Latest status per job, its error text ("" when none), event count."""
    latest = F.max_by(F.struct("status", "error"), F.struct("ts", "event_id"))
    return log.groupBy(key).agg(latest.alias("_l"), F.count("*").alias("n_events")).select(
        key, F.col("_l.status").alias("status"), F.coalesce(F.col("_l.error"), F.lit("")).alias("error"),
        "n_events")


def check_status(log: DataFrame) -> DataFrame:
    """Fail the job when a status outside the lifecycle appears."""
    return log.withColumn("status", F.when(F.col("status").isin(*STATUSES), F.col("status"))
                          .otherwise(F.raise_error(F.concat(F.lit("unknown status: "), F.col("status")))))


def failure_payloads(log: DataFrame) -> DataFrame:
    """T12 per failed event: the error object as JSON text."""
    failed = log.filter(F.col("status") == "failed")
    return failed.withColumn("payload", error_payload(F.col("error")))


def result_payloads(task_results: DataFrame, keys: tuple[str, ...] | list[str] = ("task", "category"), scores: DataFrame | None = None,
                    score_keys: list[str] | None = None, job_id: str | None = None, benchmark: str | None = None) -> DataFrame:
    """One JSON record per task and model with its metric results and scores.

    ``task_results``: keys (among them task), metric, value.  Rows without a
    task id are skipped.  Without ``job_id``, each row's model names its job.  Metric keys follow the "<metric>,none"
    convention; ROUGE is one entry whose value is the object of its parts.
    ``scores`` holds the final record of each of ``score_keys`` (its ``record`` map,
    so that scores a task lacks are no keys).
    """
    rows = task_results.filter(F.col("task").isNotNull())
    part = F.col("metric").startswith("rouge") & (F.col("metric") != "rouge")
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    entry = lambda name, x: F.concat(quoted(name), F.lit(": "), F.coalesce(x.cast("string"), F.lit("null")))
    joined = lambda xs: F.array_join(F.array_sort(F.collect_list(xs)), ", ")
    plain = joined(F.when(~part, entry(F.concat("metric", F.lit(",none")), F.col("value"))))
    rouge = joined(F.when(part, entry(F.col("metric"), F.col("value"))))
    per_task = rows.groupBy(*keys).agg(plain.alias("_plain"), rouge.alias("_rouge"))
    rouge = F.when(F.col("_rouge") != "", F.concat(F.lit('"rouge,none": {'), F.col("_rouge"), F.lit("}")))
    results = F.parse_json(F.concat(F.lit("{"), F.concat_ws(", ", F.nullif(F.col("_plain"), F.lit("")), rouge), F.lit("}")))
    per_task = per_task.select(*keys, results.alias("results"))
    if scores is not None:
        fields = [c for c in scores.columns if c not in score_keys]
        final = F.col("record") if "record" in fields else F.struct(*fields)
        per_task = per_task.join(scores.select(*score_keys, final.alias("scores")), score_keys, "left")
    body = F.struct(
        (F.lit(job_id) if job_id else F.concat(F.lit("job-"), "model")).alias("job_id"), F.col("task").alias("task_id"), F.col("results"),
        *([F.col("scores")] if scores is not None else []),
        F.lit("completed").alias("status"), F.col("category"),
        F.lit(benchmark).cast("string").alias("benchmark"))
    return per_task.select(*keys, F.to_json(body).alias("payload"))
