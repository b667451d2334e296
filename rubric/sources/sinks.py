"""Writers (S9, S10, S11, S13).  All are DataFrame writes: each task writes its own
files, nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rubric.operators.judge import batch_statistics
from rubric.operators.prepare import escape_item_newlines, item_records, normalize_items
from rubric.operators.rollup import representative_metric


def write_split_export(items: DataFrame, out: str, mode: str = "overwrite", manifest: DataFrame | None = None) -> None:
    """One JSON object a line for each item, one folder per dataset and split, in
    the items' order within a split's files (which sort by name).

    Newlines are escaped, missing keys have their defaults, inputs are rendered, media
    listed (see ``item_records``)."""
    records = item_records(normalize_items(escape_item_newlines(items)), manifest)
    place = ["dataset", "split", "pos"]
    (records.repartitionByRange(*place).sortWithinPartitions(*place).select("dataset", "split", F.col("record").alias("value"))
     .write.mode(mode).partitionBy("dataset", "split").text(out))


def results_with_averages(task_results: DataFrame, keys: list[str], digits: int = 4) -> DataFrame:
    """Task results and their averages from one pass: ``grain`` is ``results`` (a row
    a task and metric) or ``average_scores`` (a row a metric: mean over the tasks,
    rounded, with number of tasks, minimum and maximum).

    Grouping sets give both grains from one aggregate.  ROUGE counts in the averages
    as ``rouge``, by its rougeLsum alone."""
    rows = task_results.select(*keys, "task", "metric", F.col("value").cast("double").alias("value"),
                               representative_metric(F.col("metric")).alias("average_of"))
    columns = [*map(F.col, keys), F.col("task"), F.col("metric"), F.col("average_of")]
    per_task, per_metric = columns, [*columns[:len(keys)], columns[-1]]
    both = rows.groupingSets([per_task, per_metric], *columns).agg(
        F.grouping("task").alias("averaged"), F.avg("value").alias("value"), F.count("value").alias("n_tasks"),
        F.min("value").alias("min_score"), F.max("value").alias("max_score"))
    averaged = F.col("averaged") == 1
    of_average = lambda c: F.when(averaged, F.col(c))
    return both.where(~averaged | F.col("average_of").isNotNull()).select(
        F.when(averaged, F.lit("average_scores")).otherwise(F.lit("results")).alias("grain"), *keys, "task",
        F.when(averaged, F.col("average_of")).otherwise(F.col("metric")).alias("metric"),
        F.when(averaged, F.round("value", digits)).otherwise(F.col("value")).alias("value"),
        of_average("n_tasks").alias("n_tasks"), of_average("min_score").alias("min_score"), of_average("max_score").alias("max_score"))


def write_results(task_results: DataFrame, out: str, keys: tuple[str, ...] = ("category",), fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Results and average scores of each of ``keys`` as two folders of one
    output, ``grain=results`` and ``grain=average_scores``."""
    both = results_with_averages(task_results, list(keys))
    both.write.mode(mode).partitionBy("grain", *keys).format(fmt).save(out)


def write_judge_results(samples: DataFrame, out: str, threshold: float = 0.7, mode: str = "overwrite") -> None:
    """Judged samples as JSON lines and, beside them in ``_batch_statistics``
    (which readers of ``out`` pass over), their batch statistics (G6).

    The statistics read the samples back as written, so judging runs once.  Rows
    without score, raw_score and valid have none."""
    samples.write.mode(mode).json(out)
    if {"score", "raw_score", "valid"} <= set(samples.columns):
        written = samples.sparkSession.read.schema(samples.schema).json(out)
        batch_statistics(written, threshold).coalesce(1).write.mode(mode).json(f"{out}/_batch_statistics")


def write_payloads(payloads: DataFrame, out: str, mode: str = "overwrite") -> None:
    """S11 sink: one JSON text line per task payload."""
    payloads.select(F.col("payload").alias("value")).write.mode(mode).text(out)
