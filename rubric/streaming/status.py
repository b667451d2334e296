"""Job status log as a stream (S12 incremental).

Status events (job_id, ts, event_id, status, error) land as files in a
folder while jobs run.  ``latest_status_stream`` keeps the current state of
every job with the same ``max_by`` aggregate as the batch operator, in
update mode: each micro-batch only touches the jobs it saw, and the state
store holds one row per job (checkpointed to the shared checkpoint folder,
so a restarted query resumes where it stopped).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rubric.operators.jobs import latest_status
from rubric.session import ensure_checkpoint_dir

STATUS_SCHEMA = "job_id bigint, ts timestamp, event_id bigint, status string, error string"


def status_events(spark: SparkSession, folder: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(STATUS_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def latest_status_stream(events: DataFrame) -> DataFrame:
    return latest_status(events)


def start_status_tracker(spark: SparkSession, folder: str, out: str, name: str = "job_status",
                         available_now: bool = False) -> StreamingQuery:
    """Run the tracker into the folder ``out``: each micro-batch writes the jobs it saw
    to its own ``batch=`` folder, and anew if it is repeated.  The checkpoint goes under
    the session's shared checkpoint folder; see ``current_status``."""
    def save(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}"
    writer = (latest_status_stream(status_events(spark, folder)).writeStream
              .outputMode("update").foreachBatch(save).option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def current_status(spark: SparkSession, out: str) -> DataFrame:
    """Status of every job as of the last batch that saw it."""
    state = F.max_by(F.struct("status", "error", "n_events"), F.col("batch")).alias("s")
    return spark.read.parquet(out).groupBy("job_id").agg(state).select("job_id", "s.*")
