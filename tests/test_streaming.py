"""Streaming status tracker: two batches of events, latest state per job."""

from rubric.plans import fixtures as fx
from rubric.streaming.status import current_status, start_status_tracker
from conftest import SF_SMALL


def test_status_tracker_matches_batch(spark, tmp_path):
    from rubric.operators.jobs import latest_status
    events = fx.job_events(spark, SF_SMALL)
    folder = str(tmp_path / "events")
    # two arrivals: earlier and later halves of the log
    events.filter("event_id % 2 = 0").write.parquet(folder + "/part=a")
    events.filter("event_id % 2 = 1").write.parquet(folder + "/part=b")
    import uuid
    out = str(tmp_path / "state")
    q = start_status_tracker(spark, folder, out, name=f"test-{uuid.uuid4().hex}", available_now=True)
    q.awaitTermination(120)
    state = lambda df: {r["job_id"]: (r["status"], r["error"], r["n_events"]) for r in df.collect()}
    assert state(current_status(spark, out)) == state(latest_status(events))
