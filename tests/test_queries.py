"""Every registered query: runs on the smallest tables, matches its DuckDB
oracle where one exists, and the rows-only ones match brute force."""

import math

import brute
import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 4)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["model", "metric", "average_score", "n_tasks", "min_score", "max_score"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon(df.columns, got) == _canon(rel.columns, rel.fetchall())


def test_rows_only_queries_run(spark, duck):
    """Queries without SQL return a row for each row of their table, or more."""
    n = {t: duck.sql(f"SELECT count(*) FROM {t}").fetchone()[0] for t in TABLES}
    least = {"op6_projection_forest": n["embeddings"] // 20, "op8_license_scans": 1, "op11_conversation_repair": 1, "op13_embedding_whitening": n["embeddings"], "pipeline": 1}
    for name in set(entry.queries()) - set(entry.oracle_sql()):
        assert entry.queries()[name](spark, SF_SMALL).count() >= least.get(name, n["documents"]), name


def test_wer_by_task_brute(spark, duck):
    from rubric.plans.oracle import conversation_pairs_sql
    pairs = duck.sql(conversation_pairs_sql()).fetchall()
    cols = duck.sql(conversation_pairs_sql()).columns
    acc = {}
    for r in pairs:
        d = dict(zip(cols, r))
        from rubric.functions import text  # noqa: F401
        pred = d["response"].strip()
        v = brute.wer(d["gold"], pred)
        if v is not None:
            acc.setdefault((d["model"], d["task"]), []).append(v)
    got = {(r.model, r.task): r.wer for r in entry.queries()["wer_by_task"](spark, SF_SMALL).collect()}
    for k, v in acc.items():
        assert math.isclose(got[k], round(sum(v) / len(v), 6), abs_tol=1e-6), k


def test_rouge_lsum_brute(spark, duck):
    from rubric.plans.oracle import passage_pairs_sql
    rel = duck.sql(passage_pairs_sql())
    acc = {}
    for r in rel.fetchall():
        d = dict(zip(rel.columns, r))
        acc.setdefault(d["source"], []).append(brute.rouge_lsum(d["passage"], d["document"]))
    got = {r.source: r.rougeLsum for r in entry.queries()["rouge_lsum"](spark, SF_SMALL).collect()}
    assert set(got) == set(acc)
    for k, v in acc.items():
        assert math.isclose(got[k], round(sum(v) / len(v), 6), abs_tol=1e-6), k
