"""Judge rules (G1-G6, T10, T11) on hand-made replies."""

from conftest import rows
from pyspark.sql import functions as F

from rubric.operators import judge as J

FENCE = "```json\n{}\n```"


def _attempts(spark, data):
    return spark.createDataFrame(data, "task string, sample_id long, judge string, attempt int, raw string")


def test_parse_verdict(spark):
    raws = ['{"score": 2, "explanation": "ok"}', FENCE.format('{"score": 1, "explanation": "x"}'),
            '{"score": 2}', '{"score": null, "explanation": "n"}', "not json", '[1, 2]',
            '{"score": "2", "explanation": "s"}']
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = [r[0] for r in df.select(J.parse_verdict(F.col("raw"))).collect()]
    assert [g.valid for g in got] == [True, True, False, True, False, False, True]
    assert got[0].score == 2.0 and got[1].score == 1.0 and got[6].kind == "STRING"
    assert got[3].kind == "VOID"


def test_first_valid_and_normalisation(spark):
    data = [
        ("t", 1, "j1", 1, "broken"), ("t", 1, "j1", 2, '{"score": 3, "explanation": "a"}'),
        ("t", 2, "j1", 1, '{"score": 4, "explanation": "over"}'),           # generative: not clamped
        ("t", 3, "j1", 1, "x"), ("t", 3, "j1", 2, "y"), ("t", 3, "j1", 3, "z"),
        ("t", 3, "j1", 4, '{"score": 3, "explanation": "too late"}'),       # attempt 4 ignored
        ("t", 4, "j1", 1, '{"score": "2", "explanation": "string"}'),       # numeric string
        ("t", 5, "j1", 1, '{"score": "bad", "explanation": "text"}'),       # not a number
    ]
    v = J.first_valid_verdict(_attempts(spark, data), ["task", "sample_id"])
    s = J.judge_scores(v, ["task", "sample_id"], mcq=False)
    agg = {r["sample_id"]: r for r in rows(J.aggregate_judges(s, ["task", "sample_id"]))}
    assert agg[1]["score"] == 1.0 and agg[1]["raw_score"] == 3.0 and agg[1]["valid"]
    assert abs(agg[2]["score"] - 1.33333) < 1e-9
    assert agg[3]["valid"] is False and agg[3]["score"] is None          # no verdict: left out
    assert agg[4]["valid"] is False                                       # raw mean fails
    assert agg[5]["valid"] and agg[5]["score"] == 0.0 and agg[5]["raw_score"] == 0.0
    expl = {r["sample_id"]: r["explanation"] for r in rows(v)}
    assert expl[3] == J.NO_VERDICT


def test_mcq_clamp_and_multi_judge(spark):
    data = [("t", 1, "j1", 1, '{"score": 5, "explanation": "a"}'), ("t", 1, "j2", 1, "broken"),
            ("t", 2, "j1", 1, '{"score": -1, "explanation": "b"}'), ("t", 2, "j2", 1, '{"score": 1, "explanation": "c"}')]
    v = J.first_valid_verdict(_attempts(spark, data), ["task", "sample_id"])
    s = J.judge_scores(v, ["task", "sample_id"], mcq=True)
    agg = {r["sample_id"]: r for r in rows(J.aggregate_judges(s, ["task", "sample_id"], method="mean"))}
    # judge 2 of sample 1 failed: counts 0 in the score mean, left out of the raw mean
    assert agg[1]["score"] == 0.5 and agg[1]["raw_score"] == 5.0
    assert agg[2]["score"] == 0.5 and agg[2]["raw_score"] == 0.0
    med = {r["sample_id"]: r for r in rows(J.aggregate_judges(s, ["task", "sample_id"], method="median"))}
    assert med[1]["score"] == 0.5
    stats = rows(J.batch_statistics(J.aggregate_judges(s, ["task", "sample_id"]), threshold=0.5))[0]
    assert stats["total_test_cases"] == 2 and stats["pass_rate"] == 1.0
    task = rows(J.taskwise(J.aggregate_judges(s, ["task", "sample_id"]), prefix="mcq_"))[0]
    assert task["mcq_llm_judge_score"] == 0.5 and task["mcq_llm_judge_score_stderr"] == 0.0


def test_judge_prompt(spark):
    df = spark.createDataFrame([("q", "r", "a", ""), ("q", "r", "a", "ctx")], "q string, r string, a string, c string")
    got = [x[0] for x in df.select(J.judge_prompt(F.col("q"), F.col("r"), F.col("a"), F.col("c"))).collect()]
    assert "[CONTEXT]" not in got[0] and "[CONTEXT]\nctx\n[/CONTEXT]" in got[1]
    assert got[0].endswith("[GENERATED OUTPUT]\na\n[/GENERATED OUTPUT]")


def test_batch_statistics_equal_the_builtin_median(spark):
    import random
    import statistics

    draw = random.Random(5)
    for n in (0, 1, 2, 7, 500, 501):
        data = [(draw.choice([0.0, 0.25, draw.random() * 40 - 3]), draw.choice([1.0, draw.random()]), True) for _ in range(n)]
        df = spark.createDataFrame(data + [(99.0, 99.0, False)], "score double, raw_score double, valid boolean")
        got = J.batch_statistics(df, threshold=0.2).collect()[0]
        assert got["total_test_cases"] == n
        if n:
            for col, k in (("median_score", 0), ("median_raw_score", 1)):
                assert abs(got[col] - statistics.median(r[k] for r in data)) < 1e-9
            assert abs(got["average_score"] - statistics.fmean(r[0] for r in data)) < 1e-9
            assert abs(got["pass_rate"] - sum(r[0] >= 0.2 for r in data) / n) < 1e-9
        else:
            assert got["median_score"] is None and got["pass_rate"] == 0.0
