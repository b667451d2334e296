"""Writers, schedule, manifest and record rules on hand-made files and rows."""
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rubric.operators import judge as J
from rubric.operators import prepare as P
from rubric.operators import rollup
from rubric.operators.metrics import score_pairs
from rubric.sources import datasets as S
from rubric.sources import sinks


def _write(path, doc):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(doc, ensure_ascii=False), encoding="utf-8")


# -- S10, S13 ---------------------------------------------------------------

RESULTS = [("c1", "t1", "bleu", 0.5), ("c1", "t1", "rouge1", 0.9), ("c1", "t1", "rougeLsum", 0.25), ("c1", "t2", "bleu", 0.25),
           ("c1", "t2", "rougeLsum", 0.5), ("c2", "t3", "accuracy", 1.0), ("c2", "t4", "accuracy", None), ("c2", "t5", "accuracy", 1 / 3)]


def test_results_and_averages_in_one_output(spark, tmp_path):
    df = spark.createDataFrame(RESULTS, "category string, task string, metric string, value double")
    sinks.write_results(df, str(tmp_path / "out"), fmt="json")
    results = spark.read.json(str(tmp_path / "out" / "grain=results"))
    averages = {(r["category"], r["metric"]): r for r in rows(spark.read.json(str(tmp_path / "out" / "grain=average_scores")))}
    assert sorted((r["category"], r["task"], r["metric"], r["value"]) for r in rows(results) if r["value"] is not None) == \
        sorted(r for r in RESULTS if r[3] is not None)
    assert results.count() == len(RESULTS)
    assert {k: (v["value"], v["n_tasks"], v["min_score"], v["max_score"]) for k, v in averages.items()} == {
        ("c1", "bleu"): (0.375, 2, 0.25, 0.5), ("c1", "rouge"): (0.375, 2, 0.25, 0.5), ("c2", "accuracy"): (0.6667, 2, 1 / 3, 1.0)}
    plan = sinks.results_with_averages(df, ["category"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 1


def test_judge_results_and_statistics(spark, tmp_path):
    data = [("t", 1, 0.9, 2.7, True, "a"), ("t", 2, 0.3, 1.0, True, "b\nc"), ("t", 3, None, None, False, "none"), ("u", 4, 0.8, 2.0, True, "d")]
    df = spark.createDataFrame(data, "task string, sample_id long, score double, raw_score double, valid boolean, explanation string")
    sinks.write_judge_results(df, str(tmp_path / "judge"), threshold=0.7)
    back = spark.read.json(str(tmp_path / "judge"))
    assert back.count() == 4 and {r["explanation"] for r in rows(back)} == {"a", "b\nc", "none", "d"}
    stats = rows(spark.read.json(str(tmp_path / "judge" / "_batch_statistics")))
    assert len(stats) == 1 and stats[0]["total_test_cases"] == 3 and stats[0]["median_score"] == 0.8
    assert abs(stats[0]["pass_rate"] - 2 / 3) < 1e-9 and abs(stats[0]["average_raw_score"] - 1.9) < 1e-9


# -- S6 ----------------------------------------------------------------------

def test_schedule_by_path(spark, tmp_path):
    empty = {"name": "N", "task": "T", "category": "C", "json": {"metric_list": [{"metric": ""}], "data": {"test": [{"id": "skipped"}]}}}
    good = {"name": "N", "task": "T2", "category": "C2", "json": {"metric_list": [{"metric": "bleu"}], "data": {"test": [{"id": "kept"}]}}}
    bare = {"name": "B", "task": "T3", "category": "C", "metric_list": [{"metric": ""}], "data": {"test": [{"id": "bare"}]}}
    _write(tmp_path / "a" / "same.json", empty)
    _write(tmp_path / "b" / "same.json", good)
    _write(tmp_path / "b" / "bare.json", bare)
    _write(tmp_path / "b" / "same_test.json", [{"id": "export"}])
    path = [str(tmp_path / "a"), str(tmp_path / "b")]
    scheduled, by_category, task_of = S.task_schedule(spark, path)
    got = {r["path"].split("/")[-2] + "/" + r["dataset"]: (r["name"], r["task"], r["category"]) for r in rows(scheduled)}
    assert got == {"b/same": ("N", "T2", "C2"), "b/bare": ("B", "T3", "C")}
    assert sorted((r["category"], r["dataset"]) for r in rows(by_category)) == [("C", "bare"), ("C2", "same")]
    assert {r["name"]: r["task"] for r in rows(task_of)} == {"N": "T2", "B": "T3"}
    items, ds = S.read_json_datasets(spark, path)
    assert sorted(r["id"] for r in rows(items)) == ["bare", "kept"]
    assert sorted(r["dataset"] for r in rows(ds)) == ["bare", "same"]


# -- S8 ----------------------------------------------------------------------

def test_uri_keys(spark):
    same = [("file:/a/b.png", "/a/b.png"), ("file:///a/b.png", "/a/b.png"), ("/a//./b.png", "/a/b.png"), ("S3A://bucket/x//y.png", "s3://bucket/x/y.png"),
            ("s3n://bucket/x/y.png", "s3://bucket/x/y.png"), ("hdfs://host:8020/x/y.png", "hdfs://host:8020/x/y.png"), ("rel/y.png", "rel/y.png")]
    df = spark.createDataFrame(same, "p string, want string")
    assert [r["k"] for r in df.select(S.uri_key(F.col("p")).alias("k")).collect()] == [w for _, w in same]


def test_manifest_states_its_choice(spark, tmp_path):
    for at in ("ds/x/a.png", "ds/y/a.png", "ds/.tasks/z/a.png", "ds/b.png"):
        (tmp_path / at).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / at).write_bytes(b"0")
    items = spark.createDataFrame(
        [("ds", "test", 0, ["missing/a.png", "text"]), ("ds", "test", 1, ["y/a.png"]), ("ds", "test", 2, ["x/a.png", "b.png"]), ("ds", "dev", 0, ["z/a.png"])],
        "dataset string, split string, pos int, input array<string>").repartition(3)
    dirs = spark.createDataFrame([("ds", f"file://{tmp_path}/ds/")], "dataset string, dir string")
    roots = [str(tmp_path / "ds"), str(tmp_path / "ds" / ".tasks")]
    got = {r["basename"]: r for r in rows(S.media_manifest(spark, items, roots, dirs))}
    # the first reference is missing, so the next in the items' order that exists
    assert got["a.png"]["ref"] == "y/a.png" and not got["a.png"]["missing"] and set(got) == {"a.png", "b.png"}
    refs = {r["ref"]: r for r in rows(S.media_references(spark, items, roots, dirs))}
    assert refs["z/a.png"]["path"].endswith(".tasks/z/a.png") and refs["missing/a.png"]["missing"]
    records = {r["pos"]: json.loads(r["record"]) for r in rows(
        P.item_records(P.normalize_items(items.where("split = 'test'")), S.media_references(spark, items, roots, dirs)))}
    assert records[1]["images"][0].endswith("/ds//y/a.png") and records[0]["input"] == "<image>\ntext"


# -- S9, P2 --------------------------------------------------------------------

def test_export_reads_back_with_all_keys(spark, tmp_path):
    doc = {"name": "n", "task": "t", "category": "c", "metric": "bleu", "data": {
        "test": [{"id": "2", "input": ["see", "pic.PNG", "é\n\"q\""], "output": ["first", "second"], "colour": "red"},
                 {"id": "1", "input": "plain", "output": "only", "mcq": ["x", "y"], "Experimental prompts": ["p"], "difficulty": "hard"},
                 {"id": "3"}],
        "dev": [{"id": "9", "input": "d", "output": [], "size": "big"}]}}
    _write(tmp_path / "in" / "set.json", doc)
    items, _ = S.read_json_datasets(spark, str(tmp_path / "in"))
    sinks.write_split_export(items, str(tmp_path / "out"))
    folder = tmp_path / "out" / "dataset=set"
    lines = [json.loads(x) for f in sorted((folder / "split=test").glob("part-*")) for x in f.read_text(encoding="utf-8").splitlines()]
    assert [x["id"] for x in lines] == ["2", "1", "3"]       # in the items' order
    assert lines[0] == {"id": "2", "input": 'see\n<image>\né\\n"q"', "output": "first", "instruction": "", "source_link": "", "difficulty": "",
                        "source": "", "images": ["pic.PNG"], "colour": "red"}
    assert lines[1]["mcq"] == ["x", "y"] and lines[1]["Experimental prompts"] == ["p"] and lines[1]["colour"] == "" and lines[1]["images"] == ""
    assert lines[2]["input"] == "" and lines[2]["output"] == "" and "mcq" not in lines[2] and "audio" not in lines[2]
    dev = [json.loads(x) for f in (folder / "split=dev").glob("part-*") for x in f.read_text().splitlines()]
    assert len(dev) == 1 and dev[0]["size"] == "big" and "colour" not in dev[0] and dev[0]["output"] == ""


def test_missing_lists_stay_lists(spark):
    df = spark.createDataFrame([("d", "test", None)], "dataset string, split string, input array<string>")
    out = P.normalize_items(df)
    assert dict(out.dtypes)["output"] == "array<string>" and rows(out)[0]["input"] == [""] and rows(out)[0]["output"] == [""]


# -- G8, A5, M13 ----------------------------------------------------------------

def test_test_case_shapes(spark):
    cases = ['{"id": 7, "question": "q", "reference_answer": "r", "given_answer": "g", "context": "c", "metadata": {"k": 1}}',
             '{"input": "q", "expected_output": null, "actual_output": "g", "context": ["a", "b"]}',
             '{"test_case": {"id": "n", "input": "q", "context": []}, "other": 1}', "{}"]
    df = spark.createDataFrame(list(enumerate(cases)), "k int, j string").select("k", F.parse_json("j").alias("case"))
    got = [tuple(r)[1:] for r in J.normalise_variant_cases(df).orderBy("k").collect()]
    assert got == [("7", "q", "r", "g", "c", '{"k":1}'), (None, "q", "", "g", "a\nb", None), ("n", "q", "", "", None, None), (None, "", "", "", None, None)]
    bad = spark.createDataFrame([("[1]",)], "j string").select(F.parse_json("j").alias("case"))
    with pytest.raises(Exception, match="not a test case"):
        J.normalise_variant_cases(bad).collect()


def test_final_record_holds_what_the_task_has(spark):
    data = [("a", "rouge1", 0.1), ("a", "rougeLsum", 0.2), ("a", "bleu", 0.3), ("a", "accuracy", None), ("a", "llm_as_judge", 0.4), ("a", "llm_judge_score", 0.5),
            ("b", "bleu", 0.6), ("b", "llm_judge_score", 0.7), ("b", "mcq_llm_as_judge", None), ("b", "mcq_llm_judge_score", 0.8), ("b", "wer", 0.9),
            ("c", "rouge1", 0.1), ("c", "mcq_llm_judge_score", None), ("d", "wer", 1.0), ("e", "rouge", 0.35)]
    df = spark.createDataFrame(data, "task string, metric string, value double")
    got = {r["task"]: r for r in rows(rollup.final_scores(df, ["task"]))}
    assert got["a"]["record"] == {"nGramScore": 0.2, "mcqScore": None, "llmAsJudgeScore": 0.4}
    assert got["b"]["record"] == {"nGramScore": 0.6, "llmAsJudgeScore": 0.7, "MCQllmAsJudgeScore": 0.0}
    assert got["c"]["record"] == {"nGramScore": 0.0} and got["d"]["record"] == {} and got["e"]["record"] == {"nGramScore": 0.35}
    assert got["a"]["nGramScore"] == 0.2 and got["d"]["nGramScore"] is None


def test_list_golds_and_responses(spark):
    data = [(0, ["the cat sat on the mat", "other"], ["the cat sat on the mat", "x"]), (1, ["yes"], ["Yes."]), (2, [], ["a"]), (3, ["it's", "b"], []), (4, None, None)]
    df = spark.createDataFrame(data, "i int, gold array<string>, response array<string>")
    got = {r["i"]: r for r in rows(score_pairs(df, ["bleu", "exact_accuracy", "cer", "rouge"], keep=["i"], only={"rouge": ("rouge1", "rougeLsum")}))}
    assert got[0]["bleu"] == {"value": 1.0, "valid": True} and not got[0]["cer"]["valid"] and got[0]["rouge1"]["value"] < 1.0
    assert got[1]["exact_accuracy"] == {"value": 1.0, "valid": True} and got[1]["cer"]["valid"]
    assert not got[2]["bleu"]["valid"] and not got[3]["bleu"]["valid"] and not got[4]["exact_accuracy"]["valid"]
    from rubric.operators.metrics import list_text
    texts = [r[0] for r in df.orderBy("i").select(list_text(F.col("gold"))).collect()]
    assert texts == [str(g) if g is not None else None for _, g, _ in data]


# -- G7 ------------------------------------------------------------------------

def test_pipeline_asks_each_prompt_once_and_keeps_keys(spark):
    data = [("t1", 1, "q", "gold", ["ans"], None), ("t1", 2, "q", "gold", ["ans", "later"], None), ("t1", 3, "q", "gold", [], None), ("t1", 4, "q", "", ["ans"], None),
            ("t2", 5, "q", "gold", ["ans"], None), ("t1", 6, None, "gold", ["other"], None)]
    samples = spark.createDataFrame(data, "task string, sample long, question string, gold string, response array<string>, mcq array<string>")
    tasks = spark.createDataFrame([("t1",)], "task string")
    requests = J.judge_requests(samples, ["task", "sample"], tasks=tasks)
    prompts = J.distinct_prompts(requests)
    assert prompts.count() == 2 and requests.count() == 3
    key = {r["sample"]: r["prompt_key"] for r in rows(requests)}
    replies = spark.createDataFrame([(key[1], "j", 1, "?"), (key[1], "j", 2, '{"score": 6, "explanation": "e"}')], "prompt_key string, judge string, attempt int, raw string")
    got = {r["sample"]: r for r in rows(J.judge_pipeline(requests, replies, ["task", "sample"]))}
    assert set(got) == {1, 2, 6} and got[1]["score"] == got[2]["score"] == 2.0 and got[1]["passed"]
    assert got[6]["valid"] is False and got[6]["score"] is None
