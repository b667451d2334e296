"""Preparation operators and registry."""

from conftest import rows
from pyspark.sql import functions as F

from rubric.operators import judge as J
from rubric.operators import prepare as P
from rubric.operators import rollup
from rubric.operators.metrics import REGISTRY, register_metric, result, score_pairs, to_long


def test_metric_list_and_resolution(spark):
    specs = ['"bleu"', '["rouge", null, "wer"]', '{"metric": "Fuzzy_Accuracy"}', "rouge_l_sum", "", None,
             '{"other": 1}', "perplexity"]
    df = spark.createDataFrame([(s,) for s in specs], "s string")
    got = [r[0] for r in df.select(F.transform(P.metric_list("s"), P.resolve_metric)).collect()]
    # "fuzzy_accuracy" contains "accuracy", registered first: resolves to accuracy
    assert got == [["bleu"], ["rouge", "wer"], ["accuracy"], ["rouge"], [], [], [], ["perplexity"]]
    kinds = [r[0] for r in spark.createDataFrame([(["accuracy"],), (["bleu", "accuracy"],), ([],)],
                                                 "m array<string>").select(P.split_kind("m")).collect()]
    assert kinds == ["mcq", "generation", "generation"]
    assert REGISTRY.resolve("My-WER-score") == "wer"


def test_assign_task(spark):
    df = spark.createDataFrame([("t", "a_b_c_d_e"), (None, "a_b_c_d_e"), (None, "short_name")],
                               "task string, name string")
    got = [r[0] for r in df.select(P.assign_task(F.col("task"), F.col("name"))).collect()]
    assert got == ["t", "a", "short_name"]
    got2 = [r[0] for r in df.select(P.assign_task(F.col("task"), F.col("name"), explicit="x")).collect()]
    assert got2 == ["t", "x", "x"]


def test_normalize_keys_and_alias(spark):
    df = spark.createDataFrame([("Ｆｕｌｌ Width.Name",), ("a/b c",)], "k string")
    got = {r["k"]: r["key"] for r in rows(P.normalize_keys(df, "k"))}
    assert got == {"Ｆｕｌｌ Width.Name": "full_width_name", "a/b c": "a_b_c"}
    mapping = spark.createDataFrame([("My Task", "mt")], "alias string, task string")
    ok = P.map_alias(spark.createDataFrame([("my-task",)], "a string"), mapping, "a")
    assert [r["task"] for r in ok.collect()] == ["mt"]
    bad = P.map_alias(spark.createDataFrame([("nope",)], "a string"), mapping, "a")
    try:
        bad.collect()
        raise AssertionError("unknown alias must fail")
    except Exception as e:  # noqa: BLE001
        assert "unknown alias" in str(e)


def test_redact_and_defaults(spark):
    df = spark.createDataFrame([(("m", ("k", 1)),)], "config struct<name:string, model_args:struct<api_key:string, n:int>>")
    out = P.redact_config(df)
    assert out.schema["config"].dataType.simpleString() == "struct<name:string,model_args:struct<n:int>>"
    items = spark.createDataFrame([("d", "1", None)], "dataset string, id string, instruction string")
    r = rows(P.normalize_items(items))[0]
    assert r["instruction"] == "" and r["output"] == [""] and r["source_link"] == ""


def test_valid_datasets_and_schema_keys(spark):
    ds = spark.createDataFrame([("a",), ("b",)], "dataset string")
    items = spark.createDataFrame([("a", {"x": "1"}), ("a", {"y": "2", "x": "3"})],
                                  "dataset string, extras map<string,string>")
    assert [r[0] for r in P.valid_datasets(ds, items).collect()] == ["a"]
    assert [r[0] for r in P.empty_datasets(ds, items).collect()] == ["b"]
    assert sorted(r[0] for r in P.schema_keys(items).collect()) == ["x", "y"]


def test_prompt_template(spark):
    items = spark.createDataFrame(
        [("d1", "dev", 1, "Dev first", ["i1"]), ("d1", "test", 5, "Use this", ["q", "img.png"]),
         ("d2", "test", 1, "skip (not_ins)", ["z"]), ("d3", "dev", 2, "", ["w"])],
        "dataset string, split string, id_order int, instruction string, input array<string>")
    t = {r["dataset"]: r["template"] for r in rows(P.prompt_templates(items))}
    assert t == {"d1": "instruction_input", "d2": "input", "d3": "input"}
    pr = {r["dataset"] + r["split"]: r["prompt"] for r in rows(P.render_prompt(items, P.prompt_templates(items)))}
    assert pr["d1test"] == "Use this\nq\n<image>" and pr["d2test"] == "z"
    one = spark.createDataFrame([("", "x"), ("i", "")], "a string, b string")
    assert [r[0] for r in one.select(P.render_prompt_per_row("a", "b")).collect()] == ["x", "i"]


def test_custom_metric_and_aggregate(spark):
    register_metric("length_ratio", lambda r, p: result(F.try_divide(F.length(p), F.length(r)), F.length(r) > 0),
                    higher_is_better=False)
    df = spark.createDataFrame([("t", "abcd", "ab"), ("t", "ab", "abcd"), ("t", "", "x")],
                               "task string, gold string, response string")
    long = to_long(score_pairs(df, ["length_ratio"], keep=["task"]), ["task"], ["length_ratio"])
    got = rows(rollup.custom_task_metric(long, ["task"], aggregation="max"))[0]
    assert got["value"] == 2.0 and got["n_samples"] == 2


def test_normalise_test_cases(spark):
    df = spark.createDataFrame([("q", None, "a", ["c1", "c2"])],
                               "question string, reference_answer string, given_answer string, context array<string>")
    r = rows(J.normalise_test_cases(df))[0]
    assert r["reference_answer"] == "" and r["context"] == "c1\nc2"
