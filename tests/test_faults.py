"""Inputs that once crashed an operator or gave a wrong result."""

import json

import pytest
from conftest import SF_SMALL, one_col, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry


def test_long_error_message(spark):
    from rubric.functions.text import API_ERROR_MARKER, error_payload
    body = '{"error": "' + "x" * 1_000_000 + '"}'
    nested = '{"error": "e", "parts": ' + "{}" * 1 + ", " + ", ".join(f'"k{i}": {{"a": 1}}' for i in range(20_000)) + "}"
    got = one_col(spark, [f"{API_ERROR_MARKER} {body}", f"{API_ERROR_MARKER} {nested}"], lambda c: error_payload(c))
    assert got == [body, nested]


@pytest.fixture()
def xml_dir(tmp_path):
    for i in range(6):
        (tmp_path / f"d{i}.xml").write_text(
            "<dataset><name>n</name><task>t</task><category>c</category><metric>bleu</metric><data>"
            + "".join(f"<item><instruction>i{k}</instruction><input><value>v{k}</value></input><output>o</output></item>" for k in range(3))
            + "</data></dataset>")
    return tmp_path


def test_xml_single_values_and_places(spark, xml_dir):
    from rubric.sources.datasets import read_xml_datasets
    items, _ = read_xml_datasets(spark, str(xml_dir))
    got = {(r["dataset"], r["pos"], tuple(r["input"])) for r in rows(items.select("dataset", "pos", "input"))}
    assert got == {(f"d{i}", k, (f"v{k}",)) for i in range(6) for k in range(3)}


def test_dispatch_on_uri_feeds_templates(spark, xml_dir):
    from rubric.operators.prepare import prompt_templates
    from rubric.sources.datasets import read_datasets
    items, datasets = read_datasets(spark, f"file://{xml_dir}")
    assert datasets.count() == 6
    assert {r["template_instruction"] for r in rows(prompt_templates(items))} == {"i0"}


def test_registering_a_name_anew(spark):
    from rubric.operators.metrics import register_metric, score_pairs
    pairs = spark.createDataFrame([("a", "b")], "gold string, response string")
    for want in (1.0, 2.0):
        register_metric("anew", lambda ref, pred, w=want: F.struct(F.lit(w).alias("value"), F.lit(True).alias("valid")))
        assert score_pairs(pairs, ["anew"], keep=[]).first()["anew"]["value"] == want


def test_second_response_is_an_error(spark):
    from rubric.operators.prepare import join_responses
    items = spark.createDataFrame([(1,), (2,)], "k int")
    one = spark.createDataFrame([(1, "a")], "k int, response string")
    assert {(r["k"], r["response"]) for r in rows(join_responses(items, one, ["k"]))} == {(1, "a"), (2, "")}
    with pytest.raises(Exception, match="more than one response"):
        join_responses(items, one.union(one), ["k"]).collect()


def test_rouge_averages_as_one(spark):
    from rubric.operators.rollup import average_scores
    t = spark.createDataFrame([("m", "rouge1", 0.1), ("m", "rougeLsum", 0.4), ("m", "bleu", 0.2)], "model string, metric string, value double")
    assert {(r["metric"], r["average_score"]) for r in rows(average_scores(t, ["model"]))} == {("rouge", 0.4), ("bleu", 0.2)}


def test_text_block_without_text(spark):
    from rubric.operators.chat import clean_content
    assert one_col(spark, ['[{"type": "text"}, {"type": "text", "text": "a"}]', '[{"type": "image"}, "b"]'], lambda c: clean_content(c)) == [" a", "b"]


def test_final_scores_of_all_models_combine(spark):
    got = rows(entry.queries()["final_scores"](spark, SF_SMALL))
    assert {r["model"] for r in got} == {"m0", "m1", "m2"}
    assert all(r["nGramScore"] is not None and r["llmAsJudgeScore"] is not None and r["MCQllmAsJudgeScore"] is not None for r in got)


def test_payload_holds_scores_and_one_rouge(spark):
    got = [json.loads(r["payload"]) for r in rows(entry.queries()["result_payloads"](spark, SF_SMALL))]
    final = {(r["model"], r["task"]): r["nGramScore"] for r in rows(entry.queries()["final_scores"](spark, SF_SMALL))}
    assert len(got) == len(final)
    for p in got:
        assert not [k for k in p["results"] if k.startswith("rouge") and k != "rouge,none"]
        assert p["scores"]["nGramScore"] == final[p["job_id"].removeprefix("job-"), p["task_id"]]
