"""Dataset readers and writers on small files written by the test."""

import json

from conftest import rows
from pyspark.sql import functions as F

from rubric.sources import datasets as S
from rubric.sources import sinks


def _write(p, text):
    p.write_text(text, encoding="utf-8")
    return p


def test_json_datasets(spark, tmp_path):
    plain = {"name": "Geo QA", "task": "geo", "category": "knowledge", "metric": ["bleu", None],
             "version": "1", "data": {"test": [
                 {"id": "1", "instruction": "Answer.", "input": "Capital of France?", "output": "Paris",
                  "mcq": ["Paris", "Rome"], "difficulty": "easy", "region": "EU"},
                 {"id": "2", "input": ["line a", "img.png"], "output": ["x", "y"]}],
                 "dev": [{"id": "3", "input": "dev q", "output": "dev a"}]}}
    env = {"name": "wrapped", "task": "outer_task", "category": "outer_cat",
           "json": {"name": "inner", "task": "inner_task", "metric": {"metric": "accuracy"},
                    "data": {"test": [{"id": "9", "input": "q", "output": "a"}]}}}
    _write(tmp_path / "geo.json", json.dumps(plain))
    _write(tmp_path / "env.json", json.dumps(env))
    _write(tmp_path / "geo_test.json", json.dumps(plain))      # an export: skipped
    items, ds = S.read_json_datasets(spark, str(tmp_path))
    it = {r["id"]: r for r in rows(items)}
    assert set(it) == {"1", "2", "3", "9"}
    assert it["1"]["input"] == ["Capital of France?"] and it["1"]["mcq"] == ["Paris", "Rome"]
    assert it["1"]["extras"] == {"region": "EU"} and it["1"]["split"] == "test"
    assert it["2"]["output"] == ["x", "y"] and it["3"]["split"] == "dev"
    d = {r["dataset"]: r for r in rows(ds)}
    assert d["env"]["task"] == "outer_task" and d["env"]["category"] == "outer_cat"
    assert json.loads(d["geo"]["metric_spec"]) == ["bleu", None]
    assert "data" not in d["geo"]["metadata"] and d["geo"]["metadata"]["version"] == "1"


def test_csv_datasets(spark, tmp_path):
    text = ("name,task,category,metric\n"
            "Csv Set,csvtask,cat1,accuracy\n"
            "\n"
            "id,instruction,output,source,input_1,input_2,mcq_a,mcq_b,experimental_1\n"
            "1,Pick,A,web,first,,yes,no,\n"
            "2,Pick,B,web,only,second,,,try this\n")
    _write(tmp_path / "set.csv", text)
    items, ds = S.read_csv_datasets(spark, str(tmp_path))
    it = {r["id"]: r for r in rows(items)}
    assert it["1"]["input"] == ["first"] and it["1"]["mcq"] == ["yes", "no"] and it["1"]["experimental_prompts"] is None
    assert it["2"]["input"] == ["only", "second"] and it["2"]["mcq"] is None
    assert it["2"]["experimental_prompts"] == ["try this"] and it["2"]["output"] == ["B"]
    d = rows(ds)[0]
    assert d["task"] == "csvtask" and d["metadata"]["name"] == "Csv Set"


def test_xml_datasets(spark, tmp_path):
    text = ("<dataset><name>X Set</name><task>xt</task><category>c</category><metric>bleu</metric>"
            "<data><item><id>1</id><instruction>Do</instruction><input><value>a</value><value>b.png</value></input>"
            "<output>out</output><mcq><option>p</option><option>q</option></mcq></item>"
            "<item><id>2</id><input><value>z</value></input><output>o2</output></item></data></dataset>")
    _write(tmp_path / "x.xml", text)
    items, ds = S.read_xml_datasets(spark, str(tmp_path))
    it = {r["id"]: r for r in rows(items)}
    assert it["1"]["input"] == ["a", "b.png"] and it["1"]["mcq"] == ["p", "q"]
    assert it["2"]["output"] == ["o2"]
    d = rows(ds)[0]
    assert d["task"] == "xt" and d["name"] == "X Set"


def test_format_dispatch_and_export(spark, tmp_path):
    data = {"name": "n", "task": "t", "category": "c", "metric": "bleu",
            "data": {"test": [{"id": "1", "input": "in\nline", "output": "out"}]}}
    src = tmp_path / "src"
    src.mkdir()
    _write(src / "same.json", json.dumps(data))
    _write(src / "same.csv", "name,task\nn,t\nid,instruction,output\n7,i,o\n")
    items, ds = S.read_datasets(spark, str(src))
    assert [r["id"] for r in rows(items)] == ["1"]          # JSON wins over CSV
    out = tmp_path / "export"
    sinks.write_split_export(items, str(out))
    back = spark.read.json(str(out))
    r = back.collect()[0]
    assert r["input"] == "in\\nline" and r["output"] == "out" and r["dataset"] == "same" and r["split"] == "test"


def test_media_manifest(spark, tmp_path):
    root = tmp_path / "media"
    (root / "ds1" / ".tasks").mkdir(parents=True)
    (root / "ds1" / "a.png").write_bytes(b"x")
    (root / "ds1" / ".tasks" / "b.wav").write_bytes(b"y")
    items = spark.createDataFrame([("ds1", ["a.png", "b.wav", "c.jpg", "text"])], "dataset string, input array<string>")
    dirs = spark.createDataFrame([("ds1", str(root / "ds1"))], "dataset string, dir string")
    roots = [str(root), str(root / "ds1" / ".tasks")]
    got = {r["ref"]: r for r in rows(S.media_manifest(spark, items, roots, dirs))}
    assert not got["a.png"]["missing"] and got["a.png"]["path"].endswith("ds1/a.png")
    assert got["b.wav"]["path"].endswith(".tasks/b.wav") and got["b.wav"]["kind"] == "audio"
    assert got["c.jpg"]["missing"] and "text" not in got


def test_select_catalog(spark):
    cat = spark.createDataFrame([("a", "c1", "generation"), ("b", "c1", "mcq"), ("c", "c2", "mcq")],
                                "dataset string, category string, type string")
    got = sorted(r["dataset"] for r in S.select_catalog(cat, "c1", " mcq , generation ,").collect())
    assert got == ["a", "b"]
    assert [r["dataset"] for r in S.select_catalog(cat, "c1", None).collect()] == ["a"]


def test_result_writers(spark, tmp_path):
    from rubric.operators import jobs
    tr = spark.createDataFrame([("t1", "c1", "bleu", 0.5), ("t1", "c1", "accuracy", 1.0), ("t2", "c1", "bleu", 0.25)],
                               "task string, category string, metric string, value double")
    sinks.write_results(tr, str(tmp_path / "results"))
    back = spark.read.parquet(str(tmp_path / "results"))
    assert back.filter("task = 't1'").count() == 2 and set(back.columns) >= {"task", "category", "metric"}
    pay = jobs.result_payloads(tr, job_id="j", benchmark="b")
    sinks.write_payloads(pay, str(tmp_path / "payloads"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "payloads")).collect())
    doc = json.loads(lines[0])
    assert doc["task_id"] == "t1" and doc["results"] == {"accuracy,none": 1.0, "bleu,none": 0.5}
    assert doc["status"] == "completed" and doc["job_id"] == "j"
    sinks.write_judge_results(tr.withColumn("explanation", F.lit("x")), str(tmp_path / "judge"))
    assert spark.read.json(str(tmp_path / "judge")).count() == 3
