"""The pipeline's stages one by one and in a chain, on rows that need each of them."""
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from rubric.llm import mixing, quality

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "theta", "kappa", "lambda", "sigma", "omega", "river", "stone", "cloud"]


def prose(rng, n=80):
    return " ".join(rng.choices(WORDS, k=n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng), "en", f"src{i % 3}" if i % 7 else None) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " tail", "en", "src1") for i in range(5)]            # near copies
    rows += [(3, rows[3][1], "en", "src0"), (None, rows[4][1], "en", "src2")]              # repeated row, copy without id
    rows += [(200, None, None, None), (201, "", "en", "src0"), (202, "too few words", "en", "src1"), (203, "same line here\n" * 60, "en", "src1")]
    rows += [(300, prose(rng) + " password = hunter2hunter2 " + prose(rng), "en", "src2")]
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumn("target", F.lit("own")).withColumn("key", F.lit(1)).repartition(4), rows


def test_stages_on_odd_rows(spark, corpus, tmp_path):
    docs, rows = corpus
    texts = {r[0]: r[1] for r in rows}
    held = {}
    for name, stage in cp.STAGES:
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{name}")
        held[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "byte_bpe":
            assert held[name].columns == docs.columns, name
            docs = held[name]
    good = {r["doc_id"] for r in held["quality_rules"].collect()}
    assert good.isdisjoint({200, 201, 202, 203}) and {0, 100, 300, None} <= good
    one = held["near_dedup"].collect()
    ids = [r["doc_id"] for r in one]
    assert len(ids) == len(set(ids)) and None not in ids and not set(ids) & {100, 101, 102, 103, 104} and {3, 4} <= set(ids)
    clean = {r["doc_id"]: r for r in held["secret_scans"].collect()}
    assert set(clean) == set(ids) and "hunter2" not in clean[300]["text"] and "[SECRET]" in clean[300]["text"]
    assert clean[300]["n_chars"] == len(clean[300]["text"])
    assert all(r["text"] == texts[i] and r["n_chars"] == len(texts[i]) for i, r in clean.items() if i != 300)
    copies = {r["doc_id"]: r["count"] for r in held["source_mix"].groupBy("doc_id").count().collect()}
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_report(held["secret_scans"]).collect() if r["size"]}
    assert copies == {k: v for k, v in taken.items() if v}
    import public_tokenizers
    from rubric.llm.bpe import decode_documents
    tokens = held["byte_bpe"]
    assert tokens.count() == sum(copies.values())
    back = decode_documents(tokens.select("doc_id", "ids"), public_tokenizers.path("byte_bpe_50k.tiktoken")).select("doc_id", F.col("decoded").cast("string").alias("t"))
    assert {(r["doc_id"], r["t"]) for r in back.collect()} == {(i, clean[i]["text"]) for i in copies}


def test_run_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_costly_rules_are_not_asked_after_a_rejection(spark):
    """A rule that stops the job when asked is never asked of rows that an earlier one rejects."""
    stop = F.raise_error(F.lit("asked")).cast("boolean")
    rules = [quality.Rule("cheap", F.col("id") >= 0), quality.Rule("costly", stop)]
    got = spark.range(20).select(quality.first_rejection(rules).alias("r")).distinct().collect()
    assert [r["r"] for r in got] == ["cheap"]
    with pytest.raises(Exception, match="asked"):
        spark.range(20).select(quality.first_rejection(rules[::-1]).alias("r")).collect()
