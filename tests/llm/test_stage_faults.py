"""Rows and columns on which pipeline stages once failed."""
import random

import pytest
from pyspark.sql import functions as F

from rubric.llm import mixing, near_dedup

BASE = " ".join(f"w{i}" for i in range(60))
OTHER = " ".join(f"v{i}" for i in range(60))


def test_ids_on_rows_with_different_texts(spark):
    rows = [(1, BASE), (1, OTHER), (2, BASE + " tail"), (3, OTHER + " end"), (4, "alone " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in near_dedup.near_duplicates(df, 2).select("doc_id", "component_id", "kept").collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)]


def test_one_row_of_each_group_stays(spark):
    rows = [(1, BASE)] * 3 + [(None, BASE + " tail")] * 2 + [(None, OTHER)] * 2 + [(5, OTHER), (5, OTHER), (5, "x y z " * 9), (7, ""), (7, ""), (8, None), (9, BASE)]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, __id string, component_id string").repartition(5)
    kept = sorted(((r["doc_id"], r["text"]) for r in near_dedup.keep_first(df, 2).collect()), key=repr)
    assert kept == sorted([(1, BASE), (5, OTHER), (5, "x y z " * 9), (7, ""), (8, None)], key=repr)
    assert near_dedup.keep_first(df, 2).columns == df.columns


def test_a_row_goes_by_its_text_not_its_id(spark):
    # id 3 stands on a copy and on a text of its own: only the copy goes
    df = spark.createDataFrame([(1, BASE), (3, BASE), (3, "a text of its own " * 4)], "doc_id long, text string")
    kept = sorted((r["doc_id"], r["text"][:6]) for r in near_dedup.keep_first(df, 5).collect())
    assert kept == [(1, BASE[:6]), (3, "a text")]


CLASHES = ["target", "epochs", "source_size", "gap", "cut_bin", "key", "row", "copy", "size", "bin", "before", "w", "last", "__plan"]


def test_mix_with_columns_named_like_its_own(spark):
    rng = random.Random(2)
    rows = [(i, f"s{rng.randrange(5)}" if i % 9 else None, "word " * rng.randrange(40)) for i in range(300)]
    plain = spark.createDataFrame(rows, "doc_id long, source string, text string")
    clashing = plain.select("*", *[F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in CLASHES])
    out = mixing.mix(clashing)
    assert out.columns == clashing.columns
    copies = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert copies == {r["doc_id"]: r["count"] for r in mixing.mix(plain).groupBy("doc_id").count().collect()}
    assert out.where(F.col("gap") != F.concat(F.lit("gap-"), "doc_id")).count() == 0
    assert mixing.mix_report(clashing).count() == 300


@pytest.mark.parametrize("weight", [1.0, 0.09, 0.001])
def test_no_bin_holds_much_of_a_source(spark, weight):
    keys = spark.range(50_000).select(mixing.draw(F.col("id"), F.lit(weight)).alias("key"))
    largest = keys.groupBy(mixing._bin(F.col("key")).alias("b")).count().agg(F.max("count")).first()[0]
    assert largest < 50_000 * 0.004


def test_vectors_of_other_lengths_take_no_part(spark):
    from rubric.llm import ann
    rng = random.Random(3)
    rows = [(i, [rng.random() for _ in range(4)]) for i in range(60)] + [(100, [1.0]), (120, [2.0, 3.0, 4.0, 5.0, 6.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.where("vec_id % 20 = 0"), 5).collect()
    assert {r["query_id"] for r in got} == {0, 20, 40} and len(got) == 15
    assert all(r["vec_id"] < 60 for r in got)
