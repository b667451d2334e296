"""Dataset catalog derived from ``documents`` (re-aimed fixture F-F).

One dataset per document source; every document is an item whose input is
either the whole text (real newlines) or its lines, plus media references
for some ids; outputs are lists; some items carry options.  Dataset
metadata (metric spec in every shape the loaders accept, task, category,
name) follows fixed rules on the source number, so all catalog operators
run on data that grows with the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rubric.plans.fixtures import memo_view, table


@memo_view
def catalog_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    i = F.col("doc_id")
    lines = F.split(F.col("text"), "\n")
    media = F.array_compact(F.array(
        F.when(i % 7 == 0, F.concat(F.lit("img_"), i.cast("string"), F.lit(".PNG"))),
        F.when(i % 11 == 0, F.concat(F.lit("media/rec_"), i.cast("string"), F.lit(".wav"))),
        F.when(i % 13 == 0, F.lit(".png")),
    ))
    text_input = F.when(i % 2 == 0, F.array(F.col("text"))).otherwise(lines)
    return d.select(
        F.concat(F.lit("ds_"), F.col("source")).alias("dataset"),
        F.when(i % 5 == 0, F.lit("dev")).otherwise(F.lit("test")).alias("split"),
        i.cast("string").alias("id"),
        i.alias("id_order"),
        F.when(F.col("lang") == "en", F.lit("Answer the question."))
         .when(F.col("lang") == "fr", F.lit("Traduire (not_ins)."))
         .when(F.col("lang") == "de", F.lit("")).alias("instruction"),
        F.concat(text_input, media).alias("input"),
        F.when(i % 2 == 0, F.array(F.get(lines, 0)))
         .otherwise(F.array(F.get(lines, 0), F.element_at(lines, -1))).alias("output"),
        F.when(i % 3 == 0, F.array(F.lit("yes"), F.lit("no"))).alias("mcq"),
    )


@memo_view
def catalog_item_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog items with keys beyond the core: ``level`` on ids divisible by 4,
    ``hint`` (of a source's English items) on ids divisible by 6."""
    i = F.col("id_order")
    entries = F.array_compact(F.array(
        F.when(i % 4 == 0, F.struct(F.lit("level").alias("k"), F.concat(F.lit("l"), (i % 3).cast("string")).alias("v"))),
        F.when((i % 6 == 0) & (F.col("instruction") == "Answer the question."),
               F.struct(F.lit("hint").alias("k"), F.concat(F.lit("see "), F.col("id")).alias("v")))))
    return catalog_items(spark, sf_dir).withColumn("extras", F.map_from_entries(entries))


@memo_view
def catalog_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with list golds (``output``) and list responses: the first line without
    every third word, or no response when id % 17 = 0."""
    from rubric.plans.fixtures import degraded_response
    items = catalog_items(spark, sf_dir)
    answer = degraded_response(F.get("output", 0), F.lit(0))
    none = F.array().cast("array<string>")
    return items.select("dataset", "id", F.col("output").alias("gold"),
                        F.when(F.col("id_order") % 17 == 0, none).otherwise(F.array(answer, F.lit("second try"))).alias("response"))


@memo_view
def catalog_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "source")
    per = d.groupBy("source").agg(F.count("*").alias("n_items"))
    n = F.expr("substring(source, 4)").cast("int")
    spec = (F.when(n % 6 == 0, F.lit('"accuracy"'))
            .when(n % 6 == 1, F.lit('["bleu", "rouge"]'))
            .when(n % 6 == 2, F.lit('{"metric": "Fuzzy_Accuracy"}'))
            .when(n % 6 == 3, F.lit("rouge_l_sum"))
            .when(n % 6 == 4, F.lit('["WER", null]'))
            .otherwise(F.lit("")))
    name = F.when(n % 2 == 0, F.concat_ws("_", F.concat(F.lit("grp"), (n % 4).cast("string")), F.lit("eval"),
                                           F.lit("set"), F.col("source"), F.lit("v1")))\
        .otherwise(F.concat(F.lit("plain"), F.col("source")))
    return per.select(
        F.concat(F.lit("ds_"), F.col("source")).alias("dataset"),
        spec.alias("metric_spec"),
        F.when(n % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("task"), (n % 3).cast("string"))).alias("task"),
        F.concat(F.lit("cat"), (n % 4).cast("string")).alias("category"),
        name.alias("name"),
        "n_items",
    )


def catalog_items_sql() -> str:
    return """
    SELECT 'ds_' || source AS dataset, CASE WHEN doc_id % 5 = 0 THEN 'dev' ELSE 'test' END AS split,
           doc_id::VARCHAR AS id, doc_id AS id_order,
           CASE lang WHEN 'en' THEN 'Answer the question.' WHEN 'fr' THEN 'Traduire (not_ins).' WHEN 'de' THEN '' END AS instruction,
           (CASE WHEN doc_id % 2 = 0 THEN [text] ELSE string_split(text, chr(10)) END)
             || list_filter([CASE WHEN doc_id % 7 = 0 THEN 'img_' || doc_id::VARCHAR || '.PNG' END,
                             CASE WHEN doc_id % 11 = 0 THEN 'media/rec_' || doc_id::VARCHAR || '.wav' END,
                             CASE WHEN doc_id % 13 = 0 THEN '.png' END], lambda x: x IS NOT NULL) AS input,
           CASE WHEN doc_id % 2 = 0 THEN [string_split(text, chr(10))[1]]
                ELSE [string_split(text, chr(10))[1], string_split(text, chr(10))[-1]] END AS output,
           CASE WHEN doc_id % 3 = 0 THEN ['yes', 'no'] END AS mcq
    FROM documents"""


def catalog_datasets_sql() -> str:
    return """
    SELECT 'ds_' || source AS dataset,
           CASE n % 6 WHEN 0 THEN '"accuracy"' WHEN 1 THEN '["bleu", "rouge"]' WHEN 2 THEN '{"metric": "Fuzzy_Accuracy"}'
                      WHEN 3 THEN 'rouge_l_sum' WHEN 4 THEN '["WER", null]' ELSE '' END AS metric_spec,
           CASE WHEN n % 5 = 0 THEN NULL ELSE 'task' || (n % 3)::VARCHAR END AS task,
           'cat' || (n % 4)::VARCHAR AS category,
           CASE WHEN n % 2 = 0 THEN 'grp' || (n % 4)::VARCHAR || '_eval_set_' || source || '_v1' ELSE 'plain' || source END AS name,
           n_items
    FROM (SELECT source, substr(source, 4)::INTEGER AS n, count(*) AS n_items FROM documents GROUP BY source)"""
