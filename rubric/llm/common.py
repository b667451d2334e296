"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rubric.session import ensure_checkpoint_dir

# Word separators are the space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text in order (null text: none), JVM side."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once: a lambda over a one-element array
    binds it, so no later expression evaluates it again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def md5_unit(key: Column, salt: str) -> Column:
    """Uniform double in (0, 1) from a key; the same bits in any SQL engine with md5."""
    digest = F.md5(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def by_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns every operator works on; other columns, whatever their
    names, never meet the operator's own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
