"""Operator 10: mixing sources to target weights.

Targets: sources share all words by weight; a target stops at ``MAX_EPOCHS``
times its source, and the excess is shared again by weight until none is above
(the level that fills them all is found from one ordered pass over sources).

Selection: complete epochs first; what is left of a target is filled by
Efraimidis-Spirakis sampling.  Each document draws an exponential key scaled by
its quality weight, documents are sorted by key within their source, and are
taken while the running sum of their sizes stays within the budget.  The gap
that remains goes to the one document, of those not taken, whose size fits it
best (none, if that would miss by more).

A source may hold a third of all rows, so no source is ever sorted whole: keys
fall into bins in key order, bin sums (combined before the shuffle) show the one
bin in which the budget ends, and only that bin's rows are sorted.  Bins have
equal widths in the logarithm of the key, a 256th of a doubling: whatever the
quality weights, none holds more than about 0.1 % of a source, since a weight only
shifts the logarithm.  Rows meet their source's decision by source and one of
``SALTS`` numbers.  The targets' ordered pass has one row a source in one task.

Edge cases: a null text has size 0; a null source is a source of its own and
sorts last; rows with the same id and text share a key and are taken or left
together; an empty table gives an empty result; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rubric.llm.common import md5_unit, n_words, scratch_dir
from rubric.session import cut_lineage

# Weights of the sources in code point order, repeating.
WEIGHTS = [5, 2, 1]
MAX_EPOCHS = 3
#: Bins in a doubling of the key, and the bin after all others.
BINS = 256
LAST_BIN = 1 << 30
#: Parts into which the rows of a source are dealt when they meet its decision.
SALTS = 16
SEED = "mix"


def quality_weight(text: Column, size: Column) -> Column:
    """1 for plain prose, less the more symbols a text has for its words."""
    symbols = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[#*$%&|<>]"))
    return F.lit(1.0) / (F.lit(1.0) + symbols.cast("double") / F.greatest(size, F.lit(1)).cast("double"))


def draw(doc_id: Column, weight: Column) -> Column:
    """Exponential key of rate ``weight``: sorting by it samples by weight."""
    return -F.log(md5_unit(doc_id, SEED)) / weight


def _bin(key: Column) -> Column:
    return F.floor(F.log2(key) * BINS).cast("int")


def targets(sizes: DataFrame, weights: list[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.get(F.array(*[F.lit(x) for x in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    caps = sizes.withColumn("w", w).withColumn("level", F.lit(float(max_epochs)) * F.col("source_size") / F.col("w"))
    ahead = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    caps = caps.select(
        "*", (F.sum("source_size").over(whole) - F.coalesce(F.sum("source_size").over(ahead), F.lit(0)) * max_epochs).alias("left"),
        F.sum("w").over(behind).alias("w_left"))
    caps = caps.withColumn("fill", F.col("left").cast("double") / F.col("w_left"))
    fill = F.min(F.when(F.col("fill") <= F.col("level"), F.struct("level", "fill"))).over(whole)["fill"]
    return caps.select(
        "source", "source_size",
        F.least(F.lit(float(max_epochs)) * F.col("source_size"), F.coalesce(fill, F.lit(0.0)) * F.col("w")).alias("target"))


def decisions(keyed: DataFrame) -> DataFrame:
    """Per source: target, complete epochs, the last (bin, key, id) of the
    fractional selection and the document at its edge.  ``keyed`` has doc_id,
    source, size and key."""
    rows = keyed.withColumn("bin", _bin(F.col("key")))
    sums = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    sizes = targets(sums.groupBy("source").agg(F.sum("bin_size").alias("source_size")))
    plan = sizes.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(
        F.floor(F.col("target") / F.col("source_size")), F.lit(MAX_EPOCHS))).otherwise(0).cast("int"))
    plan = plan.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    upto = Window.partitionBy("source").orderBy("bin")
    ends = (sums.withColumn("upto", F.sum("bin_size").over(upto)).alias("s")
            .join(plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")))
            .where(F.col("upto") > F.col("budget"))
            .groupBy(F.col("p.source").alias("source"))
            .agg(F.min(F.struct("bin", "bin_size", "upto", "budget")).alias("at"))
            .select("source", F.col("at.bin").alias("cut_bin"), (F.col("at.upto") - F.col("at.bin_size")).alias("before"),
                    F.col("at.budget").alias("budget")))
    inside = (rows.alias("r").join(ends.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")) & (F.col("r.bin") == F.col("e.cut_bin")))
              .select(F.col("r.source").alias("source"), "doc_id", "size", "key", "before", "budget"))
    running = Window.partitionBy("source").orderBy("key", "doc_id")
    last = (inside.withColumn("upto", F.col("before") + F.sum("size").over(running))
            .where(F.col("upto") <= F.col("budget"))
            .groupBy("source").agg(F.max(F.struct("key", "doc_id", "upto")).alias("last")))
    out = plan.alias("p").join(ends.select("source", "cut_bin", "before").alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
    out = out.select("p.*", F.coalesce("cut_bin", F.lit(LAST_BIN)).alias("cut_bin"), "before")
    plan = (out.alias("o").join(last.alias("l"), F.col("o.source").eqNullSafe(F.col("l.source")), "left")
            .select("o.source", "source_size", "target", "epochs", "cut_bin", F.col("last.key").alias("cut_key"),
                    F.col("last.doc_id").alias("cut_id"),
                    (F.col("budget") - F.coalesce("last.upto", "before", F.lit(0))).alias("gap")))
    plan = cut_lineage(plan)
    gap = F.col("__plan.gap")
    miss = F.abs(F.col("size") - gap)
    best = (_join_sources(rows.select("source", "doc_id", "size", "key"), plan)
            .where(~_in_prefix(F.col("key"), F.col("doc_id")) & (miss < gap))
            .groupBy("source").agg(F.min(F.struct(miss.alias("miss"), "key", "doc_id")).alias("best")))
    return cut_lineage(
        plan.alias("p").join(best.alias("b"), F.col("p.source").eqNullSafe(F.col("b.source")), "left")
        .select("p.*", F.col("best.key").alias("edge_key"), F.col("best.doc_id").alias("edge_id")))


def _in_prefix(key: Column, doc_id: Column) -> Column:
    p = lambda name: F.col(f"__plan.{name}")
    at = F.struct(key.alias("a"), doc_id.alias("b")) <= F.struct(p("cut_key").alias("a"), p("cut_id").alias("b"))
    in_bin = (_bin(key) == p("cut_bin")) & p("cut_key").isNotNull() & at
    return (_bin(key) < p("cut_bin")) | F.coalesce(in_bin, F.lit(False))


def _taken_copies(key: Column, doc_id: Column) -> Column:
    p = lambda name: F.col(f"__plan.{name}")
    edge = p("edge_key").isNotNull() & (key == p("edge_key")) & doc_id.eqNullSafe(p("edge_id"))
    return p("epochs") + (_in_prefix(key, doc_id) | F.coalesce(edge, F.lit(False))).cast("int")


def _join_sources(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row with its source's decision as ``__plan``.  The table of sources is
    written, so Spark knows its size and broadcasts it only if small; if not, a
    source's rows lie in ``SALTS`` parts."""
    spark = rows.sparkSession
    folder = scratch_dir(spark, "sources")
    plan.select(F.col("source").alias("__source"), F.struct(*plan.columns).alias("__plan")).write.parquet(folder)
    decided = spark.read.parquet(folder).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("__part", F.spark_partition_id() % SALTS)
    return dealt.join(decided, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__part") == F.col("__salt"))).drop(
        "__source", "__salt", "__part")


def keyed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key) of each document, kept in the shared folder:
    every later pass reads these narrow rows, not the texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text", n_words(F.col("text")).alias("size"))
    return cut_lineage(rows.select("doc_id", "source", "size", draw(
        F.col("doc_id"), quality_weight(F.col("text"), F.col("size"))).alias("key")))


def mix_report(docs: DataFrame) -> DataFrame:
    """size, source_size, target and taken words of each document."""
    rows = keyed_rows(docs)
    out = _join_sources(rows, decisions(rows))
    return out.select("doc_id", "size", "__plan.source_size", "__plan.target",
                      (F.col("size") * _taken_copies(F.col("key"), F.col("doc_id"))).cast("long").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it."""
    plan = decisions(keyed_rows(docs))
    text = F.coalesce(F.col("text"), F.lit(""))
    # the row's own columns stay apart from the plan's, whatever their names
    own = docs.select(F.struct(*docs.columns).alias("row"), "source", F.col("doc_id").cast("long").alias("doc_id"),
                      draw(F.col("doc_id"), quality_weight(text, n_words(text))).alias("key"))
    out = _join_sources(own, plan)
    copies = F.array_repeat(F.lit(1), _taken_copies(F.col("key"), F.col("doc_id")))
    return out.select("row", F.explode(copies).alias("copy")).select("row.*")
