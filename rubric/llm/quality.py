"""Operator 1: quality rules as a short-circuit cascade.

Every rule is one self-contained ``Column`` over the text (true: reject).  Cost
and selectivity of each rule are measured on a bounded uniform sample; the
cascade then asks the rules in the order of rejections per second, and a
``CASE`` stops at the first rule that rejects.  The order changes the work,
never the verdict, because a document is kept only if no rule rejects it.

Edge cases: a null or empty text has no words and is rejected by ``few_words``;
repeated rows are judged one by one; an empty table gives an empty result; all
columns of the input are returned as they came.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubric.llm.common import WORD, let, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_100_WORDS = 10
MAX_DUP_LINE_PERCENT = 30
MIN_WORD_CHARS, MAX_WORD_CHARS = 2, 15
MAX_UPPER_PERCENT = 50
#: Rows (expected) of the sample on which costs and selectivities are measured.
SAMPLE_ROWS = 600

SYMBOL = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def _text(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def word_chars(w: Column) -> Column:
    return F.length(F.array_join(w, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(_text(text), F.lit(SYMBOL)).cast("long")


def _word_lines(text: Column) -> Column:
    return F.filter(F.split(_text(text), "\n"), lambda line: line.rlike(WORD))


def _dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_dup_lines(text: Column) -> Column:
    return let(_word_lines(text), _dup_lines)


def _windows(w: Column) -> Column:
    """The text's 3-word windows with their positions, in sorted order."""
    n = F.greatest(F.size(w) - 2, F.lit(0))
    at = lambda k: F.slice(w, F.lit(k), n)
    places = F.slice(F.sequence(F.lit(0), F.size(w)), F.lit(1), n)
    return F.sort_array(F.arrays_zip(at(1).alias("a"), at(2).alias("b"), at(3).alias("c"), places.alias("i")))


def _repeated(s: Column) -> Column:
    """Positions of the windows equal to a neighbour in sorted order, ascending."""
    n = F.greatest(F.size(s) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(s, F.lit(1), n).alias("x"), F.slice(s, F.lit(2), n).alias("y"))
    equal = F.filter(pairs, lambda p: (p["x"]["a"] == p["y"]["a"]) & (p["x"]["b"] == p["y"]["b"]) & (p["x"]["c"] == p["y"]["c"]))
    return let(equal, lambda p: F.sort_array(F.array_distinct(F.concat(p["x"]["i"], p["y"]["i"]))))


def _covered(p: Column) -> Column:
    """Words in the union of the 3-word windows at ascending positions."""
    gaps = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g)


def n_repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text: equal
    neighbours of the sorted windows, n log n in the length of the text."""
    return let(_windows(w), lambda s: let(_repeated(s), _covered))


def default_rules(text: Column) -> list[Rule]:
    """The rules over a text column, cheapest guess first."""
    def ratio(body):
        return let(words(text), body)
    return [
        Rule("few_words", F.size(words(text)) < MIN_WORDS),
        Rule("symbols", ratio(lambda w: n_symbols(text) * 100 > F.size(w) * MAX_SYMBOLS_PER_100_WORDS)),
        Rule("word_length", ratio(lambda w: (word_chars(w) < F.size(w) * MIN_WORD_CHARS) | (word_chars(w) > F.size(w) * MAX_WORD_CHARS))),
        Rule("dup_lines", let(_word_lines(text), lambda lines: _dup_lines(lines) * 100 > F.size(lines) * MAX_DUP_LINE_PERCENT)),
        Rule("upper_case", ratio(lambda w: F.regexp_count(_text(text), F.lit(r"\p{Lu}")) * 100 > word_chars(w) * MAX_UPPER_PERCENT)),
        Rule("repeats", let(words(text), lambda w: n_repeat_words(w) * 100 > F.size(w) * MAX_REPEAT_PERCENT)),
    ]


def measure(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, seconds, rejection rate) of each rule on a uniform sample.

    The sample has ``sample_rows`` expected rows whatever the table's size and
    is held by Spark; only one count per rule reaches the driver.
    """
    total = docs.count()
    if total == 0:
        return [(r.name, 0.0, 0.0) for r in rules]
    fraction = min(1.0, sample_rows / total)
    sample = docs.sample(False, fraction, seed=7).repartition(4).persist()
    try:
        seen = max(1, sample.count())
        out = []
        for rule in rules:
            began = time.perf_counter()
            hits = sample.select(F.count_if(rule.rejects)).first()[0]
            out.append((rule.name, time.perf_counter() - began, hits / seen))
        return out
    finally:
        sample.unpersist()


def ordered(rules: list[Rule], measured: list[tuple[str, float, float]]) -> list[Rule]:
    """Rules by rejections per second, highest first."""
    rate = {name: share / max(seconds, 1e-6) for name, seconds, share in measured}
    return sorted(rules, key=lambda r: -rate[r.name])


def first_rejection(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects (null: none); later ones are not evaluated."""
    out = F.when(F.lit(False), F.lit(""))
    for rule in rules:
        out = out.when(rule.rejects, F.lit(rule.name))
    return out


def keep_good(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents no rule rejects, with their columns."""
    rules = default_rules(F.col(text_col))
    cascade = ordered(rules, measure(docs.select(text_col), rules, sample_rows))
    return docs.where(first_rejection(cascade).isNull())


def quality_report(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Base figures of every document, the base verdict and the cascade's.

    The rules here ask the figures that the report holds anyway, and the
    cascade is asked only where the base rules pass.
    """
    text = F.col("text")
    base = docs.select("doc_id", "text", words(text).alias("w"))
    base = base.select(
        "doc_id", "text", F.size("w").cast("long").alias("n_words"), word_chars(F.col("w")).alias("word_chars"),
        n_symbols(text).alias("n_symbols"), n_dup_lines(text).alias("n_dup_lines"), _windows(F.col("w")).alias("s"))
    base = base.select("*", _repeated(F.col("s")).alias("p")).select("*", _covered(F.col("p")).alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    base = base.withColumn("base_failed", failed)
    over = {
        "few_words": F.col("n_words") < MIN_WORDS,
        "symbols": F.col("n_symbols") * 100 > F.col("n_words") * MAX_SYMBOLS_PER_100_WORDS,
        "upper_case": F.regexp_count(text, F.lit(r"\p{Lu}")) * 100 > F.col("word_chars") * MAX_UPPER_PERCENT,
        "word_length": (F.col("word_chars") < F.col("n_words") * MIN_WORD_CHARS) | (F.col("word_chars") > F.col("n_words") * MAX_WORD_CHARS),
        "repeats": F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT,
    }
    rules = default_rules(text)
    order = ordered(rules, measure(docs.select("text"), rules, sample_rows))
    cascade = [Rule(r.name, over.get(r.name, r.rejects)) for r in order]
    reason = first_rejection(cascade)
    return base.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & reason.isNull()).alias("kept"))
