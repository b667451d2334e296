"""Metric plans against plain-Python brute force (hand rows + table rows)."""

import math
import random

import brute
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from rubric.functions import lcs
from rubric.operators.metrics import score_pairs
from rubric.plans import fixtures as fx

HAND = [
    ("the cat sat on the mat", "the cat sat on the mat"),
    ("the cat sat on the mat", "the cat is on the mat today"),
    ("a b c d e", "e d c b a"),
    ("Hello, world!", "hello world"),
    ("foo\\nbar baz", "foo\nbar baz qux"),
    ("line one\nline two here", "line two here\nline one"),
    ("{x} y", "{x} y"),
    ("", "something"),
    ("word", ""),
    ("   ", "x y"),
    ("كَتَبَ الوَلَدُ", "كتب الولد"),
    ("one two three four", "one two three"),
]


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def _pairs(spark):
    pairs = fx.conversation_pairs(spark, SF_SMALL).select("gold", "response").limit(60).collect()
    passages = fx.passage_pairs(spark, SF_SMALL).select(
        F.col("passage").alias("gold"), F.col("document").alias("response")).collect()
    return HAND + [(r.gold, r.response) for r in pairs] + [(r.gold, r.response) for r in passages[:5]]


@pytest.fixture(scope="module")
def scored(spark):
    data = _pairs(spark)
    df = spark.createDataFrame([(i, g, r) for i, (g, r) in enumerate(data)], "i int, gold string, response string")
    out = score_pairs(df, ["bleu", "rouge", "wer", "cer"], keep=["i"]).orderBy("i").collect()
    return data, out


def test_bleu(scored):
    data, out = scored
    for (g, r), row in zip(data, out):
        exp = brute.bleu(g, r)
        assert row.bleu.valid == (exp is not None)
        assert _close(row.bleu.value, exp), (g, r)


def test_rouge(scored):
    data, out = scored
    for (g, r), row in zip(data, out):
        assert _close(row.rouge1.value, brute.rouge_n(g, r, 1)), (g, r)
        assert _close(row.rouge2.value, brute.rouge_n(g, r, 2)), (g, r)
        assert _close(row.rougeL.value, brute.rouge_l(g, r)), (g, r)
        assert _close(row.rougeLsum.value, brute.rouge_lsum(g, r)), (g, r)


def test_edit_rates(scored):
    data, out = scored
    for (g, r), row in zip(data, out):
        assert _close(row.wer.value, brute.wer(g, r)), (g, r)
        assert _close(row.cer.value, brute.cer(g, r)), (g, r)


def test_word_distance_many_symbols(spark):
    # more distinct words than the BMP block used first: supplementary code points
    words = [f"w{i}" for i in range(60000)]
    ref = " ".join(words[:30000] + words[:10])
    pred = " ".join(words[5:30000] + ["zz"] + words[:10])
    df = spark.createDataFrame([(ref, pred)], "gold string, response string")
    got = score_pairs(df, ["wer"], keep=[]).collect()[0].wer.value
    assert _close(got, 6 / 30010)


def test_lcs_kernels():
    rnd = random.Random(7)
    for _ in range(200):
        a = "".join(rnd.choice("abcde ") for _ in range(rnd.randint(0, 30)))
        b = "".join(rnd.choice("abcde ") for _ in range(rnd.randint(0, 30)))
        assert lcs.lcs_length(a, b) == brute.lcs_table(a, b)[-1][-1]
        assert math.isclose(lcs.ratio(a, b), brute.ratio(a, b))
        assert math.isclose(lcs.partial_ratio(a, b), brute.partial_ratio(a, b)), (a, b)
        assert math.isclose(lcs.ratio(a, b), lcs.ratio(b, a))


def test_fuzzy_accuracy(spark):
    rows = [("Paris", "paris"), ("a", "Paris"), ("color", "colour"), ("London", "Berlin"),
            ("The answer is Paris", "Paris"), ("B", "Answer: B."), (None, "x"), ("!!", "x")]
    df = spark.createDataFrame([(i, g, r) for i, (g, r) in enumerate(rows)], "i int, gold string, response string")
    out = score_pairs(df, ["accuracy", "exact_accuracy"], keep=["i"]).orderBy("i").collect()
    acc = [(r.accuracy.value, r.accuracy.valid) for r in out]
    assert acc == [(1.0, True), (1.0, True), (1.0, True), (0.0, True), (0.0, True), (1.0, True),
                   (None, False), (None, False)]
    assert [r.exact_accuracy.value for r in out][:4] == [1.0, 0.0, 0.0, 0.0]


def test_contained_passages_all_lengths(spark):
    long = " ".join(f"w{i}" for i in range(30))
    short = "alpha beta gamma delta epsilon zeta"
    tiny = "xy zz"
    docs = [(1, "pre " + long + " post", "s", "en"), (2, "alphabet alpha beta gamma delta epsilon zetas", "s", "en"),
            (3, "nothing here", "s", "en"), (4, "axy zzz and more", "s", "en"),
            (5, long[3:] + "\n" + short, "s", "en")]
    bench = spark.createDataFrame([(10, long), (11, short), (12, tiny), (13, long[3:40]), (14, "not present at all")],
                                  "item_id long, text string")
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    got = sorted((r.item_id, r.doc_id) for r in fx.contained_passages(bench, d).collect())
    want = sorted((b, dd) for b, bt in [(10, long), (11, short), (12, tiny), (13, long[3:40]), (14, "not present at all")]
                  for dd, dt, _, _ in docs if bt in dt)
    assert got == want and len(want) >= 5


def test_passages_of_one_and_two_tokens_and_edges(spark):
    passages = [(1, "needle"), (2, "ba se"), (3, " edge"), (4, "edge "), (5, "two  words"), (6, "a b a"), (7, "é x"), (8, "absent one here"), (9, "\nline two")]
    docs = [(1, "a needles b"), (2, "alba sea"), (3, "an edge case"), (4, "edge"), (5, "two  words"), (6, "two words"), (7, "xa b ab"), (8, "café xy"),
            (9, "first\nline two"), (10, ""), (11, "needle needle needle")]
    bench = spark.createDataFrame(passages, "item_id long, text string")
    d = spark.createDataFrame([(i, t, "s", "en") for i, t in docs], "doc_id long, text string, source string, lang string")
    got = sorted((r.item_id, r.doc_id) for r in fx.contained_passages(bench, d).collect())
    want = sorted((i, k) for i, p in passages for k, t in docs if p in t)
    assert got == want and len(want) == 9
