"""Operator 9: toxic passages as maximum-scoring segments.

Model, fitted on a bounded sample of labelled rows: a token's features are the
word and its prefixes of three to seven characters.  A feature's score is the log
odds of its document counts in toxic and clean rows under a Dirichlet prior made
of the pooled counts, less ``BOUND`` deviations; it takes part if it stands
``MIN_Z`` deviations above zero.  A token scores as its highest feature, at most its first
``REPEATS`` times in a text (later ones score zero, so one chance word repeated all
over a text is no passage).  Tokens without a feature score less than zero by a
drift of ``DRIFT_RATIO`` times the mean score that features give the tokens of clean
rows: small enough that toxic words scattered over a text add up, large enough that
chance ones do not.

Each text is scanned once: the linear-time all-maximal-segments scan finds every
passage whose score cannot be raised by growing or cutting it.  Scores of chance
segments follow an extreme-value law, whose rate solves
``sum p(s) exp(rate * s) = 1`` over the token scores of clean rows, held apart
from those that gave the features.  A segment's expected number of chance
equals, ``tokens * exp(-rate * score)``, makes it significant; the evidence of a
text is the sum of ``-log10`` of that over its significant segments, and a
logistic curve in its logarithm, fitted on the same rows, turns it into a
probability.

Edge cases: null and empty texts have no evidence and get the lowest score; with
no usable label of either kind every text scores 0; labels that disagree for an
id count as toxic; repeated rows score alike; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows on which the model is fitted, at most: a uniform sample.
TRAIN_ROWS = 20_000
PRIOR = 0.5
PRIOR_WEIGHT = 1.0
MIN_Z = 2.7
#: Deviations by which a feature's score is lowered.
BOUND = 2.0
#: Drift in multiples of a clean token's mean score, and the drift where clean rows score nothing.
DRIFT_RATIO, DRIFT = 3.0, 0.5
#: Times that a word scores in one text.
REPEATS = 2
PREFIXES = (3, 4, 5, 6, 7)
SIGNIFICANT = 0.05
THRESHOLD = 0.7
MEMO = 400_000

TOKEN = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def features(token: str) -> list[str]:
    return ["=" + token, *(token[:n] for n in PREFIXES if len(token) >= n)]


@dataclass
class Model:
    """What the workers need to score a text."""

    weights: dict[str, float]  # feature: least credible log odds
    drift: float = DRIFT
    rate: float = 1.0
    bias: float = -50.0
    slope: float = 0.0
    memo: dict[str, float] = field(default_factory=dict)

    def token_score(self, token: str) -> float:
        got = self.memo.get(token)
        if got is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            found = [self.weights[f] for f in features(token) if f in self.weights]
            got = self.memo[token] = max(found, default=-self.drift)
        return got

    def scores(self, text: str) -> list[float]:
        tokens = TOKEN.findall(text.lower())
        out = list(map(self.token_score, tokens))
        times: dict[str, int] = {}
        for at, score in enumerate(out):
            if score > 0:
                n = times[tokens[at]] = times.get(tokens[at], 0) + 1
                if n > REPEATS:
                    out[at] = 0.0
        return out

    def set_drift(self, drift: float) -> None:
        self.drift = drift
        self.memo.clear()

    def passages(self, text: str) -> list[tuple[int, int, float, float]]:
        """(first token, end token, score, expected chance equals) of every
        significant toxic passage."""
        values = self.scores(text)
        n = len(values)
        out = []
        for start, end, score in maximal_segments(values):
            expected = n * math.exp(-min(700.0, self.rate * score))
            if expected < SIGNIFICANT:
                out.append((start, end, score, expected))
        return out

    def evidence(self, text: str) -> float:
        return sum(-math.log10(max(e, 1e-300)) for *_, e in self.passages(text))

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, self.bias + self.slope * math.log1p(evidence)))))


def maximal_segments(values: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score), left to right.

    One pass over the values: each positive value opens a candidate, kept with
    the sums before and up to it; a candidate joins the nearest one to the left
    that starts lower, if that one ends lower too.  Links to that nearest lower
    start make the search linear over the whole pass.
    """
    cand: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum up to, link
    total = 0.0
    for at, value in enumerate(values):
        if value <= 0:
            total += value
            continue
        start, end, before = at, at + 1, total
        total += value
        while True:
            j = len(cand) - 1
            while j >= 0 and cand[j][2] >= before:
                j = cand[j][4]
            if j < 0 or cand[j][3] >= total:
                cand.append((start, end, before, total, j))
                break
            start, before = cand[j][0], cand[j][2]
            del cand[j:]
    return [(s, e, up - before) for s, e, before, up, _ in cand]


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(toxic, text, role) of at most ``limit`` labelled documents, each text
    once; a uniform sample of ids, small enough by its bound to broadcast."""
    order = F.xxhash64(F.lit("train"), F.col("doc_id"))
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(order, "doc_id").limit(limit))
    rows = docs.join(F.broadcast(ids), "doc_id").select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.groupBy(F.md5("text").alias("k")).agg(F.max(F.struct("toxic", "doc_id", "text")).alias("r")).select("r.*")
    return rows.withColumn("fits", F.pmod(F.xxhash64(F.lit("role"), F.col("doc_id")), F.lit(5)) != 0)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each kind that hold a feature, summed over a partition's rows."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
            tokens = set(TOKEN.findall(text.lower()))
            (toxic if label else clean).update({f for t in tokens for f in features(t)})
    names = list(toxic.keys() | clean.keys())
    if names:
        yield pa.RecordBatch.from_pydict({"feature": names, "y1": [toxic[f] for f in names], "y0": [clean[f] for f in names]})


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Model:
    """The model of a bounded sample; what reaches the driver is bounded by it."""
    rows = training_rows(docs, labels, limit).persist()
    try:
        kinds = {(r["fits"], r["toxic"]): r["n"] for r in rows.groupBy("fits", "toxic").agg(F.count("*").alias("n")).collect()}
        n1, n0 = kinds.get((True, 1), 0), kinds.get((True, 0), 0)
        if not n1 or not n0:
            return Model({})
        counts = (rows.where("fits").select("toxic", "text").mapInArrow(_count_features, "feature string, y1 long, y0 long")
                  .groupBy("feature").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")))
        prior = F.lit(PRIOR) + PRIOR_WEIGHT * (F.col("y1") + F.col("y0")) / F.lit(float(n1 + n0))
        odds = lambda y, n: F.log((F.col(y) + prior) / (F.lit(float(n)) - F.col(y) + prior + 1))
        delta = odds("y1", n1) - odds("y0", n0)
        z = delta / F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior))
        sure = counts.select("feature", delta.alias("d"), z.alias("z")).where(F.col("z") >= MIN_Z)
        model = Model({r["feature"]: r["least"] for r in sure.select(
            "feature", (F.col("d") * (1 - BOUND / F.col("z"))).alias("least")).collect()})
        calibrate(model, rows)
        return model
    finally:
        rows.unpersist()


def calibrate(model: Model, rows: DataFrame) -> None:
    """Drift, rate of the extreme-value law and the logistic curve, on the rows that
    gave no feature (on all, if those lack a kind)."""
    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(round(s, 3) for s in model.scores(text))
        yield pa.RecordBatch.from_pydict({"score": pa.array(list(seen), pa.float64()), "n": pa.array(list(seen.values()), pa.int64())})

    apart = rows.where("not fits")
    model.set_drift(0.0)
    null = apart.where("toxic = 0").select("text").mapInArrow(histogram, "score double, n long").groupBy("score").agg(F.sum("n").alias("n"))
    tokens = {r["score"]: float(r["n"]) for r in null.collect()}
    for score in model.weights.values():
        tokens[round(score, 3)] = tokens.get(round(score, 3), 0.0) + 0.5 / len(model.weights)
    silent = tokens.pop(0.0, 0.0) + tokens.pop(-0.0, 0.0) + 1.0
    mean = sum(score * n for score, n in tokens.items()) / silent
    model.set_drift(DRIFT_RATIO * mean or DRIFT)
    model.rate = solve_rate(tokens | {-model.drift: silent})

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([model.evidence(t) for t in batch.column("text").to_pylist()], pa.float64())], ["toxic", "x"])

    points = [(r["x"], r["toxic"]) for r in apart.select("toxic", "text").mapInArrow(judge, "toxic int, x double").collect()]
    if len({y for _, y in points}) < 2:
        points = [(r["x"], r["toxic"]) for r in rows.select("toxic", "text").mapInArrow(judge, "toxic int, x double").collect()]
    model.bias, model.slope = logistic(points)


def solve_rate(tokens: dict[float, float]) -> float:
    """The positive root of ``sum p(s) exp(rate * s) = 1`` (mean score below 0)."""
    total = sum(tokens.values())
    value = lambda r: math.fsum(n / total * math.exp(min(700.0, r * s)) for s, n in tokens.items()) - 1
    low, high = 1e-6, 1e-3
    while value(high) < 0 and high < 20:
        high *= 2
    if value(low) >= 0:
        return low
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return low


def logistic(points: list[tuple[float, int]], ridge: float = 1e-2) -> tuple[float, float]:
    """Newton steps of a one-feature logistic fit with targets kept off 0 and 1."""
    x = np.log1p(np.array([p[0] for p in points], float))
    y = np.array([p[1] for p in points], float)
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design, beta = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (p - t) + ridge * beta
        hess = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


PASSAGES = "doc_id long, score double, passages array<struct<first:long,end:long,score:double,expected:double>>"


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, passages) of every text; passages count tokens."""
    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = [], []
            for text in batch.column("text"):
                got = model.passages(text.as_py() or "") if model.weights else []
                found.append([dict(zip(("first", "end", "score", "expected"), x)) for x in got])
                scores.append(model.probability(sum(-math.log10(max(x[3], 1e-300)) for x in got)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(found, kind)], ["doc_id", "score", "passages"])

    return docs.select("doc_id", "text").mapInArrow(run, PASSAGES)


def toxicity_report(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of passages."""
    scored = score_documents(docs, fit(docs, labels, limit))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"))
