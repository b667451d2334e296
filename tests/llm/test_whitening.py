"""Whitening against numpy over all rows, copies expanded."""
import math

import numpy as np

from rubric.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>, key string, x string, weight int, copies string"


def expected(rows, components=32):
    """(ids, n, deviations, covariance, explained) from all rows one by one."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept]
    n = len(x)
    sums = [sum(col) for col in zip(*x)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    c = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    cov = c.T @ c / n
    return kept, n, dev, c, cov


def check(got, rows, components=32):
    kept, n, dev, centred, cov = expected(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > values[0] * 1e-9).sum()))
    assert len(got) == len(kept) * k
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    whitened = centred @ vectors[:, :k] / np.sqrt(values[:k])
    for j in range(k):   # either sign, the same for all rows
        first = by_id[kept[0][0]]
        mine = next(r["whitened"] for r in first if r["component"] == j + 1)
        if mine * whitened[0, j] < 0:
            whitened[:, j] *= -1
    for (i, _), d, w in zip(kept, dev, whitened):
        for r in by_id[i]:
            assert r["n"] == n and r["deviation"] == d
            assert abs(r["whitened"] - w[r["component"] - 1]) < 1e-6
            assert abs(r["explained"] / (values[r["component"] - 1] / np.trace(cov)) - 1) < 1e-8
            assert 0 <= r["identity_error"] < 1e-9


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "k", "x", 7, "c") for i, v in rows], SCHEMA).repartition(6)


def test_query_equals_numpy(spark):
    from rubric.llm.queries import op13_embedding_whitening
    rows = [(r[0], [float(c) for c in r[1]]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(op13_embedding_whitening(spark, "/root/testdata/sf0.001").collect(), rows)


def test_copies_count_and_odd_rows_drop(spark):
    rng = np.random.default_rng(2)
    base = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(60, 5)) * [3, 2, 1, 0.5, 0.2])]
    rows = base + [(1000 + i, base[7][1]) for i in range(400)] + [(2000 + i, base[i % 9][1]) for i in range(50)]
    odd = [(3000, None), (3001, []), (3002, [1.0, None, 0.0, 0.0, 0.0]), (3003, [float("nan")] * 5), (3004, [float("-inf"), 0.0, 0.0, 0.0, 0.0])]
    check(wh.whitening_report(vectors(spark, rows + odd)).collect(), rows)
    ragged = [(3005, [1.0, 2.0]), (3006, [1e200] * 5)]
    check(wh.whitening_report(vectors(spark, rows + ragged)).collect(), rows)


def test_fewer_components_and_rank(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(a), float(a), float(b), 0.25]) for i, (a, b) in enumerate(rng.integers(-9, 9, size=(80, 2)))]
    check(wh.whitening_report(vectors(spark, rows)).collect(), rows)     # two of four components
    check(wh.whitening_report(vectors(spark, rows), components=1).collect(), rows, components=1)


def test_weights_of_one(spark):
    rows = [(i, [float(i % 5), float((i * i) % 7)]) for i in range(70)]
    out, model, error = wh.whiten(vectors(spark, rows), weights="ones")
    alone = {tuple(v): i for i, v in rows}
    _, n, _, _, cov = expected([(i, list(v)) for v, i in alone.items()])
    assert model.n == n == len(alone) and error < 1e-9 and out.count() == 70
    assert np.allclose(model.variances, np.linalg.eigvalsh(cov)[::-1])


def test_repeated_ids_and_equal_rows(spark):
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (1, [1.5, 3.0]), (None, [0.0, 7.0])]
    got = wh.whitening_report(vectors(spark, rows)).collect()
    assert len(got) == 4 * 2 and sum(r["vec_id"] is None for r in got) == 2
    assert wh.whitening_report(vectors(spark, [(1, [0.5, 1.0])] * 3)).collect() == []
    assert wh.whitening_report(vectors(spark, [])).collect() == []


def test_large_integers(spark):
    x = np.array([[2 ** 60, 5], [3, 2 ** 61]])
    sums = [int(v) for v in x.astype(object).sum(axis=0)]
    d = wh.deviations(x, 2, sums)
    assert [[int(v) for v in r] for r in d] == [[2 * int(a) - s for a, s in zip(r, sums)] for r in x]
    assert wh._squares(d) == [None, None]
    assert wh._squares(np.array([[2 ** 31, 2 ** 31], [3_037_000_499, 0], [4_000_000_000, 0]])) == [2 ** 63 if 2 ** 63 <= wh.LONG_MAX else None, 3_037_000_499 ** 2, None]
