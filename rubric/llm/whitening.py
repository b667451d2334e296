"""Operator 13: embedding whitening with a weighted multiplicity covariance.

Method: vectors become integers ``x = floor(64 c) + 1000000``; identical x vectors
are grouped and their counts (or one each) are the fit weights.  Sums are exact
integers; the covariance is a weighted GEMM of centred vectors, one product a
batch, added by dimension.  Its eigenvectors (a dimensions x dimensions matrix on
the driver) whiten each distinct vector once, and the rows join the result back.

Bounds: the driver holds one matrix of dimensions squared and the sums; tasks hold one
Arrow batch and one such matrix.  Rows meet their vector by a 128-bit digest of x.
A vector that holds at least one in ``HOT`` rows is sent to all tasks: there are at
most ``HOT`` such vectors whatever the table, so a third of all rows may be copies of
one vector without one task reading them.  What later steps read more than once is
written to the shared checkpoint folder.

Edge cases: rows whose vector is null, empty, or holds null or non-finite entries are
dropped, also those with an entry so large that x is no long (64 times its size is
2^62 or more) and, where lengths differ, those not of the commonest length (the longer of
equally common ones).  Components whose variance is below ``RANK`` of the largest
are rounding and left out, so vectors that are all equal, like an empty table, give
no rows.  A deviation that no long can hold is null.  Repeated rows and ids are
returned as often as they come; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rubric.session import cut_lineage

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(2 ** 62)
#: A vector of at least one in HOT rows goes to all tasks.
HOT = 256
#: Variances below this share of the largest are rounding.
RANK = 1e-11
LONG_MAX = 2 ** 63 - 1


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the rows that can take part."""
    entry = lambda c: F.abs(c.cast("double") * SCALE) < LARGEST  # noqa: E731  (false for NaN and infinities)
    v = F.col("v")
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    # the test stays inside the expression: filters on x may be asked before others
    usable = F.when((F.size(v) > 0) & F.coalesce(F.forall(v, entry), F.lit(False)), x)
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
            .select("vec_id", usable.alias("x")).where(F.col("x").isNotNull()))


def digest(x: Column) -> Column:
    return F.md5(F.array_join(x, ","))


# ---------------------------------------------------------------------------
# Weighted sums and covariances, one partial result a task
# ---------------------------------------------------------------------------

def _matrix(column: pa.ListArray, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in batches if b.num_rows)


def exact_sums(vectors: DataFrame, dims: int) -> tuple[int, list[int]]:
    """(total weight, weighted sum of each dimension) as exact integers."""
    def partial(batches):
        n, high, low = 0, [0] * dims, [0] * dims
        for b in _batches(batches):
            x, w = _matrix(b.column("x"), np.int64), b.column("weight").to_numpy().astype(object)
            n += int(w.sum())
            # Python integers: a weight times a half of x may pass 64 bits
            high = [h + int(v) for h, v in zip(high, w @ (x >> 32).astype(object))]
            low = [h + int(v) for h, v in zip(low, w @ (x & 0xFFFFFFFF).astype(object))]
        yield pa.RecordBatch.from_pydict(
            {"dim": pa.array(range(dims), pa.int32()), "n": pa.array([str(n)] * dims),
             "s": pa.array([str((h << 32) + v) for h, v in zip(high, low)])})
    total = (vectors.select("x", "weight").mapInArrow(partial, "dim int, n string, s string").groupBy("dim")
             .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    by_dim = {r["dim"]: r for r in total}
    return int(by_dim[0]["n"]), [int(by_dim[d]["s"]) for d in range(dims)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S`` exactly: 64-bit where that holds it, else Python integers."""
    largest = max(int(np.abs(x).max(initial=0)) * n, max((abs(s) for s in sums), default=0))
    if largest < 2 ** 62:
        return x * np.int64(n) - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def scatter(vectors: DataFrame, dims: int, centred: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum of weight times outer product of the centred vectors: one GEMM a batch,
    one matrix a task, added by row of the matrix in order of the tasks."""
    def products(batches):
        total = np.zeros((dims, dims))
        for b in _batches(batches):
            c, w = centred(b), b.column("weight").to_numpy().astype(np.float64)
            total += (c * w[:, None]).T @ c
        yield pa.RecordBatch.from_pydict({"dim": pa.array(range(dims), pa.int32()), "line": pa.array(list(total), pa.list_(pa.float64()))})

    def add(batches):
        lines: dict[int, np.ndarray] = {}
        for b in _batches(batches):
            for dim, line in zip(b.column("dim").to_numpy(), _matrix(b.column("line"), np.float64)):
                lines[int(dim)] = lines[int(dim)] + line if int(dim) in lines else line
        yield pa.RecordBatch.from_pydict({"dim": pa.array(list(lines), pa.int32()), "line": pa.array(list(lines.values()), pa.list_(pa.float64()))})

    parts = vectors.mapInArrow(products, "dim int, line array<double>").withColumn("task", F.spark_partition_id())
    rows = (parts.repartition("dim").sortWithinPartitions("dim", "task").select("dim", "line")
            .mapInArrow(add, "dim int, line array<double>").collect())   # dims rows
    out = np.zeros((dims, dims))
    for r in rows:
        out[r["dim"]] = r["line"]
    return out


def means(vectors: DataFrame, dims: int, n: int) -> np.ndarray:
    """Weighted means of the ``whitened`` vectors."""
    def partial(batches):
        total = np.zeros(dims)
        for b in _batches(batches):
            total += b.column("weight").to_numpy().astype(np.float64) @ _matrix(b.column("whitened"), np.float64)
        yield pa.RecordBatch.from_pydict({"dim": pa.array(range(dims), pa.int32()), "s": pa.array(total)})
    sums = {r["dim"]: r["s"] for r in vectors.select("whitened", "weight").mapInArrow(partial, "dim int, s double").groupBy("dim").agg(F.sum("s").alias("s")).collect()}
    return np.array([sums[d] for d in range(dims)]) / n


# ---------------------------------------------------------------------------
# Operator
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: total weight, exact sums, and by component its unit
    eigenvector, variance and share of all variance (falling variance)."""
    n: int
    sums: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    explained: np.ndarray


def distinct_vectors(rows: DataFrame, weights: str = "counts") -> tuple[DataFrame, int]:
    """(x, copies, weight, key) of each distinct vector of the common length, written to the
    shared folder, and that length (0: none)."""
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    grouped = cut_lineage(rows.groupBy("x").agg(F.count("*").alias("copies")).select(
        "x", "copies", weight.alias("weight"), digest(F.col("x")).alias("key")))
    common = grouped.groupBy(F.size("x").alias("dims")).agg(F.sum("copies").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    dims = common["dims"] if common else 0
    return grouped.where(F.size("x") == dims), dims


def fit(vectors: DataFrame, dims: int, components: int) -> Whitening:
    """Whitening by the weighted covariance of the distinct vectors."""
    n, sums = exact_sums(vectors, dims)

    def centred(batch):
        return deviations(_matrix(batch.column("x"), np.int64), n, sums).astype(np.float64) / n
    covariance = scatter(vectors.select("x", "weight"), dims, centred) / n
    covariance = (covariance + covariance.T) / 2
    values, columns = np.linalg.eigh(covariance)
    values, columns = values[::-1], columns[:, ::-1]
    keep = int(np.sum(values[:components] > max(values[0], 0) * RANK))
    return Whitening(n, sums, np.ascontiguousarray(columns[:, :keep].T), values[:keep].copy(), values[:keep] / np.trace(covariance) if keep else values[:0])


def _squares(d: np.ndarray) -> list[int | None]:
    """Exact sums of squares; None where a long cannot hold one."""
    rough = (d.astype(np.float64) ** 2).sum(axis=1)
    exact = (d * d).sum(axis=1) if d.dtype != object else None
    out = []
    for i, r in enumerate(rough):
        if exact is not None and r < 2.0 ** 62:
            out.append(int(exact[i]))
        elif r < 2.0 ** 64:
            s = sum(int(v) * int(v) for v in d[i])
            out.append(s if s <= LONG_MAX else None)
        else:
            out.append(None)
    return out


def whiten_vectors(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(key, copies, weight, deviation, whitened) of each distinct vector."""
    n, sums, project = model.n, model.sums, (model.vectors / np.sqrt(model.variances)[:, None]).T

    def run(batches):
        for b in _batches(batches):
            d = deviations(_matrix(b.column("x"), np.int64), n, sums)
            whitened = (d.astype(np.float64) / n) @ project
            yield pa.RecordBatch.from_pydict({
                "key": b.column("key"), "copies": b.column("copies"), "weight": b.column("weight"),
                "deviation": pa.array(_squares(d), pa.int64()), "whitened": pa.array(list(whitened), pa.list_(pa.float64()))})
    return vectors.select("x", "key", "copies", "weight").mapInArrow(
        run, "key string, copies long, weight long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, n: int, components: int) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    mean = means(whitened, components, n)

    def centred(batch):
        return _matrix(batch.column("whitened"), np.float64) - mean
    return float(np.abs(scatter(whitened.select("whitened", "weight"), components, centred) / n - np.eye(components)).max())


RESULT = "vec_id long, n long, deviation long, whitened array<double>"
REPORT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32,
           weights: str = "counts") -> tuple[DataFrame, Whitening | None, float | None]:
    """((vec_id, n, deviation, whitened) of each row that takes part, the fitted
    whitening, its identity error); ``weights`` is ``counts`` or ``ones``."""
    spark = rows.sparkSession
    taking_part = integer_vectors(rows, id_col, vector_col)
    vectors, dims = distinct_vectors(taking_part, weights)
    model = fit(vectors, dims, components) if dims else None
    if model is None or not len(model.variances):
        return spark.createDataFrame([], RESULT), None, None
    whitened = cut_lineage(whiten_vectors(vectors, model))
    error = identity_error(whitened, model.n, len(model.variances))
    result = whitened.select("key", "copies", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened")
    total = whitened.agg(F.sum("copies")).first()[0]
    is_hot = F.col("copies") * HOT >= total   # at most HOT vectors
    keyed = taking_part.where(F.size("x") == dims).select("vec_id", digest(F.col("x")).alias("key"))
    hot = F.broadcast(result.where(is_hot).drop("copies"))
    of_hot = keyed.join(hot, "key")
    others = keyed.join(F.broadcast(result.where(is_hot).select("key")), "key", "left_anti").join(result.where(~is_hot).drop("copies"), "key")
    return of_hot.unionByName(others).drop("key"), model, error


def whitening_report(rows: DataFrame, components: int = 32) -> DataFrame:
    """One row for each row that takes part and component, with the fit's figures."""
    out, model, error = whiten(rows, components=components)
    if model is None:
        return rows.sparkSession.createDataFrame([], StructType.fromDDL(REPORT))
    explained = F.array(*[F.lit(float(v)) for v in model.explained])
    return out.select("vec_id", "n", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
