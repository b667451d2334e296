"""Operator 6: approximate nearest neighbours by a forest of random-projection
trees.

Inner products become angles by one more component, ``sqrt(M**2 - |v|**2)`` with
the largest norm M, which queries have at 0.  Rows with equal vectors are one
point, kept with its least ids, so no number of copies can fill a leaf.

A routing tree, fitted on a bounded uniform sample, deals the points to shards of
about ``SHARD`` points; its size follows the number of shards and is checked
before it goes to the tasks.  Each shard grows a forest of ``TREES`` trees that
split at the median of a random two-point projection down to leaves of
``LEAF`` points.  A query is sent to a fixed share of all shards (``PROBE_SHARE``,
at least ``PROBES``), those with the least sum of squared margins on the way; there
one priority queue, shared by all trees, takes the most promising branch next
until a fixed share of the shard's points (``GATHER_SHARE``, at least
``CANDIDATES``) is gathered, each counted once, which are reranked exactly.  The
best of all shards are merged.  Both are shares, not numbers, because vectors
without clusters in many dimensions have their nearest neighbours spread over most
shards: fixed numbers lose recall as the table grows.  The work of a query
therefore follows the table's size.

Edge cases: null, zero, or partly null or non-finite vectors take no part, nor do
vectors of another length than the commonest (of equally common ones the longer); equal
scores order by id; fewer points than asked give all of them; repeated rows with
one id are distinct candidates of that id only once; an empty table gives an
empty result; extra columns are never read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Points of a shard, as the sample tells; the sample's size; points of a leaf.
SHARD = 16_384
SAMPLE = 8_192
LEAF = 64
TREES = 12
#: Shards that a query is sent to: a share of all, and the least number.
PROBE_SHARE = 0.875
PROBES = 6
#: Distinct points that a search gathers in a shard before the exact rerank: a
#: share of the shard's, and the least number.
GATHER_SHARE = 0.65
CANDIDATES = 3_000
#: Bytes of the routing tree beyond which shards grow instead.
MAX_TREE_BYTES = 64 << 20


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): finite, non-zero vectors as doubles."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()
                      & F.forall("v", finite) & F.exists("v", lambda x: x != 0))


def _split(points: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float] | None:
    """A plane between two random points, at the median of all points."""
    for _ in range(4):
        i, j = rng.integers(len(points), size=2)
        normal = points[i] - points[j]
        size = np.linalg.norm(normal)
        if size == 0:
            continue
        normal = normal / size
        along = points @ normal
        cut = float(np.median(along))
        if (along < cut).any():
            return normal, cut
    return None


def grow(points: np.ndarray, leaf: int, rng: np.random.Generator) -> list[tuple]:
    """A tree as a list of nodes: (normal, cut, left, right) or (members,)."""
    nodes: list = [None]
    todo = [(0, np.arange(len(points)))]
    while todo:
        at, members = todo.pop()
        plane = _split(points[members], rng) if len(members) > leaf else None
        if plane is None:
            nodes[at] = (members,)
            continue
        low = points[members] @ plane[0] < plane[1]
        nodes[at] = (*plane, len(nodes), len(nodes) + 1)
        nodes += [None, None]
        todo += [(len(nodes) - 2, members[low]), (len(nodes) - 1, members[~low])]
    return nodes


def search(trees: list[list[tuple]], query: np.ndarray, enough: int) -> np.ndarray:
    """Members of the leaves that one queue over all trees visits until
    ``enough`` distinct ones are gathered; the least of the largest margins on
    the way comes first."""
    queue = [(-np.inf, t, 0) for t in range(len(trees))]
    seen, n = np.zeros(sum(len(node[0]) for node in trees[0] if len(node) == 1) if trees else 0, bool), 0
    while queue and n < enough:
        margin, t, at = heapq.heappop(queue)
        node = trees[t][at]
        while len(node) > 1:
            normal, cut, left, right = node
            side = float(query @ normal) - cut
            near, far = (left, right) if side < 0 else (right, left)
            heapq.heappush(queue, (max(margin, abs(side)), t, far))
            node = trees[t][near]
        n += len(node[0]) - int(np.count_nonzero(seen[node[0]]))
        seen[node[0]] = True
    return np.flatnonzero(seen)


def _leaves(tree: list[tuple], query: np.ndarray, probes: int) -> list[int]:
    """The ``probes`` leaves of a tree with the least sums of squared margins, by
    leaf number."""
    queue, found = [(0.0, 0)], []
    while queue and len(found) < probes:
        margin, at = heapq.heappop(queue)
        while len(tree[at]) > 1:
            normal, cut, left, right = tree[at]
            side = float(query @ normal) - cut
            near, far = (left, right) if side < 0 else (right, left)
            heapq.heappush(queue, (margin + side * side, far))
            at = near
        found.append(at)
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.values.to_numpy(zero_copy_only=False)
    width = len(column[0]) if len(column) else 0
    start = column.offsets[0].as_py() if len(column) else 0
    return flat[start:start + len(column) * width].reshape(len(column), width)


def _lift(x: np.ndarray, norm: float) -> np.ndarray:
    """Points on the sphere of radius ``norm``: angles order as inner products."""
    rest = np.sqrt(np.maximum(norm * norm - (x * x).sum(1), 0))
    return np.column_stack([x, rest])


def routed(points: DataFrame, tree: list[tuple], norm: float, probes: int, lift: bool) -> DataFrame:
    """(shard, vec_id, v): each point with its shard, or its nearest shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _matrix(batch.column("v"))
            x = _lift(x, norm) if lift else np.column_stack([x, np.zeros(len(x))])
            leaves = [_leaves(tree, q, probes) for q in x]
            take = np.repeat(np.arange(len(x)), [len(s) for s in leaves])
            out = batch.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([pa.array([s for own in leaves for s in own], pa.int64()), out.column("vec_id"), out.column("v")], ["shard", "vec_id", "v"])

    return points.select("vec_id", "v").mapInArrow(run, "shard long, vec_id long, v array<double>")


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
            trees: int = TREES, candidates: int = CANDIDATES, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best by inner product,
    its own row excluded."""
    rows = usable(vectors, id_col, vector_col)
    # inner products need one length: the commonest, of equally common ones the longer
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    same = F.size("v") == (common["d"] if common else 0)
    rows = rows.where(same)
    # equal vectors are one point; a query may own one of its ids, so k + 1 are kept
    ids = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    least = (rows.dropDuplicates(["vec_id"]).withColumn("r", ids).where(F.col("r") <= k + 1)
             .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    points = least.select(F.element_at("ids", 1).alias("vec_id"), "v")
    asked = usable(queries, id_col, vector_col).where(same).dropDuplicates(["vec_id"])
    wanted = asked.groupBy("v").agg(F.min("vec_id").alias("vec_id"))

    state = points.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    n, norm = state["n"], float(state["m"] or 0.0) ** 0.5
    sample = points.sample(False, min(1.0, SAMPLE / max(1, n)), seed=11).limit(2 * SAMPLE).toPandas()
    sample = _lift(np.stack(sample["v"].to_numpy()), norm) if len(sample) else np.zeros((0, 1))
    share = max(len(sample) * SHARD / max(1, n), 2.0)
    while len(sample) and 2 * len(sample) / share * sample.shape[1] * 8 > MAX_TREE_BYTES:
        share *= 2
    router = grow(sample, int(share), np.random.default_rng(3))
    router = [node if len(node) > 1 else (None,) for node in router]
    probes = max(probes, math.ceil(PROBE_SHARE * sum(len(node) == 1 for node in router)))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        own = left.combine_chunks()
        base = _matrix(own.column("v").chunk(0)) if own.num_rows else np.zeros((0, 1))
        asks = right.combine_chunks()
        none = pa.table({"query": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if own.num_rows == 0 or asks.num_rows == 0:
            return none
        rng = np.random.default_rng(int(key[0].as_py()) + 17)
        lifted = _lift(base, norm)
        forest = [grow(lifted, LEAF, rng) for _ in range(trees)]
        enough = max(candidates, math.ceil(GATHER_SHARE * len(base)))
        names = own.column("vec_id").to_numpy()
        out = ([], [], [])
        for query, x in zip(asks.column("vec_id").to_pylist(), _matrix(asks.column("v").chunk(0))):
            got = search(forest, np.append(x, 0.0), enough)
            score = base[got] @ x
            if len(got) > k + 1:
                # everything that ties with the last place stays in
                got = got[score >= np.partition(score, len(score) - k - 1)[len(score) - k - 1]]
            exact = (base[got] * x).sum(1)
            out[0].extend([query] * len(got))
            out[1].extend(names[got].tolist())
            out[2].extend(exact.tolist())
        return pa.table({"query": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    dealt = routed(points, router, norm, 1, True)
    sent = routed(wanted, router, norm, probes, False)
    hits = dealt.groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(run, "query long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = hits.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r")
    # from points back to rows: each point's ids, each query's own ids
    named = best.join(least.select(F.element_at("ids", 1).alias("vec_id"), "ids"), "vec_id")
    named = named.select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = named.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    lists = named.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("hits"))
    members = asked.join(wanted.select("v", F.col("vec_id").alias("query")), "v").select(F.col("vec_id").alias("query_id"), "query")
    found = members.join(lists, "query").select(
        "query_id", F.posexplode(F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)).alias("p", "h"))
    return found.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("h.vec_id").alias("vec_id"), (-F.col("h.s")).alias("score"))
