"""Operator 7: near-duplicates by SuperMinHash, banding, verification, union-find.

Signatures.  Each shingle ranks all registers by a permutation of its own; in
round ``j`` it offers ``j + u`` to the register of rank ``j``, and a register
keeps the least offer.  The ranks of one shingle are thus correlated, which
lowers the variance, and a text is done (early stop) once every register holds
less than ``j + 1``, as later offers are larger.

Candidates.  Texts with equal sets are one class and go on as one row.  Classes
that agree in all registers of a band meet in a bucket.  First each bucket's
least member is paired with the others, pairs are verified on the full sets, and
links are joined to components; that settles nearly all copies at a cost in
proportion to their number.  In a bucket that still holds several components,
the members outside its largest one are then verified against all members of
that component and against each other, in blocks of ``BLOCK`` sets that are
compared inside the tasks.  So every pair of a bucket is connected already or
verified, and no pair but a verified link ever becomes a row.

Components.  Links are contracted by union-find inside the tasks and joined
across them by distributed star contraction until nothing changes.

Bands: a pair at the least similarity shares a bucket with probability
``1 - (1 - 0.8**6)**42``, over 0.999997.

Edge cases: a text without words has an empty set and links with nothing; one of
fewer than k words has its whole sequence as its one shingle; repeated rows are
one class; rows that share an id but not their text are judged by their texts and
carry the same component only if linked or the least of both; a null id takes part
in no link (component null, kept), but in ``keep_first``; an empty table gives an
empty result; extra columns are never read or, in ``keep_first``, returned as they
came.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubric.llm import bloom
from rubric.llm.common import scratch_dir
from rubric.llm.shingles import U64, chunks, mix, shingle_sets, text_bytes
from rubric.session import cut_lineage

REGISTERS = 256
ROWS_PER_BAND, BANDS = 6, 42
#: Links need ``PERCENT`` of the union's shingles in common.
PERCENT = 80
SHINGLE = 5
#: Sets that one task compares with as many others at once.
BLOCK = 64
#: Parts of a component's classes.
SALTS = 16


def _permuted(keys: np.ndarray, rank: int) -> np.ndarray:
    """The register that each key's permutation of 0..255 has at ``rank``:
    steps that are bijections of eight bits, with constants from the key."""
    part = lambda s: ((keys >> U64(s)) & U64(255)).astype(np.uint8)
    x = np.full(len(keys), rank, np.uint8)
    x = x * (part(0) | np.uint8(1)) + part(8)
    x ^= x >> np.uint8(4)
    x = x * (part(16) | np.uint8(1)) + part(24)
    x ^= x >> np.uint8(3)
    x = x * (part(32) | np.uint8(1)) + part(40)
    return x ^ (x >> np.uint8(4))


def super_minhash(hashes: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """Signatures (n_texts x REGISTERS) of the sets of shingle hashes."""
    table = np.full((n_texts, REGISTERS), 0xFFFFFFFF, np.uint32)
    flat = table.reshape(-1)
    keys = mix(hashes ^ U64(0xA5A5A5A5A5A5A5A5))
    live_hash, live_key, live_owner = hashes, keys, owner
    for rank in range(REGISTERS):
        if len(live_hash) == 0:
            break
        salt = U64((rank + 1) * 0xD1B54A32D192ED03 % (1 << 64))
        draw = (mix(live_hash + salt) >> U64(40)).astype(np.uint32)
        offer = np.uint32(rank << 24) | draw
        np.minimum.at(flat, live_owner * REGISTERS + _permuted(live_key, rank), offer)
        going = np.unique(live_owner)
        open_texts = np.zeros(n_texts, bool)
        open_texts[going] = table[going].max(1) >= np.uint32((rank + 1) << 24) if rank < 255 else False
        keep = open_texts[live_owner]
        live_hash, live_key, live_owner = live_hash[keep], live_key[keep], live_owner[keep]
    return table


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per text and band."""
    rows = signatures[:, :BANDS * ROWS_PER_BAND].reshape(len(signatures), BANDS, ROWS_PER_BAND).astype(U64)
    key = np.broadcast_to(np.arange(BANDS, dtype=U64) * U64(0x9E3779B97F4A7C15), rows.shape[:2])
    for r in range(ROWS_PER_BAND):
        key = mix(key ^ rows[:, :, r])
    return key


def text_digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, t, n, cls, bands): digest of the text, set size, digest of the set, band keys."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            for a, b in chunks(ends):
                own = ends[a:b + 1] - ends[a]
                hashes, owner = shingle_sets(data[ends[a]:ends[b]], own, k)
                cuts = np.searchsorted(owner, np.arange(b - a + 1))
                raw = hashes.tobytes()
                digests = [hashlib.blake2b(raw[8 * s:8 * e], digest_size=16).digest() for s, e in zip(cuts[:-1], cuts[1:])]
                keys = band_keys(super_minhash(hashes, owner, b - a)).astype(np.int64)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (b - a + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("t").slice(a, b - a), pa.array(np.diff(cuts)), pa.array(digests, pa.binary()), bands],
                    ["doc_id", "t", "n", "cls", "bands"])

    return docs.select("doc_id", "text", text_digest(F.col("text")).alias("t")).mapInArrow(
        run, "doc_id long, t binary, n long, cls binary, bands array<long>")


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, cls, grams): the sorted 64-bit shingle hashes of each text and
    their digest."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            for a, b in chunks(ends):
                hashes, owner = shingle_sets(data[ends[a]:ends[b]], ends[a:b + 1] - ends[a], k)
                cuts = np.searchsorted(owner, np.arange(b - a + 1))
                raw = hashes.tobytes()
                sets = [raw[8 * s:8 * e] for s, e in zip(cuts[:-1], cuts[1:])]
                digests = [hashlib.blake2b(x, digest_size=16).digest() for x in sets]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(digests, pa.binary()), pa.array(sets, pa.binary())],
                                                 ["doc_id", "cls", "grams"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, cls binary, grams binary")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                s, t = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                place = np.searchsorted(t, s)
                place[place == len(t)] = 0
                both = int((t[place] == s).sum()) if len(t) else 0
                keep.append(100 * both >= percent * (len(s) + len(t) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_x = pairs.join(sets.select(F.col("rep").alias("a"), F.col("grams").alias("x")), "a")
    both = with_x.join(sets.select(F.col("rep").alias("b"), F.col("grams").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a partition's links: each node with its least member."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if root(x) != x]
    yield pa.RecordBatch.from_pydict({"a": pa.array(nodes, pa.int64()), "b": pa.array([root(x) for x in nodes], pa.int64())})


def components(links: DataFrame) -> DataFrame:
    """(node, root): each linked node that is not the least of its component.

    Star contraction: every node's larger neighbours, then every node's
    neighbours, move to its least neighbour, until all links are stars.
    """
    links = cut_lineage(links.mapInArrow(_contract, "a long, b long").distinct())  # a > b
    while True:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
                 .union(down.select("a", F.col("m").alias("b"))).distinct())
        new = cut_lineage(small)
        # all links are stars when no node is both a leaf and a root, and no leaf has two roots
        state = new.select(F.col("a").alias("n"), F.lit(1).alias("leaf"), F.lit(0).alias("top")).union(
            new.select(F.col("b").alias("n"), F.lit(0).alias("leaf"), F.lit(1).alias("top")).distinct())
        busy = state.groupBy("n").agg(F.sum("leaf").alias("leaf"), F.max("top").alias("top")).where("leaf > 1 or (leaf > 0 and top > 0)")
        if busy.isEmpty():
            return new.select(F.col("a").alias("node"), F.col("b").alias("root"))
        links = new


def _blocks(rows: DataFrame, sets: DataFrame, size: int) -> DataFrame:
    """(grp, blk, docs): the sets of each group's (grp, rep), about ``size`` together."""
    counts = rows.groupBy("grp").agg(F.count("*").alias("c"))
    dealt = rows.join(counts, "grp").select("grp", "rep", F.pmod(F.xxhash64("rep"), F.ceil(F.col("c") / size)).alias("blk"))
    return dealt.join(sets, "rep").groupBy("grp", "blk").agg(F.collect_list(F.struct("rep", "grams")).alias("docs"))


def _block_links(pairs: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the sets of two blocks (``x`` and ``y``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x, y = (batch.column(c)[row].as_py() for c in ("x", "y"))
                grams = [np.frombuffer(d["grams"], U64) for d in y]
                sizes, names = np.array([len(g) for g in grams]), np.array([d["rep"] for d in y])
                flat, owner = np.concatenate(grams), np.repeat(np.arange(len(y)), sizes)
                a, b = [], []
                for d in x:
                    own = np.frombuffer(d["grams"], U64)
                    place = np.searchsorted(own, flat)
                    place[place == len(own)] = 0
                    both = np.bincount(owner[own[place] == flat], minlength=len(y))
                    hit = names[(100 * both >= percent * (len(own) + sizes - both)) & (names != d["rep"])]
                    a += [d["rep"]] * len(hit)
                    b += hit.tolist()
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return pairs.select("x", "y").mapInArrow(run, "a long, b long")


def _rest_links(now: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the buckets that hold several components: (bucket, rep, root)."""
    sizes = now.groupBy("bucket", "root").agg(F.count("*").alias("m"))
    top = sizes.groupBy("bucket").agg(F.count("*").alias("c"), F.max(F.struct("m", "root")).alias("top"))
    top = top.where("c > 1").select("bucket", F.col("top.root").alias("main"))
    others = cut_lineage(now.join(top, "bucket").where("root != main").select("bucket", "rep", "main"))
    probes = others.select(F.col("main").alias("grp"), "rep").distinct()
    wanted = probes.select("grp").distinct()
    inside = now.select("rep", F.col("root").alias("grp")).distinct().join(wanted, "grp", "left_semi").select("grp", "rep")
    left = _blocks(probes, sets, BLOCK).select("grp", F.col("docs").alias("x"))
    right = _blocks(inside, sets, BLOCK).select("grp", F.col("docs").alias("y"))
    own = _blocks(others.select(F.col("bucket").alias("grp"), "rep").join(
        others.groupBy(F.col("bucket").alias("grp")).count().where("count > 1").select("grp"), "grp"), sets, BLOCK)
    each = own.select("grp", "blk", F.col("docs").alias("x")).join(
        own.select("grp", F.col("blk").alias("to"), F.col("docs").alias("y")), "grp").where("blk <= to")
    return _block_links(left.join(right, "grp"), percent).union(_block_links(each, percent)).distinct()


def _grouped(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, t, n, root, component_id) of each row of (doc_id, text); ``root``
    names the group, null for rows without words or without id.

    A class of equal sets is known by its digest and gets a number of its own, so
    rows that share an id but not their text stay apart."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "near")
    sketches(docs, k).write.parquet(f"{folder}/sketch")
    sketch = spark.read.parquet(f"{folder}/sketch")
    usable = sketch.where("doc_id is not null and n > 0")
    classes = usable.groupBy("cls").agg(F.min("doc_id").alias("least"), F.min("n").alias("n"))
    classes.withColumn("rep", F.monotonically_increasing_id()).write.parquet(f"{folder}/classes")
    classes = spark.read.parquet(f"{folder}/classes")
    bands = usable.select("cls", "bands").dropDuplicates(["cls"]).join(classes, "cls").select("rep", "n", F.explode("bands").alias("bucket"))
    buckets = cut_lineage(bands.join(bands.groupBy("bucket").count().where("count > 1").select("bucket"), "bucket"))
    members = buckets.select("bucket", "rep", "n")
    wanted = cut_lineage(classes.join(members.select("rep").distinct(), "rep", "left_semi"))
    # texts without partners are left out before the shuffle, but for the filter's false hits
    ids = wanted.select(F.col("least").alias("doc_id"))
    near = bloom.flag(docs.select("doc_id", "text"), F.xxhash64("doc_id"), ids.select(F.xxhash64("doc_id").alias("key"))).where("maybe")
    mine = near.drop("maybe").join(ids.distinct(), "doc_id", "left_semi")
    sets = (full_sets(mine, k).dropDuplicates(["doc_id", "cls"])
            .join(wanted.select(F.col("least").alias("doc_id"), "cls", "rep"), ["doc_id", "cls"]).select("rep", "grams"))
    sets.write.parquet(f"{folder}/sets")
    sets = spark.read.parquet(f"{folder}/sets")
    least = F.min("rep").alias("p"), F.min(F.struct("rep", "n"))["n"].alias("pn")
    star = members.join(members.groupBy("bucket").agg(*least), "bucket")
    fits = (F.col("n") * 100 >= F.col("pn") * percent) & (F.col("pn") * 100 >= F.col("n") * percent)
    pairs = star.where((F.col("rep") != F.col("p")) & fits).select(F.col("p").alias("a"), F.col("rep").alias("b")).distinct()
    links = cut_lineage(verify(pairs, sets, percent))
    roots = components(links)
    now = cut_lineage(members.join(roots, F.col("rep") == F.col("node"), "left").select(
        "bucket", "rep", F.coalesce("root", "rep").alias("root")))
    more = cut_lineage(_rest_links(now, sets, percent))
    if not more.isEmpty():
        roots = components(more.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    rooted = classes.select("cls", "rep", "least").join(roots, F.col("rep") == F.col("node"), "left").select(
        "cls", "least", F.coalesce("root", "rep").alias("root"), F.pmod(F.xxhash64("rep"), F.lit(SALTS)).alias("salt"))
    # one component may hold a third of all classes: its name is looked up in SALTS parts
    named = rooted.groupBy("root").agg(F.min("least").alias("component")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    of_class = rooted.join(named, ["root", "salt"]).select("cls", "root", "component")
    out = sketch.select("doc_id", "t", "n", "cls").join(of_class, "cls", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    has_id = F.col("doc_id").isNotNull()
    return out.select("doc_id", "t", "n", F.when(has_id & (F.col("n") > 0), F.col("root")).alias("root"), F.when(has_id, component).alias("component_id"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of (doc_id, text)."""
    return _grouped(docs, k, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


#: Rows without an id are told apart by their text, by numbers from here on.
NO_ID = 1 << 62


def keep_first(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group: of the least id, once.

    Rows without an id come after all others.  Among rows of the least id the one
    with the least digest of its text stays, and of rows equal in both any one.
    Texts without words link with nothing; rows of them go only if another has
    their id."""
    text = F.col("text").cast("string")
    # rows without an id: a number from their text, so that equal ones have one
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID) + F.pmod(F.xxhash64(text), F.lit(1 << 61)))
    groups = _grouped(docs.select(own.alias("doc_id"), text.alias("text")), k, percent)
    # rows without words are a group with those of their id
    group = F.struct("root", F.when(F.col("root").isNull(), F.col("doc_id")).alias("id")).alias("grp")
    keys = groups.groupBy(group, "doc_id", "t").agg(F.count("*").alias("c"))
    first = keys.groupBy("grp").agg(F.min(F.struct("doc_id", "t")).alias("first"))
    stays = F.struct("doc_id", "t") == F.col("first")
    marks = cut_lineage(keys.join(first, "grp").select(
        F.col("doc_id").alias("__id"), F.col("t").alias("__t"), stays.alias("stays"), (F.col("c") > 1).alias("repeated"))
        .where(~F.col("stays") | F.col("repeated")))
    # rows whose id no mark has stay, unshuffled; only the filter's hits meet the marks
    keyed = docs.select(F.struct(*docs.columns).alias("__row"), own.alias("__id"), text.alias("__text"))
    flagged = bloom.flag(keyed, F.xxhash64("__id"), marks.select(F.xxhash64("__id").alias("key")))
    clear = flagged.where("not maybe").select("__row")
    keyed = flagged.where("maybe").select("__row", "__id", text_digest(F.col("__text")).alias("__t"))
    at = ["__id", "__t"]
    alone = keyed.join(marks.select(*at), at, "left_anti")
    # nearly always few; equal rows are combined before they are shuffled
    repeated = keyed.join(marks.where("stays").select(*at), at, "left_semi").dropDuplicates(at)
    return clear.unionByName(alone.select("__row")).unionByName(repeated.select("__row")).select("__row.*")
