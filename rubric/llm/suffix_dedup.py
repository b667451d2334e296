"""Operator 2: removal of repeated byte passages by hashes at
content-chosen places, in place of distributed prefix doubling.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts
elsewhere.  Ranking every position at every doubled length would shuffle many
times the input, so positions are thinned in a way that loses none:

* Places.  Every window of ``LENGTH`` bytes has one place, the leftmost least
  hash of its ``GRAM``-byte substrings.  Equal windows have equal places, so a
  window can only repeat if its place's rank does.  A run is the stretch of
  windows that share a place.
* First rank.  Spark counts the ranks (names of the ``GRAM`` bytes at a place);
  unique ones are settled: no window of the run repeats.
* Longer ranks.  A run whose whole stretch of bytes, at the same offset from its
  place, is equal to another's repeats in all its windows.  Of each name whose
  runs differ, one run of each kind goes on window by window: pairs (hash of the
  first half, hash of the second half) are sorted, and equal ones repeat.  Up to
  ``TOGETHER`` kinds are sorted in one task, more by Spark over all tasks.

Ranks are names of bytes; no byte goes unless two independent 64-bit names agree.

Edge cases: a null text counts as empty; texts shorter than ``LENGTH`` bytes keep
all; repeated rows remove each other where long enough; rows are told apart by
a 64-bit digest of id and text, so ids may be null or repeat; an empty table
gives an empty result; extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rubric.llm.shingles import CHUNK, U64, chunks, mix, text_bytes

LENGTH = 200
GRAM = 32
#: Runs whose windows are named at once.
SPANS = 1024
#: Kinds of runs of one name whose windows one task compares, 1.5 MB of bytes at
#: most; the windows of names with more kinds are ranked by Spark over all tasks.
TOGETHER = 4096

_BASE, _BASE2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse's powers modulo 2**64 for i < n at least."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 21)
        one = lambda b: np.cumprod(np.concatenate([np.ones(1, U64), np.full(size - 1, b, U64)]), dtype=U64)
        have = _POWERS[base] = one(base), one(pow(base, -1, 1 << 64))
    return have


class Names:
    """Names of any substring of a buffer in constant time each."""

    def __init__(self, data: np.ndarray, base: int = _BASE):
        self.up, self.down = _powers(base, len(data) + 1)
        # random numbers instead of bytes, so that no byte is zero
        letters = mix(np.arange(256, dtype=U64) * U64(base))
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(letters[data] * self.up[:len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def _least_places(order: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` numbers, the place of its leftmost least."""
    n = len(order) - width + 1
    place = np.arange(len(order))
    best, step = place, 1
    while step * 2 <= width:  # least over windows of 1, 2, 4, ... numbers
        a, b = best[:len(best) - step], best[step:]
        best = np.where(order[b] < order[a], b, a)
        step *= 2
    a, b = best[:n], best[width - step:width - step + n]
    return np.where(order[b] < order[a], b, a)


def _runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(place, first window, last window, name of the gram, text) of each run.

    Windows that cross a text's end are left out; runs are split at text ends.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, np.zeros(0, U64), none
    names = Names(data)
    grams = mix((names.sums[gram:] - names.sums[:-gram]) * names.down[:len(data) - gram + 1])
    place = _least_places(grams, length - gram + 1)
    window = np.arange(len(place))
    text = np.searchsorted(ends, window, "right") - 1
    inside = window + length <= ends[text + 1]
    window, place, text = window[inside], place[inside], text[inside]
    if len(window) == 0:
        return none, none, none, np.zeros(0, U64), none
    new = np.ones(len(window), bool)
    new[1:] = (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    return place[first], window[first], window[last], grams[place[first]], text[first]


RUNS = "row long, pos long, name long, whole long"


def _pack(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """First window and length of a run (under 256 windows) in one integer."""
    return (first << 8) | (last - first)


def runs(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The runs of (row, text): their first and last window (``pos``), the name
    at their place, and ``whole``, the name of all their bytes."""
    def parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """Buffers of bounded size: some texts, or overlapping parts of a long one."""
        data, ends = text_bytes(batch.column("text"))
        ids = batch.column("row").to_numpy()
        for a, b in chunks(ends):
            flat, own = data[ends[a]:ends[b]], ends[a:b + 1] - ends[a]
            if b - a > 1 or len(flat) <= 2 * CHUNK:
                yield flat, own, ids[a:b], 0
                continue
            for at in range(0, len(flat) - length + 1, CHUNK):
                part = flat[at:at + CHUNK + length - 1]
                yield part, np.array([0, len(part)]), ids[a:b], at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for flat, own, ids, at in parts(batch):
                place, lo, hi, name, text = _runs(flat, own, length, gram)
                if len(place) == 0:
                    continue
                # the offset from the place belongs to the name
                shape = (place - lo).astype(U64) * U64(1 << 20) + (hi - lo).astype(U64)
                whole = mix(Names(flat, _BASE2)(lo, hi + length) + mix(shape))
                shift = at - own[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[text]), pa.array(_pack(lo + shift, hi + shift)), pa.array(name.astype(np.int64)), pa.array(whole.astype(np.int64))],
                    ["row", "pos", "name", "whole"])

    return rows.select("row", "text").mapInArrow(run, RUNS)


CONTEXTS = "name long, kinds long, row long, lo long, bytes binary"


def contexts(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """The bytes of each listed run of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, runs in zip(batch.column("row").to_pylist(), batch.column("text"), batch.column("runs").to_pylist()):
                data = text.as_buffer()
                lo = [r["pos"] >> 8 for r in runs]
                parts = [data.slice(a, (r["pos"] & 255) + length).to_pybytes() for a, r in zip(lo, runs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["name"] for r in runs]), pa.array([r["kinds"] for r in runs]), pa.array([row] * len(runs)), pa.array(lo), pa.array(parts, pa.binary())],
                    ["name", "kinds", "row", "lo", "bytes"])

    return rows.select("row", "doc_id", "text", "runs").mapInArrow(run, CONTEXTS)


def _ranks(parts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(part, window, rank of its first half, rank of its second half) of all
    windows of some stretches of bytes."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    n = sizes - length + 1
    part = np.repeat(np.arange(len(parts)), n)
    window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    here, half = window + np.repeat(np.cumsum(sizes) - sizes, n), length // 2
    return part, window, Names(data)(here, here + half), Names(data, _BASE2)(here + half, here + length)


def compare_groups(groups: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, lo, hi) of repeated windows among the ``runs`` of each group: pairs
    of half ranks are sorted, and equal neighbours repeat."""
    def gathered(batch: pa.RecordBatch) -> Iterator[list[tuple[int, dict]]]:
        """Whole groups, as (group, run), until about ``SPANS`` runs are together."""
        held = []
        for g, own in enumerate(batch.column("runs")):
            held += [(g, r) for r in own.as_py()]
            if len(held) >= SPANS:
                yield held
                held = []
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for runs in gathered(batch):
                part, window, left, right = _ranks([r["bytes"] for _, r in runs], length)
                left = mix(left + np.array([g for g, _ in runs], U64)[part])
                order = np.lexsort((right, left))
                same = (left[order[1:]] == left[order[:-1]]) & (right[order[1:]] == right[order[:-1]])
                hit = np.zeros(len(part), bool)
                hit[order[1:][same]] = hit[order[:-1][same]] = True
                hit = np.flatnonzero(hit)
                if len(hit) == 0:
                    continue
                joins = (part[hit[1:]] == part[hit[:-1]]) & (window[hit[1:]] == window[hit[:-1]] + 1)
                first = hit[np.append(True, ~joins)]
                last = hit[np.append(~joins, True)]
                row, lo = np.array([r["row"] for _, r in runs])[part[first]], np.array([r["lo"] for _, r in runs])[part[first]]
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(lo + window[first]), pa.array(lo + window[last] + length)], ["row", "lo", "hi"])

    return groups.select("runs").mapInArrow(run, "row long, lo long, hi long")


def windows(runs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Each window of each context with the ranks of its two halves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SPANS):
                some = batch.slice(at, SPANS)
                part, window, left, right = _ranks(some.column("bytes").to_pylist(), length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.column("row").to_numpy()[part]), pa.array(some.column("lo").to_numpy()[part] + window),
                     pa.array(left.astype(np.int64)), pa.array(right.astype(np.int64))], ["row", "start", "left", "right"])

    return runs.select("row", "lo", "bytes").mapInArrow(run, "row long, start long, left long, right long")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_text binary"


def _cut(rows: DataFrame) -> DataFrame:
    """Removes the union of the ``spans`` of bytes from each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, gone, count, kept = [], [], [], []
                for text, spans in zip(part.column("text"), part.column("spans").to_pylist()):
                    data = text.as_py().encode() if text.is_valid else b""
                    out, done, n = [], 0, 0
                    for s, e in sorted((x["lo"], x["hi"]) for x in spans or ()):
                        if s > done or n == 0:
                            out.append(data[done:s])
                            n += 1
                        done = max(done, e)
                    out.append(data[done:])
                    rest = b"".join(out)
                    sizes.append(len(data))
                    gone.append(len(data) - len(rest))
                    count.append(n)
                    kept.append(rest)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_text"])

    return rows.select("row", "doc_id", "text", "spans").mapInArrow(run, RESULT)


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(row, lo, hi): stretches of bytes, end exclusive, whose union is what
    repeats.  ``rows`` has row and text, and is read three times."""
    # no column is ever null; saying so keeps filters that joins would add to
    # one use of a shuffle, but not to another, out of the plan
    found = runs(rows, length, gram).where("row is not null and pos is not null and name is not null and whole is not null")
    # first rank: names that occur once are settled
    again = found.groupBy("name").count().where("count > 1").select("name")
    # the key of a stretch is spelled apart from the name, so that a frequent
    # name is joined in many tasks and summed before the next shuffle
    alive = found.join(again, "name").select("row", "pos", "whole", F.bitwise_not("name").alias("name"))
    lo, hi = F.shiftright("pos", 8), F.shiftright("pos", 8) + F.col("pos").bitwiseAND(255) + length
    # whole stretches: equal ones repeat.  Every use of the kinds asks for all
    # their columns, so that one plan, and its shuffles, serve them all
    kinds = alive.groupBy("name", "whole").agg(F.count("*").alias("n"), F.min(F.struct("row", "pos")).alias("one"))
    known = F.col("one.row").isNotNull() & F.col("one.pos").isNotNull() & (F.col("n") > 0)
    equal = kinds.where(known & (F.col("n") > 1)).select("name", "whole")
    alike = alive.join(equal, ["name", "whole"]).select("row", lo.alias("lo"), hi.alias("hi"))
    # the windows of one run of each kind are ranked among the kinds of a name
    many = kinds.where(known).groupBy("name").agg(F.count("*").alias("kinds")).where("kinds > 1")
    ones = kinds.where(known).join(many, "name").select("name", "kinds", F.col("one.row").alias("row"), F.col("one.pos").alias("pos"))
    listed = ones.groupBy("row").agg(F.collect_list(F.struct("name", "kinds", "pos")).alias("runs"))
    runs_of = contexts(rows.join(listed, "row"), length)
    groups = runs_of.where(F.col("kinds") <= TOGETHER).groupBy("name").agg(F.collect_list(F.struct("row", "lo", "bytes")).alias("runs"))
    some = compare_groups(groups, length)
    ranked = windows(runs_of.where(F.col("kinds") > TOGETHER), length)
    pairs = ranked.groupBy("left", "right").agg(F.count("*").alias("n")).where("n > 1").select("left", "right")
    rest = ranked.join(pairs, ["left", "right"]).select(
        "row", F.col("start").alias("lo"), (F.col("start") + length).alias("hi"))
    return alike.union(some).union(rest)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_text) of each (doc_id, text)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(rows, length, gram).groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return _cut(rows.join(spans, "row", "left"))
