"""Longest-common-subsequence metrics as Arrow-batched pandas UDFs.

LCS has no built-in Spark form, so these few kernels run in Python on Arrow
batches (never per row through pickling).  Spark still partitions the pairs;
each task scores its own batch.

* ``lcs_length``: bit-parallel LCS (one machine word per 64 symbols of the
  shorter side, Python big ints), O(n*m/w).
* ``union_lcs_hits``: the summary-level LCS of ROUGE-Lsum; per reference
  sentence the union of LCS positions against every candidate sentence,
  counted with clipped token budgets.  Positions come from bit rows of the
  table, of which a square root is kept, so memory is linear in the texts.
* ``ratio`` / ``partial_ratio``: normalised indel similarity of two strings
  and its best-window variant.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def lcs_length(a, b) -> int:
    """Length of the longest common subsequence of two sequences."""
    if len(a) == 0 or len(b) == 0:
        return 0
    if len(a) < len(b):
        a, b = b, a
    # bit i of masks[x] is set where the shorter sequence b holds x
    masks: dict = {}
    for i, x in enumerate(b):
        masks[x] = masks.get(x, 0) | (1 << i)
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        m = masks.get(x)
        if m is None:
            continue
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(b) - bin(v).count("1")


def edit_distance(a, b) -> int:
    """Levenshtein distance of two sequences (characters or words).

    Bit-parallel (Myers 1999, in Hyyrö's formulation for global distance):
    one big-int word per column of the shorter sequence, O(len(a) * len(b) / w).
    """
    if len(a) < len(b):
        a, b = b, a
    m = len(b)
    if m == 0:
        return len(a)
    peq: dict = {}
    for i, x in enumerate(b):
        peq[x] = peq.get(x, 0) | (1 << i)
    full = (1 << m) - 1
    top = 1 << (m - 1)
    pv, mv, score = full, 0, m
    for x in a:
        eq = peq.get(x, 0)
        xv = eq | mv
        xh = ((((eq & pv) + pv) & full) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ((ph << 1) | 1) & full
        mh = (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
    return score


#: Lanes below which pairs go one by one, and 64-row blocks and mask words of a chunk.
MIN_LANES, CHUNK_BLOCKS, CHUNK_MASKS = 16, 4096, 1 << 21


def _settled(a, b) -> tuple[int | None, object, object]:
    """(distance, None, None) where it follows at once, else (None, text, pattern): the
    two without what they begin and end with in common, the longer first."""
    if len(a) < len(b):
        a, b = b, a
    if isinstance(a, str) and b in a:
        return len(a) - len(b), None, None
    lo, hi = 0, len(b)
    while lo < hi:                       # longest common start, by halving
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    a, b = a[lo:], b[lo:]
    lo, hi = 0, len(b)
    while lo < hi:                       # longest common end
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[len(a) - mid:len(a) - lo] == b[len(b) - mid:len(b) - lo] else (lo, mid - 1)
    a, b = a[:len(a) - lo], b[:len(b) - lo]
    return (None, a, b) if len(b) else (len(a), None, None)


def _codes(text, pattern) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes from 1 of the pattern's symbols, 0 for what the pattern lacks, and their number."""
    if isinstance(text, str):
        t, p = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), dtype="<u4") for x in (text, pattern))
        known, p = np.unique(p, return_inverse=True)
        at = np.minimum(np.searchsorted(known, t), len(known) - 1)
        return np.where(known[at] == t, at + 1, 0), p + 1, len(known) + 1
    number: dict = {}
    p = np.array([number.setdefault(x, len(number) + 1) for x in pattern])
    return np.array([number.get(x, 0) for x in text]), p, len(number) + 1


def _side_by_side(pairs: list[tuple]) -> np.ndarray:
    """Edit distances of (text, pattern) pairs, no side empty.

    As in ``edit_distance``, with one 64-bit word for 64 rows of the table.  A step
    takes every pair's blocks on by one column: block w is at column t - w, one behind
    the block above it, whose outgoing difference of the step before it takes in."""
    coded = [_codes(*p) for p in pairs]
    n = np.array([len(t) for t, _, _ in coded])
    m = np.array([len(p) for _, p, _ in coded])
    symbols = np.array([k for _, _, k in coded])
    blocks = (m + 63) // 64
    first = np.cumsum(blocks) - blocks                  # first block of each pair
    total = int(blocks.sum())
    depth = np.arange(total) - np.repeat(first, blocks)
    start = np.cumsum(blocks * symbols) - blocks * symbols
    base = np.repeat(start, blocks) + depth * np.repeat(symbols, blocks)
    masks = np.zeros(int((blocks * symbols).sum()), dtype=np.uint64)
    row = np.concatenate([np.arange(k) for k in m])
    lane = np.repeat(np.arange(len(pairs)), m)
    np.add.at(masks, start[lane] + row // 64 * symbols[lane] + np.concatenate([p for _, p, _ in coded]),
              np.uint64(1) << (row % 64).astype(np.uint64))
    text = np.concatenate([t for t, _, _ in coded])
    begin = np.repeat(np.cumsum(n) - n, blocks)
    at, end = begin - depth, begin + np.repeat(n, blocks)
    one, top = np.uint64(1), np.uint64(63)
    pv, mv = np.full(total, ~np.uint64(0)), np.zeros(total, dtype=np.uint64)
    p_in, m_in = np.zeros(total + 1, dtype=np.uint64), np.zeros(total + 1, dtype=np.uint64)
    p_in[first] = one
    deep, shortest = int(blocks.max()), int(n.min())
    for t in range(int(n.max()) + deep - 1):
        eq = masks.take(base + text.take(at, mode="clip"), mode="clip")
        xv = eq | mv
        eq |= m_in[:-1]
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        p_out, m_out = ph >> top, mh >> top
        ph = (ph << one) | p_in[:-1]
        mh = (mh << one) | m_in[:-1]
        new_pv, new_mv = mh | ~(xv | ph), ph & xv
        if deep - 1 <= t < shortest:
            pv, mv = new_pv, new_mv
        else:                            # blocks not begun or at their text's end stay
            on = (at >= begin) & (at < end)
            np.copyto(pv, new_pv, where=on)
            np.copyto(mv, new_mv, where=on)
        p_in[1:], m_in[1:] = p_out, m_out
        p_in[first], m_in[first] = one, 0
        at += 1
    rows = np.minimum(np.repeat(m, blocks) - 64 * depth, 64).astype(np.uint64)
    used = ~np.uint64(0) >> (np.uint64(64) - rows)
    rise = np.bitwise_count(pv & used).astype(np.int64) - np.bitwise_count(mv & used).astype(np.int64)
    return n + np.add.reduceat(rise, first)


def edit_distances(pairs: list[tuple]) -> list[int]:
    """``edit_distance`` of many pairs: those of like length are computed side by side."""
    out, open_ = [0] * len(pairs), []
    for k, (a, b) in enumerate(pairs):
        known, text, pattern = _settled(a, b)
        if known is None:
            open_.append((len(text), len(pattern), k, text, pattern))
        else:
            out[k] = known
    open_.sort(key=lambda x: x[:3])
    while open_:
        longest, blocks, masks, take = open_[-1][0], 0, 0, 0
        for n, m, *_ in reversed(open_):
            blocks += (m + 63) // 64
            masks += (m + 63) // 64 * (m + 1)
            if 5 * n < 4 * longest - 256 or blocks > CHUNK_BLOCKS or masks > CHUNK_MASKS:
                break
            take += 1
        take = max(take, 1)
        chunk, open_ = open_[-take:], open_[:-take]
        found = (_side_by_side([x[3:] for x in chunk]) if take >= MIN_LANES
                 else [edit_distance(x[3], x[4]) for x in chunk])
        for x, d in zip(chunk, found):
            out[x[2]] = int(d)
    return out


def f_measure(hits: float, n_ref: int, n_pred: int) -> float:
    if n_ref == 0 or n_pred == 0 or hits == 0:
        return 0.0
    p = hits / n_pred
    r = hits / n_ref
    return 2 * p * r / (p + r)


def _masks(c) -> dict:
    """Bit j of the entry of x is set where ``c[j]`` is x."""
    masks: dict = {}
    for j, x in enumerate(c):
        masks[x] = masks.get(x, 0) | (1 << j)
    return masks


def _next_row(v: int, mask: int, full: int) -> int:
    """Row of the LCS table after one more reference token, as bits: bit j is 0
    where the length grows between the candidate's prefixes of j and j + 1."""
    u = v & mask
    return ((v + u) | (v - u)) & full


def _lcs_positions(r, c) -> list[int]:
    """Reference positions of one LCS, backtracking from the end and preferring
    to drop a candidate token when that keeps a strictly longer prefix.

    Table rows are bits, and only every sqrt(len(r))-th is kept; the rows between
    two of them are made again when the backtrack gets there.  Two texts of
    20,000 tokens need about one megabyte."""
    masks, full = _masks(c), (1 << len(c)) - 1
    step = max(1, math.isqrt(len(r)))
    kept, v = [full], full
    for i, x in enumerate(r, start=1):
        mask = masks.get(x)
        v = v if mask is None else _next_row(v, mask, full)
        if i % step == 0:
            kept.append(v)
    i, j = len(r), len(c)
    out: list[int] = []
    rows: list[int] = []
    base = -1
    length = j - v.bit_count()          # L[i][j]
    while i > 0 and j > 0 and length > 0:
        if (i - 1) // step != base:      # rows base * step .. i of the table
            base = (i - 1) // step
            rows = [kept[base]]
            for x in r[base * step:i]:
                mask = masks.get(x)
                rows.append(rows[-1] if mask is None else _next_row(rows[-1], mask, full))
        here, above = rows[i - base * step], rows[i - 1 - base * step]
        if masks.get(r[i - 1]) is None:
            i -= 1
            continue
        up = j - (above & ((1 << j) - 1)).bit_count()       # L[i-1][j]
        while j > 0:                    # along the row: both lengths follow from one bit
            if r[i - 1] == c[j - 1]:
                out.append(i - 1)
                length = up - 1 + (above >> (j - 1) & 1)    # L[i-1][j-1]
                i, j = i - 1, j - 1
                break
            left = length - 1 + (here >> (j - 1) & 1)       # L[i][j-1]
            if left <= up:
                i, length = i - 1, up
                break
            up += (above >> (j - 1) & 1) - 1
            length, j = left, j - 1
    out.reverse()
    return out


def union_lcs_hits(ref_sents, pred_sents) -> tuple[int, int, int]:
    """(hits, ref token count, pred token count) of the summary-level LCS."""
    ref_sents = [list(s) for s in ref_sents]
    pred_sents = [list(s) for s in pred_sents]
    m = sum(len(s) for s in ref_sents)
    n = sum(len(s) for s in pred_sents)
    if m == 0 or n == 0:
        return 0, m, n
    budget_r = Counter(t for s in ref_sents for t in s)
    budget_p = Counter(t for s in pred_sents for t in s)
    hits = 0
    pred_sets = [set(c) for c in pred_sents]
    for r in ref_sents:
        if not r:
            continue
        positions = set()
        r_set = set(r)
        for c, c_set in zip(pred_sents, pred_sets):
            if c and not r_set.isdisjoint(c_set):   # no shared token: empty LCS
                positions.update(_lcs_positions(r, c))
        for pos in sorted(positions):
            tok = r[pos]
            if budget_p[tok] > 0 and budget_r[tok] > 0:
                hits += 1
                budget_p[tok] -= 1
                budget_r[tok] -= 1
    return hits, m, n


def ratio(a: str, b: str) -> float:
    """2 * LCS / (len a + len b); 1.0 for two empty strings."""
    if not a and not b:
        return 1.0
    return 2.0 * lcs_length(a, b) / (len(a) + len(b))


def _best_window(short: str, long: str) -> float:
    n1, n2 = len(short), len(long)
    chars = set(short)
    best = 0.0
    # windows that start before the long string (prefixes), full-width
    # windows, and windows running past its end (suffixes)
    for k in range(1, n1):
        if long[k - 1] in chars:
            best = max(best, ratio(short, long[:k]))
    for s in range(0, n2 - n1 + 1):
        if long[s] in chars or long[s + n1 - 1] in chars:
            best = max(best, ratio(short, long[s:s + n1]))
            if best == 1.0:
                return 1.0
    for s in range(n2 - n1 + 1, n2):
        if long[s] in chars:
            best = max(best, ratio(short, long[s:]))
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string against any window of the longer."""
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    if a in b:
        return 1.0
    best = _best_window(a, b)
    if len(a) == len(b):
        best = max(best, _best_window(b, a))
    return best


# ---------------------------------------------------------------------------
# pandas UDFs (Arrow batches)
# ---------------------------------------------------------------------------

@pandas_udf(DoubleType())
def rouge_l_udf(ref_tokens: pd.Series, pred_tokens: pd.Series) -> pd.Series:
    out = np.empty(len(ref_tokens), dtype=np.float64)
    for k, (r, p) in enumerate(zip(ref_tokens, pred_tokens)):
        r = [] if r is None else list(r)
        p = [] if p is None else list(p)
        out[k] = f_measure(lcs_length(r, p), len(r), len(p))
    return pd.Series(out)


@pandas_udf(DoubleType())
def rouge_lsum_udf(ref_sents: pd.Series, pred_sents: pd.Series) -> pd.Series:
    out = np.empty(len(ref_sents), dtype=np.float64)
    for k, (r, p) in enumerate(zip(ref_sents, pred_sents)):
        r = [] if r is None else r
        p = [] if p is None else p
        hits, m, n = union_lcs_hits(r, p)
        out[k] = f_measure(hits, m, n)
    return pd.Series(out)


@pandas_udf(DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


@pandas_udf(DoubleType())
def partial_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([partial_ratio(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


@pandas_udf(DoubleType())
def edit_distance_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edit distance of two strings (code points) or two token arrays."""
    out = np.full(len(a), np.nan)
    given = [k for k, (x, y) in enumerate(zip(a, b)) if x is not None and y is not None]
    sides = ((a.iloc[k], b.iloc[k]) for k in given)
    out[given] = edit_distances([(x, y) if isinstance(x, str) else (list(x), list(y)) for x, y in sides])
    return pd.Series(out)
