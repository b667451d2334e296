"""Kernels against plain tables and counters, and their memory on long texts."""
import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest

from rubric.functions import lcs, overlap

from brute import lcs_table


def positions(r, c):
    t = lcs_table(r, c)
    i, j, out = len(r), len(c), []
    while i and j:
        if r[i - 1] == c[j - 1]:
            out.append(i - 1)
            i, j = i - 1, j - 1
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out[::-1]


def test_lcs_positions_equal_the_full_table():
    rng = random.Random(1)
    for _ in range(800):
        k = rng.choice([2, 3, 5, 20])
        r, c = ([f"w{rng.randrange(k)}" for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert lcs._lcs_positions(r, c) == positions(r, c), (r, c)


def test_rouge_lsum_of_long_lines_in_little_memory():
    rng = random.Random(2)
    r, c = ([f"w{rng.randrange(900)}" for _ in range(20_000)] for _ in range(2))
    tracemalloc.start()
    hits, m, n = lcs.union_lcs_hits([r], [c])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert hits == lcs.lcs_length(r, c) and m == n == 20_000
    assert peak < 50_000_000


@pytest.mark.parametrize("chunk", [1, 10, 1 << 20])
def test_clipped_matches_equal_counters(monkeypatch, chunk):
    monkeypatch.setattr(overlap, "CHUNK_TOKENS", chunk)
    rng = random.Random(chunk)

    def tokens():
        return [rng.choice("abc") for _ in range(rng.randint(0, 12))] if rng.random() > 0.1 else None

    def grams(t, n):
        return Counter(tuple(t[i:i + n]) for i in range(len(t) - n + 1)) if t else Counter()

    for _ in range(60):
        rows = [(tokens(), tokens()) for _ in range(rng.randint(0, 30))]
        sides = [pa.array([r[k] for r in rows], pa.list_(pa.string())) for k in (0, 1)]
        want = [[sum((grams(a, n) & grams(b, n)).values()) for n in range(1, 5)] for a, b in rows]
        assert overlap.clipped_matches(*sides, 4).tolist() == want
        half = [s.slice(len(rows) // 2) for s in sides]
        assert overlap.clipped_matches(*half, 4).tolist() == want[len(rows) // 2:]


def test_edit_distances_side_by_side_equal_the_full_table():
    rng = random.Random(5)
    text = lambda n, symbols: "".join(rng.choice(symbols) for _ in range(n))
    pairs = [("", ""), ("", "ab"), ("abc", "xabcx"), ("abcd", "abd"), ("\ud800a", "a\ud800")]
    for symbols in ("ab", "abcdefgh é😀"):
        for longest in (6, 64, 65, 130, 300):
            for _ in range(30):
                a = text(rng.randint(0, longest), symbols)
                pairs.append((a, text(rng.randint(0, longest), symbols) if rng.random() < .5 else "".join(c for c in a if rng.random() < .7)))
    def table(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]
    want = [table(*p) for p in pairs]
    assert lcs.edit_distances(pairs) == want
    assert lcs.edit_distances([(a.split("a"), b.split("a")) for a, b in pairs]) == [table(a.split("a"), b.split("a")) for a, b in pairs]


def test_answers_of_like_length_take_fewer_steps_than_one_by_one(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdef ") for _ in range(300)) for _ in range(64)]
    alone = []
    monkeypatch.setattr(lcs, "edit_distance", lambda a, b: alone.append((a, b)))
    lcs.edit_distances([(t, texts[k - 1]) for k, t in enumerate(texts)] + [("of " + texts[0] + " and more", texts[0])])
    assert not alone
