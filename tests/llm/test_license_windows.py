"""Licences that a text holds are met, wherever they stand."""

import numpy as np

from rubric.llm import licenses


def test_bands_follow_the_least_share_in_common():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for group in scanner.classes:
        size = max(1, group.window - scanner.k + 1)
        for _, grams in group.templates:
            need = -(-scanner.percent * len(grams) // 100)
            assert (1 - need / (size + len(grams) - need)) ** group.keys.shape[1] <= 0.5 ** 24


def test_short_notices_in_the_middle_of_texts_are_all_found():
    scanner, notice = licenses.Scanner(licenses.TEMPLATES), "Released under the MIT License."
    rng, n = np.random.default_rng(3), 40_000
    data = [" ".join(["%x" % w for w in rng.integers(1 << 40, size=9)] + [notice] + ["%x" % w for w in rng.integers(1 << 40, size=9)]).encode() for _ in range(n)]
    ends = np.cumsum([0, *map(len, data)])
    words, owner = licenses.word_hashes(np.frombuffer(b"".join(data), np.uint8), ends)
    assert {t for t, *_ in scanner.scan(words, owner, n)} == set(range(n))
