"""Word and shingle hashes of whole batches of texts, on their UTF-8 bytes.

A word's hash is the sum of one random 64-bit number per (place, byte), so all
words of a batch are hashed by one pass over its buffer; a shingle's hash mixes
the hashes of its words in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_PLACES = 64
_rng = np.random.Generator(np.random.PCG64(20240229))
_TABLE = _rng.integers(0, 1 << 64, size=(_PLACES, 256), dtype=U64)
_ORDER = _rng.integers(0, 1 << 64, size=64, dtype=U64) | U64(1)
#: Bytes of text that are hashed at once, but for a longer single text.
CHUNK = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column's texts; null texts are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"") if column.null_count else column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[ends[0]:ends[-1]], ends - ends[0]


def chunks(ends: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes, one text at least."""
    at, n = 0, len(ends) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield at, min(stop, n)
        at = min(stop, n)


def word_hashes(data: np.ndarray, ends: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of its text) in order; words are runs of bytes
    other than the space and 0x09..0x0D, A-Z lower-cased if asked."""
    n = len(data)
    if n == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    inside = (data != 32) & ((data < 9) | (data > 13))
    first = np.zeros(n + 1, bool)
    first[1:n] = inside[:-1]
    starts_text = np.zeros(n + 1, bool)
    starts_text[ends[:-1]] = True
    begin = np.flatnonzero(inside & (~first[:n] | starts_text[:n]))
    if len(begin) == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(inside)
    if lower:
        data = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    head = np.searchsorted(at, begin)
    sizes = np.diff(np.append(head, len(at)))
    place = np.arange(len(at)) - np.repeat(head, sizes)
    value = _TABLE[place & (_PLACES - 1), data[at]]
    if sizes.max() > _PLACES:
        value = value * (U64(2) * (place // _PLACES).astype(U64) + U64(1))
    return mix(np.add.reduceat(value, head)), np.searchsorted(ends, begin, "right") - 1


def shingle_hashes(words: np.ndarray, texts: np.ndarray, k: int, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-word shingle, index of its text), in order of place.

    A text of 1 to k-1 words has one shingle, its whole sequence.
    """
    counts = np.bincount(texts, minlength=n_texts)
    if len(words) == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    full = np.zeros(0, U64)
    owner = np.zeros(0, np.int64)
    if len(words) >= k:
        total = words[:len(words) - k + 1] * _ORDER[0]
        for j in range(1, k):
            total = total + words[j:len(words) - k + 1 + j] * _ORDER[j]
        same = texts[:len(words) - k + 1] == texts[k - 1:]
        full, owner = mix(total[same]), texts[:len(words) - k + 1][same]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short) == 0:
        return full, owner
    firsts = np.searchsorted(texts, short)
    whole = np.zeros(len(short), U64)
    for j in range(k - 1):
        has = counts[short] > j
        whole[has] += words[firsts[has] + j] * _ORDER[j]
    whole = mix(whole + counts[short].astype(U64) * _ORDER[63])
    owner, full = np.append(owner, short), np.append(full, whole)
    order = np.argsort(owner, kind="stable")
    return full[order], owner[order]


def shingle_sets(data: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the distinct shingles, by text, then by hash."""
    words, texts = word_hashes(data, ends)
    hashes, owner = shingle_hashes(words, texts, k, len(ends) - 1)
    if len(hashes) == 0:
        return hashes, owner
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]
