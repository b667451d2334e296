"""N-gram overlap and word edit distance of two token arrays of a row.

A scored pair never leaves its partition: no n-gram shuffle is needed (a pair is
already one row).

* ``ngram_matches``: multiset intersection sizes of the n-grams of two token
  arrays, all orders in one Arrow batch: integer token codes, one sort an order.
* ``word_edit_distance``: word-level Levenshtein.  The distinct words of a
  pair are numbered and each word is written as one code point, so the
  built-in character ``levenshtein`` (code-point based) gives the word
  distance.  Code points skip the surrogate block and reach the
  supplementary planes, so the mapping is exact up to ~1.1 million distinct
  words per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


#: Tokens of both sides that the n-gram kernel counts at once.
CHUNK_TOKENS = 1 << 20


def clipped_matches(ref: pa.ListArray, pred: pa.ListArray, max_n: int) -> np.ndarray:
    """rows x max_n: sum over n-grams of min(count in ref, count in pred).

    Tokens get integer codes once.  An n-gram's code numbers the pairs of an
    (n-1)-gram's code and the next token's, and codes of order one already hold the
    row, so equal codes are equal grams of one row and one sort an order counts them."""
    out = np.zeros((len(ref), max_n), dtype=np.int32)
    sizes = [pc.fill_null(pc.list_value_length(side), 0).to_numpy(zero_copy_only=False).astype(np.int64) for side in (ref, pred)]
    chunk = (np.cumsum(sizes[0] + sizes[1]) - 1) // CHUNK_TOKENS
    cuts = np.flatnonzero(np.diff(chunk, prepend=-1)) if len(ref) else []
    for start, stop in zip(cuts, [*cuts[1:], len(ref)]):
        lengths = np.concatenate([s[start:stop] for s in sizes])
        flat = pa.concat_arrays([side.slice(start, stop - start).flatten() for side in (ref, pred)])
        if not len(flat):
            continue
        n_rows = stop - start
        segment = np.repeat(np.arange(2 * n_rows), lengths)      # row, then row + n_rows for pred
        row, is_pred = segment % n_rows, segment >= n_rows
        token = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        vocabulary = int(token.max()) + 1
        code = row
        for n in range(1, max_n + 1):
            at = np.flatnonzero(segment[:max(len(segment) - n + 1, 0)] == segment[n - 1:])
            if not len(at):
                break
            gram = code[at] * vocabulary + token[at + n - 1]
            distinct, first, inverse = np.unique(gram, return_index=True, return_inverse=True)
            of_pred = is_pred[at]
            counts = [np.bincount(inverse[of_pred == s], minlength=len(distinct)) for s in (False, True)]
            out[start:stop, n - 1] = np.bincount(row[at[first]], weights=np.minimum(*counts), minlength=n_rows)
            code = np.zeros(len(token), dtype=np.int64)
            code[at] = inverse
    return out


def ngram_matches(ref_tokens: Column, pred_tokens: Column, max_n: int) -> Column:
    """array<int>: clipped matches of the n-grams of orders 1..``max_n``."""
    @F.arrow_udf("array<int>")
    def count(ref: pa.Array, pred: pa.Array) -> pa.Array:
        found = clipped_matches(ref, pred, max_n)
        return pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * max_n, found.reshape(-1))
    return count(ref_tokens, pred_tokens)


def _code_point_hex(i: Column) -> Column:
    """UTF-16BE hex of the i-th (0-based) symbol code point."""
    cp = F.when(i < 0xD800 - 256, i + 256).otherwise(i + 256 + 0x800)
    bmp = F.lpad(F.hex(cp), 4, "0")
    sup = cp - 0x10000
    pair = F.concat(F.hex(F.lit(0xD800) + F.shiftright(sup, 10)),
                    F.hex(F.lit(0xDC00) + F.lit(0x3FF).bitwiseAND(sup)))
    return F.when(cp < 0x10000, bmp).otherwise(pair)


def _encode(words: Column, vocab: Column) -> Column:
    index = F.transform(words, lambda w: F.array_position(vocab, w) - 1)
    hexs = F.array_join(F.transform(index, _code_point_hex), "")
    return F.decode(F.unhex(hexs), "UTF-16BE")


def word_vocab(ref_words: Column, pred_words: Column) -> Column:
    """Distinct words of a pair; compute as its own column, then encode."""
    return F.array_distinct(F.concat(ref_words, pred_words))


def word_edit_distance(ref_words: Column, pred_words: Column, vocab: Column) -> Column:
    return F.levenshtein(_encode(ref_words, vocab), _encode(pred_words, vocab))


def jiwer_words(c: Column) -> Column:
    """Word split of the WER default transform: runs of two or more white-space
    characters become one space, strip, split on the space character, drop
    empty words (a lone tab or newline stays inside a word)."""
    from rubric.functions.text import trim_ws
    t = trim_ws(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s\s+", " "))
    return F.filter(F.split(t, " "), lambda x: x != F.lit(""))
