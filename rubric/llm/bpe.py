"""Operator 4: byte-level BPE by monoid tree reduction.

A piece (one match of the split pattern) is encoded by halves: each half is
encoded on its own, and the two token lists are joined by encoding the bytes of
a window of tokens around the seam again.  A token list is the encoding of its
bytes exactly when each two neighbours are (encoding the two tokens' bytes gives
the two tokens back).  So once the window's outer tokens agree with the tokens
beyond them, everything outside is proven stable; otherwise that side of the
window doubles.  Decoding concatenates up the same tree.

Texts are cut before a space that a non-space follows: the split pattern always
starts a match there, so the parts are encoded apart, and a bounded memo serves
the parts that a worker has seen.

Edge cases: a null text counts as empty and gives no ids; text of any length is
encoded whole; repeated rows and extra columns are kept by the caller's select.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of a leaf, which plain merging encodes.
LEAF = 24
#: Entries of a worker's memo before it starts anew.
MEMO = 400_000
#: Ids of a leaf in decoding.
DECODE_LEAF = 4096
#: Rows of an output batch.
ROWS = 512

UNIT = re.compile(r" (?=\S)")


class Ranks:
    """Byte-level BPE over a table of ranks, as read from a rank file."""

    def __init__(self, path: str, pattern: str | None = None):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.split = regex.compile(pattern).findall if pattern else None
        self._agree: dict[tuple[int, int], bool] = {}
        self._pieces: dict[str, bytes] = {}
        self._first: dict[str, bytes] = {}
        self._spaced: dict[str, bytes] = {}

    # -- leaves: plain merging, lowest rank first, leftmost among equals

    def merge(self, data: bytes) -> list[int]:
        """Ids of a short run of bytes."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > 4 * LEAF:
            return self._merge_long(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same for long windows: a heap of pairs over a linked list."""
        ranks, n = self.ranks, len(data)
        start, end = list(range(n)), list(range(1, n + 1))
        after, before, alive = list(range(1, n)) + [-1], list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j >= 0:
                rank = ranks.get(data[start[i]:end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, start[i], i, end[j]))

        for i in range(n):
            push(i)
        while heap:
            _, _, i, stop = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or end[j] != stop:
                continue
            end[i], after[i], alive[j] = end[j], after[j], False
            if after[j] >= 0:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [ranks[data[start[i]:end[i]]] for i in range(n) if alive[i]]

    # -- the tree

    def agree(self, a: int, b: int) -> bool:
        """Whether two tokens stay apart when their bytes are encoded together."""
        known = self._agree.get((a, b))
        if known is None:
            if len(self._agree) > MEMO:
                self._agree.clear()
            known = self._agree[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """Encoding of the joined bytes of two encodings."""
        if not a or not b:
            return a or b
        i = j = 1
        while True:
            i, j = min(i, len(a)), min(j, len(b))
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, a[-i:] + b[:j])))
            left = i == len(a) or self.agree(a[-i - 1], window[0])
            right = j == len(b) or self.agree(window[-1], b[j])
            if left and right:
                return a[:-i] + window + b[j:]
            i, j = i if left else 2 * i, j if right else 2 * j

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) <= LEAF:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))

    # -- texts

    def _unit(self, text: str) -> bytes:
        pieces, out = self._pieces, []
        for piece in self.split(text) if self.split else [text]:
            ids = pieces.get(piece)
            if ids is None:
                if len(pieces) > MEMO:
                    pieces.clear()
                ids = b"".join(i.to_bytes(4, "little") for i in self.encode_bytes(piece.encode()))
                if len(piece) < 64:
                    pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, each as four little-endian bytes."""
        first, *units = UNIT.split(text)
        memo, out = self._spaced, [self._unit(first)]
        for unit in units:
            ids = memo.get(unit)
            if ids is None:
                if len(memo) > MEMO:
                    memo.clear()
                ids = self._unit(" " + unit)
                if len(unit) < 64:
                    memo[unit] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids, concatenated up the tree of halves."""
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_LOADED: dict[tuple[str, str | None], Ranks] = {}


def load(path: str, pattern: str | None = None) -> Ranks:
    """A worker's table of ranks, read once."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Ranks(path, pattern)
    return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) from (doc_id, text): ids as little-endian 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = [ranks.encode(t.as_py() or "") for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of each row's ids."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                out = [ranks.decode(np.frombuffer(x.as_py(), "<u4").tolist()) for x in part.column("ids")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def encode_checked(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids), each text decoded again and compared before it is returned."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                out = []
                for value in part.column("text"):
                    text = value.as_py() or ""
                    ids = ranks.encode(text)
                    if ranks.decode(np.frombuffer(ids, "<u4").tolist()) != text.encode():
                        raise ValueError("decoded text differs")
                    out.append(ids)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")
