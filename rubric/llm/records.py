"""Operator 5: token ids in length-delimited binary records.

A record is ``length (u64) | masked checksum of the length (u32) | payload |
masked checksum of the payload (u32)``, all little-endian.  The payload is the
document's id, a byte that says whether the id is null, the width of an id in
bytes and the ids.  Beside each data file lies an index file with one fixed-size
entry per record (doc id, null flag, offset, payload length, number of ids), so
a reader can fetch records in any order without scanning the data.  The checksum
is CRC-32, masked by rotation and an added constant, so that a checksum stored
in data does not check itself.

Files are written in ascending id order (null ids first) by the tasks of one
range-partitioned sort, under names that no other attempt uses; a manifest
lists the files of the attempts that succeeded, and only those are read, so lost
executors and repeated attempts leave no wrong record behind.

Edge cases: a null text counts as empty and is a record of the end id alone; an
empty table writes no file and reads back no row; rows with the same id stand
next to each other in either order; other columns are not written.
"""

from __future__ import annotations

import json
import random
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MASK_DELTA = 0xA282EAD8
HEADER = "<QI"
LEAD = "<qBB"
ENTRY = np.dtype([("doc_id", "<i8"), ("null", "<u8"), ("offset", "<u8"), ("length", "<u8"), ("n", "<u8")])
#: Bytes gathered before they are written.
BUFFER = 4 << 20
#: Parts of texts that a worker remembers before it starts anew.
MEMO = 1_000_000
#: Characters of a part that is remembered, at most.
LONGEST = 64
#: Rows of an output batch.
ROWS = 4096
#: Documents whose unseen parts are tokenized together.
TOGETHER = 2048
#: Parts that are encoded as one string.
CHUNK = 2048

MANIFEST = "part int, file string, n_docs long, n_tokens long"
UNIT = re.compile(r" (?=\S)")
# Runs that the split pattern of byte-level BPE takes alone wherever they stand
# (no apostrophe, which may begin a contraction; letters that all releases of Unicode know).
PIECE = re.compile(r"[A-Za-zÀ-ÖØ-öø-\u024f]+|[0-9]+|[!-&(-/:-@\[-`{-~]+|\n(?=[A-Za-zÀ-ÖØ-öø-\u024f0-9!-&(-/:-@\[-`{-~])")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return struct.pack(HEADER, len(payload), masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes) -> bytes:
    """The payload of one framed record; raises if a checksum differs."""
    length, check = struct.unpack_from(HEADER, data)
    payload = data[struct.calcsize(HEADER):struct.calcsize(HEADER) + length]
    if check != masked(data[:8]) or data[struct.calcsize(HEADER) + length:] != struct.pack("<I", masked(payload)):
        raise ValueError("record checksum differs")
    return payload


def shared_uri(spark: SparkSession, folder: str) -> str:
    """The folder with its store: one without a scheme lies in Hadoop's default file
    system, where Spark itself writes it, never on an executor's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    scheme, rest = uri.split(":", 1)
    return f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest.removeprefix('//')}"


def open_folder(uri: str):
    """(file system, path) of a shared folder, in any store that Arrow reaches."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Encoder:
    """The tokenizers library over whole texts.

    A text is cut before each space that a non-space follows, where the split
    pattern of byte-level BPE always starts anew.  Parts that the worker has not
    seen are encoded in a few long strings, and the tokens that begin with a space
    show where each part starts.  Parts that end in white space or lack the space
    before them (which the split pattern reads together with their neighbours) or
    hold a zero byte are encoded one by one; pieces within parts are told apart by a
    zero byte after each, which no token but its own holds.  With ``special_tokens``, the library's default, an added token
    that stands literally in a text gives its own id; such texts are encoded whole.
    Without, it is text like any other.
    """

    def __init__(self, path: str, end_id: int, special_tokens: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_tokens
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special_tokens else []
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.end = end_id.to_bytes(self.width, "little")
        zero = self.tokenizer.encode("\0", add_special_tokens=False)
        holding = [t for t in self.tokenizer.get_vocab() if zero.tokens[0] in t]
        self.zero = zero.ids[0] if zero.tokens == holding else None
        space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.spaced[[k for t, k in self.tokenizer.get_vocab().items() if t.startswith(space)]] = True
        split = json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}
        self.byte_level = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        self.memo: dict[str, bytes] = {}    # part without its space: ids of the part
        self.inside: dict[str, bytes] = {}  # piece within a part: its ids

    def _singly(self, parts: list[str]) -> list[bytes]:
        codes = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(code.ids, self.kind).tobytes() for code in codes]

    def _cut(self, parts: list[str], end: str, marks) -> list[bytes]:
        """Ids of each part, encoded as a few long strings; ``marks`` finds the places
        in a string's ids at which parts end, ``end`` follows each part."""
        out: list[bytes] = []
        width = len(end) * self.width
        chunks = [parts[at:at + CHUNK] for at in range(0, len(parts), CHUNK)]
        texts = [end.join([*chunk, ""]) for chunk in chunks]
        for chunk, code in zip(chunks, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(code.ids, self.kind)
            stops = marks(ids)
            if len(stops) != len(chunk):
                raise ValueError("a part's end is not found among the ids")
            raw, at = ids.tobytes(), 0
            for stop in (stops * self.width).tolist():
                out.append(raw[at:stop])
                at = stop + width
        return out

    def _joined(self, parts: list[str]) -> list[bytes]:
        """Ids of parts without a zero byte: one after each part shows its end."""
        return self._cut(parts, "\0", lambda ids: np.flatnonzero(ids == self.zero))

    def _spaced(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that hold one space, at their start: tokens that begin with a
        space show where the next part starts."""
        return self._cut(parts, "", lambda ids: np.append(np.flatnonzero(self.spaced[ids])[1:], len(ids)))

    def _encode(self, parts: list[str]) -> list[bytes]:
        """Ids of each part."""
        if self.zero is None:
            return self._singly(parts)
        apart = {k for k, p in enumerate(parts) if p[:1] != " " or p[-1].isspace() or "\0" in p or " " in p[1:]}
        own = iter(self._singly([parts[k] for k in sorted(apart)]))
        rest = iter(self._spaced([p for k, p in enumerate(parts) if k not in apart]))
        return [next(own) if k in apart else next(rest) for k in range(len(parts))]

    def _learn(self, names: list[str]) -> list[str]:
        """Remembers the ids of parts (given without their space); returns the long
        ones, which are to be forgotten.

        A part of Latin letters, digits and ASCII punctuation is put together from its
        pieces by the split pattern, which repeat far more often than parts do: its
        first piece is a part itself, the others are remembered apart."""
        memo, inside = self.memo, self.inside
        if len(inside) > MEMO:
            inside.clear()
        cuts = {}
        if self.byte_level and self.zero is not None:
            for p in names:
                if not p.isalpha():
                    pieces = PIECE.findall(p)
                    if len(pieces) > 1 and sum(map(len, pieces)) == len(p):
                        cuts[p] = pieces
        own = {p for p in names if p not in cuts}
        own.update(f[0] for f in cuts.values() if f[0] not in memo)
        own_names = list(own)
        memo.update(zip(own_names, self._encode([" " + p for p in own_names])))
        new = list({x for f in cuts.values() for x in f[1:] if x not in inside})
        inside.update(zip(new, self._joined(new)))
        for p, pieces in cuts.items():
            memo[p] = memo[pieces[0]] + b"".join([inside[x] for x in pieces[1:]])
        for piece in new:
            if len(piece) > LONGEST:
                del inside[piece]
        return [p for p in own.union(cuts) if len(p) > LONGEST]

    def __call__(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text (null: empty) with the end id, in little-endian bytes."""
        column = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")
        if not len(column):
            return []
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        lists = pc.split_pattern(column, " ")
        starts = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        codes, parts = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        first = np.zeros(len(codes), bool)
        first[starts[:-1]] = True
        # such a space is no place to cut
        no_cut = np.fromiter((not p or p[0].isspace() for p in parts), bool, len(parts))
        odd = np.add.reduceat((no_cut[codes] & ~first).astype(np.int64), starts[:-1]) > 0
        whole = np.zeros(len(column), bool)
        for token in self.added:
            whole |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        apart = {int(k): column[int(k)].as_py() for k in np.flatnonzero(odd | whole)}
        cut = {k: UNIT.split(text) for k, text in apart.items() if not whole[k]}
        plain = np.repeat(~(odd | whole), np.diff(starts)) & ~first
        used = np.zeros(len(parts), bool)
        used[codes[plain]] = True
        known = [memo.get(p) if u else b"" for p, u in zip(parts, used.tolist())]
        new = {parts[k] for k, ids in enumerate(known) if ids is None}
        new.update(p for own in cut.values() for p in own[1:] if p not in memo)
        long = self._learn(list(new))
        heads = self._encode([cut[k][0] if k in cut else parts[codes[at]] for k, at in enumerate(starts[:-1].tolist())])
        known = [memo[p] if x is None else x for p, x in zip(parts, known)]
        out = self._gather(known, heads, codes, starts)
        for k, own in cut.items():
            out[k] = heads[k] + b"".join(map(memo.__getitem__, own[1:])) + self.end
        own = [k for k in apart if whole[k]]
        for k, code in zip(own, self._singly([apart[k] for k in own])):
            out[k] = code + self.end
        for part in long:
            del memo[part]
        return out

    def _gather(self, known: list[bytes], heads: list[bytes], codes: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """Each text's ids: those of its head, of its other parts and the end id,
        copied from one buffer of the ids of all distinct parts."""
        table = [*known, *heads, self.end]
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // self.width
        buffer = np.frombuffer(b"".join(table), self.kind)
        begin = np.cumsum(sizes) - sizes
        n = len(heads)
        order = codes.astype(np.int64)
        order[starts[:-1]] = len(known) + np.arange(n)
        order = np.insert(order, starts[1:], len(table) - 1)
        lengths = sizes[order]
        ends = np.cumsum(lengths)
        at = np.repeat(begin[order] - ends + lengths, lengths) + np.arange(ends[-1])
        ids = buffer[at]
        stops = ends[starts[1:] + np.arange(n)]
        return [x.tobytes() for x in np.split(ids, stops[:-1])]


_LOADED: dict[tuple[str, int, bool], Encoder] = {}


def load(path: str, end_id: int, special_tokens: bool = False) -> Encoder:
    """A worker's encoder, read once."""
    key = path, end_id, special_tokens
    if key not in _LOADED:
        _LOADED[key] = Encoder(*key)
    return _LOADED[key]


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, special_tokens: bool = False) -> DataFrame:
    """Writes (doc_id, text) to record files in id order; returns the manifest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        store, root = open_folder(uri)
        encoder, name = None, f"part-{part:05d}-{uuid.uuid4().hex}"
        data = index = None
        offset = n_docs = n_tokens = 0
        held, entries = [], []

        def flush() -> None:
            nonlocal held, entries
            data.write(b"".join(held))
            index.write(np.array(entries, ENTRY).tobytes())
            held, entries = [], []

        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                rows = batch.slice(at, TOGETHER)
                if data is None:
                    encoder = load(tokenizer_path, end_id, special_tokens)
                    data, index = (store.open_output_stream(f"{root}/{name}.{x}") for x in ("rec", "idx"))
                ids = encoder(rows.column("text"))
                for doc_id, code in zip(rows.column("doc_id").to_pylist(), ids):
                    null = doc_id is None
                    record = frame(struct.pack(LEAD, 0 if null else doc_id, null, encoder.width) + code)
                    n = len(code) // encoder.width
                    held.append(record)
                    entries.append((0 if null else doc_id, null, offset, len(record), n))
                    offset, n_docs, n_tokens = offset + len(record), n_docs + 1, n_tokens + n
                if sum(map(len, held)) > BUFFER:
                    flush()
        if data is not None:
            flush()
            data.close()
            index.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [name], "n_docs": [n_docs], "n_tokens": [n_tokens]})

    spark = docs.sparkSession
    uri = shared_uri(spark, folder)
    store, root = open_folder(uri)
    store.create_dir(root)
    # rows of one id, or without one, may lie in several files
    (docs.select("doc_id", "text").repartitionByRange(F.col("doc_id"), F.octet_length("text")).sortWithinPartitions("doc_id")
     .mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest"))
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file, with the ids of all files before it as ``base``."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_records(spark: SparkSession, folder: str, shuffle_seed: int | None = None) -> DataFrame:
    """(doc_id, start, ids) of every record, fetched by its index entry: in
    stored order, or in a shuffled order within each file."""
    uri = shared_uri(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(uri)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{root}/{row['file']}.idx") as stream:
                    index = np.frombuffer(stream.read(), ENTRY)
                if len(index) != row["n_docs"]:
                    raise ValueError("index and manifest differ")
                starts = row["base"] + np.cumsum(index["n"]) - index["n"]
                order = list(range(len(index)))
                if shuffle_seed is not None:
                    random.Random(f"{shuffle_seed}:{row['part']}").shuffle(order)
                with store.open_input_file(f"{root}/{row['file']}.rec") as data:
                    for at in range(0, len(order), ROWS // 8):
                        ids, out, first = [], [], []
                        for k in order[at:at + ROWS // 8]:
                            payload = unframe(data.read_at(int(index["length"][k]), int(index["offset"][k])))
                            doc_id, null, width = struct.unpack_from(LEAD, payload)
                            code = np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(LEAD)).astype("<u4")
                            if len(code) != index["n"][k]:
                                raise ValueError("index and record differ")
                            ids.append(None if null else doc_id)
                            first.append(int(starts[k]))
                            out.append(code.tobytes())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids, pa.int64()), pa.array(first, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "start", "ids"])

    files = read_manifest(spark, folder)
    # a stated number of tasks: the tiny manifest rows say nothing of the files they name
    return files.repartition(max(1, files.count()), F.col("part")).mapInArrow(run, "doc_id long, start long, ids binary")
