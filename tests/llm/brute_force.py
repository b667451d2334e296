"""Plain versions of the operators, for small inputs."""

import base64
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers as P


def quality(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def repeats(rows, length=200):
    """[(n_bytes, n_removed, n_spans, digest)] of [(id, text)]."""
    data = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, r in zip(b, gone) if not r)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


KINDS = ["assign", "access", "hex"]


def secrets(text):
    t, out = text or "", []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    out.sort()
    c = collections.Counter(k for _, k, _ in out)
    joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in out)
    return c[0], c[1], c[2], hashlib.sha256(joined.encode()).hexdigest()


def entropy(window):
    return -sum(c / len(window) * math.log2(c / len(window)) for c in collections.Counter(window).values())


def tiktoken_encoding():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def record_rows(rows):
    """{id: (start, n, crc)} of [(id, text)] with ids that differ; null id first."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    out, start = {}, 0
    for k, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out.setdefault(k, []).append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near(rows, k, percent=80):
    """{id: (set size, component)} of {id: text}."""
    sets = {i: shingles(t, k) for i, t in rows.items()}
    root = {i: i for i in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(rows)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in rows}


def segments(values):
    """All maximal scoring segments: the best segment, then the same on either side."""
    def best(a, b):
        top = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += values[j]
                if total > 0 and (top is None or total > top[0] + 1e-12):
                    top = (total, i, j + 1)
        if top is None:
            return []
        return [*best(a, top[1]), (top[1], top[2], top[0]), *best(top[2], b)]
    return best(0, len(values))
