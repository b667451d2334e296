"""Plain-Python reference implementations used only to check the Spark plans."""

import math
import re
import sys
import unicodedata
from collections import Counter

_P = "".join(chr(i) for i in range(sys.maxunicode) if unicodedata.category(chr(i)).startswith("P") and chr(i) != "\\")
_PUNCT = re.compile("([" + re.escape(_P + "`÷×<>^ـ~¦+|") + "])")


def space_punct(t, braces=False, diacritics=False):
    t = _PUNCT.sub(r" \1 ", t or "")
    if braces:
        t = t.replace("{", "[").replace("}", "]")
    if diacritics:
        t = re.sub("[\u064b-\u0652]", "", t)
    return t


def ngrams(tok, n):
    return Counter(tuple(tok[i:i + n]) for i in range(len(tok) - n + 1))


def bleu(ref, pred):
    r = space_punct(ref, False, True).split()
    p = space_punct(pred, True, True).split()
    if not r or not p:
        return None
    precs = []
    for n in range(1, 5):
        m = sum((ngrams(r, n) & ngrams(p, n)).values())
        poss = len(p) - n + 1
        precs.append(m / poss if poss > 0 else 0.0)
    geo = math.exp(sum(math.log(x) for x in precs) / 4) if min(precs) > 0 else 0.0
    ratio = len(p) / len(r)
    bp = 1.0 if ratio > 1.0 else math.exp(1 - 1 / ratio)
    return geo * bp


def f1(m, nr, np_):
    p = m / max(np_, 1)
    r = m / max(nr, 1)
    return 2 * p * r / (p + r) if p + r > 0 else 0.0


def rouge_n(ref, pred, n):
    r = space_punct(ref).split()
    p = space_punct(pred, True).split()
    m = sum((ngrams(r, n) & ngrams(p, n)).values())
    return f1(m, max(len(r) - n + 1, 0), max(len(p) - n + 1, 0))


def lcs_table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = t[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(t[i - 1][j], t[i][j - 1])
    return t


def rouge_l(ref, pred):
    r = space_punct(ref).split()
    p = space_punct(pred, True).split()
    if not r or not p:
        return 0.0
    lcs = lcs_table(r, p)[-1][-1]
    return f1(lcs, len(r), len(p)) if lcs else 0.0


def rouge_lsum(ref, pred):
    rs = [s.split() for s in space_punct(ref).strip().split("\n") if len(s)]
    ps = [s.split() for s in space_punct(pred, True).strip().split("\n") if len(s)]
    m, n = sum(map(len, rs)), sum(map(len, ps))
    if not m or not n:
        return 0.0
    cr, cp = Counter(t for s in rs for t in s), Counter(t for s in ps for t in s)
    hits = 0
    for r in rs:
        union = set()
        for c in ps:
            t = lcs_table(r, c)
            i, j = len(r), len(c)
            while i > 0 and j > 0:
                if r[i - 1] == c[j - 1]:
                    union.add(i - 1)
                    i, j = i - 1, j - 1
                elif t[i][j - 1] > t[i - 1][j]:
                    j -= 1
                else:
                    i -= 1
        for k in sorted(union):
            tok = r[k]
            if cr[tok] > 0 and cp[tok] > 0:
                hits += 1
                cr[tok] -= 1
                cp[tok] -= 1
    return f1(hits, m, n) if hits else 0.0


def levenshtein(a, b):
    prev = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        cur = [i] + [0] * len(b)
        for j in range(1, len(b) + 1):
            cur[j] = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (a[i - 1] != b[j - 1]))
        prev = cur
    return prev[-1]


def wer_words(t):
    t = re.sub(r"\s\s+", " ", t or "").strip()
    return [w for w in t.split(" ") if w]


def wer(ref, pred):
    if not ref or not pred:
        return None
    r, p = wer_words(ref), wer_words(pred)
    if not r:
        return None
    return levenshtein(r, p) / len(r)


def cer(ref, pred):
    if not ref or not pred:
        return None
    r, p = ref.strip(), pred.strip()
    if not r:
        return None
    return levenshtein(r, p) / len(r)


def ratio(a, b):
    if not a and not b:
        return 1.0
    return 2 * lcs_table(a, b)[-1][-1] / (len(a) + len(b))


def partial_ratio(a, b):
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    n1, n2 = len(a), len(b)
    best = 0.0
    for k in range(1, n1):
        best = max(best, ratio(a, b[:k]))
    for s in range(0, n2 - n1 + 1):
        best = max(best, ratio(a, b[s:s + n1]))
    for s in range(n2 - n1 + 1, n2):
        best = max(best, ratio(a, b[s:]))
    if n1 == n2:
        for k in range(1, n1):
            best = max(best, ratio(b, a[:k]), ratio(b, a[n1 - k:]))
    return best
