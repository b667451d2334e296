"""Operator 3: secret scans with sliding-window Shannon entropy.

Base kinds are found by pattern.  Beside them, candidate strings (runs of at
least 20 characters of the base64 alphabet) are classed by their characters,
and a window of 20 characters slides over each.  The counts of the characters
in the window, of their classes and the sum of ``c * log2 c`` change only for the
character that enters and the one that leaves.  A window is judged by the limit of
its own class; windows at or over the limit are flagged and overlapping flagged
windows become one span.  Keys mix digits, lower and upper case within their runs,
while paths, slugs, dates and numbers change kind at separators and names at
capitals: a window needs digits, letters and at least ``MIXED`` pairs of neighbours
of different kinds, ``DIGIT_MIXED`` of them with a digit.
A match of the allow list (placeholders, documentation samples, counting
sequences) suppresses the windows that meet it or the letters and digits that it
stands in, if these are at most ``PLACEHOLDER`` characters; of a longer run only
the windows that meet the match.  UUIDs and spans that meet a base span are
suppressed; base spans always stay.

Edge cases: null texts count as empty; positions are code points, end
exclusive; texts without a match give the empty string and its digest; repeated
rows are scanned one by one; other columns are never touched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubric.llm.common import let

# The base patterns.  A hex or access run that is long enough is
# the same maximal run that the open-ended pattern finds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_MIN = 6
KINDS = ["assign", "access", "hex", "entropy"]

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Least entropy in bits of a window, by its class of characters.
#: Windows of letters alone are words in some language and never flagged.
HEX_BITS, ALNUM_BITS, BASE64_BITS = 3.0, 3.6, 3.8
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
ALLOWED = r"(?i)example|sample|placeholder|dummy|change_?me|your[_-]|x{4,}|0{6,}|1234567|abcdefg|lorem"
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
#: Least pairs of neighbours in a window that are of two kinds (digit, lower, upper case), and with a digit.
MIXED, DIGIT_MIXED = 5, 2
#: Longest run of letters and digits that an allowed match makes a placeholder.
PLACEHOLDER = 64
#: What a character adds to the counts by class, six bits each: digits, a-f, A-F,
#: other letters, the rest.
CLASS = [1 if ch.isdigit() else 1 << 6 if ch in "abcdef" else 1 << 12 if ch in "ABCDEF" else 1 << 18 if ch.isalpha() else 1 << 24
         for ch in ALPHABET]

#: Kind of a character: digit, lower case, upper case, 0 for the rest.
KIND = [1 if ch.isdigit() else 2 if ch.islower() else 3 if ch.isupper() else 0 for ch in ALPHABET]

SPAN = "array<struct<s:int,k:int,e:int>>"


def _empty() -> Column:
    return F.array().cast(SPAN)


def _matches(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """Spans of a pattern's leftmost non-overlapping matches.

    ``keep`` (one boolean per match) drops matches after they have consumed
    their text.  ``split`` gives what lies between the matches that ``regexp_extract_all``
    gives, so running lengths are their positions.
    """
    def spans(hits: Column) -> Column:
        parts = F.split(text, pattern)
        ok = F.transform(hits, lambda h: F.lit(True)) if keep is None else keep
        acc = F.struct(F.lit(0).alias("p"), _empty().alias("o"))
        rows = F.arrays_zip(F.slice(parts, F.lit(1), F.size(hits)).alias("a"), hits.alias("h"), ok.alias("ok"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["p"] + F.length(x["a"])
            end = start + F.length(x["h"])
            span = F.struct(start.alias("s"), F.lit(kind).alias("k"), end.alias("e"))
            return F.struct(end.alias("p"), F.when(x["ok"], F.array_append(acc["o"], span)).otherwise(acc["o"]).alias("o"))

        return F.aggregate(rows, acc, step, lambda acc: acc["o"])

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)).otherwise(_empty())


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds, by start, then kind."""
    long_enough = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_MIN)
    return F.sort_array(F.concat(
        _matches(text, ASSIGN, 0, long_enough), _matches(text, ACCESS, 1), _matches(text, HEX, 2)))


def _threshold(c: Column) -> Column:
    """Entropy limit of a candidate's class (null: never flagged)."""
    return (F.when(~c.rlike("[0-9]") | ~c.rlike("[A-Za-z]") | c.rlike(UUID), F.lit(None).cast("double"))
            .when(c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), F.lit(HEX_BITS))
            .when(c.rlike("^[A-Za-z0-9]+$"), F.lit(ALNUM_BITS))
            .otherwise(F.lit(BASE64_BITS)))


def _window_limit(classes: Column, limit: Column) -> Column:
    """Entropy limit of a window by its counts of classes (null: never flagged);
    ``limit`` is the candidate's."""
    lacks = lambda *at: classes.bitwiseAND(F.lit(sum(63 << 6 * k for k in at))) == 0
    return (F.when(lacks(0) | lacks(1, 2, 3), F.lit(None).cast("double"))
            .when(lacks(3, 4) & (lacks(1) | lacks(2)), F.least(limit, F.lit(HEX_BITS)))
            .when(lacks(4), F.least(limit, F.lit(ALNUM_BITS)))
            .otherwise(limit))


def _meets(x: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))


def _allowed(c: Column) -> Column:
    """Spans of ``c`` that the allow list suppresses."""
    return F.when(c.rlike(ALLOWED), let(_matches(c, ALLOWED, 0), lambda own: F.concat(own, F.filter(
        _matches(c, "[A-Za-z0-9]+", 0), lambda x: (x["e"] - x["s"] <= PLACEHOLDER) & _meets(x, own))))).otherwise(_empty())


def _hot_windows(c: Column, start: Column, limit: Column, allowed: Column) -> Column:
    """Spans of ``c`` (found at ``start``) whose windows reach their limits and
    meet no span of ``allowed``."""
    terms = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 2)])
    codes = F.transform(F.split(c, ""), lambda ch: F.instr(F.lit(ALPHABET), ch) - 1)
    weights = F.array(*[F.lit(w) for w in CLASS])
    kinds = F.array(*[F.lit(x) for x in KIND])
    zero = F.array_repeat(F.lit(0), len(ALPHABET))
    kind = F.lit(len(KINDS) - 1)

    def mixed(codes: Column) -> Column:
        """1 at each character of another kind than the one before it, 64 more if one
        of the two is a digit."""
        own = F.transform(codes, lambda k: F.get(kinds, k))
        return let(own, lambda x: F.zip_with(x, F.concat(F.array(F.lit(0)), F.slice(x, F.lit(1), F.size(x) - 1)),
                                             lambda a, b: F.when((a != b) & (a > 0) & (b > 0), F.when((a == 1) | (b == 1), 65).otherwise(1)).otherwise(0)))

    def scan(codes: Column) -> Column:
        return let(mixed(codes), lambda pairs: scan_pairs(codes, pairs))

    def scan_pairs(codes: Column, pairs: Column) -> Column:
        first = F.struct(zero.alias("n"), F.lit(0).alias("c"), F.lit(0).alias("m"), F.lit(0.0).alias("t"), F.lit(-1).alias("lo"), F.lit(-1).alias("hi"), _empty().alias("o"))

        def step(acc: Column, i: Column) -> Column:
            enters = F.get(codes, i)
            leaves = F.coalesce(F.get(codes, i - WINDOW), F.lit(-1))
            same = enters == leaves
            n_in, n_out = F.get(acc["n"], enters), F.coalesce(F.get(acc["n"], leaves), F.lit(0))
            total = (F.when(same, acc["t"]).otherwise(
                acc["t"] + F.get(terms, n_in + 1) - F.get(terms, n_in)
                + F.when(leaves >= 0, F.get(terms, n_out - 1) - F.get(terms, n_out)).otherwise(0.0)))
            counts = F.when(same, acc["n"]).otherwise(F.transform(
                acc["n"], lambda n, k: n + (k == enters).cast("int") - (k == leaves).cast("int")))
            classes = acc["c"] + F.get(weights, enters) - F.coalesce(F.get(weights, leaves), F.lit(0))
            mixing = acc["m"] + F.get(pairs, i) - F.coalesce(F.get(pairs, i - WINDOW + 1), F.lit(0))
            hot = ((i >= WINDOW - 1) & (mixing.bitwiseAND(F.lit(63)) >= MIXED) & (mixing >= 64 * DIGIT_MIXED)
                   & F.coalesce(F.lit(math.log2(WINDOW)) - total / WINDOW >= _window_limit(classes, limit), F.lit(False))
                   & ~F.exists(allowed, lambda b: (b["s"] <= i) & (i - WINDOW + 1 < b["e"])))
            lo, joins = i - (WINDOW - 1), (acc["hi"] >= 0) & (i - (WINDOW - 1) <= acc["hi"])
            done = F.struct((start + acc["lo"]).alias("s"), kind.alias("k"), (start + acc["hi"]).alias("e"))
            return F.struct(
                counts.alias("n"), classes.alias("c"), mixing.alias("m"), total.alias("t"),
                F.when(hot & ~joins, lo).otherwise(acc["lo"]).alias("lo"),
                F.when(hot, i + 1).otherwise(acc["hi"]).alias("hi"),
                F.when(hot & ~joins & (acc["hi"] >= 0), F.array_append(acc["o"], done)).otherwise(acc["o"]).alias("o"))

        def finish(acc: Column) -> Column:
            last = F.struct((start + acc["lo"]).alias("s"), kind.alias("k"), (start + acc["hi"]).alias("e"))
            return F.when(acc["hi"] >= 0, F.array_append(acc["o"], last)).otherwise(acc["o"])

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), first, step, finish)

    return let(codes, scan)


def entropy_spans(text: Column, base: Column) -> Column:
    """Spans of high-entropy windows that meet no base span."""
    def scan(found: Column) -> Column:
        return F.flatten(F.transform(found, lambda m: let(
            F.substring(text, m["s"] + 1, m["e"] - m["s"]),
            lambda c: let(_threshold(c), lambda limit: F.when(limit.isNull(), _empty()).otherwise(
                let(_allowed(c), lambda allowed: _hot_windows(c, m["s"], limit, allowed)))))))

    return let(scan(_matches(text, CANDIDATE, len(KINDS) - 1)), lambda own: F.filter(own, lambda x: ~_meets(x, base)))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def with_spans(docs: DataFrame, text_col: str, base: str, spans: str) -> DataFrame:
    """``docs`` with the arrays of base and of all spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(base, base_spans(text)).withColumn(
        spans, F.sort_array(F.concat(F.col(base), entropy_spans(text, F.col(base)))))


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts, base digest and all spans of every document."""
    found = with_spans(docs, "text", "base", "all_spans")
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("all_spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Each maximal run of secret characters replaced by ``mark``; texts without
    secrets, and all other columns, stay as they are."""
    text = F.col(text_col)
    found = with_spans(docs, text_col, "__base", "__spans")

    def step(acc: Column, x: Column) -> Column:
        fresh = x["s"] >= acc["p"]
        return F.struct(
            F.greatest(acc["p"], x["e"]).alias("p"),
            F.when(fresh, F.concat(acc["o"], F.substring(text, acc["p"] + 1, x["s"] - acc["p"]), F.lit(mark)))
            .otherwise(acc["o"]).alias("o"))

    first = F.struct(F.lit(0).alias("p"), F.lit("").alias("o"))
    clean = F.aggregate(F.col("__spans"), first, step, lambda acc: F.concat(
        acc["o"], F.substring(text, acc["p"] + 1, F.length(text))))
    return found.withColumn(text_col, F.when(F.size("__spans") > 0, clean).otherwise(text)).drop("__base", "__spans")
