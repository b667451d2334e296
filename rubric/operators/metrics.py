"""Per-sample text metrics (M1-M13) and the metric registry.

A metric is a pairing rule plus a *staged plan*: a list of stages, each a
function from "column getter" to new named columns.  Stage ``k`` only reads
columns produced by earlier stages as plain column references, so expensive
inputs (token arrays, vocabularies) are computed once per row and never
re-evaluated inside a higher-order lambda.  The last stage returns
``{output name: struct<value: double, valid: boolean>}``; ``valid`` carries
the metric's own skip rule, so denominators differ per metric without
filtering rows away.

``score_pairs`` runs any list of metrics side by side, stage by stage, in
narrow ``select``s (multi-metric scoring, M12): no shuffle, one pass.

Text preparation and scores are built-in Spark functions.  N-gram counts, the
LCS family (ROUGE-L, ROUGE-Lsum, fuzzy ratios) and edit distances run on Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubric.functions import lcs
from rubric.functions.overlap import jiwer_words, ngram_matches
from rubric.functions.text import (
    extract_asr_text,
    first_word_or_line,
    normalize_answer,
    quoted_text,
    space_punctuation,
    trim_ws,
    ws_tokens,
)

Getter = Callable[[str], Column]
Stage = Callable[[Getter], dict]


def result(value: Column, valid: Column) -> Column:
    return F.struct(value.cast("double").alias("value"), valid.alias("valid"))


def f1(matches: Column, n_ref: Column, n_pred: Column) -> Column:
    p = matches / F.greatest(n_pred, F.lit(1))
    r = matches / F.greatest(n_ref, F.lit(1))
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


# ---------------------------------------------------------------------------
# pairing rules (what each metric compares)
# ---------------------------------------------------------------------------

def pair_raw(gold: Column, response: Column) -> tuple[Column, Column]:
    return gold, response


def pair_answer(gold: Column, response: Column) -> tuple[Column, Column]:
    """Accuracy pairing: answer extraction on both sides."""
    return first_word_or_line(gold), first_word_or_line(response)


def pair_asr(gold: Column, response: Column) -> tuple[Column, Column]:
    """WER/CER pairing: text extraction on the response only (T5)."""
    return gold, extract_asr_text(response)


def first_response(response: Column) -> Column:
    """The first of a list of responses; an empty list is no response."""
    return F.coalesce(F.get(response, 0), F.lit(""))


def list_text(values: Column) -> Column:
    """A list written out, ``['a', 'b']``, as accuracy compares a gold of several
    answers: entries in single quotes, in double quotes if they hold only single ones."""
    quoted = lambda x: F.coalesce(quoted_text(x), F.lit("None"))
    return F.when(values.isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(values, quoted), ", "), F.lit("]")))


#: What a metric takes of a gold that is a list.
LIST_GOLDS: dict[str, Callable[[Column], Column]] = {
    "first": lambda g: F.get(g, 0),                         # BLEU: the first answer; an empty list is no gold
    "only": lambda g: F.when(F.size(g) == 1, F.get(g, 0)),  # error rates: lists of other lengths are skipped
    "text": list_text,                                      # accuracy: the list written out
    "lines": lambda g: F.array_join(g, "\n"),               # ROUGE and user metrics: one answer a line
}


# ---------------------------------------------------------------------------
# staged plans; every plan starts from columns "ref" and "pred"
# ---------------------------------------------------------------------------

def bleu_plan(name: str = "bleu") -> list[Stage]:
    """Sentence BLEU, 4-gram, no smoothing; skipped when either prepared side
    is empty.  Ref keeps braces, pred maps {} to []; both lose Arabic marks."""
    def tokens(c: Getter) -> dict:
        return {"rt": ws_tokens(space_punctuation(c("ref"), change_braces=False, remove_diacritics=True)),
                "pt": ws_tokens(space_punctuation(c("pred"), change_braces=True, remove_diacritics=True))}

    def matches(c: Getter) -> dict:
        return {"m": ngram_matches(c("rt"), c("pt"), 4), "lr": F.size(c("rt")), "lp": F.size(c("pt"))}

    def score(c: Getter) -> dict:
        lr, lp = c("lr"), c("lp")
        precisions = [F.when(lp - n + 1 > 0, c("m")[n - 1] / (lp - n + 1)).otherwise(F.lit(0.0)) for n in range(1, 5)]
        geo = F.when(F.least(*precisions) > 0,
                     F.exp(sum(F.ln(x) for x in precisions) / 4)).otherwise(F.lit(0.0))
        bp = F.when(lp > lr, F.lit(1.0)).otherwise(F.exp(1 - lr / lp))
        valid = (lr > 0) & (lp > 0)
        return {name: result(F.when(valid, geo * bp), valid)}

    return [tokens, matches, score]


ROUGE_PARTS = ("rouge1", "rouge2", "rougeL", "rougeLsum")


def _sentences(text: Column) -> Column:
    """Newline-separated sentences (non-empty), each split on white space."""
    parts = F.filter(F.split(trim_ws(text), "\n"), lambda s: F.length(s) > 0)
    return F.transform(parts, ws_tokens)


def rouge_plan(parts: tuple[str, ...] = ROUGE_PARTS) -> list[Stage]:
    """ROUGE F1 on punctuation-padded whitespace tokens, no stemming.  The
    reference keeps braces, the prediction maps {} to []; mean over all rows."""
    def prep(c: Getter) -> dict:
        ref = space_punctuation(c("ref"), change_braces=False)
        pred = space_punctuation(c("pred"), change_braces=True)
        out = {"rt": ws_tokens(ref), "pt": ws_tokens(pred)}
        if "rougeLsum" in parts:
            out["rs"], out["ps"] = _sentences(ref), _sentences(pred)
        return out

    def counts(c: Getter) -> dict:
        out = {"lr": F.size(c("rt")), "lp": F.size(c("pt"))}
        if "rouge1" in parts or "rouge2" in parts:
            out["m"] = ngram_matches(c("rt"), c("pt"), 2)
        if "rougeL" in parts:
            out["lcs_f"] = lcs.rouge_l_udf(c("rt"), c("pt"))
        if "rougeLsum" in parts:
            out["lsum_f"] = lcs.rouge_lsum_udf(c("rs"), c("ps"))
        return out

    def score(c: Getter) -> dict:
        ok = F.lit(True)
        lr, lp = c("lr"), c("lp")
        out = {}
        if "rouge1" in parts:
            out["rouge1"] = result(f1(c("m")[0], lr, lp), ok)
        if "rouge2" in parts:
            out["rouge2"] = result(f1(c("m")[1], F.greatest(lr - 1, F.lit(0)), F.greatest(lp - 1, F.lit(0))), ok)
        if "rougeL" in parts:
            out["rougeL"] = result(c("lcs_f"), ok)
        if "rougeLsum" in parts:
            out["rougeLsum"] = result(c("lsum_f"), ok)
        return out

    return [prep, counts, score]


def wer_plan(name: str = "wer") -> list[Stage]:
    """Word error rate; skipped when either side is empty or the reference has
    no words.  Word edit distance runs as the bit-parallel Arrow kernel (the
    JVM-side alternative ``overlap.word_edit_distance`` maps words to code
    points for the built-in ``levenshtein``; it is O(n*m) per pair)."""
    def words(c: Getter) -> dict:
        return {"rw": jiwer_words(c("ref")), "pw": jiwer_words(c("pred")),
                "ok": (F.coalesce(c("ref"), F.lit("")) != "") & (F.coalesce(c("pred"), F.lit("")) != "")}

    def distance(c: Getter) -> dict:
        valid = c("ok") & (F.size(c("rw")) > 0)
        return {"valid": valid, "n": F.size(c("rw")),
                "dist": lcs.edit_distance_udf(F.when(valid, c("rw")), F.when(valid, c("pw")))}

    def score(c: Getter) -> dict:
        return {name: result(F.when(c("valid"), c("dist") / c("n")), c("valid"))}

    return [words, distance, score]


def cer_plan(name: str = "cer") -> list[Stage]:
    """Character error rate on stripped text (code points), bit-parallel
    edit distance on Arrow batches (valid rows only)."""
    def prep(c: Getter) -> dict:
        return {"r": trim_ws(F.coalesce(c("ref"), F.lit(""))), "p": trim_ws(F.coalesce(c("pred"), F.lit(""))),
                "ok": (F.coalesce(c("ref"), F.lit("")) != "") & (F.coalesce(c("pred"), F.lit("")) != "")}

    def distance(c: Getter) -> dict:
        valid = c("ok") & (F.length(c("r")) > 0)
        return {"valid": valid, "n": F.length(c("r")),
                "dist": lcs.edit_distance_udf(F.when(valid, c("r")), F.when(valid, c("p")))}

    def score(c: Getter) -> dict:
        return {name: result(F.when(c("valid"), c("dist") / c("n")), c("valid"))}

    return [prep, distance, score]


def exact_accuracy_plan(name: str = "exact_accuracy") -> list[Stage]:
    def prep(c: Getter) -> dict:
        return {"a": normalize_answer(c("ref")), "b": normalize_answer(c("pred")),
                "ok": c("ref").isNotNull() & c("pred").isNotNull()}

    def score(c: Getter) -> dict:
        valid = c("ok") & (c("a") != "") & (c("b") != "")
        return {name: result(F.when(valid, (c("a") == c("b")).cast("double")), valid)}

    return [prep, score]


FUZZY_THRESHOLD = 0.85


def fuzzy_accuracy_plan(name: str = "accuracy") -> list[Stage]:
    """Correct when the normalised answers are equal, one contains the other
    (best-window ratio 1), or their indel ratio / best-window ratio reaches
    0.85.  Only rows not settled by equality or containment go to Python."""
    def prep(c: Getter) -> dict:
        return {"a": normalize_answer(c("ref")), "b": normalize_answer(c("pred")),
                "ok": c("ref").isNotNull() & c("pred").isNotNull()}

    def settle(c: Getter) -> dict:
        a, b = c("a"), c("b")
        valid = c("ok") & (a != "") & (b != "")
        settled = (a == b) | F.contains(a, b) | F.contains(b, a)
        return {"valid": valid, "settled": settled,
                "ra": F.when(valid & ~settled, a), "rb": F.when(valid & ~settled, b)}

    def fuzzy(c: Getter) -> dict:
        return {"ratio": lcs.ratio_udf(c("ra"), c("rb")), "partial": lcs.partial_ratio_udf(c("ra"), c("rb"))}

    def score(c: Getter) -> dict:
        hit = (c("ratio") >= FUZZY_THRESHOLD) | (c("partial") >= FUZZY_THRESHOLD)
        value = F.when(~c("valid"), F.lit(None)).when(c("settled"), F.lit(1.0)).otherwise(hit.cast("double"))
        return {name: result(value, c("valid"))}

    return [prep, settle, fuzzy, score]


# ---------------------------------------------------------------------------
# registry (U1 / U2)
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class MetricDef:
    name: str
    plan: Callable[[], list[Stage]]
    pair: Callable[[Column, Column], tuple[Column, Column]] = pair_raw
    higher_is_better: bool = True
    empty_value: float = 0.0          # task value when no sample is valid
    list_gold: str = "lines"          # what is taken of a list gold (LIST_GOLDS)
    outputs: tuple[str, ...] = field(default_factory=tuple)

    def output_names(self) -> tuple[str, ...]:
        return self.outputs or (self.name,)


class MetricRegistry:
    """Case-insensitive registry in registration order."""

    def __init__(self) -> None:
        self._defs: dict[str, MetricDef] = {}

    def register(self, metric: MetricDef) -> None:
        self._defs[metric.name.lower()] = metric

    def get(self, name: str) -> MetricDef:
        return self._defs[name.lower()]

    def names(self) -> list[str]:
        return [m.name for m in self._defs.values()]

    def defs(self) -> list[MetricDef]:
        return list(self._defs.values())

    def resolve(self, name: str) -> str:
        """First registered name contained (case-insensitively) in ``name``;
        the name itself when none is."""
        low = name.lower()
        for m in self._defs.values():
            if m.name.lower() in low:
                return m.name
        return name

    def __contains__(self, name: str) -> bool:
        return name.lower() in self._defs


REGISTRY = MetricRegistry()
# Registration order matters for resolve(): "accuracy" precedes "fuzzy_accuracy".
REGISTRY.register(MetricDef("bleu", bleu_plan, list_gold="first"))
REGISTRY.register(MetricDef("rouge", rouge_plan, outputs=ROUGE_PARTS))
REGISTRY.register(MetricDef("accuracy", lambda: fuzzy_accuracy_plan("accuracy"), pair=pair_answer, list_gold="text"))
REGISTRY.register(MetricDef("fuzzy_accuracy", lambda: fuzzy_accuracy_plan("fuzzy_accuracy"), pair=pair_answer, list_gold="text"))
REGISTRY.register(MetricDef("wer", wer_plan, pair=pair_asr, higher_is_better=False, empty_value=1.0, list_gold="only"))
REGISTRY.register(MetricDef("cer", cer_plan, pair=pair_asr, higher_is_better=False, empty_value=1.0, list_gold="only"))
REGISTRY.register(MetricDef("exact_accuracy", exact_accuracy_plan, pair=pair_answer, list_gold="text"))


def register_metric(name: str, score: Callable[[Column, Column], Column], *, pair=pair_raw,
                    higher_is_better: bool = True, empty_value: float = 0.0) -> MetricDef:
    """Add a user metric from a ``(ref, pred) -> struct(value, valid)``
    Column builder (a pandas UDF inside it is fine)."""
    m = MetricDef(name, lambda: [lambda c: {name: score(c("ref"), c("pred"))}], pair=pair,
                  higher_is_better=higher_is_better, empty_value=empty_value)
    REGISTRY.register(m)
    return m


# Built expression trees by metric definition (a name may be registered anew),
# reused across queries: a stage only reads fixed column names, so its Column
# objects do not depend on the DataFrame.  (Each
# expression node costs a JVM round trip to build.)
_STAGE_CACHE: dict = {}
_PAIR_CACHE: dict = {}


def _cols(prefix: str):
    return lambda col: F.col(f"{prefix}__{col}")


def score_pairs(pairs: DataFrame, metrics: list[str], gold: str = "gold",
                response: str = "response", keep: list[str] | None = None,
                only: dict[str, tuple[str, ...]] | None = None,
                needed: dict[str, str] | None = None) -> DataFrame:
    """Wide per-sample scores: one struct column per metric output.

    ``only`` optionally restricts a multi-output metric (e.g. rouge) to some
    outputs.  ``needed`` maps a metric to a boolean column of ``pairs``: rows
    where it is false get null inputs (cheap in every stage and kernel) and
    are meant to be dropped by the caller, as when metrics are carried per
    task (M12).  Stages of all metrics advance together, one ``select`` each.
    A response column of lists counts by its first entry, a gold column of lists
    by the metric's own rule (M13).
    """
    keep = keep if keep is not None else [c for c in pairs.columns if c not in (gold, response)]
    kinds = dict(pairs.dtypes)
    plans, defs = {}, {}
    first = []
    for name in metrics:
        m = REGISTRY.get(name)
        need = (needed or {}).get(name)
        lists = tuple(kinds[c].startswith("array") for c in (gold, response))
        pkey = (m, gold, response, need, lists)
        if pkey not in _PAIR_CACHE:
            ref = LIST_GOLDS[m.list_gold](F.col(gold)) if lists[0] else F.col(gold)
            ref, pred = m.pair(ref, first_response(F.col(response)) if lists[1] else F.col(response))
            if need is not None:
                ref, pred = F.when(F.col(need), ref), F.when(F.col(need), pred)
            _PAIR_CACHE[pkey] = [ref.alias(f"{m.name}__ref"), pred.alias(f"{m.name}__pred")]
        first += _PAIR_CACHE[pkey]
        parts = only.get(name) if only else None
        defs[m.name] = m
        plans[m.name] = (parts, (lambda p=parts: rouge_plan(p)) if parts and m.name == "rouge" else m.plan)
    cur = pairs.select(*keep, *first)
    outputs: list[str] = []
    depth = {mname: len(factory()) for mname, (_, factory) in plans.items()}
    for k in range(max(depth.values())):
        new = []
        for mname, (parts, factory) in plans.items():
            if k >= depth[mname]:
                continue
            last = k == depth[mname] - 1
            skey = (defs[mname], parts, k)
            if skey not in _STAGE_CACHE:
                got = factory()[k](_cols(mname))
                _STAGE_CACHE[skey] = [(out, expr.alias(out if last else f"{mname}__{out}")) for out, expr in got.items()]
            for out, expr in _STAGE_CACHE[skey]:
                new.append(expr)
                if last:
                    outputs.append(out)
        cur = cur.select("*", *new)
    return cur.select(*keep, *outputs)


def to_long(scored: DataFrame, keys: list[str], score_cols: list[str]) -> DataFrame:
    """Wide struct scores -> long rows (keys..., metric, value, valid)."""
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c)["value"].alias("value"), F.col(c)["valid"].alias("valid"))
        for c in score_cols
    ])).alias("s")
    return scored.select(*keys, stacked).select(*keys, "s.metric", "s.value", "s.valid")


def metric_info(metric: str) -> MetricDef:
    if metric in ROUGE_PARTS:
        return REGISTRY.get("rouge")
    return REGISTRY.get(metric)
