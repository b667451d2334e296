"""Dataset and item preparation.

Items are a table ``(dataset, split, id, instruction, input ARRAY<STRING>,
output ARRAY<STRING>, mcq ARRAY<STRING>, ...)``; datasets a small table
``(dataset, task, category, metrics ARRAY<STRING>, ...)``.  Every operator
is a column expression or a hash aggregate; per-dataset results are joined
back on the dataset key (Spark broadcasts that side only when its measured
size is under the broadcast threshold).
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from rubric.functions.text import (
    col_,
    escape_newlines,
    escape_newlines_array,
    is_audio,
    is_image,
    key_basic,
    safe_name,
    trim_ws,
)
from rubric.operators.metrics import REGISTRY

CORE_DEFAULTS = {"id": None, "input": "", "output": "", "instruction": "", "source": "",
                 "source_link": "", "difficulty": ""}


def escape_item_newlines(items: DataFrame) -> DataFrame:
    """Newline -> the two characters backslash-n in every string field."""
    cols = []
    for name, dtype in items.dtypes:
        if dtype == "string":
            cols.append(escape_newlines(name).alias(name))
        elif dtype == "array<string>":
            cols.append(escape_newlines_array(name).alias(name))
        else:
            cols.append(F.col(name))
    return items.select(*cols)


LIST_FIELDS = ("input", "output")


def normalize_items(items: DataFrame) -> DataFrame:
    """Missing core fields get their defaults: "" for strings, one empty string
    for the lists ``input`` and ``output``, null for ``id``; ``mcq`` and experimental
    prompts stay absent.  With an ``extras`` map, see ``fill_extras``."""
    kinds = dict(items.dtypes)
    cols = [F.col(c) for c in items.columns]
    for name, default in CORE_DEFAULTS.items():
        if name not in kinds:
            value = F.array(F.lit("")) if name in LIST_FIELDS else F.lit(default).cast("string")
            cols.append(value.alias(name))
    out = items.select(*cols)
    kinds = dict(out.dtypes)
    fill = {n: d for n, d in CORE_DEFAULTS.items() if d is not None and kinds[n] == "string"}
    lists = {n: F.coalesce(F.col(n), F.array(F.lit(""))) for n in LIST_FIELDS if kinds[n] == "array<string>"}
    out = out.fillna(fill).withColumns(lists)
    return fill_extras(out) if "extras" in kinds else out


def fill_extras(items: DataFrame, extras: str = "extras") -> DataFrame:
    """P2 for keys beyond the core: an item lacking a key that another item of its
    dataset and split has gets "" for it; keys in order.

    The keys of a split are its schema, an aggregate of a few strings that is joined
    back on (dataset, split)."""
    keys = (items.select("dataset", "split", F.explode(F.map_keys(extras)).alias("_key"))
            .groupBy("dataset", "split").agg(F.array_sort(F.collect_set("_key")).alias("_keys")))
    own = F.coalesce(F.col(extras), F.create_map().cast("map<string,string>"))
    value = lambda k: F.when(F.map_contains_key(own, k), F.element_at(own, k)).otherwise(F.lit(""))
    filled = F.when(F.col("_keys").isNull(), own).otherwise(F.map_from_arrays("_keys", F.transform("_keys", value)))
    return items.join(keys, ["dataset", "split"], "left").withColumn(extras, filled).drop("_keys")


def first_output(output: Column | str) -> Column:
    """P5: the first element of a non-empty list output (null when empty)."""
    o = col_(output)
    return F.when(F.size(o) > 0, F.get(o, 0))


def render_input(inputs: Column | str) -> Column:
    """List input joined by newline; image files -> <image>, audio -> <audio>."""
    return F.array_join(F.transform(col_(inputs), lambda x: F.when(is_image(x), F.lit("<image>"))
                                    .when(is_audio(x), F.lit("<audio>")).otherwise(x)), "\n")


def media_paths(inputs: Column | str, kind: str = "image") -> Column:
    """Image (or audio) entries of the input; null when none."""
    test = is_image if kind == "image" else is_audio
    found = F.filter(col_(inputs), test)
    return F.when(F.size(found) > 0, found)


def dataset_modality(items: DataFrame) -> DataFrame:
    """Whether a dataset has image / audio inputs in any split."""
    return items.groupBy("dataset").agg(
        F.bool_or(F.exists("input", is_image)).alias("has_images"),
        F.bool_or(F.exists("input", is_audio)).alias("has_audio"))


def prompt_templates(items: DataFrame) -> DataFrame:
    """Per dataset, look at the first item of "test" (else "dev"): a
    non-empty instruction without "not_ins" gives instruction + newline +
    input, otherwise input only.  Items are ordered by ``id_order``, or by the
    readers' ``pos``."""
    place = "id_order" if "id_order" in items.columns else "pos"
    rank = F.when(F.col("split") == "test", 0).when(F.col("split") == "dev", 1).otherwise(2)
    first = items.groupBy("dataset").agg(
        F.min_by(F.col("instruction"), F.struct(rank, F.col(place))).alias("first_instruction"))
    ins = F.coalesce(F.col("first_instruction"), F.lit(""))
    use = (ins != "") & ~F.contains(ins, F.lit("not_ins"))
    return first.select("dataset", F.when(use, F.lit("instruction_input")).otherwise(F.lit("input")).alias("template"),
                        F.when(use, ins).alias("template_instruction"))


def render_prompt(items: DataFrame, templates: DataFrame) -> DataFrame:
    """Apply the dataset template to every item."""
    joined = items.join(templates, "dataset")
    text = render_input("input")
    prompt = F.when(F.col("template") == "instruction_input",
                    F.concat(F.col("template_instruction"), F.lit("\n"), text)).otherwise(text)
    return joined.withColumn("prompt", prompt)


def render_prompt_per_row(instruction: Column | str, text: Column | str) -> Column:
    """P9 per-row variant: non-empty parts joined by newline."""
    return F.concat_ws("\n", F.nullif(col_(instruction), F.lit("")), F.nullif(col_(text), F.lit("")))


def metric_list(spec: Column | str) -> Column:
    """P10: a metric given as string, list, or object with "metric" (JSON text)
    -> list of names, nulls dropped."""
    s = col_(spec)
    v = F.try_parse_json(s)
    kind = F.schema_of_variant(v)
    arr = F.from_json(s, "array<string>")
    obj = F.try_variant_get(v, "$.metric", "string")
    return (F.when(kind.startswith("ARRAY"), F.array_compact(arr))
            .when(kind.startswith("OBJECT"), F.when(obj.isNotNull(), F.array(obj)).otherwise(F.array().cast("array<string>")))
            .when(kind == "STRING", F.array(F.try_variant_get(v, "$", "string")))
            .when(s.isNull() | (s == ""), F.array().cast("array<string>"))
            .otherwise(F.array(s)))


def resolve_metric(name: Column | str) -> Column:
    """The first registered metric name contained case-insensitively in
    ``name``; else the name itself.  The registry is code (a handful of
    names), so this is a CASE chain, not a join."""
    n = col_(name)
    low = F.lower(n)
    expr = None
    for m in REGISTRY.names():
        cond = F.contains(low, F.lit(m.lower()))
        expr = F.when(cond, F.lit(m)) if expr is None else expr.when(cond, F.lit(m))
    return expr.otherwise(n)


def metric_higher_is_better(resolved: Column | str) -> Column:
    """Direction of a resolved metric; unknown names count as higher-is-better."""
    lower = [m.name for m in REGISTRY.defs() if not m.higher_is_better]
    return ~col_(resolved).isin(*lower)


def split_kind(metrics: Column | str) -> Column:
    """first metric exactly "accuracy" -> "mcq", anything else -> "generation"."""
    return F.when(F.get(col_(metrics), 0) == "accuracy", F.lit("mcq")).otherwise(F.lit("generation"))


def assign_task(existing: Column, name: Column, explicit: str | None = None, mapped: Column | None = None) -> Column:
    """Existing task; else an explicit id; else a mapper lookup; else the
    first "_" part of names with at least five parts; else the full name."""
    parts = F.split(name, "_")
    options = [existing]
    if explicit is not None:
        options.append(F.lit(explicit))
    if mapped is not None:
        options.append(mapped)
    options.append(F.when(F.size(parts) >= 5, F.get(parts, 0)))
    options.append(name)
    return F.coalesce(*options)


def dataset_name(task: Column, category: Column, kind: Column, metrics: Column) -> Column:
    """Task, category, type and metrics joined by "_" plus a short
    deterministic hash suffix; forbidden file characters -> "_"."""
    base = F.concat_ws("_", task, category, kind, F.array_join(metrics, "_"))
    return safe_name(F.concat_ws("_", base, F.substring(F.sha2(base, 256), 1, 10)))


@pandas_udf(StringType())
def _nfkc(keys: pd.Series) -> pd.Series:
    return keys.map(lambda k: None if k is None else unicodedata.normalize("NFKC", k))


def normalize_keys(df: DataFrame, column: str, out: str = "key") -> DataFrame:
    """NFKC (Python, on *distinct* values only) then lower, drop NUL,
    strip, first 255 characters, and ' ./' -> '_'; joined back."""
    distinct = df.select(column).distinct()
    keys = distinct.select(column, key_basic(_nfkc(F.col(column))).alias(out))
    return df.join(keys, column, "left")


def map_alias(df: DataFrame, mapping: DataFrame, column: str, sanitized: bool = True) -> DataFrame:
    """Alias -> task name through a mapping table (alias, task); an
    unknown alias fails the job."""
    from rubric.functions.text import sanitize_text
    key = sanitize_text(F.col(column)) if sanitized else F.col(column)
    m = mapping.select((sanitize_text("alias") if sanitized else F.col("alias")).alias("_alias"), "task")
    joined = df.withColumn("_alias", key).join(m, "_alias", "left")
    checked = F.when(F.col("task").isNotNull(), F.col("task")).otherwise(
        F.raise_error(F.concat(F.lit("unknown alias: "), F.col(column))))
    return joined.withColumn("task", checked).drop("_alias")


def redact_config(df: DataFrame, column: str = "config", path: str = "model_args.api_key") -> DataFrame:
    """Drop the API key from a nested configuration struct."""
    return df.withColumn(column, F.col(column).dropFields(path))


def valid_datasets(datasets: DataFrame, items: DataFrame) -> DataFrame:
    """datasets with at least one item in some split (anti join drops empties)."""
    counts = items.groupBy("dataset").count()
    return datasets.join(counts, "dataset", "left_semi")


def empty_datasets(datasets: DataFrame, items: DataFrame) -> DataFrame:
    return datasets.join(items.select("dataset").distinct(), "dataset", "left_anti")


def item_records(items: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Dataset, split, pos and ``record``, the item as one JSON object.

    The input is rendered text (P3), the output its first entry (P5), ``images`` and
    ``audio`` are the item's media (P6) under the paths that ``manifest`` (dataset,
    ref, path) resolves them to, else as given.  As with all keys, an item without
    media has "" for them if another item of its split has some.  Items as the
    readers give them, or normalised ones.
    """
    place = "pos" if "pos" in items.columns else "id_order"
    kinds = dict(items.dtypes)
    media = {"images": media_paths("input", "image"), "audio": media_paths("input", "audio")}
    flat = items.withColumns(media)
    if manifest is not None:
        key = ["dataset", "split", place]
        ref = flat.select(*key, F.posexplode(F.concat(*[F.coalesce(F.col(m), F.array().cast("array<string>")) for m in media])).alias("_at", "ref"))
        paths = (ref.join(manifest.select("dataset", "ref", "path"), ["dataset", "ref"], "left")
                 .groupBy(*key).agg(F.map_from_entries(F.collect_set(F.struct("ref", F.coalesce("path", "ref")))).alias("_paths")))
        flat = flat.join(paths, key, "left")
        resolved = lambda m: F.transform(F.col(m), lambda r: F.coalesce(F.element_at(F.col("_paths"), r), r))
        flat = flat.withColumns({m: resolved(m) for m in media})
    has = flat.groupBy("dataset", "split").agg(*[F.bool_or(F.col(m).isNotNull()).alias(f"_has_{m}") for m in media])
    flat = flat.join(has, ["dataset", "split"])
    as_json = lambda c: F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)")
    flat = flat.withColumns({"_input": render_input("input"), "_output": F.coalesce(first_output("output"), F.lit(""))})
    text = {"id": "id", "input": "_input", "output": "_output", "instruction": "instruction", "source_link": "source_link",
            "difficulty": "difficulty", "source": "source"}
    pairs = [F.concat(F.lit(f'"{name}":'), F.coalesce(as_json(f"`{c}`"), F.lit("null"))) for name, c in text.items() if c in flat.columns]
    lists = {"mcq": "mcq", "Experimental prompts": "experimental_prompts"}
    pairs += [F.when(F.col(c).isNotNull(), F.concat(F.lit(f'"{name}":'), F.to_json(c))) for name, c in lists.items() if c in kinds]
    pairs += [F.when(F.col(f"_has_{m}"), F.concat(F.lit(f'"{m}":'), F.coalesce(F.to_json(m), F.lit('""')))) for m in media]
    if "extras" in kinds:
        pairs.append(F.when(F.size("extras") > 0, F.expr("substring(to_json(extras), 2, length(to_json(extras)) - 2)")))
    record = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    return flat.select("dataset", "split", F.col(place).alias("pos"), record.alias("record"))


def schema_keys(items: DataFrame, extras: str = "extras", by: list[str] | None = None) -> DataFrame:
    """Union of extra keys over items, of each of ``by`` if given (one row per
    distinct key)."""
    return items.select(*(by or []), F.explode(F.map_keys(extras)).alias("key")).distinct()


def drop_empty_groups(catalog: DataFrame) -> DataFrame:
    """rows without category dropped (empty groups then never appear)."""
    return catalog.filter(F.col("category").isNotNull() & (trim_ws(F.col("category")) != ""))


def first_valid_attempt(attempts: DataFrame, keys: list[str], response: str = "response", limit: int = 3) -> DataFrame:
    """Per request the first attempt (of ``limit``) whose text is not blank, as
    ``response`` and ``used``; both null when none is."""
    ok = (trim_ws(F.col(response)) != "") & (F.col("attempt") <= limit)
    return attempts.groupBy(*keys).agg(
        F.min_by(response, F.when(ok, F.col("attempt"))).alias(response), F.min(F.when(ok, F.col("attempt"))).alias("used"))


def join_responses(items: DataFrame, responses: DataFrame, keys: list[str]) -> DataFrame:
    """One response per request; none -> "".

    Two responses of one request stop the job: the check is an aggregate on the
    join's own keys, so both share one shuffle.
    """
    n = F.count("*")
    twice = F.raise_error(F.lit("more than one response for a request"))
    rest = [c for c in responses.columns if c not in keys]
    one = responses.groupBy(*keys).agg(F.when(n > 1, twice).otherwise(F.max(F.struct(*rest))).alias("_one"))
    joined = items.join(one, keys, "left").select(*items.columns, "_one.*")
    return joined.withColumn("response", F.coalesce(F.col("response"), F.lit("")))


def join_model_responses(items: DataFrame, responses: DataFrame, keys: list[str], models: list[str]) -> DataFrame:
    """J1 for several models at once: each item's responses meet it as one map by
    model, so an item is shuffled once, and becomes a row a model only then.

    Two responses of one model to one request stop the job, as a map's key is unique.
    A row's map holds at most one entry a model."""
    by_item = responses.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("model", "response"))).alias("_answers"))
    joined = items.join(by_item, keys, "left")
    return (joined.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
            .withColumn("response", F.coalesce(F.element_at("_answers", F.col("model")), F.lit(""))).drop("_answers"))
