"""Benchmark dataset readers.

All readers return the same two tables:

* items: dataset, split, pos, id, instruction, input ARRAY<STRING>,
  output ARRAY<STRING>, mcq ARRAY<STRING>, experimental_prompts
  ARRAY<STRING>, source, source_link, difficulty, extras MAP<STRING,STRING>
* datasets: dataset, name, task, category, metric_spec (JSON text of the
  metric field in whatever shape it had), metadata MAP<STRING,STRING>, path

JSON is read with one VARIANT per file (union-typed fields stay exact until
normalised by column expressions); XML with Spark's built-in XML source; the
CSV layout (a metadata preamble before the header row) is parsed per file in
``mapInPandas``, one file per record, so files are read in parallel.
"""

from __future__ import annotations

import csv
import io
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CORE = ["id", "instruction", "input", "output", "mcq", "Experimental prompts", "source", "source_link",
        "difficulty"]
DROPPED_META = ["data", "guidelines_creating_data"]
ITEM_SCHEMA = ("dataset string, split string, pos int, id string, instruction string, input array<string>, "
               "output array<string>, mcq array<string>, experimental_prompts array<string>, source string, "
               "source_link string, difficulty string, extras map<string,string>")


def _stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def _as_strings(v: Column) -> Column:
    """VARIANT string or array -> ARRAY<STRING> (null when absent)."""
    k = F.schema_of_variant(v)
    return (F.when(k.startswith("ARRAY"), F.transform(F.try_variant_get(v, "$", "array<variant>"),
                                                      lambda x: F.try_variant_get(x, "$", "string")))
            .when(k.isNotNull() & (k != "VOID"), F.array(F.try_variant_get(v, "$", "string"))))


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _json_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, doc): each JSON file as one VARIANT."""
    return (spark.read.option("multiLine", True).option("singleVariantColumn", "doc").option("pathGlobFilter", "*.json").json(path)
            .select(F.col("_metadata.file_path").alias("path"), "doc"))


def _scheduled(files: DataFrame, skip_split_files: bool = True) -> DataFrame:
    """S6, judged file by file: exports (``*_test.json``, ``*_dev.json``) and enveloped
    datasets whose first listed metric is "" are skipped.  A file without an envelope is
    never skipped for its metric, and a skipped file does not touch its namesakes in
    other folders."""
    if skip_split_files:
        files = files.filter(~F.col("path").rlike(r"_(test|dev)\.json$"))
    first_metric = F.try_variant_get("doc", "$.json.metric_list[0].metric", "string")
    return files.filter(F.coalesce(first_metric, F.lit("x")) != "")


def task_schedule(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A task folder as three tables of rows.

    * scheduled: path, dataset (file stem), name, task, category of each file to run;
    * by_category: category, dataset, path, one row a dataset of the category;
    * task_of: name, task, the mapper from dataset names to tasks.  Of files with one
      name the last by path counts, as the later file replaces the earlier.
    """
    of = lambda field: F.try_variant_get("doc", f"$.{field}", "string")
    scheduled = _scheduled(_json_files(spark, path)).select(
        "path", _stem(F.col("path")).alias("dataset"), of("name").alias("name"), of("task").alias("task"), of("category").alias("category"))
    task_of = scheduled.groupBy("name").agg(F.max_by("task", "path").alias("task"))
    return scheduled, scheduled.select("category", "dataset", "path"), task_of


def read_json_datasets(spark: SparkSession, path: str, skip_split_files: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 + S5 + S6: one JSON document per dataset file.

    Envelope documents ({name, task, category, json: {...}}) are unwrapped,
    keeping the outer task and category.  Files named ``*_test.json`` or
    ``*_dev.json`` (exports) are skipped.
    """
    raw = _scheduled(_json_files(spark, path), skip_split_files)
    doc = F.col("doc")
    inner = F.variant_get(doc, "$.json", "variant")
    body = F.coalesce(inner, doc)
    docs = raw.select(
        "path",
        body.alias("body"),
        F.coalesce(F.when(inner.isNotNull(), _text(F.variant_get(doc, "$.task", "variant"))),
                   _text(F.variant_get(body, "$.task", "variant"))).alias("task"),
        F.coalesce(F.when(inner.isNotNull(), _text(F.variant_get(doc, "$.category", "variant"))),
                   _text(F.variant_get(body, "$.category", "variant"))).alias("category"),
    ).withColumn("dataset", _stem(F.col("path")))
    meta = F.from_json(F.to_json(F.col("body")), "map<string,variant>")
    datasets = docs.select(
        "dataset", "path", "task", "category",
        _text(F.variant_get(F.col("body"), "$.name", "variant")).alias("name"),
        F.to_json(F.coalesce(F.variant_get(F.col("body"), "$.metric_list", "variant"),
                             F.variant_get(F.col("body"), "$.metric", "variant"))).alias("metric_spec"),
        F.transform_values(F.map_filter(meta, lambda k, v: ~k.isin(*DROPPED_META)),
                           lambda k, v: F.coalesce(_text(v), F.to_json(v))).alias("metadata"),
    )
    splits = F.array(*[F.struct(F.lit(s).alias("split"),
                                F.try_variant_get(F.col("body"), f"$.data.{s}", "array<variant>").alias("rows"))
                       for s in ("test", "dev")])
    per_split = docs.select("dataset", F.explode(splits).alias("s")).select("dataset", "s.split", "s.rows")
    exploded = per_split.select("dataset", "split", F.posexplode("rows").alias("pos", "item"))
    return _items_from_variant(exploded), datasets


def _items_from_variant(df: DataFrame) -> DataFrame:
    item = F.col("item")

    def field(name: str) -> Column:
        return F.variant_get(item, f"$['{name}']", "variant")

    fields = F.from_json(F.to_json(item), "map<string,variant>")
    extras = F.transform_values(F.map_filter(fields, lambda k, v: ~k.isin(*CORE)),
                                lambda k, v: F.coalesce(_text(v), F.to_json(v)))
    return df.select(
        "dataset", "split", F.col("pos").cast("int").alias("pos"),
        _text(field("id")).alias("id"),
        _text(field("instruction")).alias("instruction"),
        _as_strings(field("input")).alias("input"),
        _as_strings(field("output")).alias("output"),
        _as_strings(field("mcq")).alias("mcq"),
        _as_strings(field("Experimental prompts")).alias("experimental_prompts"),
        _text(field("source")).alias("source"),
        _text(field("source_link")).alias("source_link"),
        _text(field("difficulty")).alias("difficulty"),
        extras.alias("extras"),
    )


def _parse_csv_file(path: str, content: str) -> tuple[dict, list[dict]]:
    rows = [r for r in csv.reader(io.StringIO(content)) if any(cell.strip() for cell in r)]
    if len(rows) < 2:
        raise ValueError(f"{path}: a dataset CSV needs metadata keys and values")
    meta = {k: v for k, v in zip(rows[0], rows[1]) if k}
    header_at = next((i for i, r in enumerate(rows) if r and r[0].strip() == "id"), None)
    if header_at is None:
        raise ValueError(f"{path}: no header row starting with 'id'")
    header = rows[header_at]
    items = []
    for r in rows[header_at + 1:]:
        rec = dict(zip(header, r + [""] * (len(header) - len(r))))

        def gathered(prefix: str) -> list[str] | None:
            vals = [rec[h] for h in header if h.startswith(prefix) and rec.get(h, "") != ""]
            return vals or None

        items.append({
            "id": rec.get("id"), "instruction": rec.get("instruction", ""),
            "output": [rec.get("output", "")], "source": rec.get("source", ""),
            "input": gathered("input_") or [], "experimental_prompts": gathered("experimental_"),
            "mcq": gathered("mcq_"),
        })
    return meta, items


def read_csv_datasets(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Metadata rows, then the item table after the row starting with
    ``id``; non-empty ``input_*`` / ``experimental_*`` / ``mcq_*`` cells
    become lists.  Items get split "test"."""
    files = (spark.read.option("pathGlobFilter", "*.csv").text(path, wholetext=True)
             .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for p, content in zip(b["path"], b["content"]):
                meta, items = _parse_csv_file(p, content)
                name = p.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                for pos, it in enumerate(items):
                    out.append({"dataset": name, "split": "test", "pos": pos, **it, "meta": meta})
            yield pd.DataFrame(out, columns=["dataset", "split", "pos", "id", "instruction", "input", "output",
                                             "mcq", "experimental_prompts", "source", "meta"])

    parsed = files.mapInPandas(parse, "dataset string, split string, pos int, id string, instruction string, "
                                      "input array<string>, output array<string>, mcq array<string>, "
                                      "experimental_prompts array<string>, source string, meta map<string,string>")
    items = parsed.select("dataset", "split", "pos", "id", "instruction", "input", "output", "mcq",
                          "experimental_prompts", "source", F.lit("").alias("source_link"),
                          F.lit("").alias("difficulty"), F.create_map().cast("map<string,string>").alias("extras"))
    datasets = parsed.groupBy("dataset").agg(F.first("meta").alias("metadata")).select(
        "dataset", F.lit(None).cast("string").alias("path"), F.col("metadata")["task"].alias("task"),
        F.col("metadata")["category"].alias("category"), F.col("metadata")["name"].alias("name"),
        F.to_json(F.array(F.col("metadata")["metric"])).alias("metric_spec"), "metadata")
    return items, datasets


XML_ITEM = ("id string, instruction string, input struct<value: array<string>>, output string, mcq struct<option: array<string>>, "
            "experimental_prompts struct<prompt: array<string>>, source string, source_link string, difficulty string")


def read_xml_datasets(spark: SparkSession, path: str, root_tag: str = "dataset") -> tuple[DataFrame, DataFrame]:
    """S3: ``data/item`` elements are items (``input/value``,
    ``mcq/option``, ``experimental_prompts/prompt`` lists, empty text
    dropped); the root's other children are metadata."""
    raw = (spark.read.format("xml").option("rowTag", "item").option("pathGlobFilter", "*.xml")
           .schema(XML_ITEM).load(path).withColumn("path", F.col("_metadata.file_path"))
           .withColumn("_at", F.monotonically_increasing_id()))
    # ids grow along a file, so their rank within the file is the item's place
    place = F.row_number().over(Window.partitionBy("path").orderBy("_at")) - 1

    def nested(c: str, child: str) -> Column:
        return F.filter(F.col(f"{c}.{child}"), lambda x: F.coalesce(x, F.lit("")) != "")

    items = raw.select(
        _stem(F.col("path")).alias("dataset"), F.lit("test").alias("split"), place.alias("pos"), "id", "instruction",
        nested("input", "value").alias("input"), F.array("output").alias("output"), nested("mcq", "option").alias("mcq"),
        nested("experimental_prompts", "prompt").alias("experimental_prompts"), "source", "source_link", "difficulty",
        F.create_map().cast("map<string,string>").alias("extras"))
    meta_raw = (spark.read.format("xml").option("rowTag", root_tag).option("pathGlobFilter", "*.xml")
                .option("inferSchema", "false").load(path).withColumn("path", F.col("_metadata.file_path")))
    keep = [c for c in meta_raw.columns if c not in DROPPED_META + ["path"]]
    meta = F.map_from_arrays(F.array(*[F.lit(c) for c in keep]),
                             F.array(*[F.col(f"`{c}`").cast("string") for c in keep]))
    datasets = meta_raw.select(
        _stem(F.col("path")).alias("dataset"), "path",
        (F.col("task") if "task" in keep else F.lit(None)).cast("string").alias("task"),
        (F.col("category") if "category" in keep else F.lit(None)).cast("string").alias("category"),
        (F.col("name") if "name" in keep else F.lit(None)).cast("string").alias("name"),
        F.to_json(F.array(F.col("metric").cast("string"))).alias("metric_spec") if "metric" in keep
        else F.lit(None).cast("string").alias("metric_spec"),
        meta.alias("metadata"))
    return items, datasets


def read_datasets(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """All three formats under ``path``; when one dataset exists in several
    formats, JSON wins over CSV over XML (rank by file stem)."""
    readers = {"json": read_json_datasets, "csv": read_csv_datasets, "xml": read_xml_datasets}
    # Spark lists the files once, so any store it reads will do
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    present = {r[0] for r in listed.select(F.lower(F.substring_index("path", ".", -1)).alias("e")).where(F.col("e").isin(*readers)).distinct().collect()}
    parts = [(rank, *reader(spark, path)) for rank, (ext, reader) in enumerate(readers.items()) if ext in present]
    if not parts:
        raise ValueError(f"no .json, .csv or .xml dataset under {path}")
    items = parts[0][1].withColumn("_rank", F.lit(parts[0][0]))
    datasets = parts[0][2].withColumn("_rank", F.lit(parts[0][0]))
    for rank, i, d in parts[1:]:
        items = items.unionByName(i.withColumn("_rank", F.lit(rank)))
        datasets = datasets.unionByName(d.withColumn("_rank", F.lit(rank)), allowMissingColumns=True)
    best = datasets.groupBy("dataset").agg(F.min("_rank").alias("_rank"))
    return (items.join(best, ["dataset", "_rank"], "left_semi").drop("_rank"),
            datasets.join(best, ["dataset", "_rank"], "left_semi").drop("_rank"))


def select_catalog(catalog: DataFrame, category: str, types: str | None = "generation") -> DataFrame:
    """Datasets of a category whose evaluation type is in a comma list
    (trimmed; empty entries ignored; default "generation")."""
    if not category:
        raise ValueError("a category is required")
    wanted = [t.strip() for t in (types or "generation").split(",") if t.strip()]
    return catalog.filter((F.col("category") == category) & F.col("type").isin(*wanted))


def uri_key(path: Column) -> Column:
    """One spelling of a file's address, whatever wrote it: ``file:`` and its slashes
    drop to the plain path, schemes are lower-cased, ``s3a`` and ``s3n`` are ``s3``, and
    slashes repeated after the authority or ``.`` steps count once."""
    scheme = F.lower(F.regexp_extract(path, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    rest = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    tidy = F.regexp_replace(F.regexp_replace(rest, r"/(\./)+", "/"), r"(?<=.)/{2,}", "/")
    store = F.when(scheme.isin("s3a", "s3n"), F.lit("s3")).otherwise(scheme)
    local = F.regexp_replace(tidy, r"^/+", "/")
    return F.when((scheme == "") | (scheme == "file"), local).otherwise(F.concat(store, F.lit("://"), F.regexp_replace(tidy, r"^/+", "")))


def media_references(spark: SparkSession, items: DataFrame, media_roots: list[str], dataset_dirs: DataFrame) -> DataFrame:
    """(dataset, ref, path, missing, kind, basename, place) of every image and
    audio reference of the items, resolved.

    Candidates in priority order: the dataset's directory, its ``.tasks`` folder, then
    the path as given.  The first that exists (a left join to ``binaryFile`` metadata on
    ``uri_key``, the content column pruned) wins; otherwise the dataset-directory path
    is kept and flagged missing.  ``place`` is the first place of the reference among
    the items (split, position, position in the input).  File listing skips hidden
    folders, so ``.tasks`` folders are passed in ``media_roots`` explicitly.
    """
    from rubric.functions.text import is_audio, is_image
    pos = [F.col(c) if c in items.columns else F.lit(None).cast(t) for c, t in (("split", "string"), ("pos", "int"))]
    rank = F.when(pos[0] == "test", 0).otherwise(1)
    refs = (items.select("dataset", rank.alias("_rank"), pos[1].cast("long").alias("_pos"), F.posexplode("input").alias("_at", "ref"))
            .filter(is_image("ref") | is_audio("ref"))
            .groupBy("dataset", "ref").agg(F.min(F.struct("_rank", "_pos", "_at")).alias("place")))
    refs = refs.join(dataset_dirs, "dataset", "left")
    candidates = refs.select("dataset", "ref", "place", F.posexplode(F.array(
        F.concat_ws("/", F.col("dir"), F.col("ref")), F.concat_ws("/", F.col("dir"), F.lit(".tasks"), F.col("ref")),
        F.col("ref"))).alias("priority", "candidate")).withColumn("_key", uri_key(F.col("candidate")))
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(media_roots)
             .groupBy(uri_key(F.col("path")).alias("_key")).agg(F.max("length").alias("length")))
    hit = candidates.join(files, "_key", "left")
    best = hit.groupBy("dataset", "ref").agg(
        F.min("place").alias("place"),
        F.min_by("candidate", F.when(F.col("length").isNotNull(), F.col("priority"))).alias("found"),
        F.min_by("candidate", "priority").alias("fallback"))
    return best.select("dataset", "ref", F.coalesce("found", "fallback").alias("path"), F.col("found").isNull().alias("missing"),
                       F.when(is_image("ref"), F.lit("image")).otherwise(F.lit("audio")).alias("kind"),
                       F.substring_index("ref", "/", -1).alias("basename"), "place")


def media_manifest(spark: SparkSession, items: DataFrame, media_roots: list[str], dataset_dirs: DataFrame) -> DataFrame:
    """One resolved file for each (dataset, kind, basename): of several references
    with one basename the first existing one in the items' order, else the first."""
    refs = media_references(spark, items, media_roots, dataset_dirs)
    first = F.min_by(F.struct("ref", "path", "missing"), F.struct("missing", "place", "ref"))
    return refs.groupBy("dataset", "kind", "basename").agg(first.alias("f")).select(
        "dataset", "f.ref", "f.path", "f.missing", "kind", "basename")
