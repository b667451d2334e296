"""Operator 12: URL filter by a blocked Bloom filter and an exact join (native).

Rules are canonical (host, path) pairs with a verdict.  A rule fits the URLs of its
host and of all subdomains whose path starts with the rule's path; the longest rule
that fits decides, and a URL that no rule fits is allowed: the method's own verdict
on what is not listed.

Method: every listed (host, path) sets eight bits in one 256-bit block of a Bloom
filter (one row a block, one bit in each of eight 32-bit words).  A URL's possible
rules are its host's suffixes at label borders with the path's prefixes, of lengths
that occur among the rules.  The filter drops nearly all that are not listed; the
rest go to an exact equi-join with the rules, which removes the false positives.
Everything is DataFrame functions.

Bounds: the filter has at most ``MAX_BLOCKS`` rows, so its broadcast is bounded (a few
MB) however long the list; beyond that more possible rules pass to the join, which
stays exact.  What reaches the driver is the number of rules, the longest rule host and
the distinct lengths of rule paths.  The join with the rules is dealt by rule and one of
``SALTS`` numbers, so a rule that fits a third of all URLs lies in many tasks.

Edge cases: a null URL or one without ``://`` has an empty host and path; rules with an
empty host fit only an equal (empty) host.  Rules are canonicalised by lower-casing A-Z
in the host; null hosts or paths count as empty; of equal rules ``block`` wins; among
fitting rules of equal length the one with the longer host wins.  Repeated rows and null
ids are judged one by one; an empty table gives an empty result, an empty list allows
everything; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubric.llm.bloom import MAX_BLOCKS, all_bits, block_of, blocks, n_blocks_for  # noqa: F401
from rubric.llm.common import let

SALTS = 8

# A-Z and a-z, the only letters that a host changes.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> Column:
    """struct(host, path) of a URL: the host follows the first ``://`` up to ``/``,
    ``?``, ``#`` or the end, the path goes on up to ``?``, ``#`` or the end."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return let(after, lambda rest: let(
        F.regexp_extract(rest, r"^[^/?#]*", 0),
        lambda host: F.struct(
            F.translate(host, UPPER, LOWER).alias("host"),
            F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0).alias("path"))))


def canonical_rules(rules: DataFrame) -> DataFrame:
    """(host, path, verdict), once each; ``rules`` has host, path and verdict."""
    host = F.translate(F.coalesce(F.col("host").cast("string"), F.lit("")), UPPER, LOWER)
    return (rules.select(host.alias("host"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                         (F.col("verdict") == "block").alias("blocks"))
            .groupBy("host", "path").agg(F.bool_or("blocks").alias("blocks"))
            .select("host", "path", F.when(F.col("blocks"), F.lit("block")).otherwise(F.lit("allow")).alias("verdict")))


# ---------------------------------------------------------------------------
# Filter
# ---------------------------------------------------------------------------

def rule_key(host: Column, path: Column) -> Column:
    return F.xxhash64(host, path)


def bloom_blocks(rules: DataFrame, n_blocks: int) -> DataFrame:
    """The filter of the listed rules: block, w0..w7; at most ``n_blocks`` rows."""
    return blocks(rules.select(rule_key(F.col("host"), F.col("path")).alias("key")), n_blocks)


# ---------------------------------------------------------------------------
# Operator
# ---------------------------------------------------------------------------

def suffixes(host: Column, longest: int) -> Column:
    """The host and its suffixes after a dot, of at most ``longest`` characters."""
    # only the end of a host can equal a rule's, so a very long host costs no more
    end = F.right(host, F.lit(longest + 1))
    labels = F.split(end, r"\.")
    tails = let(labels, lambda ls: F.transform(
        F.sequence(F.lit(1), F.size(ls)), lambda i: F.array_join(F.slice(ls, i, F.size(ls)), ".")))
    # the first piece is cut unless the end is the whole host
    whole = F.length(host) <= longest + 1
    tails = F.when(whole, tails).otherwise(F.slice(tails, F.lit(2), F.greatest(F.size(tails) - 1, F.lit(0))))
    return F.filter(tails, lambda t: (F.length(t) <= longest) & ((t != "") | (host == "")))


def candidates(pages: DataFrame, longest: int, lengths: list[int]) -> DataFrame:
    """page_id, host, path and one row for each possible rule (r_host, r_path), and
    one with nulls for the page itself."""
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    pairs = F.flatten(F.transform(suffixes(F.col("host"), longest), lambda h: F.transform(
        cuts, lambda n: F.struct(h.alias("h"), F.substring(F.col("path"), 1, n).alias("p")))))
    own = F.array(F.struct(F.lit(None).cast("string").alias("h"), F.lit(None).cast("string").alias("p")))
    return pages.select("page_id", "host", "path", F.explode(F.concat(own, pairs)).alias("c")).select(
        "page_id", "host", "path", F.col("c.h").alias("r_host"), F.col("c.p").alias("r_path"))


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule (null: none), verdict for every row of ``pages``
    (page_id, url) under ``rules`` (host, path, verdict)."""
    listed = canonical_rules(rules)
    size = listed.agg(F.count("*").alias("n"), F.max(F.length("host")).alias("longest"),
                      F.sort_array(F.collect_set(F.length("path"))).alias("lengths")).first()
    split = pages.select(F.col("page_id").cast("long").alias("page_id"), host_path(F.col("url").cast("string")).alias("u")).select(
        "page_id", "u.host", "u.path")
    if size["n"] == 0:
        return split.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    n_blocks = n_blocks_for(size["n"])
    possible = candidates(split, size["longest"], list(size["lengths"]))
    key = rule_key(F.col("r_host"), F.col("r_path"))
    own = F.col("r_host").isNull()
    probed = possible.select("*", key.alias("key")).withColumn("block", block_of(F.col("key"), n_blocks))
    # at most MAX_BLOCKS rows of nine integers
    passed = (probed.join(F.broadcast(bloom_blocks(listed, n_blocks)), "block", "left")
              .where(own | F.coalesce(all_bits(F.col("key")), F.lit(False)))
              .select("page_id", "host", "path", "r_host", "r_path", (F.spark_partition_id() % SALTS).alias("salt")))
    exact = listed.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict",
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    found = passed.join(exact, ["r_host", "r_path", "salt"], "left")
    rule = F.when(F.col("verdict").isNotNull(), F.struct(
        (F.length("r_host") + F.length("r_path")).alias("size"), F.length("r_host").alias("host_size"),
        F.concat("r_host", "r_path").alias("rule"), "verdict"))
    # rows that are equal here have equal verdicts: count them, then give each its row
    return (found.groupBy("page_id", "host", "path").agg(F.count_if(own).alias("n"), F.max(rule).alias("best"))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.verdict"), F.lit("allow")).alias("verdict"),
                    F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")).drop("copy"))


#: The query's list: (host, path, verdict).
QUERY_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
               ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def query_rules(pages: DataFrame) -> DataFrame:
    """``QUERY_RULES`` as a table."""
    return pages.sparkSession.createDataFrame(QUERY_RULES, "host string, path string, verdict string")


URL_FILTER_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h, rest FROM cut),
urls AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path, row_number() OVER () AS id
  FROM split),
rules(r_host, r_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT id, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(verdict, length(r_host || r_path)) AS verdict
  FROM urls, rules
  WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (id)"""
