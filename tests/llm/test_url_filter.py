"""URL filter against a plain scan of all rules."""
import random

from rubric.llm import url_filter as uf

SCHEMA = "page_id long, url string, host string, rule string, block string, r_host string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    n = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[n:]
    m = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n]), path[:m]


def judge(url, rules):
    host, path = split(url)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
            if (host == h or (h and host.endswith("." + h))) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def rows(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


URLS = [None, "", "://", "http://", "no scheme", "http://ORG", "http://org/", "HTTP://Example.ORG/es/1", "https://www.example.org/en/12?x=/es/",
        "https://www.example.org/en/21#top", "http://xexample.org/es/", "http://a.com/fr", "http://a.com/fr/x?y", "http://a.com/de/x://y", "http://É.com/de/É",
        "http://a.com?/de/", "http://a.com#/de/", "http://com./de/", "http://.com/de/", "x://" + "a." * 3000 + "com/de/" + "p" * 50_000, "http://com\n/de/",
        "http://user@a.com:80/de/", "http://a.com/de/", "http://a.com/de/", "ftp://a..org//"]


def test_query_equals_plain_scan(spark):
    from rubric.llm.queries import op12_url_filter
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()
    want = sorted(((i, *judge(u, uf.QUERY_RULES)) for i, u in pages), key=repr)
    assert rows(op12_url_filter(spark, "/root/testdata/sf0.01")) == want
    assert {v for *_, v in want} == {"allow", "block"}


def test_odd_urls(spark):
    data = [(i if i % 6 else None, u) for i, u in enumerate(URLS)] + [(22, URLS[22])] * 3 + [(None, None)] * 2
    df = spark.createDataFrame([(*d, "x", "y", "z", "w") for d in data], SCHEMA).repartition(5)
    assert rows(uf.judge_urls(df, uf.query_rules(df))) == sorted(((i, *judge(u, uf.QUERY_RULES)) for i, u in data), key=repr)


def test_many_rules(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("ab", k=rng.randint(1, 3)))
    rules = {(".".join(word() for _ in range(rng.randint(1, 3))), "/" * rng.randint(0, 1) + "".join(rng.choices("ab/", k=rng.randint(0, 5)))): rng.choice(["allow", "block"])
             for _ in range(800)}
    rules[("", "")] = "block"
    rules = [(h, p, v) for (h, p), v in rules.items()]
    pages = [(i, f"http://{'.'.join(word() for _ in range(rng.randint(1, 5)))}/{''.join(rng.choices('ab/', k=rng.randint(0, 8)))}") for i in range(1500)] + [(-1, "none")]
    df = spark.createDataFrame(pages, "page_id long, url string")
    listed = spark.createDataFrame([*rules, (rules[0][0].upper(), rules[0][1], "allow"), (rules[0][0], rules[0][1], "block")], "host string, path string, verdict string")
    rules[0] = (*rules[0][:2], "block")
    assert rows(uf.judge_urls(df, listed)) == sorted(((i, *judge(u, rules)) for i, u in pages), key=repr)


def test_filter_holds_every_rule_and_drops_most_others(spark):
    from pyspark.sql import functions as F
    listed = spark.range(20_000).select(F.concat(F.lit("h"), "id").alias("host"), F.lit("/").alias("path"))
    n = uf.n_blocks_for(20_000)
    blocks = uf.bloom_blocks(listed, n)
    asked = spark.range(40_000).select("id", uf.rule_key(F.concat(F.lit("h"), "id"), F.lit("/")).alias("key")).withColumn("block", uf.block_of(F.col("key"), n))
    hits = asked.join(blocks, "block").where(uf.all_bits(F.col("key")))
    assert hits.where("id < 20000").count() == 20_000
    assert hits.where("id >= 20000").count() < 400
    assert blocks.count() <= n <= uf.MAX_BLOCKS


def test_no_rows_no_rules(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert uf.judge_urls(empty, uf.query_rules(empty)).collect() == []
    df = spark.createDataFrame([(1, "http://a.com/de/")], "page_id long, url string")
    assert rows(uf.judge_urls(df, uf.query_rules(df).limit(0))) == [(1, "a.com", "/de/", None, "allow")]
