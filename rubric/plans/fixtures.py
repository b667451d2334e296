"""Evaluation inputs derived from the shared parquet tables.

Each view is a deterministic DataFrame expression over the given tables, so
its work grows with them:

* ``conversation_items`` / ``conversation_pairs`` (F-A): a user turn is the
  question, the next turn (when by the assistant) the gold answer; three
  synthetic models answer by dropping every (3+k)-th word.
* ``passage_pairs`` (F-B): benchmark passages found verbatim in documents.
* ``judge_attempts`` (F-C): raw judge replies (up to three attempts) built
  from ``labels``.
* ``mcq_samples`` (F-D): region multiple choice over customers.
* ``job_events`` (F-E): job status log from ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rubric.functions.text import escape_newlines
from rubric.operators.prepare import join_model_responses
from rubric.session import spread

MODELS = ["m0", "m1", "m2"]

_VIEWS: dict = {}


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session (a restarted session gets a new app id)."""
    try:
        return id(spark), spark.sparkContext.applicationId
    except Exception:  # sessions without a SparkContext handle
        return (id(spark),)


def memo_view(fn):
    """Build a derived view once per (session, folder, args): DataFrames are
    immutable plans, so queries share the analysed plan instead of rebuilding
    it (every expression node is a JVM round trip)."""
    def wrapper(spark, sf_dir, *args, **kwargs):
        key = (fn.__name__, session_key(spark), sf_dir, args, tuple(sorted(kwargs.items())))
        if key not in _VIEWS:
            _VIEWS[key] = fn(spark, sf_dir, *args, **kwargs)
        return _VIEWS[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A shared table (file listing and schema resolved once per session)."""
    key = (session_key(spark), sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    df = _TABLES[key]
    return df.select(*cols) if cols else df


# ---------------------------------------------------------------------------
# F-A conversation samples
# ---------------------------------------------------------------------------

@memo_view
def conversation_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per (user turn, next assistant turn).

    "Next turn" is ``turn + 1`` (turns are contiguous per conversation), an
    equi-join on (conv_id, turn): a very long conversation is spread over
    many tasks instead of one window partition.
    """
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    q = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return q.join(a, ["conv_id", "turn"]).select(
        "conv_id", "turn", "question",
        escape_newlines("answer").alias("gold"),
        F.col("answer").alias("answer_raw"),
        F.concat(F.lit("t"), (F.col("conv_id") % 8).cast("string")).alias("task"),
        F.concat(F.lit("c"), (F.col("conv_id") % 4).cast("string")).alias("category"),
    )


def degraded_response(text: F.Column, k: F.Column) -> F.Column:
    """Synthetic model k: drop the words whose 0-based index i has i % (3+k) = 2."""
    return F.array_join(F.filter(F.split(text, " "), lambda w, i: i % (k + 3) != 2), " ")


@memo_view
def conversation_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response table (model, conv_id, turn, response) of the synthetic models."""
    items = conversation_items(spark, sf_dir)
    k = F.explode(F.sequence(F.lit(0), F.lit(len(MODELS) - 1))).alias("k")
    return items.select("conv_id", "turn", "answer_raw", k).select(
        F.concat(F.lit("m"), F.col("k").cast("string")).alias("model"),
        "conv_id", "turn",
        degraded_response(F.col("answer_raw"), F.col("k")).alias("response"),
    )


@memo_view
def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples: items x evaluated models with their responses (J1); a missing
    response scores as the empty string.  Items and responses meet on the item's own
    key, on which both are partitioned already, before rows become rows a model."""
    items = conversation_items(spark, sf_dir).drop("answer_raw")
    return join_model_responses(items, conversation_responses(spark, sf_dir), ["conv_id", "turn"], MODELS)


# ---------------------------------------------------------------------------
# F-B passages found in documents
# ---------------------------------------------------------------------------

# Anchors.  A word strictly inside a passage (between its first and last white space)
# is a whole word of every document that contains the passage.  Of a passage's inner
# words the one in the fewest documents is its anchor, so candidates are the documents
# with that word.  A passage of two tokens lies across a word's end or start, one of a
# single token within a word: documents offer those pieces of their words, but only in
# lengths that such passages have, so without them nothing is added.
WORD, END, START, PART = "w", "e", "s", "p"
PARTS = 32  # of the documents with one piece, a power of two


def _words(text: F.Column) -> F.Column:
    return F.split(text, r"(?U)\s+")


def _passage_pieces(passages: DataFrame) -> DataFrame:
    """(item_id, kind, piece): what every document with the passage offers."""
    tok, n = F.col("tok"), F.size("tok")
    piece = lambda kind, x: F.struct(F.lit(kind).alias("kind"), x.alias("piece"))
    first, second = F.get(tok, 0), F.get(tok, 1)
    pieces = (F.when(n >= 3, F.transform(F.array_distinct(F.slice(tok, F.lit(2), F.greatest(n - 2, F.lit(0)))), lambda w: piece(WORD, w)))
              .when((n == 2) & (first != ""), F.array(piece(END, first)))
              .when(n == 2, F.array(piece(START, second)))
              .otherwise(F.array(piece(PART, first))))
    return passages.select("item_id", _words(F.col("text")).alias("tok")).select("item_id", F.explode(pieces).alias("x")).select(
        "item_id", "x.kind", "x.piece")


def _piece_name(kind: str, piece: F.Column) -> F.Column:
    """What pieces meet by; a space, which no word has, sets cut pieces apart from words."""
    return piece if kind == WORD else F.concat(F.lit(kind + " "), piece)


def _piece_key(name: F.Column) -> F.Column:
    """Pieces meet by hash; ``contains`` judges every candidate."""
    return F.xxhash64(name)


def _document_keys(docs: DataFrame, lengths: F.Column) -> DataFrame:
    """(doc_id, key) of each distinct piece that a document offers; ``lengths`` holds
    those of the cut pieces."""
    def cuts(kind: str, places):  # length by length, so that no word is walked for a kind without lengths
        return F.flatten(F.transform(F.col("lengths")[kind], lambda k: F.flatten(F.transform(
            F.filter("words", lambda w: F.length(w) >= k),
            lambda w: F.transform(places(w, k), lambda at: _piece_name(kind, F.substring(w, at, k)))))))

    offered = F.array_distinct(F.concat(
        "words", cuts(END, lambda w, k: F.array(F.length(w) - k + 1)), cuts(START, lambda w, k: F.array(F.lit(1))),
        cuts(PART, lambda w, k: F.sequence(F.lit(1), F.length(w) - k + 1))))
    # explode_outer: of explode, Spark takes a filter that computes the array a second time
    return (spread(docs.select("doc_id", "text")).select("doc_id", _words(F.col("text")).alias("words"), lengths.alias("lengths"))
            .select("doc_id", offered.alias("pieces")).select("doc_id", F.explode_outer("pieces").alias("piece"))
            .select("doc_id", _piece_key(F.col("piece")).alias("key")))


@memo_view
def passage_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-B over the shared tables (see ``contained_passages``)."""
    bench = table(spark, sf_dir, "benchmark", "item_id", "text")
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return contained_passages(bench, docs)


def contained_passages(bench: DataFrame, docs: DataFrame) -> DataFrame:
    """(item_id, doc_id, source, lang, passage, document) where the document
    contains the passage verbatim.

    Pieces that no passage has go first (a semi join).  The rest is shuffled once, by
    piece and part of the documents: how many documents have each is counted there, and
    the documents with a passage's anchor, its candidates, are found there.  Both read
    one shuffle, so the texts are split once, as long as both take the same columns."""
    pieces = _passage_pieces(bench)
    of = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.length("piece"))).alias(kind)
    lengths = pieces.agg(F.struct(of(END), of(START), of(PART)).alias("l")).scalar()
    name = F.when(F.col("kind") == WORD, F.col("piece")).otherwise(F.concat_ws(" ", "kind", "piece"))
    asked = pieces.select("item_id", _piece_key(name).alias("key"))
    named = docs.where(F.col("doc_id").isNotNull())  # as the last join takes them, so that both readers take the same
    offered = _document_keys(named, lengths).join(asked.select("key").distinct(), "key", "left_semi")
    offered = offered.select("doc_id", "key", F.xxhash64("doc_id").bitwiseAND(PARTS - 1).alias("part")).repartition("key", "part")
    counts = offered.groupBy("key", "part").agg(F.count("doc_id").alias("n")).groupBy("key").agg(F.sum("n").alias("n"))
    anchors = asked.join(counts, "key").groupBy("item_id").agg(F.min(F.struct("n", "key"))["key"].alias("key"))
    anchors = anchors.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    candidates = offered.join(anchors, ["key", "part"]).select("item_id", "doc_id")
    found = candidates.join(bench.select("item_id", F.col("text").alias("passage")), "item_id").join(docs, "doc_id")
    return found.filter(F.contains(F.col("text"), F.col("passage"))).select(
        "item_id", "doc_id", "source", "lang", "passage", F.col("text").alias("document"))


# ---------------------------------------------------------------------------
# F-C judge replies
# ---------------------------------------------------------------------------

@memo_view
def judge_attempts(spark: SparkSession, sf_dir: str, mcq: bool = False) -> DataFrame:
    """Raw judge replies per (judge, sample, attempt).

    Judge ``j1``: score quality + 2*toxic (generative) or quality (MCQ);
    attempt 1 is broken when doc_id % 5 = 0, attempt 2 is fenced JSON unless
    doc_id % 10 = 0, attempt 3 likewise, so doc_id % 10 = 0 never parses.
    Judge ``j2``: score 3*quality (generative) or 1 - toxic (MCQ); replies on
    the first attempt except when doc_id % 3 = 0, never when doc_id % 7 = 0.
    """
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    docs = table(spark, sf_dir, "documents", "doc_id", "source")
    s = labels.join(docs, "doc_id")
    d = F.col("doc_id")
    score1 = F.col("quality") if mcq else F.col("quality") + 2 * F.col("toxic")
    score2 = (1 - F.col("toxic")) if mcq else 3 * F.col("quality")

    def verdict(score: F.Column, who: str) -> F.Column:
        return F.concat(F.lit('{"score": '), score.cast("string"),
                        F.lit(f', "explanation": "{who} graded document '), d.cast("string"), F.lit('"}'))

    def fenced(text: F.Column) -> F.Column:
        return F.concat(F.lit("```json\n"), text, F.lit("\n```"))

    broken = F.concat(F.lit('{"score": '), F.lit('"unfinished'))
    j1 = F.array(
        F.when(d % 5 == 0, broken).otherwise(verdict(score1, "j1")),
        F.when(d % 10 != 0, fenced(verdict(score1, "j1"))).otherwise(F.lit("I cannot grade this.")),
        F.when(d % 10 != 0, fenced(verdict(score1, "j1"))).otherwise(broken),
    )
    j2 = F.array(
        F.when((d % 3 != 0) & (d % 7 != 0), verdict(score2, "j2")).otherwise(F.lit("")),
        F.when(d % 7 != 0, verdict(score2, "j2")).otherwise(F.lit("no json here")),
        F.when(d % 7 != 0, verdict(score2, "j2")).otherwise(broken),
    )
    replies = F.array(F.struct(F.lit("j1").alias("judge"), j1.alias("raw")),
                      F.struct(F.lit("j2").alias("judge"), j2.alias("raw")))
    return (s.select("doc_id", "source", F.explode(replies).alias("j"))
            .select("doc_id", "source", "j.judge", F.posexplode("j.raw").alias("pos", "raw"))
            .select(F.col("doc_id").alias("sample_id"), F.col("source").alias("task"), "judge",
                    (F.col("pos") + 1).alias("attempt"), "raw"))


@memo_view
def conversation_judge_attempts(spark: SparkSession, sf_dir: str, mcq: bool = False) -> DataFrame:
    """Raw replies of one judge to the conversation samples, keyed to them.

    With h = conv_id + turn + k of model k, the score is h % 5 (generative) or
    h % 3 - 1 (MCQ, so it leaves [0, 1]); attempt 1 is broken when h % 5 = 0,
    and no attempt parses when h % 10 = 0.
    """
    s = conversation_pairs(spark, sf_dir).select("model", "task", "conv_id", "turn")
    h = F.col("conv_id") + F.col("turn") + F.expr("substring(model, 2)").cast("int")
    score = h % 3 - 1 if mcq else h % 5
    good = F.concat(F.lit('{"score": '), score.cast("string"), F.lit(', "explanation": "graded"}'))
    broken = F.lit('{"score": "unfinished')
    tries = F.array(F.when(h % 5 == 0, broken).otherwise(good), F.when(h % 10 != 0, good).otherwise(broken))
    return s.select(
        F.concat_ws("|", "model", "task").alias("task"), F.concat_ws("-", "conv_id", "turn").alias("sample_id"),
        F.lit("j1").alias("judge"), F.posexplode(tries).alias("pos", "raw")).select(
        "task", "sample_id", "judge", (F.col("pos") + 1).alias("attempt"), "raw")


@memo_view
def conversation_judge_samples(spark: SparkSession, sf_dir: str, mcq: bool = False) -> DataFrame:
    """F-A samples as the judge pipeline takes them: model, task, conv_id, turn,
    question, gold, response as a list (empty when (conv_id + turn) % 11 = 0), mcq.

    The multiple-choice form has the gold's first four words as options, the letter
    (conv_id + turn) % 4 as gold, and answers as a lower-case letter (m0), ``X) ``
    and more (m1, the next letter) or the first option's text (m2)."""
    s = conversation_pairs(spark, sf_dir)
    place = F.col("conv_id") + F.col("turn")
    if mcq:
        options = F.slice(F.split("gold", " "), 1, 4)
        letter = F.chr(place % 4 + 65)
        answer = (F.when(F.col("model") == "m0", F.lower(letter))
                  .when(F.col("model") == "m1", F.concat(F.chr((place + 1) % 4 + 65), F.lit(") so it is")))
                  .otherwise(F.get(F.split("gold", " "), 0)))
        s = s.select("model", "task", "conv_id", "turn", "question", letter.alias("gold"), answer.alias("response"), options.alias("mcq"))
    else:
        s = s.select("model", "task", "conv_id", "turn", "question", "gold", "response", F.lit(None).cast("array<string>").alias("mcq"))
    none = F.array().cast("array<string>")
    return s.withColumn("response", F.when(place % 11 == 0, none).otherwise(F.array("response")))


@memo_view
def block_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with block content by turn % 4: a text block and a plain string (0), media
    alone and a text block without text (1), a plain string, media and a text block (2),
    the text itself (3); no role when turn % 5 = 0."""
    m = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    text = F.to_json(F.struct(F.lit("text").alias("type"), "text"))
    image = F.lit('{"type": "image_url", "image_url": {"url": "a.png"}}')
    listed = lambda *parts: F.concat(F.lit("["), F.concat_ws(", ", *parts), F.lit("]"))
    kind = F.col("turn") % 4
    content = (F.when(kind == 0, listed(text, F.lit('"and more"'))).when(kind == 1, listed(image, F.lit('{"type": "text"}')))
               .when(kind == 2, listed(F.lit('"first"'), image, text)).otherwise(F.col("text")))
    return m.select("conv_id", "turn", F.when(F.col("turn") % 5 != 0, F.col("role")).alias("role"), content.alias("content"))


@memo_view
def asr_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speech-recognition answers of m0's items in eight forms by (conv_id + turn) % 8:
    object with text (0), object whose first string counts (1), JSON string (2), text
    in double quotes (3), a list (4) or number (5) or false (6) as text, text in single
    quotes (7)."""
    s = conversation_items(spark, sf_dir)
    place, text, n = F.col("conv_id") + F.col("turn"), F.col("answer_raw"), F.col("conv_id").cast("string")
    as_string = F.expr("substring(to_json(array(answer_raw)), 2, length(to_json(array(answer_raw))) - 2)")
    forms = [F.concat(F.lit('{"text": '), as_string, F.lit("}")), F.concat(F.lit('{"n": 1, "said": '), as_string, F.lit(', "a": "x"}')), as_string,
             F.concat(F.lit('"'), text, F.lit('"')), F.concat(F.lit('{"text": ['), n, F.lit('.0, "it\'s", true, null]}')),
             F.concat(F.lit('{"text": '), n, F.lit(".50}")), F.lit('{"text": false}'), F.concat(F.lit(" '"), text, F.lit("'\n"))]
    form = F.when(F.lit(False), F.lit(""))
    for k, value in enumerate(forms):
        form = form.when(place % 8 == k, value)
    return s.select("conv_id", "turn", form.alias("answer"))


@memo_view
def conversation_tasks(spark: SparkSession, sf_dir: str, mcq: bool = False) -> DataFrame:
    """Allow-list of tasks: t0..t5 are judged as generation, t4..t7 as multiple choice."""
    number = F.substring("task", 2, 1).cast("int")
    return conversation_items(spark, sf_dir).select("task").distinct().where(number >= 4 if mcq else number <= 5)


def prompt_replies(prompts: DataFrame, mcq: bool = False) -> DataFrame:
    """Raw replies (prompt_key, judge, attempt, raw) of one judge to prompts.

    With h the first four hexadecimal digits of the prompt's key, the score is h % 5
    (generative) or h % 4 - 1 (multiple choice), so it leaves [0, 1]; by (h div 5) % 9
    it is a numeric string (0), a word (1) or null (2).  Attempt 1 is broken when
    h % 5 = 0, and no attempt parses when h % 10 = 0."""
    h = F.conv(F.substring("prompt_key", 1, 4), 16, 10).cast("int")
    value = (h % 4 - 1 if mcq else h % 5).cast("string")
    form = F.floor(h / 5) % 9
    score = (F.when(form == 0, F.concat(F.lit('"'), value, F.lit('"'))).when(form == 1, F.lit('"high"'))
             .when(form == 2, F.lit("null")).otherwise(value))
    good = F.concat(F.lit('{"score": '), score, F.lit(', "explanation": "graded"}'))
    broken = F.lit('{"score": "unfinished')
    fenced = F.concat(F.lit("```json\n"), good, F.lit("\n```"))
    tries = F.array(F.when(h % 5 == 0, broken).otherwise(good), F.when(h % 10 != 0, fenced).otherwise(broken))
    return prompts.select("prompt_key", F.lit("j1").alias("judge"), F.posexplode(tries).alias("pos", "raw")).select(
        "prompt_key", "judge", (F.col("pos") + 1).alias("attempt"), "raw")


@memo_view
def conversation_test_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of m0 as VARIANT test cases in three shapes, by (conv_id + turn) % 3:
    judge record, evaluation record with a list context, record nested under
    ``test_case``; every fifth has no given answer."""
    s = conversation_pairs(spark, sf_dir).where(F.col("model") == "m0")
    place = F.col("conv_id") + F.col("turn")
    key = F.concat_ws("-", "conv_id", "turn")
    answer = F.when(place % 5 != 0, F.col("response"))
    record = F.to_json(F.struct(key.alias("id"), "question", F.col("gold").alias("reference_answer"), answer.alias("given_answer"),
                                F.col("task").alias("context"), F.struct("category").alias("metadata")))
    evaluation = F.to_json(F.struct(key.alias("id"), F.col("question").alias("input"), F.col("gold").alias("expected_output"),
                                    answer.alias("actual_output"), F.array("category", "task").alias("context")))
    nested = F.concat(F.lit('{"test_case": '), F.when(place % 2 == 0, record).otherwise(evaluation), F.lit("}"))
    case = F.when(place % 3 == 0, record).when(place % 3 == 1, evaluation).otherwise(nested)
    return s.select((place % 3).cast("int").alias("shape"), F.parse_json(case).alias("case"))


# ---------------------------------------------------------------------------
# F-D multiple choice over regions
# ---------------------------------------------------------------------------

@memo_view
def mcq_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers answer "which region is the nation of this customer in".

    Options are the region names ordered by key (letters A..).  The region
    table is a fixed-size dimension (five rows by definition), so the window
    without partition that lists all options runs on five rows.
    """
    region = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    w_all = Window.orderBy("r_regionkey").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w_ord = Window.orderBy("r_regionkey")
    reg = region.select(
        "r_regionkey", "r_name",
        F.collect_list("r_name").over(w_all).alias("mcq"),
        F.chr(F.row_number().over(w_ord) + 64).alias("gold_letter"),
    )
    nat = nation.join(reg, nation["n_regionkey"] == reg["r_regionkey"]).select(
        "n_nationkey", "n_name", "mcq", "gold_letter", "r_name")
    s = cust.join(nat, cust["c_nationkey"] == nat["n_nationkey"])
    k = F.col("c_custkey") % 6
    wrong = F.get(F.col("mcq"), (F.ascii("gold_letter") - 65 + 1) % F.size("mcq"))
    response = (
        F.when(k == 0, F.col("gold_letter"))
        .when(k == 1, F.lower("gold_letter"))
        .when(k == 2, F.concat(F.col("gold_letter"), F.lit(") "), F.col("r_name")))
        .when(k == 3, F.concat(F.lit("Answer: "), F.col("r_name")))
        .when(k == 4, F.col("r_name"))
        .otherwise(wrong)
    )
    return s.select(
        F.col("c_custkey").alias("sample_id"),
        F.concat(F.lit("In which region is "), F.col("n_name"), F.lit("?")).alias("question"),
        "mcq",
        F.col("gold_letter").alias("gold"),
        response.alias("response"),
        F.concat(F.lit("region_"), (F.col("n_nationkey") % 3).cast("string")).alias("task"),
    )


# ---------------------------------------------------------------------------
# F-E job status log
# ---------------------------------------------------------------------------

@memo_view
def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    status = (F.when(F.col("event_type") == "signup", "starting")
              .when(F.col("event_type").isin("view", "click"), "running")
              .when(F.col("event_type") == "purchase", "completed")
              .when(F.col("event_type") == "error", "failed"))
    error = F.when(F.col("event_type") == "error",
                   F.concat(F.lit('API request failed with error message: {"error": '), F.col("props"), F.lit("}")))
    return ev.select(F.col("user_id").alias("job_id"), "ts", "event_id", status.alias("status"),
                     error.alias("error"))


@memo_view
def response_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation attempts (model, conv_id, turn, attempt, response): with
    h = conv_id + turn + k, attempt 1 is empty when h % 4 = 0, attempt 2 is
    blank when h % 8 = 0, attempt 3 is empty when h % 16 = 0."""
    r = conversation_responses(spark, sf_dir)
    h = F.col("conv_id") + F.col("turn") + F.expr("substring(model, 2)").cast("int")
    tries = F.array(
        F.when(h % 4 == 0, F.lit("")).otherwise(F.col("response")),
        F.when(h % 8 == 0, F.lit("   ")).otherwise(F.col("response")),
        F.when(h % 16 == 0, F.lit("")).otherwise(F.col("response")),
    )
    return r.select("model", "conv_id", "turn", F.posexplode(tries).alias("pos", "text")).select(
        "model", "conv_id", "turn", (F.col("pos") + 1).alias("attempt"), F.col("text").alias("response"))
