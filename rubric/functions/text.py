"""Scalar text rules as Spark Column expressions (JVM side, codegen-friendly).

Every function takes and returns ``Column`` objects so callers compose them
inside one ``select``; nothing here leaves the JVM.

Regex notes (Java vs the Python rules being reproduced):
* Python's ``\\w`` is letters, numbers and underscore; Java's ``(?U)\\w`` also
  takes combining marks, so the word class is spelled out as
  ``[\\p{L}\\p{N}_]``.
* Java's plain ``\\s`` is ASCII only; ``(?U)\\s`` is Unicode white space,
  which is what Python's ``str.strip()``/``str.split()`` use.
* Spark's ``trim`` removes spaces only, so "strip" is a regex here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the evaluated system's rules for equal results)
# ---------------------------------------------------------------------------

# Characters that are neither word characters nor white space.
NON_WORD = r"[^\p{L}\p{N}_\s]"

# Punctuation padded with spaces before BLEU / ROUGE tokenisation: every
# Unicode punctuation character except the backslash, plus these extras:
#   ` ÷ × < > ^ ـ ~ ¦ + |
PUNCT_EXTRAS = "`÷×<>^ـ~¦+|"
PUNCT_CLASS = r"[\p{P}" + PUNCT_EXTRAS + r"&&[^\\]]"

# Arabic diacritics removed for BLEU: fathatan, dammatan, kasratan, fatha,
# damma, kasra, shadda, sukun (U+064B .. U+0652).
ARABIC_DIACRITICS = r"[\x{064B}-\x{0652}]"

# Prefix words that announce an answer before a colon ("Answer: B").
ANSWER_PREFIX_WORDS = ["answer", "response", "result", "choice", "option", "الإجابة", "الجواب"]

# File suffixes that mark an input entry as media.
IMAGE_SUFFIXES = ["png", "jpg", "jpeg", "gif", "bmp", "webp"]
AUDIO_SUFFIXES = ["wav", "mp3", "flac", "ogg", "m4a", "aac", "wma"]

# Separators of the simple token counter: white space runs or one of , . ! ? ; : " ( ) [ ] { }
SIMPLE_TOKEN_SPLIT = r'(?U)\s+|[,.!?;:"()\[\]{}]'

# Marker of an API failure message and the JSON object pattern inside it
# (an object with at most one level of nesting).
API_ERROR_MARKER = "API request failed with error message:"
# Possessive and unrolled: the matcher neither recurses nor backtracks.
JSON_OBJECT_PATTERN = r"\{[^{}]*+(?:\{[^{}]*+\}[^{}]*+)*+\}"

# Characters not allowed in generated dataset names.
FORBIDDEN_NAME_CHARS = '<>:/\\|?*'

# ---------------------------------------------------------------------------


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def trim_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode white space."""
    return F.regexp_replace(col_(c), r"(?U)^\s+|\s+$", "")


def ws_tokens(c: Column | str) -> Column:
    """Python ``str.split()``: tokens between white-space runs, never empty."""
    return F.filter(F.split(trim_ws(c), r"(?U)\s+"), lambda x: x != F.lit(""))


def escape_newlines(c: Column | str) -> Column:
    """A real newline becomes the two characters backslash and n."""
    return F.replace(col_(c), F.lit("\n"), F.lit("\\n"))


def escape_newlines_array(c: Column | str) -> Column:
    return F.transform(col_(c), lambda x: F.replace(x, F.lit("\n"), F.lit("\\n")))


def normalize_answer(c: Column | str) -> Column:
    """Strip, punctuation to space, collapse white space, strip, lower.

    Null becomes the empty string.
    """
    t = trim_ws(F.coalesce(col_(c), F.lit("")))
    t = F.regexp_replace(t, "(?U)" + NON_WORD, " ")
    t = F.regexp_replace(t, r"(?U)\s+", " ")
    return F.lower(trim_ws(t))


def first_word_or_line(c: Column | str) -> Column:
    """Answer extraction used by the accuracy metrics.

    strip -> first line -> strip -> drop a trailing run of non-word,
    non-space characters.  "<prefix>: <token>" with an answer-like prefix
    yields the token without non-word characters; a line of at most three
    words is returned as is; otherwise its first word without non-word
    characters.
    """
    text = F.regexp_replace(F.coalesce(col_(c), F.lit("")), r"(?U)^\s+", "")
    line = trim_ws(F.substring_index(text, "\n", 1))
    line = F.regexp_replace(line, "(?U)" + NON_WORD + "+$", "")
    return once(line, _answer_of_line)


def _answer_of_line(line: Column) -> Column:
    colon = r"(?U)^([^:]+):\s*(\S+)"
    prefix = F.lower(trim_ws(F.regexp_extract(line, colon, 1)))
    prefix_hit = F.regexp_like(prefix, F.lit("|".join(ANSWER_PREFIX_WORDS)))
    after_colon = trim_ws(F.regexp_replace(trim_ws(F.regexp_extract(line, colon, 2)), "(?U)" + NON_WORD, ""))
    words = F.filter(F.split(trim_ws(line), r"(?U)\s+", 4), lambda x: x != F.lit(""))  # the fourth is all the rest
    first = lambda words: trim_ws(F.regexp_replace(F.coalesce(F.get(words, 0), line), "(?U)" + NON_WORD, ""))
    by_words = once(words, lambda words: F.when(F.size(words) <= 3, line).otherwise(first(words)))
    return F.when(F.contains(line, F.lit(":")) & F.regexp_like(line, F.lit(colon)) & prefix_hit, after_colon).otherwise(by_words)


def space_punctuation(c: Column | str, change_braces: bool = False,
                      remove_diacritics: bool = False) -> Column:
    """Pad punctuation with spaces; optional ``{}`` -> ``[]`` and Arabic
    diacritic removal.  Null is treated as the empty string."""
    t = F.regexp_replace(F.coalesce(col_(c), F.lit("")), "(" + PUNCT_CLASS + ")", " $1 ")
    if change_braces:
        t = F.translate(t, "{}", "[]")
    if remove_diacritics:
        t = strip_arabic_diacritics(t)
    return t


def strip_arabic_diacritics(c: Column | str) -> Column:
    return F.regexp_replace(col_(c), ARABIC_DIACRITICS, "")


def quoted_text(x: Column) -> Column:
    """A string as it stands in a written-out list: in single quotes, in double quotes
    if it holds only single ones."""
    safe = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    single, double = F.contains(x, F.lit("'")), F.contains(x, F.lit('"'))
    return (F.when(single & ~double, F.concat(F.lit('"'), safe, F.lit('"')))
            .otherwise(F.concat(F.lit("'"), F.replace(safe, F.lit("'"), F.lit("\\'")), F.lit("'"))))


def _value_text(text: Column, kind: Column) -> Column:
    """A JSON value inside a list or object as it is written out: numbers as they stand
    in the source, True, False and None, strings quoted; what is nested stays JSON."""
    return (F.when(kind == "STRING", quoted_text(text)).when(kind == "BOOLEAN", F.initcap(text))
            .when(text.isNull() | (kind == "VOID"), F.lit("None")).otherwise(text))


def value_text(json: Column) -> Column:
    """A JSON value (its text) that is no string, written out: ``1.0``, ``True``,
    ``['a', None]``, ``{'k': 1}``."""
    v = F.try_parse_json(json)
    kind = F.schema_of_variant(v)
    kinds = lambda values: F.transform(values, F.schema_of_variant)
    items = F.zip_with(F.from_json(json, "array<string>"), kinds(F.from_json(json, "array<variant>")), _value_text)
    named = F.zip_with(F.map_entries(F.from_json(json, "map<string,string>")), kinds(F.map_values(F.from_json(json, "map<string,variant>"))),
                       lambda e, k: F.concat(quoted_text(e["key"]), F.lit(": "), _value_text(e["value"], k)))
    return (F.when(kind.startswith("ARRAY"), F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")))
            .when(kind.startswith("OBJECT"), F.concat(F.lit("{"), F.array_join(named, ", "), F.lit("}")))
            .when(kind == "BOOLEAN", F.initcap(json)).otherwise(json))


def extract_asr_text(c: Column | str) -> Column:
    """T5: text of a speech-recognition answer.

    JSON object with "text" -> that value (non-string: written out, see
    ``value_text``, "" when falsy); other object -> first string value in source order; JSON
    string -> the string; otherwise the stripped text without one pair of
    surrounding double or single quotes.
    """
    p = trim_ws(F.coalesce(col_(c), F.lit("")))
    return once(p, lambda p: once(F.try_parse_json(p), lambda v: once(F.schema_of_variant(v), lambda kind: _asr_text(p, v, kind))))


def _asr_text(p: Column, v: Column, kind: Column) -> Column:
    """Text of an answer ``p``, parsed as ``v`` (null: no JSON) of the schema ``kind``."""
    is_obj = kind.startswith("OBJECT")
    text_v = F.variant_get(v, "$.text", "variant")
    text_str = F.variant_get(v, "$.text", "string")
    text_true = value_text(F.get_json_object(p, "$.text"))
    falsy = (F.is_variant_null(text_v) | text_str.isin("false", "", "[]", "{}")
             | (F.schema_of_variant(text_v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)") & (F.try_variant_get(v, "$.text", "double") == 0)))
    entries = F.map_entries(F.from_json(p, "map<string,variant>"))
    first_str = F.get(
        F.filter(entries, lambda e: F.schema_of_variant(e["value"]) == "STRING"), 0
    )["value"]
    inner = F.substring(p, F.lit(2), F.length(p) - 2)
    strip_quotes = (
        F.when(p.startswith('"') & p.endswith('"'), inner)
        .when(p.startswith("'") & p.endswith("'"), inner)
        .otherwise(p)
    )
    return (
        F.when(is_obj & text_v.isNotNull() & (F.schema_of_variant(text_v) == "STRING"), text_str)
        .when(is_obj & text_v.isNotNull(), F.when(falsy, F.lit("")).otherwise(text_true))
        .when(is_obj & first_str.isNotNull(), F.variant_get(first_str, "$", "string"))
        .when(kind == "STRING", F.variant_get(v, "$", "string"))
        .otherwise(strip_quotes)
    )


def option_for_letter(mcq: Column | str, letter: Column) -> Column:
    """Option text for a letter A.. (by position), null when out of range."""
    idx = F.ascii(F.upper(letter)) - 65
    return F.when((F.length(letter) == 1) & (idx >= 0), F.get(col_(mcq), idx))


def normalize_mcq_answer(answer: Column | str, mcq: Column | str) -> Column:
    """Letter or "X)" answer -> option text; otherwise the stripped text.

    Null answer -> ""; no options -> the answer unchanged.
    """
    a = col_(answer)
    opts = col_(mcq)
    s = trim_ws(a)
    single = option_for_letter(opts, s)
    paren_letter = F.regexp_extract(s, r"^([A-Za-z])\)", 1)
    paren = F.when(paren_letter != "", option_for_letter(opts, paren_letter))
    has_opts = opts.isNotNull() & (F.size(opts) > 0)
    return (
        F.when(a.isNull(), F.lit(""))
        .when(~has_opts, a)
        .when((F.length(s) == 1) & single.isNotNull(), single)
        .when(paren.isNotNull(), paren)
        .otherwise(s)
    )


def simple_tokens(c: Column | str) -> Column:
    """Tokens split on white space or , . ! ? ; : " ( ) [ ] { }."""
    return F.filter(F.split(F.coalesce(col_(c), F.lit("")), SIMPLE_TOKEN_SPLIT), lambda x: x != F.lit(""))


def _last_component(c: Column) -> Column:
    return F.substring_index(F.rtrim(c, F.lit("/")), "/", -1)


def _has_suffix(c: Column | str, suffixes: list[str]) -> Column:
    # Path suffix: text after the last dot of the last path component, when
    # that dot is not the component's first character.  Plain string
    # functions (no regex scan over long texts); only the suffix is lowered.
    comp = _last_component(col_(c))
    ext = F.substring_index(comp, ".", -1)
    return (F.length(comp) >= F.length(ext) + 2) & F.lower(ext).isin(*suffixes)


def is_image(c: Column | str) -> Column:
    """The file suffix (lower-cased) is an image suffix; ".png" alone is a
    hidden file without suffix."""
    return _has_suffix(c, IMAGE_SUFFIXES)


def is_audio(c: Column | str) -> Column:
    return _has_suffix(c, AUDIO_SUFFIXES)


def sanitize_text(c: Column | str) -> Column:
    """Strip, lower, space and '-' to '_'."""
    return F.translate(F.lower(trim_ws(col_(c))), " -", "__")


def safe_name(c: Column | str) -> Column:
    """Forbidden file-name characters to '_'."""
    return F.translate(col_(c), FORBIDDEN_NAME_CHARS, "_" * len(FORBIDDEN_NAME_CHARS))


def key_basic(c: Column | str) -> Column:
    """P13 after NFKC: lower, drop NUL, strip, first 255 chars, then ' ./' -> '_'."""
    t = trim_ws(F.replace(F.lower(col_(c)), F.lit("\u0000"), F.lit("")))
    return F.translate(F.substring(t, 1, 255), " ./", "___")


def error_payload(msg: Column | str, exc_type: str = "Exception") -> Column:
    """The JSON error object inside an API failure message when it has an
    "error" key, else a fallback object with message, type, param and code."""
    m = F.coalesce(col_(msg), F.lit(""))
    js = F.regexp_extract(m, JSON_OBJECT_PATTERN, 0)
    v = F.try_parse_json(js)
    has_error = F.variant_get(v, "$.error", "variant").isNotNull()
    fallback = F.to_json(F.struct(F.struct(
        m.alias("message"), F.lit(exc_type).alias("type"), F.lit(None).cast("string").alias("param"),
        F.lit("unknown").alias("code")).alias("error")), {"ignoreNullFields": "false"})
    return F.when(F.contains(m, F.lit(API_ERROR_MARKER)) & has_error, js).otherwise(fallback)


def capitalize(c: Column | str) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    c = col_(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))
