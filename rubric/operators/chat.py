"""Chat messages: cleaning (T8), prompt rendering (T7), token counts.

Rendering is narrow: every message becomes one *segment* keyed by (conversation,
turn), carrying the separator that follows it; the prompt of a conversation is the
concatenation of its segments in turn order, with the generation cue (titled style)
or without the last separator (plain style).  No conversation is ever gathered into
one row or one task, so a very long one costs no more than its own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubric.functions.text import capitalize, col_, simple_tokens

CUE = "Assistant:"


def clean_content(content: Column | str) -> Column:
    """A JSON list of content blocks -> their texts joined by a space
    (dict blocks: type "text" or any "text" key; plain strings kept); a JSON
    object -> its text form; anything else -> the string as is."""
    c = F.coalesce(col_(content), F.lit(""))
    v = F.try_parse_json(c)
    kind = F.schema_of_variant(v)
    blocks = F.from_json(c, "array<variant>")

    def block_text(b: Column) -> Column:
        k = F.schema_of_variant(b)
        return F.when(k == "STRING", F.variant_get(b, "$", "string")) \
            .when(k.startswith("OBJECT") & (F.variant_get(b, "$.text", "variant").isNotNull()
                                            | F.coalesce(F.try_variant_get(b, "$.type", "string") == "text", F.lit(False))),
                  F.coalesce(F.try_variant_get(b, "$.text", "string"), F.lit("")))

    texts = F.filter(F.transform(blocks, block_text), lambda t: t.isNotNull())
    return F.when(kind.startswith("ARRAY"), F.array_join(texts, " ")).otherwise(c)


def clean_messages(messages: DataFrame, role: str = "role", content: str = "content") -> DataFrame:
    """T8 on a message table: role defaults to "user", content to text."""
    return messages.withColumn(role, F.coalesce(F.col(role), F.lit("user"))) \
                   .withColumn(content, clean_content(F.col(content)))


def render_segments(messages: DataFrame, keys: list[str], order: str = "turn", role: str = "role",
                    content: str = "content", style: str = "titled") -> DataFrame:
    """T7 as segments, without a shuffle.

    ``titled``: "Role: content" (role capitalised) and a blank line after each; the
    prompt is the segments and the "Assistant:" cue.  ``plain``: "role: content" and
    one newline after each; the prompt is the segments up to the last newline.
    """
    r = F.coalesce(F.col(role), F.lit("user"))
    label = capitalize(r) if style == "titled" else r
    separator = "\n\n" if style == "titled" else "\n"
    return messages.select(*keys, order, F.concat(label, F.lit(": "), F.coalesce(F.col(content), F.lit("")), F.lit(separator)).alias("segment"))


def prompt_lengths(segments: DataFrame, keys: list[str], style: str = "titled", order: str = "turn") -> DataFrame:
    """Length of each rendered prompt, its message count and a digest of its segments
    at their places: the sum of the first 32 bits of each (place, segment)'s MD5, so
    that partial sums combine before the shuffle and any change or swap shows."""
    end = len(CUE) if style == "titled" else -1
    place = F.concat(F.coalesce(F.col(order).cast("string"), F.lit("")), F.lit(":"), F.col("segment"))
    return segments.groupBy(*keys).agg(
        F.count("*").alias("n_messages"),
        (F.sum(F.length("segment")) + F.lit(end)).alias("prompt_chars"),
        F.sum(F.conv(F.substring(F.md5(place), 1, 8), 16, 10).cast("long")).alias("prompt_digest"))


def token_counts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """T9 + A8: simple token counts summed per key."""
    return df.groupBy(*keys).agg(F.sum(F.size(simple_tokens(F.col(text)))).alias("tokens"),
                                 F.count("*").alias("n_texts"))
