"""Chat formatting: messages rebuilt from a log of chat events, rendered with a template and a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.llm.common import read, text_or_empty

#: The template: a turn is OPEN role NEWLINE text CLOSE.
OPEN, CLOSE = "<|turn|>", "<|end|>"
#: Control strings of this and other templates, as what follows their first character. One more backslash after that
#: character escapes one.
CONTROL = r"([<\[])(\\*)(\||s>|/s>|INST\]|/INST\])"
ESCAPED = r"([<\[])\\(\\*)(\||s>|/s>|INST\]|/INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def rebuild(events: DataFrame) -> DataFrame:
    """Messages (conv_id, place, role, text) from events (conv_id, seq, kind, target, role, text).

    By conversation and seq: `message` starts a message with its role and text; `delta` adds its text to a message;
    `edit` replaces a message's text; `regenerate` does so too and drops the messages started since that one. The last
    three name their message by the seq of its start in target, or mean the latest one started; where there is none,
    they are ignored, as are other kinds. Null texts and roles are empty; a null conv_id is a conversation of its own
    and a null seq comes first. Events of one seq go in the order of kind, role and text; a repeated `message` row is
    a message of its own, and a target means the first of its seq. An empty log gives no messages. Other columns are
    not carried.
    """
    # A null id is told apart from every id by a flag, so that joins and windows need no null-safe comparison.
    log = events.select(
        F.col("conv_id").isNull().alias("_none"), F.coalesce(F.col("conv_id"), F.lit(0)).cast("long").alias("_conv"), "seq", "kind", "target",
        text_or_empty("role").alias("role"), text_or_empty("text").alias("text"),
    )
    whole = Window.partitionBy("_none", "_conv").orderBy(F.col("seq").asc_nulls_first(), F.col("kind").desc(), "role", "text")
    starts = F.col("kind") == "message"
    log = log.withColumn("_at", F.row_number().over(whole)).withColumn("_latest", F.max(F.when(starts, F.col("_at"))).over(whole))
    first = log.where(starts & F.col("seq").isNotNull()).groupBy(F.col("_none").alias("_n"), F.col("_conv").alias("_c"), F.col("seq").alias("_seq")).agg(F.min("_at").alias("_named"))
    named = log.where(~starts & F.col("target").isNotNull()).join(first, (F.col("_none") == F.col("_n")) & (F.col("_conv") == F.col("_c")) & (F.col("target") == F.col("_seq")))
    named = named.where("_named < _at").withColumn("_of", F.col("_named")).drop("_n", "_c", "_seq", "_named")
    known = log.where(starts | F.col("target").isNull()).withColumn("_of", F.when(starts, F.col("_at")).otherwise(F.col("_latest"))).unionByName(named)
    known = known.where(F.col("_of").isNotNull() & F.col("kind").isin("message", "delta", "edit", "regenerate"))
    later = Window.partitionBy("_none", "_conv").orderBy("_at").rowsBetween(1, Window.unboundedFollowing)
    known = known.withColumn("_back_to", F.min(F.when(F.col("kind") == "regenerate", F.col("_of"))).over(later))
    folded = known.groupBy("_none", "_conv", F.col("_of").alias("place")).agg(
        F.max(F.when(F.col("kind") != "delta", F.col("_at"))).alias("_reset"),
        F.min_by("role", "_at").alias("role"),
        F.min_by("_back_to", "_at").alias("_back_to"),
        F.sort_array(F.collect_list(F.struct("_at", "text"))).alias("_texts"),
    )
    text = F.array_join(F.transform(F.filter("_texts", lambda x: x["_at"] >= F.col("_reset")), lambda x: x["text"]), "")
    stays = F.col("_back_to").isNull() | (F.col("_back_to") >= F.col("place"))
    return folded.where(stays).select(F.when(~F.col("_none"), F.col("_conv")).alias("conv_id"), "place", "role", text.alias("text"))


def render(messages: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans): a row for each conversation, its turns in the order of place.

    loss_spans are the [start, length) in code points of the texts of learned_role, one for each, empty ones too.
    Ties in place go by role and text. A conversation without messages has no row.
    """
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    turn = Window.partitionBy("conv_id").orderBy("place", "role", "text")
    rows = (
        messages.withColumn("_text", escape(F.col("text")))
        .withColumn("_head", head)
        .withColumn("_length", F.char_length("_head") + F.char_length("_text") + len(CLOSE))
        .withColumn("_turn", F.row_number().over(turn))
        .withColumn("_start", F.sum("_length").over(turn.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_length"))
        .withColumn("_loss", F.when(F.col("role") == learned_role, F.struct((F.col("_start") + F.char_length("_head")).cast("int").alias("start"), F.char_length("_text").alias("length"))))
    )
    one = F.sort_array(F.collect_list(F.struct("_turn", F.concat("_head", "_text", F.lit(CLOSE)).alias("said"), "_loss")))
    return rows.groupBy("conv_id").agg(one.alias("_turns")).select(
        "conv_id",
        F.array_join(F.transform("_turns", lambda x: x["said"]), "").alias("formatted"),
        F.filter(F.transform("_turns", lambda x: x["_loss"]), lambda x: x.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as array<struct<role, text>>."""
    turns = F.filter(F.split(formatted, r"<\|turn\|>"), lambda x: x != "")
    body = lambda x: F.substring(x, F.instr(x, "\n") + 1, F.char_length(x) - F.instr(x, "\n") - len(CLOSE))
    return F.transform(turns, lambda x: F.struct(unescape_role(F.substring_index(x, "\n", 1)).alias("role"), unescape(body(x)).alias("text")))


def streamed(said: DataFrame) -> DataFrame:
    """Chat events, as rebuild reads them, whose messages are the rows (conv_id, turn, role, text) in the order of turn, role and text.

    Each row is a message with the first half of its text and a delta with the rest. After that, by its place: nothing
    more, or an edit from a draft to the whole text, or a regeneration with the first half and a delta with the rest.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = said.withColumn("_k", F.row_number().over(order)).withColumn("_half", F.floor(F.char_length("text") / 2).cast("int"))
    first, rest = F.substring("text", F.lit(1), F.col("_half")), F.substr("text", F.col("_half") + 1)
    seq = F.col("_k").cast("long") * 4
    kind = F.col("_k") % 3

    def event(step: int, name: str, text: Column) -> Column:
        target = F.lit(None) if name == "message" else seq
        return F.struct((seq + step).alias("seq"), F.lit(name).alias("kind"), target.cast("long").alias("target"), F.when(F.lit(name == "message"), F.col("role")).alias("role"), text.alias("text"))

    more = [F.when(kind == 1, event(2, "edit", F.col("text"))), F.when(kind == 2, event(2, "regenerate", first)), F.when(kind == 2, event(3, "delta", rest))]
    return rows.select("conv_id", F.inline(F.array_compact(F.array(event(0, "message", first), event(1, "delta", F.when(kind == 1, F.lit(" draft")).otherwise(rest)), *more))))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), control.alias("text"))
    events = streamed(said.unionByName(extra))
    done = render(rebuild(events))
    turns = F.transform(read_back(F.col("formatted")), lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    loss = F.array_join(F.transform("loss_spans", lambda x: unescape(F.substring(F.col("formatted"), x["start"] + 1, x["length"]))), "")
    read_in = done.select("conv_id", "formatted", turns.alias("_turns"), loss.alias("_loss"))
    return read_in.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("_turns", ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), long AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(\||s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g'))
          + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '([<\[])(\\*)(\||s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g'))
          + length('<|turn|><|end|>') + 1 AS chars
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM long GROUP BY conv_id
"""
