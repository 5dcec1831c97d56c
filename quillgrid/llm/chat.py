"""Chat formatting by event-sourced reconstruction: logs are folded into messages, messages rendered into one string.

DataFrame functions only. One shuffle, by conversation. A conversation's rendered string is one value of the result, so
its messages meet in one task by the result's nature; nothing larger does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import let, table

#: Kinds of event. message, edit and regenerate set a message's text; delta adds to it; start opens it; delete removes it.
RESETS, KINDS = ("message", "edit", "regenerate"), ("start", "delta", "delete", "message", "edit", "regenerate")
OPEN, HEAD_END, CLOSE = "<turn ", ">\n", "</turn>\n"
#: Escapes: afterwards a text has none of the characters that control strings begin or end with.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), (">", "\\g"))
LEARNED = "assistant"


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def reconstruct(events: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the messages that a log of events leaves.

    events has conv_id, seq (of any type with an order), kind, message_id, role, text; further columns are ignored. Events of a conversation are taken by seq (null first), ties by
    kind, role, text. Rows without message_id are each a message of its own; other rows of one message_id are folded: the
    text is that of the last message, edit or regenerate event with all later deltas; a delete after that removes the
    message until a later reset. Null kind counts as message, unknown kinds are left out, null text is empty, null role
    is empty. A null conv_id is a conversation too. Repeated rows are repeated events.
    """
    kind = F.coalesce("kind", F.lit("message"))
    rows = events.select("conv_id", "seq", kind.alias("kind"), F.col("message_id").cast("string").alias("message_id"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).filter(F.col("kind").isin(*KINDS))
    order = Window.partitionBy("conv_id").orderBy("seq", "kind", "role", "text", "message_id")
    rows = rows.withColumn("n", F.row_number().over(order)).withColumn("own", F.when(F.col("message_id").isNull(), F.col("n")))
    logs = rows.groupBy("conv_id", "message_id", "own").agg(F.min("n").alias("position"), F.array_sort(F.collect_list(F.struct("n", "kind", "role", "text"))).alias("log"))
    last = lambda log, kinds: F.coalesce(F.array_max(F.transform(log, lambda x, i: F.when(x["kind"].isin(*kinds), i + 1))), F.lit(0))
    logs = logs.withColumn("reset", last(F.col("log"), RESETS)).filter(last(F.col("log"), ("delete",)) <= F.col("reset"))
    since = F.filter(F.slice("log", F.greatest("reset", F.lit(1)), F.size("log")), lambda x: x["kind"].isin("delta", *RESETS))
    role = F.coalesce(F.get(F.filter("log", lambda x: x["role"] != ""), F.lit(0))["role"], F.lit(""))
    return logs.select("conv_id", "position", role.alias("role"), F.array_join(F.transform(since, lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame, learned: str = LEARNED) -> DataFrame:
    """(conv_id, formatted, loss): one string for each conversation.

    A turn is "<turn ROLE>\\n" TEXT "</turn>\\n", both escaped. loss: array<struct<turn,start,end>>, the spans of code
    points to learn from, counted in turn's own part of the string, which ends with its "</turn>\\n".
    """
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(HEAD_END))
    parts = messages.select("conv_id", F.struct("position", F.concat(head, escape(F.col("text")), F.lit(CLOSE)).alias("part"), (F.col("role") == learned).alias("learn"), F.length(head).alias("start")).alias("turn"))
    turns = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    marked = F.transform("turns", lambda x, i: F.struct(x["learn"].alias("learn"), i.alias("turn"), x["start"].alias("start"), (F.length(x["part"]) - len(CLOSE)).alias("end")))
    return turns.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda x: x["part"]), "").alias("formatted"),
        F.transform(F.filter(marked, lambda x: x["learn"]), lambda x: F.struct(x["turn"].alias("turn"), x["start"].alias("start"), x["end"].alias("end"))).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted's rows with turns array<struct<role,text>> and learned array<string>, both from the string alone."""
    parts = F.slice(F.split("formatted", CLOSE), 1, F.size(F.split("formatted", CLOSE)) - 1)
    body = lambda part: F.substring(part, F.lit(len(OPEN) + 1), F.length(part))
    both = lambda part: let(F.split(body(part), ">", 2), lambda s: F.struct(unescape(F.get(s, F.lit(0))).alias("role"), unescape(F.substring(F.get(s, F.lit(1)), F.lit(2), F.length(part))).alias("text")))
    masked = let(parts, lambda p: F.transform("loss", lambda m: unescape(F.substring(F.get(p, m["turn"]), m["start"] + 1, m["end"] - m["start"]))))
    return formatted.withColumn("turns", F.transform(parts, both)).withColumn("learned", masked)


def chat_format(events: DataFrame, learned: str = LEARNED) -> DataFrame:
    """(conv_id, formatted, loss) of event logs; see reconstruct and render. An empty log gives no rows; a conversation
    whose messages are all deleted has none."""
    return render(reconstruct(events), learned)


def as_log(rows: DataFrame) -> DataFrame:
    """Events of (conv_id, turn, role, text) rows whose fold is these rows: each text is said and goes on by a delta, then an
    edit (of the learned role: a regeneration) starts anew with its first half, and a delta brings the second.

    Repeated rows are turns of their own. Null text stays empty.
    """
    half = (F.length("text") / 2).cast("int")
    steps = F.array(
        F.struct(F.lit(0).alias("k"), F.lit("message").alias("kind"), F.col("text").alias("said")),
        F.struct(F.lit(1).alias("k"), F.lit("delta").alias("kind"), F.lit(" (goes on)").alias("said")),
        F.struct(F.lit(2).alias("k"), F.when(F.col("role") == LEARNED, "regenerate").otherwise("edit").alias("kind"), F.substring("text", F.lit(1), half).alias("said")),
        F.struct(F.lit(3).alias("k"), F.lit("delta").alias("kind"), F.substring("text", half + 1, F.length("text")).alias("said")),
    )
    # A scan of files gives its rows the same numbers each time; they are only told apart by them.
    numbered = rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("message_id"))
    return numbered.select("conv_id", "turn", "role", "message_id", F.inline(steps)).select("conv_id", F.struct("turn", "k").alias("seq"), "kind", "message_id", "role", F.col("said").alias("text"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    done = read_back(chat_format(as_log(rows.unionByName(extra))))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length(F.array_join("learned", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("learned", "").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *, length(role) + length(text)
    + length(regexp_replace(role || text, '[^\\<>]', '', 'g')) + 6 + 2 + 8 AS chars FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""

QUERIES = {"op6_chat_formatting": op6_chat_formatting}
ORACLES = {"op6_chat_formatting": _SQL}
