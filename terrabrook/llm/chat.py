"""Chat formatting: reply trees to root-to-leaf paths, ranked by score, each one conversation.

Paths come from self-joins over ids alone: jump pointers double (2, 4, 8 ... replies up) while
every leaf's list of ancestors, one row per step, doubles with them.  So a tree of depth D takes
about log2(D) rounds, rows stay in proportion to the paths' total length, and a texts is moved once.
DataFrame functions only.

Every turn is TURN role SAYS text END.  Backslashes and "<|" inside roles and texts are escaped,
so no text can form a mark, and unescaping gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, table
from .spans import running_total

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
LOSS_ROLE = "assistant"
CONTROL = "</s>[INST] ok [/INST]"


def escaped(col: Column) -> Column:
    return F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(col: Column) -> Column:
    return F.regexp_replace(col, r"(?s)\\(.)", "$1")


def keyed(messages: DataFrame) -> DataFrame:
    """messages with conv_id in a struct: structs of null are equal, so a null conv_id joins like others."""
    return messages.withColumn("conv_id", F.struct("conv_id"))


def reply_paths(messages: DataFrame) -> DataFrame:
    """conv_id, leaf, node, step (0 at the leaf) for every root-to-leaf path.

    messages: conv_id, msg_id (unique in its conversation), parent_id.  A message whose parent is
    null, missing or not before it (parent_id >= msg_id) is a root, so there are no cycles.
    Messages with a null conv_id are one conversation.
    """
    return keyed_paths(keyed(messages)).withColumn("conv_id", F.col("conv_id.conv_id"))


def keyed_paths(messages: DataFrame) -> DataFrame:
    nodes = cut(messages.select("conv_id", "msg_id", F.when(F.col("parent_id") < F.col("msg_id"), F.col("parent_id")).alias("parent_id")))
    known = nodes.select("conv_id", F.col("msg_id").alias("up"))
    jump = cut(nodes.filter("parent_id is not null").select("conv_id", F.col("msg_id").alias("node"), F.col("parent_id").alias("up")).join(known, ["conv_id", "up"]).select("conv_id", "node", "up"))
    leaves = nodes.join(jump.select("conv_id", F.col("up").alias("msg_id")).distinct(), ["conv_id", "msg_id"], "left_anti")
    paths = leaves.select("conv_id", F.col("msg_id").alias("leaf"), F.col("msg_id").alias("node"), F.lit(0).alias("step"))
    width = 1
    while not jump.isEmpty():
        further = paths.join(jump, ["conv_id", "node"]).select("conv_id", "leaf", F.col("up").alias("node"), (F.col("step") + width).alias("step"))
        paths = cut(paths.unionByName(further))
        above = jump.select("conv_id", F.col("node").alias("up"), F.col("up").alias("top"))
        jump = cut(jump.join(above, ["conv_id", "up"]).select("conv_id", "node", F.col("top").alias("up")))
        width *= 2
    return paths


def format_chats(messages: DataFrame, top: int | None = None) -> DataFrame:
    """conv_id, leaf, score, branch (1 is the best), n_turns, formatted, loss (array of start, end).

    messages: conv_id, msg_id, parent_id, role, text, score (null: 0).  A path's score is its
    messages' mean; branches rank by score, then leaf.  top keeps that many branches of each
    conversation (a top-k feature; None keeps all).  loss are the code points of the formatted
    string that hold a LOSS_ROLE turn's escaped text.  Null roles and texts are empty.  Messages with
    a null conv_id are one conversation.  Extra columns are not returned.
    """
    messages = keyed(messages)
    paths = keyed_paths(messages)
    turns = paths.join(messages.select("conv_id", F.col("msg_id").alias("node"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0.0)).alias("score")), ["conv_id", "node"])
    scored = turns.groupBy("conv_id", "leaf").agg(
        F.avg("score").alias("score"),
        F.array_sort(F.collect_list(F.struct((-F.col("step")).alias("place"), (F.col("role") == LOSS_ROLE).alias("loss"), escaped(F.col("role")).alias("role"), escaped(F.col("text")).alias("text")))).alias("turns"),
    )
    ranked = scored.withColumn("branch", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("score"), "leaf")))
    ranked = ranked if top is None else ranked.filter(F.col("branch") <= top)
    pieces = F.transform("turns", lambda t: F.concat(F.lit(TURN), t["role"], F.lit(SAYS), t["text"], F.lit(END)))
    lengths = F.transform("turns", lambda t: F.length(t["role"]) + F.length(t["text"]) + len(TURN + SAYS + END))
    placed = ranked.select("conv_id", "leaf", "score", "branch", "turns", pieces.alias("pieces"), running_total(lengths).alias("starts"))
    spans = F.transform(F.arrays_zip("turns", "starts"), lambda z: F.struct(
        (z["starts"] + len(TURN + SAYS) + F.length(z["turns"]["role"])).alias("start"),
        (z["starts"] + len(TURN + SAYS) + F.length(z["turns"]["role"]) + F.length(z["turns"]["text"])).alias("end"),
        z["turns"]["loss"].alias("loss"),
    ))
    return placed.select(
        "conv_id.conv_id", "leaf", "score", "branch", F.size("turns").cast("long").alias("n_turns"), F.array_join("pieces", "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted string."""
    parts = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1 << 30)
    return F.transform(parts, lambda p: F.struct(
        unescaped(F.substring_index(p, SAYS, 1)).alias("role"),
        unescaped(F.substring(F.substring_index(p, END, 1), F.length(F.substring_index(p, SAYS, 1)) + len(SAYS) + 1, F.length(p))).alias("text"),
    ))


def as_tree(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as messages: each turn replies to the one before.

    Ties of turn are ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select("conv_id", F.row_number().over(order).cast("long").alias("msg_id"), "role", "text")
    return numbered.select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql(f"SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, '{CONTROL}' AS text UNION ALL SELECT -1L, 1L, 'assistant', '{CONTROL}'")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = format_chats(as_tree(rows)).select("conv_id", "n_turns", "formatted", "loss", read_turns(F.col("formatted")).alias("turns"))
    loss = F.transform("loss", lambda s: unescaped(F.substring("formatted", s["start"] + 1, s["end"] - s["start"])))
    back = chats.select(
        "conv_id", "n_turns", "formatted", F.array_join(loss, "").alias("loss_text"), F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("all_text")
    )
    return back.select(
        "conv_id", "n_turns", F.sha2("all_text", 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars")
    )


OP6_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, replace(replace(role, '\', '\\'), '<|', '<\|') AS r, replace(replace(text, '\', '\\'), '<|', '<\|') AS t FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(r) + length(t) + 23)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
