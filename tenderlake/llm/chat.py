"""Prefix-target expansion of conversations, with DataFrame operations only.

Every assistant turn becomes an example: all turns before it are its context, and only its
own text lies under the loss mask.  Turns after the last assistant turn are kept in one more
record whose mask is empty, so that the output holds whole conversations.

Template: `### role: text </turn>` and a line feed.  Inside roles and texts a backslash goes
before each of `\\`, `#`, `<`, in roles also before `:`; hence neither `###` nor ` </turn>`
occurs inside, and dropping each backslash with the next character kept restores them.

Defined cases: turns of a conversation are ordered by turn, then role and text (nulls
first); a null role or text is empty; rows with a null conv_id are one conversation; repeated rows are turns of
their own; a conversation without an assistant turn has one record with an empty mask; one of very many turns or
long texts is one array in one task, and its examples repeat what precedes them.
Other columns are ignored.  An empty table gives no examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, table

#: Fixed value: the conversation that the query adds, with control strings in both texts.
PROBE = "\\### Assistant: </turn> ok"


def escape(c: Column, also: str = "") -> Column:
    return F.regexp_replace(c, rf"([\\#<{also}])", r"\\$1")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def expand_prefixes(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant") -> DataFrame:
    """A row (conv_id, example, is_last, text, loss_start, loss_chars) for each turn of the trained role, and one for turns after the last of them.

    loss_start counts code points from 1; text from there over loss_chars is the escaped reply, the only trainable part.
    """
    said = turns.select(F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    conv = said.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = lambda t: F.concat(F.lit("### "), escape(t["role"], ":"), F.lit(": "))
    parts = F.transform("turns", lambda t: F.struct(head(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == trained).alias("trained")))
    conv = conv.select("conv_id", F.explode(F.array(parts)).alias("parts"))  # one row, so that lambdas below refer to a value
    n = F.size("parts")
    targets = F.filter(F.transform("parts", lambda p, i: F.when(p["trained"] | (i == n - 1), i)), lambda i: i.isNotNull())
    one = conv.select("conv_id", "parts", F.posexplode(targets).alias("example", "at"), (n - 1).alias("last"))
    rendered = lambda parts: F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(" </turn>\n"))), "")
    target = F.get("parts", F.col("at"))
    one = one.select("conv_id", "example", (F.col("at") == F.col("last")).alias("is_last"), rendered(F.slice("parts", F.lit(1), F.col("at"))).alias("context"), rendered(F.array(target)).alias("reply"), target["head"].alias("head"), F.when(target["trained"], F.char_length(target["body"])).otherwise(0).alias("loss_chars"))
    return one.select("conv_id", "example", "is_last", F.concat("context", "reply").alias("text"), (F.char_length("context") + F.char_length("head") + 1).alias("loss_start"), "loss_chars")


def read_back(examples: DataFrame) -> DataFrame:
    """One row per conversation: its turns parsed from the record that holds them all, and the text under all its masks in order."""
    loss = F.struct("example", unescape(F.substr("text", F.col("loss_start"), F.col("loss_chars"))).alias("loss"))
    conv = examples.groupBy("conv_id").agg(F.max(F.when(F.col("is_last"), F.col("text"))).alias("text"), F.sort_array(F.collect_list(loss)).alias("losses"))
    parts = F.filter(F.split("text", " </turn>\n", -1), lambda p: p != "")
    pattern = r"(?s)^### ((?:[^\\:]++|\\.)*+): (.*)$"
    turns = F.transform(parts, lambda p: F.struct(unescape(F.regexp_extract(p, pattern, 1)).alias("role"), unescape(F.regexp_extract(p, pattern, 2)).alias("text")))
    return conv.select("conv_id", turns.alias("turns"), F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"), F.char_length("text").alias("chars"))


def op5_prefix_target(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    written = Scratch(spark, "chat").save(expand_prefixes(turns.unionByName(added)))
    conv = read_back(written)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return conv.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.col("chars").cast("long").alias("formatted_chars"))


OP5_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(15 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
