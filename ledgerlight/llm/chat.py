"""Chat formatting by prefix-target expansion.

Each turn is formatted once, as a piece ``### <role>:\\n<text></turn>\\n`` with its place in the conversation's formatted
text. Each assistant turn then becomes an example of its own: its context is the formatted text of all turns before it
(and the header of its own), and the only trainable span is the reply. Examples are written out whole. That is quadratic in
a conversation's length by nature; the turns cross the network once, as examples are built where their conversation was
ordered, and the prefixes that examples of one conversation share lie next to each other in the files and compress well.

Inside texts and roles, a backslash stands before every backslash, ``#`` and ``<`` (in roles also ``:`` and line feed), so
no text can hold a mark, and ``unescape`` gives the text back exactly.

Cases: null text or role is empty; turns with equal number are ordered by role and text; repeated rows are turns of their
own; a null conversation id is a conversation; a conversation without assistant turn has no example, but its pieces;
other columns of the input are ignored; an empty table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_folder, staged, table

# The marks of the template.
OPEN, AFTER_ROLE, CLOSE = "### ", ":\n", "</turn>\n"
TRAINABLE_ROLE = "assistant"


def escape(text: Column, marks: str = "\\#<") -> Column:
    for mark in marks:
        text = F.replace(text, F.lit(mark), F.lit(f"\\{mark}"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn_no (from 0), piece, piece_from, text_from, text_to (characters), is_target.

    The running place is a window over one conversation; it streams and spills, and collects nothing.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    header = F.concat(F.lit(OPEN), escape(role, "\\#<:\n"), F.lit(AFTER_ROLE))
    turns = conversations.select(
        "conv_id", F.col("turn").alias("turn_key"), role.alias("role"), text.alias("text"),
        F.concat(header, escape(text), F.lit(CLOSE)).alias("piece"), F.length(header).alias("header_chars"),
    )
    ordered = Window.partitionBy("conv_id").orderBy("turn_key", "role", "text")
    end = F.sum(F.length("piece").cast("long")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return turns.select(
        "conv_id", (F.row_number().over(ordered) - 1).alias("turn_no"), "piece", end.alias("piece_to"),
        "header_chars", (F.col("role") == TRAINABLE_ROLE).alias("is_target"),
    ).select(
        "conv_id", "turn_no", "piece", (F.col("piece_to") - F.length("piece")).alias("piece_from"),
        (F.col("piece_to") - F.length("piece") + F.col("header_chars")).alias("text_from"),
        (F.col("piece_to") - len(CLOSE)).alias("text_to"), "is_target",
    )


def expand(pieces: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, target_turn, example, loss_from, loss_to.

    ``example`` is the formatted text up to the end of the turn; all before ``loss_from`` (characters) is context, and only
    ``loss_from`` to ``loss_to`` is trainable. The running list needs no exchange beyond that of ``format_turns``.
    """
    so_far = Window.partitionBy("conv_id").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, 0)
    running = pieces.select("conv_id", "turn_no", "text_from", "text_to", "is_target", F.collect_list("piece").over(so_far).alias("parts"))
    return running.where("is_target").select(
        "conv_id", F.col("turn_no").alias("target_turn"), F.array_join("parts", "").alias("example"),
        F.col("text_from").alias("loss_from"), F.col("text_to").alias("loss_to"),
    )


def read_replies(examples: DataFrame) -> DataFrame:
    """The trainable text of each example, unescaped, and the example's length: conv_id, target_turn, reply, example_chars."""
    span = F.col("example").substr((F.col("loss_from") + 1).cast("int"), (F.col("loss_to") - F.col("loss_from")).cast("int"))
    return examples.select("conv_id", "target_turn", unescape(span).alias("reply"), F.length("example").cast("long").alias("example_chars"))


def read_turns(pieces: DataFrame) -> DataFrame:
    """Role and text of each turn, from its piece alone."""
    role_to = F.locate(AFTER_ROLE, F.col("piece"))
    body_from = role_to + len(AFTER_ROLE)
    return pieces.select(
        "conv_id", "turn_no",
        unescape(F.col("piece").substr(F.lit(len(OPEN) + 1), role_to - len(OPEN) - 1)).alias("role"),
        unescape(F.col("piece").substr(body_from, F.length("piece") - len(CLOSE) - body_from + 1)).alias("text"),
    )


# ---------------------------------------------------------------- the query


def op4_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from the written turns and examples."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    special = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    folder, formatted = shared_folder(spark), format_turns(given.unionByName(special))
    pieces, examples = staged(formatted, folder, "turns"), staged(expand(formatted), folder, "examples")
    turns = read_turns(pieces).select("conv_id", "turn_no", "text", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("shown"))
    replies = read_replies(examples).withColumnRenamed("target_turn", "turn_no")
    rows = turns.select("conv_id", "turn_no", "shown", F.lit(None).cast("long").alias("example_chars"), F.lit(None).cast("string").alias("reply"))
    rows = rows.unionByName(replies.withColumn("shown", F.lit(None).cast("string")))
    # The contract's digests are of whole conversations, so here, and only here, the turns of one meet in one value.
    listed = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("shown").isNotNull(), F.struct("turn_no", "shown")))).alias("shown"),
        F.array_sort(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("turn_no", "reply")))).alias("replies"),
        F.coalesce(F.sum("example_chars"), F.lit(0)).alias("formatted_chars"),
    )
    loss = F.array_join(F.col("replies.reply"), "")
    return listed.select(
        "conv_id", F.size("shown").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.col("shown.shown"), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )


OP4_SQL = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized as (
    select *, 4 + length(regexp_replace(role, '([\\#<:\n])', '\\\1', 'g')) + 2
              + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) + 8 as piece_chars from turns),
placed as (
    select *, sum(piece_chars) over (partition by conv_id order by turn, role, text
                                     rows between unbounded preceding and current row) as piece_to from sized)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       coalesce(sum(piece_to) filter (where role = 'assistant'), 0)::bigint as formatted_chars
from placed group by conv_id
"""
