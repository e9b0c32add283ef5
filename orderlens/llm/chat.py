"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all turns before it as context, and its reply as the only trainable text. A
conversation that does not end with the assistant adds one example without trainable text, so that no turn is lost.

A turn is written as `<|im_start|>role\\ntext<|im_end|>\\n`. Inside roles and texts `&`, `<` and `[` (and the line end
in a role) are written as character references, so no control string of this or another template can arise from them;
the references are turned back exactly.

Only DataFrame functions are used. Turns are ordered by turn, role, text, nulls first; repeated rows are turns of their
own. Null role and null text are empty; a null conversation id is a conversation. An empty table gives an empty result.
An example holds its whole context, so one conversation's rows meet in one row; the expansion of a conversation streams
one example at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The template and the character references.
START, END = "<|im_start|>", "<|im_end|>\n"
REFERENCES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_REFERENCES = (*REFERENCES, ("\n", "&#10;"))
TARGET_ROLE = "assistant"


def escaped(text: Column, references=REFERENCES) -> Column:
    for plain, reference in references:
        text = F.replace(text, F.lit(plain), F.lit(reference))
    return text


def unescaped(text: Column, references=REFERENCES) -> Column:
    for plain, reference in reversed(references):
        text = F.replace(text, F.lit(reference), F.lit(plain))
    return text


def examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end), examples from 1 in turn order, offsets in code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    formatted = turns.select(
        "conv_id",
        F.struct(
            "turn",
            role.alias("role"),
            text.alias("text"),
            F.concat(F.lit(START), escaped(role, ROLE_REFERENCES), F.lit("\n")).alias("head"),
            escaped(text).alias("body"),
        ).alias("t"),
    )
    talks = formatted.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    last = F.size("ts") - 1
    at = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (F.get("ts", i)["role"] == TARGET_ROLE) | (i == last),
    )
    pieces = F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    each = talks.select("conv_id", "ts", pieces.alias("pieces"), F.posexplode(at).alias("example", "at"))
    context = F.array_join(F.slice("pieces", 1, F.col("at")), "")
    turn = F.get("ts", F.col("at"))
    parts = each.select(
        "conv_id",
        (F.col("example") + 1).alias("example"),
        context.alias("context"),
        turn["head"].alias("head"),
        turn["body"].alias("body"),
        (turn["role"] == TARGET_ROLE).alias("trained"),
    )
    start = F.char_length("context") + F.char_length("head")
    return parts.select(
        "conv_id",
        "example",
        F.concat("context", "head", "body", F.lit(END)).alias("text"),
        start.alias("loss_start"),
        F.when(F.col("trained"), start + F.char_length("body")).otherwise(start).alias("loss_end"),
    )


def parsed(text: Column) -> Column:
    """The turns (role, text) of a formatted text."""

    def turn(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        length = F.char_length(part) - F.char_length(head) - 1 - len(END)
        return F.struct(
            unescaped(head, ROLE_REFERENCES).alias("role"),
            unescaped(F.substring(part, F.char_length(head) + 2, length)).alias("text"),
        )

    # Before the first mark stands nothing, and every turn is longer than nothing.
    return F.transform(F.filter(F.split(text, r"<\|im_start\|>", -1), lambda p: p != ""), turn)


def read_back(made: DataFrame) -> DataFrame:
    """Turns, trainable text and size of each conversation, from its examples alone.

    The examples are still partitioned by conversation, so this groups them without another shuffle.
    """
    loss = unescaped(F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    told = made.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", loss.alias("loss")))).alias("losses"),
        F.sum(F.char_length("text")).alias("formatted_chars"),
    )
    turns = F.col("turns")
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        "conv_id",
        parsed(F.col("whole")).alias("turns"),
        F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def with_control_case(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """The turns and conversation -1, whose texts are control strings."""
    case = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(case)


def oracle_sql() -> str:
    escape = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"
    role = f"replace({escape.format('role')}, chr(10), '&#10;')"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (SELECT *, {len(START) + len(END) + 1} + length({role}) + length({escape.format('text')}) AS chars,
             row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM c
      WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
q AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM p)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM q GROUP BY conv_id"""
