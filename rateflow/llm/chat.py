"""Chat formatting as relational work: one grouped row per conversation.

Turn structs are collected, sorted, joined into text and masked by Spark expressions
alone.  Neighbouring turns of the same role are merged into one turn with parts, so
that nothing of the original turns is lost.  The template:

    <|turn|>role<|text|>text<|part|>text of a merged turn<|end|>

Inside roles and texts the escape character ``\\`` is doubled and ``<|`` becomes
``<\\|``, so no text can hold a control string, and reading back is exact.

The loss mask is a list of spans (start, length) in code points of the formatted
text: the texts of the assistant, without the control strings.

Edge cases: a null text or role is empty; turns are ordered by number (null first),
then role and text, so ties and repeated rows have one order; a null conv_id is a
conversation of its own; an empty table gives an empty result; further columns are
not read.  A conversation is one training text, so it has to fit into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN, TEXT, PART, END = "<|turn|>", "<|text|>", "<|part|>", "<|end|>"
TRAINED = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def format_chat(turns: DataFrame, trained: str = TRAINED) -> DataFrame:
    """Per conversation: conv_id, formatted text and the loss mask's spans."""
    empty = F.lit("")
    rows = turns.select("conv_id", F.struct(
        F.col("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    t, n = F.col("turns"), F.size("turns")

    def piece(x: Column, i: Column) -> Column:
        # element_at counts from 1: i is the turn before, i + 2 the turn after.
        opens = (i == 0) | (F.element_at(t, F.greatest(i, F.lit(1))).getField("role") != x.getField("role"))
        closes = (i == n - 1) | (F.element_at(t, F.least(i + 2, n)).getField("role") != x.getField("role"))
        head = F.when(opens, F.concat(F.lit(TURN), escape(x.getField("role")), F.lit(TEXT))).otherwise(F.lit(PART))
        return F.struct(head.alias("head"), escape(x.getField("text")).alias("body"),
                        F.when(closes, F.lit(END)).otherwise(empty).alias("tail"),
                        (x.getField("role") == trained).alias("loss"))

    pieces = sorted_turns.select("conv_id", F.transform(t, piece).alias("p"))
    text = F.array_join(F.transform("p", lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
    length = lambda c: F.length(c).cast("long")
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def add(acc: Column, p: Column) -> Column:
        begin = acc["at"] + length(p["head"])
        span = F.array(F.struct(begin.alias("start"), length(p["body"]).alias("length")))
        return F.struct((begin + length(p["body"]) + length(p["tail"])).alias("at"),
                        F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return pieces.select("conv_id", text.alias("formatted"),
                         F.aggregate("p", start, add, lambda acc: acc["spans"]).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The original turns, an array of structs (role, text), read from formatted text."""
    after = F.filter(F.split(formatted, r"<\|turn\|>"), lambda x: x != "")

    def parts(turn: Column) -> Column:
        role_text = F.split(F.regexp_replace(turn, r"<\|end\|>$", ""), r"<\|text\|>")
        texts = F.split(F.element_at(role_text, 2), r"<\|part\|>")
        return F.transform(texts, lambda x: F.struct(
            unescape(F.element_at(role_text, 1)).alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(after, parts))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted text: counts and digests."""
    chats = format_chat(turns)
    back = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    nl = F.lit("\n")
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], nl, t["text"], nl)), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha(plain).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


# Conversation -7 checks that texts cannot pose as control strings.
PROBE = "</s>[INST] ok [/INST]"


def with_probe(turns: DataFrame) -> DataFrame:
    probe = turns.sparkSession.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)],
                                               "conv_id long, turn long, role string, text string")
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER w AS i, lag(role) OVER w IS DISTINCT FROM role AS opens,
             lead(role) OVER w IS DISTINCT FROM role AS closes FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
                + (length(text) - length(replace(text, '<|', ''))) // 2 AS n_text,
             length(role) + length(role) - length(replace(role, '\', ''))
                + (length(role) - length(replace(role, '<|', ''))) // 2 AS n_role FROM o)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n_text + CASE WHEN opens THEN 16 + n_role ELSE 8 END + CASE WHEN closes THEN 7 ELSE 0 END)::BIGINT
           AS formatted_chars
FROM e GROUP BY conv_id
"""
