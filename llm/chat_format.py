"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|turn|>role<|text|>body<|end|>``. The rendered turn is parsed
again by the same deterministic grammar; where the recovered role or text differs from
the source, the turn is rendered a second time with its control strings escaped and
``<|coded|>`` instead of ``<|text|>``. The escape is a prefix code, so the second round is
always identical; ``round_trip`` says so for each conversation, read from the final text.
"""

import re
from functools import reduce

from pyspark.sql import functions as F

# Control strings of this template and of other common ones.
TURN, TEXT, CODED, END = "<|turn|>", "<|text|>", "<|coded|>", "<|end|>"
CONTROLS = [TURN, TEXT, CODED, END, "<s>", "</s>", "[INST]", "[/INST]"]
#: First character of every escape; "~0" is the character itself, "~1" the first control.
ESCAPE = "~"


def escaped(column):
    pairs = [(ESCAPE, ESCAPE + "0")] + [(c, f"{ESCAPE}{i}") for i, c in enumerate(CONTROLS, 1)]
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, column)


def unescaped(column):
    pairs = [(f"{ESCAPE}{i}", c) for i, c in enumerate(CONTROLS, 1)] + [(ESCAPE + "0", ESCAPE)]
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, column)


def rendered(role, text, mark=TEXT):
    return F.concat(F.lit(TURN), role, F.lit(mark), text, F.lit(END))


def reparsed(formatted):
    """array<struct<role, text>> that the grammar reads from rendered turns, escapes undone.

    Pieces begin at the turn mark; a role ends at the first text or coded mark and a body
    at the first end mark. A body with any control string left in it is no valid turn and
    reads as null.
    """
    control = "|".join(re.escape(c) for c in CONTROLS)

    def turn(piece):
        coded = F.instr(piece, CODED) > 0
        mark = F.when(coded, CODED).otherwise(TEXT)
        at = F.locate(TEXT, piece)
        at = F.when(coded, F.locate(CODED, piece)).otherwise(at)
        role = F.substr(piece, F.lit(1), at - 1)
        rest = F.substr(piece, at + F.length(mark))
        body = F.substr(rest, F.lit(1), F.length(rest) - len(END))
        valid = (at > 0) & rest.endswith(END) & ~role.rlike(control) & ~body.rlike(control)
        return F.when(valid, F.struct(
            F.when(coded, unescaped(role)).otherwise(role).alias("role"),
            F.when(coded, unescaped(body)).otherwise(body).alias("text")))
    pieces = F.split(formatted, re.escape(TURN))
    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def format_conversations(rows):
    """``conv_id, formatted, turns, round_trip`` for each conversation of the rows.

    ``rows(conv_id, turn, role, text)`` may hold other columns; null text or role counts as
    empty, rows of one turn number follow each other by role and text, a null number comes
    first, and rows with a null ``conv_id`` form one conversation. ``turns`` is what the
    parser reads from ``formatted``. A conversation is one value of the result, so its rows
    meet in one task; all work on texts is done before that. Empty in, empty out.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = rendered(role, text)
    back = reparsed(plain)
    same = (F.size(back) == 1) & F.coalesce(
        (back[0]["role"] == role) & (back[0]["text"] == text), F.lit(False))
    turns = rows.select(
        F.col("conv_id"), F.col("turn"), role.alias("role"), text.alias("text"),
        F.when(same, plain).otherwise(rendered(escaped(role), escaped(text), CODED)).alias("piece"))
    whole = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "piece"))).alias("source"))
    whole = whole.withColumn("formatted", F.array_join(F.col("source.piece"), ""))
    whole = whole.withColumn("turns", reparsed(F.col("formatted")))
    source = F.transform("source", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return whole.select("conv_id", "formatted", "turns",
                        F.coalesce(F.col("turns") == source, F.lit(False)).alias("round_trip"))


def with_loss_text(formatted, trained="assistant"):
    """Adds ``loss_text``: the texts of turns under the loss mask, in order."""
    own = F.filter("turns", lambda t: t["role"] == trained)
    return formatted.withColumn("loss_text", F.array_join(F.transform(own, lambda t: t["text"]), ""))


def digests(formatted):
    """The columns of op7, all from the parsed output."""
    lines = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return with_loss_text(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "round_trip")


#: The added conversation, whose texts hold control strings.
ADDED = "</s>[INST] ok [/INST]"


def with_added(rows):
    spark = rows.sparkSession
    added = spark.range(0, 2, 1, 1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ADDED).alias("text"))
    return rows.select("conv_id", "turn", "role", "text").unionByName(added)


def _sql():
    control = " OR ".join(f"contains(x, '{c}')" for c in CONTROLS)
    code = "replace(x, '~', '~0')"
    for i, c in enumerate(CONTROLS, 1):
        code = f"replace({code}, '{c}', '~{i}')"
    return f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{ADDED}' UNION ALL SELECT -7, 1, 'assistant', '{ADDED}'),
u AS (
    SELECT *, list_bool_or([({control}) FOR x IN [role, text]]) AS coded FROM t),
v AS (
    SELECT *, {sum(map(len, (TURN, TEXT, END)))} + CASE WHEN coded
        THEN {len(CODED) - len(TEXT)} + list_sum([length({code}) FOR x IN [role, text]])
        ELSE length(role) + length(text) END AS n FROM u)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    sum(n)::BIGINT AS formatted_chars, true AS round_trip
FROM v GROUP BY conv_id
"""


SQL = _sql()
