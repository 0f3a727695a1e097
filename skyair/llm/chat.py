"""Chat formatting: a state machine over roles checks the order of turns, a declarative template turns a
conversation into text segments with a loss flag each.

The template marks where a turn begins and ends. The texts between the marks are escaped, so that no mark
can appear inside them, and unescaping gives the text back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of the template, and for which roles the text counts in the loss.
TEMPLATE = {"begin": "<|turn|>", "name_end": "\n", "end": "<|end|>", "loss": ("assistant",)}

#: Transitions of the state machine: state -> role -> next state. A conversation may stop in a final state.
MACHINE = {
    "start": {"system": "told", "user": "asked"},
    "told": {"user": "asked"},
    "asked": {"assistant": "answered"},
    "answered": {"user": "asked"},
}
FINAL = ("answered",)

#: Every control string begins with one of the characters that are replaced here (in this order).
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
NAME_ESCAPES = (*ESCAPES, ("\n", "&#10;"))


def escaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, coded in escapes:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, coded in reversed(escapes):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _states(roles: Column) -> Column:
    """State after the last turn; ``invalid`` once a role has no transition."""

    def step(state: Column, role: Column) -> Column:
        following = F.lit("invalid")
        for source, moves in MACHINE.items():
            for name, target in moves.items():
                following = F.when((state == source) & (role == name), F.lit(target)).otherwise(following)
        return following

    return F.aggregate(roles, F.lit("start"), step)


def format_conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template=TEMPLATE
) -> DataFrame:
    """One row per conversation: its id, ``valid``, ``segments`` (text, loss) and ``formatted``.

    Turns stand in order of ``turn``, then role, then text; a null turn comes first, a repeated row is a
    turn of its own. Null roles and texts count as empty. Rows with a null id form one conversation. A
    conversation whose roles break the order is formatted all the same, with ``valid`` false. An empty
    table gives an empty result; other columns are ignored.
    """
    rows = df.select(
        F.col(f"`{conv}`").alias("__conv"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        ).alias("row"),
    )
    turns = rows.groupBy("__conv").agg(F.sort_array(F.collect_list("row")).alias("turns"))

    def segments_of(row: Column) -> Column:
        head = F.concat(F.lit(template["begin"]), escaped(row["role"], NAME_ESCAPES), F.lit(template["name_end"]))
        marked = lambda value, loss: F.struct(value.alias("text"), loss.alias("loss"))
        return F.array(
            marked(head, F.lit(False)),
            marked(escaped(row["text"]), row["role"].isin(*template["loss"])),
            marked(F.lit(template["end"]), F.lit(False)),
        )

    formatted = turns.select(
        F.col("__conv").alias(conv),
        _states(F.transform("turns", lambda r: r["role"])).isin(*FINAL).alias("valid"),
        F.flatten(F.transform("turns", segments_of)).alias("segments"),
    )
    joined = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return formatted.withColumn("formatted", joined)


def read_back(formatted: Column, template=TEMPLATE) -> Column:
    """The turns (role, text) in a formatted conversation."""
    begin = F.lit(template["begin"].replace("|", "\\|"))
    parts = F.slice(F.split(formatted, begin), F.lit(2), F.size(F.split(formatted, begin)))

    def turn(part: Column) -> Column:
        name = F.substring_index(part, template["name_end"], 1)
        body = F.substr(part, F.length(name) + 1 + len(template["name_end"]))
        body = F.left(body, F.length(body) - len(template["end"]))
        return F.struct(unescaped(name, NAME_ESCAPES).alias("role"), unescaped(body).alias("text"))

    return F.transform(parts, turn)


def digest(df: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What a formatted conversation holds, read from its segments and its text."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"]))
    trained = F.array_join(trained, "")
    return df.withColumn("turns", read_back(F.col("formatted"))).select(
        F.col(conv),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(trained).cast("bigint").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        F.col("valid"),
    )


ORACLE = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS coded
  FROM rows
), checked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY k) AS before,
    k = count(*) OVER (PARTITION BY conv_id) AS is_last
  FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + coded + 16)::BIGINT AS formatted_chars,
  bool_and(CASE WHEN k = 1 THEN role IN ('system', 'user')
    WHEN role = 'user' THEN before IN ('system', 'assistant')
    WHEN role = 'assistant' THEN before = 'user' ELSE false END
    AND (NOT is_last OR role = 'assistant')) AS valid
FROM checked GROUP BY conv_id
"""
