"""Chat formatting with a grammar round trip, by DataFrame functions only.

A conversation is rendered as

    <|im_start|>ROLE NEWLINE TEXT<|im_end|>NEWLINE

for each turn, parsed again by the grammar's deterministic parser and compared with its
source. Turns whose plain rendering doesn't come back identical get their conflicting
content escaped: every ``<``, any number of backslashes, ``|`` gets one backslash more, so
no control string is left in a text, and the parser takes one away. In roles, backslashes
and line breaks are escaped too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Role whose texts are learned from.
LEARNED = "assistant"


def _escaped(s: Column) -> Column:
    return F.regexp_replace(s, r"<(\\*)\|", r"<$1\\|")


def _unescaped(s: Column) -> Column:
    return F.regexp_replace(s, r"<(\\*)\\\|", "<$1|")


def _role_escaped(s: Column) -> Column:
    return F.replace(F.replace(_escaped(s), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _role_unescaped(s: Column) -> Column:
    # a backslash and what it escapes, at once: a doubled one isn't the start of \n
    parts = F.regexp_extract_all(s, F.lit(r"(?s)\\.|[^\\]+"), F.lit(0))
    plain = F.transform(parts, lambda p: F.when(p == "\\n", "\n").when(p == "\\\\", "\\").otherwise(p))
    return _unescaped(F.array_join(plain, ""))


def turn(role: Column, text: Column) -> Column:
    """One rendered turn."""
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def parse(formatted: Column) -> Column:
    """Array of (role, text) of a rendered string, or null where it isn't one of the grammar."""
    bodies = F.split(formatted, r"<\|im_end\|>\n", -1)
    heads = F.slice(bodies, 1, F.greatest(F.size(bodies) - 1, F.lit(0)))
    good = (F.element_at(bodies, -1) == "") & F.forall(
        heads, lambda b: b.startswith(START) & (F.instr(b, "\n") > 0) & ~F.substr(b, F.lit(len(START) + 1)).rlike(r"<\|im_(start|end)\|>")
    )
    body = lambda b: F.substr(b, F.lit(len(START) + 1))
    turns = F.transform(
        heads,
        lambda b: F.struct(
            _role_unescaped(F.substring_index(body(b), "\n", 1)).alias("role"),
            _unescaped(F.substr(body(b), F.instr(body(b), "\n") + 1)).alias("text"),
        ),
    )
    return F.when(good, turns)


def format_turns(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) to rows with ``piece``, the rendered turn, and where its text stands in it.

    Round trip: the plain rendering is parsed; where role and text don't come back identical
    the turn is rendered with its content escaped, which always comes back.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    back = parse(turn(F.col("role"), F.col("text")))
    same = F.coalesce((F.size(back) == 1) & (back[0]["role"] == F.col("role")) & (back[0]["text"] == F.col("text")), F.lit(False))
    # only what holds a "<", a backslash or a break in its role can conflict; the rest needs no parse
    plain = ~(F.col("text").contains("<") | F.col("role").rlike(r"[<\\\n]"))
    rows = rows.withColumn("conflict", ~(plain | same))
    rows = rows.withColumn("shown_role", F.when(F.col("conflict"), _role_escaped(F.col("role"))).otherwise(F.col("role")))
    rows = rows.withColumn("shown", F.when(F.col("conflict"), _escaped(F.col("text"))).otherwise(F.col("text")))
    return rows.withColumn("piece", turn(F.col("shown_role"), F.col("shown")))


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, mask): each conversation as one string, and the spans to learn from.

    ``mask`` holds (start, length) in code points of every assistant text, in order. Turns
    are ordered by turn, then role and text, nulls first, so repeated rows and equal turn
    numbers have a defined place; null roles and texts are empty. Rows with a null conv_id
    are one conversation. A conversation is one string by definition, so its turns meet in
    one row; nothing else is gathered. An empty table gives no rows. Each string is parsed once
    more as a whole, and the query fails if one should not give its turns back identical.
    """
    rows = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    rows = format_turns(rows)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(
        "conv_id", "piece", F.row_number().over(order).alias("k"), F.struct("role", "text").alias("source"),
        F.when(F.col("role") == LEARNED, F.struct(
            (F.coalesce(before, F.lit(0)) + F.length("shown_role") + len(START) + 1).alias("start"), F.length("shown").cast("long").alias("length"),
        )).alias("span"),
    )
    parts = F.array_sort(F.collect_list(F.struct("k", "piece", "span", "source")))
    whole = rows.groupBy("conv_id").agg(parts.alias("parts")).select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"),
        F.filter(F.transform("parts", lambda p: p["span"]), lambda s: s.isNotNull()).alias("mask"),
        F.transform("parts", lambda p: p["source"]).alias("source"),
    )
    # the last step of the round trip: what was put together, escaped turns too, is parsed and compared with its source
    kept = F.when(parse(F.col("formatted")).eqNullSafe(F.col("source")), F.col("formatted"))
    lost = F.raise_error(F.concat(F.lit("conversation doesn't come back identical: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    return whole.select("conv_id", kept.otherwise(lost).alias("formatted"), "mask")


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under a mask, unescaped, nothing between."""
    cut = lambda s: _unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.transform(mask, cut), "")
