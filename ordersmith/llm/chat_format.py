r"""Chat formatting with a grammar that can be read back, in DataFrame functions only.

A conversation is its turns one after another; a turn is

    <s>ROLE[INST] TEXT [/INST]</s>

``<s> </s> [INST] [/INST]`` are control strings. The parser is deterministic: cut at
``</s>``, then at the first ``[INST] `` and the final `` [/INST]``, and unescape (a
backslash stands for the character after it). Every turn is first rendered as it
is and parsed again; where that does not give back the turn, its content
is escaped: backslashes are doubled and a backslash goes behind the first character
of each control string. The whole conversation is then parsed and compared with its
source once more; if they still differ all its turns are escaped, and a conversation that
differs even so is an error, never an output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import require

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]"]
OPEN, BEGIN, FINISH, CLOSE = "<s>", "[INST] ", " [/INST]", "</s>"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(BEGIN), text, F.lit(FINISH + CLOSE))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; of anything else, something else."""
    def one(part: Column) -> Column:
        begin = F.instr(part, BEGIN)
        role = F.substring(part, F.lit(len(OPEN) + 1), begin - F.lit(len(OPEN) + 1))
        start = begin + F.lit(len(BEGIN))
        text = F.substring(part, start, F.length(part) - F.lit(len(FINISH)) - start + F.lit(1))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    parts = F.split(formatted, r"\Q</s>\E", -1)
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - F.lit(1)), one)


def format_chats(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text",
                 loss_role: str = "assistant") -> DataFrame:
    """(conv, formatted, turns, loss_spans), one row per conversation.

    ``turns`` are read back from ``formatted``. ``loss_spans`` (start, length; code points
    from 1) are where the texts of ``loss_role`` stand in it, escapes included.

    Turns are ordered by turn number (null last), ties by role and text; repeated rows
    are turns of their own. Null role or text: empty. Rows without a conversation
    id form one conversation. Other columns are ignored; an empty table gives none.
    """
    require(chats, conv_col, turn_col, role_col, text_col)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = chats.select(F.col(conv_col).alias("conv"), F.col(turn_col).isNull().alias("late"),
                        F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    source = F.array(F.struct("role", "text"))
    plain = parse(_turn(F.col("role"), F.col("text"))) == source
    rows = rows.withColumn("plain", F.coalesce(plain, F.lit(False)))
    own = F.struct("late", "turn", "role", "text", "plain")
    chat = rows.groupBy("conv").agg(F.array_sort(F.collect_list(own)).alias("own"))

    def shown(x: Column, always: bool, name: str) -> Column:
        return escape(x[name]) if always else F.when(x["plain"], x[name]).otherwise(escape(x[name]))

    def render(always: bool) -> Column:
        return F.array_join(F.transform("own", lambda x: _turn(
            shown(x, always, "role"), shown(x, always, "text"))), "")

    wanted = F.transform("own", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    chat = chat.withColumn("first", render(False)).withColumn("wanted", wanted)
    same = F.coalesce(parse(F.col("first")) == F.col("wanted"), F.lit(False))
    chat = chat.withColumn("always", ~same)
    chat = chat.withColumn("formatted", F.when(F.col("always"), render(True)).otherwise(F.col("first")))
    chat = chat.withColumn("turns", parse(F.col("formatted")))
    chat = chat.withColumn("turns", F.when(F.col("turns") == F.col("wanted"), F.col("turns")).otherwise(
        F.raise_error(F.lit("a conversation does not survive formatting")).cast(
            "array<struct<role:string,text:string>>")))

    def sizes(x: Column) -> Column:
        r, t = (F.length(F.when(F.col("always"), escape(x[n])).otherwise(shown(x, False, n)))
                for n in ("role", "text"))
        return F.struct((r + F.lit(len(OPEN + BEGIN))).alias("lead"), t.alias("size"),
                        (x["role"] == loss_role).alias("loss"))

    # running positions: (position, spans) folded over the turns
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>")
                     .alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        span = F.struct((acc["at"] + x["lead"]).alias("start"), x["size"].alias("length"))
        return F.struct((acc["at"] + x["lead"] + x["size"] + F.lit(len(FINISH + CLOSE))).alias("at"),
                        F.when(x["loss"], F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate(F.transform("own", sizes), start, step, lambda acc: acc["spans"])
    return chat.select(F.col("conv").alias(conv_col), "formatted", "turns", spans.alias("loss_spans"))


def under_loss(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, read from the formatted conversation and unescaped."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(
        F.substring(formatted, s["start"], s["length"]))), "")
