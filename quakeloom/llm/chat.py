"""Chat formatting with Spark expressions only.

Turn structs are collected and sorted per conversation; each turn looks at its
neighbours in the array, so adjacent turns of one role share a block, and the
pieces are joined into one string. Every step is linear in the conversation.

Template, one block per run of turns of a role, turns of a block apart by ``[TURN]``:

    user       [INST]text[/INST]
    assistant  <s>text</s>
    system     [SYS]text[/SYS]
    others     [ROLE]role[/ROLE]text[END]

A control string inside a text gets a backslash after its first character, and
one that already has backslashes there gets one more; reading back takes one
away. Control strings begin with ``<`` or ``[`` and hold none further on, so none
can arise where a text meets the template.

Defined cases: a null text or role is empty; turns sort by number (null first),
then role, then text; repeated rows are turns of their own; a null conv_id is one
conversation; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
TURN, END = "[TURN]", "[END]"
_REST = r"/?s>|/?INST\]|/?SYS\]|/?ROLE\]|TURN\]|END\]"
#: The loss is taken on what this role says.
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_REST})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_REST})", r"$1$2$3")


def _by_role(role: Column, side: int) -> Column:
    out = F.concat(F.lit("[ROLE]"), escape(role), F.lit("[/ROLE]")) if side == 0 else F.lit(END)
    for name, marks in ROLES.items():
        out = F.when(role == name, F.lit(marks[side])).otherwise(out)
    return out


def format_chat(turns: DataFrame) -> DataFrame:
    """conv_id, ``formatted``, and ``mask``: of each turn its code points in the text and whether they count for the loss."""
    clean = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"),
                        F.struct(F.col("turn").cast("long").alias("turn"), clean("role"), clean("text")).alias("t"))
    sorted_ = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    said = sorted_.select("conv_id", F.transform("ts", lambda t: F.struct(t["role"].alias("role"), escape(t["text"]).alias("text"))).alias("ts"))

    def piece(t: Column, i: Column) -> Column:
        first = (i == 0) | (F.get(F.col("ts"), i - 1)["role"] != t["role"])
        last = (i == F.size("ts") - 1) | (F.get(F.col("ts"), i + 1)["role"] != t["role"])
        return F.concat(F.when(first, _by_role(t["role"], 0)).otherwise(TURN), t["text"],
                        F.when(last, _by_role(t["role"], 1)).otherwise(""))

    return said.select(
        "conv_id", F.array_join(F.transform("ts", piece), "").alias("formatted"),
        F.transform("ts", lambda t: F.struct(F.length(t["text"]).cast("long").alias("chars"), (t["role"] == LEARNED).alias("loss"))).alias("mask"))


_BLOCK = r"(?s)\[INST\].*?\[/INST\]|<s>.*?</s>|\[SYS\].*?\[/SYS\]|\[ROLE\].*?\[END\]"


def read_chat(formatted: Column) -> Column:
    """The turns (role, text) that a formatted string holds."""
    def turns(block: Column) -> Column:
        role, body = F.regexp_extract(block, r"(?s)^\[ROLE\](.*?)\[/ROLE\]", 1), F.regexp_extract(block, r"(?s)^\[ROLE\].*?\[/ROLE\](.*)\[END\]$", 1)
        role = unescape(role)
        for name, (open_, close) in ROLES.items():
            mine = block.startswith(open_)
            role = F.when(mine, F.lit(name)).otherwise(role)
            body = F.when(mine, F.substr(block, F.lit(len(open_) + 1), F.length(block) - len(open_) - len(close))).otherwise(body)
        return F.transform(F.split(body, r"\[TURN\]", -1), lambda text: F.struct(role.alias("role"), text.alias("text")))

    return F.flatten(F.transform(F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(0)), turns))


def digest(chats: DataFrame) -> DataFrame:
    """Counts and digests, all read back from the formatted string and its mask."""
    read = chats.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), "mask", read_chat(F.col("formatted")).alias("back"))
    under = F.filter(F.arrays_zip("back", "mask"), lambda x: x["mask"]["loss"] & (F.length(x["back"]["text"]) == x["mask"]["chars"]))
    loss = F.array_join(F.transform(under, lambda x: unescape(x["back"]["text"])), "")
    told = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), unescape(t["text"]), F.lit("\n"))), "")
    return read.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
