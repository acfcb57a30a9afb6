"""Chat formatting with a round trip through its own grammar, with DataFrame operations only.

A conversation is rendered as its turns in a row, each of them

    ### <Label>: <text></turn>\\n

Control strings inside a text, ``###`` and ``</turn>``, are stuffed: a backslash goes in between two ``#`` and after the
``<``, and one more where backslashes stand there already. Taking one out again restores any text, so stuffing is
reversible even for texts that look stuffed. The grammar reads a rendered conversation by cutting at every ``</turn>\\n``; no text holds
that string any more.

Texts are rendered as they are first. The result is read back by the grammar and compared with the source, and the texts
of those turns that did not come back are stuffed, until every turn is identical; a turn that never is stops the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_END = "</turn>\n"
# Roles with a label of their own. Others are carried as the hex digits of their UTF-8 bytes.
LABELS = {"system": "System", "user": "User", "assistant": "Assistant"}
LEARNED = "assistant"
LEVELS = 2  # as it is, stuffed


def stuffed(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"#(\\*)(?=#)", r"#\\$1"), r"<(\\*)/turn>", r"<\\$1/turn>")


def unstuffed(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"#\\(\\*)(?=#)", r"#$1"), r"<\\(\\*)/turn>", r"<$1/turn>")


def label(role: Column) -> Column:
    known = F.coalesce(*[F.when(role == r, F.lit(name)) for r, name in LABELS.items()])
    return F.coalesce(known, F.concat(F.lit("Role="), F.hex(F.encode(role, "utf-8"))))


def role_of(name: Column) -> Column:
    known = F.coalesce(*[F.when(name == shown, F.lit(r)) for r, shown in LABELS.items()])
    return F.coalesce(known, F.decode(F.unhex(F.substring(name, 6, 1 << 30)), "utf-8"))


def rendered(role: Column, body: Column) -> Column:
    return F.concat(F.lit("### "), label(role), F.lit(": "), body, F.lit(TURN_END))


def parsed(formatted: Column) -> Column:
    """The turns of a rendered conversation as ``array<struct<role, text>>``."""
    pieces = F.filter(F.split(formatted, TURN_END, -1), lambda p: p != "")
    head = r"^### ([A-Za-z]+(?:=[0-9A-F]*)?): "
    return F.transform(
        pieces,
        lambda p: F.struct(
            role_of(F.regexp_extract(p, head, 1)).alias("role"),
            unstuffed(F.substring(p, F.length(F.regexp_extract(p, head, 0)) + 1, F.length(p))).alias("text"),
        ),
    )


def same_turn(role: Column, text: Column, body: Column) -> Column:
    """Whether the grammar gives back exactly this turn from its rendering."""
    return parsed(rendered(role, body)) == F.array(F.struct(role.alias("role"), text.alias("text")))


def clean(text: Column) -> Column:
    """No control string shows in a body, whether or not the grammar would stumble over it."""
    return ~text.contains("###") & ~text.contains("</turn>")


def format_chats(turns: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss)`` for each conversation of ``turns (conv_id, turn, role, text)``.

    ``loss`` holds spans ``(from, to)`` of the assistants' texts in ``formatted``, in code points, the end exclusive. Null
    texts and roles are empty; turns are ordered by turn (null first), role and text, and rows that repeat are turns
    that repeat. Rows with a null conv_id form one conversation. A conversation is one value of the output and has to
    fit in a row.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    role, text, body = F.col("role"), F.col("text"), F.col("body")
    attempts = [text, stuffed(text)]
    good = [clean(a) & same_turn(role, text, a) for a in attempts[:LEVELS]]
    # Level by level: the next form is tried only for turns that did not come back identical.
    chosen = F.when(good[0], attempts[0]).when(good[1], attempts[1]).otherwise(F.raise_error(F.lit("a turn does not survive formatting")))
    tried = rows.select("conv_id", "turn", "role", "text", chosen.cast("string").alias("body"))
    each = tried.select("conv_id", F.struct("turn", "role", "text", "body", rendered(role, body).alias("shown")).alias("t"))
    whole = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    shown = whole.select("conv_id", "ts", F.concat_ws("", F.col("ts.shown")).alias("formatted"))
    # Where each turn ends, as a running sum of lengths.
    ends = F.aggregate(
        "ts", F.array().cast("array<bigint>"), lambda acc, t: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + F.length(t["shown"])))
    )
    placed = shown.select("conv_id", "formatted", F.arrays_zip("ts", ends.alias("end")).alias("placed"), "ts")
    stop = lambda p: p["end"] - len(TURN_END)
    spans = F.transform(
        F.filter("placed", lambda p: p["ts"]["role"] == LEARNED), lambda p: F.struct((stop(p) - F.length(p["ts"]["body"])).alias("from"), stop(p).alias("to"))
    )
    source = F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    checked = placed.withColumn("same", parsed(F.col("formatted")) == source)
    proven = F.when(F.col("same"), F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not survive formatting")).cast("string"))
    return checked.select("conv_id", proven.alias("formatted"), spans.alias("loss"))


def read_chats(chats: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``, all from ``formatted`` and ``loss``."""
    turns = F.transform(parsed(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under = F.transform("loss", lambda s: unstuffed(F.substring(F.col("formatted"), (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int"))))
    read = chats.select("conv_id", turns.alias("turns"), F.concat_ws("", under).alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.concat_ws("", "turns"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )
