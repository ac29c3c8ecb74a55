"""Conversations as training text, in budgeted windows.

Every turn is rendered between marks, ``### Role: text </turn>`` and a line break, with the marks inside texts escaped
so that they can be read back. Running sums of turn tokens cut a conversation into spans of whole turns; a window holds
the conversation's system turn, a limited history of turns before its span, and the span. The loss mask covers the
assistant texts of the span; those that the history repeats are masked, so each is learned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearcurve.llm.work import WORD, stage

BUDGET = 2048
HISTORY = 512
#: Turns of a conversation whose tokens are summed by one task.
BLOCK_TURNS = 1 << 16
END = " </turn>\n"
ROLES = {"user": "User", "assistant": "Assistant", "system": "System"}


def escape(text: Column) -> Column:
    """Marks written without their own letters; every backslash of the result starts an escape."""
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    out = F.replace(out, F.lit("###"), F.lit("\\h"))
    return F.replace(out, F.lit("</turn>"), F.lit("\\t"))


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\t"), F.lit("</turn>"))
    out = F.replace(out, F.lit("\\h"), F.lit("###"))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def _title(role: Column) -> Column:
    """Known roles by their titles; others as they are, behind an equals sign, without colons."""
    out = F.concat(F.lit("="), F.replace(escape(role), F.lit(":"), F.lit("\\c")))
    for name, title in ROLES.items():
        out = F.when(role == name, title).otherwise(out)
    return out


def _role(title: Column) -> Column:
    out = unescape(F.replace(F.substring(title, 2, 1 << 30), F.lit("\\c"), F.lit(":")))
    for name, shown in ROLES.items():
        out = F.when(title == shown, name).otherwise(out)
    return out


def tokens(text: Column) -> Column:
    """Tokens of a turn: its words and four for its marks. Any other count will do."""
    return (F.regexp_count(text, F.lit(WORD)) + 4).cast("long")


def _placed(turns: DataFrame) -> DataFrame:
    """``turns`` with ``before``, the tokens of the conversation's turns before each, their place ``at`` in a block of
    turns, and ``first``, the turn that opens the conversation, if it is a system turn.

    Texts are moved once, by conversation and block; what a block needs of the others is summed beside them.
    """
    key = ["c", "is_null"]
    system = F.col("role") == "system"
    opening = F.struct("turn", "role", "text", F.when(system, F.struct("head", "body", "tokens")).alias("system"))
    blocks = turns.groupBy(*key, "block").agg(F.sum("tokens").alias("total"), F.min(opening).alias("opening"))
    along = Window.partitionBy(*key).orderBy("block")
    opened = F.first(F.struct("block", "opening.system")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    bases = blocks.select(
        *key,
        "block",
        F.coalesce(F.sum("total").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        opened.alias("first"),
    )
    within = Window.partitionBy(*key, "block").orderBy("turn", "role", "text")
    own = F.coalesce(F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = turns.withColumn("own", own).withColumn("at", F.row_number().over(within))
    return numbered.join(bases, [*key, "block"]).withColumn("before", F.col("base") + F.col("own")).drop("base", "own")


def windows(turns: DataFrame, *, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """``conv_id``, ``window``, ``text``, ``targets`` (text), ``spans`` of the loss mask and ``turns`` of each window.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``. Null texts and roles are empty; null ids are one
    conversation; turns of equal number are ordered by role and text, repeated rows are turns of their own. Null turn
    numbers come first. A span's turns start within one stretch of ``budget - history`` less the system turn, halved,
    so a window keeps the budget unless one of its turns alone takes more than that half. History is the turns before
    the span that start within ``history`` tokens of it. No turn is cut.
    """
    one = turns.select(
        "conv_id",
        F.coalesce("conv_id", F.lit(0)).alias("c"),
        F.col("conv_id").isNull().alias("is_null"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    head, body = F.concat(F.lit("### "), _title(F.col("role")), F.lit(": ")), escape(F.col("text"))
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62)))
    one = one.withColumns({"head": head, "body": body, "tokens": tokens(body), "block": block})
    system = F.col("first.system")
    held = F.coalesce(system["tokens"], F.lit(0))
    stretch = F.greatest(F.lit(1), F.floor((budget - history - held) / 2))
    opens = system.isNotNull() & (F.col("block") == F.col("first.block")) & (F.col("at") == 1)
    # A system turn that opens its conversation is repeated in every window.
    own = _placed(one).withColumns({"is_system": opens, "stretch": stretch})
    own = own.withColumn("window", F.floor(F.col("before") / F.col("stretch")))
    # A turn is in its own window, and in the next ones that start within the history after it.
    reach = F.floor((F.col("before") + history) / F.col("stretch"))
    seats = F.when(F.col("is_system"), F.array("window")).otherwise(F.sequence("window", F.greatest("window", reach)))
    seated = own.withColumn("seat", F.explode(seats))
    repeated = F.col("seat") > F.col("window")
    learned = (F.col("role") == "assistant") & ~repeated
    part = F.struct(
        "block", "at", repeated.alias("repeated"), "is_system", learned.alias("learned"), "head", "body"
    )
    grouped = seated.groupBy("conv_id", "seat").agg(
        F.sort_array(F.collect_list(part)).alias("parts"),
        F.first(F.concat(system["head"], system["body"], F.lit(END))).alias("system"),
    )
    # A window of repeated turns alone has nothing of its own.
    grouped = grouped.filter(F.exists("parts", lambda p: ~p["repeated"]))
    lead = F.when(F.exists("parts", lambda p: p["is_system"]), F.lit("")).otherwise(F.coalesce("system", F.lit("")))
    spans = F.aggregate(
        "parts",
        F.struct(F.char_length("lead").alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.char_length(p["head"]) + F.char_length(p["body"]) + len(END)).alias("at"),
            F.when(
                p["learned"],
                F.concat(
                    a["spans"],
                    F.array(
                        F.struct(
                            (a["at"] + F.char_length(p["head"])).alias("begin"),
                            (a["at"] + F.char_length(p["head"]) + F.char_length(p["body"])).alias("end"),
                        )
                    ),
                ),
            ).otherwise(a["spans"]).alias("spans"),
        ),
    )["spans"]
    laid = grouped.withColumn("lead", lead)
    return laid.select(
        "conv_id",
        F.col("seat").alias("window"),
        F.concat("lead", F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")).alias("text"),
        spans.alias("spans"),
        # Turns that are only repeated in this window, the system turn among them.
        (F.size(F.filter("parts", lambda p: p["repeated"])) + (F.col("lead") != "").cast("int")).alias("n_repeated"),
    )


def parse(text: Column) -> Column:
    """Turns of a window's text: ``role``, ``text``."""
    parts = F.split(text, F.lit(END.rstrip("\n") + r"\n"), -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        cut = F.locate(": ", part)
        return F.struct(
            _role(F.substring(part, F.lit(5), cut - 5)).alias("role"),
            unescape(F.substring(part, cut + 2, F.lit(1 << 30))).alias("text"),
        )

    return F.transform(parts, turn)


def targets(text: Column, spans: Column) -> Column:
    """The texts under the mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(text, s["begin"] + 1, s["end"] - s["begin"])))


def digest(made: DataFrame) -> DataFrame:
    """What windows say of each conversation, read back from their texts and masks."""
    read = made.select(
        "conv_id",
        "window",
        parse(F.col("text")).alias("all"),
        "n_repeated",
        targets(F.col("text"), F.col("spans")).alias("learned"),
        F.char_length("text").cast("long").alias("chars"),
    )
    own = F.slice("all", F.col("n_repeated") + 1, F.size("all"))
    # System, history, span: what a window repeats comes before what is its own.
    parts = read.select("conv_id", "window", own.alias("own"), F.array_join("learned", "").alias("learned"), "chars")
    whole = parts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "own", "learned"))).alias("w"), F.sum("chars").alias("formatted_chars")
    )
    turns = F.flatten(F.transform("w", lambda x: x["own"]))
    joined = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("w", lambda x: x["learned"]), "")
    return whole.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def round_trip(turns: DataFrame, **options) -> DataFrame:
    """Write the windows of all conversations, read them back, and say what they hold."""
    return digest(stage(windows(turns, **options), "windows"))
