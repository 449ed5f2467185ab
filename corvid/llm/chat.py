"""Chat formatting with typed content parts (DataFrame functions only).

A turn's content is an ordered list of parts ``struct<type, text, ref, units>``. A visitor
(one ``transform`` over the parts) writes a text part as its escaped text and any other
part as a placeholder, and records an attachment with its reference and the number of
tokens its placeholder expands to:

* image: ``units`` pixels, one token per started 28 x 28 patch, plus 2 for its borders;
* audio: ``units`` milliseconds, one token per started 40 ms;
* document: ``units`` pages, 256 tokens per page.

Template: ``<s>`` once, then per turn ``[INST] role\\n text [/INST]``; an assistant's turn
ends with ``</s>`` after its mark. The marks ``<s> </s> [INST] [/INST] <|...`` that appear
inside a text or role are escaped reversibly: the backslash becomes ``\\\\``, the first
character of a mark becomes ``\\l`` or ``\\b``. Escaped text holds no mark, so the output
splits back into turns without counting.

Turns of a conversation meet in one row, its formatted string, which is the feature (a
conversation is one value); their places in it are running sums of a window over the same
exchange, so the work is linear in the turns. Null text or parts: empty content. Null role: the
empty role. Turns with equal numbers: by role, then text as it was given (of parts: as they are
written), then attachments; null turn numbers come last. A null conversation id is a conversation of its own. Unknown
part types are kept as placeholders without tokens. An empty table gives an empty result.
Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
PATCH_PIXELS, AUDIO_MS, PAGE_TOKENS = 28 * 28, 40, 256
PART = "struct<type:string,text:string,ref:string,units:bigint>"
LEARN = "assistant"


def escape(text: Column) -> Column:
    """Text without any control string."""
    t = F.regexp_replace(text, r"\\", r"\\\\")
    t = F.regexp_replace(t, r"<(/?s>|\|)", r"\\l$1")
    return F.regexp_replace(t, r"\[(/?INST\])", r"\\b$1")


def unescape(text: Column) -> Column:
    """The inverse. A backslash pair is set aside as U+0000 pairs first: a backslash that
    is left can only begin ``\\l`` or ``\\b``. U+0000 itself is guarded the same way."""
    t = F.replace(text, F.lit("\x00"), F.lit("\x000"))
    t = F.replace(t, F.lit("\\\\"), F.lit("\x001"))
    t = F.replace(t, F.lit("\\l"), F.lit("<"))
    t = F.replace(t, F.lit("\\b"), F.lit("["))
    t = F.replace(t, F.lit("\\n"), F.lit("\n"))
    t = F.replace(t, F.lit("\x001"), F.lit("\\"))
    return F.replace(t, F.lit("\x000"), F.lit("\x00"))


def escape_role(role: Column) -> Column:
    """A role is written on the line of its mark, so its line ends are escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def text_parts(text: Column) -> Column:
    """A plain text as a list with one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units")))


def expanded_tokens(kind: Column, units: Column) -> Column:
    """Tokens that a placeholder stands for."""
    n = F.greatest(F.coalesce(units, F.lit(0)), F.lit(0))
    up = lambda per: F.ceil(n / F.lit(per)).cast("bigint")
    return (F.when(kind == "image", up(PATCH_PIXELS) + 2).when(kind == "audio", up(AUDIO_MS))
            .when(kind == "document", n * PAGE_TOKENS).otherwise(F.lit(0).cast("bigint")))


def visit(parts: Column) -> tuple[Column, Column]:
    """The visitor: a turn's content string, and its attachments in order as
    ``array<struct<type, ref, tokens>>``."""
    is_text = lambda p: p["type"] == "text"
    flat = F.transform(parts, lambda p: F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<|"), escape(F.coalesce(p["type"], F.lit("unknown"))), F.lit("|>"))))
    files = F.transform(F.filter(parts, lambda p: ~F.coalesce(is_text(p), F.lit(False))), lambda p: F.struct(
        p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p["type"], p["units"]).alias("tokens")))
    empty = F.array().cast("array<string>")
    return (F.array_join(F.coalesce(flat, empty), ""),
            F.coalesce(files, F.array().cast("array<struct<type:string,ref:string,tokens:bigint>>")))


def format_chat(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str | None = "text", parts: str | None = None, learn: str = LEARN) -> DataFrame:
    """``(conv_id, n_turns, formatted, loss_spans, attachments)``, one row per conversation.
    ``loss_spans`` are ``struct<start, length>`` in characters of ``formatted``: the text of
    every ``learn`` turn, still escaped. Content comes from ``parts`` (``array<PART>``) or
    from the plain ``text`` column."""
    plain = F.coalesce(F.col(text).cast("string"), F.lit("")) if text and not parts else None
    content, files = visit(F.col(parts)) if parts else visit(text_parts(plain))
    name = F.coalesce(F.col(role).cast("string"), F.lit(""))
    one = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).isNull().alias("_late"), F.col(turn).alias("_turn"),
                       name.alias("_role"), (content if parts else plain).alias("_text"), files.alias("_files"))
    # A plain text travels and is ordered as it is, and is escaped on both sides of the exchange.
    inner = F.col("_text") if parts else visit(text_parts(F.col("_text")))[0]
    head = F.concat(F.lit(OPEN + " "), escape_role(F.col("_role")), F.lit("\n"))
    tail = F.concat(F.lit(" " + CLOSE), F.when(F.col("_role") == learn, F.lit(END)).otherwise(""))
    one = one.withColumn("_before", F.length(head).cast("bigint")).withColumn("_inside", F.length(inner).cast("bigint")).withColumn(
        "_whole", F.col("_before") + F.col("_inside") + F.length(tail))
    order = Window.partitionBy("conv_id").orderBy("_late", "_turn", "_role", "_text", "_files")
    begun = F.coalesce(F.sum("_whole").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + len(BEGIN)
    placed = one.withColumn("_n", F.row_number().over(order)).withColumn("_at", begun)
    row = F.struct("_n", F.concat(head, inner, tail).alias("out"), (F.col("_role") == learn).alias("learn"),
                   F.struct((F.col("_at") + F.col("_before")).alias("start"), F.col("_inside").alias("length")).alias("span"), "_files")
    g = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return g.select("conv_id", F.size("rows").cast("bigint").alias("n_turns"),
                    F.concat(F.lit(BEGIN), F.array_join(F.transform("rows", lambda r: r["out"]), "")).alias("formatted"),
                    F.transform(F.filter("rows", lambda r: r["learn"]), lambda r: r["span"]).alias("loss_spans"),
                    F.flatten(F.transform("rows", lambda r: r["_files"])).alias("attachments"))


def parse_chat(formatted: Column) -> Column:
    """The turns read back from the formatted string: ``array<struct<role, text>>``, in
    order and unescaped (placeholders stay in the text)."""
    body = F.filter(F.split(formatted, r"\[INST\] "), lambda _, i: i > 0)
    mark = F.lit("\n")
    return F.transform(body, lambda t: F.struct(
        unescape(F.substring_index(t, "\n", 1)).alias("role"),
        unescape(F.regexp_replace(F.substring(t, F.instr(t, mark) + 1, F.length(t)),
                                  r" \[/INST\](</s>)?\z", "")).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
