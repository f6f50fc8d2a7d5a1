"""Chat formatting from typed content parts, with a loss mask that can be read back.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts a backslash is
doubled and ``<|`` becomes ``<\\|``, so that a control string never comes from a
text and every text can be restored. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's control strings.
START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PART_TYPE = "array<struct<type:string,text:string,uri:string,tokens:int>>"


def escape(text: Column) -> Column:
    """Makes a text safe inside the template; a null is empty."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given."""
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def text_part(text: Column) -> Column:
    """A content array of one text part."""
    part = F.struct(
        F.lit("text").alias("type"), text.alias("text"),
        F.lit(None).cast("string").alias("uri"), F.lit(None).cast("int").alias("tokens"),
    )
    return F.array(part)


def visit_parts(parts: Column) -> Column:
    """Flattens content parts into struct(body, attachments, expanded_tokens).

    Texts are escaped as if adjacent ones were one text, so that a control string
    does not come from several parts either. An image, audio or document part becomes its
    placeholder; its type, uri, token count and character place in the body are
    recorded in order in ``attachments`` and its tokens (a null counts 1) are
    summed. A part of another or no type is taken as text. Null parts are skipped.
    """
    known = F.create_map(*(F.lit(x) for pair in PLACEHOLDERS.items() for x in pair))
    parts = F.filter(F.coalesce(parts, F.array().cast(PART_TYPE)), lambda p: p.isNotNull())
    empty = F.struct(
        F.lit("").alias("body"),
        F.array().cast("array<struct<type:string,uri:string,tokens:int,at:int>>").alias("attachments"),
        F.lit(0).cast("bigint").alias("expanded_tokens"),
    )

    def step(done: Column, part: Column) -> Column:
        mark = F.element_at(known, F.coalesce(part.type, F.lit("text")))
        tokens = F.coalesce(part.tokens, F.lit(1))
        text = escape(part.text)
        # a "<" that ended the last text and a "|" that begins this one
        meets = F.endswith(done.body, F.lit("<")) & F.startswith(text, F.lit("|"))
        text = F.when(meets, F.concat(F.lit("\\"), text)).otherwise(text)
        noted = F.array(F.struct(part.type.alias("type"), part.uri.alias("uri"), tokens.alias("tokens"), F.length(done.body).alias("at")))
        return F.struct(
            F.concat(done.body, F.coalesce(mark, text)).alias("body"),
            F.when(mark.isNull(), done.attachments).otherwise(F.concat(done.attachments, noted)).alias("attachments"),
            (done.expanded_tokens + F.when(mark.isNull(), 0).otherwise(tokens)).alias("expanded_tokens"),
        )

    return F.aggregate(parts, empty, step)


def format_turns(turns: DataFrame, parts: Column) -> DataFrame:
    """One formatted turn per row: (conv_id, turn, role, segment, head, body, attachments, expanded_tokens).

    ``head`` and ``body`` are the lengths before and of the content. A null role
    is empty. This needs no shuffle, so a hot conversation costs nothing here.
    """
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit(NEWLINE))
    opening = F.concat(F.lit(START), role, F.lit("\n"))
    seen = turns.select("conv_id", "turn", "role", opening.alias("opening"), visit_parts(parts).alias("content"))
    return seen.select(
        "conv_id",
        "turn",
        "role",
        F.concat("opening", "content.body", F.lit(END + "\n")).alias("segment"),
        F.length("opening").alias("head"),
        F.length("content.body").alias("body"),
        "content.attachments",
        "content.expanded_tokens",
    )


def format_conversations(turns: DataFrame, parts: Column | None = None, trained_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans, attachments, expanded_tokens) per conversation.

    ``turns`` has conv_id, turn, role and text; ``parts`` gives the typed content
    and is the text alone by default. ``loss_spans`` are struct(start, length) in
    code points over the contents of the trained role's turns. Turns are ordered
    by number, nulls first, and rows with the same number by role and formatted
    content; repeated rows are repeated turns. Rows without conv_id form a conversation.
    Texts may be empty or as long as a row holds; further columns are ignored.
    A conversation is one text by its nature, so the turns are formatted before
    they are brought together; it must fit in a row of 2 GB. An empty table gives no rows.
    """
    pieces = format_turns(turns, text_part(F.col("text")) if parts is None else parts)
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "segment").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("at", F.coalesce(F.sum(F.length("segment")).over(so_far), F.lit(0)))
    order = F.struct("at", "role", "segment", "head", "body", "attachments", "expanded_tokens")
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(order)).alias("turns"))
    trained = F.filter("turns", lambda t: t.role == trained_role)
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t.segment), "").alias("formatted"),
        F.transform(
            trained, lambda t: F.struct((t.at + t.head).cast("int").alias("start"), t.body.alias("length"))
        ).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t.attachments)).alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("bigint"), lambda n, t: n + t.expanded_tokens).alias("expanded_tokens"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of struct(role, text)."""
    whole = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda piece: piece != "")

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
        cut = F.instr(body, "\n")
        role = F.replace(F.substring(body, F.lit(1), cut - 1), F.lit(NEWLINE), F.lit("\n"))
        text = F.substring(body, cut + 1, F.length(body))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(whole, turn)


def text_under_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, joined."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s.start + 1, s.length))), "")


def digest(conversations: DataFrame) -> DataFrame:
    """What the query returns, read back from the formatted text alone."""
    read = conversations.select(
        "conv_id",
        "formatted",
        parse_turns(F.col("formatted")).alias("turns"),
        text_under_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(plain.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
