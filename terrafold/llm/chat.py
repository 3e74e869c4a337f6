"""Chat rendering with a grammar round trip; native expressions only.

A turn is ``<|im_start|>role\\n``, the body, ``<|im_end|>\\n``. The parser splits at the start mark,
takes the role up to the line end and the body up to the end mark, and undoes the escapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.shared import let, running

# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"

#: The levels of escaping, tried in order until the parse gives the source back. The parser undoes
#: the escapes at every level: so a plain rendering that has marks or the escape character in a
#: text is found to differ, and at the last level no text can hold a mark or a bare escape.
LEVELS = (0, 1, 2)


def _escape(text: Column, level: int, line: bool = False) -> Column:
    if level == 2:
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    if level:
        text = F.replace(text, F.lit("<|"), F.lit("<\\|"))
    if line and level == 2:
        text = F.replace(text, F.lit("\n"), F.lit("\\n"))
    return text


def _unescape(text: Column, line: bool = False) -> Column:
    """Undoes both escapes. An escaped escape is set aside as a code point that no rendered text
    holds on its own: it is itself written as escape and digit meanwhile."""
    aside = F.replace(F.replace(text, F.lit("\x00"), F.lit("\x000")), F.lit("\\\\"), F.lit("\x001"))
    if line:
        aside = F.replace(aside, F.lit("\\n"), F.lit("\n"))
    back = F.replace(F.replace(aside, F.lit("<\\|"), F.lit("<|")), F.lit("\x001"), F.lit("\\"))
    return F.replace(back, F.lit("\x000"), F.lit("\x00"))


def _render(turns: Column, level: int) -> Column:
    one = lambda t: F.concat(F.lit(START), _escape(t["role"], level, True), F.lit("\n"), _escape(t["text"], level), F.lit(END + "\n"))
    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a rendered conversation; null where it isn't one."""
    chunks = F.split(formatted, r"\Q" + START + r"\E", -1)
    rest = F.slice(chunks, F.lit(2), F.greatest(F.size(chunks) - 1, F.lit(0)))
    tail = END + "\n"
    good = (F.element_at(chunks, 1) == "") & F.forall(
        rest, lambda c: c.endswith(F.lit(tail)) & (F.locate("\n", c) > 0) & (F.length(F.replace(c, F.lit(END))) == F.length(c) - len(END))
    )

    def turn(c: Column) -> Column:
        line = F.locate("\n", c)
        body = F.substring(c, line + 1, F.length(c) - line - len(tail))
        return F.struct(_unescape(F.substring(c, F.lit(1), line - 1), True).alias("role"), _unescape(body).alias("text"))

    return F.when(good, F.transform(rest, turn))


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): array<struct<role, text>> in the order of turn.

    Null text or role is empty; rows with a null turn come first, ties are ordered by role and
    text; repeated rows are turns like others; null ids are one conversation.
    """
    each = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    grouped = rows.groupBy(F.col(conv).alias("conv_id")).agg(F.array_sort(F.collect_list(each)).alias("rows"))
    return grouped.select("conv_id", F.transform("rows", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def render(convs: DataFrame) -> DataFrame:
    """(conv_id, turns) to (conv_id, formatted, level): the first level whose parse is the source."""
    out = convs.withColumn("formatted", F.lit(None).cast("string")).withColumn("level", F.lit(None).cast("int"))
    for level in LEVELS:
        out = out.withColumn("tried", F.when(F.col("formatted").isNull(), _render(F.col("turns"), level)))
        same = F.coalesce(parse(F.col("tried")) == F.col("turns"), F.lit(False))
        out = out.withColumn("level", F.when(F.col("formatted").isNull() & same, F.lit(level)).otherwise(F.col("level")))
        out = out.withColumn("formatted", F.when(F.col("level") == level, F.col("tried")).otherwise(F.col("formatted")))
    return out.select("conv_id", "formatted", "level")


def _chunks(formatted: Column) -> Column:
    chunks = F.split(formatted, r"\Q" + START + r"\E", -1)
    return F.slice(chunks, F.lit(2), F.greatest(F.size(chunks) - 1, F.lit(0)))


def _masked(formatted: Column, learned: str) -> Column:
    """array<struct<start, length, body>> of the bodies to learn, escaped, as they stand in ``formatted``."""

    def spans(rest: Column) -> Column:
        ends = running(F.transform(rest, lambda c: (F.length(c) + len(START)).cast("bigint")), lambda x, y: x + y)

        def span(x: Column) -> Column:
            c, line = x["c"], F.locate("\n", x["c"])
            length = F.length(c) - line - len(END) - 1
            return F.struct(
                (x["end"] - F.length(c) + line).cast("bigint").alias("start"), length.cast("bigint").alias("length"), F.substring(c, line + 1, length).alias("body"), (_unescape(F.substring(c, F.lit(1), line - 1), True) == learned).alias("mine")
            )

        return F.filter(F.transform(F.arrays_zip(rest.alias("c"), ends.alias("end")), span), lambda x: x["mine"])

    return let(_chunks(formatted), spans)


def loss_spans(formatted: Column, learned: str = "assistant") -> Column:
    """array<struct<start, length>> of the escaped bodies to learn, in code points of ``formatted``."""
    return F.transform(_masked(formatted, learned), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))


def format_chats(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, level, loss_spans, loss_text, turns): rendered conversations, the spans
    to learn, and turns and learned text as read back from the rendering.

    Null texts, roles and ids, ties and repeated rows are as in ``conversations``; other columns are
    not read, whatever their names; an empty table gives no rows.
    """
    made = render(conversations(rows, conv, turn, role, text))
    masked = made.withColumn("masked", _masked(F.col("formatted"), "assistant")).withColumn("turns", parse(F.col("formatted")))
    spans = F.transform("masked", lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
    learned = F.array_join(F.transform("masked", lambda x: _unescape(x["body"])), "")
    return masked.select("conv_id", "formatted", "level", spans.alias("loss_spans"), learned.alias("loss_text"), "turns")
