"""Chat formatting with a grammar round trip (operator 1).  DataFrame functions only.

Grammar of a rendered conversation::

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

Texts are rendered as they are, parsed back by the deterministic parser below and compared with
their source.  Only where the two differ is content escaped: first the turns that conflict by
themselves, then, if the whole conversation still reads differently, all of its turns.

Escapes: a control string in a text gets one more backslash after its ``<`` (reading takes one
away), so any depth survives; in a role ``%``, line feed and ``<`` are percent-encoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
CLOSE = END + "\n"
_CONTROL = r"<(\\*)\|(im_start|im_end)\|>"
_ESCAPED = r"<(\\*)\\\|(im_start|im_end)\|>"
_ROLE = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"))


def escape_text(c: Column) -> Column:
    return F.regexp_replace(c, _CONTROL, r"<$1\\|$2|>")


def unescape_text(c: Column) -> Column:
    return F.regexp_replace(c, _ESCAPED, "<$1|$2|>")


def escape_role(c: Column) -> Column:
    for plain, code in _ROLE:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape_role(c: Column) -> Column:
    for plain, code in reversed(_ROLE):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """Turns read from rendered text: array of ``(role, text)``, a null element where a piece
    does not follow the grammar, null where the text does not begin with a turn."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    bodies = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: F.when(
        F.endswith(p, F.lit(CLOSE)), F.substring(p, F.lit(1), F.length(p) - len(CLOSE))))
    turns = F.transform(bodies, lambda b: F.when(
        F.contains(b, F.lit("\n")) & ~F.contains(b, F.lit(END)), F.struct(
            unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            unescape_text(F.substring(b, F.length(F.substring_index(b, "\n", 1)) + 2, F.length(b))).alias("text"))))
    return F.when(F.get(pieces, 0) == "", turns)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_col``, ``formatted``, ``turns`` (read back from it) and
    ``loss_spans`` (1-based start and length, in code points of ``formatted``, of the texts whose
    role is ``loss_role``).

    Defined results: turns are ordered by (turn, role, text), nulls first, so ties and repeated
    rows have a place of their own; null roles and texts are empty; null conversation ids form
    one conversation; an empty table gives no row; other columns are ignored.  A conversation is
    one string by nature of the output, so one has to fit a row (2 GB).  A conversation that does
    not read back as its source raises an error instead of being written.
    """
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    source = F.array(F.struct("role", "text"))
    rows = rows.withColumn("escaped", ~F.coalesce(parse(render(F.col("role"), F.col("text"))) == source, F.lit(False)))

    def written(role, text, escaped):
        return (F.when(escaped, escape_role(role)).otherwise(role), F.when(escaped, escape_text(text)).otherwise(text))

    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name, escaped in (("some", F.col("escaped")), ("all", F.lit(True))):
        role, text = written(F.col("role"), F.col("text"), escaped)
        rows = rows.withColumns({f"{name}_n": F.length(text).cast("long"),
                                 f"{name}_all": F.length(render(role, text)).cast("long")})
    # where each text starts, under either way of escaping
    rows = rows.select("conv", "role", "text", "escaped", "some_n", "all_n", F.row_number().over(order).alias("at"), *[
        (F.sum(f"{n}_all").over(upto) - F.col(f"{n}_n") - len(CLOSE) + 1).alias(f"{n}_start") for n in ("some", "all")])
    chats = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(
        "at", "role", "text", "escaped", "some_start", "some_n", "all_start", "all_n"))).alias("src"))

    def joined(escaped):
        return F.array_join(F.transform("src", lambda t: render(*written(t["role"], t["text"], escaped(t)))), "")

    plain = F.transform("src", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    chats = chats.withColumns({"plain": plain, "some": joined(lambda t: t["escaped"])})
    chats = chats.withColumn("same", F.coalesce(parse(F.col("some")) == F.col("plain"), F.lit(False)))
    chats = chats.withColumn("formatted", F.when(F.col("same"), F.col("some")).otherwise(joined(lambda t: F.lit(True))))
    chats = chats.withColumn("read", parse(F.col("formatted")))
    loss = F.transform(F.filter("src", lambda t: t["role"] == loss_role), lambda t: F.struct(
        F.when(F.col("same"), t["some_start"]).otherwise(t["all_start"]).alias("start"),
        F.when(F.col("same"), t["some_n"]).otherwise(t["all_n"]).alias("length")))
    return chats.select(
        F.col("conv").alias(conv_col), "formatted",
        F.when(F.col("read") == F.col("plain"), F.col("read")).otherwise(
            F.raise_error(F.lit("a conversation does not read back as its source"))).alias("turns"),
        loss.alias("loss_spans"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape_text(
        F.substring(formatted, s["start"].cast("int"), s["length"].cast("int")))), "")
