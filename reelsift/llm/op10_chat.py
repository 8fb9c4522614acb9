r"""Chat formatting with a grammar round trip, in DataFrame operations only.

    conversation = "<s>" turn*        turn = "[INST]" role "[/INST]" text "</s>"

Escaping puts a backslash after the first character of each control string and doubles backslashes. A turn is rendered
as it is, parsed again and compared with its source; a turn that differs or holds a control string is escaped, and only
then. The whole conversation is parsed and compared once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Control strings of the template.
START, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
_CONTROL = r"(<|\[)(s>|/s>|INST\]|/INST\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(CLOSE), text, F.lit(END))


def parsed(formatted: Column) -> Column:
    """The turns of a rendered conversation: array<struct<role, text, raw>>, ``raw`` being the text as it was rendered."""
    pieces = F.split(F.substring(formatted, len(START) + 1, 2147483647), F.lit(r"\Q" + END + r"\E"), F.lit(-1))
    pieces = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substring(piece, len(OPEN) + 1, 2147483647), CLOSE, 1)
        raw = F.substring(piece, F.length(role) + len(OPEN + CLOSE) + 1, F.lit(2147483647))
        return F.struct(unescaped(role).alias("role"), unescaped(raw).alias("text"), raw.alias("raw"))

    return F.transform(pieces, turn)


def _round_trips(role: Column, text: Column) -> Column:
    """Whether a turn, rendered as it is, parses to itself and nothing else, with no control string in its role or text."""
    found = parsed(F.concat(F.lit(START), _rendered(role, text)))
    return ~role.rlike(_CONTROL) & ~text.rlike(_CONTROL) & (F.size(found) == 1) & found[0]["role"].eqNullSafe(role) & found[0]["text"].eqNullSafe(text)


def format_conversations(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learned: str = "assistant"
) -> DataFrame:
    """One row for each conversation: its id, n_turns (long), formatted (string), loss_mask (array<struct<turn, start, length>>), exact (boolean).

    Turns are in order of turn, role and text, nulls first; ties are equal rows, and repeated rows are turns of their
    own. Null roles and texts count as empty. ``loss_mask`` has the code point range of each text whose role is
    ``learned``, in order. ``exact`` says that the conversation parses to its source. Null conversation ids are one
    conversation. Other columns are not kept. An empty table gives an empty table.
    """
    rows = turns.select(F.col(conversation).alias("c"), F.col(turn).alias("t"), F.coalesce(role, F.lit("")).alias("r"), F.coalesce(text, F.lit("")).alias("x"))
    plain = _round_trips(F.col("r"), F.col("x"))
    rows = rows.withColumn("plain", F.when(F.col("x").rlike(r"[<\[\\]") | F.col("r").rlike(r"[<\[\\]"), plain).otherwise(True))
    rows = rows.withColumn("er", F.when(F.col("plain"), F.col("r")).otherwise(escaped(F.col("r"))))
    rows = rows.withColumn("ex", F.when(F.col("plain"), F.col("x")).otherwise(escaped(F.col("x"))))
    rows = rows.withColumn("shown", _rendered(F.col("er"), F.col("ex")))
    order = Window.partitionBy("c").orderBy("t", "r", "x")
    before = F.coalesce(F.sum(F.length("shown")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("start", before + F.length("er") + len(START + OPEN + CLOSE)).withColumn("n", F.row_number().over(order))
    item = F.struct("n", "r", "x", "shown", F.struct((F.col("n") - 1).alias("turn"), F.col("start"), F.length("ex").alias("length")).alias("span"))
    out = rows.groupBy("c").agg(F.array_sort(F.collect_list(item)).alias("items"))
    out = out.withColumn("formatted", F.concat(F.lit(START), F.array_join(F.transform("items", lambda i: i["shown"]), "")))
    source = F.transform("items", lambda i: F.struct(i["r"].alias("role"), i["x"].alias("text")))
    again = F.transform(parsed(F.col("formatted")), lambda i: F.struct(i["role"].alias("role"), i["text"].alias("text")))
    mask = F.transform(F.filter("items", lambda i: i["r"] == learned), lambda i: i["span"])
    return out.select(F.col("c").alias(conversation), F.size("items").cast("long").alias("n_turns"), "formatted", mask.alias("loss_mask"), (again == source).alias("exact"))


def loss_text(formatted: Column, turns: Column, mask: Column) -> Column:
    """The text under the loss mask, read from the rendered string and unescaped.

    A range that is a parsed turn's own text, as long as the turn's, is taken from there; any other is cut out.
    """

    def one(m: Column) -> Column:
        own = F.get(turns, m["turn"])
        return F.when(F.length(own["raw"]) == m["length"], own["text"]).otherwise(unescaped(F.substring(formatted, m["start"].cast("int") + 1, m["length"])))

    return F.array_join(F.transform(mask, one), "")


def digests(chats: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """What the rendered conversations hold, read back from them."""
    rows = chats.select("*", parsed(F.col("formatted")).alias("turns"))
    rows = rows.withColumn("loss", loss_text(F.col("formatted"), F.col("turns"), F.col("loss_mask")))
    said = F.array_join(F.transform("turns", lambda i: F.concat(i["role"], F.lit("\n"), i["text"], F.lit("\n"))), "")
    return rows.select(
        conversation, F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
