"""Chat formatting in Spark expressions: sorted turn structs, same-role neighbours in one block, a reversible template.

``<|im_start|>role`` and a newline open a block, ``<|turn|>`` parts the turns of a block, ``<|im_end|>`` and a newline close it.
In texts and roles a backslash is doubled and ``<|`` becomes ``<\\|``, so that no control string can come from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TURN, END, NEWLINE = "<|im_start|>", "<|turn|>", "<|im_end|>\n", "<|nl|>"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Undoes ``escape``: every run of backslashes is even but for the one that follows ``<`` and precedes ``|``."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def formatted(turns: DataFrame, trained: str = TRAINED) -> DataFrame:
    """One row per conv_id: ``segments`` (text, loss) in order, and ``formatted``, their concatenation.

    ``turns``: conv_id, turn, role, text; other columns are left out. Turns are ordered by turn, then role, then text, nulls
    first; repeated rows are repeated turns; null text or role counts as empty; a null conv_id is a conversation like any other; an
    empty table gives none. ``loss`` marks the texts of role ``trained``. A conversation becomes one row, so its texts are gathered
    once, as structs; all later steps are linear in them."""
    packed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))

    def pieces(t: Column, i: Column) -> Column:
        same = (i > 0) & (F.get("turns", i - 1)["role"] == t["role"])
        opens = F.when(same, F.lit(TURN)).otherwise(F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")))
        closes = F.when(F.coalesce(F.get("turns", i + 1)["role"] == t["role"], F.lit(False)), F.lit("")).otherwise(F.lit(END))
        return F.array(F.struct(opens.alias("text"), F.lit(False).alias("loss")), F.struct(escape(t["text"]).alias("text"), (t["role"] == trained).alias("loss")),
                       F.struct(closes.alias("text"), F.lit(False).alias("loss")))

    out = packed.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parsed(text: Column) -> Column:
    """The turns (role, text) read back from a formatted conversation."""
    blocks = F.filter(F.split(text, r"<\|im_end\|>\n", -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = unescape_role(F.substring(head, F.lit(len(START) + 1), F.length(head)))
        body = F.substring(block, F.length(head) + 2, F.length(block))
        return F.transform(F.split(body, r"<\|turn\|>", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def under_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
