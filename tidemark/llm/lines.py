"""Lines that many documents share: explode, hash, count documents, drop, put together again by position.

Spark expressions throughout. A line's key is the line without blanks at either end and with A-Z in lower case; 128 bits of its
SHA-256 stand for it, so long lines cost no more than short ones to move."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered_repeats, stored, text_of

BLANKS = " \t\n\x0b\x0c\r"


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def drop_shared_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` (bigint) and ``kept``, the text of the lines that stay, joined by a newline.

    A line whose key has at least ``least_chars`` code points and stands in at least ``least_docs`` documents goes, but for the lines
    of the largest doc_id that holds it. Documents are told apart by doc_id: rows that share one count once and keep their lines
    together; a null doc_id is one document below all others. Null and empty texts are one empty line. Repeated rows come out
    repeated. Other columns pass through; one that bears the name of a new column, or starts with ``_line``, is replaced.

    Each (key, document) is one row before keys are counted, so a line in a third of all documents is dealt out by document first and
    arrives at its count as partial sums. Both tables are written, so texts are split once and the join of a common line with its
    documents lies between plain exchanges, which adaptive execution splits. Only places of dropped lines go back to their documents;
    the text moves once."""
    new = ("n_lines", "n_dropped", "kept", "_seq")
    rows = docs.select(*[c for c in docs.columns if c.lower() not in new and not c.startswith("_line")])
    rows = numbered_repeats(rows, key, text)
    lines = F.transform(split_lines(text_of(text)), lambda line, i: F.struct(i.alias("at"), line_key(line).alias("key")))
    long = F.transform(F.filter(lines, lambda x: F.char_length(x["key"]) >= least_chars), lambda x: F.struct(
        x["at"].alias("at"), F.substring(F.unhex(F.sha2(x["key"], 256)), 1, 16).alias("hash")))
    each = rows.select(F.col(key).alias("_line_doc"), F.col("_seq").alias("_line_seq"), F.explode(long).alias("x")).select("_line_doc", "_line_seq", "x.*")
    held = stored(each.groupBy("hash", "_line_doc").agg(F.collect_set(F.struct("_line_seq", "at")).alias("places")), "held")
    shared = stored(held.groupBy("hash").agg(F.count("*").alias("n"), F.max("_line_doc").alias("stays")).where(F.col("n") >= least_docs).drop("n"), "shared")
    gone = held.join(shared, "hash").where(~F.col("_line_doc").eqNullSafe(F.col("stays"))).select("_line_doc", F.explode("places").alias("p"))
    gone = gone.groupBy("_line_doc", F.col("p._line_seq").alias("_line_seq")).agg(F.collect_list("p.at").alias("_line_gone"))
    out = rows.join(gone, F.col(key).eqNullSafe(F.col("_line_doc")) & (F.col("_seq") == F.col("_line_seq")), "left")
    parts = out.withColumn("_line_all", split_lines(text_of(text)))
    last = F.size("_line_all") - 1
    # both lists hold each place once, and array_except is linear in them
    left = F.array_except(F.sequence(F.lit(0), last), F.coalesce("_line_gone", F.array().cast("array<int>")))
    kept = F.array_join(F.transform(left, lambda i: F.get("_line_all", i)), "\n")
    return parts.select(*[c for c in rows.columns if c != "_seq"], F.size("_line_all").cast("bigint").alias("n_lines"),
                        F.size(F.coalesce("_line_gone", F.array().cast("array<int>"))).cast("bigint").alias("n_dropped"), kept.alias("kept"))
