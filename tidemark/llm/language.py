"""Language identification by rank-order profiles: a text's most frequent n-grams against each language's, by out-of-place distance.

Letters only, lower-cased, each word between blanks; n-grams of one to three characters within a word, as numbers of 21 bits a
character. The profiles rest on all training rows: every partition counts its n-grams, counts are summed by language and n-gram,
and the first ``PROFILE`` of each language stay."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, field, in_slices, stored

PROFILE = 400
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
#: Characters handled at once: of one text, and of one language's training texts before their counts go out.
SLAB, BATCH = 1 << 20, 4_000_000
BLANK = ord(" ")

Counts = tuple[np.ndarray, np.ndarray]
EMPTY: Counts = (np.empty(0, np.int64), np.empty(0, np.int64))


def summed(parts: list[Counts]) -> Counts:
    """Sums of counts by n-gram, n-grams in order."""
    if len(parts) == 1:
        return parts[0]
    grams, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return grams, np.bincount(where, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)


def gram_counts(text: str | None) -> Counts:
    """The n-grams of a text in order, and how often each occurs."""
    words = LETTERS.findall((text or "").lower())
    if not words:
        return EMPTY
    chars = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    parts = []
    for s in range(0, len(chars), SLAB):
        c = chars[s:s + SLAB + 2].astype(np.int64)
        k = min(SLAB, len(chars) - s)
        one, two = c[:k], (c[:-1] << 21 | c[1:])[:k]
        three = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[:k][c[1:-1][:k] != BLANK]
        grams, n = np.unique(np.concatenate([one[one != BLANK], two, three]), return_counts=True)
        parts.append((grams, n))
    return summed(parts)


def ranked(counts: Counts, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams; of equally frequent ones the smaller number first."""
    return counts[0][np.argsort(-counts[1], kind="stable")[:size]]


def profiles(train: DataFrame, size: int = PROFILE) -> DataFrame:
    """(lang, gram, place): each language's n-grams by rank, from all rows (text, lang) with a lang and a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size_of: dict[str, int] = {}

        def out(lang):
            grams, n = summed(held.pop(lang))
            size_of.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

        for b in in_slices(batches):
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(lang, []).append(gram_counts(text))
                size_of[lang] = size_of.get(lang, 0) + len(text)
                if size_of[lang] > BATCH:
                    yield out(lang)
            while len(held) > 200:
                yield out(next(iter(held)))
        for lang in list(held):
            yield out(lang)

    seen = train.where("lang is not null and text is not null").select("text", "lang").mapInArrow(run, "lang string, gram bigint, n bigint")
    sums = seen.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return sums.withColumn("place", place - 1).where(F.col("place") < size).select("lang", "gram", "place")


def decide(text: str | None, learned: list[tuple[str, np.ndarray, np.ndarray]], size: int) -> tuple[str, float]:
    """The nearest language (the first by name on ties) and one less its share of the greatest distance.

    An n-gram that a profile lacks costs ``size``. ``learned``: language, its n-grams in order, their places."""
    own = ranked(gram_counts(text), size)
    if not learned or not len(own) or not any(map(str.isalpha, text)):  # numerals such as a raised two are no letters
        return UNKNOWN, 0.0
    places, best = np.arange(len(own)), None
    for lang, grams, rank in learned:
        at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        off = int(np.where(grams[at] == own, np.abs(rank[at] - places), size).sum())
        if best is None or off < best[0]:
            best = (off, lang)
    return best[1], round(1 - best[0] / (size * len(own)), 6)


def identify(docs: DataFrame, learned: DataFrame, size: int = PROFILE) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1).

    ``learned`` is the table of ``profiles``: at most ``size`` rows for each language, which go to every worker. Null texts and
    texts without a letter are ``und`` with score 0; without any profile all are. Equal texts get equal results; other columns
    pass through, those named lang_pred or score are replaced."""
    ranks: dict[str, list[tuple[int, int]]] = {}
    for r in learned.toLocalIterator():
        ranks.setdefault(r.lang, []).append((r.gram, r.place))
    table = [(lang, *(np.array(x, np.int64) for x in zip(*sorted(ranks[lang]), strict=True))) for lang in sorted(ranks)]
    held = docs.sparkSession.sparkContext.broadcast(table)

    def make(cols):
        got = [decide(t, held.value, size) for t in cols["text"]]
        return {"lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    return add_columns(docs, [field("lang_pred", "string"), field("score", "double")], make, ["text"])


def split(docs: DataFrame) -> DataFrame:
    """``docs`` with held_out: whether crc32 of doc_id as text leaves 2 on division by 4."""
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))


def train_and_identify(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from the rows that are not held out and have a lang."""
    rows = split(docs.select("doc_id", "text", "lang"))
    learned = stored(profiles(rows.where(~F.col("held_out")), size), "profiles")
    return identify(rows.select("doc_id", "text", "held_out"), learned, size).select("doc_id", "held_out", "lang_pred", "score")
