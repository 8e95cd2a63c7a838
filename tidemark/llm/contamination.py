"""Benchmark decontamination: one Aho-Corasick automaton over the normalised items, one scan of every text.

Texts are normalised byte by byte (A-Z lower-cased, separators to blanks), so a word keeps its place and matches map back to the original."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import field, in_slices, text_of

WIDTH = 10
#: Bytes of item text that one automaton takes; more items are scanned for in further passes.
BATCH_BYTES = 16_000_000

NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split(b" ")


def windows(text: str | None, width: int = WIDTH) -> list[bytes]:
    """The runs of ``width`` words of an item; all its words if there are fewer."""
    words = [w for w in normal_words(text) if w]
    if not words:
        return []
    return [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]


def automaton(items: list[tuple[int | None, str]], width: int = WIDTH):
    """The automaton, whose matches carry the number of a window, and per window its number of words and its items."""
    import ahocorasick

    known: dict[bytes, set[int]] = {}
    for item, text in items:
        for w in windows(text, width):
            known.setdefault(w, set()).update(() if item is None else (item,))
    auto, info = ahocorasick.Automaton(ahocorasick.STORE_INTS), []
    for w, of in known.items():
        auto.add_word(f" {w.decode('latin-1')} ", len(info))
        info.append((w.count(b" ") + 1, tuple(of)))
    if info:
        auto.make_automaton()
    return auto, info


def matches(auto, info: list, words: list[bytes]) -> list[tuple[int, int, tuple]]:
    """(first word, last word + 1, items) of every occurrence in a text's words."""
    if not info or not words:
        return []
    line = f" {b' '.join(words).decode('latin-1')} "
    found = list(auto.iter(line))
    if not found:
        return []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    last = np.searchsorted(ends, [e for e, _ in found])
    return [(int(k) + 1 - info[v][0], int(k) + 1, info[v][1]) for k, (_, v) in zip(last, found, strict=True)]


def batches_of(items: DataFrame, batch_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items in parts of a bounded size, one part at a time on the driver."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), text_of().alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = -(-size * 2 // batch_bytes) if size > batch_bytes else 1
    for k in range(parts):
        part = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        yield [(r.item_id, r.text) for r in part.toLocalIterator()]


def scan(docs: DataFrame, items: DataFrame, width: int = WIDTH, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items (sorted array), spans (array of char start and end of hit runs), contaminated.

    One scan of the texts without a shuffle; the items are held in bounded parts, and only when they exceed one part are the texts
    scanned once for each. Other columns pass through; those named like a result are replaced. Null text has no words and no hits, on either side; items
    without words are never found; items without an item_id count for hits and contaminated, not in items and n_items; repeated rows get the same result; repeated items count once by item_id."""
    spark: SparkSession = docs.sparkSession
    names = ["n_words", "n_hit", "n_items", "items", "spans", "contaminated", "_hits", "_found"]
    own = [c for c in docs.columns if c.lower() not in names]
    kept = docs.select(*own).withColumn("_hits", F.array().cast("array<bigint>")).withColumn("_found", F.array().cast("array<bigint>"))
    text = next(c for c in own if c.lower() == "text")

    def scanner(held):
        def run(batches):
            auto, info = automaton(held.value, width)
            for b in in_slices(batches):
                hits, found = b.column("_hits").to_pylist(), b.column("_found").to_pylist()
                for i, t in enumerate(b.column(text).to_pylist()):
                    for lo, hi, of in matches(auto, info, [w for w in normal_words(t) if w]):
                        hits[i] += (lo, hi)
                        found[i] = list({*found[i], *of})
                cols = [b.column(c) for c in own] + [pa.array(hits, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=[*own, "_hits", "_found"])

        return run

    for part in batches_of(items, batch_bytes):
        kept = kept.mapInArrow(scanner(spark.sparkContext.broadcast(part)), kept.schema)

    def finish(batches):
        for b in in_slices(batches):
            rows = [verdict(*r) for r in zip(b.column(text).to_pylist(), b.column("_hits").to_pylist(), b.column("_found").to_pylist(), strict=True)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            cols = [b.column(c) for c in own] + [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(cols, names=[*own, *names[:5]])

    schema = T.StructType([docs.schema[c] for c in own] + [field(n, "long") for n in names[:3]] + [
        field("items", "array<bigint>"), field("spans", "array<struct<start:bigint,end:bigint>>")])
    return kept.mapInArrow(finish, schema).withColumn("contaminated", F.col("n_hit") > 0)


def verdict(text: str | None, hits: list[int], found: list[int]) -> tuple:
    """Word counts, items, and the hit runs as character positions in the original text."""
    pieces = normal_words(text)
    words = [(i, w) for i, w in enumerate(pieces) if w]
    if not hits:
        return len(words), 0, 0, [], []
    mark = np.zeros(len(words) + 1, np.int64)
    np.add.at(mark, hits[0::2], 1)
    np.add.at(mark, hits[1::2], -1)
    hit = np.cumsum(mark)[:-1] > 0
    begins = np.cumsum([0] + [len(p) + 1 for p in pieces])
    raw = (text or "").encode("utf-8", "surrogatepass")
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    spans, at, chars = [], 0, 0
    for lo, hi in zip(edge[0::2], edge[1::2], strict=True):
        ends = []
        for byte in (int(begins[words[lo][0]]), int(begins[words[hi - 1][0]]) + len(words[hi - 1][1])):
            chars += len(raw[at:byte].decode("utf-8", "surrogatepass"))
            at = byte
            ends.append(chars)
        spans.append({"start": ends[0], "end": ends[1]})
    return len(words), int(hit.sum()), len(found), sorted(found, key=str), spans


def items_digest(items: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, items)).encode()).hexdigest()


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a benchmark window, in the columns of ``docs``."""
    return scan(docs, items).where("not contaminated").select(*docs.columns)
