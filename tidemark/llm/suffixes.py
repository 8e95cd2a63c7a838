"""Repeated passages by a distributed, sampled suffix array.

A byte goes if a string of ``length`` bytes that covers it also starts earlier. Sorting the suffix at every byte would move each text
a hundred times over, so suffixes are sampled by content: the window of ``length`` bytes at each place picks one anchor, the least hash
of ``LEAD`` bytes in it, and equal windows pick equal anchors. Anchors whose leading bytes occur once in the corpus can be part of
no repeat. The suffixes at the others, with the bytes their windows reach, are range-partitioned by leading bytes with sampled
splitters; each bucket sorts its suffixes by multikey quicksort, eight bytes to a key, first the whole contexts, so that copies fall
together, and then the windows of those that differ. Splitters are whole leading keys: a bucket boundary always parts two different
keys, so the comparison across it is already made, and equal windows, which have equal leading keys, never lie on both sides.

Leading bytes that stand in very many places (one passage in a third of all documents) are cut into their windows, which equal no
others. These are range-partitioned by window and place, so that one window fills as many partitions as it needs; a task remembers
the first of the present window only, and the partitions' first and last windows settle what crosses a boundary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, drop_stored, field, in_slices, numbered_repeats, parallelism, released, stored, text_of

LENGTH = 100
LEAD = 40
#: Occurrences beyond which leading bytes are cut into windows.
HOT = 20_000
#: Bytes of texts, and of contexts, that a task handles at a time.
TEXT_BATCH, CONTEXT_BATCH = 4_000_000, 4_000_000
#: Places in the later texts of one doc_id follow those of the first at this distance.
SEQ = 1 << 40

BASE = 0x9E3779B97F4A7C15
#: Windows for which anchors are chosen at once; a place in a slab takes the low 20 bits of a key.
SLAB = 1 << 19
LOW = (1 << 20) - 1


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


UP, DOWN = powers(BASE, SLAB + 4096), powers(pow(BASE, -1, 2**64), SLAB + 4096)


def lead_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed hash of the ``LEAD`` bytes at every place: equal bytes, equal hash."""
    part = data.astype(np.uint64) + np.uint64(1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * UP[:len(part)])])
    h = (sums[LEAD:] - sums[:-LEAD]) * DOWN[:len(part) - LEAD + 1]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, first window, last window, hash) of the anchors; every window of ``length`` bytes belongs to just one.

    A window's anchor is the leftmost place of the least hash in it, by a sliding minimum over hash and place."""
    w, n = length - LEAD + 1, len(data) - length + 1
    parts = []
    for s in range(0, n, SLAB):
        count = min(SLAB, n - s)
        h = lead_hashes(data[s:s + count + length - 1])
        low, span = (h & np.uint64(2**64 - 1 - LOW)) | np.arange(len(h), dtype=np.uint64), 1
        while span * 2 <= w:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < w:
            low = np.minimum(low[:count], low[w - span:w - span + count])
        at = (low & np.uint64(LOW)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        place = at[first]
        parts.append((place + s, first + s, np.append(first[1:], count) - 1 + s, h[place]))
    if not parts:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def multikey_classes(n: int, columns: int, key) -> np.ndarray:
    """Multikey quicksort of ``n`` strings: per string the number of its class of equal strings, in string order.

    ``key(c, rows)`` gives the c-th eight bytes of some strings as numbers. Every unresolved class is split by its next key, all
    classes at once; a string alone in its class is done, so only what truly repeats is read to its end."""
    group, live = np.zeros(n, np.int64), np.arange(n)
    for c in range(columns):
        if len(live) == 0:
            break
        k = key(c, live)
        o = np.lexsort((k, group[live]))
        order, k = live[o], k[o]
        g = group[order]
        head = np.concatenate([[True], g[1:] != g[:-1]])
        new = head | np.concatenate([[True], k[1:] != k[:-1]])
        start, first = np.flatnonzero(new), np.flatnonzero(head)
        size = np.diff(np.append(start, len(order)))
        base = np.repeat(first, np.diff(np.append(first, len(order))))
        group[order] = g + np.repeat(start, size) - base
        live = order[np.repeat(size > 1, size)]
    return group


def by_class(group: np.ndarray, docs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by class and place, which strings come first in their class, and which start later than that (a repeated row does not)."""
    order = np.lexsort((places, docs, group))
    first = np.concatenate([[True], group[order][1:] != group[order][:-1]])
    head = np.repeat(order[first], np.diff(np.append(np.flatnonzero(first), len(order))))
    return order, first, (docs[order] != docs[head]) | (places[order] != places[head])


def eight_bytes(flat: np.ndarray, at: np.ndarray, left: np.ndarray | int) -> np.ndarray:
    """The eight bytes at places of a padded byte array as big-endian numbers, those beyond ``left`` blanked."""
    raw = np.lib.stride_tricks.sliding_window_view(flat, 8)[at].view(">u8").ravel().astype(np.uint64)
    drop = (np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)) if isinstance(left, np.ndarray) else np.uint64(8 * (8 - min(left, 8)))
    return (raw >> drop) << drop


def repeats(contexts: list[bytes], docs: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first window, last window) of the windows that occur earlier among the given contexts.

    ``places`` has the place of a context's first byte. Contexts are sorted whole, and only the first of equal ones goes on to
    have its windows compared."""
    lens = np.fromiter(map(len, contexts), np.int64, len(contexts))
    flat = np.concatenate([np.frombuffer(b"".join(contexts), np.uint8), np.zeros(8, np.uint8)])
    begin = np.cumsum(lens) - lens

    def whole(c, rows):
        if c == 0:
            return lens[rows].astype(np.uint64)
        left = lens[rows] - 8 * (c - 1)
        return np.where(left > 0, eight_bytes(flat, np.minimum(begin[rows] + 8 * (c - 1), len(flat) - 8), np.maximum(left, 1)), np.uint64(0))

    group = multikey_classes(len(lens), 1 + -(-int(lens.max()) // 8), whole)
    order, first, later = by_class(group, docs, places)
    copies, kept = order[later], order[first]
    out = [(docs[copies], places[copies], places[copies] + lens[copies] - length)]
    counts = lens[kept] - length + 1
    total = int(counts.sum())
    if len(kept) > 1:
        own = np.repeat(np.arange(len(kept)), counts)
        step = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        at = begin[kept][own] + step
        group = multikey_classes(total, -(-length // 8), lambda c, rows: eight_bytes(flat, at[rows] + 8 * c, length - 8 * c))
        d, p = docs[kept][own], places[kept][own] + step
        order, _, later = by_class(group, d, p)
        found = np.sort(order[later])
        if len(found):
            edge = np.flatnonzero(np.concatenate([[True], (np.diff(found) != 1) | (own[found][1:] != own[found][:-1])]))
            end = np.append(edge[1:], len(found)) - 1
            out.append((d[found[edge]], p[found[edge]], p[found[end]]))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def as_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    s, total = 0, 0
    for e, n in enumerate(sizes):
        if e > s and total + n > most:
            yield s, e
            s, total = e, 0
        total += n
    if s < len(sizes):
        yield s, len(sizes)


def anchor_prints(docs: DataFrame, length: int) -> DataFrame:
    """(print, doc, place) of all anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches):
            texts, keys, seqs = b.column(2).to_pylist(), b.column(0).to_pylist(), b.column(1).to_pylist()
            for s, e in slices([len(t) for t in texts], TEXT_BATCH):
                got = [(k, q, *anchors(np.frombuffer(as_bytes(t), np.uint8), length)) for k, q, t in zip(keys[s:e], seqs[s:e], texts[s:e], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([g[5] for g in got]).view(np.int64)),
                    pa.array(np.repeat(np.array([g[0] for g in got], np.int64), [len(g[2]) for g in got])),
                    pa.array(np.concatenate([g[2] + g[1] * SEQ for g in got]))], names=["print", "doc", "place"])

    return docs.select("_id", F.col("_seq").cast("bigint").alias("_seq"), text_of().alias("text")).mapInArrow(run, "print bigint, doc bigint, place bigint")


def suffix_contexts(docs: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    """(lead, context, doc, place, hi) for the marked anchors: the bytes their windows reach, from place on.

    Windows of hot anchors are single contexts without a lead. Of equal contexts of one batch of texts the first is handed on; the
    others are known to be repeats and become spans at once: rows without a context, windows from ``place`` to ``hi``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 2000):
            keys, seqs, texts, wanted = (b.column(i).to_pylist() for i in range(4))
            for s, e in slices([len(t) for t in texts], TEXT_BATCH):
                first: dict[bytes, tuple] = {}
                spans: list[tuple] = []
                for i in sorted(range(s, e), key=lambda i: (keys[i], seqs[i])):
                    raw, shift, lo = as_bytes(texts[i]), seqs[i] * SEQ, None
                    place, low, high, _ = anchors(np.frombuffer(raw, np.uint8), length)
                    want = np.array(sorted(wanted[i]), np.int64)
                    spot = np.minimum(np.searchsorted(want >> 1, place + shift), len(want) - 1)
                    hit = np.flatnonzero(want[spot] >> 1 == place + shift)
                    for p, a, z, hot in zip(place[hit].tolist(), low[hit].tolist(), high[hit].tolist(), (want[spot[hit]] & 1).tolist(), strict=True):
                        for x, y in ((x, x) for x in range(a, z + 1)) if hot else ((a, z),):
                            context = raw[x:y + length]
                            had = first.get(context)
                            if had is None:
                                first[context] = None if hot else raw[p:p + LEAD], keys[i], x + shift
                            elif had[1] != keys[i] or had[2] != x + shift:
                                if lo is not None and x == hi + 1:
                                    hi = y
                                    continue
                                if lo is not None:
                                    spans.append((keys[i], lo + shift, hi + shift))
                                lo, hi = x, y
                    if lo is not None:
                        spans.append((keys[i], lo + shift, hi + shift))
                rows = [(v[0], c, v[1], v[2], None) for c, v in first.items()] + [(None, None, k, lo, hi) for k, lo, hi in spans]
                for f, g in slices([len(r[1] or b"") + 24 for r in rows], TEXT_BATCH):
                    cols = zip(*rows[f:g], strict=True)
                    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["lead", "context", "doc", "place", "hi"])

    rows = docs.select("_id", F.col("_seq").cast("bigint").alias("_seq"), text_of().alias("text"))
    return rows.join(marks, ["_id", "_seq"]).select("_id", "_seq", "text", "marks").mapInArrow(
        run, "lead binary, context binary, doc bigint, place bigint, hi bigint")


def hot_repeats(windows: DataFrame) -> DataFrame:
    """(doc, lo, hi) of the windows (context, doc, place) that occur earlier among the given ones, however many are equal.

    A window's rows lie in order in one partition or in consecutive ones. So a row is a repeat if the one before has the same window,
    and the first of a partition if the partition before ends with its window, which one row of each partition tells the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = last = None
        names = ["doc", "lo", "hi", "head", "tail"]
        for b in batches:
            docs, lo = [], []
            for row in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if last is None or row[0] != last[0]:
                    last = row
                    head = head or row
                elif row != last:
                    docs.append(row[1])
                    lo.append(row[2])
            none = pa.nulls(len(lo), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(lo, pa.int64()), pa.array(lo, pa.int64()), none, none], names=names)
        if head:
            edge = [pa.array([x], pa.int64()) for x in (head[1], head[2], head[2])] + [pa.array([x], pa.binary()) for x in (head[0], last[0])]
            yield pa.RecordBatch.from_arrays(edge, names=names)

    spark = windows.sparkSession
    keys = ["context", "doc", "place"]
    ordered = windows.select(*keys).repartitionByRange(parallelism(spark), *keys).sortWithinPartitions(*keys)
    found = stored(ordered.mapInArrow(run, "doc bigint, lo bigint, hi bigint, head binary, tail binary"), "hot")
    edges = sorted((bytes(r.head), r.doc, r.lo, bytes(r.tail)) for r in found.where("head is not null").collect())
    crossing = [(b[1], b[2], b[2]) for a, b in zip(edges, edges[1:]) if a[3] == b[0]]
    spans = found.where("head is null").select("doc", "lo", "hi")
    return spans.union(spark.createDataFrame(crossing, "doc bigint, lo bigint, hi bigint")) if crossing else spans


def bucket_repeats(contexts: DataFrame, length: int) -> DataFrame:
    """(doc, lo, hi): windows that start earlier elsewhere, from buckets of the suffixes' order.

    A bucket comes sorted by leading key and is handled in bounded parts that end where the key changes; a key has ``HOT`` rows at
    most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def close():
            found = repeats([h[1] for h in held], np.array([h[2] for h in held], np.int64), np.array([h[3] for h in held], np.int64), length)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["doc", "lo", "hi"])

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if row[0] != last and size > CONTEXT_BATCH:
                    yield close()
                    size = 0
                last = row[0]
                held.append(row)
                size += len(row[1]) + 16
        if held:
            yield close()

    spark = contexts.sparkSession
    ordered = contexts.select("lead", "context", "doc", "place").repartitionByRange(parallelism(spark), "lead").sortWithinPartitions("lead")
    return ordered.mapInArrow(run, "doc bigint, lo bigint, hi bigint")


def cut_runs(text: str | None, flat: list[int] | None, length: int) -> tuple:
    """(n_bytes, n_removed, runs, kept bytes, text without the characters that lie wholly in a run)."""
    raw = as_bytes(text)
    if not flat:
        return len(raw), 0, [], raw, text
    pairs = sorted(zip(flat[0::2], flat[1::2], strict=True))
    runs: list[list[int]] = []
    for lo, hi in pairs:
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi + length)
        else:
            runs.append([lo, hi + length])
    kept, whole, at, near = [], [], 0, 0
    for lo, hi in runs:
        kept.append(raw[at:lo])
        at = hi
        while lo < hi and raw[lo] & 0xC0 == 0x80:
            lo += 1
        while hi > lo and hi < len(raw) and raw[hi] & 0xC0 == 0x80:
            hi -= 1
        whole.append(raw[near:lo])
        near = hi
    text = b"".join([*whole, raw[near:]]).decode("utf-8", "surrogatepass")
    return len(raw), sum(hi - lo for lo, hi in runs), [{"start": lo, "end": hi} for lo, hi in runs], b"".join([*kept, raw[at:]]), text


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with n_bytes, n_removed, spans (byte runs that go), kept (the remaining bytes) and clean_text.

    ``clean_text`` keeps a character of which a part remains. Earlier means a smaller doc_id (null before all), in rows that share
    a doc_id a smaller hash of the text, in one document an earlier start; rows that repeat both are one document and get one
    result. Null text is empty and stays null in ``clean_text``; texts below ``length`` bytes have nothing to lose; other columns
    pass through, those named like a result are replaced."""
    spark = docs.sparkSession
    drop = {"n_bytes", "n_removed", "spans", "kept", "clean_text", "_id", "_seq", "_spans"}
    least = F.lit(-(2**63)).cast("bigint")
    rows = numbered_repeats(docs.select(*[c for c in docs.columns if c.lower() not in drop]).withColumn("_id", F.coalesce(F.col("doc_id").cast("bigint"), least)), "_id")
    prints = stored(anchor_prints(rows, length), "anchors")
    often = prints.groupBy("print").count().where("count > 1").select("print", (F.col("count") > HOT).alias("hot"))
    seq = F.shiftright("place", 40)
    marks = prints.join(often, "print").groupBy(F.col("doc").alias("_id"), seq.alias("_seq")).agg(
        F.collect_list(F.col("place") * 2 + F.col("hot").cast("bigint")).alias("marks"))
    marks = stored(marks, "marks")
    drop_stored(prints)
    released(spark)
    contexts = stored(suffix_contexts(rows, marks, length), "contexts")
    released(spark)
    known = contexts.where("context is null").select("doc", F.col("place").alias("lo"), "hi")
    hot = hot_repeats(contexts.where("lead is null and context is not null"))
    spans = stored(bucket_repeats(contexts.where("lead is not null"), length).union(hot).union(known), "spans")
    drop_stored(contexts)
    drop_stored(marks)
    released(spark)
    low = SEQ - 1
    of = spans.groupBy(F.col("doc").alias("_id"), F.shiftright("lo", 40).cast("int").alias("_seq")).agg(F.flatten(F.collect_list(
        F.array(F.col("lo").bitwiseAND(F.lit(low)), F.col("hi").bitwiseAND(F.lit(low))))).alias("_spans"))

    def make(cols):
        got = [cut_runs(t, x, length) for t, x in zip(cols["text"], cols["_spans"], strict=True)]
        return {n: [g[i] for g in got] for i, n in enumerate(["n_bytes", "n_removed", "spans", "kept", "clean_text"])}

    added = [field("n_bytes", "long"), field("n_removed", "long"), field("spans", "array<struct<start:bigint,end:bigint>>"), field("kept", "binary"), field("clean_text", "string")]
    return add_columns(rows.join(of, ["_id", "_seq"], "left"), added, make, ["text", "_spans"]).drop("_id", "_seq", "_spans")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut from the texts, in the same columns; a document of which nothing remains goes."""
    out = remove_repeats(docs).where("n_removed = 0 or n_removed < n_bytes")
    return out.withColumn("text", F.col("clean_text")).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)
