"""Packing by concatenating and cutting: two passes of prefix sums give every document its place, fixed windows cut it.

Pass one tokenises each input partition and counts its tokens as it goes; the totals of the partitions, one row each, are summed up
to offsets. Pass two adds them and cuts at multiples of the window. A piece that ends or begins at a cut is a boundary record: it
says where in its document and where in its sequence it stands, so that sequences that span partitions are joined by their id."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, stored, text_of

WINDOW = 2048
END_ID = 1
MEMO_WORDS, MEMO_LETTERS = 200_000, 48

#: Rows of three numbers, some 25 MB.
BROADCAST_ROWS = 1_000_000

#: Ids of single words, by vocabulary file, kept while the worker lives: the words in use, and those in use before the memo was last full.
MEMO: dict[str, list[dict[bytes, bytes]]] = {}
TOKENIZERS: dict = {}


#: A word of Latin letters with marks behind it: the pre-tokeniser makes two pieces of it, the normaliser only lower-cases it.
PLAIN = re.compile(r"([a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u024f]*)([!-&(-/:-@\[-`{-~]*)")


MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves and the others as the characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = byte_letters()


def tokenizer(file: str):
    if file not in TOKENIZERS:
        from tokenizers import Tokenizer

        TOKENIZERS[file] = Tokenizer.from_file(file)
        MEMO[file] = [{}, {}]
    return TOKENIZERS[file]


def plain_ids(model, memo: dict[bytes, bytes], older: dict[bytes, bytes], word: bytes) -> bytes | None:
    """The ids of a plain word by the vocabulary's model itself; None for words that need the whole tokeniser."""
    letters = word.rstrip(MARKS)
    if not letters.isalpha():  # not ASCII letters alone
        text = word.decode("utf-8", "replace").lower()
        found = PLAIN.fullmatch(text)
        if not found:
            return None
        letters, word = found[1].encode(), text.encode()
    else:  # a text that might name a control token comes with its capitals
        letters, word = letters.lower(), word.lower()
    if b"<|" in word:
        return None
    ids = memo.get(letters) or older.get(letters)
    if ids is None:
        text = letters.decode() if letters.isascii() else letters.decode("latin-1").translate(LETTERS)
        ids = array("I", [t.id for t in model.tokenize(text)]).tobytes() if letters else b""
        if len(letters) <= MEMO_LETTERS:
            memo[letters] = ids
    if len(letters) == len(word):
        return ids
    marks = word[len(letters):]
    more = memo.get(marks)
    if more is None:
        more = array("I", [t.id for t in model.tokenize(marks.decode())]).tobytes()
        if len(marks) <= MEMO_LETTERS:
            memo[marks] = more
    return ids + more


def encode_texts(file: str, texts: list[str]) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers.

    The vocabulary's own pre-tokeniser drops white space and joins nothing across it, and its normaliser changes nothing across
    ASCII white space, so the ids of a text are those of its words in turn; each word is encoded once while the memo holds it. A-Z
    are lower-cased before as the normaliser would, in texts that might name a control token only word by word."""
    t = tokenizer(file)
    raws = [x.encode("utf-8", "surrogatepass") for x in texts]
    words = [(r if b"<|" in r else r.lower()).split() for r in raws]
    used: set[bytes] = set()
    for ws in words:
        used.update(ws)
    if len(MEMO[file][0]) + len(used) > MEMO_WORDS:
        MEMO[file] = [{}, MEMO[file][0]]
    memo, older = MEMO[file]
    new, model = [], t.model
    long = [w for w in used if len(w) > MEMO_LETTERS]
    for w in used.difference(memo):
        ids = older.get(w) or plain_ids(model, memo, older, w)
        if ids is None:
            new.append(w)
        else:
            memo[w] = ids
    for s in range(0, len(new), 20_000):
        part = new[s:s + 20_000]
        for w, e in zip(part, t.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False), strict=True):
            memo[w] = array("I", e.ids).tobytes()
    out = [b"".join(map(memo.__getitem__, ws)) for ws in words]
    for w in long:
        del memo[w]
    return out


def tokenised(docs: DataFrame, file: str, end_id: int = END_ID) -> DataFrame:
    """(part, doc_id, start, n, ids): the ids of each document, end id included, and its start among its partition's tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes()
        for b in in_slices(batches, 2000):
            texts, keys = b.column(1).to_pylist(), b.column(0)
            s = 0
            while s < len(texts):
                size, e = 0, s
                while e < len(texts) and (size < 4_000_000 or e == s):
                    size += len(texts[e])
                    e += 1
                ids = [x + end for x in encode_texts(file, texts[s:e])]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(ids), pa.int32()), keys.slice(s, e - s), pa.array(starts), pa.array(n), pa.array(ids, pa.binary())],
                    names=["part", "doc_id", "start", "n", "ids"])
                s = e

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "part int, doc_id bigint, start bigint, n bigint, ids binary")


def pack(docs: DataFrame, file: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, unsigned 32-bit little-endian), doc_tokens, sequence_id, offset, boundary.

    All sequences but the last are full. ``boundary`` marks the pieces of a sequence that a partition of the input begins or ends
    in. Null or empty text is the end id alone; rows of one doc_id are packed one by one; an empty table gives no pieces.

    The totals are one row per partition of the input, whatever the documents hold; up to ``BROADCAST_ROWS`` of them are broadcast,
    more are joined by shuffle."""
    tokens = stored(tokenised(docs, file, end_id), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    few = totals.count() <= BROADCAST_ROWS
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select("part", "total", before.alias("before"))
    placed = tokens.join(F.broadcast(offsets) if few else offsets, "part").withColumn("at", F.col("before") + F.col("start"))

    def cut(k):
        lo = F.greatest(F.col("at"), k * window)
        hi = F.least(F.col("at") + F.col("n"), (k + 1) * window)
        return F.struct((lo - F.col("at")).alias("start"), (hi - lo).alias("length"), F.substring(
            "ids", ((lo - F.col("at")) * 4 + 1).cast("int"), ((hi - lo) * 4).cast("int")).alias("ids"), k.alias("sequence_id"), (lo - k * window).alias("offset"))

    first, last = F.floor(F.col("at") / window), F.floor((F.col("at") + F.col("n") - 1) / window)
    pieces = placed.select("doc_id", F.col("n").alias("doc_tokens"), "before", "total", F.explode(F.transform(F.sequence(first, last), cut)).alias("p"))
    edge = (F.col("p.sequence_id") == F.floor(F.col("before") / window)) | (F.col("p.sequence_id") == F.floor((F.col("before") + F.col("total") - 1) / window))
    return pieces.select("doc_id", "p.start", "p.length", "p.ids", "doc_tokens", "p.sequence_id", "p.offset", edge.alias("boundary"))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, length, doc_ids): the windows put together; a group is bounded by the window."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))
    whole = pieces.groupBy("sequence_id").agg(rows.alias("r"))
    joined = F.aggregate("r", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return whole.select("sequence_id", joined.alias("ids"), F.aggregate("r", F.lit(0).cast("bigint"), lambda acc, x: acc + x["length"]).alias("length"),
                        F.transform("r", lambda x: x["doc_id"]).alias("doc_ids"))
