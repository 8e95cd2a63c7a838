"""Near-duplicates by a chosen-path similarity join over MinHash trees.

Every tree deals the documents out by a minwise token of their shingle sets. A node that is small is compared exhaustively on full
sets; a large one is compared in blocks that all hold the node's first document. What is connected by then needs no comparison among
itself, so a node that is nearly one group ends with the few others held against all of it, and only a node without such a group
branches again, by two further minwise tokens. A pair of similarity s parts with probability 1 - s at the first level of a
tree and (1 - s) ** 2 at each further one; all trees together lose a pair at 0.8 about once in eighty thousand (0.2 ** 7)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.graphs import components
from tidemark.llm.common import drop_stored, in_slices, parallelism, stored, text_of

SHINGLE = 4
PERCENT = 80
TREES = 7
DEPTH = 4
BLOCK = 512
#: A large node is finished exactly if that takes at most so many rows for each of its own.
FINISH = 8
COORDS = TREES + TREES * 2 * (DEPTH - 1)
MULTIPLIERS = np.random.default_rng(20240229).integers(1, 2**63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles, A-Z lower-cased; all words as one if there are fewer, none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    take = min(width, len(words))
    h = np.full(len(w) - take + 1, take, np.uint64)
    for i in range(take):
        h = h * BASE + w[i: len(w) - take + 1 + i]
        h ^= h >> np.uint64(29)
    h = (h ^ (h >> np.uint64(32))) * BASE
    return np.unique(h ^ (h >> np.uint64(31)))


def minwise(tokens: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the ``COORDS`` hash functions, as 32-bit numbers."""
    best = np.full(COORDS, 2**64 - 1, np.uint64)
    for s in range(0, len(tokens), 4096):
        np.minimum(best, (tokens[s:s + 4096, None] * MULTIPLIERS).min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketches(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, n, print, mins) of every row: size and 128-bit fingerprint of the shingle set, and its minwise values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches):
            n, prints, mins = [], [], []
            for t in b.column(1).to_pylist():
                s = shingle_set(t, width)
                n.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                mins.append(minwise(s))
            flat = pa.array(np.concatenate(mins) if mins else np.empty(0, np.int32))
            offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * COORDS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.ListArray.from_arrays(offsets, flat)], names=["doc_id", "n", "print", "mins"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id bigint, n bigint, print binary, mins array<int>")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a block's sets, from the tokens that two or more of them hold."""
    k = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(k), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    same = values[1:] == values[:-1]
    shared = np.zeros(len(values), bool)
    shared[1:] |= same
    shared[:-1] |= same
    start = np.ones(len(values), bool)
    start[1:] = ~same
    values, owner, row = None, owner[shared], np.cumsum(start[shared]) - 1
    out = np.zeros((k, k), np.int64)
    for s in range(0, int(row[-1]) + 1 if len(row) else 0, 8192):
        lo, hi = np.searchsorted(row, (s, s + 8192))
        m = np.zeros((min(8192, int(row[-1]) + 1 - s), k), np.float32)
        m[row[lo:hi] - s, owner[lo:hi]] = 1
        out += (m.T @ m).astype(np.int64)
    return out


def link_block(ids: list[int], labels: list[int], texts: list[str], pivot: int | None, width: int, percent: int) -> list[int]:
    """New labels of a block's members: the pivot's where a chain of confirmed links leads to it, else the least label reached."""
    sets = [shingle_set(t, width) for t in texts]
    size = np.array([len(s) for s in sets])
    common = overlaps(sets)
    linked = 100 * common >= percent * (size[:, None] + size[None, :] - common)
    root = {x: x for x in labels}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    first = labels[ids.index(pivot)] if pivot in ids else None
    for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        x, y = find(labels[i]), find(labels[j])
        if x != y:
            if y == first or (x != first and y < x):
                x, y = y, x
            root[y] = x
    return [find(x) for x in labels]


def compare(rows: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, sid, label, new) for rows (node, block, sid, label, pivot); a block has some ``2 * BLOCK`` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []

        def close():
            if len(held) > 1:
                ids, labels = [h[0] for h in held], [h[1] for h in held]
                for i, new in enumerate(link_block(ids, labels, [h[3] for h in held], held[0][2], width, percent)):
                    out.append((key[0], ids[i], labels[i], new))

        def full():
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["node", "sid", "label", "new"])

        for b in batches:
            for node, block, sid, label, pivot, text in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if (node, block) != key:
                    close()
                    key, held = (node, block), []
                held.append((sid, label, pivot, text))
            if len(out) > 20_000:
                yield full()
        close()
        yield full()

    spark = rows.sparkSession
    ready = rows.join(texts, "sid").select("node", "block", "sid", "label", "pivot", "text")
    ready = ready.repartition(parallelism(spark), "node", "block").sortWithinPartitions("node", "block")
    return ready.mapInArrow(run, "node bigint, sid bigint, label bigint, new bigint")


def plausible(nodes: DataFrame, mins: DataFrame, percent: int) -> DataFrame:
    """The rows (tree, node, sid) that stand in a node with another whose minwise values agree with theirs often enough, and all
    rows of large nodes.

    Agreement is asked for at 30 points below ``percent``; a pair at 80 falls below it about once in a million. So documents that share
    no more than a passage leave before any text moves."""
    least = (percent - 30) * COORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []

        def close():
            if len(held) > 1:
                m = np.array([h[1] for h in held])
                for i, (sid, _) in enumerate(held):
                    agree = (m == m[i]).sum(axis=1)
                    agree[i] = 0
                    if 100 * agree.max() >= least:
                        out.append((*key, sid))

        def full():
            cols = list(zip(*out, strict=True)) or [()] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["tree", "node", "sid"])

        for b in batches:
            values = b.column(3).flatten().to_numpy().reshape(-1, COORDS)
            for tree, node, sid, v in zip(*(b.column(i).to_pylist() for i in range(3)), values, strict=True):
                if (tree, node) != key:
                    close()
                    key, held = (tree, node), []
                held.append((sid, v))
            if len(out) > 50_000:
                yield full()
        close()
        yield full()

    sizes = nodes.groupBy("node").agg(F.count("*").alias("m")).where("m > 1")
    rows = stored(nodes.join(sizes, "node").select("tree", "node", "sid", "m"), "nodes")
    small = rows.where(f"m <= {2 * BLOCK}").join(mins.select("sid", "mins"), "sid").select("tree", "node", "sid", "mins")
    small = small.repartition(parallelism(nodes.sparkSession), "node").sortWithinPartitions("tree", "node")
    return small.mapInArrow(run, "tree int, node bigint, sid bigint").union(rows.where(f"m > {2 * BLOCK}").select("tree", "node", "sid"))


def grow(level: DataFrame, mins: DataFrame, texts: DataFrame, width: int, percent: int) -> list[DataFrame]:
    """Edges (a, b) between labels from the trees that begin with ``level`` (tree, node, sid, label), branched until every node is
    small, compared, or connected."""
    edges, parts = [], F.ceil(F.col("m") / BLOCK)
    for depth in range(1, DEPTH + 1):
        stats = level.groupBy("node").agg(F.count("*").alias("m"), F.min("sid").alias("pivot"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        rows = level.join(stats.where("lo != hi").select("node", "m", "pivot"), "node")
        own = F.when(F.col("m") <= 2 * BLOCK, 0).otherwise(F.pmod(F.xxhash64("sid", "node"), parts))
        every = F.sequence(F.lit(0).cast("bigint"), parts - 1)
        blocks = F.when((F.col("sid") == F.col("pivot")) & (F.col("m") > 2 * BLOCK), every).otherwise(F.array(own))
        rows = stored(rows.withColumn("block", F.explode(blocks)).select("tree", "node", "block", "sid", "label", "m", "pivot"), f"rows{depth}")
        most = rows.agg(F.max("m")).first()[0]
        if most is None:
            break
        done = stored(compare(rows, texts, width, percent), f"linked{depth}")
        edges.append(done.where("label != new").select(F.col("label").alias("a"), F.col("new").alias("b")).distinct())
        if most <= 2 * BLOCK:
            break
        large = rows.where(f"m > {2 * BLOCK}").groupBy("tree", "node", "sid").agg(F.first("m").alias("m"), F.first("pivot").alias("pivot"))
        large = large.join(done.groupBy("node", "sid").agg(F.min("new").alias("label")), ["node", "sid"])
        sizes = large.groupBy("node", "label").count()
        main = sizes.groupBy("node").agg(F.max(F.struct(F.col("count").alias("n"), F.col("label").alias("l"))).alias("x")).select("node", F.col("x.n").alias("n"), F.col("x.l").alias("main"))
        rest = F.col("m") - F.col("n")
        large = stored(large.join(main, "node").where("m > n").withColumn("rest", rest).withColumn(
            "finish", F.lit(depth == DEPTH) | (parts * rest + F.ceil(rest / BLOCK) * F.col("m") <= FINISH * F.col("m"))), f"large{depth}")
        last = stored(compare(final_blocks(large.where("finish")), texts, width, percent), f"finished{depth}")
        edges.append(last.where("label != new").select(F.col("label").alias("a"), F.col("new").alias("b")).distinct())
        if depth == DEPTH or large.where("not finish").isEmpty():
            break
        at = F.lit(TREES) + F.col("tree") * 2 * (DEPTH - 1) + 2 * (depth - 1)
        deeper = large.where("not finish").join(mins.select("sid", "mins"), "sid").select(
            "tree", "node", "sid", "label", F.explode(F.array(
                F.struct(F.lit(0).alias("c"), F.get("mins", at).alias("v")), F.struct(F.lit(1).alias("c"), F.get("mins", at + 1).alias("v")))).alias("x"))
        level = stored(deeper.select("tree", F.xxhash64("node", "x.c", "x.v").alias("node"), "sid", "label"), f"level{depth + 1}")
    return edges


def final_blocks(large: DataFrame) -> DataFrame:
    """The exact end of a large node: its main group in blocks of rows, the rest in blocks of rows, and every block of the rest met
    with every block of both. The main group, connected already, is not compared with itself."""
    of_main, of_rest = F.ceil(F.col("n") / BLOCK), F.ceil(F.col("rest") / BLOCK)
    own = F.pmod(F.xxhash64("sid", "node"), F.when(F.col("label") == F.col("main"), of_main).otherwise(of_rest))
    # blocks of the rest come first; a pair of blocks (r, b) has r below the blocks of the rest and b at or above r
    total = of_main + of_rest
    rows = large.withColumn("own", own)
    as_main = F.transform(F.sequence(F.lit(0).cast("bigint"), of_rest - 1), lambda r: r * total + of_rest + F.col("own"))
    ups = F.transform(F.sequence(F.col("own"), total - 1), lambda b: F.col("own") * total + b)
    downs = F.when(F.col("own") > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("own") - 1), lambda r: r * total + F.col("own"))).otherwise(F.array().cast("array<bigint>"))
    blocks = F.when(F.col("label") == F.col("main"), as_main).otherwise(F.concat(ups, downs))
    return rows.withColumn("block", F.explode(blocks)).select("tree", "node", "block", "sid", "label", "m", "pivot")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Links are confirmed on full shingle sets. Rows whose sets are equal are one entity, named by its smallest doc_id. Null or
    empty texts have no shingles and are linked with nothing; rows that share a doc_id are one document of the graph, each with its own ``n_shingles``; a
    row without doc_id has no component and is kept. An empty table gives an empty table."""
    spark = docs.sparkSession
    sketch = stored(sketches(docs, width), "sketch")
    known = sketch.where("doc_id is not null and n > 0")
    sets = stored(known.groupBy("print").agg(F.min("doc_id").alias("sid"), F.first("mins").alias("mins")), "sets")
    trees = F.explode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(t.alias("tree"), F.get("mins", t).alias("v"))))
    nodes = sets.select("sid", trees.alias("x")).select("x.tree", F.xxhash64("x.tree", "x.v").alias("node"), "sid")
    roots = stored(plausible(nodes, sets, percent).withColumn("label", F.col("sid")), "roots")
    # a merge join at every size: the texts are dealt out once, whatever the planner thinks of the list
    wanted = roots.select("sid").distinct().hint("merge")
    texts = stored(docs.select(F.col("doc_id").cast("bigint").alias("sid"), text_of().alias("text")).join(wanted, "sid", "left_semi"), "texts")

    edges = grow(roots.where("tree = 0").select("tree", "node", "sid", "label"), sets, texts, width, percent)
    again = known.groupBy("doc_id").agg(F.min("print").alias("p"), F.max("print").alias("q")).where("p != q").select("doc_id")
    if not again.isEmpty():
        twice = known.select("doc_id", "print").join(again, "doc_id", "left_semi").join(sets.select("print", "sid"), "print")
        edges.append(twice.select(F.col("doc_id").alias("a"), F.col("sid").alias("b")))
    none = spark.createDataFrame([], "id bigint, root bigint")
    first = components(union(edges)) if edges else none
    rest = roots.where("tree > 0").join(first.withColumnRenamed("id", "sid"), "sid", "left").select(
        "tree", "node", "sid", F.coalesce("root", "label").alias("label"))
    # the labels of the other trees are roots by now, so their edges join roots alone
    more = grow(rest, sets, texts, width, percent)
    second = components(union(more)) if more else none
    up = second.select(F.col("id").alias("root"), F.col("root").alias("top"))
    found = first.join(up, "root", "left").select("id", F.coalesce("top", "root").alias("root")).union(
        second.join(first, "id", "left_anti").select("id", "root"))
    drop_stored(texts)
    drop_stored(roots)

    of_set = sets.select("print", "sid").join(found.select(F.col("id").alias("sid"), "root"), "sid", "left").select("print", F.coalesce("root", "sid").alias("set_root"))
    out = sketch.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("print")).alias("print")).join(of_set, "print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("set_root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def representatives(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near-duplicates, in the columns of ``docs``: the one with the smallest doc_id.

    Rows without doc_id stay, as they are linked with nothing."""
    verdict = near_duplicates(docs, width, percent).where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct()
    stay = docs.join(verdict, F.col("doc_id").cast("bigint") == F.col("_kept"), "left_semi")
    return stay.union(docs.where("doc_id is null")).select(*docs.columns)
