"""Repair of the turn structure of conversations at least cost.

Role initials of a sound conversation read ``(s?(ua)+)?``. Rows may be kept (0), given the role user or assistant (3), deleted (4),
and empty turns inserted (3); a row that stays although its text is cut off adds 3. Four states say what may come next: 0 nothing
yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn; only 0 and 3 may end.

A conversation is cut into blocks of rows, so one of any length is dealt out. Inside a block a cost DP runs backward over the nodes
(row, state), for all blocks of an Arrow batch at once; then the nodes are ranked by the least audit of one character along arcs of
least cost, and ranks and pointers are doubled to 2, 4, 8 ... characters until every pointer has reached an end. Arcs that leave a
node bear different characters, so the rank of length one settles each node's arc. Between blocks, costs go backward and entry states
forward by doubled self-joins of the block table, a few numbers a block."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import drop_stored, in_slices, numbered, parallelism, stored

KEEP_COST, ROLE_COST, DELETE_COST, INSERT_COST, CUT_COST = 0, 3, 4, 3, 3
FAR = 1 << 40
#: The state after the turn that may be put in at a state, and what ending there costs in inserted turns.
NEXT = np.array([2, 2, 3, 2])
END = np.array([0, 2 * INSERT_COST, INSERT_COST, 0])
#: State reached by keeping a system, user, assistant or other turn; -1 where the turn may not stand.
KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])


def is_blank(text: Column) -> Column:
    return ~F.rlike(text, F.lit(r"[^\x20\x09-\x0D]"))


def is_cut(text: Column) -> Column:
    """The last character that is no blank does not end a sentence."""
    return ~F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1)).isin(".", "!", "?")


# ---- one block: costs, ranks, audits ----------------------------------------


def _relaxed(cost: np.ndarray) -> np.ndarray:
    """Costs (..., 4) when turns may be inserted first."""
    for _ in range(3):
        cost = np.minimum(cost, cost[..., NEXT] + INSERT_COST)
    return cost


def _moves(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cost (rows, 3 edits, 4 states) and target of deleting, keeping and re-roling rows. Code: kind + 4 if cut off; 8: to be deleted."""
    kind, cut, dead = code & 3, (code & 4 > 0) * CUT_COST, code >= 8
    to = np.empty((len(code), 3, 4), np.int64)
    to[:, 0], to[:, 1], to[:, 2] = np.arange(4), KEPT[kind], NEXT
    cost = np.empty_like(to)
    cost[:, 0] = DELETE_COST
    cost[:, 1] = np.where((to[:, 1] < 0) | dead[:, None], FAR, KEEP_COST + cut[:, None])
    cost[:, 2] = np.where(dead, FAR, ROLE_COST + cut)[:, None]
    return cost, np.maximum(to, 0)


def costs_to_go(codes: list[np.ndarray], exits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least cost from each node, laid out block after block with one position more than rows, and the offsets of the blocks.

    ``exits``: (blocks, 4, k), k cost vectors at the position after the last row; the result is (positions, 4, k)."""
    size = np.array([len(c) for c in codes])
    at = np.concatenate(([0], np.cumsum(size + 1)))
    out = np.empty((at[-1], 4, exits.shape[2]), np.int64)
    cost, to = _moves(np.concatenate(codes)) if size.sum() else (None, None)
    first = np.concatenate(([0], np.cumsum(size)))
    out[at[1:] - 1] = exits
    for p in range(size.max(initial=0) - 1, -1, -1):
        live = np.flatnonzero(size > p)
        row = first[live] + p
        later = out[at[live] + p + 1]
        best = np.min(cost[row][..., None] + later[np.arange(len(live))[:, None, None], to[row]], axis=1)
        out[at[live] + p] = np.minimum(_relaxed(best.swapaxes(1, 2)).swapaxes(1, 2), FAR)
    return out, at


def products(codes: list[np.ndarray]) -> np.ndarray:
    """(blocks, 4, 4): least cost from each state before a block to each state after it, insertions after its last row left out."""
    unit = np.where(np.eye(4, dtype=bool), 0, FAR)
    cost, at = costs_to_go(codes, np.broadcast_to(unit, (len(codes), 4, 4)))
    return cost[at[:-1]]


def least_audits(codes: list[np.ndarray], exits: np.ndarray, last: np.ndarray, starts: list[list[int]]) -> list[list[tuple[str, int] | None]]:
    """For each block and start state: the edits of the least audit among the cheapest ways out, and the state reached.

    ``exits`` (blocks, 4): cost to go after the last row; ``last``: whether the conversation ends there, so that turns may be inserted.
    Edits: D deleted, K kept, U and A given the role user or assistant, u and a inserted before what follows. None: no way."""
    cost, at = costs_to_go(codes, exits[:, :, None])
    cost = cost[:, :, 0]
    size = np.diff(at) - 1
    n = len(cost)
    where = np.repeat(np.arange(len(codes)), size + 1)
    inner = np.ones(n, bool)
    inner[at[1:] - 1] = False
    move, to = np.full((n, 3, 4), FAR), np.zeros((n, 3, 4), np.int64)
    if inner.any():
        move[inner], to[inner] = _moves(np.concatenate(codes))
    here = np.arange(n)[:, None] * 4
    state = np.arange(4)[None, :]
    # least character first: D, I, K, R; a node without an arc of least cost is an end
    pointer = here + state
    label = np.zeros((n, 4), np.int64)
    nxt = np.minimum(np.arange(n) + 1, n - 1)
    ok = cost < FAR
    mayinsert = inner | last[where]
    for rank, edit in ((4, 2), (3, 1), (2, None), (1, 0)):
        if edit is None:
            fits, target = mayinsert[:, None] & (cost[:, NEXT] + INSERT_COST == cost), here + NEXT[None, :]
        else:
            fits = inner[:, None] & (move[:, edit] < FAR) & (move[:, edit] + cost[nxt[:, None], to[:, edit]] == cost)
            target = nxt[:, None] * 4 + to[:, edit]
        fits = fits & ok
        label[fits], pointer[fits] = rank, target[fits]
    label, pointer = label.ravel(), pointer.ravel()
    rank, jump, length = label.copy(), pointer.copy(), (label > 0).astype(np.int64)
    jumps = [jump]
    while (label[jump] > 0).any():
        # ranks of twice as many characters: the pair of a node's rank and that of the node its pointer leads to
        _, rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)
        length, jump = length + length[jump], jump[jump]
        jumps.append(jump)
    # one start after the other: the node t characters on is reached through the pointers of the bits of t
    want = [(b, s) for b, some in enumerate(starts) for s in some]
    node = np.array([at[b] * 4 + s for b, s in want], np.int64)
    steps = length[node] if len(node) else np.zeros(0, np.int64)
    path = np.repeat(node, steps)
    t = np.arange(len(path)) - np.repeat(np.cumsum(steps) - steps, steps)
    for k, j in enumerate(jumps):
        path = np.where(t >> k & 1, j[path], path)
    user = NEXT[path & 3] == 2
    kind = label[path]
    mark = np.select([kind == 1, kind == 2, kind == 3], [ord("D"), np.where(user, ord("u"), ord("a")), ord("K")], np.where(user, ord("U"), ord("A")))
    text = mark.astype(np.uint8).tobytes().decode()
    cuts = np.concatenate(([0], np.cumsum(steps)))
    end = jumps[-1][node] & 3 if len(node) else node
    found = iter([(text[cuts[i]:cuts[i + 1]], int(end[i])) if ok[at[b], s] else None for i, (b, s) in enumerate(want)])
    return [[next(found) for _ in some] for some in starts]


def _codes(shapes: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(s.encode(), np.uint8).astype(np.int64) - ord("a") for s in shapes]


# ---- blocks of all conversations --------------------------------------------


def _min_plus(a: Column, b: Column) -> Column:
    return F.array(*[F.least(*[F.get(a, F.lit(4 * i + k)) + F.get(b, F.lit(4 * k + j)) for k in range(4)]) for i in range(4) for j in range(4)])


def _stored_round(df: DataFrame, before: DataFrame | None, name: str) -> DataFrame:
    out = stored(df, name)
    if before is not None:
        drop_stored(before)
    return out


def _doubled(table: DataFrame, blocks: int, shift: int, value: str, merge) -> DataFrame:
    """``value`` of each block merged with those of the blocks after (shift 1) or before it (shift -1), in log2(blocks) rounds."""
    reach, last = 1, None
    while reach < blocks:
        other = table.select(F.col("conv").alias("_c"), (F.col("block") - shift * reach).alias("_b"), F.col(value).alias("_v"))
        joined = table.join(other, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")), "left")
        table = _stored_round(joined.withColumn(value, F.when(F.col("_v").isNull(), F.col(value)).otherwise(merge(F.col(value), F.col("_v")))).drop("_c", "_b", "_v"), last, "double")
        last, reach = table, 2 * reach
    return table


def exit_costs(shapes: DataFrame, blocks: int) -> DataFrame:
    """(conv, block, shape, exits, last): the cost to go after each block of (conv, block, shape)."""
    end = F.array(*[F.lit(int(x)).cast("bigint") for x in END])
    if blocks <= 1:
        return shapes.withColumn("exits", end).withColumn("last", F.lit(True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 200):
            got = products(_codes(b.column("shape").to_pylist())).reshape(b.num_rows, 16).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.list_(pa.int64()))], names=[*b.schema.names, "cost"])

    made = stored(shapes.mapInArrow(run, T.StructType([*shapes.schema.fields, T.StructField("cost", T.ArrayType(T.LongType()))])), "products")
    far = F.lit(FAR)
    merged = _doubled(made, blocks, 1, "cost", lambda a, b: F.transform(_min_plus(a, b), lambda x: F.least(x, far)))
    togo = F.array(*[F.least(*[F.get("cost", F.lit(4 * i + k)) + int(END[k]) for k in range(4)]) for i in range(4)])
    after = merged.select(F.col("conv").alias("_c"), (F.col("block") - 1).alias("_b"), togo.alias("exits"))
    out = shapes.join(after, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")), "left").drop("_c", "_b")
    out = out.withColumn("last", F.col("exits").isNull())
    return out.withColumn("exits", F.coalesce("exits", end))


def block_edits(shapes: DataFrame, blocks: int) -> DataFrame:
    """(conv, block, shape, edits): what to do with the rows of each block, ``shapes`` being (conv, block, shape)."""
    held = exit_costs(shapes, blocks)
    kind = T.StructType([*held.schema.fields, T.StructField("ways", T.ArrayType(T.StringType())), T.StructField("to", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 200):
            first = b.column("block").to_pylist()
            starts = [[0] if k == 0 else [0, 1, 2, 3] for k in first]
            got = least_audits(_codes(b.column("shape").to_pylist()), np.array(b.column("exits").to_pylist(), np.int64).reshape(-1, 4),
                               np.array(b.column("last").to_pylist(), bool), starts)
            ways = pa.array([[x and x[0] for x in g] for g in got], pa.list_(pa.string()))
            to = pa.array([[x and x[1] for x in g] + [None] * (4 - len(g)) for g in got], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns, ways, to], names=[*b.schema.names, "ways", "to"])

    made = held.mapInArrow(run, kind)
    if blocks <= 1:
        return made.select("conv", "block", "shape", F.get("ways", F.lit(0)).alias("edits"))
    made = stored(made, "ways")
    before = made.select(F.col("conv").alias("_c"), (F.col("block") + 1).alias("_b"), F.col("to").alias("came"))
    start = made.join(before, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")), "left").drop("_c", "_b")
    same = F.array(*[F.lit(i).cast("bigint") for i in range(4)])
    start = stored(start.select("conv", "block", "shape", "ways", F.coalesce("came", same).alias("came")), "came")
    # maps of states: the earlier block's map first, then this one's
    entered = _doubled(start, blocks, -1, "came", lambda now, earlier: F.transform(earlier, lambda s: F.get(now, s.cast("int"))))
    return entered.select("conv", "block", "shape", F.get("ways", F.when(F.col("block") == 0, 0).otherwise(F.get("came", F.lit(0)).cast("int"))).alias("edits"))


# ---- the operator -----------------------------------------------------------

#: What each edit costs without the surcharge of a cut-off row.
PRICE = {"D": DELETE_COST, "K": KEEP_COST, "U": ROLE_COST, "A": ROLE_COST, "u": INSERT_COST, "a": INSERT_COST}
NAMES = {"u": "user", "a": "assistant", "U": "user", "A": "assistant"}
UNITS = re.compile("[ua]*[KDUA]|[ua]+$")
AUDIT = str.maketrans("uaUA", "IIRR")
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Conversation:
    """Running figures of the conversation whose rows are passing."""

    def __init__(self, conv):
        self.conv, self.turns, self.low, self.high = conv, 0, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.role, self.audit, self.sha, self.empty, self.units, self.codes = None, [], hashlib.sha256(), True, iter(()), iter(())

    def block(self, edits: str, shape: str) -> None:
        self.audit.append(edits.translate(AUDIT))
        self.cost += sum(price * edits.count(c) for c, price in PRICE.items())
        self.units, self.codes = iter(UNITS.findall(edits)), iter(shape)

    def line(self, role: str, text: str) -> None:
        self.sha.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.turns += self.high != turn
            self.low, self.high = turn if self.low is None else self.low, turn
        self.illegal += self.role is not None and self.role + role[:1] not in ("su", "ua", "au")
        self.role = role[:1]
        code, unit = ord(next(self.codes)) - ord("a"), next(self.units)
        self.blank, self.duplicate, self.truncated = self.blank + (code == 8), self.duplicate + (code == 9), self.truncated + (4 <= code < 8)
        for c in unit[:-1]:
            self.line(NAMES[c], "")
        if unit[-1] != "D":
            self.line(NAMES.get(unit[-1], role), text)
            self.cost += CUT_COST * (4 <= code < 8)

    def closed(self) -> tuple:
        for c in "".join(self.units):
            self.line(NAMES[c], "")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def _passed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Figures of the conversations in rows sorted by (conv, _i, sort); sort 0 announces one, 1 a block's edits, 2 is a row."""
    now, done = None, []
    for b in in_slices(batches):
        for conv, _, sort, turn, role, text, edits, shape in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now is None or now.conv != conv:
                done += [now.closed()] if now else []
                now = _Conversation(conv)
            if sort == 1:
                now.block(edits, shape)
            elif sort == 2:
                now.row(turn, role, text)
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in done], schema=schema)
            done = []
    if now:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, now.closed(), strict=True))], schema=schema)


def block_shapes(rows: DataFrame, rows_per_block: int) -> DataFrame:
    """(conv, block, shape): a letter a row. ``rows``: conv, _i, role, text.

    Letters from a: kind of role (system, user, assistant, other), 4 more if cut off; i blank, j seen earlier."""
    kind = F.when(F.left("role", F.lit(1)) == "s", 0).when(F.left("role", F.lit(1)) == "u", 1).when(F.left("role", F.lit(1)) == "a", 2).otherwise(3)
    code = F.when(is_blank(F.col("text")), 8).otherwise(kind + F.when(is_cut(F.col("text")), 4).otherwise(0)).cast("int")
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    facts = rows.select("conv", "_i", code.alias("code"), F.substring(F.unhex(same), 1, 16).alias("print"))
    first = facts.where("code < 8").groupBy("conv", "print").agg(F.min("_i").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("conv").alias("_c"), F.col("print").alias("_p"), "first")
    again = facts.where("code < 8").join(first, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("print") == F.col("_p"))).where("_i > first")
    marks = facts.select("conv", "_i", "code").unionAll(again.select("conv", "_i", F.lit(9).alias("code")))
    marks = marks.withColumn("block", F.expr(f"_i div {rows_per_block}"))
    found = marks.groupBy("conv", "block").agg(
        F.array_sort(F.collect_list(F.when(F.col("code") != 9, F.struct("_i", "code")))).alias("rows"),
        F.collect_list(F.when(F.col("code") == 9, (F.col("_i") % rows_per_block).cast("int"))).alias("again"))
    letter = lambda x, k: F.char(F.lit(ord("a")) + F.when(F.array_contains("again", k), 9).otherwise(x["code"]))
    return found.select("conv", "block", F.array_join(F.transform("rows", letter), "").alias("shape"))


def repair(turns: DataFrame, asked: DataFrame | None = None, rows_per_block: int = 256) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost (bigint), audit, repaired_sha256.

    ``turns``: conv_id, turn, role, text; other columns are left out. ``asked`` (conv_id) names further conversations to report: one
    without rows has zeros, an empty audit and the digest of nothing. Rows stand by turn, nulls first, then role and text; a null role
    or text is one space; a null conv_id is a conversation like any other. The first fault of a row counts: blank, duplicate (role and
    text seen earlier), truncated (its last character that is no blank is none of .!?). ``illegal``: neighbours whose role initials
    are not su, ua or au. The audit is the least in ASCII order among the cheapest. ``gaps``: turns missing between the least and the
    largest. Repeated rows are duplicates; very long texts are hashed piece by piece; an empty table gives no rows.

    Costs and edits are found block by block. Only the last step passes a conversation through one task, in order, one row at a time
    and without holding it: a digest of its whole text can't be cut."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = turns.select(F.col("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("turn"), space("role"), space("text"))
    rows = numbered(rows, "conv", ["turn", "role", "text"], [F.col("turn"), F.col("role"), F.substring("text", 1, 40)], "turns")
    shapes = stored(block_shapes(rows, rows_per_block), "shapes")
    blocks = (shapes.agg(F.max("block")).first()[0] or 0) + 1
    edits = block_edits(shapes, blocks)
    none = F.lit(None).cast("string")
    void = [F.lit(None).cast("bigint").alias("turn"), none.alias("role"), none.alias("text")]
    parts = rows.select("conv", "_i", F.lit(2).alias("sort"), "turn", "role", "text", none.alias("edits"), none.alias("shape")).unionAll(
        edits.select("conv", (F.col("block") * rows_per_block).alias("_i"), F.lit(1), *void, "edits", "shape"))
    if asked is not None:
        parts = parts.unionAll(asked.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("bigint"), F.lit(0), *void, none, none))
    dealt = parts.repartition(parallelism(turns.sparkSession), "conv").sortWithinPartitions("conv", "_i", "sort")
    out = T.StructType([T.StructField("conv_id", parts.schema["conv"].dataType), *[T.StructField(c, T.LongType()) for c in FIGURES],
                        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    schema = to_arrow_schema(out)
    return dealt.mapInArrow(lambda batches: _passed(batches, schema), out)
