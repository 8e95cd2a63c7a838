"""Line dedup, the Merkle manifest and conversation repair on small tables, against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import lines, merkle, repair
from tidemark.llm.common import numbered

DOCS = "doc_id bigint, text string, lang string"
TURNS = "conv_id bigint, turn bigint, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


# ---- numbering --------------------------------------------------------------


@pytest.mark.parametrize("groups", [[None], ["a"], [None, "", "a", "b", "b", "b"]])
def test_numbered_goes_on_over_ranges(frame, groups):
    r = random.Random(1)
    rows = [(r.choice(groups), r.randrange(60), str(i)) for i in range(700)]
    got = numbered(frame(rows, "g string, x bigint, t string"), "g", ["x", "t"], [F.col("x")], "test").collect()
    want = {}
    for g in set(groups):
        want |= {k: i for i, k in enumerate(sorted(x for x in rows if x[0] == g))} if g is not None else {k: i for i, k in enumerate(sorted((x for x in rows if x[0] is None), key=lambda x: x[1:]))}
    assert {(x.g, x.x, x.t): x._i for x in got} == want and len(got) == 700


# ---- lines ------------------------------------------------------------------


def brute_lines(docs, least_chars=20, least_docs=3):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    held = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            held[key(line)].add(doc)
    out = []
    for doc, text in docs:
        all_ = (text or "").split("\n")
        gone = [len(k) >= least_chars and len(held[k]) >= least_docs and doc != max((d for d in held[k] if d is not None), default=None) for k in map(key, all_)]
        out.append((doc, len(all_), sum(gone), "\n".join(x for x, g in zip(all_, gone, strict=True) if not g)))
    return Counter(out)


def test_shared_lines_against_brute_force(frame):
    r = random.Random(5)
    pool = ["Shared line of twenty c", "shared LINE of twenty c\r", "  Shared line of twenty c\t", "exactly 20 charactrs", "nineteen characters", "ÀÀÀÀ long line with Àccents", "àààà long line with àccents",
            "", " ", "x" * 500, " Shared line of twenty c"]
    docs = [(r.choice([None, *range(25)]), "\n".join(r.choice(pool) + r.choice(["", "", str(r.randrange(9))]) for _ in range(r.randrange(12)))) for _ in range(60)]
    docs += [(30, None), (31, ""), (32, "\n"), (33, "end\n"), (7, docs[0][1]), docs[3], (40, "Shared line of twenty c\n" * 40_000)]
    df = frame([(*d, "en") for d in docs], DOCS).withColumn("kept", F.lit(1)).withColumn("_line_all", F.lit(2)).withColumn("hash", F.lit("other"))
    got = lines.drop_shared_lines(df)
    assert got.columns == ["doc_id", "text", "lang", "hash", "n_lines", "n_dropped", "kept"]
    rows = got.collect()
    assert Counter((x.doc_id, x.n_lines, x.n_dropped, x.kept) for x in rows) == brute_lines(docs)
    assert {x.hash for x in rows} == {"other"}
    few = lines.drop_shared_lines(df, least_chars=3, least_docs=2).collect()
    assert Counter((x.doc_id, x.n_lines, x.n_dropped, x.kept) for x in few) == brute_lines(docs, 3, 2)
    assert lines.drop_shared_lines(frame([], DOCS)).count() == 0


def test_a_line_in_a_third_of_all_documents_stays_once(frame):
    rows = [(i, f"own {i}\nThis very common footer line" if i % 3 == 0 else f"own {i}", "en") for i in range(3000)]
    out = lines.drop_shared_lines(frame(rows, DOCS))
    assert out.agg(F.sum("n_dropped")).first()[0] == 999 and out.where("kept like '%footer%'").first().doc_id == 2997


# ---- Merkle manifest --------------------------------------------------------


def brute_tree(leaves, arity):
    """The root and, for each leaf, the siblings' digests on its way up."""
    ways, at = [[] for _ in leaves], [{i} for i in range(len(leaves))]
    level = list(leaves)
    while len(level) > 1:
        up, own = [], []
        for k in range(0, len(level), arity):
            run = level[k:k + arity]
            for j in range(len(run)):
                for i in at[k + j]:
                    ways[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(sha("".join(run)))
            own.append(set().union(*at[k:k + arity]))
        level, at = up, own
    return level[0], ways


@pytest.mark.parametrize("arity", [2, 3, 5])
@pytest.mark.parametrize("size", [1, 2, 7, 60])
def test_manifest_against_brute_force(frame, arity, size):
    r = random.Random(size * 10 + arity)
    rows = [(r.choice([None, *range(size)]), f"leaf{r.randrange(size * 2)}", r.choice([None, "", "de", "zé", "Z"]) if size > 2 else "de") for _ in range(size)]
    df = frame(rows, "doc_id bigint, leaf string, lang string").withColumn("path", F.lit("clash")).withColumn("hash", F.lit(0)).withColumn("extra", F.col("leaf"))
    got = merkle.manifest(df.withColumn("leaf", F.sha2("leaf", 256)), arity=arity)
    got = got.withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).withColumn("proof", merkle.siblings(F.col("path"))).collect()
    groups = sorted({x[2] for x in rows}, key=lambda g: (g is not None, (g or "").encode()))
    want, subs = [], []
    for g in groups:
        own = sorted(((k is not None, k or 0, sha(x)) for k, x, lang in rows if lang == g))
        subs.append(brute_tree([x[2] for x in own], arity))
        want.append(own)
    root, tops = brute_tree([s for s, _ in subs], arity)
    expect = Counter()
    for g, own, (sub, ways), top in zip(groups, want, subs, tops, strict=True):
        for (there, k, leaf), way in zip(own, ways, strict=True):
            expect[(k if there else None, g, leaf, sub, root, "".join(a + b for a, b in way + top))] += 1
    assert Counter((x.doc_id, x.lang, x.leaf, x.subroot, x.root, x.proof) for x in got) == expect
    assert all(x.folded == root and sha(x.extra) == x.leaf for x in got)


def test_manifest_edges(frame):
    assert merkle.manifest(frame([], "doc_id bigint, leaf string, lang string")).count() == 0
    one = merkle.manifest(frame([(1, None, None)], "doc_id bigint, leaf string, lang string")).first()
    assert one.subroot == one.root == "" and one.path == []
    df = frame([(1, "x", None), (2, None, "é"), (None, "", "é")], "doc_id bigint, text string, lang string")
    got = [r[0] for r in df.select(merkle.leaf_digest(F.col("doc_id"), F.col("text"), F.col("lang"))).collect()]
    assert got == [sha("1:11:x-"), sha("1:2-2:é"), sha("-0:2:é")]


def test_changed_leaf_is_found(frame):
    df = frame([(i, sha(str(i)), "en" if i % 3 else "de") for i in range(50)], "doc_id bigint, leaf string, lang string")
    got = merkle.manifest(df).withColumn("bad", merkle.fold(F.sha2("leaf", 256), F.col("path")) == F.col("root")).withColumn("good", merkle.fold(F.col("leaf"), F.col("path")) == F.col("root"))
    assert got.where("good and not bad").count() == 50


# ---- conversation repair ----------------------------------------------------


def brute_repair(rows):
    """Faults, cost and the least audit by a plain search over (row, state) with whole audits kept."""
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        solid = text.strip(BLANKS)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {"": (0, "", ())}
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def put(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def inserted(table):
        for _ in range(4):
            for state, (c, a, t) in list(table.items()):
                new = after[state]
                put(table, new, (c + 3, a + "I", (*t, ("user" if new == "u" else "assistant") + ":")))
        return table

    for (_, role, text), fault in zip(rows, faults, strict=True):
        nxt = {}
        for state, (c, a, t) in inserted(best).items():
            put(nxt, state, (c + 4, a + "D", t))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 * (fault == "truncated")
            if role[:1] == after[state] or (state == "" and role[:1] == "s"):
                put(nxt, role[:1], (c + extra, a + "K", (*t, f"{role}:{text}")))
            put(nxt, after[state], (c + extra + 3, a + "R", (*t, ("user" if after[state] == "u" else "assistant") + f":{text}")))
        best = nxt
    cost, audit, text = min(v for s, v in inserted(best).items() if s in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = Counter(faults)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha("\n".join(text))


ROLES, TEXTS = ["system", "user", "assistant", "u", "", " ", "tool", "über"], ["Yes.", "No!", "cut off", " \t", "", "Ends here. \n", "é?", "Maybe", "a:b\nc."]


def random_rows(r, n):
    return [(r.choice([None, r.randrange(n + 2), r.randrange(n + 2)]), r.choice(ROLES[:3] + ROLES), r.choice(TEXTS) if r.random() < .5 else f"t{r.randrange(99)}" + r.choice([".", "", "?"])) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 256])
def test_repair_against_brute_force(frame, block):
    r = random.Random(block)
    convs = {k: random_rows(r, r.choice([1, 2, 3, 5, 8, 21])) for k in [None, *range(40)]}
    rows = [(k, *x) for k, some in convs.items() for x in some]
    r.shuffle(rows)
    df = frame(rows, TURNS).withColumn("cost", F.lit("clash")).withColumn("extra", F.lit(1))
    asked = frame([(None,), (7,), (99,), (99,)], "conv_id bigint")
    got = {x.conv_id: tuple(x)[1:] for x in repair.repair(df, asked, rows_per_block=block).collect()}
    assert got == {k: brute_repair(some) for k, some in convs.items()} | {99: (0, 0, 0, 0, 0, 0, "", sha(""))}


def test_repair_edges(frame):
    assert repair.repair(frame([], TURNS)).count() == 0
    rows = [(1, None, None, None), (2, 0, "user", "Long. " * 200_000), (2, 1, "assistant", "Fine."), (3, 0, "system", "Only."), (4, -5, "assistant", "No question."), (4, 9, "user", "ok?")]
    got = {x.conv_id: x for x in repair.repair(frame(rows, TURNS)).collect()}
    assert (got[1].blank, got[1].audit, got[1].cost, got[1].gaps) == (1, "D", 4, 0)
    assert (got[2].audit, got[2].cost, got[2].repaired_sha256) == ("KK", 0, sha("user:" + "Long. " * 200_000 + "\nassistant:Fine."))
    # put two turns after a system row (6), or delete it (4)
    assert (got[3].audit, got[3].cost, got[3].repaired_sha256) == ("D", 4, sha(""))
    # keeping both needs a turn before and one behind (6), as does changing both roles: I comes before R
    assert (got[4].audit, got[4].cost, got[4].gaps, got[4].illegal) == ("IKKI", 6, 13, 0)


def test_one_long_conversation_in_blocks(frame):
    r = random.Random(3)
    rows = random_rows(r, 700)
    got = repair.repair(frame([(5, *x) for x in rows], TURNS), rows_per_block=16).first()
    assert tuple(got)[1:] == brute_repair(rows)


def test_states_of_the_pattern():
    """Every audit of all shapes of up to four rows gives role initials of the pattern, at the brute-force cost."""
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for n in range(5):
        for kinds in itertools.product("suax", repeat=n):
            code = repair._codes(["".join(chr(97 + "suax".index(k)) for k in kinds)])
            (edits, end), = repair.least_audits(code, repair.END[None, :], repair.np.array([True]), [[0]])[0]
            want = brute_repair([(i, names[k], f"{i}.") for i, k in enumerate(kinds)])
            assert edits.translate(repair.AUDIT) == want[6]
            left, out = list(kinds), ""
            for c in edits:
                out += c.lower() if c in "uaUA" else left[0] if c == "K" else ""
                left = left[1:] if c in "KDUA" else left
            assert re.fullmatch("(s?(ua)+)?", out) and end in (0, 3)
