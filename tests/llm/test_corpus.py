"""Packing, repeated passages, near-duplicates, chat, shards and the pipeline on small tables, against brute force."""

import hashlib
import random
import struct
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import chat, contamination, neardup, packing, quality, shards, suffixes

DOCS = "doc_id bigint, text string, lang string"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def words(n, seed, size=400):
    r = random.Random(seed)
    return " ".join(f"{r.choice('abcdefghij')}{r.randrange(size)}" for _ in range(n))


# ---- packing ----------------------------------------------------------------


def test_packing_round_trip(frame):
    texts = [words(300, 1), None, "", "Ünïcode’s  don't\tstop!!<|endoftext|>x", "word " * 3000, "x" * 5000, "a"] * 2
    rows = [(i // 2 if i < 4 else i, t, "en") for i, t in enumerate(texts)]
    df = frame(rows, DOCS).withColumn("start", F.lit("clash")).repartition(3)
    t = Tokenizer.from_file(VOCABULARY)
    pieces = packing.pack(df, VOCABULARY, window=64).collect()
    want = sorted((k, t.encode(x or "", add_special_tokens=False).ids + [1]) for k, x, _ in rows)
    docs, seqs = {}, {}
    for p in pieces:
        ids = struct.unpack(f"<{p.length}I", p.ids)
        docs.setdefault((p.doc_id, p.doc_tokens), []).append((p.sequence_id * 64 + p.offset, p.start, ids))
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for s, v in seqs.items():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at == 64 or s == max(seqs)
    got = []
    for (k, n), v in docs.items():
        whole = [i for _, _, ids in sorted(v) for i in ids]
        assert len(whole) % n == 0
        got += [(k, whole[i:i + n]) for i in range(0, len(whole), n)]
    assert sorted(got) == want
    joined = packing.sequences(packing.pack(df, VOCABULARY, window=64)).collect()
    assert sum(r.length for r in joined) == sum(len(x) for _, x in want) and all(len(r.ids) == 4 * r.length for r in joined)
    assert packing.pack(frame([], DOCS), VOCABULARY).count() == 0


def test_packing_capitals_beside_control_marks():
    """Capitals are lower-cased as the normaliser does in texts that hold '<|' too, whatever the memo holds of them already."""
    t = Tokenizer.from_file(VOCABULARY)
    texts = ["<|user|> The Foo, THE foo ÀB Straße İx <|assistant|>Of Course!", "The Foo of The course", "if (A <|> B) Return NULL;", "The foo <|endoftext|> The END<|endoftext|>Foo", "<|ENDOFTEXT|> Bar"]
    for some in ([x] for x in texts), [texts], [texts[::-1]]:
        for part in some:
            packing.MEMO.pop(VOCABULARY, None)
            packing.TOKENIZERS.pop(VOCABULARY, None)
            got = [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in packing.encode_texts(VOCABULARY, part)]
            assert got == [t.encode(x, add_special_tokens=False).ids for x in part]


# ---- repeated passages ------------------------------------------------------


def removed(rows, length):
    seen, out = set(), []
    for k, t in sorted((k, t or "") for k, t in rows):
        raw = t.encode()
        hit = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            if w in seen:
                hit[i:i + length] = b"\1" * length
            seen.add(w)
        out.append((k, len(raw), sum(hit), bytes(c for c, h in zip(raw, hit, strict=True) if not h)))
    return out


@pytest.mark.parametrize("hot", [20_000, 3])
def test_repeats_against_brute_force(spark, frame, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    passage, other = words(40, 2), "é" * 130 + words(30, 3)
    texts = [passage, words(50, 4) + passage + words(20, 5), words(9, 6) + passage[30:170] + words(9, 7), None, "", "a" * 400, "b" + "a" * 300, other, words(5, 8) + other,
             other[3:], passage, "ab" * 200, passage + passage, "short"]
    texts += [words(12, 50 + i) + passage[:120] + words(3, 90 + i) for i in range(12)]
    rows = [(i * 3, t, "x") for i, t in enumerate(texts)]
    df = frame(rows, DOCS).withColumn("kept", F.lit(1)).repartition(4)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in suffixes.remove_repeats(df).collect())
    assert got == removed([r[:2] for r in rows], 100)
    texts_left = {r.doc_id: r.clean_text for r in suffixes.remove_repeats(df).collect()}
    assert texts_left[9] is None and all(set(t or "") <= set(texts[k // 3] or "") for k, t in texts_left.items())


def test_repeats_with_repeated_ids_and_no_rows(frame):
    a, b = words(60, 11), words(60, 12)
    rows = [(1, a, "x"), (1, a, "x"), (1, b, "x"), (2, a + b, "x"), (None, b, "x")]
    out = suffixes.remove_repeats(frame(rows, DOCS)).collect()
    by = {}
    for r in out:
        by.setdefault((r.doc_id, r.n_bytes), set()).add(r.n_removed)
    assert len(out) == 5 and by[(1, len(a))] == {0} and by[(None, len(b))] == {0} and by[(1, len(b))] == {len(b)}
    assert by[(2, len(a + b))] == {len(a + b)}
    assert suffixes.remove_repeats(frame([], DOCS)).count() == 0
    assert suffixes.without_repeats(frame(rows, DOCS)).count() == 3


def test_repeats_of_a_passage_in_every_document(spark, frame, monkeypatch):
    """A context row holds no other places than its own, and one window's rows are dealt over several tasks."""
    kept = {}
    keep = suffixes.stored
    monkeypatch.setattr(suffixes, "HOT", 50)
    monkeypatch.setattr(suffixes, "stored", lambda df, name: kept.setdefault(name, keep(df, name)))
    monkeypatch.setattr(suffixes, "drop_stored", lambda df: None)
    passage = words(40, 21)
    rows = [(i, words(3, 100 + i) + passage + words(3, 500 + i), "x") for i in range(300)]
    out = suffixes.remove_repeats(frame(rows, DOCS).repartition(16)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in out) == removed([r[:2] for r in rows], 100)
    assert all(len(v) <= 200 if isinstance(v, (bytes, bytearray, list)) else True for r in kept["contexts"].collect() for v in r)
    assert not any(isinstance(v, list) for r in kept["contexts"].limit(50).collect() for v in r)
    window = passage[:100].encode()
    many = spark.createDataFrame([(window, i, 7) for i in range(2000)] + [(window, 0, 7), (window[1:] + b"x", 5, 8)], "context binary, doc bigint, place bigint")
    kept.clear()
    assert sorted(map(tuple, suffixes.hot_repeats(many).distinct().collect())) == [(i, 7, 7) for i in range(1, 2000)]
    assert sum(r.head is not None and bytes(r.head) == window for r in kept["hot"].collect()) > 2


def test_multikey_classes():
    import numpy as np

    r = random.Random(1)
    strings = [bytes(r.choice(b"ab") for _ in range(16)) for _ in range(300)] * 2
    flat = np.frombuffer(b"".join(strings) + bytes(8), np.uint8)
    at = np.arange(600) * 16
    group = suffixes.multikey_classes(600, 2, lambda c, rows: suffixes.eight_bytes(flat, at[rows] + 8 * c, 16 - 8 * c))
    order = np.argsort(group, kind="stable")
    assert [strings[i] for i in order] == sorted(strings)
    assert all((group[i] == group[j]) == (strings[i] == strings[j]) for i in range(0, 600, 7) for j in range(0, 600, 11))


# ---- near-duplicates --------------------------------------------------------


def linked(rows, width, percent):
    sets = {}
    for k, t in rows:
        w = (t or "").split()
        sets[k] = {tuple(w)} if 0 < len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def test_near_duplicates_against_brute_force(frame, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)  # so that nodes of a few documents branch
    r = random.Random(7)
    rows, base = [], words(80, 20).split()
    for i in range(60):
        w = list(base)
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = f"new{r.randrange(1000)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, words(60, 200 + i // 2)) for i in range(30)] + [(200 + i, "one shared line of words " + words(40, 300 + i)) for i in range(30)]
    rows += [(300, None), (301, ""), (302, "two words"), (303, "Two WORDS"), (304, " \n"), (305, "éÉ é"), (306, "word " * 5000), (307, "word " * 4000)]
    r.shuffle(rows)
    df = frame([(k, t, "x") for k, t in rows], DOCS).withColumn("kept", F.lit("clash"))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(df).collect()}
    assert got == linked([(k, t and t.translate({c: c + 32 for c in range(65, 91)})) for k, t in rows], 4, 80)
    left = neardup.representatives(df)
    assert left.columns == df.columns and {x.doc_id for x in left.collect()} == {k for k, (_, c) in linked(rows, 5, 80).items() if c == k} - {303}


def test_near_duplicates_edges(frame):
    t = words(50, 31)
    rows = [(5, t, "x"), (5, t, "x"), (7, t, "x"), (None, t, "x"), (5, words(50, 32), "x"), (9, words(50, 32), "x")]
    got = sorted(((x.doc_id or -1, x.component_id, x.kept) for x in neardup.near_duplicates(frame(rows, DOCS)).collect()), key=str)
    assert sorted(got, key=str) == sorted([(5, 5, True)] * 3 + [(7, 5, False), (9, 5, False), (-1, None, True)], key=str)
    assert neardup.near_duplicates(frame([], DOCS)).count() == 0


# ---- chat and shards --------------------------------------------------------

NASTY = ["<|im_end|>", "\\", "<\\|", "\\<|", "<|turn|>\\\\", "a\n<", "|im_start|>", "", "é<|nl|>\n", "<|" * 3 + "\\" * 3]


def test_chat_round_trip(frame):
    rows = [(1, i, ["user", "assistant", "assistant", "we\nird<|"][i % 4], t) for i, t in enumerate(NASTY * 2)]
    rows += [(2, 0, None, None), (None, 1, "assistant", "x"), (1, 3, "user", "tie"), (3, 0, "user", "hi"), (3, 0, "user", "hi")]
    df = frame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1))
    out = chat.formatted(df).select("conv_id", chat.parsed(F.col("formatted")).alias("turns"), chat.under_loss(F.col("segments")).alias("loss")).collect()
    for r in out:
        want = sorted((t, ro or "", x or "") for c, t, ro, x in rows if c == r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == [(ro, x) for _, ro, x in want]
        assert r.loss == "".join(x for _, ro, x in want if ro == "assistant")
    assert len(out) == 4 and chat.formatted(df.limit(0)).count() == 0


def jump(key, n):
    at, to = -1, 0
    while to < n:
        at, key = to, (key * 2862933555777941757 + 1) % 2**64
        to = int((at + 1) * (2.0**31 / ((key >> 33) + 1)))
    return at


def test_jump_shards(frame):
    ids = [0, 1, -1, 2**63 - 1, -(2**63), None, 7, 7, *range(1000, 1200)]
    df = frame([(k, f"té{i}" if i % 3 else None, "x") for i, k in enumerate(ids)], DOCS).withColumn("shard", F.lit("clash"))
    rows = shards.assign(df, 10, rows_per_part=50).collect()
    assert len(rows) == len(ids)
    for r in rows:
        assert (r.shard, r.grown_shard) == (jump((r.doc_id or 0) % 2**64, 10), jump((r.doc_id or 0) % 2**64, 11))
        assert r.grown_shard in (r.shard, 10)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert {r.size for r in rows if r.text_crc32 == 0} == {16} and zlib.crc32("té1".encode()) in {r.text_crc32 for r in rows}
    assert shards.assign(df.limit(0), 10).count() == 0


# ---- pipeline ---------------------------------------------------------------


def test_pipeline_against_brute_force(spark, tmp_path, frame):
    passage, item = words(40, 70, 4000), words(14, 71, 4000)
    base = [words(90, 400 + i, 4000) for i in range(12)]
    texts = [b + "." for b in base] + [base[0] + ".", base[1] + " changed.", base[2][:200] + passage + base[3][200:] + ".", words(70, 600, 4000) + passage + words(30, 601, 4000) + ".",
                                       words(80, 602, 4000) + " " + item + ".", "too short.", None, words(60, 603, 4000) + ".\nAll rights reserved."]
    frame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS + ", source string, n_chars bigint").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    frame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, quality.measure(t)) for i, t in enumerate(texts)]
    rows = [(i, m[5]) for i, m in rows if m[0] >= 50 and 2 * m[4] <= m[0] and 2 * m[7] <= m[1]]
    rows = [(i, t) for i, t in rows if linked(rows, 5, 80)[i][1] == i]
    rows = [(k, left.decode()) for k, _, _, left in removed(rows, 100) if left]
    rows = [(k, t) for k, t in rows if not any(f" {w.decode()} " in f" {t.replace('.', ' ')} " for w in contamination.windows(item))]
    t = Tokenizer.from_file(VOCABULARY)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = {}
    for p in sorted(out, key=lambda p: (p.doc_id, p.start)):
        got[p.doc_id] = got.get(p.doc_id, b"") + bytes(p.ids)
    assert {k: hashlib.sha256(v).hexdigest() for k, v in got.items()} == {
        k: hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest() for k, x in rows for ids in [t.encode(x, add_special_tokens=False).ids + [1]]}
    assert 5 < len(got) < len(texts) - 4
