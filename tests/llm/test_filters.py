"""Quality rules, decontamination, language profiles, page differencing and the URL filter on small tables."""

import datetime as dt
import functools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import contamination, language, pages, quality, queries, urls

DOCS = "doc_id bigint, text string, lang string"
PROSE = " ".join(f"word{i} then{i} comes{i} before{i} next{i}." for i in range(12))


# ---- quality ----------------------------------------------------------------


@pytest.mark.parametrize("line, rule", [
    ("A whole sentence ends here.", ""), ("He said \"so it is.\"", ""), ("no end at all", "punctuation"), ("One ends. This is cut o", ""),
    ("Home | News | Sport | Weather", "navigation"), ("skip to content", "navigation"), ("© 2024 Someone.", "boilerplate"), ("All rights reserved.", "boilerplate"),
    ("a### b$$$ c%%% d.", "punctuation"), ("BUY!! NOW!! THIS!!", "punctuation")])
def test_line_rules(line, rule):
    assert quality.line_fails(line) == rule


def test_counts_by_hand():
    text = "a b c a b c\na b c a b c\n\n x #|"
    words, chars, symbols, dup, repeat, left, gone, lost = quality.measure(text)
    assert (words, chars, symbols, dup) == (14, 15, 2, 1)
    assert repeat == 12 and gone == 3 and lost == 15 and left == ""


def test_clean_lines_edges(frame):
    df = frame([(1, None, "en"), (2, "", "en"), (3, PROSE + "\nhome\n" + PROSE.upper(), "en"), (3, PROSE, "en"), (3, PROSE, "en"), (4, "x " * 200_000, "en")], DOCS)
    df = df.withColumn("kept", F.lit("clash")).withColumn("extra", F.lit(7))
    rows = quality.clean_lines(df).orderBy("doc_id", "n_words").collect()
    assert [r.kept for r in rows] == [False, False, True, True, True, False]
    assert rows[0].clean_text == "" and rows[0].extra == 7
    assert rows[4].clean_text == PROSE + "\n" + PROSE.upper() and rows[4].n_lines_removed == 1
    assert rows[5].n_repeat_words == 200_000
    assert quality.reject(frame([], DOCS + ", n_chars bigint")).count() == 0


def plain_line_fails(line):
    """The line rules as patterns over the whole line, with nothing looked for beforehand."""
    words, bare = quality.WORD.findall(line), line.strip(quality.SPACES).rstrip(quality.CLOSERS)
    if sum(w in quality.NAV_MARKS for w in words) * 4 > len(words) or quality.NAVIGATION.search(line):
        return "navigation"
    if quality.BOILERPLATE.search(line):
        return "boilerplate"
    marked = sum(line.count(c) for c in quality.SYMBOLS)
    if marked > 2 and marked * 5 > len(words) or len(words) > 2 and bare.count("!") * 3 > len(words):
        return "punctuation"
    return "" if bare.endswith(quality.LINE_ENDS) or quality.SENTENCE_END.search(line) else "punctuation"


def plain_repeated(words):
    windows = list(zip(words, words[1:], words[2:]))
    count = Counter(windows)
    return len({x for i, w in enumerate(windows) if count[w] > 1 for x in (i, i + 1, i + 2)}) if len(words) > 3 else 0


def test_rules_and_repeats_against_plain_ones():
    rng = random.Random(5)
    parts = ["a", "b", "one two", "End.", "go!", "|", "»", "› ", "·", "/ ", "###", "<b>", "\t", "\x0b", "\x1c", "\xa0", " ", "Home", "sıgn in", "SKIP to content", "ALL RİGHTS reſerved", "cooKie", "COOKıE", "Cookies",
             "Droits", "TOUS DROITS RÉSERVÉS", "under the MIT licence", "Under the sun", "Terms of use", "terms of trade", "©", "Copyright ©", "(C) 2024", "(c) x", "SPDX-License", "\ud800", "”", ")"]
    lines = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randint(1, 9))) for _ in range(6000)]
    lines = [x for x in lines if x.strip(quality.SPACES)]
    want = [plain_line_fails(x) for x in lines]
    assert [quality.line_fails(x) for x in lines] == want and min(Counter(want).values()) > 100
    for _ in range(300):
        some = rng.sample(lines, 8) + [" \t"]
        text = "\n".join(rng.choices(some, k=12))
        own = [x for x in text.split("\n") if x.strip(quality.SPACES)]
        n, _, _, dup, repeat, left, gone, lost = quality.measure(text)
        failed = [x for x in own if plain_line_fails(x)]
        assert (n, repeat) == (len(quality.WORD.findall(text)), plain_repeated(quality.WORD.findall(text)))
        assert (dup, gone, lost) == (len(own) - len(set(own)), len(failed), sum(len("".join(quality.WORD.findall(x))) for x in failed))
        assert left == "\n".join(x for x in text.split("\n") if x not in failed)


def test_counts_come_back_without_the_texts(spark, frame, tmp_path):
    docs = frame([(1, PROSE + "\nhome", "en"), (2, None, "en")], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op5_quality_rules(spark, str(tmp_path))
    plan = next(x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "MapInArrow" in x)
    assert "lost_chars" in plan and "text#" not in plan.partition("[")[2]
    whole = quality.clean_lines(docs.select("doc_id", "text")).select(*out.columns)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, whole.collect()))


# ---- decontamination --------------------------------------------------------


def brute(text, items):
    words = [w for w in contamination.normal_words(text) if w]
    hit, found = set(), set()
    for item, t in items:
        own = [w for w in contamination.normal_words(t) if w]
        n = min(10, len(own))
        wins = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n else set()
        for p in range(len(words) - n + 1 if n else 0):
            if tuple(words[p:p + n]) in wins:
                hit |= set(range(p, p + n))
                found.add(item)
    return len(words), len(hit), len(found)


def test_decontamination_against_brute_force(frame):
    items = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short ITEM"), (3, None), (4, "...") , (5, "eleven twelve"), (2, "Short ITEM")]
    texts = ["zero One, two-three four five six seven eight nine TEN eleven twelve", "a short item; short item short", None, "", "shortitem", "é one two " * 5, "four five six seven eight nine ten"]
    docs = frame([(i, t, "x") for i, t in enumerate(texts)], DOCS).withColumn("spans", F.lit(1))
    for size in (10**6, 100):
        out = {r.doc_id: r for r in contamination.scan(docs, frame(items, "item_id bigint, text string"), batch_bytes=size).collect()}
        for i, t in enumerate(texts):
            assert (out[i].n_words, out[i].n_hit, out[i].n_items) == brute(t, items)
            for s in out[i].spans:
                assert [w for w in contamination.normal_words(t[s.start:s.end]) if w]
    assert out[0]["items"] == [1, 5] and texts[0][out[0].spans[0].start:out[0].spans[0].end].startswith("One") and out[0].contaminated
    assert contamination.scan(docs, frame([], "item_id bigint, text string")).where("contaminated").count() == 0
    assert contamination.clean(frame([], DOCS), frame(items, "item_id bigint, text string")).count() == 0


# ---- language ---------------------------------------------------------------


def test_decontamination_by_items_without_an_id(frame):
    quote = "one two three four five six seven eight nine ten"
    items = frame([(None, quote), (7, "alpha beta")], "item_id bigint, text string")
    docs = frame([(1, f"so {quote} end", "en"), (2, "Alpha beta " + quote, "en"), (3, "clean", "en")], "doc_id bigint, text string, lang string")
    for limit in (contamination.BATCH_BYTES, 20):
        got = {r.doc_id: (r.n_hit, r.n_items, r["items"], r.contaminated) for r in contamination.scan(docs, items, batch_bytes=limit).collect()}
        assert got == {1: (10, 0, [], True), 2: (12, 1, [7], True), 3: (0, 0, [], False)}
    assert [r.doc_id for r in contamination.clean(docs, items).collect()] == [3]


def test_language_profiles(frame):
    en, de = "the cat and the dog are in the house with the bird", "der hund und die katze sind in dem haus mit dem vogel"
    rows = [(i, (en if i % 2 else de) + f" {i}", "en" if i % 2 else "de") for i in range(40)] + [(100, None, "en"), (101, "123 ²½ !", "de"), (102, "the house and the bird", None)]
    out = {r.doc_id: r for r in language.train_and_identify(frame(rows, DOCS)).collect()}
    assert all(out[i].lang_pred == rows[i][2] and 0 < out[i].score <= 1 for i in range(40))
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in out)
    assert (out[100].lang_pred, out[101].lang_pred, out[102].lang_pred) == ("und", "und", "en")
    assert {r.lang_pred for r in language.train_and_identify(frame([(1, "abc", None)], DOCS)).collect()} == {"und"}


def brute_language(rows, size):
    """Rank-order profiles with counters over strings: (held_out, language, score) of each row."""
    def grams(text):
        s = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
        found = [s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i:i + n] != " " and (n < 3 or s[i + 1] != " ")]
        return Counter(found) if s.strip() else Counter()

    def first(counts):
        number = lambda g: functools.reduce(lambda a, c: a << 21 | ord(c), g, 0)
        return sorted(counts, key=lambda g: (-counts[g], number(g)))[:size]

    held = [zlib.crc32(str(k).encode()) % 4 == 2 if k is not None else False for k, _, _ in rows]
    train = {}
    for (_, text, lang), out in zip(rows, held, strict=True):
        if not out and lang is not None and text is not None:
            train.setdefault(lang, Counter()).update(grams(text))
    place = {lang: {g: i for i, g in enumerate(first(c))} for lang, c in train.items() if c}
    result = []
    for (_, text, _), out in zip(rows, held, strict=True):
        own = first(grams(text or ""))
        if not own or not any(map(str.isalpha, text)):
            result.append((out, "und", 0.0))
            continue
        far, lang = min((sum(abs(p[g] - i) if g in p else size for i, g in enumerate(own)), lang) for lang, p in place.items())
        result.append((out, lang, round(1 - far / (size * len(own)), 6)))
    return result


@pytest.mark.parametrize("size", [5, 60, 400])
def test_language_against_brute_force(frame, size):
    r = random.Random(size)
    letters = {"aa": "abcdeé", "bb": "bcdfgß", "cç": "xyzabİ"}
    word = lambda some: "".join(r.choice(some) for _ in range(r.randrange(1, 9)))
    rows = [(i, " ".join(word(letters[lang]) for _ in range(r.randrange(1, 40))) + r.choice(["", " 12!", "\n\t_x_", " \u4e2d\u6587"]), lang) for i, lang in enumerate(list(letters) * 25)]
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 \u00b2\u00bd", "aa"), (None, "abc abc", "aa"), (203, "abc", None), (203, "abc", None), (204, "zzz " * 60_000, "cç"), (205, "a", "aa")]
    df = frame(rows, DOCS).withColumn("score", F.lit("clash")).withColumn("n", F.monotonically_increasing_id())
    got = Counter((x.doc_id, x.held_out, x.lang_pred, x.score) for x in language.train_and_identify(df, size).collect())
    assert got == Counter((row[0], *b) for row, b in zip(rows, brute_language(rows, size), strict=True))


def test_gram_counts_across_slabs(monkeypatch):
    text = "the cat sat on the mat " * 20
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "SLAB", 7)
    parts = language.gram_counts(text)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()


# ---- pages ------------------------------------------------------------------


def test_page_lines():
    page = ("<title>t</title><script>var a='<p>';</script><nav><ul><li>Menu</ul></nav><p class=ad>Buy<p>One &amp; <b>t</b>wo<br>three</p>"
            "<div id='comments'><div>no</div></div><footer>f</footer>tail")
    assert [t for t, k in pages.page_lines(page) if k != pages.CHROME] == ["One & two three", "tail"]
    page = "<p>before<article><header><h1>Head</h1></header><p>Body<aside>x</aside></article><p>after"
    assert [t for t, k in pages.page_lines(page) if k == pages.OWN] == ["Head", "Body"]
    assert [t for t, k in pages.page_lines(page) if k == pages.NEUTRAL] == ["before", "after"]
    assert pages.page_lines(None) == [] and pages.page_lines("a < b") == [("a < b", pages.NEUTRAL)]


@pytest.mark.parametrize("bits", [1 << 28, 60, 1])
def test_common_lines_with_repeats(monkeypatch, bits):
    """As long as the table's, a subsequence of both, whether rows are kept whole or pairs halved."""
    monkeypatch.setattr(pages, "ROW_BITS", bits)
    assert len(pages.common_lines([1, 2, 1, 3], [2, 1, 3])) == 3
    for seed in range(1500):
        r = random.Random(seed)
        n = r.choice([2, 4, 9, 50])
        a, b = ([r.randrange(n) for _ in range(r.randrange(16))] for _ in range(2))
        got = [a[i] for i in sorted(pages.common_lines(a, b))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        rest = iter(b)
        assert len(got) == table[-1][-1] and all(x in rest for x in got)


def test_common_lines_against_dynamic_programming():
    import random

    random.seed(5)
    for _ in range(200):
        a, b = ([random.randrange(12) for _ in range(random.randrange(12))] for _ in range(2))
        a, b = list(dict.fromkeys(a)), list(dict.fromkeys(b))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = sorted(pages.common_lines(a, b))
        assert len(got) == best[-1][-1]
        it = iter(b)
        assert all(a[i] in it for i in got)


def test_differencing(frame):
    rows = [(i, f"http://h.org/a/{i:03d}", f"<div>Top</div><p>Own {i}.</p><p>Same end</p>") for i in range(60)]
    rows += [(100, None, "<p>Alone</p>"), (101, "http://other.org/", None), (102, "http://h.org/a/005", rows[5][2])]
    out = {r.page_id: r.text for r in pages.main_text(frame(rows, "page_id bigint, url string, html string")).collect()}
    assert {i: out[i] for i in range(60)} == {i: f"Own {i}." for i in range(60)}
    assert out[100] == "Alone" and out[101] == "" and out[102] == "Own 5." and len(out) == 63
    assert pages.main_text(frame([], "page_id bigint, url string, html string")).count() == 0


def test_class_names_never_drop_an_article():
    def kept(page):
        return [t for t, k in pages.page_lines(page) if k != pages.CHROME]

    assert kept("<article class='post category-search tag-cookies'><p>Body</article>") == ["Body"]
    assert kept("<article class='comments'><p>Body</article><div class='has-sidebar'>Text</div>") == ["Body", "Text"]
    assert kept("<div class=sidebar>Side</div><div id=page class=widget><div class='x menu'><p>In<article><p>Body</article></div>After</div><div class=ad>Buy</div>") == ["In", "Body", "After"]
    assert kept("<div class=widget><div class=ad>Buy</div><main>Body</main></div>") == ["Body"]


def test_differencing_of_runs_longer_than_a_bucket(frame):
    """Pages with equal lines over many buckets have the different pages around them as neighbours, wherever the buckets end."""
    same = "<div>Top</div><p>Copied.</p><p>Same end</p>"
    rows = [(i, f"http://h.org/a/{i:03d}", same if 10 <= i < 150 else f"<div>Top</div><p>Own {i}.</p><p>Same end</p>") for i in range(160)]
    rows += [(1000 + i, f"http://i.org/a/{i:03d}", same) for i in range(60)]
    for parts in (1, 5):
        out = {r.page_id: r.text for r in pages.main_text(frame(rows, "page_id bigint, url string, html string").repartition(parts)).collect()}
        assert {i: out[i] for i in range(160)} == {i: "Copied." if 10 <= i < 150 else f"Own {i}." for i in range(160)}
        assert len(out) == 220 and {out[1000 + i] for i in range(60)} == {"Top\nCopied.\nSame end"}


# ---- URL filter -------------------------------------------------------------


def test_url_filter(frame):
    d = dt.date
    entries = [("l", "bad.org", "add", d(2024, 1, 10)), ("l", "bad.org", "remove", d(2024, 3, 5)), ("l", "bad.org", "add", d(2024, 3, 5)), ("m", "ok.org/x", "add", d(2024, 2, 1)),
               ("l", "bad.org", "add", d(2024, 1, 12)), ("l", None, "add", d(2024, 1, 1)), ("m", "www.bad.org", "add", d(2024, 12, 31))]
    rows = [(1, "http://www.bad.org/p", d(2024, 1, 9)), (2, "http://www.BAD.org:80/p", d(2024, 1, 10)), (3, "https://bad.org", d(2024, 3, 4)), (4, "https://bad.org", d(2024, 3, 5)),
            (5, "http://ok.org/x/y?q", d(2024, 2, 1)), (6, "http://ok.org/xy", d(2024, 6, 1)), (7, None, d(2024, 2, 1)), (8, "http://notbad.org/", d(2024, 2, 1)), (9, "http://bad.org/", None), (5, "http://ok.org/x/y?q", d(2024, 2, 1)),
            (10, "http://www.bad.org/", d(2025, 1, 1))]
    caps = frame([(a, b, str(c) if c else None) for a, b, c in rows], "page_id bigint, url string, fetched date")
    ents = frame([(a, b, c, str(x)) for a, b, c, x in entries], "list string, pattern string, action string, dated date")
    out = [(r.page_id, r.lists, r.pattern) for r in urls.evaluate(caps.withColumn("lists", F.lit(1)), ents).where("blocked").orderBy("page_id").collect()]
    assert out == [(2, "l", "bad.org"), (3, "l", "bad.org"), (5, "m", "ok.org/x"), (5, "m", "ok.org/x"), (10, "m", "www.bad.org")]
    assert urls.evaluate(caps, ents.limit(0)).count() == len(rows)
    assert urls.evaluate(caps.limit(0), ents).count() == 0
