"""Main text of web pages: neighbours by URL path within a host are differenced line by line, shared lines go.

Markup speaks first: scripts, menus, footers, forms, adverts and comments are chrome and go; lines inside an article are the page's
own and stay, even where a copy of the article stands next to it. All lines without such a mark stay only if the longest common
subsequence with the nearest different page before or after, in the order of the paths, leaves them out."""

from __future__ import annotations

import bisect
import html as entities
import operator
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parallelism
from tidemark.llm.urls import host_of

OWN, NEUTRAL, CHROME = 0, 1, 2

# Element names of HTML by what they do to text.
RAW = frozenset("script style noscript template textarea title svg iframe object canvas math audio video xmp".split())
HIDDEN = frozenset("head nav footer aside form button select option dialog menu fieldset label input datalist".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup "
    "sidebar widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar comment comments disqus replies related recommended share sharing social pagination "
    "pager notice notices alert disclaimer login search skip toc".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def chrome(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is chrome by its name or role."""
    if tag in HIDDEN or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    roles = ("".join(values).lower().split() for name, *values in NAMED.findall(attributes) if name.lower() == "role")
    return any(r and r[0] in CHROME_ROLES for r in roles)


def chrome_name(tag: str, attributes: str) -> bool:
    """Whether a whole class or id token of an element names chrome; parts of tokens (has-comments, tag-cookies) say nothing."""
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    return any(name.lower() != "role" and not CHROME_NAMES.isdisjoint("".join(values).lower().split()) for name, *values in NAMED.findall(attributes))


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """The lines (blocks of text) of a page in order, each with its kind.

    An element that is chrome by class or id only, and turns out to hold an article or main, is read again as none, with the
    elements open in it."""
    html = html or ""
    lines: list[str] = []
    buffer: list[str] = []
    skip: list[str] = []
    article = main = 0
    kinds: list[tuple[bool, bool, bool]] = []
    named, held = -1, 0  # where the element that is skipped for its name begins, and the lines before it
    opened: list[tuple[str, int]] = []
    depth: Counter[str] = Counter()
    exempt: set[int] = set()

    def flush():
        text = " ".join(entities.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            lines.append(text)
            kinds.append((bool(skip), article > 0, main > 0))

    at, end = 0, len(html)
    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            buffer.append(html[at:])
            break
        buffer.append(html[at:lt])
        m = TAG.match(html, lt) or LOOSE.match(html, lt)
        if not m:
            buffer.append("<")
            at = lt + 1
            continue
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        closing = bool(m.group(1))
        if tag in RAW and not closing:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = close.end() if close else end
            if tag not in ("script", "style"):
                buffer.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            if not closing and len(skip) == 1 and (skip[0] == "p" or tag == skip[0] == "li"):
                skip.pop()  # their end tags may be left out
        elif tag == "br":
            buffer.append(" ")
        if closing:
            if skip and named >= 0 and depth[tag]:
                while True:
                    last = opened.pop()[0]
                    depth[last] -= 1
                    if last == tag:
                        break
            if skip and tag == skip[-1]:
                flush()
                skip.pop()
            elif not skip:
                article -= tag == "article" and article > 0
                main -= tag == "main" and main > 0
        elif tag not in VOID and not m.group(3).endswith("/"):
            if skip:
                if named >= 0 and tag in ("article", "main"):
                    exempt.update((named, *(p for _, p in opened)))
                    del lines[held:], kinds[held:]
                    buffer.clear()
                    skip.clear()
                    at = named
                    continue
                opened.append((tag, lt))
                depth[tag] += 1
                if tag == skip[0]:
                    skip.append(tag)
            elif (by_tag := chrome(tag, m.group(3), article + main > 0)) or (lt not in exempt and chrome_name(tag, m.group(3))):
                flush()
                skip.append(tag)
                named, held = -1 if by_tag else lt, len(lines)
                opened.clear()
                depth.clear()
            else:
                article += tag == "article"
                main += tag == "main"
    flush()
    within = 1 if any(not k[0] and k[1] for k in kinds) else 2 if any(not k[0] and k[2] for k in kinds) else 0
    return [(t, CHROME if k[0] else OWN if within and k[within] else NEUTRAL) for t, k in zip(lines, kinds, strict=True)]


#: Bits of the rows kept for reading a subsequence back; longer pairs are halved first.
ROW_BITS = 1 << 28


def _step(rows: int, matches: dict[int, int], lines: list[int], keep: list[int] | None, full: int) -> int:
    """Bit-parallel rows of the subsequence table: a zero bit is a place of ``b`` at which its length grows."""
    for x in lines:
        m = rows & matches.get(x, 0)
        rows = ((rows + m) | (rows - m)) & full
        if keep is not None:
            keep.append(rows)
    return rows


def _matches(b: list[int]) -> dict[int, int]:
    at: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        at.setdefault(x, []).append(j)
    out = {}
    for x, places in at.items():
        bits = bytearray(places[-1] // 8 + 1)
        for j in places:
            bits[j >> 3] |= 1 << (j & 7)
        out[x] = int.from_bytes(bits, "little")
    return out


def _growth(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each beginning of ``b``."""
    full = (1 << len(b)) - 1
    rows = _step(full, _matches(b), a, None, full)
    bits = np.unpackbits(np.frombuffer(rows.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate(([0], np.cumsum(bits == 0)))


def common_lines(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, lines that repeat included.

    Equal beginnings and ends are taken off. The rest is a table of bits, a row for each line of ``a``, read back from its end; where
    the rows would not fit, ``a`` is halved and ``b`` cut where both halves together have most in common, so memory stays bounded."""
    out: set[int] = set()
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, z = todo.pop()
        while i < k and j < z and a[i] == b[j]:
            out.add(i)
            i, j = i + 1, j + 1
        while i < k and j < z and a[k - 1] == b[z - 1]:
            k, z = k - 1, z - 1
            out.add(k)
        if i == k or j == z:
            continue
        if (k - i) * (z - j) > ROW_BITS and k - i > 1:
            mid = (i + k) // 2
            best = int(np.argmax(_growth(a[i:mid], b[j:z]) + _growth(a[mid:k][::-1], b[j:z][::-1])[::-1]))
            todo += [(i, mid, j, j + best), (mid, k, j + best, z)]
            continue
        full, kept = (1 << (z - j)) - 1, []
        _step(full, _matches(b[j:z]), a[i:k], kept, full)
        row, col = k - i, z - j
        while row and col:
            if kept[row - 1] >> (col - 1) & 1:
                col -= 1
            else:
                row -= 1
                if not row or kept[row - 1] >> (col - 1) & 1:
                    out.add(i + row)
                    col -= 1
    return out


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)


def near_edge(pair: tuple, x: tuple, before: Callable) -> tuple:
    """(the page at one end, the nearest page of its host with other lines) with one more page (host, path, page_id, prints, kinds)."""
    end, other = pair
    if end is None or (before(x, end) and x[0] != end[0]):
        return x, None
    if before(x, end):
        return x, end if x[3:] != end[3:] else other
    if x[0] == end[0] and x[3:] != end[3:] and (other is None or before(x, other)):
        return end, x
    return pair


def lines_digest(prints: bytes, kinds: bytes) -> int:
    return xxhash.xxh3_128_intdigest(len(kinds).to_bytes(8, "little") + prints + kinds)


def across_borders(ends: dict[int, tuple]) -> dict[tuple, set[int]]:
    """The buckets that each page is sent to: the nearest page with other lines before a bucket's first and after its last page.

    ``ends``: of each bucket (first page, nearest different, last page, nearest different) as (host, path, page_id, digest). A run of
    equal pages may span any number of buckets; what is found for one bucket inside it holds for the next."""
    send: dict[tuple, set[int]] = {}
    for order, near, far in ((sorted(ends), 0, 2), (sorted(ends, reverse=True), 2, 0)):
        run = other = None  # the last page so far, and the nearest that differs from it
        for b in order:
            first, last = ends[b][near], ends[b][far]
            if run and run[0] == first[0]:
                found = run if run[3] != first[3] else other
                if found:
                    send.setdefault(found, set()).add(b)
            else:
                found = None
            inner = ends[b][far + 1]
            run, other = last, inner if inner or last[0] != first[0] else found
    return send


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html).

    Null html gives an empty text; pages without a host (null or relative URLs) have no neighbours; equal paths are ordered by
    page_id and then by row; runs of pages with the same lines are one neighbour. Other columns are left out; an empty table
    gives an empty table.

    Pages are dealt to buckets by sampled splitters of (host, path, page_id), so a host with a third of all pages fills many
    buckets. The splitters come from a pass over the URLs alone. A second pass finds the first and last page of each bucket and the
    nearest page with other lines beside them; a bucket is also sent, without its text, the nearest page that differs from its first
    or last one, from however many buckets away, so the result does not depend on where buckets end."""
    spark = pages.sparkSession
    n = parallelism(spark)
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), url.alias("url"), F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"),
                        F.col("html").cast("string").alias("html"))
    key = F.struct("host", "path", F.coalesce("page_id", F.lit(-(2**63))).alias("page_id"))
    edges = rows.select(key.alias("k")).repartitionByRange(n, "k.host", "k.path", "k.page_id").groupBy(F.spark_partition_id().alias("part")).agg(F.min("k").alias("lo"))
    held = spark.sparkContext.broadcast([tuple(r.lo) for r in edges.orderBy("part").collect()])
    page = ["bucket", "host", "path", "page_id", "prints", "kinds"]

    def read_page(host, path, page, html):
        lines = page_lines(html)
        prints = np.array([xxhash.xxh64_intdigest(t) for t, _ in lines], np.uint64).tobytes()
        k = (host, path, -(2**63) if page is None else page)
        return lines, prints, bytes(kind for _, kind in lines), k, max(bisect.bisect_right(held.value, k) - 1, 0)

    def outermost(ends: dict[int, list], b: int, x: tuple) -> None:
        lo, hi = ends.get(b, ((None, None), (None, None)))
        ends[b] = near_edge(lo, x, operator.lt), near_edge(hi, x, operator.gt)

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[int, tuple] = {}
        for batch in batches:
            for key, _, host, path, html in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                _, prints, kinds, k, b = read_page(host, path, key, html)
                outermost(ends, b, (*k, prints, kinds))
        for b, (lo, hi) in ends.items():
            cols = zip(*((b, *x) for x in {*lo, *hi} if x), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=page)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[int, tuple] = {}
        for batch in batches:
            for b, *x in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                outermost(ends, b, tuple(x))
        for b, (lo, hi) in ends.items():
            cols = zip(*((b, i, x[0], x[1], x[2], str(lines_digest(*x[3:]))) for i, x in enumerate((*lo, *hi)) if x), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)], names=["bucket", "i", "host", "path", "page_id", "digest"])

    found = rows.mapInArrow(survey, "bucket int, host string, path string, page_id bigint, prints binary, kinds binary").repartition(n, "bucket").mapInArrow(
        merged, "bucket int, i int, host string, path string, page_id bigint, digest string")
    ends: dict[int, list] = {}
    for r in found.collect():
        ends.setdefault(r.bucket, [None] * 4)[r.i] = (r.host, r.path, r.page_id, int(r.digest))
    sent = spark.sparkContext.broadcast(across_borders({b: tuple(x) for b, x in ends.items()}))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {x[:3] for x in sent.value}
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            out = []
            for page, link, host, path, html in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                lines, prints, kinds, k, b = read_page(host, path, page, html)
                body = pack("\n".join(t for t, kind in lines if kind != CHROME).encode("utf-8", "surrogatepass"))
                row = [host, path, page, link, prints, kinds]
                out.append([b, *row, body])
                if k in wanted:
                    out += [[to, *row, None] for to in sent.value.get((*k, lines_digest(prints, kinds)), ())]
            cols = list(zip(*out, strict=True)) or [()] * 8
            types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["bucket", "host", "path", "page_id", "url", "prints", "kinds", "body"])

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        before = run = None  # (place, prints, kinds, [(page, url, body)])
        out: list[tuple] = []

        def settle(after):
            place, prints, kinds, members = run
            mine = np.frombuffer(prints, np.uint64).tolist()
            shared: set[int] = set()
            if NEUTRAL in kinds:
                for other in (before, after):
                    if other and place[1] and other[0] == place:
                        shared |= common_lines(mine, np.frombuffer(other[1], np.uint64).tolist())
            keep = [i not in shared or k == OWN for i, k in enumerate(kinds) if k != CHROME]
            for page, link, body in members:
                if body is not None:
                    text = unpack(body).decode("utf-8", "surrogatepass")
                    out.append((page, link, text if all(keep) else "\n".join(t for t, k in zip(text.split("\n"), keep, strict=True) if k)))

        def full():
            cols = list(zip(*out, strict=True)) or [()] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string()), strict=True)], names=["page_id", "url", "text"])

        for b in batches:
            for bucket, host, page, link, prints, kinds, body in zip(*(b.column(i).to_pylist() for i in range(7)), strict=True):
                place = (bucket, host)
                if run and run[0] == place and run[1] == prints and run[2] == kinds:
                    run[3].append((page, link, body))
                    continue
                now = (place, prints, kinds, [(page, link, body)])
                if run:
                    settle(now)
                    if len(out) >= 500:
                        yield full()
                before, run = run, now
        if run:
            settle(None)
        yield full()

    parsed = rows.mapInArrow(parse, "bucket int, host string, path string, page_id bigint, url string, prints binary, kinds binary, body binary")
    ordered = parsed.repartition(n, "bucket").sortWithinPartitions("bucket", "host", "path", "page_id", "prints", "kinds", "url")
    return ordered.select("bucket", "host", "page_id", "url", "prints", "kinds", "body").mapInArrow(difference, "page_id bigint, url string, text string")
