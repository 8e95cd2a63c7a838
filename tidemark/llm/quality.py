"""Quality rules, line first: lines that fail punctuation, navigation or boilerplate rules go, then documents that lost too much.

The rules look at whole lines of whole texts. Null text counts as empty, has no words and is rejected; ties cannot occur.
Repeated rows are judged alike, an empty table gives an empty table, other columns pass through."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, field

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50

# Characters counted as symbols by the contract.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINE_ENDS = (".", "!", "?", "…", "。", "！", "？", ":", ";")
CLOSERS = "\"'”’»)]"
BOILERPLATE = re.compile(
    r"all rights reserved|alle rechte vorbehalten|tous droits réservés|todos los derechos reservados|licensed under|under the .{0,40}licen[cs]e"
    r"|terms of (?:use|service)|privacy policy|cookie|enable javascript|copyright ©|^©|\(c\) \d{4}|spdx-license", re.I)
NAVIGATION = re.compile(r"(?:\S\s*(?:\||»|›|/ |·)\s+){3}|^\s*(?:home|menu|next|previous|prev|back|login|sign in|search|share|skip to content)\s*$", re.I)
#: A line that is cut off after whole sentences is prose all the same.
SENTENCE_END = re.compile(r"\w[.!?…][\"'”’»)]*\s+\w")
NAV_MARKS = frozenset("|»›·")
#: What every match of ``BOILERPLATE`` holds, in small letters, and the length of the longest menu entry of ``NAVIGATION``. Searches for
#: whole texts are many times as fast as patterns that ignore case, which then run on the few lines that can match.
BOILERPLATE_HOLDS = (
    "all rights reserved", "alle rechte vorbehalten", "tous droits réservés", "todos los derechos reservados", "licensed under", "under the ", "terms of ", "privacy policy",
    "cookie", "enable javascript", "©", "(c) ", "spdx-license")
MENU_CHARS = len("skip to content")
#: Letters that a pattern takes for an i or an s and lower() does not: a line with one is left to the pattern.
ODD_LETTERS = ("\u0130", "\u0131", "\u017f")


def byte_words(text: str) -> list[bytes]:
    """The words of a text: bytes are split at the six blanks of ``SPACES`` only, as ``WORD`` does."""
    return text.encode("utf-8", "surrogatepass").split()


def may_hold_boilerplate(text: str) -> bool:
    low = text.lower()
    return any(x in low for x in BOILERPLATE_HOLDS + ODD_LETTERS)


def line_fails(line: str, n_words: int | None = None, boilerplate: bool = True, symbols: bool = True) -> str:
    """The rule that a line with a word breaks, or an empty string. ``boilerplate`` and ``symbols``: whether its text may hold enough of
    them to break a rule."""
    n = len(byte_words(line)) if n_words is None else n_words
    marks = line.count("|") + line.count("»") + line.count("›") + line.count("·") + line.count("/ ")
    if marks and sum(w in NAV_MARKS for w in WORD.findall(line)) * 4 > n:
        return "navigation"
    if (marks > 2 or len(line.strip()) <= MENU_CHARS) and NAVIGATION.search(line):
        return "navigation"
    if boilerplate and may_hold_boilerplate(line) and BOILERPLATE.search(line):
        return "boilerplate"
    marked = sum(map(line.count, SYMBOLS)) if symbols else 0
    if marked * 5 > n and marked > 2:
        return "punctuation"
    bare = line.strip(SPACES).rstrip(CLOSERS)
    if bare.count("!") * 3 > n and n > 2:
        return "punctuation"
    if not bare.endswith(LINE_ENDS) and not SENTENCE_END.search(line):
        return "punctuation"
    return ""


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    # equal windows have equal sums of hashes, so only windows whose sum comes twice are compared by their words
    h = np.fromiter(map(hash, words), np.int64, n)
    sums = (h[:-2] * 31 + h[1:-1]) * 31 + h[2:]
    k = np.sort(sums)
    again = k[1:][k[1:] == k[:-1]]
    if not len(again):
        return 0
    again = set(again.tolist())
    windows = [(i, tuple(words[i:i + 3])) for i, x in enumerate(sums.tolist()) if x in again]
    count = Counter(w for _, w in windows)
    at = np.array([i for i, w in windows if count[w] > 1], np.int64)
    hit = np.zeros(n, bool)
    for i in range(3):
        hit[at + i] = True
    return int(hit.sum())


def measure(text: str | None) -> tuple:
    """Counts, the text without failing lines, and what went."""
    text = text or ""
    blanks = sum(map(text.count, SPACES))
    chars = len(text) - blanks
    symbols = sum(map(text.count, SYMBOLS))
    boilerplate = may_hold_boilerplate(text)
    words, seen, dup, left, gone, lost = [], set(), 0, [], 0, 0
    for line in text.split("\n"):
        own = byte_words(line)
        if not own:
            left.append(line)
            continue
        words += own
        if line in seen:
            dup += 1
        seen.add(line)
        if line_fails(line, len(own), boilerplate, symbols > 2):
            gone += 1
            lost += len(line) - sum(map(line.count, SPACES))
        else:
            left.append(line)
    return len(words), chars, symbols, dup, repeated_words(words), "\n".join(left) if gone else text, gone, lost


def clean_lines(docs: DataFrame, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
                max_lost_percent: int = MAX_LOST_PERCENT, texts: bool = True) -> DataFrame:
    """Every row of ``docs`` (text) with its counts, ``clean_text``, ``n_lines_removed``, ``lost_chars``, ``base_failed`` and ``kept``.

    One pass without a shuffle. ``kept`` is false for documents that fail the base counts or lose more than
    ``max_lost_percent`` of the characters in their words to removed lines. Without ``texts`` neither ``text`` nor ``clean_text``
    comes back from the workers: for callers that need the counts and the verdict only."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "clean_text", "n_lines_removed", "lost_chars"]

    def make(cols):
        rows = list(map(measure, cols["text"]))
        return {n: [r[i] for r in rows] for i, n in enumerate(names) if texts or n != "clean_text"}

    added = [field(n, "string" if n == "clean_text" else "long") for n in names if texts or n != "clean_text"]
    out = add_columns(docs, added, make, ["text"], [] if texts else ["text", "clean_text"])
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= max_lost_percent * F.col("word_chars")))


def reject(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the cleaned text, in the columns of ``docs``."""
    kept = clean_lines(docs).where("kept")
    return kept.withColumn("text", F.col("clean_text")).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)
