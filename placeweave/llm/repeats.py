"""Quality rules on repetition: how many of a text's characters stand in n-grams and lines that it has already said.

The words of a text are hashed once; one running sum of them, scaled by the powers of an odd number, gives the rolling hash of every
n-gram of every length as a difference of two entries. Equal hashes of one length are found by sorting, and the characters of all words
inside later occurrences are measured (a word once, however many n-grams hold it). A text fails when the share of its word characters
that stands in repeated n-grams of any length, or in repeated lines, is over that length's limit.

Before that come plain counts: too few words, or too many words in repeated three-word windows, fail a text whatever the rest says.

Rows: every row is judged by itself, so repeated rows and repeated identifiers are judged alike. A null text is an empty one: no words, and
it fails. Lines and words are compared as they are written. Very long texts take memory in proportion to their own words, one text at a time.
Other columns are not read. An empty table gives no rows. Hashes have 64 bits: two different n-grams of one text are taken for equal with
a chance of about the number of pairs over 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.shared import query, slices, table
from placeweave.llm.shingles import WORD, Hasher

# Per cent of the word characters that repeated n-grams of so many words may hold, and repeated lines.
GRAM_LIMITS = {3: 35, 5: 30, 8: 25, 10: 20}
LINE_LIMIT = 30
MIN_WORDS = 50
WINDOW = 3
MAX_REPEATED = 50
SYMBOLS = "#*$%&|<>"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")


def _powers(factor: int, n: int) -> np.ndarray:
    steps = np.full(n, factor, dtype=np.uint64)
    steps[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(steps)


class Rolling:
    """Rolling hashes of all n-grams of a text, of any length."""

    def __init__(self):
        self.hasher = Hasher(1)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def grow(self, size: int) -> None:
        if len(self.up) < size:
            whole = max(size, 2 * len(self.up))
            self.up, self.down = (_powers(factor, whole) for factor in (_BASE, _INVERSE))

    def prefix(self, words: list[str]) -> np.ndarray:
        """Running sums of the words' hashes, each scaled down by its place."""
        self.grow(len(words))
        with np.errstate(over="ignore"):
            return np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hasher.words(words) * self.down[:len(words)])])

    def grams(self, prefix: np.ndarray, size: int) -> np.ndarray:
        """The hash of the ``size`` words from every place on: a difference of sums, scaled up again by the place."""
        n = len(prefix) - size
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        with np.errstate(over="ignore"):
            return (prefix[size:] - prefix[:n]) * self.up[:n]


def repeated(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose hash came before, and places whose hash comes twice or more."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    later = order[1:][same]
    return later, np.concatenate([later, order[:-1][same]])


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a stretch of ``size`` words from one of ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:n]) > 0


def measures(text: str | None, rolling: Rolling) -> list[int]:
    """The counts in the order of ``_COUNTS``, then the characters in repeated n-grams of every length."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup_lines, dup_line_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup_lines += 1
                dup_line_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    n = len(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    prefix = rolling.prefix(words)
    _, window = repeated(rolling.grams(prefix, WINDOW))
    found = [n, int(sizes.sum()), sum(map(text.count, SYMBOLS)), dup_lines,
             int(covered(window, WINDOW, n).sum()) if len(window) else 0, dup_line_chars]
    for size in GRAM_LIMITS:
        # A repeated n-gram holds repeated windows, so a text without these has nothing to look for.
        later = repeated(rolling.grams(prefix, size))[0] if len(window) or size < WINDOW else window
        found.append(int(sizes[covered(later, size, n)].sum()) if len(later) else 0)
    return found


def repetition(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, the counts, the characters in repeated lines and n-grams, base_failed and kept, a row a row."""
    names = [*_COUNTS, *(f"dup_{size}_chars" for size in GRAM_LIMITS)]

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rolling = Rolling()
        for rows in slices(batches):
            found = pd.DataFrame([measures(t, rolling) for t in rows["text"]], columns=names, index=rows.index)
            yield pd.concat([rows["doc_id"], found], axis=1)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = rows.mapInPandas(compute, "doc_id long, " + ", ".join(f"{name} long" for name in names))
    base = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words"
    limits = {"dup_line_chars": LINE_LIMIT} | {f"dup_{size}_chars": limit for size, limit in GRAM_LIMITS.items()}
    over = " OR ".join(f"100 * {name} > {limit} * word_chars" for name, limit in limits.items())
    return found.withColumn("base_failed", F.expr(base)).withColumn("kept", ~F.col("base_failed") & ~F.expr(over))


@query("""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    listed AS (SELECT r, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM docs),
    word AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM listed),
    gram AS (
        SELECT *, w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p AS g3
        FROM word WINDOW p AS (PARTITION BY r ORDER BY i)),
    wide AS (
        SELECT *, g3 || ' ' || lead(w, 3) OVER p || ' ' || lead(w, 4) OVER p AS g5,
               g3 || ' ' || lead(g3, 3) OVER p || ' ' || lead(w, 6) OVER p || ' ' || lead(w, 7) OVER p AS g8
        FROM gram WINDOW p AS (PARTITION BY r ORDER BY i)),
    wider AS (SELECT *, g8 || ' ' || lead(w, 8) OVER p || ' ' || lead(w, 9) OVER p AS g10 FROM wide WINDOW p AS (PARTITION BY r ORDER BY i)),
    hit AS (
        SELECT r, i, w, g3 IS NOT NULL AND count(*) OVER (PARTITION BY r, g3) > 1 AS twice,
               g3 IS NOT NULL AND row_number() OVER (PARTITION BY r, g3 ORDER BY i) > 1 AS d3,
               g5 IS NOT NULL AND row_number() OVER (PARTITION BY r, g5 ORDER BY i) > 1 AS d5,
               g8 IS NOT NULL AND row_number() OVER (PARTITION BY r, g8 ORDER BY i) > 1 AS d8,
               g10 IS NOT NULL AND row_number() OVER (PARTITION BY r, g10 ORDER BY i) > 1 AS d10
        FROM wider),
    held AS (
        SELECT r, length(w) AS c,
               bool_or(twice) OVER (PARTITION BY r ORDER BY i ROWS 2 PRECEDING) AS twice,
               bool_or(d3) OVER (PARTITION BY r ORDER BY i ROWS 2 PRECEDING) AS c3,
               bool_or(d5) OVER (PARTITION BY r ORDER BY i ROWS 4 PRECEDING) AS c5,
               bool_or(d8) OVER (PARTITION BY r ORDER BY i ROWS 7 PRECEDING) AS c8,
               bool_or(d10) OVER (PARTITION BY r ORDER BY i ROWS 9 PRECEDING) AS c10
        FROM hit),
    words AS (
        SELECT r, count(*) AS n_words, sum(c) AS word_chars, count(*) FILTER (WHERE twice) AS n_repeat_words,
               sum(c) FILTER (WHERE c3) AS dup_3_chars, sum(c) FILTER (WHERE c5) AS dup_5_chars,
               sum(c) FILTER (WHERE c8) AS dup_8_chars, sum(c) FILTER (WHERE c10) AS dup_10_chars
        FROM held GROUP BY r),
    line AS (
        SELECT r, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM docs),
    again AS (
        SELECT r, l, row_number() OVER (PARTITION BY r, l ORDER BY i) > 1 AS dup
        FROM line WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
    lines AS (
        SELECT r, count(*) AS n_dup_lines, sum(length(regexp_replace(l, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS dup_line_chars
        FROM again WHERE dup GROUP BY r),
    counts AS (
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
               coalesce(dup_line_chars, 0) AS dup_line_chars, coalesce(dup_3_chars, 0) AS dup_3_chars,
               coalesce(dup_5_chars, 0) AS dup_5_chars, coalesce(dup_8_chars, 0) AS dup_8_chars, coalesce(dup_10_chars, 0) AS dup_10_chars
        FROM docs LEFT JOIN words USING (r) LEFT JOIN lines USING (r)),
    judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
           n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, dup_line_chars::BIGINT AS dup_line_chars,
           dup_3_chars::BIGINT AS dup_3_chars, dup_5_chars::BIGINT AS dup_5_chars, dup_8_chars::BIGINT AS dup_8_chars,
           dup_10_chars::BIGINT AS dup_10_chars, base_failed,
           NOT base_failed AND 100 * dup_line_chars <= 30 * word_chars AND 100 * dup_3_chars <= 35 * word_chars
           AND 100 * dup_5_chars <= 30 * word_chars AND 100 * dup_8_chars <= 25 * word_chars
           AND 100 * dup_10_chars <= 20 * word_chars AS kept
    FROM judged
""")
def op11_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "documents"))
