"""Periodic runs: stretches of words that repeat with a period four times or more, and texts with the repetitions taken out.

A suffix automaton of the words, walked by link-cut access: as each word is appended, the path of suffix links from its prefix to the root is
recoloured with the new end. The path comes in segments that were last coloured at one earlier end; the deepest state of a segment is the
longest suffix whose last occurrence ended there. Where the distance of the two ends is within that length, suffix and occurrence meet or overlap, which is a
square, and both together are the whole repetition up to here; if the next word does not go on with the period, it is a run.
For the last end of a run this distance is its smallest period, so each run is reported once.

Only stretches that can hold a run are given to the automaton. In a run of length m >= 4 q every three-word window has an equal one within
q <= m / 4 words; so a stretch keeps the windows with an equal window at most a quarter of its length away, and what falls apart is cut again. Every run lies in one
such stretch as a whole, and its neighbours outside cannot extend it.

Before all that a text may be given a planted repetition, by its identifier (``planted``).

Rows: every row is judged by itself, so repeated rows are judged alike. A null text is an empty one: no runs. A row without identifier gets no
planted repetition. Ties between runs go to the smallest start, then the smallest period. Words are compared as they are written. Very long texts take memory in proportion
to their own words, one at a time. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.shared import query, slices, table
from placeweave.llm.shingles import WORD, Hasher, mixed

MIN_LENGTH = 6
MIN_PERIODS = 4
_WINDOW = 3
# A stretch is cut this many times at most; after that it goes to the automaton as it is, which changes nothing in the result.
_CUTS = 12
_PLACE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def planted(words: list[str], doc_id: int | None) -> list[str]:
    """The words, of a tenth of all identifiers with a repetition from some place to the end."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def candidate_stretches(hashes: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches of words that may hold runs; together they hold every run."""
    n = len(hashes) - _WINDOW + 1
    if n + _WINDOW - 1 < MIN_LENGTH:
        return []
    with np.errstate(over="ignore"):
        windows = mixed(sum((hashes[i:n + i] ^ (hashes[i:n + i] >> np.uint64(29))) * _PLACE[i] for i in range(_WINDOW)))
    found, waiting = [], [(0, n, 0)]
    while waiting:
        lo, hi, cuts = waiting.pop()
        length = hi - lo + _WINDOW - 1
        if length < MIN_LENGTH:
            continue
        part = windows[lo:hi]
        order = np.argsort(part, kind="stable")
        gap = np.where(part[order[1:]] == part[order[:-1]], np.diff(order), length)
        nearest = np.full(hi - lo, length)
        nearest[order[1:]] = gap
        nearest[order[:-1]] = np.minimum(nearest[order[:-1]], gap)
        near = np.concatenate([[False], nearest <= length // MIN_PERIODS, [False]])
        if near[1:-1].all() or cuts == _CUTS:
            found.append((lo, hi + _WINDOW - 1))
            continue
        edges = np.nonzero(near[1:] != near[:-1])[0]
        long = edges[1::2] - edges[::2] + _WINDOW - 1 >= MIN_LENGTH
        waiting += [(lo + a, lo + b, cuts + 1) for a, b in zip(edges[::2][long].tolist(), edges[1::2][long].tolist(), strict=True)]
    return found


def automaton(ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and length of every state, and the state of every prefix."""
    steps, link, length, prefixes = [{}], [-1], [0], []
    last = 0
    for c in ids:
        now = len(link)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in steps[p]:
            steps[p][c] = now
            p = link[p]
        if p != -1:
            q = steps[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(link)
                steps.append(steps[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and steps[p].get(c) == q:
                    steps[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
        prefixes.append(now)
    return link, length, prefixes


class ColouredPaths:
    """The tree of suffix links as link-cut paths; all states of a path share the end that last coloured them."""

    def __init__(self, link: list[int]):
        self.parent = list(link)
        self.left = [-1] * len(link)
        self.right = [-1] * len(link)
        self.colour = [-1] * len(link)  # meant at the top of a path's splay tree

    def _splay(self, u: int) -> None:
        parent, left, right, colour = self.parent, self.left, self.right, self.colour

        def up(x: int) -> None:
            """One rotation of x over its parent; the colour stays at the top."""
            p = parent[x]
            g = parent[p]
            if g != -1 and left[g] == p:
                left[g] = x
            elif g != -1 and right[g] == p:
                right[g] = x
            else:
                colour[x] = colour[p]
            if left[p] == x:
                child = left[p] = right[x]
                right[x] = p
            else:
                child = right[p] = left[x]
                left[x] = p
            if child != -1:
                parent[child] = p
            parent[p], parent[x] = x, g
        while (p := parent[u]) != -1 and (left[p] == u or right[p] == u):
            g = parent[p]
            if g != -1 and (left[g] == p or right[g] == p):
                up(p if (left[g] == p) == (left[p] == u) else u)
            up(u)

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """Colours the path from ``state`` to the root with ``end``; gives (earlier end, deepest state) of its segments so far."""
        parent, right, colour = self.parent, self.right, self.colour
        below, u, segments = -1, state, []
        while u != -1:
            self._splay(u)
            segments.append((colour[u], u))
            if right[u] != -1:
                colour[right[u]] = colour[u]
            right[u] = below
            below, u = u, parent[u]
        colour[below] = end
        return segments


def runs_of(ids: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a list of word numbers."""
    link, length, prefixes = automaton(ids)
    paths, found, n = ColouredPaths(link), [], len(ids)
    for end, state in enumerate(prefixes):
        for before, deepest in paths.access(state, end):
            period, size = end - before, length[deepest] + end - before
            if before >= 0 and size >= max(MIN_LENGTH, MIN_PERIODS * period) and (end + 1 == n or ids[end + 1] != ids[end + 1 - period]):
                found.append((end + 1 - size, size, period))
    return found


def text_runs(words: list[str], hasher: Hasher) -> list[tuple[int, int, int]]:
    """All runs of a text, by start, then period."""
    found = []
    for lo, hi in candidate_stretches(hasher.words(words)) if len(words) >= MIN_LENGTH else ():
        numbers: dict[str, int] = {}
        found += [(lo + start, size, period) for start, size, period in
                  runs_of([numbers.setdefault(w, len(numbers)) for w in words[lo:hi]])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that any run holds after its first period."""
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, size, period in runs:
        drop[start + period] += 1
        drop[start + size] -= 1
    gone = np.cumsum(drop[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if runs else words


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length over period, compared exactly; of equals the first."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _row(text: str | None, doc_id: int | None, hasher: Hasher) -> tuple:
    words = planted(WORD.findall(text or ""), doc_id)
    runs = text_runs(words, hasher)
    best = strongest(runs)
    return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            _sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs)), _sha256(" ".join(collapsed(words, runs))))


def periodic_runs(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_runs, the strongest run, and digests of all runs and of the collapsed text, a row a row."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(1)
        for rows in slices(batches):
            ids = [None if missing else int(i) for i, missing in zip(rows["doc_id"], rows["doc_id"].isna(), strict=True)]
            found = list(zip(*(_row(t, i, hasher) for t, i in zip(rows["text"], ids, strict=True)), strict=True))
            numbers = [pd.array(x, dtype="Int64") for x in (ids, *found[:5])]
            yield pd.DataFrame(dict(zip(("doc_id", "n_runs", "start", "length", "period", "exponent_milli"), numbers, strict=True))
                               | {"runs_sha256": found[5], "collapsed_sha256": found[6]})
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(compute, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                                     "runs_sha256 string, collapsed_sha256 string")


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"))
