import hashlib
import random
import zlib
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from placeweave.llm.runs import automaton, candidate_stretches, collapsed, periodic_runs, planted, runs_of, strongest, text_runs
from placeweave.llm.shingles import WORD, Hasher

from .conftest import AWKWARD, words


def brute(ws):
    """Every run by trying every period from every word."""
    n, out = len(ws), set()
    for q in range(1, n // 4 + 1):
        for start in range(n - q):
            if ws[start] == ws[start + q] and (start == 0 or ws[start - 1] != ws[start - 1 + q]):
                end = start
                while end + q < n and ws[end] == ws[end + q]:
                    end += 1
                part = ws[start:end + q]
                if len(part) >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.add((start, len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def result(doc_id, text):
    ws = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(ws)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    runs = brute(ws)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    kept = [w for i, w in enumerate(ws) if not any(s + q <= i < s + m for s, m, q in runs)]

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, int(1000 * Fraction(best[1], best[2])) if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(kept)))


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


repetitive = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=6), st.integers(1, 7)), max_size=6).map(
    lambda parts: [w for piece, times in parts for w in piece * times])


@settings(max_examples=300, deadline=None)
@given(repetitive)
def test_runs_equal_brute_force(ws):
    numbers = {w: i for i, w in enumerate("abc")}
    assert sorted(runs_of([numbers[w] for w in ws]), key=lambda r: (r[0], r[2])) == brute(ws)
    assert text_runs(ws, Hasher(1)) == brute(ws)


def test_runs_between_prose_equal_brute_force():
    draw = random.Random(7)
    for i in range(40):
        ws = words(i, 60).split()
        for _ in range(3):
            piece, at = words(100 + i, draw.randrange(1, 12)).split(), draw.randrange(len(ws))
            ws[at:at] = (piece * 9)[:draw.randrange(3 * len(piece), 9 * len(piece))]
        assert text_runs(ws, Hasher(1)) == brute(ws)


def test_prose_never_reaches_the_automaton():
    line = words(3, 12).split()
    apart = [w for i in range(9) for w in (*words(50 + i, 40).split(), *line)]  # a line that comes again and again, but never on end
    assert candidate_stretches(Hasher(1).words(apart)) == []


def test_automaton_accepts_every_substring():
    ids = [0, 1, 0, 0, 1, 2, 0, 1]
    link, length, prefixes = automaton(ids)
    assert [length[p] for p in prefixes] == list(range(1, 9))
    # The states' length ranges count the distinct substrings.
    assert sum(length[v] - length[link[v]] for v in range(1, len(link))) == len({tuple(ids[i:j]) for i in range(8) for j in range(i + 1, 9)})


def test_awkward_rows(awkward):
    rows = [r for r in AWKWARD if r[0] != 10]
    assert found(periodic_runs(awkward.where("doc_id IS NULL OR doc_id <> 10"))) == sorted((result(i, t) for i, t, *_ in rows), key=str)
    assert periodic_runs(awkward.where("doc_id = 10")).count() == 1


def test_planted_repetitions(docs_of):
    rows = [(i, words(i, 30 + i % 50)) for i in range(200)] + [(i, "one") for i in range(200, 240)]
    got = found(periodic_runs(docs_of(rows)))
    assert got == sorted((result(i, t) for i, t in rows), key=str)
    assert sum(r[1] > 0 for r in got) >= 10


def test_empty_table(nothing):
    assert periodic_runs(nothing).count() == 0


def test_long_runs_take_time_in_proportion():
    ws = ["a", "b", "c"] * 30_000
    assert text_runs(ws, Hasher(1)) == [(0, 90_000, 3)]
    assert collapsed(ws, [(0, 90_000, 3)]) == ["a", "b", "c"]


def test_ties_and_planting_edges():
    assert strongest([(5, 8, 2), (9, 8, 2), (20, 4, 1)]) == (5, 8, 2)
    assert planted(["x"], 1) == ["x"] and planted([], 3) == [] and planted(["a", "b"], None) == ["a", "b"]
