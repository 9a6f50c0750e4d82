import random
from collections import Counter

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from placeweave.llm.repeats import GRAM_LIMITS, LINE_LIMIT, SYMBOLS, Rolling, measures, repetition
from placeweave.llm.shared import SQL
from placeweave.llm.shingles import WORD

from .conftest import AWKWARD, words


def brute(text):
    """The measures by comparing the n-grams themselves."""
    text = text or ""
    ws, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
    again = [line for i, line in enumerate(lines) if line in lines[:i]]
    sizes = [len(w) for w in ws]

    def held(size, first_too):
        grams = [tuple(ws[i:i + size]) for i in range(len(ws) - size + 1)]
        count, seen, at = Counter(grams), set(), set()
        for i, g in enumerate(grams):
            if count[g] > 1 and (first_too or g in seen):
                at.update(range(i, i + size))
            seen.add(g)
        return at
    return [len(ws), sum(sizes), sum(c in SYMBOLS for c in text), len(again), len(held(3, True)),
            sum(len(w) for line in again for w in WORD.findall(line)), *(sum(sizes[i] for i in held(n, False)) for n in GRAM_LIMITS)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb", "c#", "\n", "\n\n", " ", "ü", "\U0001F600"]), max_size=60))
def test_measures_equal_brute_force(parts):
    text = " ".join(parts)
    assert measures(text, Rolling()) == brute(text)


def test_awkward_rows(awkward):
    found = sorted(((r.doc_id, [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words]) for r in repetition(awkward).collect()), key=str)
    assert found == sorted(((i, brute(t)[:5]) for i, t, *_ in AWKWARD), key=str)


def test_empty_table(nothing):
    assert repetition(nothing).count() == 0


def test_verdicts(docs_of):
    prose = words(1, 200)
    line = words(2, 9)
    rows = [(1, prose), (2, "spam " * 200), (3, prose + " " + words(3, 60) * 1), (4, "\n".join([words(5, 30), *[line] * 9])),
            (5, words(4, 49)), (6, prose + "\n" + prose), (7, "\n".join(f"{words(10 + i, 20)}\n{line}" for i in range(4)))]
    kept = {r.doc_id: (r.base_failed, r.kept) for r in repetition(docs_of(rows)).collect()}
    assert kept == {1: (False, True), 2: (True, False), 3: (False, True), 4: (True, False), 5: (True, False), 6: (True, False), 7: (False, True)}


def test_limits_are_shares_of_word_characters(docs_of):
    """One repeated passage of growing length: the verdict turns where a limit is passed, though the base rule still holds."""
    rows = [(n, words(1, 100) + " " + " ".join(words(1, 100).split()[:n])) for n in range(12, 60)]
    for r in repetition(docs_of(rows)).collect():
        over = any(100 * r[f"dup_{n}_chars"] > limit * r.word_chars for n, limit in GRAM_LIMITS.items()) or 100 * r.dup_line_chars > LINE_LIMIT * r.word_chars
        assert r.kept == (not over and not r.base_failed)
    kept = {r.doc_id: r.kept for r in repetition(docs_of(rows)).collect()}
    assert kept[12] and not kept[59]


def test_sql_equals(docs_of, awkward):
    draw = random.Random(5)
    texts = ["".join(draw.choice(["a ", "b ", "c# ", "\n", "dd ", "é&\t"]) for _ in range(draw.randrange(200))) for _ in range(60)]
    docs = docs_of([*AWKWARD, *((100 + i, t) for i, t in enumerate(texts))])
    got = repetition(docs)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.sql(SQL["op11_repetition_rules"]).fetchall()
    names = con.sql(SQL["op11_repetition_rules"]).columns
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(
        str(tuple(None if x != x else int(x) if isinstance(x, float) else x for x in r)) for r in want)
