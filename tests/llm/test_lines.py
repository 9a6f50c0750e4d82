from collections import defaultdict

from placeweave.llm.lines import spread_lines, without_boilerplate

from .conftest import words


def brute(rows, sites=10):
    seen = defaultdict(set)
    for _, text, _, site in rows:
        for line in (text or "").split("\n") if text is not None else ():
            if line.strip(" "):
                seen[line.strip(" ")].add(site or "")
    def cut(text):
        lines = text.split("\n") if text is not None else []
        return lines, [len(seen.get(x.strip(" "), ())) >= sites for x in lines]

    def size(lines, chosen):
        return sum(len(x.strip(" ")) for x, c in zip(lines, chosen, strict=True) if c)

    def own(text):
        lines, hit = cut(text)
        return size(lines, hit) <= 0.5 * size(lines, [True] * len(lines))
    home = {}
    for _, text, _, site in rows:
        home[text] = min(home.get(text, site or ""), site or "")
    proof = defaultdict(set)
    for text, site in home.items():
        lines, hit = cut(text)
        for x, h in zip(lines, hit, strict=True):
            if h and own(text):
                proof[x.strip(" ")].add(site)
    out = []
    for i, text, _, _ in rows:
        lines, hit = cut(text)
        gone = [h and (own(text) or len(proof[x.strip(" ")]) >= sites) for x, h in zip(lines, hit, strict=True)]
        if any(gone) and size(lines, [not g for g in gone]):
            out.append((i, "\n".join(x for x, g in zip(lines, gone, strict=True) if not g), sum(gone)))
        else:
            out.append((i, text, 0))
    return sorted(out, key=str)


COPIED = "\n".join(words(i, 12) for i in range(700, 706))


def corpus():
    rows = []
    for i in range(160):
        shared = ["Home | About", " Subscribe now! "] if i % 2 else []
        near = ["On nine sites"] if i % 9 == i % 16 % 9 and i < 9 else []
        rows.append((i, "\n".join([words(i, 30), *shared, "", *near, words(i, 9, "x")]), None, f"src{i % 16}"))
    rows += [(200 + i, "On ten sites\n" + words(i, 20), None, f"src{i}") for i in range(10)]
    rows += [(300 + i, words(999, 40) + "\nHome | About", None, f"src{i % 16}") for i in range(40)]  # a widely copied text
    rows.append((404, "Home | About\nOwn words", None, "src3"))
    rows += [(600 + i, words(600 + i, 20) + "\nHome | About", None, f"src{i}") for i in range(0, 16, 2)]
    rows += [(500 + i, COPIED, None, f"src{i % 16}") for i in range(32)]
    rows += [(540 + i, f"{COPIED}\nedit {i}", None, f"src{i % 16}") for i in range(32)]  # near copies
    return rows + [(400, None, None, None), (401, "", None, None), (402, "Home | About", None, None), (403, "a\n" * 3000 + "Home | About", None, None)]


def found(df):
    return sorted(((r.doc_id, r.text, r.n_removed) for r in df.collect()), key=str)


def test_equals_brute_force(docs_of):
    rows = corpus()
    got = found(without_boilerplate(docs_of(rows)))
    assert got == brute(rows)
    texts = {i: (t, n) for i, t, n in got}
    assert texts[404] == ("Own words", 1)  # mostly boilerplate, and proven elsewhere
    assert texts[402] == ("Home | About", 0)  # nothing would be left
    assert texts[500] == (COPIED, 0)  # lines of a text that is copied everywhere prove nothing
    assert texts[300][1] == 1 and texts[300][0] == words(999, 40)


def test_sketch_alone_decides_far_from_the_threshold(docs_of, spark):
    rows = [(i, "everywhere", None, f"s{i}") for i in range(3000)] + [(i, "here", None, f"s{i % 3}") for i in range(3000)]
    assert spread_lines(docs_of(rows), sites=100).count() == 1


def test_awkward_rows_keep_their_columns(awkward):
    got = without_boilerplate(awkward)
    assert [c for c in got.columns if c != "n_removed"] == [c for c in awkward.columns if c != "n_removed"]
    assert got.count() == awkward.count() and got.where("n_removed <> 0").count() == 0


def test_empty_table(nothing):
    assert without_boilerplate(nothing).count() == 0
