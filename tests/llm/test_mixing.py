import hashlib
from collections import defaultdict

from placeweave.llm.mixing import leaf_budgets, mixed_to_weights

from .conftest import words


def shares(budget, children):
    """Water-filling by repetition: children are name -> (weight, capacity)."""
    out, left = {}, {n: wc for n, wc in children.items() if wc[0] > 0}
    while left:
        total = sum(w for w, _ in left.values())
        full = [n for n, (w, c) in left.items() if c * total <= budget * w]
        if not full:
            until = 0
            for n in sorted(left):
                w = left[n][0]
                out[n] = budget * (until + w) // total - budget * until // total
                until += w
            return out
        n = min(full, key=lambda n: (left[n][1] / left[n][0], n))
        out[n] = left[n][1]
        budget -= left.pop(n)[1]
    return out


def budgets(leaves, weights, percent, epochs):
    """(domain, lang, source) -> budget by recursion over the tree."""
    def weight(depth, name):
        return weights.get(("domain", "lang", "source")[depth], {}).get(name, 1)

    def capacity(prefix):
        if len(prefix) == 3:
            return leaves[prefix] * epochs
        return sum(capacity((*prefix, n)) for n in {k[len(prefix)] for k in leaves if k[:len(prefix)] == prefix} if weight(len(prefix), n) > 0)

    def down(prefix, budget):
        if len(prefix) == 3:
            return {prefix: budget}
        names = {k[len(prefix)] for k in leaves if k[:len(prefix)] == prefix}
        out = {}
        for n, b in shares(budget, {n: (weight(len(prefix), n), capacity((*prefix, n))) for n in names}).items():
            out |= down((*prefix, n), b)
        return out
    return down((), min(sum(leaves.values()) * percent // 100, capacity(())))


def test_budgets_equal_recursion(spark):
    leaves = {(d, la, s): 1 + (i * 7919) % 1000 for i, (d, la, s) in enumerate((d, la, s) for d in "uvw" for la in ("de", "en", "fr") for s in "abcd"[:2 + ord(d) % 3])}
    leaves[("u", "en", "a")] = 3
    for weights, percent, epochs in (({}, 50, 1), ({"domain": {"u": 9}, "lang": {"en": 5}, "source": {"a": 4}}, 130, 3), ({"domain": {"w": 0}, "source": {"b": 0}}, 90, 2), ({"lang": {"fr": 50}}, 400, 2)):
        frame = spark.createDataFrame([(*k, n, 1) for k, n in leaves.items()], "domain string, lang string, source string, tokens long, docs long")
        got = {(r.domain, r.lang, r.source): r.budget for r in leaf_budgets(frame, weights=weights, percent=percent, epochs=epochs).collect()}
        assert got == budgets(leaves, weights, percent, epochs)


def test_selection_is_the_longest_prefix_of_the_next_epoch(docs_of):
    rows = [(i, words(i, 3 + i % 40), "en" if i % 3 else "de", f"src{i % 7 * 3}") for i in range(700)]
    got = {r.doc_id: r.mix_copies for r in mixed_to_weights(docs_of(rows), percent=60, epochs=3, seed=5, rows_per_bucket=7).collect()}
    leaves, members = defaultdict(int), defaultdict(list)
    for i, text, lang, source in rows:
        n = int(source[3:])
        leaf = ("web" if n <= 9 else "books" if n <= 14 else "reference", lang, source)
        leaves[leaf] += len(text.split())
        members[leaf].append((i, len(text.split())))
    from placeweave.llm.mixing import WEIGHTS
    want = {}
    for leaf, budget in budgets(dict(leaves), WEIGHTS, 60, 3).items():
        whole, rest = divmod(budget, leaves[leaf])
        used, open_ = 0, True
        for i, n in sorted(members[leaf], key=lambda m: hashlib.md5(f"5:{whole}:{m[0]}".encode()).hexdigest()):
            used += n
            open_ = open_ and used <= rest
            if whole + open_:
                want[i] = whole + open_
    assert got == want and max(got.values()) > 1


def test_awkward_rows_and_empty_table(awkward, nothing):
    got = mixed_to_weights(awkward, percent=400, epochs=4)
    assert [c for c in got.columns if not c.startswith("mix_")] == [c for c in awkward.columns if not c.startswith("mix_")]
    assert got.where("mix_copies <> 4").count() == 0  # everything that has tokens, as often as it may
    assert got.count() == awkward.where("text rlike '[^\\\\s\\\\x00]'").count()
    assert mixed_to_weights(nothing).count() == 0
