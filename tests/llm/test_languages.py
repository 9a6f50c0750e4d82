import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeweave.llm.languages import LanguageModel, Lattice, Scorer, learn_pieces, predict, read_pieces, train, words_of

EN = "the house was near the river and they walked home through the wood after the rain had gone"
DE = "das haus stand nahe am fluss und sie gingen nach dem regen durch den wald wieder heim und schliefen"


def brute(word, probability, pieces):
    """Sum over all segmentations, by recursion."""
    index, marked = {p: i for i, p in enumerate(pieces) if i}, "▁" + word

    def rest(i):
        if i == len(marked):
            return 1.0
        total = 0.0 if marked[i] in index else probability[0] * rest(i + 1)
        return total + sum(probability[index[marked[i:j]]] * rest(j) for j in range(i + 1, len(marked) + 1) if marked[i:j] in index)
    return rest(0)


@pytest.fixture(scope="module")
def random_model():
    pieces = read_pieces()
    return LanguageModel(["p", "q"], pieces, np.random.default_rng(3).dirichlet(np.ones(len(pieces)), 2).T)


def test_forward_pass_sums_all_segmentations(random_model):
    scorer = Scorer(random_model)
    words = ["a", "hello", "straße", "ñandú", "ψx", "thethe", "internationalisation"]
    scorer.learn([words])
    for word in words:
        want = [math.log(brute(word, random_model.probability[:, k], random_model.pieces)) for k in (0, 1)]
        assert scorer.logs[scorer.known[word]] == pytest.approx(want)
        assert scorer.long_word(word) == pytest.approx(want)


def test_long_words_do_not_vanish(random_model):
    scorer = Scorer(random_model)
    once, many = scorer.long_word("thewaterψ" * 5), scorer.long_word("thewaterψ" * 5000)
    assert np.isfinite(many).all() and many[0] < 900 * once[0]


def test_words_hold_letters_only():
    assert words_of("Größe² x½y ⅧII 五 a1b ½") == ["größe", "x", "y", "ii", "五", "a", "b"]
    assert words_of("² ½ Ⅷ ③ ٣") == [] == words_of(None)
    assert all(p.removeprefix("▁").isalpha() for p in read_pieces()[1:] if p != "▁")


def test_learning_raises_the_likelihood():
    pieces = read_pieces()
    counts = {w: 3 for w in words_of(EN)}

    def likelihood(rounds):
        scorer = Scorer(LanguageModel(["x"], pieces, learn_pieces(counts, Lattice(pieces), len(pieces), rounds)[:, None]))
        scorer.learn([list(counts)])
        return sum(n * scorer.logs[scorer.known[w]][0] for w, n in counts.items())
    steps = [likelihood(r) for r in (1, 2, 4)]
    assert steps == sorted(steps)


def test_held_out_sentences(spark, docs_of):
    rows = [(i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(40)]
    model = train(docs_of(rows))
    got = predict(docs_of([(1, "They were near the house."), (2, "SIE GINGEN NACH HAUS"), (3, "12 ... !!"), (4, None), (5, "the " * 50_000), (6, "² ½ Ⅷ")]), model, keep=("doc_id",))
    assert {r.doc_id: r.lang_pred for r in got.collect()} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "en", 6: "und"}
    assert got.where("score < 0 OR score > 1 OR (lang_pred = 'und' AND score <> 0)").count() == 0


def test_awkward_rows_and_empty_tables(awkward, nothing):
    model = train(awkward)
    got = predict(awkward, model, keep=("doc_id",))
    assert got.count() == awkward.count()
    empty = train(nothing)
    assert predict(nothing, empty).count() == 0
    assert predict(awkward, empty).where(F.col("lang_pred") != "und").count() == 0
