import itertools
import math

import numpy as np
import pytest

from placeweave.llm.quality import FEATURES, _gradient, line_features, marginals, score, train

from .conftest import words


def chain_sum(evidence, bad, good, labels=None):
    """(partition sum, expected goods) by enumeration."""
    total, goods = 0.0, np.zeros(len(evidence))
    for y in itertools.product((0, 1), repeat=len(evidence)):
        weight = math.exp(sum(e * k for e, k in zip(evidence, y, strict=True)) + sum(bad if (p, q) == (0, 0) else good if (p, q) == (1, 1) else 0
                                                                                     for p, q in itertools.pairwise(y)))
        total, goods = total + weight, goods + weight * np.array(y)
    return total, goods / total


def test_marginals_equal_enumeration():
    evidence = np.random.default_rng(2).normal(size=9)
    assert marginals(evidence, 0.6, 1.4) == pytest.approx(chain_sum(evidence, 0.6, 1.4)[1])


def test_gradient_equals_finite_differences():
    draw = np.random.default_rng(4)
    grid, sizes, label = draw.normal(size=(3, 5, 4)), np.array([5, 3, 1]), np.array([1.0, 0.0, 1.0])
    there = np.arange(5)[None, :] < sizes[:, None]
    weight = draw.normal(size=6)

    def likelihood(w):
        out = 0.0
        for x, n, y in zip(grid, sizes, label, strict=True):
            evidence = x[:n] @ w[:-2]
            path = y * evidence.sum() + (n - 1) * (w[-1] if y else w[-2])
            out += path - math.log(chain_sum(evidence, w[-2], w[-1])[0])
        return out
    numeric = [(likelihood(weight + 1e-5 * e) - likelihood(weight - 1e-5 * e)) / 2e-5 for e in np.eye(6)]
    assert _gradient(grid, there, label, np.ones(3), weight) == pytest.approx(numeric, abs=1e-4)


def test_features_are_finite_and_aligned():
    for text in (None, "", "\n\n", "One line", "x" * 100_000, "\ud800 lone", "a\nB!\n### ***"):
        features, lengths = line_features(text)
        lines = (text or "").split("\n")
        assert features.shape == (len(lines), FEATURES) and np.isfinite(features).all() and lengths.tolist() == [len(x) for x in lines]


def test_held_out_documents(spark, docs_of):
    def text(i):
        lines = [f"A sentence with {words(i * 9 + k, 8)}, and an end." for k in range(4)]
        return "\n".join(lines if i % 3 else [f"BUY!! {words(i, 5)} ### *** $$$ | | |" for _ in lines])
    docs = docs_of([(i, text(i)) for i in range(240)])
    labels = spark.createDataFrame([(i, int(bool(i % 3))) for i in range(160)] + [(None, 1), (5, None), (9999, 0)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in score(docs, train(docs, labels), keep=("doc_id",)).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    assert all((s >= 0.5) == bool(i % 3) for i, s in got.items())


def test_awkward_rows_and_empty_tables(spark, awkward, nothing):
    labels = spark.createDataFrame([(2, 0), (6, 1), (9, 0), (10, 1)], "doc_id long, quality int")
    got = score(awkward, train(awkward, labels), keep=("doc_id",))
    assert got.count() == awkward.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert train(nothing, labels) is None
    assert {r.score for r in score(awkward, None).collect()} == {0.5}
