"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features describe its characters and words, and those of the lines before and after it; transition
weights tie neighbouring labels. Training maximises the conditional likelihood of the lines of a bounded sample of labelled documents, a
line carrying its document's label. A document's quality is the mean of its lines' forward-backward marginals, weighted by length.

Scoring is a narrow pass over whole texts: one task reads a document's lines in order, nothing is shuffled.

Rows: a null text counts as empty, which is one empty line. Labels that are null or whose document is missing are not learned from, nor
is a document without identifier. Repeated rows are scored alike. Where nothing can be learned (no labels), every score is 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.shared import query, stored, table

# The bound of the training sample: labelled documents, drawn by hash of the identifier, half of them of either label where possible.
SAMPLE_DOCS = 3000
GOOD_FROM = 0.3
STEPS = 150
PENALTY = 1e-3

# The classes of characters that features count, as the characters of ASCII that belong to them.
CLASSES = {"space": " \t\r", "digit": "0123456789", "ender": ".!?", "comma": ",;:", "pipe": "|<>{}[]", "symbol": "#$%&*+/=@\\^_`~", "mark": "\"'()-", "shout": "!"}
OWN = ("log_chars", "log_words", "word_chars", "upper", "digit", "ender", "comma", "pipe", "symbol", "mark", "shout", "distinct",
       "repeated", "ends_well", "starts_upper", "empty")
_N = len(OWN)
_PART_LINES = 8000
FEATURES = 3 * _N + 3  # of the line, of the one before, of the one after; first, last, constant

_TABLES = {name: np.isin(np.arange(128), [ord(c) for c in members]) for name, members in CLASSES.items()}


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of every line of a text, and the lines' lengths in characters."""
    text = text or ""
    lines = text.split("\n")
    lengths = np.array([len(line) for line in lines])
    codes = np.frombuffer((text + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ascii_codes = np.minimum(codes, 127)

    def share(hits):
        return np.add.reduceat(hits.astype(np.int64), starts) / np.maximum(lengths, 1)
    counts = {name: share(table[ascii_codes]) for name, table in _TABLES.items()}
    own = np.empty((len(lines), _N))
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        upper = len(line) - sum(map(eq, line, line.lower())) if n else 0
        own[i] = (math.log1p(len(line)), math.log1p(n), len(line) / (n + 1) / 10, upper / max(1, len(line)), 0, 0, 0, 0, 0, 0, 0,
                  len(set(words)) / max(1, n), sum(map(eq, words, words[1:])) / max(1, n - 1),
                  line.rstrip().endswith((".", "!", "?")), line.lstrip()[:1].isupper(), n == 0)
    for name in ("digit", "ender", "comma", "pipe", "symbol", "mark", "shout"):
        own[:, OWN.index(name)] = counts[name]
    out = np.zeros((len(lines), FEATURES))
    out[:, :_N] = own
    out[1:, _N:2 * _N] = own[:-1]
    out[:-1, 2 * _N:3 * _N] = own[1:]
    out[0, -3], out[-1, -2], out[:, -1] = 1, 1, 1
    return out, lengths


def marginals(evidence: np.ndarray, stay_bad: float, stay_good: float) -> np.ndarray:
    """Probability that each line is good. ``evidence`` is a line's log-odds by its features; the other two reward equal neighbours."""
    ahead, odds = [], 0.0
    for e in evidence.tolist():  # log-odds of good after every line, summed over the labels before it
        odds = e + (_carry(odds, stay_bad, stay_good) if ahead else 0.0)
        ahead.append(odds)
    after, out = 0.0, np.empty(len(ahead))
    for i in range(len(ahead) - 1, -1, -1):
        out[i] = ahead[i] + after
        after = _carry(float(evidence[i]) + after, stay_bad, stay_good)
    return 1 / (1 + np.exp(-np.clip(out, -700, 700)))


def _carry(odds: float, stay_bad: float, stay_good: float) -> float:
    """Log-odds handed across one transition: log(e^(odds + stay_good) + 1) - log(e^odds + e^stay_bad)."""
    return _softplus(odds + stay_good) - (stay_bad + _softplus(odds - stay_bad))


def _softplus(x: float) -> float:
    return x + math.log1p(math.exp(-x)) if x > 0 else math.log1p(math.exp(x))


def fit(documents: list[np.ndarray], labels: np.ndarray, steps: int = STEPS) -> dict[str, list[float]]:
    """Weights of a chain over lines by gradient ascent (Adam) on the conditional log-likelihood; documents count by their label's rarity."""
    rows = np.concatenate(documents)
    centre, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    centre[-1], scale[-1] = 0, 1
    sizes = np.array([len(d) for d in documents])
    order = np.argsort(sizes, kind="stable")
    # A document is weighed as a whole, so that long ones do not drown the others.
    balance = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    chunks = []
    for part in _parts(order, sizes):
        longest = sizes[part].max(initial=0)
        grid = np.zeros((len(part), longest, rows.shape[1]), dtype=np.float32)
        for i, d in enumerate(part):
            grid[i, :sizes[d]] = np.clip((documents[d] - centre) / scale, -5, 5)
        chunks.append((grid, np.arange(longest)[None, :] < sizes[part][:, None], labels[part].astype(float), balance[part] / sizes[part]))
    weight = np.zeros(rows.shape[1] + 2)
    first, second = np.zeros_like(weight), np.zeros_like(weight)
    for step in range(1, steps + 1):
        gradient = -PENALTY * weight
        for grid, there, label, importance in chunks:
            gradient += _gradient(grid, there, label, importance, weight)
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient ** 2
        weight += 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return {"weights": weight[:-2].tolist(), "stay": weight[-2:].tolist(), "centre": centre.tolist(), "scale": scale.tolist()}


def _parts(order: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Documents of like length together: at most ``_PART_LINES`` padded lines, or one document."""
    parts, part = [], []
    for i in order:
        if part and (len(part) + 1) * sizes[i] > _PART_LINES:
            parts.append(np.array(part))
            part = []
        part.append(i)
    return [*parts, np.array(part, dtype=int)]


def _gradient(grid, there, label, importance, weight) -> np.ndarray:
    """Observed less expected features, and likewise for the two stay weights, over padded documents of one constant label each."""
    bad, good = weight[-2:]
    evidence = np.where(there, grid @ weight[:-2], 0.0)
    lines = grid.shape[1]
    step = np.array([[bad, 0.0], [0.0, good]])  # [label before, label after]
    local = np.stack([np.zeros_like(evidence), evidence], axis=2)
    ahead, behind = np.zeros_like(local), np.zeros_like(local)
    ahead[:, 0] = local[:, 0]
    for i in range(1, lines):
        moved = np.logaddexp(ahead[:, i - 1, :1] + step[0], ahead[:, i - 1, 1:] + step[1])
        ahead[:, i] = np.where(there[:, i, None], moved + local[:, i], ahead[:, i - 1])
    for i in range(lines - 2, -1, -1):
        after = behind[:, i + 1] + local[:, i + 1]
        moved = np.logaddexp(after[:, :1] + step[:, 0], after[:, 1:] + step[:, 1])
        behind[:, i] = np.where(there[:, i + 1, None], moved, behind[:, i])
    total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])[:, None]
    p_good = np.exp(np.minimum(ahead[:, :, 1] + behind[:, :, 1] - total, 0))
    error = np.where(there, (label[:, None] - p_good) * importance[:, None], 0.0)
    out = np.zeros_like(weight)
    out[:-2] = np.tensordot(error, grid, axes=([0, 1], [0, 1]))
    both = there[:, 1:]
    for k, stay in ((0, bad), (1, good)):
        pair = np.exp(np.minimum(ahead[:, :-1, k] + stay + local[:, 1:, k] + behind[:, 1:, k] - total, 0))
        out[-2 + k] = (np.where(both, (label[:, None] == k) - pair, 0.0) * importance[:, None]).sum()
    return out


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "quality",
          sample_docs: int = SAMPLE_DOCS) -> dict | None:
    """Weights learned from about ``sample_docs`` labelled documents, or nothing where there are none."""
    marked = (labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("label IN (0, 1) AND key IS NOT NULL")
              .groupBy("key").agg(F.max("label").alias("label")))
    sizes = {r.label: r["rows"] for r in marked.groupBy("label").agg(F.count("*").alias("rows")).collect()}
    draw = F.pmod(F.xxhash64("key", F.lit("quality")), F.lit(1_000_000))
    chance = F.when(F.col("label") == 1, min(1.0, sample_docs / 2 / max(1, sizes.get(1, 0)))).otherwise(min(1.0, sample_docs / 2 / max(1, sizes.get(0, 0))))
    # At most about sample_docs rows by the draw, so they fit a broadcast.
    chosen = F.broadcast(marked.where(draw < chance * 1_000_000))
    sample = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(chosen, "key")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [line_features(t)[0].astype(np.float32) for t in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "label": batch["label"], "lines": [f.ravel() for f in found]})

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", kind="stable")
        found = fit([np.asarray(x, dtype=np.float32).reshape(-1, FEATURES) for x in group["lines"]], group["label"].to_numpy())
        return pd.DataFrame({k: [v] for k, v in found.items()})
    rows = sample.select(F.col("key").cast("long"), "label", "text").mapInPandas(features, "key long, label int, lines array<float>")
    learned = rows.withColumn("sample", F.lit(0)).groupBy("sample").applyInPandas(learn, "weights array<double>, stay array<double>, centre array<double>, scale array<double>")
    found = stored(learned, "quality-weights").first()
    return found.asDict() if found else None


def score(docs: DataFrame, model: dict | None, *, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and score: the length-weighted share of good lines."""
    if model is None:
        return docs.select(*keep, F.lit(0.5).alias("score"))
    weights, centre, scale = (np.array(model[k]) for k in ("weights", "centre", "scale"))
    bad, good = model["stay"]

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for t in batch:
                features, lengths = line_features(t)
                evidence = np.clip((features - centre) / scale, -5, 5) @ weights
                out.append(float(np.average(marginals(evidence, bad, good), weights=lengths + 1)))
            yield pd.Series(out, dtype="float64")
    return docs.select(*keep, judge(F.col(text)).alias("score"))


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(5)) == 0, F.lit(False))


@query()
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))
    scored = score(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD_FROM).cast("int"))
