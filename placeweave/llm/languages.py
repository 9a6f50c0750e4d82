"""Language identification by unigram pieces, summed over every segmentation.

Each language is a distribution over the pieces of a fixed public vocabulary. The probability of a word is the sum, over all
ways to cut it into pieces, of the product of their probabilities (a forward pass over its lattice); a text's is the product over its
words. Probabilities are learned by expectation-maximisation over the same lattices, one task a language, from a bounded sample of
labelled rows. Scoring is a narrow pass: tasks remember words they have scored, so the cost follows distinct words.

Words are runs of letters, lower-cased; everything else is no evidence. A character outside the vocabulary counts as an unknown
piece of its own.

Rows: a null text or one without letters is ``und`` with score 0. Rows with a null label, or a null identifier, are not learned from. Repeated
rows are scored alike. If nothing can be learned (an empty table), every row is ``und``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.shared import query, stored, table
from placeweave.session import counted_side

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNDETERMINED = "und"
# The bound of the training sample: rows a language, drawn by hash of the identifier.
SAMPLE_ROWS = 1000
ROUNDS = 4
REMEMBERED = 400_000
# Longer words are scored on their own, with rescaling, and not remembered.
LONG_WORD = 40
MIN_SCORE = 0.5

_WORD = re.compile(r"[^\W\d_]+")
_START = "▁"
_UNKNOWN = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read_pieces(path: str = VOCABULARY) -> list[str]:
    """Lower-case letter pieces of a SentencePiece vocabulary, with or without the word-start mark; the first is the unknown piece."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return ["<unk>", *sorted({p for p in pieces if p == _START or (p.lower() == p and p.removeprefix(_START).isalpha())})]


def words_of(text: str | None) -> list[str]:
    words = _WORD.findall((text or "").lower())
    if not text or text.isascii():
        return words
    # The pattern also takes number-like characters (superscripts, fractions, Roman numerals); they part words as digits do.
    return [part for w in words for part in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


class Lattice:
    """Every piece that a word can be cut into, as edges between positions."""

    def __init__(self, pieces: list[str]):
        step = {p[:i]: -1 for p in pieces[1:] for i in range(1, len(p))}  # -1: only the beginning of one
        step |= {p: i for i, p in enumerate(pieces) if i}
        hashes = np.array([self._hash(p) for p in step], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(list(step.values()), dtype=np.int64)[order]

    @staticmethod
    def _hash(piece: str) -> int:
        value = 0
        for c in piece:
            value = (value * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return value

    def packed(self, words: list[str]) -> tuple[np.ndarray, int]:
        """Edges of many marked words as columns (word, start, end, piece), and the longest word's end.

        All beginnings of pieces grow by one character at a time, at every position of every word at once, until no
        piece begins like that. A character that is no piece is the unknown one.
        """
        codes = np.frombuffer("".join(_START + w for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        lengths = np.array([len(w) + 1 for w in words], dtype=np.int64)
        ends = np.cumsum(lengths)
        word = np.repeat(np.arange(len(words)), lengths)
        at, size = np.arange(len(codes)), 0
        value = np.zeros(len(codes), dtype=np.uint64)
        found = []
        with np.errstate(over="ignore"):
            while len(at):
                value = value * _BASE + codes[at + size]
                size += 1
                slot = np.minimum(np.searchsorted(self.hashes, value), len(self.hashes) - 1)
                known = self.hashes[slot] == value
                piece = np.where(known, self.ids[slot], -2)
                whole = piece >= 0
                if size == 1:
                    piece, whole = np.where(whole, piece, _UNKNOWN), np.ones(len(at), dtype=bool)
                found.append(np.stack([at[whole], np.full(whole.sum(), size), piece[whole]], axis=1))
                grows = known & (at + size < ends[word[at]])
                at, value = at[grows], value[grows]
        rows = np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)
        start = rows[:, 0] - (ends - lengths)[word[rows[:, 0]]]
        return np.stack([word[rows[:, 0]], start, start + rows[:, 1], rows[:, 2]], axis=1), int(lengths.max(initial=0))


def _sweep(edges: np.ndarray, weight: np.ndarray, words: int, last: int, backward: bool, ends: np.ndarray) -> np.ndarray:
    """Forward (or backward) sums at every position: [word, position, language]."""
    source, target = (2, 1) if backward else (1, 2)
    sums = np.zeros((words, last + 1, weight.shape[1]))
    if backward:
        sums[np.arange(words), ends] = 1
    else:
        sums[:, 0] = 1
    order = np.lexsort((edges[:, 0], edges[:, target]))
    edges, weight = edges[order], weight[order]
    bounds = np.searchsorted(edges[:, target], np.arange(last + 2))
    for at in range(last, -1, -1) if backward else range(1, last + 1):
        lo, hi = bounds[at], bounds[at + 1]
        if lo < hi:
            part = edges[lo:hi]
            first = np.concatenate([[0], np.nonzero(np.diff(part[:, 0]))[0] + 1])
            sums[part[first, 0], at] += np.add.reduceat(sums[part[:, 0], part[:, source]] * weight[lo:hi], first, axis=0)
    return sums


def learn_pieces(counts: dict[str, int], lattice: Lattice, pieces: int, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language from its word counts: expectation-maximisation over all segmentations."""
    probability = np.full(pieces, 1.0 / pieces)
    words = [w for w in counts if len(w) <= LONG_WORD]
    for _ in range(rounds):
        expected = np.full(pieces, 0.05)
        for i in range(0, len(words), 5000):
            some = words[i:i + 5000]
            edges, last = lattice.packed(some)
            ends = np.array([len(w) + 1 for w in some])
            weight = probability[edges[:, 3]][:, None]
            ahead = _sweep(edges, weight, len(some), last, False, ends)[:, :, 0]
            behind = _sweep(edges, weight, len(some), last, True, ends)[:, :, 0]
            k, start, end, piece = edges.T
            total = ahead[np.arange(len(some)), ends]
            share = ahead[k, start] * weight[:, 0] * behind[k, end] / total[k]
            expected += np.bincount(piece, share * np.array([counts[w] for w in some])[k], pieces)
        probability = expected / expected.sum()
    return probability


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[str]
    probability: np.ndarray  # [piece, language]


class Scorer:
    """Log-probabilities of words under every language, remembered."""

    def __init__(self, model: LanguageModel):
        self.lattice, self.probability = Lattice(model.pieces), model.probability
        self.known: dict[str, int] = {}
        self.logs = np.zeros((1 << 12, len(model.languages)))

    def learn(self, texts: list[list[str]]) -> None:
        seen = set().union(*texts)
        new = [w for w in seen.difference(self.known) if len(w) <= LONG_WORD]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = [w for w in seen if len(w) <= LONG_WORD]
        new.sort(key=len)  # words of like length share a batch of short lattices
        while len(self.known) + len(new) > len(self.logs):
            self.logs = np.concatenate([self.logs, np.zeros_like(self.logs)])
        for i in range(0, len(new), 5000):
            some = new[i:i + 5000]
            edges, last = self.lattice.packed(some)
            ends = np.array([len(w) + 1 for w in some])
            sums = _sweep(edges, self.probability[edges[:, 3]], len(some), last, False, ends)
            at = len(self.known)
            self.logs[at:at + len(some)] = np.log(sums[np.arange(len(some)), ends])
            self.known.update(zip(some, range(at, at + len(some)), strict=True))

    def long_word(self, word: str) -> np.ndarray:
        """The same sum for a word of any length: sums are scaled up, and the scale remembered, before they vanish."""
        sums, scale = {0: np.ones(self.probability.shape[1])}, np.zeros(self.probability.shape[1])
        by_end: dict[int, list[tuple[int, int]]] = {}
        done = 0
        edges, _ = self.lattice.packed([word])
        for start, end, piece in edges[np.argsort(edges[:, 1], kind="stable"), 1:].tolist():
            while done < start:
                done += 1
                sums[done] = sum((sums[s] * self.probability[p] for s, p in by_end.pop(done, ())), np.zeros(len(scale)))
                if (sums[done] < 1e-150).any():
                    factor = np.where(sums[done] > 0, 1 / np.maximum(sums[done], 1e-300), 1.0)
                    sums = {at: value * factor for at, value in sums.items() if at > done - 64}
                    scale -= np.log(factor)
                sums.pop(done - 64, None)
            by_end.setdefault(end, []).append((start, piece))
        last = sum((sums[s] * self.probability[p] for s, p in by_end[len(word) + 1]), np.zeros(len(scale)))
        return np.log(np.maximum(last, 1e-300)) + scale

    def text(self, words: list[str]) -> np.ndarray:
        longs = Counter()
        if max(map(len, words)) > LONG_WORD:
            longs = Counter(w for w in words if len(w) > LONG_WORD)
            words = [w for w in words if len(w) <= LONG_WORD]
        at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        total = self.logs[at].sum(axis=0)
        for word, n in longs.items():
            total = total + n * self.long_word(word)
        return total


def train(docs: DataFrame, *, text: str = "text", label: str = "lang", key: str = "doc_id", vocabulary: str = VOCABULARY,
          sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit one distribution a label on at most about ``sample_rows`` rows of each label."""
    pieces = read_pieces(vocabulary)
    rows = docs.select(F.col(text).alias("text"), F.col(label).alias("label"), F.col(key).alias("key")).where("label IS NOT NULL AND key IS NOT NULL")
    sizes = rows.groupBy("label").agg(F.count("*").alias("rows"))
    draw = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit("languages")), F.lit(1_000_000))
    sample = rows.join(counted_side(sizes), "label").where(draw * F.col("rows") < F.lit(sample_rows) * 1_000_000).select("label", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter = Counter()
            for lang, t in zip(batch["label"], batch["text"], strict=True):
                found.update((lang, w) for w in words_of(t))
            yield pd.DataFrame([(lang, w, n) for (lang, w), n in found.items()], columns=["label", "word", "n"])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        learned = learn_pieces(dict(zip(group["word"], group["n"], strict=True)), Lattice(pieces), len(pieces))
        return pd.DataFrame({"label": [group["label"].iloc[0]], "probability": [learned]})
    counted = sample.mapInPandas(count, "label string, word string, n long").groupBy("label", "word").agg(F.sum("n").alias("n"))
    fitted = counted.groupBy("label").applyInPandas(fit, "label string, probability array<double>")
    learned = sorted((r.label, r.probability) for r in stored(fitted, "language-pieces").collect())
    return LanguageModel([lang for lang, _ in learned], pieces, np.array([p for _, p in learned]).T.reshape(len(pieces), -1))


def predict(docs: DataFrame, model: LanguageModel, *, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, lang_pred and score (the posterior of the predicted language, languages being equally likely beforehand)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.pieces, model.probability))

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, scorer = shared.value[0], Scorer(LanguageModel(*shared.value))
        for batch in batches:
            out = []
            for i in range(0, len(batch), 200):
                texts = [words_of(t) for t in batch.iloc[i:i + 200]]
                scorer.learn(texts)
                for words in texts:
                    if not words or not languages:
                        out.append((UNDETERMINED, 0.0))
                        continue
                    logs = scorer.text(words)
                    best = int(logs.argmax())
                    out.append((languages[best], float(1 / np.exp(logs - logs[best]).sum())))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])
    # Else a filter on the verdict is pushed below the projection, and both judge every text, in workers of their own.
    judge = judge.asNondeterministic()
    return docs.select(*keep, judge(F.col(text)).alias("__judged")).select(*keep, "__judged.lang_pred", "__judged.score")


def held_out(key: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(4)) == 2, F.lit(False))


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model, keep=("doc_id", "held_out"))
