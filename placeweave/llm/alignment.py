"""Cross-tokenizer alignment: which tokens of two vocabularies end together, and how often over the whole corpus.

1. Exact-text deduplication: rows are shuffled by their full text, so each distinct text is tokenised and aligned once, however often it occurs.
2. A space and the text are encoded by a byte-level BPE (A), the text by a SentencePiece BPE (B, which puts the space itself). Byte offsets at
   which tokens of both end cut them into groups; the two tokens that end there are linked.
3. Links are counted by (A id, B id) over the corpus, each text's weighted by its copies; a B id's best count is the largest of its pairs'.
4. Every text's links are looked up in the counts, and the measures are joined to the rows by the text's SHA-256.

The byte-level tokens come from an engine built of the vocabulary file's own entries, whose ids are in the order of its merges (checked). Texts with
characters beyond Latin letters and common punctuation go to the file's own library, since letter classes there may be of another Unicode version.

Rows: null and empty texts, and texts whose tokens of either kind do not join up to the text's bytes, have no tokens: zeros and an empty
digest. Repeated rows each count, and each get their row. A row without identifier is a row like any other. Very long texts take memory in
proportion to their own tokens, a few texts at a time. Ties for a B id's best count are all best.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.shared import query, slices, stored, table
from placeweave.session import few_rows

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# The pair counts are broadcast to the scan of the stored links when there are at most this many (17 bytes each); more are joined by shuffle.
BROADCAST_PAIRS = 1_000_000

_SPACE = "▁"
# How byte-level vocabularies of this kind cut a text before merging (a fixed value of their format).
_WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER_SCRIPTS = re.compile("[^\u0000-\u024f\u2000-\u206f]")


def read_vocabularies(byte_path: str = BYTE_VOCABULARY, piece_path: str = PIECE_VOCABULARY) -> tuple[str, bytes]:
    """Both vocabulary files, read by the driver; tasks get their contents."""
    for path in (byte_path, piece_path):
        if not os.path.exists(path):
            raise FileNotFoundError(f"vocabulary file {path} is missing; give its path as a parameter")
    with open(byte_path, encoding="utf-8") as a, open(piece_path, "rb") as b:
        return a.read(), b.read()


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Encodes a text by both vocabularies and aligns the tokens."""

    def __init__(self, byte_json: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(byte_json)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        parsed = json.loads(byte_json)
        vocab, merges, special = parsed["model"]["vocab"], parsed["model"]["merges"], {t["id"] for t in parsed["added_tokens"]}
        alphabet = byte_alphabet()
        a_bytes = {i: bytes(alphabet[c] for c in entry) for entry, i in vocab.items() if i not in special}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        ranked = merged == list(range(256, 256 + len(merged))) and len(a_bytes) == 256 + len(merged)
        self.engine = tiktoken.Encoding("bytes", pat_str=_WORDS, mergeable_ranks={b: i for i, b in a_bytes.items()}, special_tokens={}) if ranked else None

        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.b_size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.b_size)]
        self.a_bytes = [a_bytes.get(i, b"") for i in range(max(vocab.values()) + 1)]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.sides = [(table, np.array([len(x) for x in table]), *(np.array([f"{i}{mark}" for i in range(len(table))], dtype=object) for mark in marks))
                      for table, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;"))]

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        if self.engine is None or _OTHER_SCRIPTS.search(text):
            a = self.library.encode(" " + text, add_special_tokens=False).ids
        else:
            a = self.engine.encode_ordinary(" " + text)
        return a, self.b.encode(text)

    def align(self, text: str) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups, groups_sha256, and the linked pairs of the text with their numbers."""
        whole = (" " + text).encode()
        encoded = self.encode(text)
        if any(b"".join(map(side[0].__getitem__, ids)) != whole for ids, side in zip(encoded, self.sides, strict=True)):
            return 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)
        ids = [np.array(x) for x in encoded]
        ends = [np.cumsum(side[1][x]) for x, side in zip(ids, self.sides, strict=True)]
        is_end = np.zeros((2, len(whole) + 1), dtype=bool)
        is_end[0, ends[0]] = is_end[1, ends[1]] = True
        last = [is_end[1, ends[0]], is_end[0, ends[1]]]  # the tokens that close a group of their side
        group = [np.cumsum(x) - x for x in last]
        upto = [np.concatenate([[0], np.nonzero(x)[0] + 1]) for x in last]
        # A group's tokens of A come after all earlier ones of B, its tokens of B after its own of A.
        places = np.arange(len(ids[0])) + upto[1][group[0]], np.arange(len(ids[1])) + upto[0][group[1] + 1]
        written = np.empty(len(ids[0]) + len(ids[1]), dtype=object)
        for i, side in enumerate(self.sides):
            written[places[i]] = np.where(last[i], side[3][ids[i]], side[2][ids[i]])
        groups = "".join(written.tolist())[:-1]
        pairs, times = np.unique(ids[0][last[0]] * self.b_size + ids[1][last[1]], return_counts=True)
        return len(ids[0]), len(ids[1]), len(upto[0]) - 1, hashlib.sha256(groups.encode()).hexdigest(), pairs, times


def aligned_texts(texts: DataFrame, vocabularies: tuple[str, bytes]) -> DataFrame:
    """digest, copies, n_a, n_b, n_groups, groups_sha256 and the linked pairs with their numbers, for distinct ``texts`` (text, digest, copies)."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabularies)

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(*shared.value)
        for rows in slices(batches, 64):
            out = rows[["digest", "copies"]].copy()
            found = zip(*map(aligner.align, rows["text"]), strict=True)
            for name, values in zip(("n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"), found, strict=True):
                out[name] = list(values)
            yield out
    return texts.select("text", "digest", "copies").mapInPandas(
        compute, "digest binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>")


def _links(aligned: DataFrame) -> DataFrame:
    """A row for each distinct pair of each distinct text."""
    return (aligned.select("digest", "copies", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
            .select("digest", "copies", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")))


def pair_counts(aligned: DataFrame, pieces: int) -> DataFrame:
    """pair, count (links over the whole corpus) and best (no pair of the same B id has more)."""
    counted = stored(_links(aligned).groupBy("pair").agg(F.sum(F.col("times") * F.col("copies")).alias("count")), "pair-counts")
    b = F.col("pair") % pieces
    highest = counted.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))
    return counted.withColumn("b", b).join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def alignments(docs: DataFrame, *, text: str = "text", key: str = "doc_id", byte_vocabulary: str = BYTE_VOCABULARY,
               piece_vocabulary: str = PIECE_VOCABULARY, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs``."""
    import sentencepiece
    vocabularies = read_vocabularies(byte_vocabulary, piece_vocabulary)
    pieces = sentencepiece.SentencePieceProcessor(model_proto=vocabularies[1]).get_piece_size()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    distinct = rows.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    digest = F.unhex(F.sha2("text", 256))
    aligned = stored(aligned_texts(distinct.withColumn("digest", digest), vocabularies), "aligned-texts")
    counts = stored(pair_counts(aligned, pieces), "pair-bests")
    if few_rows(counts, broadcast_pairs):
        counts = F.broadcast(counts)
    scored = (_links(aligned).join(counts, "pair").groupBy("digest")
              .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")))
    found = stored(aligned.drop("copies", "pairs", "times").join(scored, "digest", "left"), "text-measures")
    joined = rows.select("doc_id", digest.alias("digest")).join(found, "digest", "left")

    def number(name, source=None):
        return F.coalesce(F.col(source or name), F.lit(0)).cast("long").alias(name)
    return joined.select("doc_id", number("n_a"), number("n_b"), number("n_groups"), number("n_links", "n_groups"), number("n_best"),
                         number("count_sum"), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


@query()
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(table(spark, sf_dir, "documents"))
