"""Benchmark decontamination by templates: numbers, names and units become typed placeholders before windows are compared.

Both sides are cut into windows of ``WINDOW`` tokens. Each window is hashed plainly (lower-cased words; numbers and units as
placeholders) and, where it holds a name, once more with the names as placeholders, so re-cased copies and re-named
questions are both met. A window with too few other words is hashed with its numbers and units as they are, and an item shorter than a window
as one window of its own length, word for word. A bitmap of fixed size, built from the benchmark's windows, lets a scanning task drop nearly all of a document's
windows at once; what is left is hash-joined with the benchmark. For a text and an item the windows must line up, cover most of the
item, and fill its slots consistently: one value of the item always with the same value of the text, and the other way round.

A name is a capitalised word that does not begin a sentence. A unit is one of a fixed list, right after a number.

Rows: a null or empty text has no windows and is clean; a benchmark item without tokens is never found. Texts are judged once however many rows carry them; repeated rows and repeated items share one verdict. A row without identifier is judged like any other.
Other columns are passed on unread. An empty table on either side finds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.shared import query, slices, stored, table
from placeweave.llm.shingles import mixed

WINDOW = 6
MIN_LITERALS = 3
COVERAGE = 0.7
# Offsets that still count as one alignment: words put in or left out shift the rest of a passage.
DRIFT = 8
BITMAP_BITS = 1 << 26
REMEMBERED = 200_000
# Characters of texts that are cut into windows at once.
CHARACTERS = 200_000

# Words that are units when they follow a number.
UNITS = frozenset(
    "m cm mm km mi ft in yd g kg mg lb oz t l ml s ms min h hr hrs sec secs mins hour hours minute minutes second seconds day days "
    "week weeks month months year years metre metres meter meters mile miles foot feet inch inches yard yards gram grams kilogram "
    "kilograms pound pounds ounce ounces ton tons litre litres liter liters percent degrees degree dollar dollars euro euros cent "
    "cents usd eur gbp mph kmh kw kwh w v a hz kb mb gb tb".split())

_TOKEN = re.compile(r"[^\W\d_][^\W_]*|\d+(?:[.,:/]\d+)*|[.!?\n%$€£°]")
_ENDS = frozenset(".!?\n")
_MARKS = frozenset("%$€£°")
# Tokens and placeholders enter the hash of a window mixed.
with np.errstate(over="ignore"):
    _NUM, _NAME, _UNIT = mixed(np.array([xxhash.xxh3_64_intdigest(f"<{kind}>") for kind in ("num", "name", "unit")], dtype=np.uint64))
_TIMES = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(WINDOW)], dtype=np.uint64)
# Where the hash of a window of so many tokens as they are starts from; templates start from zero.
_AS_IT_IS = np.array([xxhash.xxh3_64_intdigest(f"<as it is {n}>") for n in range(WINDOW + 1)], dtype=np.uint64)
_END, _CAPITAL, _NUMBER, _UNITWORD, _MARK = 1, 2, 4, 8, 16

WINDOWS = "whole binary, hash long, pos int, slots array<string>"


def _words(text: str | None) -> list[str]:
    return [t for t in _TOKEN.findall(text or "") if t not in _ENDS]


class Canonical:
    """Cuts texts into windows; remembers the tokens it has met."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.kinds = np.zeros(1 << 12, dtype=np.uint8)
        self.spread = np.zeros(1 << 12, dtype=np.uint64)

    def _numbers(self, tokens: list[str]) -> np.ndarray:
        """Where kinds and hashes of the tokens stand."""
        if len(self.known) > REMEMBERED:
            self.__init__()
        new = set(tokens).difference(self.known)
        while len(self.known) + len(new) > len(self.kinds):
            self.kinds, self.spread = (np.concatenate([x, np.zeros_like(x)]) for x in (self.kinds, self.spread))
        first, hashes = len(self.known), []
        for t in new:
            word = t.lower()
            kind = (_END if t in _ENDS else _MARK if t in _MARKS else _NUMBER if t[0].isdecimal()
                    else (_CAPITAL if t[0].isupper() and t[1:] == word[1:] else 0) | (_UNITWORD if word in UNITS else 0))
            i = self.known[t] = len(self.known)
            self.kinds[i] = kind
            hashes.append(xxhash.xxh3_64_intdigest(word))
        with np.errstate(over="ignore"):
            self.spread[first:first + len(hashes)] = mixed(np.array(hashes, dtype=np.uint64))
        return np.fromiter(map(self.known.__getitem__, tokens), dtype=np.int64, count=len(tokens))

    def windows(self, text: str | None, short: tuple[int, ...] | None = None) -> tuple[np.ndarray, np.ndarray, callable]:
        """Hashes, token positions, and a function that lists the slots of the i-th window as ``place:type:value``.

        ``short`` lists the sizes below ``WINDOW`` to cut too; by default, a text with fewer tokens is one window.
        """
        if short is None:
            n = len(_words(text))
            short = (n,) if 0 < n < WINDOW else ()
        hashes, _, pos, slots = self.windows_of([text], short)
        return hashes, pos, slots

    def windows_of(self, texts: list[str | None], short: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray, callable]:
        """The windows of several texts at once: hashes, places of their texts in the list, token positions in these, and the slots as above.

        No window reaches from one text into the next.
        """
        tokens, sizes = [], []
        for t in texts:
            found = _TOKEN.findall(t or "")
            tokens += found
            sizes.append(len(found))
        ids = self._numbers(tokens)
        kind = self.kinds[ids]
        is_word = (kind & _END) == 0
        begins = np.concatenate([[True], ~is_word[:-1]])[:len(kind)]
        text_starts = np.cumsum([0, *sizes])
        begins[text_starts[:-1][np.array(sizes) > 0]] = True
        at = np.flatnonzero(is_word)
        kind, begins, spread, n = kind[at], begins[at], self.spread[ids[at]], len(at)
        bounds = np.searchsorted(at, text_starts)  # word numbers where the texts begin and end
        counts = np.diff(bounds)
        owner = np.repeat(np.arange(len(texts)), counts)

        def places(size: int) -> np.ndarray:
            """Where a window of so many words stays inside its text."""
            whole = np.ones(max(n - size + 1, 0), dtype=bool)
            for i in range(1, size):
                ends = bounds[1:-1] - i
                whole[ends[(ends >= 0) & (ends < len(whole))]] = False
            return np.flatnonzero(whole)

        def over(values: np.ndarray, starts: np.ndarray, size: int, origin: np.uint64 = np.uint64(0)) -> np.ndarray:
            total = np.full(len(starts), origin)
            for i in range(size):
                total += values[starts + i] * _TIMES[i]
            return mixed(total)

        number = (kind & _NUMBER) > 0
        beside = np.concatenate([[False], number[:-1]])[:n]
        beside[bounds[:-1][counts > 0]] = False
        unit = ((kind & _UNITWORD) > 0) & beside | ((kind & _MARK) > 0)
        name = ((kind & _CAPITAL) > 0) & ~begins & ~unit
        starts = places(WINDOW)

        def filled(slots: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(slots)])
            return sums[starts + WINDOW] - sums[starts]
        plain_slots = filled(number | unit)
        named_slots = plain_slots + filled(name)
        is_plain = plain_slots <= WINDOW - MIN_LITERALS
        use_plain, use_literal = starts[is_plain], starts[~is_plain]
        use_named = starts[(named_slots > plain_slots) & (named_slots <= WINDOW - MIN_LITERALS)]
        small = [(places(size), size) for size in short]
        with np.errstate(over="ignore"):
            plain = np.where(number, _NUM, np.where(unit, _UNIT, spread))
            hashes = np.concatenate([over(plain, use_plain, WINDOW), over(np.where(name, _NAME, plain), use_named, WINDOW),
                                     over(spread, use_literal, WINDOW, _AS_IT_IS[WINDOW]),
                                     *(over(spread, x, size, _AS_IT_IS[size]) for x, size in small)])
        first_named, first_literal = len(use_plain), len(use_plain) + len(use_named)
        first_small = first_literal + len(use_literal)
        begin = np.concatenate([use_plain, use_named, use_literal, *(x for x, _ in small)])

        def slots(i: int) -> list[str]:
            start, out = begin[i], []
            if i >= first_small:
                return out
            for j in range(start, start + WINDOW):
                kind_of = "num" if number[j] else "unit" if unit[j] else "name" if first_named <= i < first_literal and name[j] else None
                if kind_of:
                    out.append(f"{j - start}:{kind_of}:{tokens[at[j]].lower()}")
            return out
        of = owner[begin]
        return hashes, of, begin - bounds[of], slots


def benchmark_windows(items: DataFrame, *, text: str = "text", key: str = "item_id") -> DataFrame:
    """hash, item_id, item_pos, item_slots and n_tokens of every window of the benchmark."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canonical = Canonical()
        for batch in batches:
            out = []
            for item, t in zip(batch["item_id"], batch["text"], strict=True):
                hashes, pos, slots = canonical.windows(t)
                tokens = len(_words(t))
                out += [(h, item, int(p), slots(i), tokens) for i, (h, p) in enumerate(zip(hashes.view(np.int64), pos, strict=True))]
            yield pd.DataFrame(out, columns=["hash", "item_id", "item_pos", "item_slots", "n_tokens"])
    rows = items.select(F.col(key).cast("long").alias("item_id"), F.col(text).alias("text")).where("item_id IS NOT NULL")
    return rows.mapInPandas(cut, "hash long, item_id long, item_pos int, item_slots array<string>, n_tokens int").distinct()


def _bitmap(windows: DataFrame) -> np.ndarray:
    """A bit for every window hash modulo ``BITMAP_BITS``: eight megabytes at most, whatever the benchmark's size."""
    bit = F.pmod(F.col("hash"), F.lit(BITMAP_BITS)) + 1  # Spark counts these positions from 1
    parts = (windows.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")))
    size = 4096  # bytes of one part
    bits = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for bucket, part in parts.collect():
        bits[(bucket - 1) * size:bucket * size] = np.frombuffer(bytes(part), dtype=np.uint8)
    return bits


def _gathered(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with about ``CHARACTERS`` together, and where in the list they begin; a longer text is a run of its own."""
    low = size = 0
    for i, t in enumerate(texts):
        if i > low and size + len(t) > CHARACTERS:
            yield low, texts[low:i]
            low, size = i, 0
        size += len(t)
    if low < len(texts):
        yield low, texts[low:]


def text_windows(docs: DataFrame, bits: np.ndarray, short: tuple[int, ...] = (), *, text: str = "text") -> DataFrame:
    """The windows of every text that the bitmap lets through, those of the ``short`` sizes too; ``whole`` is the text's MD5."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canonical, known = Canonical(), shared.value
        for batch in slices(batches):
            out, wholes = [], batch["whole"].tolist()
            for low, texts in _gathered(batch["text"].tolist()):
                hashes, of, pos, slots = canonical.windows_of(texts, short)
                bit = (hashes & np.uint64(BITMAP_BITS - 1)).view(np.int64)
                for i in np.flatnonzero((known[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1):
                    out.append((wholes[low + of[i]], hashes[i].view(np.int64), int(pos[i]), slots(i)))
            yield pd.DataFrame(out, columns=["whole", "hash", "pos", "slots"])
    rows = docs.select(F.unhex(F.md5(text)).alias("whole"), F.col(text).alias("text")).where("text IS NOT NULL")
    return rows.mapInPandas(cut, WINDOWS)


def _judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Coverage of an item by the best alignment of a text, and whether slots were filled anew."""
    for batch in batches:
        out = []
        for whole, item, tokens, hits in zip(batch["whole"], batch["item_id"], batch["n_tokens"], batch["hits"], strict=True):
            coverage, anew = best_alignment([(h["shift"], h["item_pos"], h["slots"], h["item_slots"]) for h in hits], int(tokens))
            out.append((whole, item, coverage, anew))
        yield pd.DataFrame(out, columns=["whole", "item_id", "coverage", "reparameterised"])


def best_alignment(hits: list[tuple], tokens: int) -> tuple[float, bool]:
    """Hits are (shift, item position, slots of the text, slots of the item), in any order."""
    hits = sorted(hits, key=lambda h: (h[0], h[1]))
    best, start = (0.0, False), 0
    for end in range(len(hits)):
        while hits[end][0] - hits[start][0] > DRIFT:
            start += 1
        if end + 1 < len(hits) and hits[end + 1][0] - hits[start][0] <= DRIFT:
            continue  # a longer run follows
        run = hits[start:end + 1]
        consistent, anew = _slots_agree(run)
        if not consistent:
            run, anew = [h for h in run if list(h[2]) == list(h[3])], False
        covered = len({p + i for _, p, _, _ in run for i in range(min(WINDOW, tokens))})
        best = max(best, (covered / tokens, anew))
    return best


def _slots_agree(run: list[tuple]) -> tuple[bool, bool]:
    """Whether every value of the item goes with one value of the text and back, for each type; and whether any differs."""
    there, back, anew = {}, {}, False
    for _, _, ours, theirs in run:
        for a, b in zip(ours, theirs, strict=False):
            (_, kind, a), (_, _, b) = a.split(":", 2), b.split(":", 2)
            if there.setdefault((kind, b), a) != a or back.setdefault((kind, a), b) != b:
                return False, False
            anew |= a != b
    return True, anew


def leaked_texts(docs: DataFrame, items: DataFrame, *, text: str = "text", item_text: str = "text", item_key: str = "item_id",
                 coverage: float = COVERAGE) -> DataFrame:
    """whole (MD5 of a text), item_id, coverage and reparameterised for every text that holds a benchmark item."""
    windows = stored(benchmark_windows(items, text=item_text, key=item_key), "benchmark-windows")
    short = tuple(sorted(n for n, in windows.where(F.col("n_tokens") < WINDOW).select("n_tokens").distinct().collect()))
    found = text_windows(docs, _bitmap(windows), short, text=text).distinct()
    hits = (found.join(windows, "hash").groupBy("whole", "item_id", "n_tokens")
            .agg(F.collect_set(F.struct((F.col("pos") - F.col("item_pos")).alias("shift"), "item_pos", "slots", "item_slots")).alias("hits")))
    judged = hits.mapInPandas(_judged, "whole binary, item_id long, coverage double, reparameterised boolean")
    return judged.where(F.col("coverage") >= coverage)


def leaks(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, item_id, coverage and reparameterised: a row for each document and benchmark item that it holds."""
    found = stored(leaked_texts(docs, items, text=text, **options), "leaked-texts")
    return (docs.select(F.col(key).alias("doc_id"), F.unhex(F.md5(text)).alias("whole")).join(found, "whole")
            .select("doc_id", "item_id", "coverage", "reparameterised"))


def decontaminated(docs: DataFrame, items: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item."""
    found = stored(leaked_texts(docs, items, text=text, **options), "leaked-texts").select("whole").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.unhex(F.md5(text)), F.lit(b"")).alias("whole"))
    return rows.join(found, "whole", "left_anti").select("row.*")


@query()
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
