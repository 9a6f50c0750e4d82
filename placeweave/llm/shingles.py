"""Word shingles and MinHash signatures, computed in the task that reads the text."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHINGLE = 5
# Words whose hash a task remembers; beyond that it forgets them all and starts anew.
REMEMBERED = 200_000
_BLOCK = 4096  # shingles that are permuted at once
_BYTES = 1 << 20  # bytes whose words are told apart at once

# White space between words; A-Z in lower case, other bytes as they are; an odd factor from byte to byte, and its inverse among 64-bit numbers.
_IS_WORD = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint8) + np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), 32, 0).astype(np.uint8)
_STEP = 0xD6E8FEB86659FD93
_UNDO_STEP = pow(_STEP, -1, 1 << 64)

# Odd multipliers that keep word order in a shingle's hash.
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63],
                  dtype=np.uint64)


def words_of(text: str | None) -> list[str]:
    # Bytes know only ASCII letters, so this lower-cases A-Z and nothing else.
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def shingle_set(words: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    """Distinct runs of ``size`` words; fewer words form one shingle together; no words, no shingle."""
    if len(words) <= size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def linked(a: set, b: set, percent: int = 75) -> bool:
    """100 * intersection >= percent * union, and neither set empty."""
    common = len(a & b)
    return bool(a) and bool(b) and 100 * common >= percent * (len(a) + len(b) - common)


class Hasher:
    """64-bit hashes of words (remembered), of shingles, and signatures of sets of them."""

    def __init__(self, coordinates: int, seed: int = 1):
        self.known: dict[str, int] = {}
        self.letter = mixed(np.arange(1, 257, dtype=np.uint64))
        self.steps = self.undo = np.empty(0, dtype=np.uint64)
        draw = np.random.Generator(np.random.PCG64(seed))
        self.flip = draw.integers(0, 1 << 63, coordinates, dtype=np.uint64)[:, None]
        self.times = (draw.integers(0, 1 << 63, coordinates, dtype=np.uint64) | np.uint64(1))[:, None]
        self.coordinate = np.arange(coordinates, dtype=np.int64) << 32

    def words(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def texts(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Hashes of the words of every text, the same as those of ``words(words_of(text))``; words are cut and told apart in bulk."""
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        whole = _LOWER[np.frombuffer(b" ".join([b"", *parts, b""]), dtype=np.uint8)]
        edges = np.flatnonzero(np.diff(_IS_WORD[whole])) + 1
        begins, ends = edges[::2], edges[1::2]
        hashes, low = np.empty(len(begins), dtype=np.uint64), 0
        while low < len(begins):
            high = max(low + 1, int(np.searchsorted(ends, begins[low] + _BYTES)))
            hashes[low:high] = self._bulk(whole[begins[low]:ends[high - 1]], begins[low:high] - begins[low], ends[low:high] - begins[low])
            low = high
        return np.split(hashes, np.searchsorted(begins, np.cumsum([1 + len(p) for p in parts]))[:-1]) if parts else []

    def _bulk(self, some: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the words at these places: a polynomial over bytes tells words apart, and each different word is hashed once."""
        with np.errstate(over="ignore"):
            if len(some) >= len(self.steps):
                place = np.full(len(some) + 1, np.uint64(_STEP))
                undo = np.full(len(some) + 1, np.uint64(_UNDO_STEP))
                place[0] = undo[0] = 1
                self.steps, self.undo = np.cumprod(place), np.cumprod(undo)
            sums = np.zeros(len(some) + 1, dtype=np.uint64)
            np.cumsum(self.letter[some] * self.undo[:len(some)], out=sums[1:])
            told = (sums[ends] - sums[begins]) * self.steps[begins]
        which, different = pd.factorize(mixed(told))
        first = np.empty(len(different), dtype=np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        raw, digest = some.tobytes(), xxhash.xxh3_64_intdigest
        found = [digest(raw[a:b]) for a, b in zip(begins[first].tolist(), ends[first].tolist(), strict=True)]
        return np.array(found, dtype=np.uint64)[which]

    def shingles(self, words: list[str]) -> np.ndarray:
        """Sorted distinct hashes of the text's shingles."""
        if not words:
            return np.empty(0, dtype=np.uint64)
        if len(words) < SHINGLE:
            return np.array([xxhash.xxh3_64_intdigest("\n".join(words))], dtype=np.uint64)
        h = self.words(words)
        runs = len(words) - SHINGLE + 1
        with np.errstate(over="ignore"):
            total = np.zeros(runs, dtype=np.uint64)
            for i in range(SHINGLE):
                total += (h[i:i + runs] ^ (h[i:i + runs] >> np.uint64(29))) * _PLACE[i]
            return np.unique(mixed(total))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """One number a coordinate: the coordinate above, the least permuted hash in the low 32 bits."""
        least = np.full(len(self.coordinate), np.uint32(0xFFFFFFFF), dtype=np.uint32)
        with np.errstate(over="ignore"):
            for start in range(0, len(shingles), _BLOCK):
                permuted = ((shingles[None, start:start + _BLOCK] ^ self.flip) * self.times) >> np.uint64(32)
                np.minimum(least, permuted.min(axis=1).astype(np.uint32), out=least)
        return self.coordinate + least.astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
