"""Hashed words and word shingles of whole texts, many texts at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import xxhash

WIDTH = 5
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_S = np.uint64(29)
#: Bytes of text that are hashed at once.
PART = 1 << 19
#: Space and \x09-\x0D end words.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> _S)) * _P
    x = (x ^ (x >> np.uint64(32))) * _Q
    return x ^ (x >> _S)


class _Powers:
    """_BASE and its inverse to the powers 0, 1, 2, ..."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)]) for b in (np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def hash_words(lowered: bytes, ends_words: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of some bytes, with their starts and ends."""
    a = np.frombuffer(lowered, np.uint8)
    edge = np.diff(np.r_[np.int8(0), (~ends_words[a]).view(np.int8), np.int8(0)])
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers.of(max(1, len(a)))
    sums = np.r_[np.uint64(0), np.cumsum(_BYTES[a] * up[: len(a)])]
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def ascii_lower(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased."""
    return (text or "").encode().lower()


def parts_of(texts: list[str | None], lower: Callable[[str | None], bytes] = ascii_lower) -> Iterator[tuple[int, int, list[bytes]]]:
    """Runs of texts with about PART bytes: (first, end, lower-cased UTF-8)."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = lower(t)
        if held and size + len(b) > PART:
            yield first, i, held
            first, held, size = i, [], 0
        held.append(b)
        size += len(b) + 1
    if held:
        yield first, len(texts), held


def _one_large(lowered: bytes, ends_words: np.ndarray) -> np.ndarray:
    """Word hashes of a text of more than PART bytes, cut at white space."""
    out, at = [], 0
    while at < len(lowered):
        end = min(len(lowered), at + PART)
        if end < len(lowered):
            cut = max(lowered.rfind(b" ", at, end), lowered.rfind(b"\n", at, end))
            if cut <= at:
                nxt = [p for p in (lowered.find(b" ", end), lowered.find(b"\n", end)) if p >= 0]
                cut = min(nxt, default=len(lowered))
            end = cut
        out.append(hash_words(lowered[at : end + 1], ends_words)[0])
        at = end + 1
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    n = len(h) - k + 1
    x = h[:n] + np.uint64(k)
    for i in range(1, k):
        x = mixed(x) + h[i : n + i]
    return mixed(x)


def word_hashes(part: list[bytes], ends_words: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts of a part, and how many each text has."""
    if len(part) == 1 and len(part[0]) > PART:
        h = _one_large(part[0], ends_words)
        return h, np.array([len(h)])
    h, starts, _ = hash_words(b"\n".join(part), ends_words)
    begins = np.cumsum([0] + [len(b) + 1 for b in part])
    return h, np.diff(np.searchsorted(starts, begins))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its five-word shingles; of all its words if they are fewer."""
    out: list[np.ndarray] = []
    for _, _, part in parts_of(texts):
        h, counts = word_hashes(part)
        x = _shingles(h, WIDTH) if len(h) >= WIDTH else None
        at = 0
        for n in counts.tolist():
            if n >= WIDTH:
                s = np.sort(x[at : at + n - WIDTH + 1])
                out.append(s[np.r_[True, s[1:] != s[:-1]]])
            else:
                out.append(_shingles(h[at : at + n], n) if n else np.empty(0, np.uint64))
            at += n
    return out


def set_id(tokens: np.ndarray) -> int:
    """A signed 64-bit id of a set; equal sets have equal ids."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes(), seed=len(tokens)) - (1 << 63)
