"""Whole texts as numpy arrays of code points, words, lines and rolling hashes."""

import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np

# Code points handled at a time; a longer text makes a chunk of its own.
CHUNK_CHARS = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def kept_in_process(name: str, make: Callable):
    """What ``make`` gives, made once per Python worker and reused by its later tasks."""
    module = sys.modules.setdefault("_crawltable_kept", types.ModuleType("_crawltable_kept"))
    if not hasattr(module, name):
        setattr(module, name, make())
    return getattr(module, name)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the powers 0, 1, ... n - 1, kept up to the size of a chunk."""

    def made(size):
        steps = np.full(size, base, np.uint64)
        steps[:1] = 1
        return np.cumprod(steps, dtype=np.uint64)

    if n > CHUNK_CHARS + 2:
        return made(n)
    return kept_in_process(f"powers_{base}", lambda: made(CHUNK_CHARS + 2))[:n]


class RollingHash:
    """Hashes of any span of a sequence, each in constant time."""

    def __init__(self, values: np.ndarray):
        scattered = mixed(values.astype(np.uint64) + np.uint64(1))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(scattered * powers(_BASE, len(values)), out=self.sums[1:])
        self.back = powers(_BASE_INVERSE, len(values) + 1)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal spans have equal hashes wherever they lie; lengths are mixed in."""
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(raw + (end - start).astype(np.uint64))


def span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each span of code points, and a check: a number made of its characters in
    another way, which tells spans that share the hash apart."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed(codes.astype(np.uint64) ^ np.uint64(0xA5A5A5A5A5A5)), out=sums[1:])
    return RollingHash(codes).spans(start, end), sums[end] - sums[start]


class Texts:
    """Texts laid one after the other with a newline between them.

    ``starts`` and ``ends`` give each text's place in ``codes``.
    """

    def __init__(self, texts: Sequence[str]):
        self.texts = texts
        self.codes = np.frombuffer(
            "\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32
        )
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes

    def owner(self, places: np.ndarray) -> np.ndarray:
        """Number of the text that each place belongs to."""
        return np.searchsorted(self.starts, places, "right") - 1

    def count(self, mask: np.ndarray) -> np.ndarray:
        """How many places of each text are set in ``mask``."""
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return sums[self.ends] - sums[self.starts] if len(self.texts) else sums[:0]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each run without the ASCII spaces 0x20 and 0x09-0x0D."""
        codes = self.codes
        inside = np.zeros(len(codes) + 2, bool)
        inside[1:-1] = (codes != 0x20) & ((codes < 0x09) | (codes > 0x0D))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        return edges[::2], edges[1::2]

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each newline-separated line, empty ones included."""
        if not self.texts:
            return self.starts, self.ends
        breaks = np.flatnonzero(self.codes == 0x0A)
        return np.concatenate(([0], breaks + 1)), np.concatenate((breaks, [len(self.codes)]))


def chunks(texts: Sequence[str], size: int = CHUNK_CHARS) -> Iterator[slice]:
    """Consecutive slices of about ``size`` code points, one text at least."""
    start, total = 0, 0
    for n, text in enumerate(texts):
        if total and total + len(text) > size:
            yield slice(start, n)
            start, total = n, 0
        total += len(text) + 1
    if start < len(texts):
        yield slice(start, len(texts))


def sizes_to_offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)))


def expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the spans that begin at ``starts``, one span after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)
