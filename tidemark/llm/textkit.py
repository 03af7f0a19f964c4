"""Whole-batch word and shingle hashing with numpy.

Words are runs of bytes other than the ASCII white space 0x20 and 0x09-0x0D. A word's hash is the
polynomial of its bytes' random values modulo 2^64, taken as a difference of two prefix sums, so a
batch costs a few passes over its bytes, whatever the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemark.llm.common import balanced, held

CHUNK = 1 << 20  # bytes hashed at once
_SPACES = b"\t\n\x0b\x0c\r "
_BASE = 0x9E3779B97F4A7C15

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACES)] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values; one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_VALUE[_IS_SPACE] = 0


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    powers = held("powers")
    if len(powers.get("up", ())) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            powers[name] = np.cumprod(steps)
    return powers["up"], powers["down"]


def _hashed(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a buffer that ends in white space."""
    data = np.frombuffer(buffer, np.uint8)
    up, down = _tables(len(data) + 1)
    space = _IS_SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def _parts(text: bytes) -> list[bytes]:
    """A long text cut at white space into parts of about CHUNK bytes."""
    if len(text) <= CHUNK:
        return [text]
    parts, at = [], 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and text[end] not in _SPACES:
            end += 1
        parts.append(text[at:end])
        at = end
    return parts


def word_hashes(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(index, hashes of the words) of each text, in order, hashed in chunks of bounded size."""
    for first, last in balanced([len(t) for t in texts], CHUNK):
        if last - first == 1 and len(texts[first]) > CHUNK:
            whole = [_hashed(p + b" ")[1] for p in _parts(texts[first])]
            yield first, np.concatenate(whole)
            continue
        chunk = texts[first:last]
        starts, hashes = _hashed(b" ".join(chunk) + b" ")
        sizes = np.fromiter((len(t) + 1 for t in chunk), np.int64, len(chunk))
        cuts = np.searchsorted(starts, np.cumsum(sizes))
        at = 0
        for i, cut in enumerate(cuts.tolist(), first):
            yield i, hashes[at:cut]
            at = cut


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of width words, in order, repeats included."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(h)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, a text without words none."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return shingles(np.append(words, np.uint64(len(words))), len(words) + 1)
    h = np.sort(shingles(words, width))
    return h[np.append(True, h[1:] != h[:-1])]
