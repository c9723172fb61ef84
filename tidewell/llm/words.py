"""Words between ASCII white space as 64-bit names, computed for many texts at once."""

from __future__ import annotations

import numpy as np

#: The white space that separates words.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
SEGMENT = 1 << 20
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < size:
        out = []
        for base in (BASE, INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        if size > 4 * SEGMENT:  # a single very long word: not kept
            return out[0], out[1]
        _POWERS[:] = out
    return _POWERS[0][:size], _POWERS[1][:size]


def segment_names(data: np.ndarray) -> np.ndarray:
    """Names of the words of a byte array: a polynomial of the bytes, independent of the place, then mixed."""
    white = np.concatenate(([True], WHITE[data], [True]))
    edges = np.flatnonzero(white[1:] != white[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return mix(((sums[ends] - sums[starts]) * down[starts]) ^ (ends - starts).astype(np.uint64))


def word_names(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(names of all words in order, bounds): the words of text i are bounds[i] to bounds[i + 1]."""
    names, counts, group, held = [], [], [], 0

    def flush() -> None:
        nonlocal held
        if group:
            found = segment_names(np.frombuffer(b"\n".join(group), dtype=np.uint8))
            names.append(found)
            group.clear()
            held = 0

    for text in texts:
        if len(text) > SEGMENT:
            flush()
            at, total = 0, 0
            while at < len(text):
                end = min(len(text), at + SEGMENT)
                while end < len(text) and not WHITE[text[end]]:
                    end += 1
                found = segment_names(np.frombuffer(text[at:end], dtype=np.uint8))
                names.append(found)
                total += len(found)
                at = end
            counts.append(total)
            continue
        counts.append(len(text.split()))
        group.append(text)
        held += len(text) + 1
        if held > SEGMENT:
            flush()
    flush()
    bounds = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    return (np.concatenate(names) if names else np.zeros(0, dtype=np.uint64)), bounds


def run_names(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Names of all runs of `length` consecutive words, without regard to where texts end."""
    count = max(0, len(words) - length + 1)
    total = np.full(count, seed, dtype=np.uint64)
    for step in range(length):
        total = total * np.uint64(BASE) + words[step : step + count]
    return mix(total)
