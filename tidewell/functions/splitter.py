"""Recursive text splitting: the one step that is sequential inside a document."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

# Separators from coarse to fine; the empty one splits between characters.
SEPARATORS = ("\n\n", "\n", "。", ".", " ", "")


def pieces_of(text: str, separator: str) -> Iterator[str]:
    """Cut in front of every separator, so joining the pieces gives the text back."""
    if not separator:
        yield from text
        return
    start, at = 0, text.find(separator)
    while at >= 0:
        if at > start:
            yield text[start:at]
        start, at = at, text.find(separator, at + len(separator))
    yield text[start:]


def pack(pieces: Sequence[str], size: int, overlap: int) -> Iterator[str]:
    """Fill chunks up to `size`; the next chunk starts with trailing pieces of at most `overlap` characters."""
    window: deque[str] = deque()
    length = 0
    for piece in pieces:
        if window and length + len(piece) > size:
            yield "".join(window)
            while window and (length > overlap or length + len(piece) > size):
                length -= len(window.popleft())
        window.append(piece)
        length += len(piece)
    if window:
        yield "".join(window)


def split_recursive(text: str, size: int, overlap: int, separators: Sequence[str] = SEPARATORS) -> Iterator[str]:
    """Chunks of at most `size` characters, cut at the coarsest separator that makes the parts fit."""
    at = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    finer = () if separators[at] == "" else separators[at + 1 :]
    small: list[str] = []
    for piece in pieces_of(text, separators[at]):
        if len(piece) < size:
            small.append(piece)
            continue
        yield from _stripped(pack(small, size, overlap))
        small = []
        if finer:
            yield from split_recursive(piece, size, overlap, finer)
        else:
            yield piece
    yield from _stripped(pack(small, size, overlap))


def _stripped(chunks: Iterator[str]) -> Iterator[str]:
    return (c for c in (chunk.strip() for chunk in chunks) if c)
