"""Words of many texts at once, as numpy arrays over an Arrow string column.

The texts' bytes are used where they lie; there is no Python object for a word.
A word is known by a 64-bit digest of its (lower-cased) bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Text bytes handled at once (one longer text is handled alone).
BLOCK_BYTES = 1 << 20


def byte_classes(separators: str) -> np.ndarray:
    """256 values: 0 for a separator byte, else the byte with A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[list(separators.encode("latin-1"))] = 0
    return table


#: Bytes that are no part of a word.
NOT_ALNUM = byte_classes("".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61),
                                           *range(0x7B, 0x80)])))
SPACES = byte_classes("\0\t\n\v\f\r ")


def _powers_up_to(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; those of a text longer than
    a block are not kept."""
    if len(_powers[0]) < n:
        if n > 2 * BLOCK_BYTES:
            out = [np.full(n, b, np.uint64) for b in (_BASE, _INVERSE)]
            for x in out:
                x[0] = 1
                np.multiply.accumulate(x, out=x)
            return out
        for k, b in enumerate((_BASE, _INVERSE)):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_blocks(texts: pa.Array, block: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of runs of rows with about ``block`` bytes;
    offsets has one value more than the run has rows.  Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, off_buf, data = texts.buffers()
    offsets = np.frombuffer(off_buf, np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + block, side="right")) - 1
        end = min(n, max(end, at + 1))
        part = offsets[at:end + 1]
        yield at, part - part[0], raw[part[0]:part[-1]]
        at = end


class Words:
    """Words of one block: byte ranges ``start``/``end``, digests ``hash``, and
    ``first``: the number of the first word of each row (one value more than rows)."""

    def __init__(self, offsets: np.ndarray, raw: np.ndarray, classes: np.ndarray):
        low = classes[raw]
        inside = low != 0
        n = len(raw)
        before = np.zeros(n, bool)
        after = np.zeros(n, bool)
        if n:
            before[1:] = inside[:-1]
            after[:-1] = inside[1:]
            inner = offsets[1:-1]
            inner = inner[(inner > 0) & (inner < n)]
            before[inner] = False  # a word ends where its text ends
            after[inner - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        power, inverse = _powers_up_to(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(low * power[:n], out=sums[1:])
        self._sums, self._inverse = sums, inverse
        self.hash = self._digest(self.start, self.end)

    def _digest(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return mix(h + (end - start).astype(np.uint64) * _BASE)

    def prefix(self, which: np.ndarray, k: int) -> np.ndarray:
        """Digests of the first k bytes of some (longer) words; never those of a word."""
        return ~self._digest(self.start[which], self.start[which] + k)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Digest of the k words from each word on; shorter by k - 1 than ``words``."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _BASE + words[j:j + n]
    return mix(h)


def member(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in ``sorted_keys``: a bit table first, then a search."""
    out = np.zeros(len(x), bool)
    if not len(sorted_keys) or not len(x):
        return out
    bits = 20
    seen = np.zeros(1 << bits, bool)
    seen[(sorted_keys >> np.uint64(64 - bits)).astype(np.int64)] = True
    maybe = np.flatnonzero(seen[(x >> np.uint64(64 - bits)).astype(np.int64)])
    got = x[maybe]
    at = np.minimum(np.searchsorted(sorted_keys, got), len(sorted_keys) - 1)
    out[maybe[sorted_keys[at] == got]] = True
    return out
