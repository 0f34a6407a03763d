"""Words of many texts at once: one byte buffer, NumPy positions and 64-bit hashes.

A block holds a bounded number of bytes of whole texts (one text may be longer
than the bound and then is a block of its own), so memory follows the bound and
the longest text. Words are cut at bytes; both word classes used here are the
same over UTF-8 bytes as over characters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20

_ALL = np.arange(256)
#: Word bytes of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` in lower-cased text.
ALPHANUMERIC = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)
#: A-Z to a-z, all other bytes unchanged.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD_STEP = np.uint64(0xD1342543DE82EF95)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of some texts: byte positions, the text of each word, and the first word of each text."""

    __slots__ = ("raw", "data", "inside", "starts", "ends", "doc", "first")

    def __init__(self, texts: Sequence[bytes], word_bytes: np.ndarray = NOT_SPACE, lower: bool = False):
        self.raw = b" ".join(texts)
        if lower:
            self.raw = self.raw.translate(LOWER)
        self.data = np.frombuffer(self.raw, np.uint8)
        self.inside = word_bytes[self.data]
        edge = np.zeros(len(self.data) + 2, bool)
        edge[1:-1] = self.inside
        edge = np.flatnonzero(edge[1:] != edge[:-1])
        self.starts, self.ends = edge[::2], edge[1::2]
        begin = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
        self.first = np.searchsorted(self.starts, begin)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i]:self.ends[i]]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        heads = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
        power = np.full(int(lengths.max()), _BYTE_STEP, np.uint64)
        np.multiply.accumulate(power, out=power)
        value = _BYTE_VALUES[self.data[self.inside]]
        value *= power[place]
        return mix(np.add.reduceat(value, heads))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` hashes; runs are not checked for the ends of texts."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run = np.full(n, k, np.uint64)
    for i in range(k):
        run *= _WORD_STEP
        run += hashes[i:i + n]
    return mix(run)


def shingle_sets(words: Words, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``k``-word shingles of each text.

    A text with fewer words has one shingle, its whole sequence; a text without words has none.
    """
    h, first = words.hashes(), words.first
    full = windows(h, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(full[a:b - k + 1]))
        else:
            out.append(windows(h[a:b], b - a) if b > a else full[:0])
    return out


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8 bytes; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def spans(texts: Sequence[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes each."""
    begin = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield begin, i
            begin, held = i, 0
        held += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)
