"""Words of many texts at once, as arrays over their UTF-8 bytes.

A word is a maximal run of digits, a-z (after folding A-Z) and non-ASCII characters; every byte of a
non-ASCII character is 0x80 or more, so bytes decide. Missing texts count as empty. Work goes slice by
slice: a slice holds whole texts of a few megabytes together, a longer text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True
SPACE_BYTE = np.zeros(256, bool)
SPACE_BYTE[0x20] = SPACE_BYTE[0x09:0x0E] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32

U = np.uint64
ODD = 0x9E3779B97F4A7C15
INVERSE = pow(ODD, -1, 1 << 64)
BYTE_CODE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(which: str, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), ODD if which == "up" else INVERSE, U)
        steps[0] = 1
        _powers[which] = np.multiply.accumulate(steps)
    return _powers[which][:n]


def release() -> None:
    """Give back the memory of the power tables; they are made again where they are needed."""
    for which in _powers:
        _powers[which] = np.ones(1, U)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text begins (one more at the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    begins = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[begins[0] : begins[-1]], begins - begins[0]


class Words:
    """Words of the texts ``begins[i]:begins[i + 1]`` of ``data``.

    ``start`` and ``end`` are byte positions of each word, ``first`` the index of each text's first word
    (one more at the end), ``count`` the words of each text.
    """

    def __init__(self, data: np.ndarray, begins: np.ndarray, member: np.ndarray = WORD_BYTE):
        self.data = FOLD[data]
        self.begins = begins
        inside = member[self.data]
        edge = np.zeros(len(data) + 1, bool)
        edge[begins] = True
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        after = np.zeros(len(data) + 1, bool)
        after[:-1] = inside
        self.start = np.flatnonzero(after & (~before | edge))
        self.end = np.flatnonzero(before & (~after | edge))
        self.first = np.searchsorted(self.start, begins)
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        """The index of the text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def sums(self) -> np.ndarray:
        """Running hash sums over the bytes: any stretch of bytes is hashed by two look-ups."""
        total = np.zeros(len(self.data) + 1, U)
        np.cumsum(BYTE_CODE[self.data] * _power("up", len(self.data)), out=total[1:])
        return total

    def stretch(self, total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes ``start:end``; equal stretches anywhere get equal hashes."""
        at = _power("down", len(self.data) + 1)[start]
        return mix((total[end] - total[start]) * at + (end - start).astype(U))

    def hashes(self) -> np.ndarray:
        return self.stretch(self.sums(), self.start, self.end)

    def grams(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions (word indexes) where k words of one text begin, and the hash of those k words."""
        if len(hashes) < k:
            return np.zeros(0, np.int64), np.zeros(0, U)
        last = np.repeat(self.first[1:], self.count)
        at = np.flatnonzero(np.arange(len(hashes)) + k <= last)
        return at, gram(hashes, at, k)


def gram(hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros(len(at), U)
    for j in range(k):
        out = out * U(ODD) + hashes[at + j]
    return mix(out)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, begins) of consecutive slices."""
    data, begins = flat(texts)
    row = 0
    while row < len(begins) - 1:
        stop = int(np.searchsorted(begins, begins[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), len(begins) - 1)
        yield row, stop, data[begins[row] : begins[stop]], begins[row : stop + 1] - begins[row]
        row = stop


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column whose row i holds ``values[first[i]:first[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32), pa.int32()), pa.array(values, kind))


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores added until no column has it."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def words_of(text: str | None) -> list[str]:
    """The words of one text, for short texts such as test items and templates."""
    words = Words(*flat(pa.array([text], pa.string())))
    data = words.data.tobytes()
    return [data[a:b].decode() for a, b in zip(words.start, words.end)]
