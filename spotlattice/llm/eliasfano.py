"""Elias-Fano coding of non-decreasing integers with a stored select directory, and the token file that uses it.

A sequence of n values up to u keeps its low bits in l = floor(log2(u / n)) bits each and its high
parts in unary: about 2 + log2(u / n) bits a value. The place of every 64th set bit of the unary
part is stored in 32 bits, so ``select`` reads one entry and scans one short stretch; opening a
sequence reads nothing but its header.

File (little-endian): 8 bytes magic, bytes an id takes (2 or 4) and the number of documents without
an id as unsigned 64-bit numbers; then the document ids (those without come first) less the smallest,
which is a signed 64-bit number, and the ends of the documents, as two sequences; then the ids of all
documents, one after another. A sequence is four unsigned 64-bit numbers (values, largest value, low
bits, bytes of the unary part), its directory, low part and unary part.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"SLTOKEN2"
HEAD, SEQUENCE, FIRST = struct.Struct("<8s2Q"), struct.Struct("<4Q"), struct.Struct("<q")
SAMPLE = 64
NULL_ID = -(1 << 63)


class EliasFano:
    def __init__(self, n: int, largest: int, low_bits: int, directory: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.n, self.largest, self.low_bits, self.directory, self.low, self.high = n, largest, low_bits, directory, low, high

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        largest = int(values[-1]) if n else 0
        low_bits = max(0, (largest // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        if n and at[-1] >= 1 << 32:
            raise ValueError("too many values for one file")
        unary = np.zeros(int(at[-1]) + 1 if n else 0, dtype=np.uint8)
        unary[at] = 1
        return cls(n, largest, low_bits, at[::SAMPLE].astype("<u4"), low, np.packbits(unary, bitorder="little"))

    def to_bytes(self) -> bytes:
        return b"".join([SEQUENCE.pack(self.n, self.largest, self.low_bits, len(self.high)), self.directory.tobytes(), self.low.tobytes(), self.high.tobytes()])

    @classmethod
    def at(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        """The sequence that begins at a place, and where it ends. Its parts stay in ``data``."""
        n, largest, low_bits, high = SEQUENCE.unpack_from(data, at)
        at += SEQUENCE.size
        parts = []
        for kind, count in (("<u4", -(-n // SAMPLE)), (np.uint8, -(-n * low_bits // 8)), (np.uint8, high)):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        return cls(n, largest, low_bits, *parts), at

    def _low(self, i: np.ndarray) -> np.ndarray:
        bit = i[:, None] * self.low_bits + np.arange(self.low_bits)
        got = (self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
        return (got.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def select(self, i: int) -> int:
        """The i-th value, from the directory entry before it and a scan of the bits that follow."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start = int(self.directory[i // SAMPLE])
        left, byte = i % SAMPLE, start >> 3
        word = int(self.high[byte]) >> (start & 7) << (start & 7)
        while left >= (ones := word.bit_count()):
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        at = byte * 8 + (word & -word).bit_length() - 1
        return ((at - i) << self.low_bits) | int(self._low(np.array([i]))[0])

    def part(self, a: int, b: int) -> np.ndarray:
        """Values a to b - 1: selects of neighbours share the scan. Only the stretch between two directory entries is unpacked."""
        a, b = max(0, a), min(b, self.n)
        if a >= b:
            return np.zeros(0, dtype=np.int64)
        first = a // SAMPLE
        last = -(-b // SAMPLE)
        begin = int(self.directory[first]) >> 3
        end = (int(self.directory[last]) >> 3) + 1 if last < len(self.directory) else len(self.high)
        at = np.flatnonzero(np.unpackbits(self.high[begin:end], bitorder="little")) + begin * 8
        skip = int(np.searchsorted(at, int(self.directory[first]))) + a - first * SAMPLE
        i = np.arange(a, b)
        return ((at[skip : skip + b - a] - i) << self.low_bits) | self._low(i)


def encode_file(doc_ids: list[int | None], lengths: list[int], ids: bytes, id_bytes: int) -> bytes:
    """``doc_ids`` in ascending order, those without an id first."""
    known = [x for x in doc_ids if x is not None]
    first = known[0] if known else 0
    own = EliasFano.of(np.array([x - first for x in known], dtype=np.uint64))
    ends = EliasFano.of(np.cumsum(np.asarray(lengths, dtype=np.int64)))
    return b"".join([HEAD.pack(MAGIC, id_bytes, len(doc_ids) - len(known)), FIRST.pack(first), own.to_bytes(), ends.to_bytes(), ids])


class TokenFile:
    """A token file in memory; ``doc(i)`` gives the ids of its i-th document."""

    def __init__(self, data: bytes):
        magic, self.id_bytes, self.nulls = HEAD.unpack_from(data) if len(data) >= HEAD.size else (b"", 0, 0)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.first = FIRST.unpack_from(data, HEAD.size)[0]
        self.keys, at = EliasFano.at(data, HEAD.size + FIRST.size)
        self.ends, at = EliasFano.at(data, at)
        self.ids = np.frombuffer(data, f"<u{self.id_bytes}", self.ends.largest, at)

    def __len__(self) -> int:
        return self.ends.n

    def doc_id(self, i: int) -> int | None:
        return self.first + self.keys.select(i - self.nulls) if i >= self.nulls else None

    def doc_ids(self, a: int, b: int) -> list[int | None]:
        own = self.keys.part(a - self.nulls, b - self.nulls)
        return [None] * (min(b, len(self)) - a - len(own)) + [self.first + int(x) for x in own]

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def doc(self, i: int) -> np.ndarray:
        begin, end = self.span(i)
        return self.ids[begin:end]
