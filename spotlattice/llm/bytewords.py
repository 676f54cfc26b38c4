"""Words of many texts at once: positions and 64-bit hashes, in numpy over UTF-8 bytes."""

from __future__ import annotations

import numpy as np

#: White space between words.
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def _table(letters_only: bool) -> np.ndarray:
    """Byte -> byte that counts, 0 between words. A-Z become a-z; with letters_only ASCII signs stand between words too."""
    t = np.arange(256, dtype=np.uint8)
    t[ord("A") : ord("Z") + 1] += 32
    for b in range(128):
        if b in SPACES or (letters_only and not chr(b).isalnum()):
            t[b] = 0
    if not letters_only:
        t[0] = 255  # a zero byte is part of a word
    return t


WORDS, LETTERS = _table(False), _table(True)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly (the finaliser of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


STEP = 1 << 16
_odd = np.full(STEP, 0x9E3779B97F4A7C15, dtype=np.uint64)
_odd[0] = 1
POWERS = np.multiply.accumulate(_odd)
#: Bytes whose words are worked out at a time; a longer word goes on from one stretch to the next.
STRETCH = 1 << 21


def power_at(at: np.ndarray) -> np.ndarray:
    """Weight of a byte at each place of a word; places beyond the table take it again under another factor."""
    if not len(at) or at.max() < STEP:
        return POWERS[at]
    far = mix((at >> 16).astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    return POWERS[at & (STEP - 1)] * np.where(at < STEP, np.uint64(1), far)


class Words:
    """Words of ``texts``: hash, doc (index of the text), lead (first two bytes), and begin (first word of each text, one more at the end).

    Texts are read in stretches of bounded size, so what is held besides them is a few numbers a word,
    whatever the length of a text or of a word.
    """

    def __init__(self, texts: list[bytes | None], table: np.ndarray = WORDS, prefixes: tuple[int, ...] = (), fold_latin: bool = False):
        raw = [t or b"" for t in texts]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) + 1
        buf = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8) if raw else np.zeros(0, np.uint8)
        found: list[tuple] = []
        a = open_ = 0  # open_: bytes so far of a word that the stretch before left open
        while a < len(buf):
            b = min(a + STRETCH, len(buf))
            while b < len(buf) and buf[b] & 0xC0 == 0x80:
                b += 1
            part, open_ = self._stretch(buf[a:b], a, open_, table, prefixes, fold_latin)
            found.append(part)
            a = b
        start, lengths, goes_on, sums, lead0, lead1, *heads = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * (6 + len(prefixes))
        if len(found) > 1 and goes_on.any():
            for i in np.flatnonzero(goes_on):  # one a stretch at most
                if lengths[i - 1] == 1 and not goes_on[i - 1]:
                    lead1[i - 1] = lead0[i]
            first = np.flatnonzero(~goes_on)
            sums, lengths, *heads = (np.add.reduceat(x, first) for x in (sums, lengths, *heads))
            start, lead0, lead1 = start[first], lead0[first], lead1[first]
        self.n = len(start)
        self.hash = mix(sums.astype(np.uint64) + lengths.astype(np.uint64))
        self.prefix = {k: mix(x.astype(np.uint64)) for k, x in zip(prefixes, heads, strict=True)}
        self.lead = (lead0.astype(np.uint8), lead1.astype(np.uint8))
        self.begin = np.searchsorted(start, np.concatenate(([0], np.cumsum(sizes))))
        self.doc = np.repeat(np.arange(len(raw), dtype=np.int32), np.diff(self.begin))

    @staticmethod
    def _stretch(buf: np.ndarray, at: int, open_: int, table: np.ndarray, prefixes: tuple[int, ...], fold_latin: bool) -> tuple[tuple, int]:
        got = table[buf]
        if fold_latin:  # capitals of the Latin-1 supplement
            upper = np.flatnonzero((got[:-1] == 0xC3) & (got[1:] >= 0x80) & (got[1:] <= 0x9E) & (got[1:] != 0x97)) + 1
            got[upper] += 32
        inside = (got != 0).astype(np.int8)
        edge = np.diff(inside, prepend=np.int8(0), append=np.int8(0))
        starts = np.flatnonzero(edge == 1)
        lengths = np.flatnonzero(edge == -1) - starts
        goes_on = np.zeros(len(starts), dtype=bool)
        if not len(starts):
            none = np.zeros(0, np.int64)
            return (none, none, goes_on, none.astype(np.uint64), none.astype(np.uint8), none.astype(np.uint8), *(none.astype(np.uint64) for _ in prefixes)), 0
        own = np.flatnonzero(inside)
        first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(len(own)) - np.repeat(first, lengths)
        before = open_ if starts[0] == 0 else 0
        if before:
            goes_on[0] = True
            place[: lengths[0]] += before
        worth = got[own].astype(np.uint64) * power_at(place)
        heads = [np.add.reduceat(np.where(place < k, worth, np.uint64(0)), first) for k in prefixes]
        left = 0
        if starts[-1] + lengths[-1] == len(got):
            left = int(lengths[-1]) + (before if len(starts) == 1 else 0)
        return (starts + at, lengths, goes_on, np.add.reduceat(worth, first), got[starts], got[starts + (lengths > 1)], *heads), left


def slices(sizes: list[int], most: int = 1_500_000):
    """(from, to) of runs of texts of bounded total size; a longer text is a run of its own."""
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)


def runs_of(batch_texts) -> list[tuple[int, list[bytes | None]]]:
    """Of an Arrow column of binary: (row it starts at, texts) in runs of bounded size."""
    texts = batch_texts.to_pylist()
    return [(a, texts[a:b]) for a, b in slices([len(t or b"") for t in texts])]
