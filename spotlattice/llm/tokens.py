"""Token ids by the ``tokenizers`` library, with bounded caches of the pieces between blanks.

Both vocabularies split a text before every single blank that other text surrounds, so a text is
encoded piece by piece and equal pieces are encoded once. A new piece of Latin letters, digits and
ASCII signs goes straight to the library's BPE model, word by word; any other goes through the
whole library. Texts with white space other than single blanks and line feeds between words, and
texts that may hold an added token of the vocabulary, go to the library whole.
"""

from __future__ import annotations

import gc
import os
import re
import sys
from array import array
from functools import lru_cache

import numpy as np

#: Characters that some Unicode tables count as white space, or that join with what stands before.
ODD = re.compile(r"[\x00-\x09\x0b-\x1f\x7f-\xa0̀-ͯᄀ-ᇿ ᠎ -‏ -  -⁤　﻿]")


def _letters() -> str:
    """Latin letters up to U+024F in which both vocabularies' tables agree, and whose lower case is one of them."""
    agreed = {chr(c) for a, b in ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x12F), (0x131, 0x24F)) for c in range(a, b + 1)}
    return "".join(sorted(c for c in agreed if c.lower() in agreed))


LETTER = _letters()
PLAIN = re.compile(rf"[\n -~{LETTER}]*+")
#: How each vocabulary cuts a piece into words.
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
BLANK_WORDS = re.compile(rf"{ENDINGS}| ?[{LETTER}]+| ?[0-9]+| ?[^\s{LETTER}0-9]+")
BARE_WORDS = re.compile(rf"{ENDINGS}|[{LETTER}]+|[0-9]|[^\s{LETTER}0-9]+")
#: Bytes kept by a worker process, with what an entry itself takes; what comes after they are full is encoded each time.
CACHE_PIECES, CACHE_WORDS, ENTRY = 96_000_000, 48_000_000, 200


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else the next from U+0100 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class Encoder:
    """Encodes batches of texts to arrays of unsigned 16-bit ids (both vocabularies have fewer than 65,536)."""

    def __init__(self, path: str, leading_blank: bool):
        """``leading_blank``: the vocabulary keeps case and the blank before a word as part of it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if sys.byteorder != "little":
            raise OSError("ids are kept in the machine's byte order, which has to be little-endian")
        self.library = Tokenizer.from_file(path)
        if self.library.get_vocab_size(with_added_tokens=True) > 65_536:
            raise ValueError("ids do not fit 16 bits")
        others = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values() if "<|" not in t.content]
        self.added = re.compile("|".join(others), re.I) if others else None
        self.tokenize = self.library.model.tokenize
        self.letters = dict(enumerate(_byte_letters()))
        self.keeps = leading_blank
        self.find = (BLANK_WORDS if leading_blank else BARE_WORDS).findall
        self.line = self._whole(["\n"])[0]
        self.pieces: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}
        self.room_pieces, self.room_words = CACHE_PIECES, CACHE_WORDS

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u2").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if word.isascii():
                seen = "\u0120" + word[1:] if word[0] == " " else word
            else:
                seen = word.encode().decode("latin-1").translate(self.letters)
            found = array("H", [t.id for t in self.tokenize(seen)]).tobytes()
            takes = ENTRY + 2 * len(word) + len(found)
            if takes <= self.room_words:
                self.words[word] = found
                self.room_words -= takes
        return found

    def _piece(self, piece: str) -> bytes:
        if not self.keeps:
            piece = piece.lower()
        body = piece[1:] if piece[0] == " " else piece
        if body.isalpha():
            return self._word(piece)
        if body[:-1].isalpha() and body[-1] in ",.":
            return self._word(piece[:-1]) + self._word(piece[-1])
        return b"".join(map(self._word, self.find(piece)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        pieces, keeps = self.pieces, self.keeps
        for t in texts:
            if "  " in t or "\n\n" in t or "\n " in t or " \n" in t or t[:1] in " \n" or t[-1:] in " \n" or ODD.search(t) or "<|" in t or (self.added and self.added.search(t)):
                out.append(self._whole([t])[0])
                continue
            plain = PLAIN.fullmatch(t)
            lines = []
            for x in t.split("\n"):
                cut = x.split(" ")
                if keeps:
                    cut[1:] = [" " + y for y in cut[1:]]
                got = list(map(pieces.get, cut))
                if None in got:
                    for i, y in enumerate(cut):
                        if got[i] is None:
                            got[i] = self._piece(y) if plain else self._whole([y])[0]
                            takes = ENTRY + 2 * len(y) + len(got[i])
                            if takes <= self.room_pieces:
                                pieces[y] = got[i]
                                self.room_pieces -= takes
                lines.append(b"".join(got))
            out.append(self.line.join(lines))
        return [np.frombuffer(x, dtype="<u2") for x in out]


@lru_cache(maxsize=4)
def encoder(path: str, leading_blank: bool) -> Encoder:
    """One per worker process, so that tasks share its caches."""
    return Encoder(path, leading_blank)


def forget() -> None:
    """Lets go of the encoders that an earlier task of this worker process left: other operators need the memory, and Spark uses workers again."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        gc.collect()
