"""Splitting texts for word vocabularies, with bounded caches of what was encoded before.

A text is cut at ASCII white space into pieces, a piece into special marks and
words. As no word crosses white space, pieces can be encoded alone.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Sequence

from tokenizers import Tokenizer

CACHE_PIECES = 150_000
CACHE_WORDS = 300_000
LONGEST_CACHED = 100
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
# Letters and signs for which the pattern above agrees with the vocabulary's:
# ASCII and Latin letters with marks, composed, without the dotted capital I.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-įıĲ-ž]*")


def byte_signs() -> list[str]:
    """The printable sign of each byte: itself if printable Latin-1, else the next code point from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(byte if byte in plain else next(others)) for byte in range(256)]


class PieceEncoder:
    """Token ids of texts as little-endian unsigned 32-bit integers; ``encode_word`` does one word.

    Two generations of ``cache_pieces`` pieces are kept, so what is frequent
    stays, and ``cache_words`` words.
    """

    def __init__(
        self, file: str, cache_pieces: int = CACHE_PIECES, cache_words: int = CACHE_WORDS
    ) -> None:
        self.cache_pieces, self.cache_words = cache_pieces, cache_words
        self.tokenizer = Tokenizer.from_file(file)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {token.content: id for id, token in added.items()}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.byte_signs = byte_signs()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def encode_word(self, word: str) -> Sequence[int]:
        raise NotImplementedError

    def split(self, part: str) -> list[str]:
        """The words of a part, spelt in byte signs."""
        if PLAIN.fullmatch(part):
            words = SPLIT.findall(part.lower())
            if part.isascii():
                return words
            return [w if w.isascii() else "".join([self.byte_signs[b] for b in w.encode()])
                    for w in words]
        text = self.tokenizer.normalizer.normalize_str(part)
        return [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text) if w]

    def encode_piece(self, piece: bytes) -> bytes:
        out: list[bytes] = []
        text = piece.decode()
        for part in self.marks.split(text) if "<" in text else (text,):
            if part in self.special:
                out.append(struct.pack("<I", self.special[part]))
                continue
            for word in self.split(part):
                ids = self.words.get(word)
                if ids is None:
                    path = self.encode_word(word)
                    ids = struct.pack(f"<{len(path)}I", *path)
                    if len(self.words) >= self.cache_words:
                        self.words.clear()
                    if len(word) < LONGEST_CACHED:
                        self.words[word] = ids
                out.append(ids)
        return b"".join(out)

    def forget(self) -> None:
        """Drops what was cached."""
        self.young, self.old, self.words = {}, {}, {}

    def encode(self, text: bytes) -> bytes:
        young, old, out = self.young, self.old, []
        for piece in text.split():
            ids = young.get(piece)
            if ids is None:
                ids = old.get(piece)
                if ids is None:
                    ids = self.encode_piece(piece)
                if len(young) >= self.cache_pieces:
                    self.old = old = young
                    self.young = young = {}
                if len(piece) < LONGEST_CACHED:
                    young[piece] = ids
            out.append(ids)
        return b"".join(out)
