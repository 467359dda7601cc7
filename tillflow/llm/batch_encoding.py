"""Token ids of whole Arrow columns of texts: only the distinct pieces of a batch are encoded.

The bytes of a batch are cut into pieces where no token can cross: before a run of
ASCII white space that follows a printable ASCII or a Latin letter, and between an
ASCII letter and an ASCII sign. The pieces are dictionary-encoded, the distinct ones
that were not seen before go to the tokenizers library, and the ids of all pieces are
laid out from the distinct ones. Nothing is done per piece in Python.

Texts with a mark such as ``<|endoftext|>`` or a capital sigma, whose form depends on
what is around it, are encoded whole by the library.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

WINDOW = 8_000_000
CACHE_PIECES = 400_000
LONGEST_CACHED = 100
WHOLE = "<\\||Σ"


def _among(signs: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(signs)] = True
    return table


WHITE = _among(b" \t\n\x0b\x0c\r")
PRINTABLE = _among(bytes(range(0x21, 0x7F)))
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTER = _among(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B)]))
SIGN = PRINTABLE & ~LETTER & ~_among(b"0123456789")
# First bytes of the Latin letters U+00C0 to U+024F, none of which is white space.
LATIN = _among(bytes(range(0xC3, 0xCA)))
# What a vocabulary that lower-cases and ignores the kind of white space does not tell apart.
FOLDED = np.frombuffer(bytes(range(256)).lower().translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)), np.uint8)


def cuts(data: np.ndarray) -> np.ndarray:
    """Marks the bytes before which a text may be cut."""
    found = np.zeros(len(data), bool)
    if len(data) > 1:
        found[1:] = (WHITE[data[1:]] & PRINTABLE[data[:-1]]) | (SIGN[data[1:]] & LETTER[data[:-1]])
    if len(data) > 2:
        found[2:] |= WHITE[data[2:]] & LATIN[data[:-2]]
    return found


class BatchEncoder:
    """Ids (unsigned 32-bit) of texts by a vocabulary file; two generations of pieces are kept, over tasks too."""

    def __init__(self, file: str) -> None:
        # Tasks share the executor's cores; the library's own threads would take more than theirs.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        normalizer = self.tokenizer.normalizer
        self.folds = normalizer is not None and normalizer.normalize_str("A\tB\n\x0b\x0c\r") == "a b "
        self.blank = self._blank() if self.folds or normalizer is None else None
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _blank(self) -> str | None:
        """What a blank before a word becomes in the model's spelling; None if ASCII letters are not one word, spelt as they are."""
        split = self.tokenizer.pre_tokenizer
        if split is None:
            return None
        found = ["".join(w if len(words) == 1 else "\n" for w, _ in words) for words in map(split.pre_tokenize_str, (LETTERS, " " + LETTERS))]
        return found[1].removesuffix(LETTERS) if found[0] == LETTERS and found[1].endswith(LETTERS) else None

    def _words(self, distinct: list[bytes], places: list[int], found: list[bytes | None]) -> list[int]:
        """Puts the ids of the pieces at ``places`` that are a word of ASCII letters, with a blank before it
        or none, into ``found``; returns the other places. The model is asked directly, as there is nothing
        to normalise or to split."""
        if self.blank is None:
            return places
        tokenize, others = self.tokenizer.model.tokenize, []
        for at in places:
            piece = distinct[at]
            word = piece[1:] if piece[:1] == b" " else piece
            if word.isalpha():
                spelt = word.decode() if word is piece else self.blank + word.decode()
                found[at] = array("I", [token.id for token in tokenize(spelt)]).tobytes()
            else:
                others.append(at)
        return others

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _pieces(self, distinct: list[bytes]) -> list[bytes]:
        young, old = self.young, self.old
        found = list(map(young.get, distinct))
        missing = [at for at, ids in enumerate(found) if ids is None]
        if missing and old:
            for at in missing:
                found[at] = old.get(distinct[at])
        unknown = self._words(distinct, [at for at in missing if found[at] is None], found)
        for at, ids in zip(unknown, self._whole([distinct[at].decode() for at in unknown])):
            found[at] = ids
        if len(young) + len(missing) > CACHE_PIECES:
            self.old, self.young = young, {}
            young = self.young
        young.update((distinct[at], found[at]) for at in missing if len(distinct[at]) < LONGEST_CACHED)
        return found

    def _window(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces of ``data`` that begin at ``starts``, and how many each has."""
        if self.folds:
            data = FOLDED[data]
        bounds = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        each = self._pieces(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        flat = np.frombuffer(b"".join(each), "<u4")
        codes = coded.indices.to_numpy()
        counts = sizes[codes]
        first = (np.cumsum(sizes) - sizes)[codes] - (np.cumsum(counts) - counts)
        return flat[np.repeat(first, counts) + np.arange(counts.sum())], counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts``, one after another, and how many each text has; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, WHOLE).to_numpy(zero_copy_only=False)
        if whole.any():
            apart = self._whole(texts.filter(pa.array(whole)).to_pylist())
            rest, counts = self.encode(pc.if_else(pa.array(whole), "", texts))
            ends = np.cumsum(counts)
            out, before = [], 0
            for at, ids in zip(np.flatnonzero(whole).tolist(), apart):
                out += [rest[before:ends[at]], np.frombuffer(ids, "<u4")]
                before = ends[at]
                counts[at] = len(ids) // 4
            return np.concatenate([*out, rest[before:]]), counts
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        low, high = (int(bounds[0]), int(bounds[-1])) if len(bounds) else (0, 0)
        counts = np.zeros(len(texts), np.int64)
        if low == high:
            return np.zeros(0, np.uint32), counts
        data = np.frombuffer(texts.buffers()[2], np.uint8)[low:high]
        begins = bounds[:-1] - low
        out = []
        at = 0
        while at < len(data):
            until = min(at + WINDOW, len(data))
            starts = self._starts(data, begins, at, until)
            if until < len(data):
                # The last piece may go on: the next window begins with it.
                while len(starts) < 2 and until < len(data):
                    until = min(until + WINDOW, len(data))
                    starts = self._starts(data, begins, at, until)
                if until < len(data):
                    until = int(starts[-1])
                    starts = starts[:-1]
            ids, sizes = self._window(data[at:until], starts - at)
            out.append(ids)
            owner = np.searchsorted(begins, starts, side="right") - 1
            counts += np.bincount(owner, sizes, len(counts)).astype(np.int64)
            at = until
        return np.concatenate(out), counts

    @staticmethod
    def _starts(data: np.ndarray, begins: np.ndarray, at: int, until: int) -> np.ndarray:
        found = cuts(data[at:until])
        inside = begins[np.searchsorted(begins, at):np.searchsorted(begins, until)]
        found[inside - at] = True
        found[0] = True
        return np.flatnonzero(found) + at


_ENCODERS: dict[str, BatchEncoder] = {}


def batch_encoder(file: str) -> BatchEncoder:
    """The encoder of ``file``, read once per process."""
    if file not in _ENCODERS:
        _ENCODERS[file] = BatchEncoder(file)
    return _ENCODERS[file]
