"""Byte-pair encoding by a tokenization automaton, and decoding.

The merges of a vocabulary file are compiled, one merge gadget after another,
into a deterministic automaton over tokens that accepts exactly the token
sequences the merges produce. Before any merge it has one state that every base
token leads back to. The gadget of a merge (u, v) takes the state p that u leads
to, makes a copy p' of it without its arc v, lets u lead to p' from now on, and
gives each state that has an arc u an arc uv to where v leads from p. So all arcs
of one token lead to one state, a state is its parent less one arc, and the
numbers of the gadgets, by their two tokens, are the whole table.

A word is encoded along the arcs: the vocabulary's trie spells the tokens, and an
arc takes the state at a token's start to the state at its end. Each prefix has
exactly one accepted path, so the longest arcs are tried first and a place with
no way on is never visited again.

Texts are pre-split as the vocabulary file says: canonical composition, lower
case, then contractions, letter runs, single digits and other runs. Pieces
between ASCII white space are split alone, which changes nothing and lets them be
cached. Pieces beyond Latin letters are split by the library's own normalizer
and splitter, whose character tables are then the ones that count.

Defined results: a null text is empty and has no tokens; repeated rows are
encoded alike; an unknown base byte cannot occur, as all 256 are in the vocabulary.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillflow.llm.pieces import PieceEncoder
from tillflow.llm.tables import byte_texts, map_arrow, slices


class TokenAutomaton(PieceEncoder):
    """The compiled merges of one vocabulary file."""

    def __init__(self, file: str) -> None:
        # The automaton's own tables take the room of some pieces.
        super().__init__(file, cache_pieces=100_000, cache_words=200_000)
        with open(file, encoding="utf-8") as source:
            model = json.load(source)["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.labels = {**{i: t for t, i in model["vocab"].items()},
                       **{i: t for t, i in self.special.items()}}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._compile(model["vocab"], merges)

    def _compile(self, vocabulary: dict[str, int], merges: list[list[str]]) -> None:
        """The gadgets in the order of the merges.

        ``gadget[u, v]`` is the number of the merge (u, v); ``made`` is the number
        of the merge that made a token (0: a base token), ``left`` and ``right``
        are its parts.
        """
        size = max(vocabulary.values()) + 1
        self.gadget: dict[tuple[int, int], int] = {}
        self.left, self.right, self.made = [-1] * size, [-1] * size, [0] * size
        for number, (first, second) in enumerate(merges, 1):
            u, v, whole = vocabulary[first], vocabulary[second], vocabulary[first + second]
            if self.made[whole]:
                raise ValueError(f"two merges make {first + second!r}")
            self.gadget[u, v] = number
            self.left[whole], self.right[whole], self.made[whole] = u, v, number
        # The trie: sign -> node; the empty sign of a node is the token that ends there.
        self.trie: dict = {}
        for label, token in vocabulary.items():
            node = self.trie
            for sign in self._signs(label):
                node = node.setdefault(sign, {})
            node[""] = token
        self.arcs: dict[int, bool] = {}

    def _signs(self, label: str) -> list[str]:
        """A label's signs; the end mark belongs to the last one."""
        if self.suffix and label.endswith(self.suffix) and label != self.suffix:
            body = label[: -len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(label)

    def forget(self) -> None:
        super().forget()
        self.arcs = {}

    def has_arc(self, before: int, token: int) -> bool:
        """Whether the state that ``before`` leads to has an arc ``token``.

        That state is the last copy which the gadgets of ``before`` made, each
        less the arc of its second token; the first was copied from the state
        which the right part of ``before`` led to when ``before`` was made, and
        so on. An arc that is younger than a copy came to it with its left part.
        So the arc is missing if a gadget of a token on the right edge of
        ``before`` removed a token on the left edge of ``token`` while both stood.
        """
        limit, made = 1 << 60, self.made
        while before >= 0:
            part, until = token, limit
            while part >= 0:
                number = self.gadget.get((before, part))
                if number is not None and made[part] < number <= until and number < limit:
                    return False
                until, part = min(limit, made[part]), self.left[part]
            limit, before = min(limit, made[before]), self.right[before]
        return True

    def encode_word(self, word: str) -> list[int]:
        """The accepted path over the signs of ``word``, the last of which carries the end mark.

        Every prefix has one accepted path at most, so a place from which no arc
        leads to the end is left for good.
        """
        signs = [*word[:-1], word[-1] + self.suffix]
        arcs, size = self.arcs, len(signs)
        path: list[int] = []
        open_arcs: list[list[tuple[int, int]]] = []
        places, dead, at = [0], set(), 0
        while at < size:
            node, found = self.trie, []
            before = path[-1] if path else -1
            for end in range(at, size):
                node = node.get(signs[end])
                if node is None:
                    break
                token = node.get("")
                if token is not None and end + 1 not in dead:
                    found.append((token, end + 1))
            open_arcs.append(found)
            while True:
                if not open_arcs[-1]:
                    dead.add(places.pop())
                    open_arcs.pop()
                    path.pop()
                    before = path[-1] if path else -1
                    continue
                token, end = open_arcs[-1].pop()
                if end in dead:
                    continue
                if before >= 0:
                    key = before << 32 | token
                    arc = arcs.get(key)
                    if arc is None:
                        if len(arcs) >= 500_000:
                            arcs.clear()
                        arc = arcs[key] = self.has_arc(before, token)
                    if not arc:
                        continue
                path.append(token)
                places.append(end)
                at = end
                break
        return path

    def decode(self, ids: np.ndarray) -> str:
        """The labels of the arcs, joined as the library joins tokens of a file without decoder."""
        return " ".join([self.labels[i] for i in ids.tolist()])


_AUTOMATA: dict[str, TokenAutomaton] = {}


def automaton(file: str) -> TokenAutomaton:
    """The automaton of ``file``, compiled once per process."""
    if file not in _AUTOMATA:
        _AUTOMATA[file] = TokenAutomaton(file)
    return _AUTOMATA[file]


def encode_documents(docs: DataFrame, file: str, text: str = "text", decoded: bool = True) -> DataFrame:
    """``docs`` with ``_ids`` (little-endian unsigned 32-bit integers) and ``_decoded`` (their decoded text).

    ``file`` is a vocabulary file of the tokenizers library at a path that every
    executor has. Every text is encoded whole, in the task that reads it. Columns
    of those names are replaced.
    """
    docs = docs.drop("_ids", "_decoded")
    names = docs.columns
    schema = T.StructType([
        *docs.schema.fields,
        T.StructField("_ids", T.BinaryType()),
        *([T.StructField("_decoded", T.StringType())] if decoded else []),
    ])

    def encode(batches: Iterator[pa.RecordBatch]):
        tokens = automaton(file)
        try:
            for batch in slices(batches, text):
                ids = [tokens.encode(body) for body in byte_texts(batch.column(text))]
                columns = [*(batch.column(name) for name in names), pa.array(ids, pa.binary())]
                if decoded:
                    spelt = [tokens.decode(np.frombuffer(i, "<u4")) for i in ids]
                    columns.append(pa.array(spelt, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        finally:
            # The process may wait for other work: it keeps the automaton, not the cache.
            tokens.forget()

    return map_arrow(docs, encode, schema)
