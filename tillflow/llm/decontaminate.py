"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. Documents are streamed
through it word by word; after each word it knows the longest run ending there
that also occurs in an item. A document word inside an occurrence of a window
(``window`` consecutive item words, or a whole shorter item) is hit.

Texts are bytes: A-Z are lowered, and a word is a run of ASCII letters, ASCII
digits and any other non-ASCII characters.

The items are read in shards of at most ``shard_words`` words, each a broadcast
of bounded size; an item longer than that is cut with an overlap of one window.
Documents pass once per shard, so any number of items gives whole results.

Defined results: a null or empty text has no words and no hits; a null or empty
item has no windows; items with one id are one item, and a null item id is the
string "null"; a table without items hits nothing; repeated document rows are
judged alike.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.tables import byte_texts, map_arrow, settled, slices

WINDOW = 10
SHARD_WORDS = 200_000
FOLD = bytes(
    byte + 32 if 65 <= byte <= 90
    else byte if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128
    else 32
    for byte in range(256)
)
WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class SuffixAutomaton:
    """Generalised suffix automaton over the word ids of several items.

    State 0 is the empty run. ``longest`` is a state's longest run, ``link`` its
    longest suffix in another state, ``step`` its outgoing words.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            ids = [self.vocabulary.setdefault(word, len(self.vocabulary)) for word in words]
            last = 0
            for word in ids:
                last = self._extend(last, word)
            width = min(window, len(ids))
            for start in range(len(ids) - width + 1 if ids else 0):
                owners.setdefault(tuple(ids[start:start + width]), set()).add(item)
        self._mark(owners)

    def _new(self, longest: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.longest.append(longest)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The part of ``target`` whose runs extend those of ``state`` becomes a state of its own."""
        part = self._new(self.longest[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = part
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = part
            state = self.link[state]
        return part

    def _extend(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:
            fits = self.longest[known] == self.longest[last] + 1
            return known if fits else self._split(last, word, known)
        fresh = self._new(self.longest[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = fresh
            state = self.link[state]
        if state >= 0:
            target = self.step[state][word]
            fits = self.longest[target] == self.longest[state] + 1
            self.link[fresh] = target if fits else self._split(state, word, target)
        return fresh

    def _mark(self, owners: dict[tuple[int, ...], set[str]]) -> None:
        """Per state: the windows that are suffixes of its runs, with the items that hold them."""
        self.windows: list[list[tuple[int, tuple[str, ...]]]] = [[] for _ in self.link]
        for run, items in owners.items():
            state = 0
            for word in run:
                state = self.step[state][word]
            self.windows[state].append((len(run), tuple(sorted(items))))
        for state in sorted(range(1, len(self.link)), key=self.longest.__getitem__):
            self.windows[state] += self.windows[self.link[state]]
        self.least = [min((w for w, _ in found), default=1 << 60) for found in self.windows]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal hit runs of ``words`` as (start, end), and the items with occurring windows."""
        step, link, longest, least = self.step, self.link, self.longest, self.least
        state = length = 0
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for at, word in enumerate(map(self.vocabulary.get, words)):
            if word is None:
                state = length = 0
                continue
            target = step[state].get(word)
            while target is None and state:
                state = link[state]
                length = longest[state]
                target = step[state].get(word)
            if target is None:
                continue
            state = target
            length += 1
            if length < least[state]:
                continue
            widest = 0
            for width, owners in self.windows[state]:
                if width <= length:
                    widest = max(widest, width)
                    items.update(owners)
            start = at + 1 - widest
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, at + 1))
        return spans, items


def _shards(items: DataFrame, item_id: str, text: str, window: int, shard_words: int):
    """Automata over at most ``shard_words`` words each (an overlap more for cut items)."""
    chosen = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
        F.col(text).cast("string").alias("text"),
    )
    held: list[tuple[str, list[bytes]]] = []
    size = 0
    for row in chosen.toLocalIterator():
        words = words_of((row["text"] or "").encode())
        for start in range(0, max(1, len(words) - window + 1), shard_words):
            piece = words[start:start + shard_words + window - 1]
            if size and size + len(piece) > shard_words:
                yield SuffixAutomaton(held, window)
                held, size = [], 0
            held.append((row["item"], piece))
            size += len(piece)
    yield SuffixAutomaton(held, window)


def _merged(*span_lists: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(span for spans in span_lists for span in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


MATCH = T.StructType([
    T.StructField("words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    ]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
MATCH_ARROW = pa.struct([
    ("words", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("items", pa.list_(pa.string())),
])
Batches = Iterator[pa.RecordBatch]


def match_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    finish: Callable[[Batches], Batches] | None = None,
    finished: T.StructType | None = None,
) -> DataFrame:
    """``docs`` with a struct column ``_match``: its words, hit spans and items with occurring windows.

    A column of that name is replaced. It holds ``words`` (long), ``spans`` (array of word ranges, end
    exclusive, not touching) and ``items`` (array of item ids, sorted as strings).
    ``finish``, with the schema ``finished``, works on the matched batches in the same task.
    """
    docs = docs.drop("_match")
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("_match", MATCH)])
    shards = iter(_shards(items, item_id, item_text, window, shard_words))
    result, automaton = docs, next(shards)
    while automaton is not None:
        following = next(shards, None)
        shared = docs.sparkSession.sparkContext.broadcast(automaton)
        again, last = result is not docs, following is None

        def judge(batches: Batches, shared=shared, again=again) -> Batches:
            scan = shared.value.scan
            for batch in slices(batches, text):
                before = batch.column("_match").to_pylist() if again else [None] * batch.num_rows
                found = []
                for body, old in zip(byte_texts(batch.column(text)), before):
                    words = words_of(body)
                    spans, hit = scan(words)
                    if old:
                        spans = _merged(spans, ((s["start"], s["end"]) for s in old["spans"]))
                        hit |= set(old["items"])
                    found.append({
                        "words": len(words),
                        "spans": [{"start": s, "end": e} for s, e in spans],
                        "items": sorted(hit),
                    })
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name) for name in names), pa.array(found, MATCH_ARROW)],
                    names=[*names, "_match"],
                )

        def judge_and_finish(batches: Batches, judge=judge) -> Batches:
            return finish(judge(batches))

        source = settled(result) if again else result
        if last and finish is not None:
            result = map_arrow(source, judge_and_finish, finished)
        else:
            result = map_arrow(source, judge, schema)
        automaton = following
    return result


def _without(body: bytes, spans: list[dict]) -> bytes:
    """``body`` without the given word ranges, nor what stands between their words."""
    places = [(m.start(), m.end()) for m in WORD.finditer(body.translate(FOLD))]
    kept, at = [], 0
    for span in spans:
        kept.append(body[at:places[span["start"]][0]])
        at = places[span["end"] - 1][1]
    return b"".join([*kept, body[at:]])


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    max_span: int = 0,
    max_coverage: float = 0.5,
    **options,
) -> DataFrame:
    """``docs`` without contaminated text.

    Hit spans longer than ``max_span`` words are cut from the text. A document
    of whose words more than ``max_coverage`` are hit goes as a whole. Others
    keep every byte, and null texts stay null. A column ``_match`` is dropped.
    """
    docs = docs.drop("_match")
    names = docs.columns

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            found = batch.column("_match").to_pylist()
            keep, bodies = [], []
            for body, match in zip(batch.column(text).cast(pa.binary()).to_pylist(), found):
                hit = sum(s["end"] - s["start"] for s in match["spans"])
                keep.append(hit <= match["words"] * max_coverage)
                spans = [s for s in match["spans"] if s["end"] - s["start"] > max_span]
                bodies.append(_without(body, spans) if spans else body)
            kind = batch.column(text).type
            texts = pa.array(bodies, pa.binary()).cast(kind) if any(m["spans"] for m in found) else None
            yield pa.RecordBatch.from_arrays(
                [texts if name == text and texts is not None else batch.column(name) for name in names],
                names=names,
            ).filter(pa.array(keep, pa.bool_()))

    return match_items(docs, items, text=text, finish=cut, finished=docs.schema, **options)
