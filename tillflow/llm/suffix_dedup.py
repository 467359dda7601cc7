"""Suffix-array dedup of byte strings by deep-shallow sorting.

Every string of ``window`` bytes that also starts earlier in the corpus loses its
bytes. The suffix array is sparse and dealt over tasks: suffixes are taken at
anchors (``anchors``), which equal strings have at equal places, and those of one
anchor meet in one task. Runs of windows equal as a whole are pre-aggregated: the
first of them stands for all, the others are duplicates. Where an anchor has
different runs, the texts to the right of the anchor and, backwards, to its left
are put in suffix order with their common prefixes by deep-shallow sorting. Two
windows that start ``o`` bytes before their anchors are equal if the left texts
share ``o`` bytes and the right texts the rest, so windows are equal exactly if they
lie in one range of either order; the first of a class stays.

An anchor with more than ``GROUP`` different runs is dealt in parts of about that
size; the first window of each class in each part is then merged over the parts by a
128-bit hash, so no task holds an unbounded group.

Defined results: a null text is empty; a text shorter than a window keeps all;
rows are ordered by id, nulls first, and rows of one id by their text, repeated
rows one after the other; an empty table gives no rows. What is left of a text
may end within a character, so it is bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.anchors import (
    BASES, RUN, Hashes, Hot, anchored_runs, covered, in_parts, mix, numbered, pieces, repeated_runs, run_batch,
    spans_by_document,
)
from tillflow.llm.components import whole_groups
from tillflow.llm.deep_shallow import deep_shallow_order
from tillflow.llm.tables import byte_texts, map_arrow, settled, slices, spread

WINDOW = 100
CORE = 32
GROUP = 16_384
NUMBERS = ("anchor", "start", "windows", "lead", "part", "parts")
VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[0]))


def byte_values(text: bytes) -> np.ndarray:
    return VALUES[np.frombuffer(text, np.uint8)]


def runs(docs: DataFrame, hot: Hot, window: int, core: int) -> DataFrame:
    """The runs of windows of every document (``doc, text``) as rows of ``RUN``."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def find(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            numbers = batch.column("doc").to_numpy()
            bodies = byte_texts(batch.column("text"))
            for cut in pieces(np.array([len(b) for b in bodies]), window):
                values = byte_values(b"".join([bodies[row][first:last] for row, first, last in cut]))
                edges = np.cumsum([0, *(last - first for _, first, last in cut)])
                yield run_batch(numbers, cut, anchored_runs(values, edges, window, core), edges, shared.value)

    return map_arrow(docs, find, RUN)


def with_bodies(docs: DataFrame, opened: DataFrame, window: int) -> DataFrame:
    """The opened runs with ``body``, the bytes of all their windows."""
    wanted = opened.groupBy("doc").agg(
        F.collect_list(F.struct(*NUMBERS)).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            out: dict[str, list] = {name: [] for name in (*NUMBERS, "doc", "body")}
            for number, body, places in zip(
                batch.column("doc").to_pylist(), byte_texts(batch.column("text")),
                batch.column("wanted").to_pylist(),
            ):
                for p in places:
                    for name in NUMBERS:
                        out[name].append(p[name])
                    out["doc"].append(number)
                    out["body"].append(body[p["start"]:p["start"] + p["windows"] - 1 + window])
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return map_arrow(docs.select("doc", "text").join(wanted, "doc"), cut,
                     "anchor bigint, start bigint, windows int, lead int, part int, parts int,"
                     " doc bigint, body binary")


def later_windows(group: np.ndarray, lead: np.ndarray, count: np.ndarray, bodies: list[bytes],
                  window: int, core: int) -> np.ndarray:
    """Per run and window: does an equal window stand in an earlier row of its group?

    The rows of a group must be in corpus order. ``lead`` is how far before its
    anchor a run's first window starts, ``count`` its number of windows.
    """
    right = [body[ahead + core:] for body, ahead in zip(bodies, lead.tolist())]
    left = [body[:ahead][::-1] for body, ahead in zip(bodies, lead.tolist())]
    (right_order, right_shared), (left_order, left_shared) = (
        deep_shallow_order(strings, group) for strings in (right, left))
    rows = len(bodies)
    later = np.zeros((rows, int(count.max(initial=0))), bool)
    ranges = [np.empty(rows, np.int64), np.empty(rows, np.int64)]
    for before in range(int((lead - count).min(initial=0)) + 1, int(lead.max(initial=0)) + 1):
        here = np.flatnonzero((before <= lead) & (before > lead - count))
        if len(here) < 2:
            continue
        ranges[0][right_order] = np.cumsum(right_shared < max(0, window - core - before))
        ranges[1][left_order] = np.cumsum(left_shared < before)
        key = ranges[0][here] * (rows + 1) + ranges[1][here]
        _, first = np.unique(key, return_index=True)
        again = np.ones(len(here), bool)
        again[first] = False
        again = here[again]
        later[again, lead[again] - before] = True
    return later


def duplicate_windows(opened: DataFrame, window: int, core: int, most: int) -> DataFrame:
    """``doc, start, end`` of windows of opened runs (with ``body``) that also start earlier."""
    dealt = spread(opened, "anchor", "part").sortWithinPartitions("anchor", "part", "doc", "start")

    def sort(batches: Iterator[pa.RecordBatch]):
        for table, bounds in whole_groups(batches, ["anchor", "part"]):
            for first, last in _stretches(bounds, most):
                part = table.slice(first, last - first)
                bodies = part["body"].to_pylist()
                doc, start = part["doc"].to_numpy(), part["start"].to_numpy()
                lead, count = (part[n].to_numpy().astype(np.int64) for n in ("lead", "windows"))
                group = np.searchsorted(bounds, np.arange(first, last), side="right")
                later = later_windows(group, lead, count, bodies, window, core)
                edge = np.zeros((len(bodies), later.shape[1] + 2), np.int8)
                edge[:, 1:-1] = later
                change = np.diff(edge, axis=1)
                row, begin = np.nonzero(change == 1)
                _, until = np.nonzero(change == -1)
                out = [doc[row], start[row] + begin, start[row] + until - 1 + window]
                none = np.zeros(len(row), bool)
                hashes = [np.zeros(len(row), np.int64)] * 2
                cut = part["parts"].to_numpy() > 1
                if cut.any():
                    row, at = np.nonzero(
                        cut[:, None] & ~later & (np.arange(later.shape[1]) < count[:, None]))
                    more = [np.concatenate([
                        Hashes(byte_values(bodies[r]), base).all(window)[at[row == r]]
                        for r in np.unique(row).tolist()]).view(np.int64) for base in BASES]
                    out = [np.concatenate([old, new]) for old, new in zip(
                        out, (doc[row], start[row] + at, start[row] + at + window))]
                    hashes = [np.concatenate([old, new]) for old, new in zip(hashes, more)]
                    none = np.concatenate([none, np.ones(len(row), bool)])
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, out), pa.array(none), *map(pa.array, hashes)],
                    names=["doc", "start", "end", "first", "one", "two"])

    found = map_arrow(dealt, sort,
                      "doc bigint, start bigint, end bigint, first boolean, one bigint, two bigint")
    order = Window.partitionBy("one", "two").orderBy("doc", "start")
    # Windows that are first in their part of an anchor in parts: all but the first of all go.
    found = settled(found)
    merged = found.where("first").withColumn("before", F.lag("doc").over(order)).where("before is not null")
    return found.where("not first").unionByName(merged.drop("before")).select("doc", "start", "end")


def _stretches(bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of whole groups of about ``most`` rows."""
    start = 0
    for at, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if end - start > most and at > start:
            yield start, at
            start = at
    if bounds[-1] > start:
        yield start, int(bounds[-1])


def duplicate_spans(docs: DataFrame, window: int = WINDOW, core: int = CORE, most: int = GROUP) -> DataFrame:
    """``doc, spans``: the byte ranges of documents (``doc, text``) in windows that also start earlier."""
    docs = docs.select("doc", "text")
    known = repeated_runs(lambda some, hot: runs(some, hot, window, core), docs, F.col("before"))
    whole = known.where("repeat").select(
        "doc", "start", (F.col("start") + F.col("windows") + (window - 1)).alias("end"))
    opened = with_bodies(docs, in_parts(known.where("open"), most), window)
    return spans_by_document(whole.unionByName(duplicate_windows(opened, window, core, most)))


def drop_repeated_bytes(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, core: int = CORE,
    most: int = GROUP,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256`` per row."""
    rows = numbered(docs, id, text)
    joined = rows.join(duplicate_spans(rows, window, core, most), "doc", "left").select(
        "doc_id", "text", "spans")

    def drop(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            out = []
            for body, spans in zip(byte_texts(batch.column("text")), batch.column("spans").to_pylist()):
                kept, removed, number = body, 0, 0
                if spans:
                    gone, number = covered(spans, len(body))
                    kept, removed = np.frombuffer(body, np.uint8)[~gone].tobytes(), int(gone.sum())
                out.append((len(body), removed, number, kept, hashlib.sha256(kept).hexdigest()))
            size, removed, number, kept, digest = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (size, removed, number)),
                 pa.array(kept, pa.binary()), pa.array(digest)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return map_arrow(joined, drop, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint,"
                                   " kept binary, kept_sha256 string")
