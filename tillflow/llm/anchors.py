"""Runs of windows that share an anchor, for finding windows that occur more than once.

A window is ``window`` consecutive tokens. Its anchor is the run of ``core`` tokens
inside it with the least hash, the leftmost of equal ones, so equal windows have
equal anchors at equal places. Consecutive windows mostly share their anchor:
each such run of windows (its tokens are a path without branches through the
graph whose edges are windows) becomes one row instead of a row per window. Rows
with equal ``anchor`` and ``path`` (hashes of the anchor and of all the run's
tokens, 64 bits each and independent) are equal runs; windows of different runs can
only be equal if the anchors are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.tables import settled, spread, text_column

CHUNK = 1 << 19
SAMPLE, SHARES, LEAST_HOT = 64, 20, 16
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
RUN = (
    "anchor bigint, path bigint, doc bigint, start bigint, windows int, lead int,"
    " own bigint, part int"
)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of ``base`` and of its inverse, modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base][0]) < size:
        size = max(size, CHUNK + 4_096)
        both = []
        for x in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, x, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _POWERS[base] = tuple(both)
    return _POWERS[base]


class Hashes:
    """Hashes of any run of a token sequence (``values``: one random-looking 64-bit number per token)."""

    def __init__(self, values: np.ndarray, base: int) -> None:
        up, self.down = powers(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, size: int) -> np.ndarray:
        """The hash of each run of ``size`` tokens."""
        count = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:count]) * self.down[:count])


def sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive keys, by doubling."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[:len(keys) - rest], keys[rest:]) if rest else keys


def pieces(sizes: np.ndarray, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Batches of (row, first token, last token) of about ``CHUNK`` tokens; a long row is cut, with overlap."""
    held: list[tuple[int, int, int]] = []
    total = 0
    for row in np.flatnonzero(sizes >= window).tolist():
        size = int(sizes[row])
        for first in range(0, size - window + 1, CHUNK):
            last = min(size, first + CHUNK + window - 1)
            if held and total + last - first > CHUNK:
                yield held
                held, total = [], 0
            held.append((row, first, last))
            total += last - first
    if held:
        yield held


def anchored_runs(values: np.ndarray, edges: np.ndarray, window: int, core: int):
    """Runs in several token sequences laid end to end, sequence i being ``edges[i]:edges[i + 1]``.

    Returns the first window of each run, its number of windows, where the anchor
    starts, and the hashes of anchor and path.
    """
    first_hash, path_hash = Hashes(values, BASES[0]), Hashes(values, BASES[1])
    cores = first_hash.all(core)
    mask = np.uint64((1 << 24) - 1)
    keys = (cores & ~mask) | np.arange(len(cores), dtype=np.uint64)
    place = (sliding_minimum(keys, window - core + 1) & mask).astype(np.int64)
    inside = np.zeros(len(place) + 1, np.int32)
    starts, ends = edges[:-1], edges[1:] - window + 1
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    inside = np.cumsum(inside[:-1]) > 0
    fresh = np.ones(len(place), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(place)))
    valid = inside[first]
    first, count = first[valid], count[valid]
    at = place[first]
    return first, count, at, cores[at], path_hash.of(first, first + count - 1 + window)


class Hot(NamedTuple):
    """Sorted anchors, and runs (sorted by path) with their numbers of parts, that many rows have."""

    anchors: np.ndarray
    paths: np.ndarray
    path_anchors: np.ndarray
    parts: np.ndarray


NONE_HOT = Hot(*[np.zeros(0, np.int64)] * 4)


def _found(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value would stand among the sorted keys, and whether it does."""
    at = np.minimum(np.searchsorted(keys, values), max(0, len(keys) - 1))
    return at, keys[at] == values if len(keys) else np.zeros(len(values), bool)


def run_batch(
    row_docs: np.ndarray, cut: list[tuple[int, int, int]], found, edges: np.ndarray, hot: Hot
) -> pa.RecordBatch:
    """The runs of one batch of pieces as rows of ``RUN``.

    ``own`` and ``part`` say where a hot run is dealt to: that of a hot anchor by
    its path (not zero then), that of a hot path to one of its parts.
    """
    first, count, at, anchor, path = found
    anchor, path = anchor.view(np.int64), path.view(np.int64)
    piece = np.searchsorted(edges, first, side="right") - 1
    docs = row_docs[np.array([p[0] for p in cut])[piece]]
    start = first - edges[piece] + np.array([p[1] for p in cut])[piece]
    _, is_hot = _found(hot.anchors, anchor)
    place, listed = _found(hot.paths, path)
    part = np.zeros(len(path), np.int64)
    if listed.any():
        listed &= hot.path_anchors[place] == anchor
        spot = mix(docs.astype(np.uint64) * np.uint64(BASES[0]) + start.astype(np.uint64))
        part = np.where(listed, spot % hot.parts[place].astype(np.uint64), 0).astype(np.int64)
    columns = [anchor, path, docs, start, count.astype(np.int32), (at - first).astype(np.int32),
               np.where(is_hot, path | 1, 0), part.astype(np.int32)]
    names = ["anchor", "path", "doc", "start", "windows", "lead", "own", "part"]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def numbered(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``doc, doc_id, text`` with a distinct number ``doc`` per row that ascends with the id.

    Distinct ids are their own numbers. Otherwise rows are sorted by id (nulls
    first), then text, and numbered in that order once, in a settled table.
    """
    chosen = docs.select(F.col(id).cast("long").alias("doc_id"), text_column(text).alias("text"))
    rows, ids = chosen.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if rows == ids:
        return chosen.select(F.col("doc_id").alias("doc"), "doc_id", "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    ordered = chosen.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return settled(ordered.select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text"))


def hot_runs(runs_of: Callable[[DataFrame, Hot], DataFrame], docs: DataFrame) -> Hot:
    """Anchors and runs that many rows have, from one in ``SAMPLE`` documents.

    They only decide where rows are dealt to. A listed one has at least
    ``1 / (SHARES * partitions)`` of the sampled rows, so each list has at most
    ``SHARES * partitions`` entries, whatever the data.
    """
    drawn = docs.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE)) == 0)
    held = settled(runs_of(drawn, NONE_HOT).groupBy("anchor", "path").agg(F.count("*").alias("n")))
    total = held.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(LEAST_HOT, -(-total // (SHARES * partitions)))
    anchors = held.groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    anchors = [row["anchor"] for row in anchors.collect()]
    paths = held.where(F.col("n") >= least).orderBy("path").collect()
    return Hot(
        np.sort(np.array(anchors, np.int64)),
        np.array([row["path"] for row in paths], np.int64),
        np.array([row["anchor"] for row in paths], np.int64),
        np.array([-(-row["n"] // least) for row in paths], np.int64),
    )


def repeated_runs(
    runs_of: Callable[[DataFrame, Hot], DataFrame], docs: DataFrame, is_repeat: Column
) -> DataFrame:
    """The runs that matter of ``docs``: ``repeat`` (equal to another run as a whole) and ``open`` ones.

    ``is_repeat`` judges a run by ``before`` and ``after``: whether an equal run
    comes before or after it in document order. A run is open if it is the first of
    its equals and its anchor has different runs, so that single windows of it may
    be repeated.

    Runs meet by anchor; those of a hot anchor by anchor and path, and those of a hot
    path in as many parts as it needs. The first of each path in each part then
    meet once more. Windows read spilling buffers: no group is held in memory.
    """
    dealt = runs_of(docs, hot_runs(runs_of, docs))
    keys = ["anchor", "own", "part"]
    order = Window.partitionBy(*keys).orderBy("path", "doc", "start")
    whole = Window.partitionBy(*keys)
    before, after, varied = F.col("before"), F.col("after"), F.col("varied")
    judged = spread(dealt, *keys).withColumn("hot", F.col("own") != 0).select(
        "*",
        F.coalesce(F.lag("path").over(order) == F.col("path"), F.lit(False)).alias("before"),
        F.coalesce(F.lead("path").over(order) == F.col("path"), F.lit(False)).alias("after"),
        (F.min("path").over(whole) != F.max("path").over(whole)).alias("varied"),
    )
    known = settled(judged.where(F.col("hot") | is_repeat | (~before & varied)).select(
        "anchor", "path", "doc", "start",
        (F.col("windows") * 1024 + F.col("lead")).alias("shape"),
        (F.col("hot").cast("int") * 8 + before.cast("int") * 4 + after.cast("int") * 2
         + varied.cast("int")).alias("flags"),
    )).select(
        "anchor", "path", "doc", "start",
        F.expr("shape div 1024").cast("int").alias("windows"), (F.col("shape") % 1024).alias("lead"),
        (F.col("flags") >= 8).alias("hot"), (F.col("flags") % 8 >= 4).alias("before"),
        (F.col("flags") % 4 >= 2).alias("after"), (F.col("flags") % 2 == 1).alias("varied"),
    )
    firsts = known.where(F.col("hot") & ~before)
    again = Window.partitionBy("anchor", "path").orderBy("doc", "start")
    # As many rows as there are hot anchors.
    variety = firsts.groupBy("anchor").agg((F.min("path") != F.max("path")).alias("varied"))
    firsts = firsts.drop("varied").join(F.broadcast(variety), "anchor").withColumns({
        "before": F.lag("doc").over(again).isNotNull(),
        "after": after | F.lead("doc").over(again).isNotNull(),
    })
    merged = known.where(~F.col("hot") | before).unionByName(firsts)
    return merged.select(
        "anchor", "doc", "start", "windows", "lead", is_repeat.alias("repeat"),
        (~before & varied).alias("open"),
    ).where("repeat or open")


def in_parts(opened: DataFrame, most: int) -> DataFrame:
    """Open runs with ``part`` and ``parts``: those of an anchor with more than ``most`` in several parts."""
    large = opened.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > most).select(
        "anchor", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    # One row at most for each ``most`` open runs.
    parts = F.coalesce("parts", F.lit(1))
    return opened.join(large, "anchor", "left").withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64("doc", "start"), F.col("parts")).cast("int"))


def spans_by_document(spans: DataFrame) -> DataFrame:
    """``doc, spans`` of rows ``doc, start, end``: a document's spans in one list, sorted."""
    return spans.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def covered(spans: list[dict] | None, size: int) -> tuple[np.ndarray, int]:
    """Which of ``size`` tokens lie in a span, and the number of maximal runs of them."""
    marks = np.zeros(size + 1, np.int32)
    if spans:
        np.add.at(marks, [s["start"] for s in spans], 1)
        np.add.at(marks, [s["end"] for s in spans], -1)
    inside = np.cumsum(marks[:-1]) > 0
    return inside, int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())
