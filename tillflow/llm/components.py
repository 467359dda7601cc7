"""Connected components of an edge table, and whole groups out of sorted batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.tables import settled


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, and where each group starts (and the last one ends).

    The rows must be sorted by the (integer) key columns. Only the rows of the last,
    unfinished group are carried from batch to batch, so groups must be of bounded size.
    """
    carried: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(key).to_numpy() for key in keys]
        changes = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            changes |= column[1:] != column[:-1]
        starts = np.flatnonzero(changes) + 1
        if last is not None and tuple(column[0] for column in columns) != last:
            starts = np.concatenate([[0], starts])
        last = tuple(column[-1] for column in columns)
        if len(starts):
            before = sum(b.num_rows for b in carried)
            if before + int(starts[-1]):
                table = pa.Table.from_batches([*carried, batch.slice(0, int(starts[-1]))])
                yield table, np.unique(np.concatenate([[0], before + starts])).astype(np.int64)
            carried = [batch.slice(int(starts[-1]))]
        else:
            carried.append(batch)
    if carried:
        table = pa.Table.from_batches(carried)
        yield table, np.array([0, table.num_rows])


class Forest:
    """Union of numbered points; remembers the links that joined two trees."""

    def __init__(self, size: int) -> None:
        self.label = np.arange(size)
        self.links: list[tuple[int, int]] = []

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        """Joins ``left[i]`` with ``right[i]`` for all i; a link for each two trees that meet."""
        a, b = self.label[left], self.label[right]
        apart = a != b
        if not apart.any():
            return
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        _, first = np.unique(np.minimum(a, b) * len(self.label) + np.maximum(a, b), return_index=True)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for x, y, i, j in zip(a[first].tolist(), b[first].tolist(), left[first].tolist(), right[first].tolist()):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.links.append((i, j))
        moved = np.arange(len(self.label))
        for x in parent:
            moved[x] = root(x)
        self.label = moved[self.label]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, long): root is the least node of its component.

    Alternates large-star and small-star steps until no edge changes; each step
    is a combined aggregate and a join, and is settled, so nothing but counts
    reaches the driver.
    """
    def oriented(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    current = settled(oriented(edges))
    before = state(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = oriented(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        current = settled(oriented(small.select("a", F.col("m").alias("b")).unionByName(
            small.select(F.col("b").alias("a"), F.col("m").alias("b")))))
        after = state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
