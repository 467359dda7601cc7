"""SimHash near-duplicates by tiled exact comparison.

A text's fingerprint has the bits that are set in over half the XXH64 values of
its word shingles. Equal fingerprints are one point. Points are cut into tiles by
their population counts, taken for each quarter of the fingerprint: two points
that differ in r bits have counts that differ by r at most over all quarters, so
only tiles within that distance meet, and every pair of those is compared with
numpy's exclusive-or and bit counts. A full tile is cut by hash, so no task holds
more than a tile and its neighbours.

A comparison emits a spanning forest of its links, so a group of near copies
gives as many rows as it has members, not as many as it has pairs.

Defined results: a null or empty text has no words and fingerprint zero, which is
linked like any other; fewer words than a shingle are one shingle; repeated rows
are equal points; a null id takes part but is no component's id unless all are null;
an empty table gives no rows. A very long text's shingles are added up in blocks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.components import Forest, components, whole_groups
from tillflow.llm.tables import byte_texts, map_arrow, settled, slices, spread, text_column

SEED = 42
TILE = 4_096
QUARTERS = 4
ROWS = 256
BLOCK = 1 << 18


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each run of ``words`` lower-cased words, joined by blanks."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(parts) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[words - 1:].tolist())
    return np.array([digest(joined[start:end], SEED) for start, end in spans], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes, as a signed 64-bit integer."""
    if len(hashes) == 0:
        return 0
    counts = np.zeros(64, np.int64)
    for first in range(0, len(hashes), BLOCK):
        part = hashes[first:first + BLOCK].astype("<u8").view(np.uint8)
        counts += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_key, fingerprint`` (signed) per row; the key is the text's SHA-256."""
    chosen = docs.select(F.col(id).cast("long").alias("doc_id"), text_column(text).alias("text")).withColumn(
        "text_key", F.unhex(F.sha2("text", 256)))

    def make(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            prints = [fingerprint(shingle_hashes(body, words)) for body in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(prints, pa.int64())],
                names=["doc_id", "text_key", "fingerprint"])

    return map_arrow(chosen, make, "doc_id bigint, text_key binary, fingerprint bigint")


def _cell(radius: int) -> tuple[Column, list[int]]:
    """A point's cell, and by how much the cells that it must meet differ (one of each two directions)."""
    quarter = 64 // QUARTERS
    counts = [
        F.bit_count(F.shiftrightunsigned("fingerprint", quarter * k).bitwiseAND((1 << quarter) - 1))
        for k in range(QUARTERS)
    ]
    base = 2 * quarter + 2 * radius + 1
    cell = sum((counts[k] * base**k for k in range(1, QUARTERS)), counts[0]).cast("long")
    steps = itertools.product(range(-radius, radius + 1), repeat=QUARTERS)
    moves = {sum(s * base**k for k, s in enumerate(step)) for step in steps if sum(map(abs, step)) <= radius}
    return cell, sorted(m for m in moves if m >= 0)


def link_points(points: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Edges ``a, b`` that connect the points (``node, fingerprint``) whose fingerprints differ in ``radius``
    bits or fewer."""
    cell, moves = _cell(radius)
    placed = points.withColumn("cell", cell)
    # There are at most 17**4 cells of counts: a bounded table.
    cells = settled(placed.groupBy("cell").agg(
        F.ceil(F.count("*") / tile).cast("long").alias("chunks")))
    meets = cells.select(F.col("cell").alias("other"), F.col("chunks").alias("other_chunks"))
    homes = (
        cells.select("cell", "chunks", F.explode(F.lit(moves).cast("array<bigint>")).alias("move"))
        .withColumn("other", F.col("cell") + F.col("move")).join(F.broadcast(meets), "other")
    )
    # To each home cell come the points of the cells at its moves, chunk by chunk.
    widest = homes.groupBy("cell").agg(F.max("chunks").alias("chunks"), F.max("other_chunks").alias("widest"))
    visits = homes.groupBy("other").agg(F.collect_list(F.struct("cell", "chunks")).alias("visits"))
    plan = widest.join(
        visits.select(F.col("other").alias("cell"), "visits"), "cell")
    known = placed.join(F.broadcast(plan), "cell").withColumn(
        "chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    carried = ["node", "fingerprint"]
    home = known.select(
        F.lit(True).alias("home"), F.col("cell").alias("home_cell"), F.col("chunk").alias("home_chunk"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("widest") - 1)).alias("visit_chunk"),
        *carried)
    visit = known.select(
        "cell", "chunk", F.explode("visits").alias("visit"), *carried
    ).select(
        F.lit(False).alias("home"), F.col("visit.cell").alias("home_cell"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("visit.chunks") - 1)).alias("home_chunk"),
        F.col("chunk").alias("visit_chunk"), *carried, "cell",
    ).where("cell <> home_cell or home_chunk < visit_chunk").drop("cell")
    keys = ["home_cell", "home_chunk", "visit_chunk"]
    dealt = spread(home.unionByName(visit), *keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]):
        for table, bounds in whole_groups(batches, keys):
            node = table["node"].to_numpy()
            prints = table["fingerprint"].to_numpy().view(np.uint64)
            is_home = table["home"].to_numpy()
            first_visit = table["visit_chunk"].to_numpy()
            links = []
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if end - start > 1:
                    links += _compare(
                        np.arange(start, end), prints, is_home, radius, first_visit[start] == 0)
            pairs = np.array(links, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], names=["a", "b"])

    return map_arrow(dealt, compare, "a bigint, b bigint")


def _compare(rows, prints, is_home, radius, among_homes) -> list[tuple[int, int]]:
    """Links that join the home rows with the visiting rows, and among themselves if asked for, as a forest."""
    counts = np.bitwise_count(prints[rows])
    low, rows = rows.min(), rows[np.argsort(counts, kind="stable")]
    homes, visitors = rows[is_home[rows]], rows[~is_home[rows]]
    forest = Forest(len(rows))
    for others in (homes, visitors) if among_homes else (visitors,):
        there = np.bitwise_count(prints[others])
        for at in range(0, len(homes), ROWS):
            part = homes[at:at + ROWS]
            here = np.bitwise_count(prints[part]).astype(np.int64)
            begin = np.searchsorted(there, max(0, here[0] - radius))
            until = np.searchsorted(there, min(64, here[-1] + radius), side="right")
            for first in range(int(begin), int(until), TILE):
                far = others[first:min(int(until), first + TILE)]
                left, right = np.nonzero(np.bitwise_count(prints[part][:, None] ^ prints[far]) <= radius)
                left, right = part[left], far[right]
                if others is homes:
                    left, right = left[left < right], right[left < right]
                if len(left):
                    forest.join(left - low, right - low)
    return [(int(i + low), int(j + low)) for i, j in forest.links]


def _named_groups(prints: DataFrame, radius: int, tile: int) -> DataFrame:
    """``fingerprint, root, component_id`` of each fingerprint of ``prints``."""
    points = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    nodes = settled(points.withColumn("node", F.col("fingerprint")))
    roots = components(link_points(nodes, radius, tile))
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(least, "root").select("fingerprint", "root", "component_id")


def near_duplicate_components(
    docs: DataFrame, words: int = 3, radius: int = 2, id: str = "doc_id", text: str = "text", tile: int = TILE
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row: components of fingerprints within ``radius`` bits."""
    prints = settled(fingerprints(docs, words, id, text))
    return prints.join(_named_groups(prints, radius, tile), "fingerprint").select(
        "doc_id", "fingerprint", "component_id")


def drop_near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 2, id: str = "doc_id", text: str = "text", tile: int = TILE
) -> DataFrame:
    """``docs`` with one row of each component: the one with the least id (a null id is last, and of rows
    with one id the least digest of the text). Columns ``_near_id`` and ``_near_key`` are dropped."""
    docs = docs.drop("_near_id", "_near_key")
    prints = settled(fingerprints(docs, words, id, text))
    kept = prints.join(_named_groups(prints, radius, tile), "fingerprint").groupBy("root").agg(F.min_by(
        F.struct("doc_id", "text_key"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("kept"))
    kept = kept.select(F.col("kept.doc_id").alias("_kept_id"), F.col("kept.text_key").alias("_kept_key"))
    keyed = docs.withColumns({
        "_near_id": F.col(id).cast("long"), "_near_key": F.unhex(F.sha2(text_column(text), 256))})
    joined = keyed.join(
        kept, keyed["_near_id"].eqNullSafe(kept["_kept_id"]) & (keyed["_near_key"] == kept["_kept_key"]), "left_semi")
    return joined.dropDuplicates(["_near_id", "_near_key"]).drop("_near_id", "_near_key")
