"""Substring dedup over the de Bruijn graph of the corpus's words.

Edges of the graph are windows of ``window`` consecutive words, from the node of
their first to the node of their last ``window - 1`` words. An edge that occurs at
two places is repeated. The graph is never laid out edge by edge: consecutive
edges of a document that share an anchor (``anchors``) are a path without branches
and one row. Equal paths meet in a shuffle by anchor; paths that occur whole more
than once are repeated whole. Where an anchor has different paths, branches are
possible inside them: a join with the documents takes those back to their
source coordinates, their edges are listed one by one, and edges that occur twice
are repeated. Repeated paths and edges that follow each other in a document are
compacted into maximal spans, and every word in a span goes.

Edges are known by two independent 64-bit hashes of their words; spans are not
compared with the words of their other occurrences.

Defined results: a null text has no words; a text of fewer words than a window
keeps all; every copy goes, the first as well, repeated rows like any others; rows
without distinct ids are all judged and returned; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.anchors import (
    BASES, RUN, Hashes, Hot, anchored_runs, covered, in_parts, numbered, pieces, repeated_runs, run_batch,
    spans_by_document,
)
from tillflow.llm.tables import byte_texts, map_arrow, settled, slices

WINDOW = 35
CORE = 12
MOST = 16_384


def word_values(words: list[bytes]) -> np.ndarray:
    return np.array([*map(xxhash.xxh3_64_intdigest, words)], np.uint64)


def paths(docs: DataFrame, hot: Hot, window: int, core: int) -> DataFrame:
    """The paths of every document (``doc, text``) as rows of ``RUN``."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def find(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            numbers = batch.column("doc").to_numpy()
            words = [body.split() for body in byte_texts(batch.column("text"))]
            for cut in pieces(np.array([len(w) for w in words]), window):
                values = word_values([w for row, first, last in cut for w in words[row][first:last]])
                edges = np.cumsum([0, *(last - first for _, first, last in cut)])
                yield run_batch(numbers, cut, anchored_runs(values, edges, window, core), edges, shared.value)

    return map_arrow(docs, find, RUN)


def repeated_edges(docs: DataFrame, opened: DataFrame, window: int, most: int) -> DataFrame:
    """``doc, start, end`` of the edges of opened paths that occur more than once among them.

    Edges meet by their hashes; those of an anchor with more than ``most`` opened
    paths do so in parts first, and the first of each part once more.
    """
    wanted = in_parts(opened, most).groupBy("doc").agg(
        F.collect_list(F.struct("start", "windows", "part", "parts")).alias("wanted"))

    def list_edges(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            for number, body, places in zip(
                batch.column("doc").to_pylist(), byte_texts(batch.column("text")),
                batch.column("wanted").to_pylist(),
            ):
                values = word_values(body.split())
                start = np.concatenate([np.arange(p["start"], p["start"] + p["windows"]) for p in places])
                count = [p["windows"] for p in places]
                pair = [
                    np.concatenate([
                        Hashes(values[p["start"]:p["start"] + p["windows"] + window - 1], base).all(window)
                        for p in places]).view(np.int64)
                    for base in BASES
                ]
                part = [np.repeat(np.array([p[n] for p in places], np.int32), count) for n in ("part", "parts")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (np.full(len(start), number), start, *pair, *part)],
                    names=["doc", "start", "one", "two", "part", "parts"])

    edges = map_arrow(docs.select("doc", "text").join(wanted, "doc"), list_edges,
                      "doc bigint, start bigint, one bigint, two bigint, part int, parts int")
    order = Window.partitionBy("one", "two", "part").orderBy("doc", "start")
    met = settled(edges.select(
        "*", F.lag("doc").over(order).isNotNull().alias("before"),
        F.lead("doc").over(order).isNotNull().alias("after"),
    ).where("before or after or parts > 1"))
    again = Window.partitionBy("one", "two").orderBy("doc", "start")
    firsts = met.where("parts > 1 and not before").select(
        "doc", "start", "after", F.lag("doc").over(again).isNotNull().alias("before"),
        F.lead("doc").over(again).isNotNull().alias("other"),
    ).where("before or after or other")
    return met.where("parts = 1 or before").select("doc", "start").unionByName(
        firsts.select("doc", "start")).withColumn("end", F.col("start") + window)


def repeated_spans(docs: DataFrame, window: int = WINDOW, core: int = CORE, most: int = MOST) -> DataFrame:
    """``doc, spans``: the word ranges of documents (``doc, text``) that lie in repeated windows."""
    docs = docs.select("doc", "text")
    known = repeated_runs(lambda some, hot: paths(some, hot, window, core), docs, F.col("before") | F.col("after"))
    whole = known.where("repeat").select(
        "doc", "start", (F.col("start") + F.col("windows") + (window - 1)).alias("end"))
    edges = repeated_edges(docs, known.where("open"), window, most)
    return spans_by_document(whole.unionByName(edges))


def drop_repeated_words(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, core: int = CORE,
    most: int = MOST,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, kept_sha256`` per row; ``kept`` joins the kept words by blanks."""
    rows = numbered(docs, id, text)
    joined = rows.join(repeated_spans(rows, window, core, most), "doc", "left").select("doc_id", "text", "spans")

    def drop(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            out = []
            for body, spans in zip(byte_texts(batch.column("text")), batch.column("spans").to_pylist()):
                words = body.split()
                if spans:
                    gone, _ = covered(spans, len(words))
                    kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                    removed = int(gone.sum())
                else:
                    kept, removed = b" ".join(words), 0
                out.append((len(words), removed, kept, hashlib.sha256(kept).hexdigest()))
            size, removed, kept, digest = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), pa.array(digest)],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return map_arrow(joined, drop,
                     "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
