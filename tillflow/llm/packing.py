"""Packing tokenised documents into sequences by bounded-space online best fit.

Each task packs the documents of its part of the input in the order it reads them.
It holds at most ``OPEN`` open sequences. A bitset has a bit for each free space
that an open sequence has; a piece goes to the sequence with the least free space
that holds it, found by one shift and the lowest bit left. Where none fits, a new
sequence is opened, and if that is one too many the fullest closes first. Pieces of
the whole length are sequences of their own. So a text is tokenised, cut and placed
where it is read, and never shuffled.

The pieces of what is still open at the end of a task are packed again, with those
of other tasks: in groups of up to ``GROUP`` pieces, the longest first. Each group
passes its emptiest sequences on, with at most a sixteenth of ``GROUP`` pieces, until
one group holds all that is left. So the last tasks' rests, and small tables, are
packed by best fit decreasing.

A document is its ids and ``end_id``. Only a longer one than a sequence is cut: all
its pieces but the first have the whole length.

Defined results: a null or empty text is its end id alone; a null document id is an
id like any other; rows with one id, or of one text, are packed apart; an empty table
gives no rows. Texts are tokenised in windows of bounded size, and only the ids of
one batch, or of one longer text, are held at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.batch_encoding import batch_encoder
from tillflow.llm.components import whole_groups
from tillflow.llm.tables import map_arrow, scratch_folder, slices, spread

LENGTH = 2_048
OPEN = 1_024
GROUP = 32_768
# Sequence ids hold the task above this many bits and the task's own number below.
NUMBER_BITS = 36


class BestFit:
    """Open sequences of ``length`` tokens, at most ``most`` of them."""

    def __init__(self, length: int = LENGTH, most: int = OPEN) -> None:
        self.length, self.most = length, most
        self.spaces = 0
        self.by_space: list[list[int]] = [[] for _ in range(length + 1)]
        self.held = self.opened = 0

    def _hold(self, sequence: int, free: int) -> None:
        if free:
            self.by_space[free].append(sequence)
            self.spaces |= 1 << free
            self.held += 1

    def _release(self, free: int) -> int:
        sequences = self.by_space[free]
        sequence = sequences.pop()
        if not sequences:
            self.spaces &= ~(1 << free)
        self.held -= 1
        return sequence

    def place(self, size: int) -> tuple[int, int]:
        """The sequence and the offset for an item of ``size`` tokens (1 to ``length``)."""
        fitting = self.spaces >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            sequence = self._release(free)
        else:
            if self.held >= self.most and size < self.length:
                # The fullest closes.
                self._release((self.spaces & -self.spaces).bit_length() - 1)
            sequence, free = self.opened, self.length
            self.opened += 1
        self._hold(sequence, free - size)
        return sequence, self.length - free

    def emptiest(self, pieces: dict[int, int], most: int) -> list[int]:
        """Open sequences, the emptiest first, that hold ``most`` pieces at most; ``pieces`` counts them."""
        chosen = []
        for found in reversed(self.by_space):
            for sequence in found:
                most -= pieces[sequence]
                if most < 0:
                    return chosen
                chosen.append(sequence)
        return chosen


def place_documents(
    docs: DataFrame, file: str, id: str, text: str, end_id: int, length: int, most: int,
    group: int, per_piece: Callable[[bytes], int] | None,
) -> DataFrame:
    """Pieces with the sequence of their task and, marked ``open``, the sequences that the task left open."""
    content = "ids" if per_piece is None else "digest"
    last = pa.binary() if per_piece is None else pa.int64()
    schema = (
        f"sequence bigint, offset bigint, doc_id bigint, piece int, start bigint, length bigint,"
        f" {content} {'binary' if per_piece is None else 'bigint'}, open boolean")
    chosen = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def rows(columns: list[list], open: bool) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), last]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        arrays.append(pa.array(np.full(len(columns[0]), open)))
        return pa.RecordBatch.from_arrays(
            arrays, names=["sequence", "offset", "doc_id", "piece", "start", "length", content, "open"])

    def place(batches: Iterator[pa.RecordBatch]):
        encoder, fit = batch_encoder(file), BestFit(length, most)
        task = TaskContext.get().partitionId() << NUMBER_BITS
        end = np.array([end_id], np.uint32)
        held: dict[int, int] = {}
        for batch in slices(batches, "text"):
            ids, counts = encoder.encode(batch.column("text"))
            out: list[list] = [[] for _ in range(7)]
            at = 0
            for doc_id, count in zip(batch.column("doc_id").to_pylist(), counts.tolist()):
                body = np.concatenate([ids[at:at + count], end])
                at += count
                start, piece = 0, 0
                until = len(body) % length or length
                while start < len(body):
                    part = body[start:until].tobytes()
                    sequence, offset = fit.place(until - start)
                    held[sequence] = held.get(sequence, 0) + 1
                    value = part if per_piece is None else per_piece(part)
                    for column, x in zip(
                            out, (task + sequence, offset, doc_id, piece, start, until - start, value)):
                        column.append(x)
                    start, piece, until = until, piece + 1, until + length
            yield rows(out, False)
            open = {s for found in fit.by_space for s in found}
            held = {s: n for s, n in held.items() if s in open}
        left = fit.emptiest(held, group)
        nothing = [None] * len(left)
        yield rows([[task + s for s in left], *[nothing] * 6], True)

    return map_arrow(chosen, place, schema)


def repack(pieces: DataFrame, length: int, most: int, group: int) -> DataFrame:
    """``sequence, offset, into, at``: new places for ``pieces`` (``sequence, offset, length``)."""
    spark = pieces.sparkSession
    passed_on = max(1, group // 16)

    def pack(turn: int, last: bool):
        def place(batches: Iterator[pa.RecordBatch]):
            for table, bounds in whole_groups(batches, ["share"]):
                shares, sizes = table["share"].to_pylist(), table["length"].to_pylist()
                into, at, open = [], [], []
                for begin, until in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    fit, held = BestFit(length, most), {}
                    placed = [fit.place(size) for size in sizes[begin:until]]
                    for sequence, _ in placed:
                        held[sequence] = held.get(sequence, 0) + 1
                    again = set() if last else set(fit.emptiest(held, passed_on))
                    # Below zero, so that no task's sequence has the name.
                    name = -1 - (turn << 56 | shares[begin] << 24)
                    into += [name - sequence for sequence, _ in placed]
                    at += [offset for _, offset in placed]
                    open += [sequence in again for sequence, _ in placed]
                yield pa.RecordBatch.from_arrays(
                    [*(table[n].combine_chunks() for n in ("sequence", "offset", "length")),
                     pa.array(into, pa.int64()), pa.array(at, pa.int64()), pa.array(open)],
                    names=["sequence", "offset", "length", "into", "at", "open"])

        return place

    done, turn = None, 0
    while True:
        groups = max(1, -(-pieces.count() // group))
        # A group takes pieces of all lengths, so that short ones find room beside long ones.
        dealt = spread(pieces.withColumn("share", F.pmod(F.xxhash64("sequence", "offset"), F.lit(groups))), "share")
        path = scratch_folder(spark, "repacked-pieces")
        map_arrow(
            dealt.sortWithinPartitions("share", F.col("length").desc(), "sequence", "offset"),
            pack(turn, groups == 1),
            "sequence bigint, offset bigint, length bigint, into bigint, at bigint, open boolean",
        ).write.parquet(path)
        found = spark.read.parquet(path)
        settled = found.where("not open").select("sequence", "offset", "into", "at")
        done = settled if done is None else done.unionByName(settled)
        if groups == 1:
            return done
        pieces, turn = found.where("open").select("sequence", "offset", "length"), turn + 1


def pack_documents(
    docs: DataFrame,
    file: str,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    length: int = LENGTH,
    most: int = OPEN,
    group: int = GROUP,
    per_piece: Callable[[bytes], int] | None = None,
) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset``, a row per piece.

    ``start`` counts the document's ids before the piece; ``ids`` are little-endian
    unsigned 32-bit integers. With ``per_piece`` a long ``digest`` of the ids stands
    in their place. ``file`` is a vocabulary file of the tokenizers library at a path
    that every executor has.
    """
    spark = docs.sparkSession
    path = scratch_folder(spark, "placed-pieces")
    place_documents(docs, file, id, text, end_id, length, most, group, per_piece).write.parquet(path)
    placed = spark.read.parquet(path)
    pieces = placed.where("not open")
    left = pieces.join(placed.where("open").select("sequence"), "sequence").select("sequence", "offset", "length")
    return pieces.join(repack(left, length, most, group), ["sequence", "offset"], "left").select(
        "doc_id", "piece", "start", "length", "ids" if per_piece is None else "digest",
        F.coalesce("into", "sequence").alias("sequence_id"), F.coalesce("at", "offset").alias("offset"))
