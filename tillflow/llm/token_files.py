"""Token files: ids coded by a static range asymmetric numeral system, in document order.

Format. A data set is Parquet files of segments. A segment holds the ids of
whole documents with ascending ids, at most ``SEGMENT_IDS`` of them unless one
document has more, and can be read without any other segment. Its frequency
table (sums to 2**20) is shared by all its blocks. A block is ``LANES`` lanes of up
to 1,024 ids each: the block's id number j belongs to lane j mod ``LANES``. Each
lane is a coder of its own with a 64-bit state; the 32-bit words of all lanes are
interleaved in the order in which the decoder asks for them. For each block a
checkpoint has the place of its first word and the lanes' states, so blocks
decode in parallel or alone, and a CRC-32 of its ids shows damage.

Documents are dealt by ranges of their ids, so a segment's place among all
follows from (``part``, ``segment``) and the ids before it from the sums of the
segments before it.

Defined results: a null text is empty and has the end id only; a null document
id sorts first; rows with one id are kept, in any order among themselves; an
empty table gives an empty data set.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow.llm.batch_encoding import batch_encoder
from tillflow.llm.tables import map_arrow, slices

LANES = 64
STEPS = 1_024
BLOCK_IDS = LANES * STEPS
SEGMENT_IDS = 2_000_000
PRECISION = 20
# Ids up to which a table says where each is among those of a segment.
DENSE = 1 << 17
LOWEST = np.uint64(1 << 32)
HALF = np.uint64(32)
SCHEMA = (
    "part int, segment int, doc_ids array<bigint>, doc_sizes array<bigint>, n_ids bigint,"
    " lane_steps int, frequency_table binary, words binary, checkpoint_words array<bigint>,"
    " checkpoint_states binary, checksums array<bigint>"
)
ARROW = pa.schema([
    ("part", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_sizes", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("lane_steps", pa.int32()),
    ("frequency_table", pa.binary()), ("words", pa.binary()), ("checkpoint_words", pa.list_(pa.int64())),
    ("checkpoint_states", pa.binary()), ("checksums", pa.list_(pa.int64())),
])


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids and their shares of 2**20, each at least one."""
    symbols, counts = np.unique(ids, return_counts=True)
    room = (1 << PRECISION) - len(symbols)
    if room < 0:
        raise ValueError("more distinct ids than the precision can tell apart")
    shares = 1 + counts * room // max(1, counts.sum())
    shares[np.argmax(counts)] += (1 << PRECISION) - shares.sum()
    return symbols, shares


def places(symbols: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Where each id is among the ascending ``symbols``: from a table, unless it had far more entries than there are ids."""
    highest = int(symbols[-1])
    if highest > max(DENSE, len(ids)):
        return np.searchsorted(symbols, ids)
    table = np.zeros(highest + 1, np.int32)
    table[symbols] = np.arange(len(symbols), dtype=np.int32)
    return table[ids]


def encode_segment(ids: np.ndarray) -> dict:
    """The coded form of ``ids`` (at least one, unsigned 32-bit)."""
    symbols, shares = frequencies(ids)
    starts = np.cumsum(shares) - shares
    blocks = -(-len(ids) // BLOCK_IDS)
    steps = -(-len(ids) // (blocks * LANES))
    size = steps * LANES
    index = np.full(blocks * size, np.argmax(shares), np.int64)
    index[: len(ids)] = places(symbols, ids)
    index = index.reshape(blocks, steps, LANES)
    share, start = shares.astype(np.uint64), starts.astype(np.uint64)
    state = np.full((blocks, LANES), LOWEST, np.uint64)
    words = np.empty((blocks, steps, LANES), np.uint32)
    asked = np.empty((blocks, steps, LANES), bool)
    for step in range(steps - 1, -1, -1):
        at = index[:, step]
        f = share[at]
        full = (state >> np.uint64(64 - PRECISION)) >= f
        asked[:, step] = full
        words[:, step] = state
        state = np.where(full, state >> HALF, state)
        whole = state // f
        state = (whole << np.uint64(PRECISION)) + (state - whole * f) + start[at]
    sizes = asked.sum(axis=(1, 2))
    return {
        "n_ids": len(ids),
        "lane_steps": steps,
        "frequency_table": zlib.compress(np.stack([symbols, shares]).astype("<u4").tobytes(), 1),
        "words": words[asked].astype("<u4").tobytes(),
        "checkpoint_words": (np.cumsum(sizes) - sizes).tolist(),
        "checkpoint_states": state.astype("<u8").tobytes(),
        "checksums": [zlib.crc32(ids[b * size:(b + 1) * size].tobytes()) for b in range(blocks)],
    }


def decode_segment(coded: dict, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of the blocks from ``first`` to before ``last``, all by default; checks their checksums."""
    symbols, shares = np.frombuffer(zlib.decompress(coded["frequency_table"]), "<u4").reshape(2, -1)
    starts = (np.cumsum(shares) - shares).astype(np.uint64)
    share = shares.astype(np.uint64)
    slot = np.repeat(np.arange(len(symbols), dtype=np.int32), shares)
    steps, blocks = coded["lane_steps"], len(coded["checksums"])
    last = blocks if last is None else last
    state = np.frombuffer(coded["checkpoint_states"], "<u8").reshape(blocks, LANES)[first:last]
    words = np.append(np.frombuffer(coded["words"], "<u4"), np.zeros(1, np.uint32)).astype(np.uint64)
    place = np.array(coded["checkpoint_words"][first:last], np.int64)[:, None]
    mask = np.uint64((1 << PRECISION) - 1)
    out = np.empty((last - first, steps, LANES), np.uint32)
    for step in range(steps):
        low = state & mask
        at = slot[low]
        out[:, step] = symbols[at]
        state = share[at] * (state >> np.uint64(PRECISION)) + low - starts[at]
        asks = state < LOWEST
        taken = np.cumsum(asks, axis=1)
        word = words[np.minimum(place + taken - 1, len(words) - 1)]
        state = np.where(asks, (state << HALF) | word, state)
        place = place + taken[:, -1:]
    size = steps * LANES
    ids = out.reshape(-1)[: max(0, min(last * size, coded["n_ids"]) - first * size)]
    for block in range(first, last):
        part = ids[(block - first) * size:(block - first + 1) * size]
        if zlib.crc32(part.tobytes()) != coded["checksums"][block]:
            raise ValueError(f"block {block} of a token segment is damaged")
    return ids


def write_token_files(
    docs: DataFrame, path: str, file: str, id: str = "doc_id", text: str = "text", end_id: int = 2
) -> None:
    """Encodes every text with vocabulary ``file``, appends ``end_id``, and writes the data set to ``path``."""
    chosen = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = chosen.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")

    def write(batches: Iterator[pa.RecordBatch]):
        encoder = batch_encoder(file)
        part, segment = TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        doc_ids: list[int | None] = []
        sizes: list[int] = []
        bodies: list[np.ndarray] = []

        def row():
            coded = encode_segment(np.concatenate(bodies))
            coded |= {"part": part, "segment": segment, "doc_ids": doc_ids, "doc_sizes": sizes}
            return pa.RecordBatch.from_pylist([coded], ARROW)

        for batch in slices(batches, "text"):
            ids, counts = encoder.encode(batch.column("text"))
            at, held = 0, sum(sizes)
            for doc_id, count in zip(batch.column("doc_id").to_pylist(), counts.tolist()):
                if held and held + count + 1 > SEGMENT_IDS:
                    yield row()
                    doc_ids, sizes, bodies, held, segment = [], [], [], 0, segment + 1
                doc_ids.append(doc_id)
                sizes.append(count + 1)
                bodies += [ids[at:at + count], end]
                at += count
                held += count + 1
        if sizes:
            yield row()

    map_arrow(ordered, write, SCHEMA).write.option("compression", "none").parquet(path)


def read_token_files(
    spark: SparkSession, path: str, per_document: Callable[[bytes], int] | None = None
) -> DataFrame:
    """One row per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers. With ``per_document`` a
    long ``digest`` of the ids stands in their place.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    order = Window.orderBy("part", "segment").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select(
        "part", "segment", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    kind = "ids binary" if per_document is None else "digest bigint"
    schema = f"part int, segment int, doc_id bigint, within bigint, n_tokens bigint, {kind}"
    last = pa.binary() if per_document is None else pa.int64()

    def read(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for number in range(batch.num_rows):
                coded = batch.slice(number, 1).to_pylist()[0]
                body = memoryview(decode_segment(coded).astype("<u4").tobytes())
                sizes = np.array(coded["doc_sizes"], np.int64)
                ends = np.cumsum(sizes)
                each = [bytes(body[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                values = each if per_document is None else [per_document(x) for x in each]
                yield pa.RecordBatch.from_arrays([
                    pa.array([coded["part"]] * len(each), pa.int32()),
                    pa.array([coded["segment"]] * len(each), pa.int32()),
                    pa.array(coded["doc_ids"], pa.int64()),
                    pa.array(ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(values, last),
                ], names=["part", "segment", "doc_id", "within", "n_tokens", kind.split()[0]])

    return map_arrow(files, read, schema).join(before, ["part", "segment"]).select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", kind.split()[0])
