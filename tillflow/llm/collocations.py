"""Collocations by dynamic itemset counting.

The texts are written in ``SHARDS`` shards, and one shard after another is scanned,
round and round. Words are counted from the first shard on. After each shard, the
phrases whose count so far has reached the threshold are noted with that step, and a
longer phrase is counted from the step on at which both its subphrases are noted (two
words: the words; three: the first two and the last two), for exactly one whole cycle,
so in each shard once. Scanning ends when no phrase is left whose cycle is open.

In these scans a phrase is its 64-bit hash. What was noted is a table of ``SLOTS``
bytes, one step each, which two slots of a phrase's hash look up (the later step
counts). It is all that tasks are sent, and it doesn't grow with the data. A clash in
it lets a phrase be counted that need not be, never the reverse; slots are set once, so
a phrase's step is the same in every scan and its cycle is whole. Where the table fills
up, more is counted than need be; ``SLOTS`` is a parameter. The longest phrases have a
table of their own, as no other phrase waits for them. Counts travel packed, ascending
hashes and their counts by ranges of hashes, and are added up where a range meets.

Phrases whose hash reached the threshold are then counted once more by their words,
in one pass over all shards, so clashes of hashes change nothing; that pass gives the
words' counts and the number of words as well.

Texts are split at bytes, a batch at once; words of one batch are numbered by
dictionary encoding, and what a batch has of a phrase is added up before it leaves the
task. A task's counts of all languages leave it together, so the rows of a scan grow with the
counts and the ranges of hashes, of which there is one for ``RANGE`` bytes of text, and not
with the languages or the partitions of a shuffle. A text longer than ``CHUNK`` bytes is cut behind a sign that ends a piece, or at a
blank, where the two words before the cut are read again as a beginning only.

Defined results: a null text is empty; a null ``lang`` is ``und`` and is one with rows
that say so; ``A-Z`` are lower-cased, nothing else is; repeated rows count again; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.tables import map_arrow, removed, scratch_folder, slices, spread, written

SHARDS = 3
THRESHOLD = 10
LONGEST = 3
SLOTS = 1 << 24
CHUNK = 8_000_000
SALTS = 8
# Bits of a row of a bitmap, and rows of exact counts that a task adds up.
BLOCK_BITS = 8 * 4_096
TOGETHER = 1_500_000
# Hashes that a task of a scan adds up, and bytes of text for each range of hashes.
HELD = 2_000_000
RANGE = 2_500_000
NEVER = 255
UNKNOWN = "und"
SEED = 42
# Odd numbers for mixing hashes: fractions of the golden ratio and of the square root of two.
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x6A09E667F3BCC909)
BLANK, BREAK = 1, 2
BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
BETWEEN = BLANKS + BREAKS
KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)] = BLANK
KIND[list(BREAKS)] = BREAK
# For whole texts, which bytes translate faster than arrays.
KINDS, LOWER = KIND.tobytes(), bytes(range(256)).lower()


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of two phrases one after the other, of their hashes."""
    value = (left * FIRST + right) * SECOND
    return value ^ (value >> np.uint64(29))


def slots_of(hashes: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    mask, bits = np.uint64(slots - 1), np.uint64(slots.bit_length() - 1)
    return hashes & mask, (hashes >> bits) & mask


def noted(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The step at which each hash was noted, ``NEVER`` if it was not."""
    first, second = slots_of(hashes, len(table))
    return np.maximum(table[first], table[second])


def chunks(text: bytes, context: int, limit: int) -> Iterator[tuple[bytes, int]]:
    """``text`` in parts of about ``limit`` bytes, each with the number of its first words that were counted before.

    That is ``context`` after a cut within a piece.
    """
    at = again = 0
    while at < len(text):
        until = at + limit
        if until >= len(text):
            yield text[at:], again
            return
        kinds = KIND[np.frombuffer(text, np.uint8, until - at, at)]
        breaks = np.flatnonzero(kinds == BREAK)
        if len(breaks):
            until = at + int(breaks[-1]) + 1
            yield text[at:until], again
            at, again = until, 0
            continue
        starts, ends = word_bounds(kinds)
        # The last word may go on; it and the ``context`` before it begin the next part.
        whole = len(starts) - 1
        if whole <= context + again:
            limit *= 2
            continue
        yield text[at:at + int(ends[whole - 1])], again
        at, again = at + int(starts[whole - context]), context


def word_bounds(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(kinds) + 2, bool)
    np.equal(kinds, 0, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


class Words:
    """The words of one language's texts, numbered, with where pieces end."""

    def __init__(self, blob: bytes, again: int = 0) -> None:
        kinds = np.frombuffer(blob.translate(KINDS), np.uint8)
        starts, ends = word_bounds(kinds)
        sizes = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
        held = blob.translate(LOWER, BETWEEN)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(held)])
        coded = words.dictionary_encode()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.words = coded.dictionary.to_pylist()
        self.again = again
        # The word that follows each sign which ends a piece.
        after = np.searchsorted(starts, np.flatnonzero(kinds == BREAK))
        self.joined = np.ones(max(0, len(starts) - 1), bool)
        self.joined[after[(after > 0) & (after < len(starts))] - 1] = False

    def hashes(self, lang: str) -> np.ndarray:
        """A hash of each distinct word and its language."""
        seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
        return np.fromiter(map(xxhash.xxh64_intdigest, self.words, repeat(seed)), np.uint64, len(self.words))

    def inside(self, length: int) -> np.ndarray:
        """Where phrases of ``length`` words start that lie in a piece."""
        count = max(0, len(self.codes) - length + 1)
        found = np.ones(count, bool)
        for shift in range(length - 1 if count else 0):
            found &= self.joined[shift:shift + count]
        return found

    def counted(self, length: int) -> np.ndarray:
        """Those of them that were not counted before."""
        found = self.inside(length)
        found[:max(0, self.again - length + 1)] = False
        return found


def _gathered(
    batches: Iterator[pa.RecordBatch], context: int, chunk: int
) -> Iterator[tuple[str, bytes, int]]:
    """Languages with texts of about ``chunk`` bytes together, joined by a sign that ends a piece."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in slices(batches, "text"):
        langs = batch.column("lang").to_pylist()
        for lang, text in zip(langs, batch.column("text").cast(pa.binary()).to_pylist()):
            if len(text) > chunk:
                for part, again in chunks(text, context, chunk):
                    yield lang, part, again
                continue
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size > chunk:
                yield from ((l, b"\n".join(texts), 0) for l, texts in held.items())
                held, size = {}, 0
    yield from ((l, b"\n".join(texts), 0) for l, texts in held.items())


# Packed counts: ascending hashes (64 bits), counts (32 bits) and first steps (a byte each) of one size.
PACKED = "bucket int, size int, reached boolean, hashes binary, counts binary, since binary"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    bucket, size, reached, *columns = zip(*rows) if rows else ((),) * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(size, pa.int32()), pa.array(reached, pa.bool_()),
         *(pa.array([array.tobytes() for array in column], pa.binary()) for column in columns)],
        names=["bucket", "size", "reached", "hashes", "counts", "since"])


def _together(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash once, ascending, with the sum of its counts."""
    if not len(hashes):
        return hashes, counts
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    return hashes[first], np.add.reduceat(counts[order], first)


def scan(
    texts: DataFrame, table, step: int, shards: int, longest: int, chunk: int, buckets: int
) -> DataFrame:
    """Packed counts in ``texts`` of the phrases whose cycle is open at ``step``, in ``buckets`` ranges of hashes."""
    limits = np.array([(at << 64) // buckets for at in range(1, buckets)], np.uint64)

    def count(batches: Iterator[pa.RecordBatch]):
        steps = table.value
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        total = 0
        for lang, blob, again in _gathered(batches, longest - 1, chunk):
            words = Words(blob, again)
            each = words.hashes(lang)
            found = []
            if step < shards:
                found.append((1, each[words.codes[words.counted(1)]]))
            # The hash of the phrase that starts at each word, and the step it was noted at.
            hashes, since = each[words.codes], noted(steps, each)[words.codes]
            for length in range(2, longest + 1):
                if len(words.codes) < length:
                    break
                since = np.maximum(since[:-1], since[1:])
                hashes = mixed(hashes[:-1], each[words.codes[length - 1:]])
                open = words.counted(length) & (since <= step) & (since.astype(np.int16) + shards > step)
                found.append((length, hashes[open]))
                if length < longest:
                    since = noted(steps, hashes)
            for size, chosen in found:
                values, counts = np.unique(chosen, return_counts=True)
                held.setdefault(size, []).append((values, counts))
                total += len(values)
            if total > HELD:
                yield from rows(held)
                held, total = {}, 0
        yield from rows(held)

    def rows(held: dict[int, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for size, parts in held.items():
            values, counts = _together(*(np.concatenate(column) for column in zip(*parts)))
            bounds = [0, *np.searchsorted(values, limits).tolist(), len(values)]
            yield _packed([
                (bucket, size, False, values[low:high], counts[low:high].astype(np.uint32),
                 np.full(high - low, step, np.uint8))
                for bucket, (low, high) in enumerate(zip(bounds, bounds[1:])) if low < high])

    return map_arrow(texts, count, PACKED)


def added_up(packed: DataFrame, threshold: int, shards: int, step: int) -> DataFrame:
    """Packed counts with each hash once: those that ``reached`` the threshold, and those that still may."""
    def add(batches: Iterator[pa.RecordBatch]):
        current, held = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != current:
                    yield _packed(list(sums(current, held)))
                    current, held = row["bucket"], {}
                held.setdefault(row["size"], []).append((
                    np.frombuffer(row["hashes"], np.uint64), np.frombuffer(row["counts"], np.uint32),
                    np.frombuffer(row["since"], np.uint8)))
        yield _packed(list(sums(current, held)))

    def sums(bucket, held):
        for size, parts in held.items():
            hashes, counts, since = (np.concatenate(column) for column in zip(*parts))
            order = np.argsort(hashes)
            hashes = hashes[order]
            first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            # A count past the threshold need not be exact here.
            total = np.add.reduceat(np.minimum(counts, threshold)[order], first, dtype=np.uint64)
            since, hashes = np.minimum.reduceat(since[order], first), hashes[first]
            done = total >= threshold
            # What was counted in every shard needs no count any more.
            more = ~done & (since.astype(np.int16) + shards > step + 1)
            for reached, chosen in ((True, done), (False, more)):
                if chosen.any():
                    yield (bucket, size, reached, hashes[chosen],
                           np.minimum(total[chosen], threshold).astype(np.uint32), since[chosen])

    return map_arrow(spread(packed, "bucket").sortWithinPartitions("bucket"), add, PACKED)


def exact_counts(texts: DataFrame, table, longest_table, longest: int, chunk: int) -> DataFrame:
    """``lang, size, phrase, n`` of all noted phrases, by their words; the number of words has size 0."""
    def count(batches: Iterator[pa.RecordBatch]):
        held.clear()
        for lang, blob, again in _gathered(batches, longest - 1, chunk):
            words = Words(blob, again)
            each, spelt = words.hashes(lang), pa.array(words.words, pa.binary())
            size = max(1, len(words.words))
            chosen = words.counted(1)
            yield from rows(lang, pa.array([b""]), 0, np.array([chosen.sum()]))
            hashes, names, begins = each[words.codes], spelt, words.codes
            for length in range(1, longest + 1):
                if len(words.codes) < length:
                    break
                steps = (longest_table if length == longest else table).value
                if length > 1:
                    last = words.codes[length - 1:]
                    hashes = mixed(hashes[:-1], each[last])
                    begins = begins[:len(last)]
                    # Phrases by the numbers of their beginning, which is noted as well, and of their last word.
                    at = np.flatnonzero(words.inside(length) & (begins >= 0) & (noted(steps, hashes) != NEVER))
                    keys, numbers = np.unique(begins[at] * size + last[at], return_inverse=True)
                    names = pc.binary_join_element_wise(
                        names.take(pa.array(keys // size)), spelt.take(pa.array(keys % size)), pa.scalar(b" "))
                else:
                    at = np.flatnonzero((noted(steps, each) != NEVER)[words.codes])
                    numbers = words.codes[at]
                begins = np.full(len(hashes), -1)
                begins[at] = numbers
                counted = begins[words.counted(length)]
                found, counts = np.unique(counted[counted >= 0], return_counts=True)
                yield from rows(lang, names.take(pa.array(found)), length, counts)
        yield from added()

    # By language and size, what some batches of a task have of each phrase.
    held: dict[tuple[str, int], list[pa.Table]] = {}

    def rows(lang: str, names: pa.Array, size: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        held.setdefault((lang, size), []).append(
            pa.table({"phrase": names.cast(pa.string()), "n": pa.array(counts.astype(np.int64))}))
        if sum(part.num_rows for parts in held.values() for part in parts) > TOGETHER:
            yield from added()

    def added() -> Iterator[pa.RecordBatch]:
        for (lang, size), parts in held.items():
            whole = pa.concat_tables(parts)
            if len(parts) > 1:
                whole = whole.group_by("phrase").aggregate([("n", "sum")]).rename_columns(["phrase", "n"])
            count = whole.num_rows
            yield from pa.table({
                "lang": pa.array([lang] * count, pa.string()), "size": pa.array(np.full(count, size, np.int32)),
                "phrase": whole["phrase"], "n": whole["n"]}).combine_chunks().to_batches()
        held.clear()

    # A task has added up its own, so rows are not combined once more before the shuffle.
    found = map_arrow(texts, count, "lang string, size int, phrase string, n bigint").repartition(
        "lang", "size", "phrase")
    return found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, longest: int = LONGEST,
    shards: int = SHARDS, slots: int = SLOTS, chunk: int = CHUNK,
) -> DataFrame:
    """``lang, size, phrase, n``: phrases of up to ``longest`` words that occur ``threshold`` times or more.

    The row of size 0 has the number of all words of the language.
    """
    if slots & (slots - 1) or shards * longest >= NEVER:
        raise ValueError("slots must be a power of two, and a step must fit a byte")
    spark = docs.sparkSession
    chosen = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    folder = scratch_folder(spark, "shards")
    chosen.withColumn("shard", F.pmod(F.xxhash64("lang", "text"), F.lit(shards))).write.partitionBy(
        "shard").parquet(folder)
    whole = spark.read.schema("lang string, text string, shard int").parquet(folder)
    table = np.full(slots, NEVER, np.uint8)
    longest_table = np.full(slots, NEVER, np.uint8)
    counts, path, newest, step = None, None, 0, 0
    size = whole.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    buckets = max(1, -(-size // RANGE))
    while step < shards or step < newest + shards:
        sent = spark.sparkContext.broadcast(table)
        found = scan(
            whole.where(F.col("shard") == step % shards), sent, step, shards, longest, chunk, buckets)
        both = found if counts is None else found.unionByName(counts)
        now = scratch_folder(spark, "phrase-counts")
        added_up(both, threshold, shards, step).write.parquet(now)
        sent.destroy()
        if path:
            removed(spark, path)
        held, path = spark.read.schema(PACKED).parquet(now), now
        fresh = _note(held.where("reached").withColumn("longest", F.col("size") == longest),
                      {False: table, True: longest_table}, step + 1)
        if False in fresh:
            newest = step + 1
        # What is noted needs no count any more.
        counts = held.where("not reached")
        step += 1
    if path:
        removed(spark, path)
    context = spark.sparkContext
    exact = written(
        exact_counts(whole, context.broadcast(table), context.broadcast(longest_table), longest, chunk), "phrases")
    removed(spark, folder)
    return exact.where((F.col("size") == 0) | (F.col("n") >= threshold))


def _note(reached: DataFrame, tables: dict[bool, np.ndarray], step: int) -> set[bool]:
    """Sets the free slots of the hashes ``reached`` to ``step``, in the table that ``longest`` names.

    Returns which tables had any. The slots come as bitmaps, at most one bit per slot of a table.
    """
    slots = len(tables[False])

    def mark(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for longest, packed in zip(batch.column("longest").to_pylist(), batch.column("hashes").to_pylist()):
                found = np.unique(np.concatenate(slots_of(np.frombuffer(packed, np.uint64), slots)))
                blocks = found // BLOCK_BITS
                starts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
                bits = []
                for part in np.split(found, starts[1:]):
                    held = np.zeros(BLOCK_BITS, bool)
                    held[part % BLOCK_BITS] = True
                    bits.append(np.packbits(held, bitorder="little").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([longest] * len(starts), pa.bool_()), pa.array(blocks[starts].astype(np.int64)),
                     pa.array(bits, pa.binary())], names=["longest", "block", "bits"])

    bits = map_arrow(
        reached.select("longest", "hashes"), mark, "longest boolean, block bigint, bits binary").groupBy(
        "longest", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    new = set()
    # In one job: an iterator makes one for each partition, however few bits it has.
    for row in bits.collect():
        first = row["block"] * BLOCK_BITS
        marked = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")
        part = tables[row["longest"]][first:first + BLOCK_BITS]
        fresh = (marked[:len(part)] == 1) & (part == NEVER)
        part[fresh] = step
        if fresh.any():
            new.add(row["longest"])
    return new


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, longest: int = LONGEST,
    percent: int = 50, shards: int = SHARDS, slots: int = SLOTS, chunk: int = CHUNK,
) -> DataFrame:
    """``lang, phrase, size, a, l, r, n, score``: phrases of two words or more that are no mere part of a longer one.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` all words;
    the score is ``1000000 * a * a / (l * r)``, rounded down. A phrase goes if a longer
    one that holds it has ``percent`` of its occurrences or more.
    """
    counts = phrase_counts(docs, text, lang, threshold, longest, shards, slots, chunk)
    words = F.split("phrase", " ")
    phrases = written(
        counts.where("size >= 2").select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("words")),
        "candidates")

    def part(first: Column, count: Column) -> Column:
        return F.array_join(F.slice("words", first, count), " ")

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
        F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    # A word may begin or end very many phrases: its count is repeated for each salt.
    parts = written(counts.where(F.col("size").between(1, longest - 1)).select(
        "lang", "phrase", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")), "parts")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(
            parts.select("lang", "salt", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", "salt", side])
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    score = F.call_function(
        "div", F.lit(1_000_000).cast("decimal(7,0)") * (exact["a"] * exact["a"]), exact["l"] * exact["r"])
    weakest = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min_by(F.struct("size", "a", "l", "r", "score"), F.struct("score", "k")).alias("cut")).select(
        "lang", "phrase", "cut.*")
    holders = phrases.where("size >= 3").withColumn(
        "taken", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn(
        "at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("taken") + 1))).groupBy(
        "lang", part(F.col("at"), F.col("taken")).alias("phrase")).agg(F.max("a").alias("_longer"))
    whole = counts.where("size = 0").select("lang", F.col("n"))
    kept = weakest.join(holders, ["lang", "phrase"], "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < percent * F.col("a")))
    return kept.join(whole, "lang").select("lang", "phrase", "size", "a", "l", "r", "n", "score")


def best_collocations(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each language by score, count and phrase, with their ``rank``.

    Each language is ranked in ``SALTS`` parts first, so the last window has ``SALTS``
    times ``most`` rows of a language at most, however many there are.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part, whole = (Window.partitionBy(*by).orderBy(*order) for by in (("lang", "_salt"), ("lang",)))
    first = salted.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= most)
    return first.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= most).drop("_salt")
