"""The trie of conversation prefixes, measured by the Euler-tour technique.

A node is a distinct sequence of first turns; the conversations that start with it
are its members. A turn is known by 120 bits of a SHA-256 of its role and text, and
a prefix by two sums of hashes of its turns and their places, so a prefix of any
length is a running sum, and its parent's the sum before it. Texts are hashed where
they are read and never shuffled.

Each node has an arc into it and an arc out of it. The arc into a node is followed by
the arc into its first child, or by its own arc out; an arc out by the arc into the
next sibling, or by the parent's arc out. That list of arcs is ranked by random
mates: in each round an arc whose coin shows heads takes its successor out of the
list if that one's shows tails, so about a quarter goes, until ``SMALL`` arcs are
left, which one task walks along. The rounds then are undone, each arc getting its
rank from the one that took it out. Leaves and savings stand on the arcs into nodes;
the sums up to a node's arc out less those before its arc in are its subtree's.

Nothing is dealt by conversation or parent alone: turns and siblings are numbered
over ranges of the whole table, children meet their parent in blocks of bounded
number, and the ids of a node's ends reach its digest in chunks.

Defined results: rows without ``conv_id`` take no part; a null role or text is empty;
turns of one conversation with one number stand in the order of their digests, equal
rows are turns of their own; ids below zero are rebuilt from ``c - c % 5`` with the
remainder of SQL, which keeps the sign; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.ordering import numbered, running_sums
from tillflow.llm.tables import map_arrow, spread, written

HEAD = 8
SMALL = 100_000
CHILDREN = 10_000
ENDS = 1_000
KEY = ["depth", "k1", "k2"]


def digests(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turn, m1, m2, bytes`` per turn: 60 bits each of a digest of role and text."""
    spoken, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(spoken).cast("string"), F.lit(":"), spoken, said), 256)

    def lane(first: int) -> Column:
        return F.conv(F.substring(digest, first, 15), 16, 10).cast("long")

    return conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        lane(1).alias("m1"), lane(16).alias("m2"), F.octet_length(said).cast("long").alias("bytes"))


def placed(turns: DataFrame, order: list[str], name: str) -> DataFrame:
    """``turns`` with ``name``: the turn's place in its conversation, from 1 in the order of the columns ``order``."""
    rows = numbered(turns, ["conv_id", *order], "_row")
    first = rows.groupBy("conv_id").agg(F.min("_row").alias("_first"))
    # A conversation of many turns is split, and its first row repeated for each part.
    blocks = rows.groupBy("conv_id", F.expr(f"_row div {CHILDREN}").alias("_part")).agg(F.lit(1).alias("_one"))
    starts = written(blocks.join(first, "conv_id").drop("_one"), "first-rows")
    return rows.withColumn("_part", F.expr(f"_row div {CHILDREN}")).join(starts, ["conv_id", "_part"]).withColumn(
        name, (F.col("_row") - F.col("_first") + 1).cast("long")).drop("_row", "_part", "_first")


def rebuilt(turns: DataFrame, head: Column, base: Column) -> DataFrame:
    """``conv_id, depth, m1, m2, bytes``: the first ``head`` turns of ``base``, then the own turns after the first ``head``.

    ``head`` (at most ``HEAD``) and ``base`` are expressions of ``conv_id``.
    """
    copies = turns.groupBy("conv_id", "turn", "m1", "m2", "bytes").agg(F.count("*").alias("n"))
    # Equal rows are parted in pieces of bounded number before each becomes a row.
    parts = copies.withColumn("copy", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {CHILDREN}"))))
    spaced = spread(parts, "conv_id", "turn", "m1", "m2", "copy").withColumn("copy", F.explode(F.sequence(
        F.col("copy") * CHILDREN, F.least(F.col("n"), (F.col("copy") + 1) * CHILDREN) - 1))).drop("n")
    # Null is the least in an ascending order.
    own = written(placed(spaced, ["turn", "m1", "m2", "copy"], "place"), "own-turns")
    ids = own.select("conv_id").distinct().withColumns({"_base": base, "_head": head})
    heads = own.where(F.col("place") <= HEAD).select(
        F.col("conv_id").alias("_base"), "place", "m1", "m2", "bytes")
    taken = ids.join(heads, "_base").where("place <= _head").select(
        "conv_id", F.lit(0).alias("part"), "place", "m1", "m2", "bytes")
    kept = own.where(F.col("place") > head).select("conv_id", F.lit(1).alias("part"), "place", "m1", "m2", "bytes")
    return placed(taken.unionByName(kept), ["part", "place"], "depth").select(
        "conv_id", "depth", "m1", "m2", "bytes")


def prefixes(turns: DataFrame) -> DataFrame:
    """Adds the key (``k1``, ``k2``) of the prefix that ends with each turn and that of the one before it (``p1``, ``p2``)."""
    lanes = {f"t{n}": F.xxhash64(F.lit(n), "depth", "m1", "m2").cast("decimal(38,0)") for n in (1, 2)}
    rows = numbered(turns.withColumns(lanes), ["conv_id", "depth"], "_row")
    count = rows.count()
    sums = written(running_sums(
        rows.withColumns({"s1": F.col("t1"), "s2": F.col("t2")}), "_row", ["s1", "s2"], count), "sums")
    # What lies before a conversation's first turn is taken off, per part of a long one as well.
    before = sums.where("depth = 1").select(
        "conv_id", (F.col("s1") - F.col("t1")).alias("b1"), (F.col("s2") - F.col("t2")).alias("b2"))
    part = F.expr(f"depth div {CHILDREN}")
    parts = sums.groupBy("conv_id", part.alias("_part")).agg(F.lit(1).alias("_one")).drop("_one")
    return sums.withColumn("_part", part).join(parts.join(before, "conv_id"), ["conv_id", "_part"]).select(
        "conv_id", "depth", "bytes",
        *[(F.col(f"s{n}") - F.col(f"b{n}")).alias(f"k{n}") for n in (1, 2)],
        *[(F.col(f"s{n}") - F.col(f"b{n}") - F.col(f"t{n}")).alias(f"p{n}") for n in (1, 2)])


def end_digests(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256``: the digest of each node's ids, in order and comma-joined.

    Ids are joined to chunks where ranges of them are sorted, so that a node of many
    ends is a stream of few rows to the task that digests it.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*KEY, "conv_id"]
    names = [*KEY, "first", "ids"]
    kinds = {"depth": pa.int64(), "k1": pa.string(), "k2": pa.string()}

    def chunks(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            key, held = None, []
            for *now, conv in zip(*(batch.column(n).to_pylist() for n in order)):
                if now != key or len(held) == ENDS:
                    if held:
                        for column, x in zip(columns, (*key, held[0], ",".join(map(str, held)))):
                            column.append(x)
                    key, held = now, []
                held.append(conv)
            if held:
                for column, x in zip(columns, (*key, held[0], ",".join(map(str, held)))):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds.get(n, pa.int64() if n == "first" else pa.string())) for n, c in zip(names, columns)],
                names=names)

    def digest(batches: Iterator[pa.RecordBatch]):
        key, sha = None, None
        for batch in batches:
            done: list[list] = [[] for _ in range(4)]
            for *now, ids in zip(*(batch.column(n).to_pylist() for n in (*KEY, "ids"))):
                if now == key:
                    sha.update(b"," + ids.encode())
                    continue
                if key is not None:
                    for column, x in zip(done, (*key, sha.hexdigest())):
                        column.append(x)
                key, sha = now, hashlib.sha256(ids.encode())
            yield digested(done)
        if key is not None:
            yield digested([[x] for x in (*key, sha.hexdigest())])

    def digested(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kinds.get(n, pa.string())) for n, c in zip((*KEY, "ends_sha256"), columns)],
            names=[*KEY, "ends_sha256"])

    keyed = ends.select("depth", F.col("k1").cast("string"), F.col("k2").cast("string"), "conv_id")
    ranged = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    joined = map_arrow(ranged, chunks, "depth bigint, k1 string, k2 string, first bigint, ids string")
    dealt = spread(joined, *KEY).sortWithinPartitions(*KEY, "first")
    found = map_arrow(dealt, digest, "depth bigint, k1 string, k2 string, ends_sha256 string")
    return found.withColumns({k: F.col(k).cast("decimal(38,0)") for k in ("k1", "k2")})


def list_ranks(arcs: DataFrame, small: int = SMALL) -> DataFrame:
    """``arc, rank`` for a list ``arc, next`` (the last one's is null): how many arcs come before each.

    The first arc has rank 0.
    """
    spark = arcs.sparkSession
    live = written(arcs.select("arc", "next", F.lit(1).cast("long").alias("steps")), "arcs")
    rounds = []

    def heads(arc: str, turn: int) -> Column:
        return F.xxhash64(F.lit(turn), arc).bitwiseAND(F.lit(1)) == 0

    # The first and the last arc are never taken out.
    while live.count() > max(small, 2):
        turn = len(rounds)
        # The list's end stays: it has no successor to pass on.
        taker = live.where(heads("arc", turn) | F.col("next").isNull())
        taken = live.where(~heads("arc", turn) & F.col("next").isNotNull()).select(
            F.col("arc").alias("gone"), F.col("next").alias("gone_next"), F.col("steps").alias("gone_steps"))
        met = written(taker.join(taken, F.col("next") == F.col("gone"), "full"), "random-mates")
        rounds.append(met.where("arc is not null and gone is not null").select("gone", "arc", "steps"))
        both = F.col("arc").isNotNull() & F.col("gone").isNotNull()
        live = met.select(
            F.coalesce("arc", "gone").alias("arc"),
            F.when(both | F.col("arc").isNull(), F.col("gone_next")).otherwise(F.col("next")).alias("next"),
            F.when(both, F.col("steps") + F.col("gone_steps")).otherwise(
                F.coalesce("steps", "gone_steps")).alias("steps"))

    def walk(batches: Iterator[pa.RecordBatch]):
        onward, steps = {}, {}
        for batch in batches:
            names = batch.column("arc").to_pylist()
            onward.update(zip(names, batch.column("next").to_pylist()))
            steps.update(zip(names, batch.column("steps").to_pylist()))
        first = set(onward) - set(onward.values())
        arcs, ranks, rank = [], [], 0
        at = first.pop() if first else None
        while at is not None:
            arcs.append(at)
            ranks.append(rank)
            rank += steps[at]
            at = onward[at]
        yield pa.RecordBatch.from_arrays([pa.array(arcs, pa.int64()), pa.array(ranks, pa.int64())], names=["arc", "rank"])

    ranks = map_arrow(live.coalesce(1), walk, "arc bigint, rank bigint")
    for met in reversed(rounds):
        ranks = written(ranks, "ranks")
        found = met.join(ranks, "arc").select(
            F.col("gone").alias("arc"), (F.col("rank") + F.col("steps")).alias("rank"))
        ranks = ranks.unionByName(found)
    return written(ranks, "ranks")


def conversation_trie(
    conversations: DataFrame,
    head: Column,
    base: Column,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    small: int = SMALL,
) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    ``head`` and ``base`` are expressions of a column ``conv_id``: conversation c is
    the first ``head`` turns of conversation ``base``, then its own after the first
    ``head``. Columns: ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``
    (over its subtree, each node's members but one times the bytes of its last text),
    ``ends_sha256``.
    """
    turns = written(digests(conversations, conv, turn, role, text), "turns")
    ids = written(turns.select("conv_id").distinct(), "conversations")
    if ids.isEmpty():
        # No conversation, no root.
        return ids.select(
            "conv_id", *[F.lit(0).cast("long").alias(n) for n in (
                "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.lit("").alias("ends_sha256"))
    places = written(prefixes(rebuilt(turns, head, base)), "prefixes")
    zero = F.lit(0).cast("decimal(38,0)")
    roots = ids.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"),
        zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("decimal(38,0)").alias("p1"),
        F.lit(None).cast("decimal(38,0)").alias("p2"))
    keyed = places.select(
        "conv_id", "depth", "bytes", *[F.col(c).cast("decimal(38,0)").alias(c) for c in ("k1", "k2", "p1", "p2")])
    members = roots.unionByName(keyed)
    grouped = members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.max("bytes").alias("bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    # Siblings stand next to each other, by their smallest members.
    nodes = numbered(grouped, ["depth", "p1", "p2", "conv_id"], "node")
    kids = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"), F.min("node").alias("first_child"))
    family = written(nodes.join(kids, KEY, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "nodes")
    # A parent meets its children in blocks of their numbers.
    parents = family.where("n_children > 0").select(
        F.explode(F.sequence(
            F.expr(f"first_child div {CHILDREN}"), F.expr(f"(first_child + n_children - 1) div {CHILDREN}"))
        ).alias("_block"),
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"), F.col("node").alias("parent"),
        (F.col("first_child") + F.col("n_children") - 1).alias("last_child"))
    placed_nodes = written(
        family.withColumn("_block", F.expr(f"node div {CHILDREN}")).join(
            parents, ["_block", "depth", "p1", "p2"], "left").drop("_block"), "family")
    arcs = placed_nodes.select(F.explode(F.array(
        F.struct(
            (2 * F.col("node")).alias("arc"),
            F.coalesce(2 * F.col("first_child"), 2 * F.col("node") + 1).alias("next")),
        F.struct(
            (2 * F.col("node") + 1).alias("arc"),
            F.when(F.col("node") < F.col("last_child"), 2 * F.col("node") + 2)
            .otherwise(2 * F.col("parent") + 1).alias("next")),
    )).alias("a")).select("a.*")
    ranks = list_ranks(arcs, small)
    count = placed_nodes.count()
    weights = placed_nodes.select(
        "node", (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    into = (F.col("arc") % 2 == 0).cast("long")
    weighed = written(
        ranks.withColumn("node", F.expr("arc div 2")).join(weights, "node").select(
            "rank", "node", into.alias("into"), (F.col("leaf") * into).alias("leaves"),
            (F.col("saved") * into).alias("savings")), "weights")
    own = weighed.select("rank", "node", "into", F.col("leaves").alias("leaf"), F.col("savings").alias("saved"),
                         "leaves", "savings")
    sums = running_sums(own, "rank", ["leaves", "savings"], 2 * count)

    def below(total: str, one: str) -> Column:
        """Up to the arc out, less what comes before the arc in."""
        return F.sum(F.when(F.col("into") == 1, F.col(one) - F.col(total)).otherwise(F.col(total))).cast("long")

    subtrees = sums.groupBy("node").agg(
        below("leaves", "leaf").alias("n_leaves"), below("savings", "saved").alias("saved_tokens"))
    last = places.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    ends = ids.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))
    ended = members.join(ends, ["conv_id", "depth"]).select(*KEY, "conv_id")
    empty = hashlib.sha256(b"").hexdigest()
    return placed_nodes.join(subtrees, "node").join(end_digests(ended), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
