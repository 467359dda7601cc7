"""The trie against brute force, list ranking against a walk, running sums against numpy."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.llm import conversation_trie as trie
from tillflow.llm import ordering
from tillflow.llm.conversation_trie import conversation_trie, list_ranks



def built(df, **options):
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    return conversation_trie(df, head, F.expr("conv_id - conv_id % 5"), **options)


def digest(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(b"%d:" % len(role) + role + text).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            whole = digest(role, text)
            own[conv].append(((turn is not None, turn or 0, int(whole[:15], 16), int(whole[15:30], 16)),
                              (role or "", text or "")))
    turns = {c: [t for _, t in sorted(found)] for c, found in own.items()}
    paths = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        paths[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, found in members.items():
        own_saved = (len(found) - 1) * len(node[-1][1].encode()) if node else 0
        leaf = not kids[node] if node in kids else 1
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += int(leaf)
            saved[node[:depth]] += own_saved
    return sorted((
        min(found), len(node), min(members[node[:-1]]) if node else None, len(found), kids.get(node, 0),
        leaves[node], saved[node],
        hashlib.sha256(",".join(map(str, sorted(c for c in found if paths[c] == node))).encode()).hexdigest(),
    ) for node, found in members.items())


def found(df):
    return sorted(tuple(row) for row in df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ).collect())


def frame(spark, rows):
    """With extra columns whose names the operator uses itself."""
    return spark.createDataFrame(
        [(*row, 1, 2, "x") for row in rows],
        "conv_id long, turn long, role string, text string, depth int, node int, k1 string")


@pytest.mark.parametrize("seed, small", [(1, 10), (2, 100_000)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, small):
    monkeypatch.setattr(ordering, "BLOCK", 16)
    monkeypatch.setattr(trie, "CHILDREN", 3)
    monkeypatch.setattr(trie, "ENDS", 2)
    rng, rows = random.Random(seed), []
    for conv in [*range(-6, 60), 10**15]:
        for turn in range(rng.choice([1, 2, 3, 12])):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None])))
    rows += [(70, None, "user", "a"), (70, 1, "user", "b"), (70, 1, "user", "b"), (70, 1, "user", "a")]
    rows += [(None, 1, "user", "a"), (None, None, None, None)]
    # One conversation of many equal rows, one of many turns.
    rows += [(72, 3, "user", "again")] * 25 + [(73, n, "user", str(n)) for n in range(40)]
    rng.shuffle(rows)
    assert found(built(frame(spark, rows), small=small)) == brute(rows)


def test_trie_of_little(spark):
    assert found(built(frame(spark, []))) == []
    assert found(built(frame(spark, [(None, 1, "user", "a")]))) == []
    # A head is taken from a conversation that is not there: no turns are left.
    lone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    rows = [(lone, 0, "user", "hello")]
    assert found(built(frame(spark, rows))) == brute(rows)
    assert len(brute(rows)) == 1


def test_list_ranks_by_random_mates(spark):
    names = list(range(500))
    random.Random(4).shuffle(names)
    arcs = spark.createDataFrame(list(zip(names, [*names[1:], None])), "arc long, next long")
    for small in (1, 40, 1_000):
        ranks = dict(tuple(r) for r in list_ranks(arcs, small).collect())
        assert ranks == {name: rank for rank, name in enumerate(names)}


def test_numbers_and_running_sums(spark, monkeypatch):
    values = np.random.default_rng(5).integers(0, 9, 700)
    df = spark.createDataFrame([(int(v), n) for n, v in enumerate(values)], "v long, tie long")
    rows = ordering.numbered(df, ["v", "tie"], "row").collect()
    assert [r.row for r in sorted(rows, key=lambda r: (r.v, r.tie))] == list(range(700))
    assert ordering.numbered(df.where("v > 99"), ["v", "tie"]).count() == 0
    sums = ordering.running_sums(df.withColumn("s", F.col("v")), "tie", ["s"], 700, block=6).collect()
    assert [r.s for r in sorted(sums, key=lambda r: r.tie)] == np.cumsum(values).tolist()
