"""Substring and near-duplicate operators against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillflow.llm import anchors
from tillflow.llm import simhash as simhash_module
from tillflow.llm.components import Forest, components, whole_groups
from tillflow.llm.debruijn import drop_repeated_words
from tillflow.llm.deep_shallow import deep_shallow_order, padded
from tillflow.llm.simhash import drop_near_duplicates, near_duplicate_components
from tillflow.llm.suffix_dedup import drop_repeated_bytes

SCHEMA = "doc_id long, text string, source string, spans int, doc string, anchor string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "s", 1, "x", "y") for row in rows], SCHEMA)


def corpus(seed=3, repeated_ids=False):
    """Texts that share passages, whole copies, nulls, empty ones, a long one, one that repeats itself."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    passage = " ".join(word() for _ in range(60))
    texts = [None, "", " ", "one", "ab " * 400, passage, passage, passage + " tail"]
    for _ in range(25):
        body = [word() for _ in range(rng.randint(5, 120))]
        if rng.random() < 0.6:
            cut = rng.randint(0, 30)
            body[rng.randint(0, len(body)):0] = passage.split()[cut:cut + rng.randint(20, 60)]
        texts.append(rng.choice(["", "\n", "  "]) + " ".join(body))
    texts.append(" ".join(word() for _ in range(9000)))
    ids = list(range(len(texts)))
    if repeated_ids:
        ids[4], ids[5], ids[9] = None, None, ids[8]
        return [*zip(ids, texts), (ids[7], texts[7]), (ids[7], texts[7])]
    return list(zip(ids, texts))


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def bytes_removed(rows, window):
    """For rows with distinct ids."""
    seen, out = set(), []
    for doc, text in in_order(rows):
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for start in range(len(body) - window + 1):
            piece = body[start:start + window]
            if piece in seen:
                gone[start:start + window] = True
            seen.add(piece)
        kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((doc, len(body), int(gone.sum()), runs, kept))
    return out


@pytest.fixture(params=[False, True], ids=["", "everything hot"])
def hot(request, monkeypatch):
    """With every anchor and path taken for a hot one, too."""
    if request.param:
        for name, value in (("SAMPLE", 1), ("LEAST_HOT", 1), ("SHARES", 10**9)):
            monkeypatch.setattr(anchors, name, value)


@pytest.mark.parametrize("most", [16_384, 3])
def test_suffix_dedup_equals_brute_force(spark, most, hot):
    rows = corpus()
    result = drop_repeated_bytes(frame(spark, rows), window=40, core=12, most=most)
    found = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in result.collect())
    assert found == bytes_removed(rows, 40)
    assert all(r.kept_sha256 == hashlib.sha256(bytes(r.kept)).hexdigest() for r in result.collect())


def test_suffix_dedup_with_repeated_and_null_ids(spark):
    rows = corpus(repeated_ids=True)
    result = drop_repeated_bytes(frame(spark, rows), window=40, core=12).collect()
    assert Counter(r.doc_id for r in result) == Counter(doc for doc, _ in rows)
    # In whatever order rows of one id come, each distinct string stays once.
    whole = sum(removed for _, _, removed, _, _ in bytes_removed(list(enumerate(t for _, t in rows)), 40))
    assert sum(r.n_removed for r in result) > 0.8 * whole
    copies = sorted(r.n_removed for r in result if r.doc_id == 7)
    assert copies[1] == copies[2] == len(dict(rows)[7].encode())


def test_hot_anchor_in_parts_equals_brute_force(spark):
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdef") for _ in range(50))
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 8))) + shared + rng.choice("xyz"))
            for i in range(120)]
    result = drop_repeated_bytes(frame(spark, rows), window=40, core=12, most=10).collect()
    found = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in result)
    assert found == bytes_removed(rows, 40)


def words_removed(rows, window):
    count = Counter()
    for _, text in rows:
        words = (text or "").encode().split()
        count.update(tuple(words[i:i + window]) for i in range(len(words) - window + 1))
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if count[tuple(words[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out.append((doc, len(words), sum(gone), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("repeated_ids", [False, True])
@pytest.mark.parametrize("most", [16_384, 2])
def test_debruijn_equals_brute_force(spark, repeated_ids, most, hot):
    rows = corpus(5, repeated_ids)
    result = drop_repeated_words(frame(spark, rows), window=12, core=4, most=most)
    found = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in result.collect()]
    assert sorted(found, key=repr) == words_removed(rows, 12)


def test_substring_dedup_of_nothing(spark):
    assert drop_repeated_bytes(frame(spark, [])).count() == 0
    assert drop_repeated_words(frame(spark, [])).count() == 0


def simhash(text, words=3):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [parts] if len(parts) < words else [parts[i:i + words] for i in range(len(parts) - words + 1)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("tile", [4_096, 3])
def test_simhash_components_equal_brute_force(spark, tile):
    rng = random.Random(2)
    rows = corpus(7)
    for i in range(120):
        base = (rng.choice(rows)[1] or "").split()
        if base:
            base[rng.randrange(len(base))] = "changed"
        rows.append((1000 + i, " ".join(base)))
    prints = np.array([simhash(t) for _, t in rows], np.uint64)
    forest = Forest(len(rows))
    left, right = np.nonzero(np.bitwise_count(prints[:, None] ^ prints) <= 2)
    forest.join(left, right)
    least = {}
    for (doc, _), label in zip(rows, forest.label):
        least[label] = min(doc, least.get(label, doc))
    expected = {doc: (int(p), least[label]) for (doc, _), p, label in zip(rows, prints, forest.label)}
    found = near_duplicate_components(frame(spark, rows), tile=tile).collect()
    assert {r.doc_id: (r.fingerprint % 2**64, r.component_id) for r in found} == expected
    assert len(found) == len(rows) and len(set(least.values())) < len(rows)


def test_near_duplicates_leave_one_of_each_group(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(150, 300))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)]
    for i, text in enumerate(texts[:20]):
        words = text.split()
        words[rng.randrange(len(words))] = "other"
        rows += [(100 + i, text), (200 + i, " ".join(words))]
    rows += [(300, None), (301, ""), (None, texts[0]), (0, texts[0]), (5, texts[7]), (None, "alone it is")]
    prints = np.array([simhash(t) for _, t in rows], np.uint64)
    forest = Forest(len(rows))
    forest.join(*np.nonzero(np.bitwise_count(prints[:, None] ^ prints) <= 2))
    expected = []
    for label in set(forest.label.tolist()):
        ids = [rows[i][0] for i in np.flatnonzero(forest.label == label)]
        expected.append(min((i for i in ids if i is not None), default=None))
    clashing = frame(spark, rows).withColumns({n: F.lit(1) for n in ("_id", "_key", "_kept_id", "component_id")})
    for tile in (4_096, 5):
        kept = drop_near_duplicates(clashing, tile=tile)
        assert kept.columns == clashing.columns
        assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, expected))
    assert drop_near_duplicates(frame(spark, [])).count() == 0
    assert near_duplicate_components(frame(spark, [])).count() == 0


def test_null_ids_in_components(spark):
    found = near_duplicate_components(frame(spark, [(None, "a b c"), (4, "a b c"), (None, "x"), (None, "x")])).collect()
    assert sorted(repr((r.doc_id, r.component_id)) for r in found) == [
        "(4, 4)", "(None, 4)", "(None, None)", "(None, None)"]


def test_fingerprint_of_many_shingles(monkeypatch):
    hashes = np.random.default_rng(3).integers(0, 2**63, 5_000, np.uint64)
    whole = simhash_module.fingerprint(hashes)
    monkeypatch.setattr(simhash_module, "BLOCK", 7)
    assert simhash_module.fingerprint(hashes) == whole


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_deep_shallow_order_equals_sorting():
    rng = random.Random(5)
    for _ in range(100):
        bases = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(0, 60))) for _ in range(3)]
        strings = []
        for _ in range(rng.randint(1, 40)):
            text = bytearray(rng.choice(bases))
            if text and rng.random() < 0.7:
                text[rng.randrange(len(text))] = rng.choice(b"abc")
            strings.append(bytes(text))
        group = np.sort([rng.randint(0, 2) for _ in strings])
        order, shared = deep_shallow_order(strings, group)
        full = [row.tobytes() for row in padded(strings)]
        keys = [(group[i], full[i]) for i in order]
        assert keys == sorted(keys)
        for k, ((g, s), (h, t)) in enumerate(zip(keys, keys[1:]), 1):
            common = next((n for n in range(len(s)) if s[n] != t[n]), len(s)) if g == h else -1
            assert shared[k] == common


def test_whole_groups_of_any_batches():
    import pyarrow as pa

    rng = random.Random(6)
    for _ in range(300):
        keys = sorted(rng.randint(0, 4) for _ in range(rng.randint(0, 25)))
        cuts = sorted(rng.randint(0, len(keys)) for _ in range(4))
        parts = [keys[a:b] for a, b in zip([0, *cuts], [*cuts, len(keys)])]
        batches = [pa.RecordBatch.from_pydict({"k": pa.array(p, pa.int64())}) for p in parts]
        groups, rows = [], []
        for table, bounds in whole_groups(iter(batches), ["k"]):
            values = table["k"].to_pylist()
            rows += values
            for a, b in zip(bounds[:-1], bounds[1:]):
                assert len(set(values[a:b])) == 1
                groups.append(values[a])
        assert rows == keys and groups == sorted(set(keys))
