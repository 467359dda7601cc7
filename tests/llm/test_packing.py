"""Packing against the library's ids, and the places of all pieces."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillflow.llm.packing import BestFit, pack_documents
from tillflow.llm.queries import op12_packing

FILE = public_tokenizers.path("byte_bpe_50k.json")


def plain_best_fit(sizes, length, most):
    """The same rule with lists: least free space that fits; a full house closes its fullest."""
    open, places, opened = [], [], 0
    for size in sizes:
        fitting = [o for o in open if o[1] >= size]
        if fitting:
            best = min(fitting, key=lambda o: o[1])
        else:
            if len(open) >= most and size < length:
                open.remove(min(open, key=lambda o: o[1]))
            best = [opened, length]
            opened += 1
            open.append(best)
        places.append((length - best[1], best[1]))
        best[1] -= size
        if best[1] == 0:
            open.remove(best)
    return places, opened


@pytest.mark.parametrize("most", [1, 3, 50])
def test_best_fit_equals_a_plain_search(most):
    rng = random.Random(most)
    sizes = [rng.choice([rng.randint(1, 20), rng.randint(1, 5), 20]) for _ in range(2000)]
    fit, ends, fill = BestFit(20, most), [], defaultdict(int)
    for size in sizes:
        sequence, offset = fit.place(size)
        assert fill[sequence] == offset and offset + size <= 20
        fill[sequence] += size
        ends.append((offset, 20 - offset))
    assert (ends, fit.opened) == plain_best_fit(sizes, 20, most)
    counts = Counter()
    for found in fit.by_space:
        counts.update(found)
    assert sum(counts.values()) <= most
    chosen = fit.emptiest({s: 2 for s in counts}, 4)
    assert [fill[s] for s in chosen] == sorted(fill[s] for s in counts)[:2]


def check(rows, length):
    """Sequences without gaps, documents whole."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for row in rows:
        assert 1 <= row.length <= length
        sequences[row.sequence_id].append((row.offset, row.length))
        documents[row.doc_id].append(row)
    for places in sequences.values():
        end = 0
        for offset, size in sorted(places):
            assert offset == end
            end += size
        assert end <= length
    for pieces in documents.values():
        pieces.sort(key=lambda p: p.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert [p.start for p in pieces] == np.cumsum([0, *(p.length for p in pieces[:-1])]).tolist()
        assert all(p.length == length for p in pieces[1:])
    return len(sequences)


@pytest.mark.parametrize("length, most, group", [(16, 2, 16), (16, 8, 64), (64, 4, 100), (64, 50, 1000)])
def test_packing_places_every_id(spark, length, most, group):
    library, rng = Tokenizer.from_file(FILE), random.Random(length + most)
    texts = [None, "", "  ", "a <|endoftext|> b", "one word"] + [
        " ".join(rng.choice(["the", "quick", "brún", "fox,", "\n\nx"]) for _ in range(rng.randint(0, 120)))
        for _ in range(300)]
    docs = spark.createDataFrame(
        [(i, t, "s", 1, False) for i, t in enumerate(texts)],
        "doc_id long, text string, sequence string, share int, open boolean").repartition(7)
    rows = pack_documents(docs, FILE, length=length, most=most, group=group).collect()
    held = defaultdict(bytes)
    for row in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert len(row.ids) == 4 * row.length
        held[row.doc_id] += bytes(row.ids)
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert np.frombuffer(held[i], "<u4").tolist() == ids
    used = check(rows, length)
    total = sum(row.length for row in rows)
    assert used <= 1.15 * -(-total // length) + 1, (used, total / length)
    # The same rows again give the same places.
    again = pack_documents(docs, FILE, length=length, most=most, group=group)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in rows}


def test_packing_of_null_and_repeated_ids_and_of_nothing(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None), (7, "x y z"), (7, "x y z")], "doc_id long, text string")
    rows = pack_documents(docs, FILE, per_piece=zlib.crc32).collect()
    assert sorted((r.doc_id or -1, r.length) for r in rows) == [(-1, 1), (-1, 3), (7, 4), (7, 4)]
    assert len({r.sequence_id for r in rows}) == 1
    assert pack_documents(docs.where("doc_id > 9"), FILE).count() == 0


def test_op12_uses_few_sequences(spark, sf_dir):
    rows = op12_packing(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    library = Tokenizer.from_file(FILE)
    held = defaultdict(list)
    for row in rows:
        held[row.doc_id].append(row)
    for doc in docs:
        ids = np.array([*library.encode(doc.text or "", add_special_tokens=False).ids, 0], "<u4")
        for row in held[doc.doc_id]:
            assert row.ids_crc32 == zlib.crc32(ids[row.start:row.start + row.length].tobytes())
    assert check(rows, 2048) <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 1
