"""Token files, tokens, decontamination, secrets and search against the library or brute force."""

import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillflow.llm import batch_encoding
from tillflow.llm.batch_encoding import BatchEncoder
from tillflow.llm.bpe import automaton, encode_documents
from tillflow.llm.decontaminate import decontaminate, match_items, words_of
from tillflow.llm.secret_scan import ASSIGN, redact_live, secret_spans
from tillflow.llm.tables import scratch_folder
from tillflow.llm.token_files import (
    BLOCK_IDS, decode_segment, encode_segment, places, read_token_files, write_token_files,
)
from tillflow.llm.topk import FIRST, best_first, top_k

FILE = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "", "  ", "Hello, World's <|endoftext|>x <|startoftext|> été 123", "aaaaaaa aaaa !!!! ''s 'll we'll",
    "’s İstanbul ΑΣ ες é K Å ŁÐÞßŒ ŉ ǅ ſ", "日本語テキスト 👍👍🏽 _a_b__ ½ ²³ ª º µ ​zero",
    "a\tb\x0bc\x0cd\re\x1cf\x85g h", "x" * 500, "ab" * 300 + "'re" * 20, "<|endoftext|>" * 3, "nul\x00l",
]


def docs(spark, texts, ids=None):
    """With extra columns whose names the operators use themselves."""
    rows = [(i if ids is None else ids[n], t, f"s{n % 3}", "en", 0.5, "m") for n, (i, t) in enumerate(enumerate(texts))]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, lang string, _score double, _match string")


def test_automaton_equals_the_library():
    library, encoder = Tokenizer.from_file(FILE), automaton(FILE)
    rng = random.Random(1)
    texts = HARD + ["".join(rng.choice("abcdefghst 'lré!0\n<|") for _ in range(rng.randint(0, 80)))
                    for _ in range(500)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text.encode()) == struct.pack(f"<{len(ids)}I", *ids), text


@pytest.mark.parametrize("window", [40, 8_000_000])
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_batches_encode_as_the_library_does(monkeypatch, name, window):
    monkeypatch.setattr(batch_encoding, "WINDOW", window)
    library, encoder = Tokenizer.from_file(public_tokenizers.path(name)), BatchEncoder(public_tokenizers.path(name))
    rng = random.Random(2)
    texts = [*HARD, None, "don't A'Σ", " lead", "trail \n\n "] + [
        "".join(rng.choice("abcST 't  ,.\n\t!0é<|àΣ' \u0301-\u00a0") for _ in range(rng.randint(0, 80)))
        for _ in range(1500)]
    for first in range(0, len(texts), 250):
        part = texts[first:first + 250]
        ids, counts = encoder.encode(pa.array(part, pa.string()))
        expected = [library.encode(text or "", add_special_tokens=False).ids for text in part]
        assert counts.tolist() == [len(each) for each in expected]
        assert ids.tolist() == [id for each in expected for id in each]
    assert [x.tolist() for x in encoder.encode(pa.array([], pa.string()))] == [[], []]
    assert encoder.encode(pa.array([None, ""], pa.string()))[1].tolist() == [0, 0]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_only_other_pieces_than_words_are_normalised_and_split(monkeypatch, name):
    file = str(public_tokenizers.path(name))
    texts = ["the cat hewhonon", "  two  blanks", "don't I'LL 12ab34", "xTHEy\tThe\nend", "é ñandú K ſt aſt", "<|endoftext|> the", "the", " ", ""]
    encoder, asked = BatchEncoder(file), []
    whole = encoder._whole
    monkeypatch.setattr(encoder, "_whole", lambda pieces: asked.extend(pieces) or whole(pieces))
    ids, counts = encoder.encode(pa.array(texts))
    found = np.split(ids, np.cumsum(counts)[:-1])
    assert [x.tolist() for x in found] == [
        encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert asked and not [piece for piece in asked if piece.strip(" ").isascii() and piece.removeprefix(" ").isalpha()]


def test_ids_are_placed_by_table_and_by_search():
    rng = np.random.default_rng(1)
    for ids in (rng.integers(0, 50_000, 3_000), rng.integers(0, 2**32, 3_000), np.array([2**32 - 1]), np.array([0, 0])):
        ids = ids.astype(np.uint32)
        symbols = np.unique(ids)
        assert (symbols[places(symbols, ids)] == ids).all()
        assert (decode_segment(encode_segment(ids)) == ids).all()


def test_encoded_documents_decode_as_the_library_does(spark):
    library = Tokenizer.from_file(FILE)
    texts = [*HARD, None, HARD[2]]
    found = encode_documents(docs(spark, texts), FILE).collect()
    for row in found:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert bytes(row._ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert row._decoded == library.decode(ids, skip_special_tokens=False)
    assert len(found) == len(texts)
    assert encode_documents(docs(spark, []), FILE).count() == 0


def test_token_files_return_what_was_written(spark):
    library = Tokenizer.from_file(FILE)
    texts = [*HARD, None, "long text " * 30_000, HARD[2]]
    ids = [None, *range(50, 50 + len(texts) - 2), 50]
    path = scratch_folder(spark, "test-tokens")
    write_token_files(docs(spark, texts, ids), path, FILE)
    expected = Counter()
    for doc, text in zip(ids, texts):
        tokens = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        expected[doc, len(tokens), zlib.crc32(struct.pack(f"<{len(tokens)}I", *tokens))] += 1
    found = read_token_files(spark, path, zlib.crc32).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.digest) for r in found) == expected
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    order = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert order == sorted(order)

    empty = scratch_folder(spark, "test-no-tokens")
    write_token_files(docs(spark, []), empty, FILE)
    assert read_token_files(spark, empty).count() == 0


def test_segments_decode_whole_and_by_block_and_show_damage():
    rng = np.random.default_rng(2)
    for size in (1, 2, 100, BLOCK_IDS, BLOCK_IDS + 1, 3 * BLOCK_IDS + 77):
        ids = (rng.zipf(1.3, size) % 49_408).astype("<u4")
        coded = encode_segment(ids)
        assert (decode_segment(coded) == ids).all()
        blocks, step = len(coded["checksums"]), coded["lane_steps"] * 64
        for block in range(blocks):
            part = decode_segment(coded, block, block + 1)
            assert (part == ids[block * step:(block + 1) * step]).all()
    assert len(coded["words"]) < 0.6 * ids.nbytes
    words = bytearray(coded["words"])
    words[len(words) // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        decode_segment({**coded, "words": bytes(words)})


def test_one_distinct_id():
    ids = np.full(1000, 7, "<u4")
    assert (decode_segment(encode_segment(ids)) == ids).all()


def occurring(text, items, window):
    """Hit words and items of a text, by looking up every run of words."""
    runs = defaultdict(set)
    for item, body in items:
        words = words_of((body or "").encode())
        width = min(window, len(words))
        for i in range(len(words) - width + 1 if words else 0):
            runs[tuple(words[i:i + width])].add(str(item) if item is not None else "null")
    words = words_of((text or "").encode())
    hit, found = [False] * len(words), set()
    for width in {len(r) for r in runs}:
        for i in range(len(words) - width + 1):
            if owners := runs.get(tuple(words[i:i + width])):
                hit[i:i + width] = [True] * width
                found |= owners
    return len(words), hit, sorted(found)


@pytest.mark.parametrize("shard_words", [200_000, 7])
def test_match_items_equals_brute_force(spark, shard_words):
    rng = random.Random(3)
    words = lambda n: " ".join(rng.choice("abcABC") + rng.choice("xyß") for _ in range(n))
    items = [(i, words(rng.randint(0, 14))) for i in range(12)] + [(3, words(9)), (None, words(7)), (20, None)]
    texts = [words(rng.randint(0, 200)) for _ in range(30)] + [None, "", items[0][1], (words(3) + "-") * 2000]
    texts += [f"{words(5)}, {items[k][1]}. {words(5)}" for k in range(12)]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = match_items(docs(spark, texts), table, window=5, shard_words=shard_words).collect()
    assert len(found) == len(texts)
    for row in found:
        size, hit, owners = occurring(row.text, items, 5)
        marked = [False] * size
        for s in row._match.spans:
            marked[s.start:s.end] = [True] * (s.end - s.start)
        assert (row._match.words, marked, row._match["items"]) == (size, hit, owners)


def test_decontaminate_cuts_spans_and_drops_covered_texts(spark):
    passage = "Alpha, beta gamma-delta epsilon; zeta eta theta iota kappa!"
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    texts = ["one two " * 10 + passage + " three", passage, None, "", "clean  text,\nas it was "]
    kept = {r.doc_id: r.text for r in decontaminate(docs(spark, texts), items).collect()}
    assert kept == {0: "one two " * 10 + "! three", 2: None, 3: "", 4: texts[4]}
    assert decontaminate(docs(spark, []), items).count() == 0
    none = decontaminate(docs(spark, texts), items.limit(0))
    assert {r.doc_id: r.text for r in none.collect()} == dict(enumerate(texts))


BASE = {"assign": re.compile(ASSIGN), "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def base_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            least, value = {"assign": (6, m[2] if number == 0 else ""), "access": (20, m[0]), "hex": (24, m[0])}[kind]
            if len(value) >= least:
                out.append((m.start(), number, kind, m.end()))
    return sorted(out)


def test_secret_spans_equal_brute_force(spark):
    rng = random.Random(4)
    parts = ["token", "Secret", "api_key", "APIKEY", " = ", ":", '"', "'", " ", "AKIA", "ABCD1234", "0123456789abcdef",
             "abcdef", "é😀", "x", "=", "password", "passwd", "/+", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "AKIA" + "A" * 16, "secret=token: abcdefgh", "f" * 24, "token=" + "a" * 10_000]
    found = secret_spans(docs(spark, texts)).collect()
    expected = Counter((i, tuple(base_spans(t))) for i, t in enumerate(texts))
    assert Counter((r.doc_id, tuple(
        (s.start, s.kind_no, s.kind, s.end) for s in r.spans if s.kind != "bare")) for r in found) == expected
    assert secret_spans(docs(spark, [])).count() == 0


def test_copied_examples_stay_and_live_secrets_go(spark):
    own, copied, bare = "password = hunter2hunter2", "token: EXAMPLEKEY00", "Zq9" * 8
    texts = [f"é {own} end", *[f"{n} {copied}" for n in range(6)], f"see {bare} there", None, f"é {own} end"]
    table = docs(spark, texts).withColumn("source", F.concat(F.lit("owner"), F.col("doc_id")))
    kept = sorted((r.doc_id, r.text) for r in redact_live(table, widely=5).collect())
    assert kept[0] == (0, "é password = [SECRET] end") and kept[9] == (9, kept[0][1])
    assert [t for _, t in kept[1:7]] == texts[1:7]
    assert kept[7] == (7, "see [SECRET] there") and kept[8] == (8, None)
    spans = {r.doc_id: r.spans for r in secret_spans(table, widely=5).collect()}
    assert [s.live for s in spans[1]] == [False] and spans[1][0].owners == 6
    assert [s.kind for s in spans[7]] == ["bare"]


def test_candidates_are_evaluated_in_the_order_of_their_limits():
    rng = np.random.default_rng(6)
    scores = rng.permutation(4_000)
    limits = scores + rng.uniform(0, 300, len(scores))
    threshold = np.sort(scores)[-5]
    # What no stride may touch after the stop has a score that would win.
    hidden = np.argsort(-limits)[8 * FIRST:]
    assert (limits[hidden] < threshold).all() and len(hidden) > 1_000
    values = scores.astype(np.float64)[:, None]
    values[hidden] = 1e9
    names, found = best_first(np.arange(4_000), values, limits, np.ones(1), 5)
    assert found.tolist() == [3999, 3998, 3997, 3996, 3995]
    assert scores[names].tolist() == found.tolist()
    ties = best_first(np.arange(4_000)[::-1].copy(), np.ones((4_000, 1)), np.ones(4_000), np.ones(1), 3)
    assert ties[0].tolist() == [0, 1, 2]


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-9, 9, 6)], "x") for i in range(150)]
    rows += [(200 + i, rows[7][1], "copies") for i in range(30)]
    rows += [(300, None, ""), (305, [1.0, None], ""), (310, [float("nan")] * 6, ""), (315, [float("inf")] * 6, ""),
             (None, [1.0] * 6, ""), (10, rows[10][1], "again"), (400, [], ""), (401, [5.0], "short")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    known = {i: np.array([*v, *[0.0] * (6 - len(v))]) for i, v, _ in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    expected = set()
    for query in (i for i in known if i % 5 == 0):
        scores = sorted((-int(known[query] @ known[i]), i) for i in known if i != query)[:7]
        expected |= {(query, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)}
    for sizes in ({}, {"candidates": 20, "queries": 8, "pivots": 3}):
        found = top_k(table, 7, F.col("vec_id") % 5 == 0, **sizes).collect()
        assert {tuple(r) for r in found} == expected and len(found) == len(expected)
    assert top_k(table.limit(0), 7, F.col("vec_id") % 5 == 0).count() == 0
