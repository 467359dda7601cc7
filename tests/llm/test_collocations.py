"""Collocations against brute force, with shards, small tables of slots and cut texts."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tillflow.llm import collocations as module
from tillflow.llm.collocations import best_collocations, chunks, collocations, phrase_counts

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def all_counts(rows, longest):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i:i + size])] += 1
    return counts, totals


def brute(rows, threshold, most, longest=3):
    out = []
    counts, totals = all_counts(rows, longest)
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def frame(spark, rows):
    """With extra columns whose names the operator uses itself."""
    return spark.createDataFrame(
        [(i, lang, text, 1, 2, "x") for i, (lang, text) in enumerate(rows)],
        "doc_id long, lang string, text string, n int, size int, phrase string").repartition(5)


def made(seed, count):
    rng, rows = random.Random(seed), []
    words = ["New", "york", "É", "the", "of", "a b", "x\x00y", "city", "İs", "hall"]
    for _ in range(count):
        parts = [rng.choice([rng.choice(words), "new york city", "Of The"]) + rng.choice([" ", " ", "\t", ", ", ".\n", "  "])
                 for _ in range(rng.randint(0, 25))]
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), "".join(parts)))
    return rows + [("en", None), (None, ""), ("fr", None), ("en", "one two"), ("en", "one two")]


@pytest.mark.parametrize("seed, shards, slots, chunk", [
    (1, 3, 1 << 16, 8_000_000), (2, 1, 1 << 16, 200), (3, 4, 1 << 15, 30)])
def test_collocations_equal_brute_force(spark, seed, shards, slots, chunk):
    rows = made(seed, 120)
    expected = brute(rows, 10, 15)
    assert len(expected) > 20
    df = collocations(frame(spark, rows), shards=shards, slots=slots, chunk=chunk)
    assert found(best_collocations(df, 15)) == expected


def test_longer_phrases_and_a_long_text(spark):
    rng = random.Random(9)
    rows = [("en", " ".join(rng.choice("abc") for _ in range(4_000))), ("en", "a b c a b " * 30), ("en", "w" * 5_000)]
    counts, totals = all_counts(rows, 4)
    held = phrase_counts(frame(spark, rows), threshold=40, longest=4, shards=2, slots=1 << 16, chunk=1_000).collect()
    assert {(r.lang, r.size, r.phrase): r.n for r in held} == {
        ("en", 0, ""): totals["en"],
        **{("en", len(p), " ".join(p)): n for p, n in counts["en"].items() if n >= 40}}


def test_collocations_of_nothing(spark):
    assert collocations(frame(spark, []), slots=1 << 15).count() == 0
    assert collocations(frame(spark, [("en", None), (None, "a b")]), slots=1 << 15).count() == 0


def test_a_task_of_a_scan_makes_a_row_for_each_range_whatever_the_languages(spark):
    """One packed row per size and range of hashes, though texts are of many languages."""
    texts = spark.createDataFrame(
        [(f"l{i}", " ".join(f"w{j}" for j in range(i, i + 400))) for i in range(20)],
        "lang string, text string").coalesce(1)
    table = spark.sparkContext.broadcast(module.np.zeros(1 << 15, module.np.uint8))
    found = module.scan(texts, table, 0, 3, 3, 8_000_000, 16).collect()
    assert len(found) == 3 * 16
    counts = sum(int(module.np.frombuffer(row["counts"], module.np.uint32).sum()) for row in found)
    assert counts == 20 * (400 + 399 + 398)


def test_ranges_of_hashes_follow_the_text_and_not_the_partitions(spark, monkeypatch):
    ranges, scan = [], module.scan
    monkeypatch.setattr(module, "scan", lambda *args: ranges.append(args[-1]) or scan(*args))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("2", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            phrase_counts(frame(spark, made(5, 30)), slots=1 << 15).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert set(ranges) == {1}


@pytest.mark.parametrize("limit", [1, 7, 40])
def test_chunks_lose_no_phrase(limit):
    rng = random.Random(limit)
    text = "".join(rng.choice("ab c. ") for _ in range(600)).encode()
    whole = module.Words(text)
    for length in (1, 2, 3):
        expected, got = Counter(), Counter()
        for held, words in [(expected, [whole])] + [(got, [module.Words(p, n) for p, n in chunks(text, 2, limit)])]:
            for part in words:
                for at in part.counted(length).nonzero()[0]:
                    held[tuple(part.words[c] for c in part.codes[at:at + length])] += 1
        assert got == expected


def test_words_are_cut_as_brute_force_cuts_them():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("abAB é.,\t\n!\x0b\x85-") for _ in range(rng.randint(0, 30)))
        words = module.Words(text.encode())
        pieces = [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(UPPER))]
        assert [words.words[c].decode() for c in words.codes] == [w for p in pieces for w in p], text
        assert words.joined.tolist() == [
            same for p in pieces for same in [False, *[True] * (len(p) - 1)][:len(p)]][1:], text


def test_noting_a_step_takes_as_many_jobs_for_any_partitions(spark):
    reached = spark.range(0, 400, 1, 4).selectExpr("id % 2 = 0 AS longest", "unhex(lpad(hex(id * 7919), 16, '0')) AS hashes")
    jobs, kept, tables = [], {k: spark.conf.get(k) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}, []
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for parts in (3, 17):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.sparkContext.setJobGroup(f"noted-{parts}", "")
            tables.append({longest: module.np.full(1 << 18, module.NEVER, "uint8") for longest in (False, True)})
            assert module._note(reached, tables[-1], 1) == {False, True}
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"noted-{parts}")))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert jobs[0] == jobs[1]
    assert all((tables[0][longest] == tables[1][longest]).all() for longest in (False, True))
