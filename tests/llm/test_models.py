"""Classifiers by held-out accuracy on planted texts, and the pipeline by its stages."""

import itertools
import random

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tillflow.llm.labelled import labelled_sample
from tillflow.llm.quality import fit_quality, score_quality
from tillflow.llm.simhash import shingle_hashes
from tillflow.llm.tables import scratch_folder
from tillflow.llm.toxicity import ToxicityChain, fit_toxicity, score_toxicity

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice("the of and stone river house green walks over under light".split()) + rng.choice(["", "s"])
                    for _ in range(n))


def junk(rng, n):
    return " ".join(rng.choice("BUY NOW!! $$$ ### CLICK CHEAP!! WIN>>".split()) for _ in range(n))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 7}", len(t or "")) for i, t in enumerate(texts)], COLUMNS)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(300):
        bad, toxic = i % 3 == 0, i % 5 == 1 and i % 3 != 0
        text = junk(rng, 80) if bad else prose(rng, 80)
        if toxic:
            text += " " + " ".join(rng.sample(["scum", "moron", "idiot", "trash"], rng.randint(1, 4)))
        texts.append(text)
        labels.append((i, int(not bad), int(toxic)))
    labels += [(None, 1, 0), (5, None, 1), (999, 1, 0), (7, 1, 0)]
    return frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_texts(spark, labelled):
    docs, labels = labelled
    model = fit_quality(docs, labels, F.col("doc_id") % 4 != 0)
    scores = {r.doc_id: r._score for r in score_quality(docs, model).where("doc_id % 4 = 0").collect()}
    right = [(s >= 0.5) == (i % 3 != 0) for i, s in scores.items()]
    assert np.mean(right) > 0.95
    odd = score_quality(frame(spark, [None, "", "x" * 200_000, "é"]), model).collect()
    assert all(0 <= r._score <= 1 for r in odd) and odd[0]._score == odd[1]._score


def test_quality_equals_a_plain_calculation(spark, labelled):
    docs, labels = labelled
    allowed = F.col("doc_id") % 4 != 0
    model = fit_quality(docs, labels, allowed)
    # Held-out labels are never seen: others in their place make the same model.
    other = labels.withColumn("quality", F.when(allowed, F.col("quality")).otherwise(1 - F.col("quality")))
    again = fit_quality(docs, other, allowed)
    assert (again.good, again.bad, again.weights) == (model.good, model.bad, model.weights)

    def size(text, content, raw):
        kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT
        press = zstandard.ZstdCompressor(
            level=1, dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind),
            write_content_size=False, write_dict_id=False)
        return sum(len(press.compress(text[at:at + 1024])) for at in range(0, len(text), 1024))

    def columns(text):
        good, bad = size(text, model.good, model.raw[0]), size(text, model.bad, model.raw[1])
        both, n = max(1, good + bad), max(1, len(text))
        return np.array([10 * (bad - good) / both, 10 * (bad - good) / n, both / 2 / n, (both / 2 / n) ** 2, 1.0])

    def score(text):
        return 1 / (1 + np.exp(-np.clip(np.dot(model.weights, columns(text)), -500, 500)))

    odd = ["", "x", "é" * 3_000, "BUY NOW!! " * 500]
    texts = [r.text for r in docs.orderBy("doc_id").collect()] + odd
    found = {r.doc_id: r._score for r in score_quality(frame(spark, texts), model).collect()}
    assert len(found) == len(texts)
    assert np.allclose([found[i] for i in range(len(texts))], [score(t.encode()) for t in texts], atol=1e-9)

    # The calibration is the optimum: the weighted, penalised likelihood has no slope there.
    sample, counts = labelled_sample(docs, labels, ["quality"], 3_000, F.col("quality").isin(0, 1) & allowed)
    slope = 1e-3 * np.array(model.weights)
    kept = {kind: [body for body, values in sample if values == (kind,)][::3] for kind in (0, 1)}
    n = sum(map(len, kept.values()))
    for kind, bodies in kept.items():
        weight = counts[(kind,)] / sum(counts.values()) / len(bodies) * n
        slope += sum(weight * (score(body) - kind) * columns(body) for body in bodies)
    assert np.abs(slope).max() < 1e-3


def test_quality_without_labels_of_both_kinds(spark, labelled):
    docs, labels = labelled
    for kept, score in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0)):
        model = fit_quality(docs, kept)
        assert {r._score for r in score_quality(docs.limit(5), model).collect()} == {score}
    few = fit_quality(docs, labels.where("doc_id in (3, 4)"))
    assert score_quality(docs, few).count() == 300


def test_sample_draws_short_texts_first_and_long_ones_where_they_lack(spark):
    docs = frame(spark, ["long " * 20 if i % 2 or i >= 40 else f"short {i}" for i in range(60)])
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(62)], "doc_id long, quality int")
    sample, counts = labelled_sample(docs, labels, ["quality"], 20, F.lit(True), longest=50)
    kinds = {kind: [body for body, values in sample if values == (kind,)] for kind in (0, 1)}
    assert counts == {(1,): 40, (0,): 22}
    assert sorted(kinds[1]) == sorted(f"short {i}".encode() for i in range(0, 40, 2))
    assert kinds[0] == [b"long " * 20] * 10
    alone, _ = labelled_sample(docs, labels, ["quality"], 1, F.lit(True), longest=50)
    assert len(alone) == 2


def test_quality_where_texts_of_a_label_are_long(spark):
    rng = random.Random(9)
    docs = frame(spark, [junk(rng, 80) if i % 3 == 0 else prose(rng, 8_000) for i in range(60)])
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(40)], "doc_id long, quality int")
    scores = {r.doc_id: r._score for r in score_quality(docs, fit_quality(docs, labels)).where("doc_id >= 40").collect()}
    assert all((score >= 0.5) == (i % 3 > 0) for i, score in scores.items())


def test_toxicity_on_held_out_texts(spark, labelled):
    docs, labels = labelled
    chain = fit_toxicity(docs, labels.withColumn("junk", 1 - F.col("quality")), ["junk", "toxic"],
                         severe_of="toxic", allowed=F.col("doc_id") % 4 != 0)
    assert chain.categories == ["junk", "toxic", "severe"]
    found = {r.doc_id: (r.text, r._scores) for r in score_toxicity(docs, chain).collect()}
    held = [(found[i][1][1] >= 0.5) == (i % 5 == 1 and i % 3 != 0) for i in range(0, 300, 4)]
    assert np.mean(held) > 0.95
    severe = [sum(w in text for w in ("scum", "moron", "idiot", "trash")) >= 3 for text, _ in found.values()]
    assert np.mean([(s[2] >= 0.5) == wanted for (_, s), wanted in zip(found.values(), severe)]) > 0.95
    odd = score_toxicity(frame(spark, [None, ""]), chain).collect()
    assert odd[0]._scores == odd[1]._scores
    none = fit_toxicity(docs, labels.limit(0), ["toxic"], severe_of="toxic")
    assert {tuple(r._scores) for r in score_toxicity(docs, none).collect()} == {(0.0, 0.0)}


def plain_fit(x, extra, y, weight):
    """Logistic regression as the chain's, on a dense table: telling columns, earlier probabilities, a constant."""
    inside, outside = x[y == 1].sum(axis=0) + 0.5, x[y == 0].sum(axis=0) + 0.5
    ratio = np.log(inside / ((y == 1).sum() + 1) / (outside / ((y == 0).sum() + 1)))
    telling = np.abs(ratio) >= 3 * np.sqrt(1 / inside + 1 / outside)
    table = np.column_stack([x * telling, extra, np.ones(len(x))])
    penalty = np.array([1e-4] * x.shape[1] + [0.0] * (table.shape[1] - x.shape[1]))
    w, first, second = (np.zeros(table.shape[1]) for _ in range(3))
    for step in range(1, 121):
        slope = table.T @ (weight * (1 / (1 + np.exp(-table @ w)) - y)) / len(x) + penalty * w
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w = w - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def test_chain_equals_a_plain_calculation_with_out_of_fold_probabilities():
    rng = random.Random(8)
    texts, targets = [], []
    for _ in range(90):
        low = rng.random() < 0.4
        toxic = rng.random() < (0.7 if low else 0.2)
        words = [rng.choice(["tree", "sea", "sun", "way"]) for _ in range(6)]
        words += ["junk"] * (low and rng.random() < 0.8) + ["scum"] * (toxic and rng.random() < 0.8)
        texts.append(" ".join(words).encode())
        targets.append((float(low), float(toxic), 0.0))
    targets, weight = np.array(targets), np.array([rng.uniform(0.5, 2) for _ in texts])
    chain = ToxicityChain(["low", "toxic", "never"])
    chain.fit(texts, targets, weight)

    def signs(text):
        return {w for w in text.split()} | {w[:4] + b" " for w in text.split() if len(w) >= 4}

    names = sorted({sign for sign in set().union(*map(signs, texts)) if sum(sign in signs(t) for t in texts) >= 4})
    x = np.array([[float(name in signs(text)) for name in names] for text in texts])
    fold, earlier, fitted = np.arange(len(texts)) % 3, np.zeros((len(texts), 0)), []
    for k in range(2):
        fitted.append(plain_fit(x, earlier, targets[:, k], weight))
        outside = np.zeros(len(texts))
        for f in range(3):
            w = plain_fit(x[fold != f], earlier[fold != f], targets[fold != f, k], weight[fold != f])
            rest = fold == f
            outside[rest] = 1 / (1 + np.exp(-np.column_stack([x, earlier, np.ones(len(x))])[rest] @ w))
        earlier = np.column_stack([earlier, outside])
    assert abs(fitted[1][len(names)]) > 0.1
    for row, text in zip(x, [*texts]):
        first = 1 / (1 + np.exp(-np.array([*row, 1.0]) @ fitted[0]))
        second = 1 / (1 + np.exp(-np.array([*row, first, 1.0]) @ fitted[1]))
        assert np.allclose(chain.score(text), [first, second, 0.0], atol=1e-6)


@pytest.fixture(scope="module")
def planted(spark, labelled):
    """Tables in a folder: prose, junk, copies, a benchmark passage, a secret, a null."""
    rng = random.Random(2)
    _, labels = labelled
    texts = [r.text for r in labelled[0].orderBy("doc_id").collect()]
    fresh = [" ".join(f"{prose(rng, 1)}{rng.randrange(900)}" for _ in range(200)) for _ in range(6)]
    passage = " ".join(f"quiz{k}" for k in range(12))
    texts += [
        *fresh, fresh[0], fresh[1].replace(fresh[1].split()[50], "other"), f"{fresh[2]} and {passage} and so on",
        fresh[3][:300] + " token = 0123456789abcdef0123456789abcdef " + fresh[3][300:], None, junk(rng, 90),
    ]
    folder = scratch_folder(spark, "test-pipeline")
    frame(spark, texts).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts


def test_pipeline_stages_one_after_another(spark, planted):
    folder, texts = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("_score", F.lit("clash"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_folder(spark, "test-stage")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == corpus_pipeline.COLUMNS
        kept[name] = {r.doc_id: r for r in docs.collect()}
    good, near, clean, safe = kept.values()
    assert 311 not in good and not any(i in good for i in range(0, 300, 3))
    assert {300, 301, 302, 303, 304, 305, 306, 307, 308, 309} <= good.keys()
    prints = {}
    for i in sorted(good):
        hashes = shingle_hashes((texts[i] or "").encode(), 3)
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hashes) > len(hashes))
    group = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(prints, 2):
            if group[i] != group[j] and (prints[i] ^ prints[j]).bit_count() <= 2:
                group[i] = group[j] = min(group[i], group[j])
                changed = True
    assert near.keys() == {i for i in group if group[i] == i} and 306 not in near
    assert clean.keys() == near.keys() and safe.keys() == clean.keys()
    assert all(safe[i].n_chars == len(safe[i].text or "") for i in safe if safe[i].text)


def test_late_stages_change_what_they_find(spark, planted):
    folder, texts = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    cut = {r.doc_id: r for r in corpus_pipeline.contamination(spark, docs, folder).collect()}
    assert cut[308].text == texts[308].replace(" ".join(f"quiz{k}" for k in range(12)), "")
    assert cut[308].n_chars == len(cut[308].text)
    safe = {r.doc_id: r.text for r in corpus_pipeline.secrets(spark, docs, folder).collect()}
    assert safe[309] == texts[309].replace("0123456789abcdef" * 2, "[SECRET]")
    assert all(safe[i] == t for i, t in enumerate(texts) if i != 309)


def test_run_gives_tokens_of_what_is_left(spark, planted):
    result = corpus_pipeline.run(spark, planted[0]).collect()
    assert {"doc_id", "n_tokens", "ids"} <= set(result[0].__fields__)
    assert all(len(r.ids) == 4 * r.n_tokens for r in result) and len(result) < len(planted[1])
