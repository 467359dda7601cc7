"""Toxicity categories by a chain of linear classifiers.

Categories are predicted in a fixed order. Each has a logistic model of which
words, and which word beginnings of four to six bytes, a text has (those that its
training texts tell apart by), and of the probabilities that the earlier
categories got. A later model is trained on
probabilities that the earlier ones gave to texts outside their training folds,
so it meets them as they will be for new texts.

The categories are label columns, 0 or 1, and ``severe``: a text with the label
``severe_of`` and ``severe_words`` or more different telling words, that is words
which texts with that label have ``telling`` times as often as others. Fitting
uses at most ``per_class`` labelled texts of each combination of labels
(``labelled_sample``), weighted by the combinations' counts over all labelled rows.

Defined results: a null text counts as empty and has the models' base odds; a
category without both values in the sample gets its known value everywhere (0
if there are no labels); repeated rows score alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.decontaminate import words_of
from tillflow.llm.labelled import labelled_sample
from tillflow.llm.tables import byte_texts, map_arrow, slices

PER_CLASS = 2_000
LEAST_TEXTS = 4
FOLDS = 3
ROUNDS = 120
PENALTY = 1e-4
LEAST_Z = 3.0
BEGINNINGS = (4, 5, 6)


def signs(text: bytes) -> set[bytes]:
    """The words of a text and their beginnings (marked by a blank)."""
    words = set(words_of(text))
    return words.union(*({word[:n] + b" " for word in words if len(word) >= n} for n in BEGINNINGS))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def telling_features(at: np.ndarray, positive: np.ndarray, size: int, rows: int, yes: int) -> np.ndarray:
    """Which features' log odds ratio lies ``LEAST_Z`` standard errors from zero or more."""
    inside = np.bincount(at[positive], minlength=size) + 0.5
    outside = np.bincount(at[~positive], minlength=size) + 0.5
    ratio = np.log(inside / (yes + 1)) - np.log(outside / (rows - yes + 1))
    return np.abs(ratio) >= LEAST_Z * np.sqrt(1 / inside + 1 / outside)


def fit_linear(rows: list[np.ndarray], size: int, extra: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Logistic weights of the telling presence features, of the ``extra`` columns and a constant.

    Adam over all rows; features are chosen from these rows alone.
    """
    at = np.concatenate([*rows, np.zeros(0, np.int64)])
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    chosen = telling_features(at, y[row] == 1, size, len(rows), int(y.sum()))
    at, row = at[chosen[at]], row[chosen[at]]
    dense = np.column_stack([extra, np.ones(len(rows))])
    w, v = np.zeros(size), np.zeros(dense.shape[1])
    moments = [np.zeros(size), np.zeros(size), np.zeros(len(v)), np.zeros(len(v))]
    for number in range(1, ROUNDS + 1):
        odds = np.bincount(row, w[at], len(rows)) + dense @ v
        error = weight * (sigmoid(odds) - y) / len(rows)
        slopes = np.bincount(at, error[row], size) + PENALTY * w, dense.T @ error
        for k, (slope, target) in enumerate(zip(slopes, (w, v))):
            first, second = moments[2 * k], moments[2 * k + 1]
            first += 0.1 * (slope - first)
            second += 0.001 * (slope * slope - second)
            target -= 0.1 * (first / (1 - 0.9**number)) / (np.sqrt(second / (1 - 0.999**number)) + 1e-8)
    return w, v


class ToxicityChain:
    """A fitted chain: words to features, and per category the weights or a known value."""

    def __init__(self, categories: list[str]) -> None:
        self.categories = categories
        self.features: dict[bytes, int] = {}
        self.words = np.zeros((0, len(categories)))
        self.chain = np.zeros((len(categories), len(categories) + 1))
        self.known: list[float | None] = [0.0] * len(categories)

    def rows(self, texts: list[bytes]) -> list[np.ndarray]:
        get = self.features.get
        return [np.array(sorted(i for s in signs(t) if (i := get(s)) is not None), np.int64) for t in texts]

    def fit(self, texts: list[bytes], targets: np.ndarray, weight: np.ndarray) -> None:
        held = Counter(sign for text in texts for sign in signs(text))
        kept = sorted(sign for sign, n in held.items() if n >= LEAST_TEXTS)
        self.features = {sign: number for number, sign in enumerate(kept)}
        rows, size = self.rows(texts), len(kept)
        self.words = np.zeros((size, len(self.categories)))
        fold = np.arange(len(texts)) % FOLDS
        earlier = np.zeros((len(texts), 0))
        for k in range(len(self.categories)):
            y = targets[:, k]
            if len(texts) == 0 or y.min() == y.max():
                self.known[k] = float(y.max()) if len(texts) else 0.0
                outside = np.full(len(texts), self.known[k])
            else:
                self.known[k] = None
                self.words[:, k], self.chain[k, [*range(k), -1]] = fit_linear(rows, size, earlier, y, weight)
                outside = np.zeros(len(texts))
                for f in range(FOLDS):
                    inside, out = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                    w, v = fit_linear([rows[i] for i in inside], size, earlier[inside], y[inside], weight[inside])
                    outside[out] = sigmoid(
                        np.array([w[rows[i]].sum() for i in out])
                        + np.column_stack([earlier[out], np.ones(len(out))]) @ v)
            earlier = np.column_stack([earlier, outside])

    def score(self, text: bytes) -> list[float]:
        get = self.features.get
        at = [i for s in signs(text) if (i := get(s)) is not None]
        odds = self.words[np.sort(np.array(at, np.int64))].sum(axis=0)
        out: list[float] = []
        for k, known in enumerate(self.known):
            if known is None:
                total = odds[k] + self.chain[k, -1] + sum(c * p for c, p in zip(self.chain[k], out))
                known = float(sigmoid(total))
            out.append(known)
        return out


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    columns: list[str],
    severe_of: str | None = None,
    severe_words: int = 3,
    telling: float = 20.0,
    allowed: Column | None = None,
    per_class: int = PER_CLASS,
    id: str = "doc_id",
    text: str = "text",
) -> ToxicityChain:
    """The chain over ``columns`` in their order, then ``severe`` if ``severe_of`` names one of them."""
    usable = F.lit(True) if allowed is None else allowed
    for column in columns:
        usable = usable & F.col(column).isin(0, 1)
    sample, counts = labelled_sample(docs, labels, columns, per_class, usable, id, text)
    chain = ToxicityChain([*columns, "severe"] if severe_of else list(columns))
    texts = [body for body, _ in sample]
    targets = np.array([values for _, values in sample], float).reshape(len(sample), len(columns))
    drawn = Counter(values for _, values in sample)
    total = sum(counts[v] for v in drawn)
    weight = np.array([counts[v] / total / drawn[v] for _, v in sample]) * len(sample)
    if severe_of and len(sample):
        marked = targets[:, columns.index(severe_of)] == 1
        words = [set(words_of(body)) for body in texts]
        inside = Counter(w for has, m in zip(words, marked) if m for w in has)
        outside = Counter(w for has, m in zip(words, marked) if not m for w in has)
        n, rest = max(1, marked.sum()), max(1, (~marked).sum())
        tells = {w for w, c in inside.items()
                 if c >= LEAST_TEXTS and c / n >= telling * (outside[w] + 0.5) / rest}
        severe = np.array([m and len(has & tells) >= severe_words for has, m in zip(words, marked)], float)
        targets = np.column_stack([targets, severe])
    elif severe_of:
        targets = np.zeros((0, len(columns) + 1))
    chain.fit(texts, targets, weight)
    return chain


def score_toxicity(docs: DataFrame, chain: ToxicityChain, text: str = "text") -> DataFrame:
    """``docs`` with ``_scores``: the probability of each category, in the chain's order.

    A column of that name is replaced.
    """
    docs = docs.drop("_scores")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def judge(batches: Iterator[pa.RecordBatch]):
        score = shared.value.score
        for batch in slices(batches, text):
            scores = [score(body) for body in byte_texts(batch.column(text))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), pa.array(scores, pa.list_(pa.float64()))],
                names=[*names, "_scores"])

    kind = T.ArrayType(T.DoubleType())
    return map_arrow(docs, judge, T.StructType([*docs.schema.fields, T.StructField("_scores", kind)]))
