"""Quality classifier by compression with dictionaries of good and bad text.

Two zstandard dictionaries are built from labelled texts, one of each kind. A
text is compressed with both, in chunks so that the dictionaries count all along
it. How much smaller the one makes it, relative to both sizes, is the evidence;
a logistic calibration, fitted on other labelled texts, turns it into the
probability that the text is good. The calibration also sees the compressed size
relative to the text, as text that repeats itself compresses well with either.

Fitting uses a sample of at most ``per_class`` texts of each label, long ones
where short ones lack (``labelled_sample``), weighted by the labels' counts over all labelled rows.

Defined results: a null text counts as empty; an empty text gets the calibrated
score of no evidence; if only one label is known every score is 1 or 0, and 0.5
if none is; repeated rows score alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.labelled import labelled_sample
from tillflow.llm.tables import byte_texts, map_arrow, slices

PER_CLASS = 3_000
DICTIONARY_BYTES = 16_384
CHUNK_BYTES = 1_024
LEVEL = 1


def dictionary(texts: list[bytes], size: int) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; the texts themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, texts)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(
            b"\n".join(texts)[-size:] or b"\n" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


@dataclass
class CompressionClassifier:
    """Fitted dictionaries and calibration; ``prior`` replaces them where one label alone is known."""

    good: bytes = b""
    bad: bytes = b""
    raw: tuple[bool, bool] = (False, False)
    weights: tuple[float, ...] = ()
    prior: float | None = None

    def __post_init__(self) -> None:
        self._pair = None

    def __getstate__(self):
        return {**self.__dict__, "_pair": None}

    def _compressors(self):
        if self._pair is None:
            pair = []
            for content, raw in zip((self.good, self.bad), self.raw):
                kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT
                data = zstandard.ZstdCompressionDict(content, dict_type=kind)
                data.precompute_compress(level=LEVEL)
                pair.append(zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False).compress)
            self._pair = pair
        return self._pair

    def evidence(self, text: bytes) -> list[float]:
        good, bad = self._compressors()
        with_good = with_bad = 0
        for start in range(0, len(text), CHUNK_BYTES):
            chunk = text[start:start + CHUNK_BYTES]
            with_good += len(good(chunk))
            with_bad += len(bad(chunk))
        both, size = max(1, with_good + with_bad), max(1, len(text))
        difference, ratio = (with_bad - with_good) / both, both / (2 * size)
        return [10 * difference, 10 * (with_bad - with_good) / size, ratio, ratio * ratio, 1.0]

    def score(self, text: bytes) -> float:
        if self.prior is not None:
            return self.prior
        odds = sum(w * x for w, x in zip(self.weights, self.evidence(text)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton steps (a few columns)."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w = w - move * min(1.0, 5.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-6:
            break
    return w


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column | None = None,
    label: str = "quality",
    per_class: int = PER_CLASS,
    id: str = "doc_id",
    text: str = "text",
) -> CompressionClassifier:
    """Fits on labelled rows with label 0 or 1 for which ``allowed`` holds."""
    usable = F.col(label).isin(0, 1) & (F.lit(True) if allowed is None else allowed)
    sample, counts = labelled_sample(docs, labels, [label], per_class, usable, id, text)
    texts = {kind: [body for body, values in sample if values[0] == kind] for kind in (0, 1)}
    if not texts[0] or not texts[1]:
        return CompressionClassifier(prior=1.0 if texts[1] else 0.0 if texts[0] else 0.5)
    # Every third text calibrates, the others make the dictionaries; with very few, all do both.
    held = {k: t[::3] if len(t) >= 6 else t for k, t in texts.items()}
    taught = {k: [b for i, b in enumerate(t) if i % 3] if len(t) >= 6 else t for k, t in texts.items()}
    made = [dictionary(taught[kind], DICTIONARY_BYTES) for kind in (1, 0)]
    model = CompressionClassifier(
        good=made[0].as_bytes(), bad=made[1].as_bytes(),
        raw=tuple(d.dict_id() == 0 for d in made))
    y = np.concatenate([np.ones(len(held[1])), np.zeros(len(held[0]))])
    x = np.array([model.evidence(body) for body in [*held[1], *held[0]]])
    share = {kind: counts[(kind,)] / (counts[(0,)] + counts[(1,)]) for kind in (0, 1)}
    weight = np.where(y == 1, share[1] / len(held[1]), share[0] / len(held[0])) * len(y)
    model.weights = tuple(logistic(x, y, weight).tolist())
    return model


def score_quality(docs: DataFrame, model: CompressionClassifier, text: str = "text") -> DataFrame:
    """``docs`` with ``_score``, the probability that the text is good, in place of a column of that name."""
    docs = docs.drop("_score")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]):
        score = shared.value.score
        for batch in slices(batches, text):
            scores = [score(body) for body in byte_texts(batch.column(text))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), pa.array(scores, pa.float64())],
                names=[*names, "_score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())])
    return map_arrow(docs, judge, schema)
