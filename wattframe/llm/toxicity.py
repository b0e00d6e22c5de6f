"""Toxicity: cumulative-link ordinal regression on sparse text features.

The grades are 0 for clean texts and 1, 2, 3 for toxic ones with few, more and many words that
occur in toxic texts only (learned from the labelled sample). One weight per
feature is shared by all thresholds: P(grade <= j) = sigmoid(threshold_j - weight . x). The
expected grade is the severity.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wattframe.llm.common import Cached, texts
from wattframe.llm.labelled import labelled_sample

#: Hashed features; a power of two.
FEATURES = 1 << 18
#: Characters of the beginnings of words that are features beside whole words.
BEGINNINGS = (4, 5, 6)
#: Labelled texts of each class that a model is fitted on, at most.
PER_CLASS = 5000
GRADES = 4
#: Standard errors by which a feature's share must differ between toxic and clean texts.
LEAST_Z = 4.0
_SIGNS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def _features(word: bytes) -> tuple[int, ...]:
    """The hashed word and its hashed beginnings."""
    chars = word.decode("utf-8", "replace").lower()
    parts = {chars} | {f"{chars[:n]}*" for n in BEGINNINGS if len(chars) > n}
    return tuple(xxhash.xxh3_64_intdigest(p.encode()) % FEATURES for p in sorted(parts))


class Words:
    """Sparse features of texts: which words and beginnings they hold, and how often."""

    def __init__(self):
        self.known = Cached(_features)

    def __call__(self, data: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        flat: list[int] = []
        known = self.known
        for word in (data or b"").translate(_SIGNS).split():
            flat.extend(known[word])
        return np.unique(np.array(flat, np.int64), return_counts=True)


@dataclass
class Model:
    """``weights`` by feature; ascending ``thresholds``, one fewer than grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """P(grade > j) for each threshold j."""
        x = float(self.weights[features] @ np.log1p(counts))
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds - x, -500, 500)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    per_class: int = PER_CLASS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """A model of at most ``per_class`` labelled texts of each class.

    Held-out rows, null ids and null labels are not learned from. Without toxic and clean
    texts the model finds nothing toxic.
    """
    sample = labelled_sample(docs, labels, label, per_class, doc_id, text)

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for part, data in texts(batches):
            found = [words(x) for x in data]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("label"),
                    pa.array([f.astype(np.int32).tobytes() for f, _ in found], pa.binary()),
                    pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary()),
                ],
                names=["doc_id", "label", "features", "counts"],
            )

    schema = "doc_id long, label int, features binary, counts binary"
    # bounded: per_class rows of a class with at most FEATURES numbers each
    rows = sample.mapInArrow(describe, schema).toArrow().to_pylist()
    rows.sort(key=lambda r: r["doc_id"])
    features = [np.frombuffer(r["features"], np.int32) for r in rows]
    counts = [np.frombuffer(r["counts"], np.int32) for r in rows]
    toxic = np.array([r["label"] for r in rows], np.int64)
    if not toxic.any() or toxic.all():
        return Model(np.zeros(FEATURES, np.float32), np.array([30.0, 31.0, 32.0]))
    return train(features, counts, grades(features, counts, toxic))


def grades(features: list, counts: list, toxic: np.ndarray) -> np.ndarray:
    """0 for clean texts; toxic texts by thirds of how often they use what only toxic do."""
    seen = np.zeros((2, FEATURES), np.int64)
    for f, t in zip(features, toxic):
        seen[t, f] += 1
    marked = (seen[1] >= 5) & (seen[0] * 50 < seen[1])
    uses = np.array([c[marked[f]].sum() for f, c in zip(features, counts)])
    cuts = np.quantile(uses[toxic == 1], [1 / 3, 2 / 3])
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, uses, side="left"), 0)


def telling(at: np.ndarray, toxic: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Features of several texts whose share differs clearly between toxic and clean ones; the
    rest mostly tell which texts were sampled."""
    one = np.bincount(at[toxic], minlength=FEATURES)
    zero = np.bincount(at[~toxic], minlength=FEATURES)
    share = (one + zero) / (n_toxic + n_clean)
    error = np.sqrt(share * (1 - share) * (1 / n_toxic + 1 / n_clean))
    z = np.abs(one / n_toxic - zero / n_clean) / np.maximum(error, 1e-12)
    return (one + zero >= 3) & (z >= LEAST_Z)


def train(
    features: list, counts: list, grade: np.ndarray, rounds: int = 300, penalty: float = 2e-4
) -> Model:
    """Weights and thresholds that make the grades likely, by Adam on all rows."""
    at = np.concatenate(features).astype(np.int64)
    value = np.log1p(np.concatenate(counts)).astype(np.float32)
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    told = telling(at, grade[row] > 0, (grade > 0).sum(), (grade == 0).sum())[at]
    at, value, row = at[told], value[told], row[told]
    n, steps = len(grade), GRADES - 1
    weights = np.zeros(FEATURES)
    # thresholds ascend: the first, then logs of the gaps
    share = np.clip([(grade <= j).mean() for j in range(steps)], 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    place = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    moments = [[np.zeros(FEATURES), np.zeros(FEATURES)], [np.zeros(steps), np.zeros(steps)]]
    balance = n / (2 * np.where(grade > 0, (grade > 0).sum(), (grade == 0).sum())) / n
    for t in range(1, rounds + 1):
        thresholds = np.cumsum(np.concatenate([place[:1], np.exp(place[1:])]))
        x = np.bincount(row, weights[at] * value, n)
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        upper, lower = edges[grade + 1] - x, edges[grade] - x
        up, low = 1 / (1 + np.exp(-np.clip(upper, -60, 60))), 1 / (1 + np.exp(-np.clip(lower, -60, 60)))
        chance = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / chance * balance, low * (1 - low) / chance * balance
        slope = np.bincount(at, (d_up - d_low)[row] * value, FEATURES) + penalty * weights
        by_edge = np.zeros(GRADES + 1)
        np.add.at(by_edge, grade + 1, -d_up)
        np.add.at(by_edge, grade, d_low)
        tail = np.cumsum(by_edge[1:-1][::-1])[::-1]
        turn = np.concatenate([tail[:1], tail[1:] * np.exp(place[1:])])
        for what, by, (first, second) in ((weights, slope, moments[0]), (place, turn, moments[1])):
            first += 0.1 * (by - first)
            second += 0.001 * (by * by - second)
            what -= 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-10)
    thresholds = np.cumsum(np.concatenate([place[:1], np.exp(place[1:])]))
    return Model(weights.astype(np.float32), thresholds)


def grade_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (chance of any toxicity), ``severity`` (expected grade, 0 to 3),
    ``grade`` (the likeliest) and ``predicted`` (1 if the score reaches 0.5).

    A null or empty text has no features and gets what the thresholds alone say. Every row keeps
    its columns; those named like the four are replaced. An empty table stays empty.
    """
    added = [
        T.StructField("score", T.DoubleType()),
        T.StructField("severity", T.DoubleType()),
        T.StructField("grade", T.IntegerType()),
        T.StructField("predicted", T.IntegerType()),
    ]
    rows = docs.drop(*[f.name for f in added])

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for part, data in texts(batches, text):
            above = np.array([model.above(*words(x)) for x in data])
            at_most = np.concatenate([1 - above, np.ones((len(data), 1))], axis=1)
            chance = np.diff(at_most, axis=1, prepend=0.0)
            columns = [
                pa.array(above[:, 0]),
                pa.array(above.sum(axis=1)),
                pa.array(chance.argmax(axis=1).astype(np.int32)),
                pa.array((above[:, 0] >= 0.5).astype(np.int32)),
            ]
            names = [*part.schema.names, *[f.name for f in added]]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=names)

    return rows.mapInArrow(judge, T.StructType([*rows.schema.fields, *added]))
