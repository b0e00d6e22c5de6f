"""A quality classifier: neighbours in a latent-semantic space vote.

A text is described by the shapes of its words (cases, digits and signs, without the letters), of
neighbouring words, and by words that repeat the one before. The relative frequencies of
these terms are projected on the leading singular vectors of a bounded labelled sample. The
sample's vectors are broadcast; every text gets its cosines with all of them in one matrix product
for a block of texts, and the labels of the nearest vote with their similarity.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.llm.common import Cached, WordHasher, free_name, hashed, mix, texts
from wattframe.llm.labelled import label_counts, labelled_sample

#: Hashed terms, latent dimensions and voting neighbours.
TERMS, DIMENSIONS, NEIGHBOURS = 4096, 32, 25
#: Labelled texts of each class that a model is fitted on, at most.
PER_CLASS = 3000
#: A neighbour's vote is its cosine to this power.
SHARPNESS = 8
#: Texts scored in one matrix product.
BLOCK = 256
_RUNS = re.compile(r"(.)\1+")


def shape(word: bytes) -> int:
    """A hash of the word's classes of characters, runs of one class as one."""
    chars = word.decode("utf-8", "replace")
    classes = "".join(
        "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in chars
    )
    return xxhash.xxh3_64_intdigest(_RUNS.sub(r"\1", classes))


class Terms:
    """Counts terms of texts; keeps what it learned about words."""

    def __init__(self):
        self.shapes, self.hasher = Cached(shape), WordHasher()

    def __call__(self, data: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and square roots of their shares."""
        words = (data or b"").split()
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        shapes = hashed(words, self.shapes)
        _, same = self.hasher(data)
        shapes[1:][same[1:] == same[:-1]] = np.uint64(1)
        pairs = mix(shapes[:-1] * np.uint64(31) + shapes[1:])
        terms = np.concatenate([mix(shapes), pairs]) % np.uint64(TERMS)
        numbers, counts = np.unique(terms.astype(np.int64), return_counts=True)
        return numbers, np.sqrt(counts / counts.sum()).astype(np.float32)


@dataclass
class Model:
    """``centre`` and ``axes`` make vectors of terms; ``vectors`` and ``labels`` vote, each with
    its weight: how many labelled texts of its class there are for one of the sample."""

    prior: float
    centre: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    neighbours: int = NEIGHBOURS

    def embed(self, terms: np.ndarray) -> np.ndarray:
        latent = (terms - self.centre) @ self.axes
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def score(self, terms: np.ndarray) -> np.ndarray:
        """Share of label 1 in the votes of the nearest, for each row of ``terms``."""
        out = np.full(len(terms), self.prior)
        known = terms.any(axis=1)
        if not len(self.labels) or not known.any():
            return out
        cosines = self.embed(terms[known]) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cosines, near, 1), 0.0) ** SHARPNESS
        votes *= self.weights[near]
        total = votes.sum(axis=1)
        share = (votes * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
        out[known] = np.where(total > 1e-12, np.clip(share, 0.0, 1.0), self.prior)
        return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: int = PER_CLASS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """A model of the labels, from at most ``per_class`` texts of each class, whose votes are
    weighted back to the classes' sizes.

    Rows that are held out, have a null id or label, or no text are not learned from. The
    prior is the share of label 1 in all labels that may be learned from, 0.5 without any.
    """
    sample = labelled_sample(docs, labels, label, per_class, doc_id, text)

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for part, data in texts(batches):
            found = [terms(x) for x in data]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("label"),
                    pa.array([n.astype(np.int16).tobytes() for n, _ in found], pa.binary()),
                    pa.array([s.tobytes() for _, s in found], pa.binary()),
                ],
                names=["doc_id", "label", "terms", "shares"],
            )

    schema = "doc_id long, label int, terms binary, shares binary"
    # bounded: per_class rows of a class with at most TERMS numbers each
    rows = sample.mapInArrow(describe, schema).toArrow().to_pylist()
    rows = sorted((r for r in rows if r["terms"]), key=lambda r: r["doc_id"])
    matrix = np.zeros((len(rows), TERMS), np.float32)
    for i, r in enumerate(rows):
        matrix[i, np.frombuffer(r["terms"], np.int16)] = np.frombuffer(r["shares"], np.float32)
    classes = np.array([r["label"] for r in rows], np.float32)
    weights = np.ones(len(rows))
    prior = 0.5
    if len(rows):
        counts = label_counts(docs, labels, label, doc_id, text)
        for value, n in counts.items():
            weights[classes == value] = n / max((classes == value).sum(), 1)
        prior = counts.get(1, 0) / sum(counts.values())
    if not len(rows):
        empty = np.zeros((0, 1), np.float32)
        axes = np.zeros((TERMS, 1), np.float32)
        return Model(prior, np.zeros(TERMS, np.float32), axes, empty, classes, weights)
    centre = matrix.mean(axis=0)
    axes = leading_axes(matrix - centre, DIMENSIONS)
    model = Model(prior, centre, axes, np.zeros((0, axes.shape[1]), np.float32), classes, weights)
    model.vectors = model.embed(matrix)
    return model


def leading_axes(matrix: np.ndarray, dimensions: int) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration from a fixed start."""
    width = min(dimensions, *matrix.shape)
    start = np.random.default_rng(7).standard_normal((matrix.shape[1], width + 8))
    basis = np.linalg.qr(start.astype(np.float32))[0]
    for _ in range(12):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ right.T)[:, :width].astype(np.float32)


def score_documents(
    docs: DataFrame, model: Model, text: str = "text", score: str = "score"
) -> DataFrame:
    """``docs`` with a double ``score`` from 0 to 1, higher where label 1 is likelier.

    A null, empty or blank text gets the model's prior. Every row keeps all its columns; a column
    named like the score is replaced. An empty table stays empty.
    """
    rows = docs.drop(score)
    schema = T.StructType([*rows.schema.fields, T.StructField(score, T.DoubleType())])

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for part, data in texts(batches, text):
            scores = np.zeros(len(data))
            for start in range(0, len(data), BLOCK):
                some = data[start : start + BLOCK]
                matrix = np.zeros((len(some), TERMS), np.float32)
                for i, x in enumerate(some):
                    numbers, shares = terms(x)
                    matrix[i, numbers] = shares
                scores[start : start + BLOCK] = model.score(matrix)
            names = [*part.schema.names, score]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=names)

    return rows.mapInArrow(judge, schema)


def keep_quality(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with their own columns."""
    score = free_name(docs.columns, "quality_score")
    scored = score_documents(docs, model, score=score)
    return scored.filter(F.col(score) >= threshold).drop(score)
