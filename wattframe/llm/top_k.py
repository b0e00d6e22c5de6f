"""Exact top-k search by inner product with block-at-a-time pruning.

The index holds blocks: ranges of the vectors ordered by their strongest signed term and id.
A block keeps a forward index (terms and weights by vector) and the largest and smallest
weight of each term. For a query the blocks are ordered by the sum, over its terms, of the
largest product the block allows; blocks are scored through their forward index until that bound
falls below the k-th best score. Queries meet the index in blocks as well.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import cut_lineage, shuffle_width

BLOCK_ROWS = 512
#: Blocks of vectors, and queries, that one task holds at a time.
BLOCKS_PER_TASK = 64
QUERIES_PER_TASK = 4096


def integer_vector(embedding: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component; null if the vector or a component is null or
    not finite."""
    x = embedding.cast("array<double>")
    whole = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    )
    return F.when(whole, F.transform(x, lambda v: F.floor(v * F.lit(float(scale)))))


def dense_terms(weights: Column) -> Column:
    """Terms 0, 1, ... of a dense vector."""
    return F.when(F.size(weights) == 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(0), F.size(weights) - 1)
    )


class Block:
    """A forward index of some vectors with the extreme weights of each term."""

    def __init__(self, ids, lengths, terms, weights):
        self.ids = ids
        self.rows = np.flatnonzero(lengths)
        self.starts = (np.cumsum(lengths) - lengths)[self.rows]
        self.terms, self.local = np.unique(terms, return_inverse=True)
        self.weights = weights
        # a vector without a term counts as weight 0
        by_term = np.argsort(self.local, kind="stable")
        counts = np.bincount(self.local, minlength=len(self.terms))
        heads = np.cumsum(counts) - counts
        self.most = self.least = np.zeros(0, np.int64)
        if len(self.terms):
            self.most = np.maximum.reduceat(weights[by_term], heads)
            self.least = np.minimum.reduceat(weights[by_term], heads)
            partial = counts < len(ids)
            self.most = np.where(partial, np.maximum(self.most, 0), self.most)
            self.least = np.where(partial, np.minimum(self.least, 0), self.least)

    def query(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The query's weights on this block's terms."""
        out = np.zeros(len(self.terms), np.int64)
        at = np.searchsorted(self.terms, terms)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == terms[known]
        np.add.at(out, at[known], weights[known])
        return out

    def bound(self, query: np.ndarray) -> int:
        return int(np.where(query > 0, query * self.most, query * self.least).sum())

    def scores(self, query: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.ids), np.int64)
        if len(self.rows):
            out[self.rows] = np.add.reduceat(self.weights * query[self.local], self.starts)
        return out


def search(blocks: list[Block], query_id: int, terms, weights, k: int):
    """The k best (score, id) of the blocks for one query, its own id left out."""
    local = [b.query(terms, weights) for b in blocks]
    bounds = np.array([b.bound(q) for b, q in zip(blocks, local)])
    best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for i in np.argsort(-bounds, kind="stable"):
        if len(best) == k and bounds[i] < best[-1]:
            break
        block = blocks[i]
        scores = block.scores(local[i])
        fit = block.ids != query_id
        if len(best) == k:
            fit &= scores >= best[-1]
        best_ids = np.concatenate([best_ids, block.ids[fit]])
        best = np.concatenate([best, scores[fit]])
        order = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[order], best[order]
    return best_ids, best


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted vectors to rows of one block each."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            terms, weights = part.column("terms"), part.column("weights")
            lengths = pc.list_value_length(weights).to_numpy(zero_copy_only=False)
            binary = [
                np.ascontiguousarray(x).tobytes()
                for x in (
                    part.column("id").to_numpy(zero_copy_only=False).astype(np.int64),
                    lengths.astype(np.int64),
                    terms.flatten().to_numpy(zero_copy_only=False).astype(np.int32),
                    weights.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], pa.binary()) for x in binary],
                names=["ids", "lengths", "terms", "weights"],
            )


def build_index(vectors: DataFrame) -> DataFrame:
    """Blocks of all rows of ``vectors`` (id, terms, weights), stored reliably.

    Rows with a null id, null terms or null weights take no part. Equal rows count once.
    """
    rows = vectors.select("id", "terms", "weights").na.drop().distinct()
    strongest = F.array_max(
        F.transform(
            F.arrays_zip("terms", "weights"),
            lambda x: F.struct(F.abs(x["weights"]), x["weights"], x["terms"]),
        )
    )
    ordered = rows.withColumn("strongest", strongest)
    width = shuffle_width(rows.sparkSession)
    ordered = ordered.repartitionByRange(width, "strongest", "id")
    ordered = ordered.sortWithinPartitions("strongest", "id").drop("strongest")
    blocks = ordered.mapInArrow(_pack, "ids binary, lengths binary, terms binary, weights binary")
    return cut_lineage(blocks)


def top_k(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The k highest inner products of every query (id, terms, weights) with indexed vectors.

    Returns query_id, rank (from 1), id and score; ties go to the smaller id; fewer rows where
    the index has fewer. Vectors with the query's own id are left out. Queries with null parts
    give nothing, and so does an empty index.
    """
    blocks = index.count()
    parts = -(-blocks // BLOCKS_PER_TASK)
    wanted = queries.select("id", "terms", "weights").na.drop().distinct()
    groups = -(-wanted.count() // QUERIES_PER_TASK)
    result = "query_id long, id long, score long"
    if not blocks or not groups:
        empty = queries.sparkSession.createDataFrame([], result)
        return empty.select("query_id", F.lit(1).alias("rank"), "id", "score")
    place = F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int")
    held = index.withColumn("part", place)
    held = held.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = wanted.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        built = [
            Block(
                np.frombuffer(r["ids"], np.int64),
                np.frombuffer(r["lengths"], np.int64),
                np.frombuffer(r["terms"], np.int32),
                np.frombuffer(r["weights"], np.int64),
            )
            for r in left.to_pylist()
        ]
        out = [[], [], []]
        for r in right.to_pylist() if built else ():
            terms, weights = np.array(r["terms"], np.int32), np.array(r["weights"], np.int64)
            ids, scores = search(built, r["id"], terms, weights, k)
            for column, values in zip(out, ([r["id"]] * len(ids), ids, scores)):
                column.extend(int(v) for v in values)
        names = ["query_id", "id", "score"]
        return pa.table([pa.array(x, pa.int64()) for x in out], names=names)

    found = held.groupBy("part", "group").cogroup(asked.groupBy("part", "group"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        found.applyInArrow(score, result)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )
