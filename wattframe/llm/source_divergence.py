"""Source divergence audit: how differently the sources of each language use its words.

A document is an exact sparse vector: its terms and how often it has each. Each language's
vocabulary is what a CountVectorizer with a minDF keeps whose vocabSize is the largest integer: every
term in at least ``min_df`` of the language's documents. Vectors are summed by source and by
language, and every two sources of a language are compared on these sums, over the terms that occur
in one of them; all other terms give the same known amount.

A CountVectorizer itself would collect each vocabulary on the driver and send it to all tasks.
Vocabularies grow with the corpus, so here they stay a table: a vector's indices are the terms, and a
vocabulary is applied by joining. Summing comes first, as terms that go do not change other sums.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.blocks import runs
from wattframe.llm.common import shuffle_width, stored, texts

MIN_DF = 10
#: Parts that a share of all occurrences is counted in.
UNIT = 1_000_000_000
#: Ranks of the terms that tell a source from its language.
TOP_TERMS = 10
#: Sources that are compared together, about.
BLOCK_SOURCES = 64
#: Bytes of a text whose words are looked at together.
PIECE_BYTES = 1 << 20
#: Numbers in a matrix of sources and terms, about.
_CELLS = 1 << 20
# terms are A-Z, lower-cased, a-z and every character beyond ASCII
_SIGNS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` cut at blanks, so that a long text's words are never all in memory."""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE_BYTES)
        end = len(data) if end < 0 else end
        yield data[start:end]
        start = end


def document_vectors(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """(lang, source, vector) of every document: ``vector`` is an array of (term, count), each term
    once. Null languages, sources and texts are empty; other columns go. A text without terms has an
    empty vector. Every row is a document, also when rows repeat."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data in texts(batches):
            offsets, terms, counts = [0], [], []
            for body in data:
                found: Counter = Counter()
                for piece in _pieces(body.translate(_SIGNS)):
                    found.update(piece.split())
                terms.extend(found)
                counts.extend(found.values())
                offsets.append(len(terms))
            pairs = pa.StructArray.from_arrays(
                [pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
                names=["term", "count"],
            )
            vectors = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), vectors], names=["lang", "source", "vector"]
            )

    return rows.mapInArrow(
        count, "lang string, source string, vector array<struct<term: string, count: long>>"
    )


def summed_vectors(vectors: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): the sum of each source's vectors, and in how many of its
    documents a term is. Summed in each task before rows are exchanged, so a hot source or term is a
    row for each task."""
    return (
        vectors.select("lang", "source", F.inline("vector"))
        .groupBy("lang", "source", "term")
        .agg(F.sum("count").alias("count"), F.count("*").alias("docs"))
    )


def vocabulary(sums: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """(lang, term, total): the terms in at least ``min_df`` documents of a language, and how often
    the language has them."""
    terms = sums.groupBy("lang", "term").agg(
        F.sum("count").alias("total"), F.sum("docs").alias("df")
    )
    return terms.filter(F.col("df") >= min_df).drop("df")


def _share(count: Column, occurrences: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (occurrences + 2 * terms)), in exact decimals."""
    exact = lambda c: c.cast("decimal(38,0)")
    upper = exact(F.lit(UNIT)) * exact(count + 2)
    lower = exact(occurrences + 2 * terms)
    # there are no shares where there are no terms
    return F.when(terms == 0, 1).otherwise(1 + F.call_function("div", upper, lower)).cast("long")


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _group_table(docs: DataFrame, kept: DataFrame, words: DataFrame, lang: str, source: str) -> DataFrame:
    """A row for each (lang, source) of the documents: n and lang_n (occurrences of kept terms), v
    (kept terms), absent (the share of a term that the source doesn't have), block and blocks."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    groups = docs.select(empty(lang).alias("lang"), empty(source).alias("source")).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    per_lang = words.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK_SOURCES).cast("int").alias("blocks"))
    rows = groups.join(sizes, ["lang", "source"], "left").join(per_lang, "lang", "left")
    rows = rows.na.fill(0, ["n", "v", "lang_n"]).join(blocks, "lang")
    return rows.withColumns(
        {
            "absent": _share(F.lit(0), F.col("n"), F.col("v")),
            "block": F.pmod(F.xxhash64("source"), "blocks").cast("int"),
        }
    )


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, both ways.

    Sources are dealt to blocks and terms to buckets. A cell holds the shares of two blocks in one
    bucket and gives a sum for each two sources; there are about as many cells as partitions.
    """
    width = shuffle_width(groups.sparkSession)
    cell = ["lang", "left", "right", "bucket"]
    buckets = F.ceil(width / (F.col("blocks") * (F.col("blocks") + 1) / 2))

    def dealt(rows: DataFrame, bucket: Column) -> DataFrame:
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        rows = rows.withColumns({"_other": other, "bucket": bucket})
        return rows.select(
            "lang",
            F.least("block", "_other").alias("left"),
            F.greatest("block", "_other").alias("right"),
            F.col("bucket").cast("int").alias("bucket"),
            "term",
            "source",
            "block",
            "share",
            "v",
        )

    bases = groups.withColumns({"term": F.lit(None).cast("string"), "share": F.col("absent")})
    bases = dealt(bases, F.explode(F.sequence(F.lit(0), buckets.cast("int") - 1)))
    own = shares.select("lang", "source", "term", "share", "block", "blocks", "v")
    rows = bases.unionAll(dealt(own, F.pmod(F.xxhash64("term"), buckets.cast("int"))))
    rows = rows.repartition(width, *cell).sortWithinPartitions(*cell, F.asc_nulls_first("term"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, cell):
            found = list(_compare_cell(run))
            langs = [run.column("lang")[0].as_py()] * len(found)
            columns = list(zip(*found)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs, pa.string()),
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.int64()),
                ],
                names=["lang", "source", "item", "value"],
            )

    parts = rows.mapInArrow(compare, "lang string, source string, item string, value long")
    found = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.explode(
        F.array(
            F.struct(F.col("source"), F.col("item")),
            F.struct(F.col("item").alias("source"), F.col("source").alias("item")),
        )
    )
    return found.select("lang", both.alias("pair"), "value").select("lang", "pair.*", "value")


def _compare_cell(run: pa.Table) -> Iterator[tuple[str, str, int]]:
    """(source, other, sum over the cell's terms) of the cell's sources. The first bucket also
    counts every kept term as absent from both; other sums are the differences from that."""
    n = run.column("term").null_count
    base = run.slice(0, n)
    names = base.column("source").to_pylist()
    at = {name: i for i, name in enumerate(names)}
    absent = base.column("share").to_numpy()
    block = base.column("block").to_numpy()
    left, right, bucket = (run.column(c)[0].as_py() for c in ("left", "right", "bucket"))
    pairs = [
        (i, j)
        for i, j in itertools.product(np.flatnonzero(block == left), np.flatnonzero(block == right))
        if left != right or i < j
    ]
    if not pairs:
        return
    one, two = np.array(pairs).T
    nothing = _divergence(absent[one], absent[two])
    sums = nothing * base.column("v")[0].as_py() if bucket == 0 else np.zeros(len(pairs), np.int64)
    rows = run.slice(n)
    if rows.num_rows:
        codes = rows.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        who = np.array([at[s] for s in rows.column("source").to_pylist()])
        share = rows.column("share").to_numpy()
        # terms come in order, so their codes rise
        step = max(1, _CELLS // len(names))
        for first in range(0, int(codes[-1]) + 1, step):
            some = slice(*np.searchsorted(codes, [first, first + step]))
            terms = min(step, int(codes[-1]) + 1 - first)
            matrix = np.repeat(absent[:, None], terms, axis=1)
            matrix[who[some], codes[some] - first] = share[some]
            for k, (i, j) in enumerate(pairs):
                sums[k] += _divergence(matrix[i], matrix[j]).sum() - terms * nothing[k]
    for k, (i, j) in enumerate(pairs):
        yield names[i], names[j], int(sums[k])


def audit(
    docs: DataFrame,
    min_df: int = MIN_DF,
    top_terms: int = TOP_TERMS,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of each language.

    Part ``pair``: the other sources of the language by falling divergence. Part ``term``: the
    ``top_terms`` terms that the source uses more than its language does, by falling divergence from
    it. A term's share is p = 1 + floor(10^9 * (count + 2) / (occurrences + 2 * kept terms)); the
    divergence of p and q is floor((p - q)^2 / (p + q)), summed over kept terms for pairs. All
    numbers are exact integers.

    Nulls are empty names and texts; sources without terms take part in pairs. Languages that keep
    no term have pairs of value 0. Ties are in the items' UTF-8 order. Every row counts, repeated
    rows too; other columns are not looked at. An empty table gives no rows.
    """
    sums = stored(summed_vectors(document_vectors(docs, lang, source, text)))
    words = stored(vocabulary(sums, min_df))
    kept = stored(sums.drop("docs").join(words, ["lang", "term"]))
    groups = stored(_group_table(docs, kept, words, lang, source))
    shares = kept.join(groups, ["lang", "source"]).withColumn(
        "share", _share(F.col("count"), F.col("n"), F.col("v"))
    )
    places = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(groups, shares).withColumn("rank", F.row_number().over(places))
    whole = _share(F.col("total"), F.col("lang_n"), F.col("v"))
    terms = shares.withColumn("whole", whole).filter(F.col("share") > F.col("whole"))
    value = F.expr("(share - whole) * (share - whole) div (share + whole)")
    terms = terms.select("lang", "source", F.col("term").alias("item"), value.alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(places)).filter(F.col("rank") <= top_terms)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair"))
        .select(columns)
        .unionAll(terms.withColumn("part", F.lit("term")).select(columns))
    )
