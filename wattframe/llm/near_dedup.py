"""MinHash near-duplicates: one-permutation hashing with optimal densification.

The hashes of a text's word shingles fall into bins, each bin keeps its least hash, and an empty
bin takes over that of a bin chosen by a fixed random order (the same for all texts). Bands of
bins are buckets. In each bucket one text is the centre of a star, and only the star's edges are
candidates; they are confirmed on the full shingle sets. Buckets that still hold several
components get another centre in the next round. Where several components are left after the last,
pairs between them are confirmed too unless they cannot be links: bit maps bound how much two
small sets have in common, without error, and of large sets one bit of each bin is kept, which
estimates it. Texts with equal sets are one node.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.blocks import confirm_stars, deal_blocks, runs
from wattframe.llm.common import (
    WordHasher,
    cut_lineage,
    free_name,
    mix,
    shingle_set,
    texts,
)
from wattframe.llm.graph import components

SHINGLE, PERCENT = 5, 75
BINS = 2048
BANDS, ROWS = 32, 4
#: Pairs whose smaller set has up to so many shingles are refused by their bit maps only.
MAPPED = 1024
#: Sets that may be in such a pair have a bit map.
_MAPPED_MOST = MAPPED * 100 // PERCENT
#: Estimated similarity from which a pair of larger sets is confirmed on its full sets: 5 standard
#: errors of the estimate below that of links. A bin agrees by chance in half of the cases.
LEAST_ESTIMATE = 0.675
_PROBES = 48
#: Rounds of stars, each with other centres, before pairs between components are looked at.
STAR_ROUNDS = 1


def _probes() -> np.ndarray:
    """For each bin the bins it asks, in order."""
    bins = np.arange(BINS, dtype=np.uint64)
    tries = np.arange(1, _PROBES + 1, dtype=np.uint64)[:, None]
    return (mix(mix(bins + np.uint64(11)) + tries) % np.uint64(BINS)).astype(np.int64)


PROBES = _probes()
#: Makes bits of equal minima, and orders of full bins, independent from bin to bin.
_SALTS = mix(np.arange(BINS, dtype=np.uint64) + np.uint64(1 << 32))


def bin_minima(found: np.ndarray, n: int = BINS) -> np.ndarray:
    """The least hash of each of the first ``n`` bins, from sorted distinct hashes; empty bins are
    filled."""
    bins = (found >> np.uint64(53)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    filled = np.zeros(BINS, bool)
    filled[bins[first]] = True
    minima = np.zeros(BINS, np.uint64)
    minima[bins[first]] = found[first]
    empty = np.flatnonzero(~filled[:n])
    if len(empty):
        hit = filled[PROBES[:, empty]]
        source = PROBES[hit.argmax(axis=0), empty]
        missed = ~hit.any(axis=0)
        if missed.any():  # few bins are full: each empty one has its own order of all
            full = bins[first]
            order = mix(_SALTS[empty[missed]][:, None] + _SALTS[full])
            source[missed] = full[order.argmin(axis=1)]
        minima[empty] = minima[source]
    return minima[:n]


def band_keys(minima: np.ndarray) -> np.ndarray:
    """A bucket for each band."""
    rows = minima[: BANDS * ROWS].reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        keys = mix(keys + rows[:, i])
    return keys.view(np.int64)


def bit_map(found: np.ndarray) -> bytes:
    """A bit for each of the hashes: as many bits as two maps differ in, as many hashes at least are
    in only one of their sets."""
    bits = np.zeros(BINS, np.uint8)
    bits[(found & np.uint64(BINS - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def bin_bits(minima: np.ndarray) -> bytes:
    """One bit of each bin."""
    return np.packbits((mix(minima ^ _SALTS) & np.uint64(1)).astype(np.uint8)).tobytes()


def _bits(column: pa.ChunkedArray) -> np.ndarray:
    """A row of 64-bit words for each value, zeros for null."""
    joined = b"".join(x or bytes(BINS // 8) for x in column.to_pylist())
    return np.frombuffer(joined, np.uint64).reshape(len(column), -1)


def may_link(
    size: np.ndarray, maps: np.ndarray, bins: np.ndarray, i: int, j: np.ndarray
) -> np.ndarray:
    """Which of the sets ``j`` may be linked with the set ``i``, by sizes and bits."""
    small, large = np.minimum(size[j], size[i]), np.maximum(size[j], size[i])
    fits = 100 * small >= PERCENT * large
    mapped = fits & (small <= MAPPED)
    some = j[mapped]
    # the least number of hashes that only one of the sets has, against the most that a link allows
    apart = np.bitwise_count(maps[some] ^ maps[i]).sum(axis=1, dtype=np.int64)
    fits[mapped] = (100 + PERCENT) * apart <= (100 - PERCENT) * (size[some] + size[i])
    rest = np.flatnonzero(fits & ~mapped)
    apart = np.bitwise_count(bins[j[rest]] ^ bins[i]).sum(axis=1, dtype=np.int64)
    fits[rest] = 1 - 2 * apart / BINS >= LEAST_ESTIMATE
    return fits


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_id, bands, map, bins) of each row; set_id and the rest are null
    where a text has no words, map where its set is too large for one, bins where it is small."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for part, data in texts(batches):
            counts, sets, bands, maps, bins = [], [], [], [], []
            for words in hasher.by_text(data):
                found = shingle_set(words, SHINGLE)
                counts.append(len(found))
                if not len(found):
                    sets.append(None), bands.append(None), maps.append(None), bins.append(None)
                    continue
                large = len(found) > MAPPED
                minima = bin_minima(found, BINS if large else BANDS * ROWS)
                sets.append(xxhash.xxh3_128_digest(found.tobytes()))
                bands.append(band_keys(minima))
                maps.append(bit_map(found) if len(found) <= _MAPPED_MOST else None)
                bins.append(bin_bits(minima) if large else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(sets, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(maps, pa.binary()),
                    pa.array(bins, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_id", "bands", "map", "bins"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        sign,
        "doc_id long, n_shingles long, set_id binary, bands array<long>, map binary, bins binary",
    )


def _sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, found): the sorted shingle hashes of the texts of ``nodes``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))

    def shingle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for part, data in texts(batches):
            sets = [shingle_set(x, SHINGLE).tobytes() for x in hasher.by_text(data)]
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array(sets, pa.binary())], names=["node", "found"]
            )

    return rows.join(nodes, "node", "left_semi").mapInArrow(shingle, "node long, found binary")


def _linked(u: np.ndarray, v: np.ndarray) -> bool:
    both = len(np.intersect1d(u, v, assume_unique=True))
    return 100 * both >= PERCENT * (len(u) + len(v) - both)


def _stars(members: DataFrame, turn: int) -> DataFrame:
    """(a, b): one centre of each bucket, another in each turn, with the members of other
    components. Buckets of the same members have the same centre."""
    members = members.repartition("bucket")  # serves the centres and the join
    order = F.struct(F.xxhash64("node", F.lit(turn)), "node", "component")
    centres = members.groupBy("bucket").agg(F.min(order).alias("centre"))
    edges = members.join(centres, "bucket").filter("component <> centre.component")
    return edges.select(F.col("centre.node").alias("a"), F.col("node").alias("b")).distinct()


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of the nodes that have links, with further links."""
    if labels is not None:
        old = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        links = old.unionAll(links)
    return components(links)


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component, of the buckets that hold several components."""
    labelled = members.join(labels, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")
    )
    labelled = labelled.repartition("bucket")  # serves the minima and the join
    mixed = labelled.groupBy("bucket").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    )
    return labelled.join(mixed.filter("least <> most").select("bucket"), "bucket", "left_semi")


def _between(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of one bucket in different components that may be links, by what ``nodes`` hold.

    A pair that shares several buckets comes from the first."""

    def agree(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["bucket", "left", "right"]):
            n = group.num_rows
            if n < 2:
                continue
            node = group.column("node").to_numpy()
            component = group.column("component").to_numpy()
            size = group.column("n_shingles").to_numpy()
            block = group.column("block").to_numpy()
            bucket = group.column("bucket")[0].as_py()
            one = group.column("left")[0].as_py() == group.column("right")[0].as_py()
            flat = group.column("bands").combine_chunks().flatten()
            bands = flat.to_numpy(zero_copy_only=False).reshape(n, -1)
            maps, bins = _bits(group.column("map")), _bits(group.column("bins"))
            a, b = [], []
            for i in range(n - 1):
                j = np.arange(i + 1, n)
                fits = component[j] != component[i]
                if not one:
                    fits &= block[j] != block[i]
                j = j[fits]
                if not len(j):
                    continue
                shared = bands[j] == bands[i]
                j = j[bands[i][shared.argmax(axis=1)] == bucket]
                j = j[may_link(size, maps, bins, i, j)]
                a.append(np.full(len(j), node[i]))
                b.append(node[j])
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
                )

    dealt = deal_blocks(members, "bucket", "node", more=nodes)
    return dealt.mapInArrow(agree, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the least id connected by
    links of similarity 0.75 or more, its own included) and kept (the id is that one).

    Words are divided by ASCII white space, A-Z lower-cased; sets hold distinct runs of five
    words, or all words of a shorter text. Null and blank texts are linked with nothing. Rows
    that share an id get one component, the least of those of their texts. Rows with a null
    id are linked with nothing, have a null component and are kept. An empty table gives no rows.
    """
    signed = cut_lineage(signatures(docs, doc_id, text))
    known = signed.filter("doc_id is not null and set_id is not null")
    # equal sets: the least id stands for all of them
    firsts = known.groupBy("set_id").agg(F.min("doc_id").alias("node"))
    nodes = known.join(firsts, "set_id").filter("doc_id = node")
    nodes = cut_lineage(nodes.select("node", "n_shingles", "bands", "map", "bins"))
    # one exchange serves the counts and the join
    placed = nodes.select("node", F.explode("bands").alias("bucket")).repartition("bucket")
    shared = placed.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    shared = shared.filter("least <> most").select("bucket")
    members = cut_lineage(placed.join(shared, "bucket").select("bucket", "node"))
    sets = cut_lineage(_sets(docs, members.select("node").distinct(), doc_id, text))
    labels, open_ = None, members.withColumn("component", F.col("node"))
    for turn in range(STAR_ROUNDS):
        links = confirm_stars(_stars(open_, turn), sets, _linked)
        labels = _joined(labels, links)
        open_ = cut_lineage(_mixed(members if turn == 0 else open_.select("bucket", "node"), labels))
    more = confirm_stars(_between(open_, nodes), sets, _linked)
    labels = _joined(labels, more)
    by_set = firsts.join(labels, "node", "left").select(
        "set_id", F.coalesce("component", "node").alias("component_id")
    )
    # an id with several texts has one component
    found = known.select("doc_id", "set_id").join(by_set, "set_id")
    found = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    found = found.withColumnRenamed("doc_id", "found_id")
    rows = signed.select("doc_id", "n_shingles")
    component = F.coalesce("component_id", "doc_id")
    return rows.join(found, rows.doc_id == found.found_id, "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` of one document of each component: that with the least id. Of rows
    that share this id one stays; rows with a null id stay."""
    found = near_duplicates(docs, doc_id, text).filter("kept and doc_id is not null")
    chosen = found.select(F.col("doc_id").alias(doc_id)).distinct()
    number = free_name(docs.columns, "number")
    # the join's partitions serve the numbering
    rows = docs.join(chosen, doc_id, "left_semi")
    rows = rows.withColumn(number, F.row_number().over(Window.partitionBy(doc_id).orderBy(text)))
    rows = rows.filter(F.col(number) == 1).drop(number)
    return rows.unionAll(docs.filter(F.col(doc_id).isNull()))
