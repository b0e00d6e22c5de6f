"""Benchmark decontamination: a prefix-filtered set join of documents and item windows.

A window is a run of consecutive item words; its set are its word shingles. As a document
must hold the whole window, the prefix that is necessary is one shingle: the rarest, by the
number of documents that hold it. Document shingles meet the windows on these, the window's
place must lie inside the document (position and length bounds), and all its words are
compared. The first pass over the documents counts shingles, the second joins.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.llm.common import WordHasher, shingles, texts

WINDOW, SHINGLE = 13, 5
#: Bytes of benchmark text held in memory at a time. A larger benchmark is matched in parts of
#: about this size, one after the other over all documents.
PART_BYTES = 8 << 20
#: Slots of the table that tells most shingles of no window at once.
SLOTS = 1 << 20
#: ASCII bytes that belong to no word: all but digits and letters.
_DIVIDERS = bytes(
    c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)
)
ADDED = ("n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated")


@dataclass
class Windows:
    """Windows of some items, over one array of item words."""

    words: np.ndarray
    start: np.ndarray
    length: np.ndarray
    items: list[list[str]]
    #: by shingle size: sorted shingles, the windows that have them, and where
    tokens: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    slots: dict[int, np.ndarray] = field(default_factory=dict)

    def hits(self, size: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each place in ``found`` that holds a token of this size: place, window, offset."""
        tokens, window, offset = self.tokens[size]
        at = np.flatnonzero(self.slots[size][found >> np.uint64(44)])
        left = np.searchsorted(tokens, found[at], "left")
        count = np.searchsorted(tokens, found[at], "right") - left
        place = np.repeat(at, count)
        entry = np.arange(len(place)) + np.repeat(left - (np.cumsum(count) - count), count)
        return place, window[entry], offset[entry]

    def index(self, rows: dict[int, list[tuple[np.ndarray, int, np.ndarray]]]) -> None:
        """Takes (shingles, window, offsets) by shingle size as tokens."""
        self.tokens, self.slots = {}, {}
        for size, parts in rows.items():
            tokens = np.concatenate([p[0] for p in parts])
            window = np.concatenate([np.full(len(p[0]), p[1]) for p in parts])
            offset = np.concatenate([p[2] for p in parts])
            order = np.argsort(tokens, kind="stable")
            self.tokens[size] = tokens[order], window[order], offset[order]
            self.slots[size] = np.zeros(SLOTS, bool)
            self.slots[size][tokens >> np.uint64(44)] = True

    def sets(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(window, shingle size, its shingles in order)."""
        for w, (start, length) in enumerate(zip(self.start, self.length)):
            size = min(SHINGLE, length)
            yield w, size, shingles(self.words[start : start + length], size)

    def occurrences(self, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and windows of all windows in the document's words."""
        places, windows = [], []
        for size in self.tokens:
            place, window, offset = self.hits(size, shingles(doc, size))
            first = place - offset
            fits = (first >= 0) & (first + self.length[window] <= len(doc))
            first, window = first[fits], window[fits]
            for length in np.unique(self.length[window]):
                same = self.length[window] == length
                a, w = first[same], window[same]
                run = np.arange(length)
                equal = doc[a[:, None] + run] == self.words[self.start[w][:, None] + run]
                equal = equal.all(axis=1)
                places.append(a[equal])
                windows.append(w[equal])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *places]), np.concatenate([none, *windows])


def windows_of(items: Iterable[tuple[str, str]], window: int) -> Windows:
    """The distinct windows of (id, text) items, with the ids of the items that have them."""
    hasher, seen, parts, at = WordHasher(_DIVIDERS), {}, [], 0
    owners: list[set[str]] = []
    start, length = [], []
    for item, text in items:
        found = hasher.by_text([text.encode("utf-8", "surrogatepass")])[0]
        size = min(window, len(found))
        for i in range(len(found) - size + 1 if size else 0):
            w = seen.setdefault(found[i : i + size].tobytes(), len(owners))
            if w == len(owners):
                owners.append(set())
                start.append(at + i)
                length.append(size)
            owners[w].add(item)
        parts.append(found)
        at += len(found)
    flat = np.concatenate([np.zeros(0, np.uint64), *parts])
    return Windows(
        flat,
        np.array(start, np.int64),
        np.array(length, np.int64),
        [sorted(o) for o in owners],
    )


def _document_counts(docs: DataFrame, part: Windows, text: str) -> dict[tuple[int, int], int]:
    """How many documents hold each shingle of the windows."""
    by_size = defaultdict(list)
    for w, size, found in part.sets():
        by_size[size].append(found)
    distinct = {size: np.unique(np.concatenate(f)) for size, f in by_size.items()}
    probe = Windows(part.words, part.start, part.length, part.items)
    probe.index({s: [(f, 0, np.arange(len(f)))] for s, f in distinct.items()})

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(_DIVIDERS)
        totals = {size: np.zeros(len(f), np.int64) for size, f in distinct.items()}
        for _, data in texts(batches, text):
            for doc in hasher.by_text(data):
                for size, total in totals.items():
                    _, _, which = probe.hits(size, shingles(doc, size))
                    total[np.unique(which)] += 1
        for size, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), size, np.int32)),
                    pa.array(some),
                    pa.array(total[some]),
                ],
                names=["size", "shingle", "docs"],
            )

    counted = docs.select(text).mapInArrow(count, "size int, shingle long, docs long")
    counted = counted.groupBy("size", "shingle").agg(F.sum("docs").alias("docs"))
    # at most a row for each distinct shingle of this part of the benchmark
    return {(r["size"], int(distinct[r["size"]][r["shingle"]])): r["docs"] for r in counted.collect()}


def benchmark_parts(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> list[Windows]:
    """The benchmark's windows in parts of bounded size, indexed by their rarest shingles."""
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("body")
    )
    items = items.na.drop().distinct()
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n = -(-size // PART_BYTES)
    parts = []
    for i in range(n):
        some = items.filter(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == i)
        part = windows_of(((r["item"], r["body"]) for r in some.toLocalIterator()), window)
        if not len(part.start):
            continue
        held = _document_counts(docs, part, text)
        rows = defaultdict(list)
        for w, size_, found in part.sets():
            rarity = [held.get((size_, int(x)), 0) for x in found]
            rare = int(np.argmin(rarity))
            if rarity[rare]:  # else no document has all of its shingles
                rows[size_].append((found[rare : rare + 1], w, np.array([rare])))
        part.index(rows)
        parts.append(part)
    return parts


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    share: int = 20,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside an occurrence of an item window), n_items and
    items (ids of items with such windows, as sorted strings), items_sha256 (of the ids, joined
    by commas) and contaminated (n_hit > 0 and share * n_hit >= n_words).

    A window is ``window`` consecutive words of an item, or all of a shorter item. Items with a
    null id, a null text or no words have none; repeated items count once. A null or empty text has
    no words and is clean. Every row keeps its columns; those named like the new ones are
    replaced. Empty tables give clean documents, or no rows.
    """
    rows = docs.drop(*ADDED)
    parts = benchmark_parts(docs, benchmark, window, text, item_id, item_text)
    carried = [
        T.StructField("_hit_places", T.BinaryType()),
        T.StructField("_hit_items", T.ArrayType(T.StringType())),
        T.StructField("_hit_words", T.LongType()),
    ]
    names = [f.name for f in carried]
    own = rows.columns
    schema = T.StructType([*rows.schema.fields, *carried])

    def search(part: Windows | None):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher = WordHasher(_DIVIDERS)
            for some, data in texts(batches, text):
                before = [[None] * len(data)] * 2
                if names[0] in some.schema.names:
                    before = [some.column(c).to_pylist() for c in names[:2]]
                places, items, counts = [], [], []
                for doc, old, old_items in zip(hasher.by_text(data), *before):
                    counts.append(len(doc))
                    covered = np.zeros(len(doc) + 1, np.int64)
                    spans = np.frombuffer(old or b"", np.int64).reshape(-1, 2)
                    found = set(old_items or ())
                    if part is not None:
                        place, which = part.occurrences(doc)
                        if len(place):
                            ends = place + part.length[which]
                            spans = np.concatenate([spans, np.stack([place, ends], 1)])
                            for w in np.unique(which):
                                found.update(part.items[w])
                    np.add.at(covered, spans[:, 0], 1)
                    np.add.at(covered, spans[:, 1], -1)
                    inside = np.concatenate([[0], np.cumsum(covered)[:-1] > 0, [0]])
                    edges = np.diff(inside.astype(np.int8))
                    merged = np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], 1)
                    places.append(merged.astype(np.int64).tobytes())
                    items.append(sorted(found))
                columns = [
                    pa.array(places, pa.binary()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(counts, pa.int64()),
                ]
                kept = [some.column(some.schema.get_field_index(c)) for c in own]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*own, *names])

        return run

    for part in parts or [None]:
        rows = rows.mapInArrow(search(part), schema)

    def summary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(batch.schema.get_field_index(names[0])).to_pylist()
            items = batch.column(batch.schema.get_field_index(names[1])).to_pylist()
            hit = []
            for x in places:
                spans = np.frombuffer(x, np.int64).reshape(-1, 2)
                hit.append(int((spans[:, 1] - spans[:, 0]).sum()))
            digests = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
            n_words = batch.column(batch.schema.get_field_index(names[2])).to_pylist()
            kept = [batch.column(batch.schema.get_field_index(c)) for c in own]
            columns = [
                pa.array(n_words, pa.int64()),
                pa.array(hit, pa.int64()),
                pa.array([len(i) for i in items], pa.int64()),
                pa.array(items, pa.list_(pa.string())),
                pa.array(digests, pa.string()),
                pa.array([h > 0 and share * h >= n for h, n in zip(hit, n_words)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*own, *ADDED])

    result = T.StructType(
        [
            *docs.drop(*ADDED).schema.fields,
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("n_items", T.LongType()),
            T.StructField("items", T.ArrayType(T.StringType())),
            T.StructField("items_sha256", T.StringType()),
            T.StructField("contaminated", T.BooleanType()),
        ]
    )
    return rows.mapInArrow(summary, result)
