"""What several text operators share: word hashing, Arrow batches, held-out rows."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.checkpoints import cut_lineage, ensure_checkpoint_dir, shared_folder

__all__ = ["cut_lineage", "ensure_checkpoint_dir"]

#: Entries after which a cache of words is emptied; it bounds a worker's memory.
CACHE_ENTRIES = 150_000
#: Bytes of text that a task looks at together.
SLICE_BYTES = 1 << 20
MASK = (1 << 64) - 1


def parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(rows: DataFrame) -> DataFrame:
    """``rows`` written once as a table in the shared folder, and read from there."""
    path = shared_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Cached(dict):
    """``make(key)`` of every key seen, at most ``CACHE_ENTRIES`` of them."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[key] = self.make(key)
        return value


#: Bytes that divide words: ASCII white space.
BLANKS = bytes([9, 10, 11, 12, 13, 32])
_STEP = 0x9E3779B97F4A7C15


class WordHasher:
    """Hashes of all words of some texts at once, A-Z lower-cased.

    ``dividers`` are the bytes that belong to no word. A word's hash is a polynomial in scrambled
    bytes modulo 2^64, scrambled again.
    """

    def __init__(self, dividers: bytes = BLANKS):
        self.codes = mix(np.arange(1, 257, dtype=np.uint64))
        self.codes[list(dividers)] = 0
        self.powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __call__(self, joined: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where each word begins, and its hash."""
        codes = self.codes[np.frombuffer(joined.lower(), np.uint8)]
        inside = codes != 0
        inside[1:] &= codes[:-1] == 0
        starts = np.flatnonzero(inside)
        if not len(starts):
            return starts, np.zeros(0, np.uint64)
        n = len(codes)
        if len(self.powers[0]) < n:
            for i, base in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                self.powers[i] = np.cumprod(steps, dtype=np.uint64)
        codes *= self.powers[0][:n]
        return starts, mix(np.add.reduceat(codes, starts) * self.powers[1][starts])

    def by_text(self, data: list[bytes | None]) -> list[np.ndarray]:
        """The hashes of each text's words."""
        found = [x or b"" for x in data]
        starts, hashes = self(b"\n".join(found))
        ends = np.cumsum([len(x) + 1 for x in found])
        return np.split(hashes, np.searchsorted(starts, ends[:-1])) if found else []


def hashed(words: list[bytes], cache: Cached) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = mix(out + words[i : i + n] + np.uint64(i + 1))
    return out


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct shingles; all words as one if there are fewer than ``size``."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(shingles(words, min(size, len(words))))


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``most`` bytes of text; a longer text comes alone."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.array([x or 0 for x in pc.binary_length(column).to_pylist()], np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def give_back() -> None:
    """Hand memory that this Python worker has freed back to the system.

    Workers are kept for later tasks, often more of them than cores, and what each holds counts."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def texts(
    batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Small slices of the batches with the bytes of their texts."""
    for batch in batches:
        for part in slices(batch, text, most):
            yield part, text_bytes(part.column(part.schema.get_field_index(text)))
            del part
        del batch  # or the next one is read beside it
        give_back()


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, or a longer one that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def shuffle_width(spark: SparkSession) -> int:
    """Partitions that a shuffle uses here."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
