"""Suffix-array dedup: bytes of passages that an earlier document also holds go.

Passages are windows of a fixed number of bytes. The least hashed run of bytes in a window is
its anchor, so equal windows have equal anchors; neighbouring windows with one anchor form a
segment. Anchors, hashed, deal the segments into shards that see all windows of equal text.
Equal segments are settled by their hashes; of each different one the first goes, with its
bytes, to a suffix array of its shard, where windows of equal text are neighbours.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import cut_lineage, mix, shuffle_width, texts
from wattframe.llm.suffix_array import permuted_common_prefixes, suffix_array

WINDOW, ANCHOR = 50, 20
_REACH = WINDOW - ANCHOR + 1
_BASE, _SETTLED = 0x9E3779B97F4A7C15 | 1, 0xFFFF
#: A document is told by its id and, as ids may repeat, 32 bits of its text's hash.
_OWNER = [("doc", "<i8"), ("tag", "<u4")]
_SEGMENT = np.dtype([("anchor", "<u8"), ("text", "<u8"), *_OWNER, ("start", "<u4"), ("windows", "u1")])
_DECISION = np.dtype([*_OWNER, ("start", "<u4"), ("windows", "<u4"), ("shard", "<u2")])
#: Bytes of a hash that are sent. Fewer of an anchor's only bring unlike segments together.
_SENT = {"anchor": 4, "text": 7}
#: Suffix arrays for each shard of anchors.
FINER = 16
_SEPARATOR = 0xFF  # no byte of UTF-8


def _powers(n: int, kept: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    if len(kept.get("up", ())) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(n, base & ((1 << 64) - 1), np.uint64)
            steps[0] = 1
            kept[name] = np.cumprod(steps, dtype=np.uint64)
    return kept["up"][:n], kept["down"][:n]


def segments(data: np.ndarray, ends: np.ndarray, kept: dict) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor and hash of each segment of joined texts.

    ``ends`` are where the texts end in ``data``; windows lie inside one text. Positions are
    those of ``data``."""
    n = len(data)
    if n < WINDOW:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(n, "<u8", padded, strides=(1,))
    grams = n - ANCHOR + 1
    gram = mix(words[:grams] * np.uint64(_BASE) + words[8 : 8 + grams])
    gram = mix(gram ^ words[ANCHOR - 8 : ANCHOR - 8 + grams])
    key = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)
    width = 1
    while 2 * width <= _REACH:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < _REACH:
        key = np.minimum(key[: width - _REACH], key[_REACH - width :])
    anchor = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)  # for each window
    crossing = np.zeros(len(anchor) + 1, np.int64)
    for end in ends[:-1]:
        crossing[max(0, end - WINDOW + 1)] += 1
        crossing[min(end, len(anchor))] -= 1
    at = np.flatnonzero(np.cumsum(crossing[:-1]) == 0)
    if not len(at):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(at)))
    first = at[heads]
    up, down = _powers(n + 1, kept)
    scrambled = mix(data.astype(np.uint64) + np.uint64(1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(scrambled * up[:n], dtype=np.uint64)])
    body = (sums[first + count + WINDOW - 1] - sums[first]) * down[first]
    return first, count, gram[anchor[first]], mix(body + count.astype(np.uint64))


def _pack(entries: np.ndarray) -> bytes:
    """Columns one after the other, hashes shortened, compressed."""
    columns = []
    for name in entries.dtype.names:
        column = np.ascontiguousarray(entries[name])
        if name in _SENT:
            columns.append(column.view(np.uint8).reshape(-1, 8)[:, 8 - _SENT[name] :].tobytes())
        elif name in ("doc", "start"):
            columns.append(np.diff(column, prepend=column.dtype.type(0)).tobytes())
        else:
            columns.append(column.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(columns))


def _unpack(data: bytes, kind: np.dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    sizes = [_SENT.get(n, kind[n].itemsize) for n in kind.names]
    n, at = len(raw) // sum(sizes), 0
    out = np.zeros(n, kind)
    for name, size in zip(kind.names, sizes):
        part = raw[at : at + n * size]
        at += n * size
        if name in _SENT:
            wide = np.zeros((n, 8), np.uint8)
            wide[:, 8 - size :] = part.reshape(n, size)
            out[name] = wide.reshape(-1).view("<u8")
        else:
            column = np.frombuffer(part.tobytes(), kind[name])
            if name in ("doc", "start"):
                column = np.cumsum(column, dtype=column.dtype)
            out[name] = column
    return out


def _owner_part(doc: np.ndarray, parts: int) -> np.ndarray:
    return (mix(doc.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _dealt(entries: np.ndarray, part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The entries of each part, by owner and place."""
    order = np.lexsort((entries["start"], entries["tag"], entries["doc"], part))
    entries, part = entries[order], part[order]
    heads = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(heads, np.append(heads[1:], len(part))):
        yield int(part[a]), entries[a:b]


def _firsts(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries sorted by anchor, text and owner, and which are of their text's first owner id."""
    order = np.lexsort((entries["start"], entries["tag"], entries["doc"], entries["text"], entries["anchor"]))
    entries = entries[order]
    new = np.ones(len(entries), bool)
    new[1:] = (entries["anchor"][1:] != entries["anchor"][:-1]) | (
        entries["text"][1:] != entries["text"][:-1]
    )
    group = np.cumsum(new) - 1
    least = entries["doc"][np.flatnonzero(new)][group]
    return entries, entries["doc"] == least


def _decide(entries: np.ndarray, settled: np.ndarray) -> np.ndarray:
    out = np.zeros(len(entries), _DECISION)
    for name in ("doc", "tag", "start", "windows"):
        out[name] = entries[name]
    out["shard"] = settled
    return out


def _scan(rows: DataFrame, shards: int) -> DataFrame:
    """(part, kind, data): segments for each shard (kind 0), and segments that an earlier
    document of the same few texts has (kind 1)."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for part, data in texts(batches):
            data = [x or b"" for x in data]
            ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum([len(x) for x in data])
            first, count, anchor, body = segments(
                np.frombuffer(b"".join(data), np.uint8), ends, kept
            )
            which = np.searchsorted(ends, first, "right")
            tags = np.array([xxhash.xxh3_64_intdigest(x) & 0xFFFFFFFF for x in data], np.uint32)
            entries = np.zeros(len(first), _SEGMENT)
            entries["anchor"], entries["text"] = anchor, body
            entries["doc"], entries["tag"] = ids[which], tags[which]
            entries["start"] = first - (np.append([0], ends[:-1])[which] if len(ends) else 0)
            entries["windows"] = count
            entries, own = _firsts(entries)
            rows_ = []
            some = entries[own]
            for p, x in _dealt(some, (some["anchor"] % np.uint64(shards)).astype(np.int64)):
                rows_.append((p, 0, _pack(x)))
            gone = _decide(entries[~own], _SETTLED)
            for p, x in _dealt(gone, _owner_part(gone["doc"], shards)):
                rows_.append((p, 1, _pack(x)))
            columns = list(zip(*rows_)) or [[], [], []]
            kinds = [pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "kind", "data"]
            )

    return rows.mapInArrow(scan, "part int, kind int, data binary")


def _settle(scanned: DataFrame, shards: int) -> DataFrame:
    """(part, data): decisions on segments, dealt by their owner. Segments that an earlier
    document has are settled; the first ones of anchors with different segments name the shard
    that has to compare them."""

    def settle(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard, own = key[0].as_py(), {0: [], 1: []}
        for kind, data in zip(table.column("kind").to_pylist(), table.column("data").to_pylist()):
            own[kind].append(_unpack(data, _SEGMENT if kind == 0 else _DECISION))
        out = [np.zeros(0, _DECISION), *own[1]]
        if own[0]:
            entries, first = _firsts(np.concatenate(own[0]))
            out.append(_decide(entries[~first], _SETTLED))
            entries = entries[first]
            # one owner of each text; its other places and equal rows are the same document
            new = np.ones(len(entries), bool)
            new[1:] = (entries["anchor"][1:] != entries["anchor"][:-1]) | (
                entries["text"][1:] != entries["text"][:-1]
            )
            group = np.cumsum(np.diff(entries["anchor"], prepend=~entries["anchor"][:1]) != 0) - 1
            several = np.bincount(group, new)[group] > 1
            entries = entries[several]
            part = mix(entries["anchor"]) % np.uint64(max(1, min(FINER, _SETTLED // shards)))
            out.append(_decide(entries, shard + shards * part.astype(np.int64)))
        all_ = np.concatenate(out)
        rows = [(p, _pack(x)) for p, x in _dealt(all_, _owner_part(all_["doc"], shards))]
        columns = list(zip(*rows)) or [[], []]
        return pa.table(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())],
            names=["part", "data"],
        )

    return scanned.groupBy("part").applyInArrow(settle, "part int, data binary")


def _texts_by_owner(docs: DataFrame, shards: int) -> DataFrame:
    """(part, doc_ids, sizes, bodies): texts dealt by their id, some in one compressed piece."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        for batch, data in texts(batches):
            ids = batch.column("doc_id").to_pylist()
            known = np.array([i if i is not None else j for j, i in enumerate(ids)], np.int64)
            part = _owner_part(known, shards)
            rows: list[list] = [[], [], [], []]
            for p in np.unique(part).tolist():
                own = np.flatnonzero(part == p).tolist()
                some = [data[i] or b"" for i in own]
                values = (
                    p,
                    [ids[i] for i in own],
                    [len(x) for x in some],
                    compressor.compress(b"".join(some)),
                )
                for column, value in zip(rows, values):
                    column.append(value)
            kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "doc_ids", "sizes", "bodies"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, k) for r, k in zip(rows, kinds)], names=names
            )

    return docs.mapInArrow(pack, "part int, doc_ids array<long>, sizes array<long>, bodies binary")


def _owned(left: pa.Table, right: pa.Table) -> Iterator[tuple[int | None, bytes, int, np.ndarray]]:
    """Each text with its tag and the decisions on it."""
    found = [_unpack(x, _DECISION) for x in right.column("data").to_pylist()]
    decisions = np.concatenate([np.zeros(0, _DECISION), *found])
    decisions = decisions[np.argsort(decisions["doc"], kind="stable")]
    docs = np.ascontiguousarray(decisions["doc"])
    decompressor = zstandard.ZstdDecompressor()
    for batch in left.to_batches(max_chunksize=1):
        row = batch.to_pylist()[0]
        joined, at = decompressor.decompress(row["bodies"]), 0
        known = np.array([0 if i is None else i for i in row["doc_ids"]], np.int64)
        begins = np.searchsorted(docs, known, "left").tolist()
        ends = np.searchsorted(docs, known, "right").tolist()
        for doc, size, a, b in zip(row["doc_ids"], row["sizes"], begins, ends):
            text = joined[at : at + size]
            at += size
            tag = xxhash.xxh3_64_intdigest(text) & 0xFFFFFFFF
            own = decisions[:0]
            if doc is not None:
                own = decisions[a:b]
                own = own[own["tag"] == tag]
            yield doc, text, tag, own


def _extract(bodies: DataFrame, decisions: DataFrame, shards: int) -> DataFrame:
    """(part, finer, doc, tag, start, body): segments with their bytes, for the shard that
    compares them."""

    def extract(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[list] = [[], [], [], [], [], []]
        for doc, text, tag, own in _owned(left, right):
            own = own[own["shard"] != _SETTLED]
            for start, windows, shard in zip(
                own["start"].tolist(), own["windows"].tolist(), own["shard"].tolist()
            ):
                body = text[start : start + windows + WINDOW - 1]
                values = (shard % shards, shard // shards, doc, tag, start, body)
                for column, value in zip(rows, values):
                    column.append(value)
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["part", "finer", "doc", "tag", "start", "body"]
        return pa.table([pa.array(r, k) for r, k in zip(rows, kinds)], names=names)

    grouped = bodies.groupBy("part").cogroup(decisions.groupBy("part"))
    schema = "part int, finer int, doc long, tag long, start long, body binary"
    return grouped.applyInArrow(extract, schema)


def repeated_windows(
    bodies: list[bytes], docs: np.ndarray, window: int = WINDOW
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Body, first and number of neighbouring windows that a smaller doc also has."""
    data = bytes([_SEPARATOR]).join(bodies) + bytes([_SEPARATOR])
    text = np.frombuffer(data, np.uint8)
    sizes = np.array([len(x) for x in bodies], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    order = suffix_array(text, window)
    shared = permuted_common_prefixes(text, order, window)
    body = np.repeat(np.arange(len(bodies)), sizes + 1)
    whole = np.arange(len(text)) + window <= (begin + sizes)[body]
    order = order[whole[order]]
    if not len(order):
        return (np.zeros(0, np.int64),) * 3
    # what stands between two equal windows is such a window too
    heads = np.flatnonzero(shared[order] < window)
    if not len(heads) or heads[0] != 0:
        heads = np.concatenate([[0], heads])
    least = np.minimum.reduceat(docs[body[order]], heads)
    counts = np.diff(np.append(heads, len(order)))
    gone = np.sort(order[docs[body[order]] > np.repeat(least, counts)])
    if not len(gone):
        return (np.zeros(0, np.int64),) * 3
    new = np.ones(len(gone), bool)
    new[1:] = (gone[1:] != gone[:-1] + 1) | (body[gone[1:]] != body[gone[:-1]])
    first = np.flatnonzero(new)
    owner = body[gone[first]]
    return owner, gone[first] - begin[owner], np.diff(np.append(first, len(gone)))


def _compare(extracted: DataFrame, shards: int) -> DataFrame:
    """(part, data): decisions on windows found by the suffix arrays of each shard."""

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = [np.zeros(0, _DECISION)]
        for finer in pc.unique(table.column("finer")).to_pylist():
            some = table.filter(pc.equal(table.column("finer"), finer))
            doc = some.column("doc").to_numpy()
            which, first, count = repeated_windows(some.column("body").to_pylist(), doc)
            own = np.zeros(len(which), _DECISION)
            own["doc"], own["tag"] = doc[which], some.column("tag").to_numpy()[which]
            own["start"] = some.column("start").to_numpy()[which] + first
            own["windows"], own["shard"] = count, _SETTLED
            found.append(own)
        out = np.concatenate(found)
        rows = [(p, _pack(x)) for p, x in _dealt(out, _owner_part(out["doc"], shards))]
        columns = list(zip(*rows)) or [[], []]
        return pa.table(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())],
            names=["part", "data"],
        )

    return extracted.groupBy("part").applyInArrow(compare, "part int, data binary")


def remove_repeated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal runs of removed
    bytes) and kept_sha256 of the bytes left; ``with_text`` adds them as ``kept``.

    A byte goes if it lies in a string of 50 bytes that also starts in a document with a smaller
    id, judged on the input. A null text is empty. Rows with a null id take no part and keep all;
    rows that share an id don't remove each other's bytes. An empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shards = min(shuffle_width(docs.sparkSession), _SETTLED - 1)
    scanned = _scan(rows.filter("doc_id is not null and text is not null"), shards)
    decisions = cut_lineage(_settle(scanned, shards))
    bodies = _texts_by_owner(rows, shards)
    compared = cut_lineage(_compare(_extract(bodies, decisions, shards), shards))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], [], []]
        for doc, body, _, own in _owned(left, right):
            own = own[own["shard"] == _SETTLED]
            edges = np.zeros(len(body) + 1, np.int64)
            np.add.at(edges, own["start"], 1)
            np.add.at(edges, own["start"].astype(np.int64) + own["windows"] + WINDOW - 1, -1)
            gone = np.cumsum(edges[:-1]) > 0
            spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
            kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
            digest = hashlib.sha256(kept).hexdigest()
            for c, v in zip(out, (doc, len(body), int(gone.sum()), spans, digest, kept)):
                c.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        n = 6 if with_text else 5
        return pa.table([pa.array(c, k) for c, k in zip(out[:n], kinds)], names=names[:n])

    both = decisions.unionAll(compared)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    grouped = bodies.groupBy("part").cogroup(both.groupBy("part"))
    return grouped.applyInArrow(cut, schema + (", kept binary" if with_text else ""))
