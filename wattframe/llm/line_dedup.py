"""Line dedup: an exact set-similarity join of lines.

A line is the set of its words, ordered by rarity in the corpus. Lines whose similarity reaches
the threshold share a word in their prefixes, so these words bring candidates together;
the lengths, the places of the shared word and a small bit map of each set then bound the
overlap from above. What is left is verified on the whole sets. Of lines with equal
sets only the first is joined, and a line needs one earlier match to go: the join lists for each line
some of its earlier candidates in a mixed order, which are verified in growing portions. Lines
that have neither a match nor seen all their candidates are joined again, for the next ones, until
none is left. So no task or table ever holds all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.llm.common import (
    BLANKS,
    WordHasher,
    cut_lineage,
    give_back,
    mix,
    shuffle_width,
    texts,
)

#: Every line that has a word takes part, unless callers leave short ones out.
MIN_WORDS = 1
#: Similarity 3/4: the overlap times 7 reaches the sizes times 3.
OVERLAP, SIZES = 7, 3
#: Slots of the table of word counts, whose size does not depend on the data.
COUNT_SLOTS = 1 << 16
#: Bits of the filter of lines that have candidates; its size does not depend on the data. Where
#: it is full, more lines are sent along, none is lost.
FILTER_BITS = 1 << 26
#: Candidates of a line that are verified first; each further portion is so many times larger.
FIRST_PORTION, GROWTH = 2, 8
#: Pairs for each partition of a shuffle that are verified at once, however many portions they are.
FEW_PAIRS = 1 << 10
#: Candidates of a line and part that the first join lists, up to 8 kB; each further join scans all
#: texts again and lists so many times more.
LISTED, LISTED_GROWTH = 1024, 64
#: Pairs that a task holds beyond those it lists; sorting them takes some 70 bytes for each.
HELD_PAIRS = 1 << 19
#: Pairs that are compared at once, about.
BLOCK_PAIRS = 1 << 18
#: Entries of prefix words that a task sorts together, about.
CHUNK_ENTRIES = 100_000
#: Bytes of text that a task divides into words at once; hashing takes some 50 bytes for each.
SLICE_BYTES = 1 << 18
#: Entries and places that a scan packs together, about.
HELD_ENTRIES = 1 << 17
#: Groups that words are dealt to, for each partition of a shuffle: a task holds one at a time.
GROUPS = 4
_LONG = 65535
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Lines of up to so many words have a bit map of 64 or 128 bits, longer ones of 256.
_SMALL, _MIDDLE = 64, 150
_MAPS = ("map0", "map1", "map2", "map3")
_ENTRY = np.dtype(
    [
        ("token", "<u4"),
        ("line", "<u8"),
        *((m, "<u8") for m in _MAPS),
        ("doc", "<i8"),
        ("number", "<u4"),
        ("size", "<u2"),
        ("place", "u1"),
    ]
)
_PLACE = np.dtype([("set", "<u8"), ("rest", "<u8"), ("doc", "<i8"), ("number", "<u4")])


_INSIDE = bytes(x not in BLANKS for x in range(256))
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Words of more pieces of eight bytes are hashed byte by byte.
_PIECES = 32


class LineHasher(WordHasher):
    """Hashes of words as ``WordHasher`` takes them, but of eight bytes at a time: what a task
    holds and moves grows with the words, not eight times with the bytes."""

    def __call__(self, joined: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where each word begins, and its hash."""
        text = b"\n" + joined.lower() + b"\n" + bytes(8)
        inside = np.frombuffer(text.translate(_INSIDE), np.uint8)[:-8]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, sizes = edges[::2] + 1, edges[1::2] - edges[::2]
        pieces = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
        hashes = pieces[starts] & _FIRST_BYTES[np.minimum(sizes, 8)]
        hashes = mix(hashes ^ sizes.astype(np.uint64) * _ODD)
        some = np.flatnonzero(sizes > 8)
        at, left = starts[some] + 8, sizes[some] - 8
        for _ in range(_PIECES):
            if not len(some):
                break
            piece = pieces[at] & _FIRST_BYTES[np.minimum(left, 8)]
            hashes[some] = mix((hashes[some] + _ODD) ^ piece)
            more = np.flatnonzero(left > 8)
            some, at, left = some[more], at[more] + 8, left[more] - 8
        if len(some):
            words = [text[starts[i] : starts[i] + sizes[i]] for i in some.tolist()]
            hashes[some] = super().__call__(b"\n".join(words))[1]
        return starts - 1, hashes


class Lines:
    """The lines of some texts that are long enough, as flat arrays of words."""

    def __init__(self, data: list[bytes | None], hasher: WordHasher, min_words: int = MIN_WORDS):
        found = [x or b"" for x in data]
        joined = b"\n".join(found)
        starts, words = hasher(joined)
        feeds = np.flatnonzero(np.frombuffer(joined, np.uint8) == 10)
        ends = np.cumsum([len(x) + 1 for x in found])
        counts = np.diff(np.searchsorted(starts, feeds), prepend=0, append=len(starts))
        enough = counts >= max(min_words, 1)
        chosen = np.flatnonzero(enough)
        self.words = words if min_words <= 1 else words[np.repeat(enough, counts)]
        # each line's text, and its number there
        begins = np.concatenate([[0], feeds + 1])
        self.text = np.searchsorted(ends, begins[chosen], "right")
        first = np.searchsorted(begins, np.concatenate([[0], ends[:-1]]))
        self.number = chosen - first[self.text] if len(chosen) else chosen
        self.line = np.repeat(np.arange(len(chosen)), counts[chosen])
        self.n = len(chosen)

    def leave(self, wanted: np.ndarray) -> None:
        """Leave the lines that have a word which the filter passes."""
        some = np.zeros(self.n, bool)
        some[self.line[passes(wanted, self.words)]] = True
        kept = some[self.line]
        self.words, self.line = self.words[kept], (np.cumsum(some) - 1)[self.line[kept]]
        self.text, self.number, self.n = self.text[some], self.number[some], int(some.sum())

    def sets(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words, rare ones first, and where the lines start."""
        key = self.line.astype(np.uint64) << np.uint64(40)
        key |= ranks[slot(self.words)].astype(np.uint64) << np.uint64(24)
        key |= self.words >> np.uint64(24) & np.uint64(0xFFFFFF)
        order = np.argsort(key)
        words, line, key = self.words[order], self.line[order], key[order]
        # words of one rank that agree in 24 bits: their order must be that of whole hashes
        tied = np.flatnonzero((key[1:] == key[:-1]) & (words[1:] != words[:-1]))
        if len(tied):
            order = np.lexsort((words, key))
            words, line = words[order], line[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (line[1:] != line[:-1])
        words, line = words[new], line[new]
        return words, np.flatnonzero(np.diff(line, prepend=-1))


def slot(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(48)).astype(np.int64)


def _ids(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64 bits for each set of words."""
    if not len(starts):
        return words[:0]
    return mix(np.add.reduceat(mix(words ^ np.uint64(0x5851F42D4C957F2D)), starts))


def _more_ids(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64 other bits for each set of words."""
    if not len(starts):
        return words[:0]
    return mix(np.add.reduceat(mix(words + np.uint64(0x14057B7EF767814F)), starts))


def word_ranks(docs: DataFrame) -> np.ndarray:
    """Slots of words in the order of how often the corpus has their words."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = LineHasher(), np.zeros(COUNT_SLOTS, np.int64)
        for _, data in texts(batches, most=SLICE_BYTES):
            _, words = hasher(b"\n".join(x or b"" for x in data))
            total += np.bincount(slot(words), minlength=COUNT_SLOTS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["slot", "n"])

    rows = docs.select("text").mapInArrow(count, "slot long, n long")
    rows = rows.groupBy("slot").agg(F.sum("n").alias("n"))
    counts = np.zeros(COUNT_SLOTS, np.int64)
    for r in rows.collect():  # at most COUNT_SLOTS rows
        counts[r["slot"]] = r["n"]
    ranks = np.empty(COUNT_SLOTS, np.uint16)
    ranks[np.argsort(counts, kind="stable")] = np.arange(COUNT_SLOTS)
    return ranks


def _unpack(data: pa.Buffer, out: np.ndarray) -> None:
    raw, at = zstandard.ZstdDecompressor().decompress(data), 0
    for name in out.dtype.names:
        out[name] = np.frombuffer(raw, out.dtype[name], len(out), at)
        at += out.dtype[name].itemsize * len(out)


def _unpacked(table: pa.Table, kind: int, dtype: np.dtype) -> np.ndarray:
    """What the rows of a kind hold, unpacked into one array without a second copy."""
    chunks = table.column("data").filter(pc.equal(table.column("kind"), kind)).chunks
    packed = [x.as_buffer() for chunk in chunks for x in chunk]
    sizes = [zstandard.frame_content_size(x) // dtype.itemsize for x in packed]
    out, at = np.empty(sum(sizes), dtype), 0
    for data, n in zip(packed, sizes):
        _unpack(data, out[at : at + n])
        at += n
    return out


def _scan(
    docs: DataFrame,
    ranks: np.ndarray,
    parts: int,
    min_words: int,
    wanted: np.ndarray | None = None,
) -> DataFrame:
    """(part, kind, data): prefix words of lines with what bounds their overlap, dealt by word
    (kind 0), and the places of all lines, dealt by set (kind 1). With a filter of words, only
    those that it passes, and no places."""

    def deal(part: np.ndarray, kind: int, columns: list[np.ndarray]) -> list[tuple]:
        # numbers of 16 bits are sorted by counting
        order = np.argsort(part.astype(np.uint16 if parts <= _LONG else np.int64), kind="stable")
        part = part[order]
        columns = [c[order] for c in columns]
        cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
        pack = zstandard.ZstdCompressor(level=1).compress
        return [
            (int(part[a]), kind, pack(b"".join([c[a:b].tobytes() for c in columns])))
            for a, b in zip(cuts, [*cuts[1:], len(part)])
        ]

    def dealt(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        part, *entries = map(np.concatenate, zip(*(own for own, _ in held)))
        rows = deal(part, 0, entries)
        places = np.concatenate([own for _, own in held])
        part = mix(places["set"]) % np.uint64(parts)
        rows += deal(part, 1, [places[n] for n in _PLACE.names])
        kinds = [pa.int32(), pa.int32(), pa.binary()]
        for at in range(0, len(rows), 1000):
            columns = zip(*rows[at : at + 1000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "kind", "data"]
            )

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, n_held = LineHasher(), [], 0
        for batch, data in texts(batches, most=SLICE_BYTES):
            lines = Lines(data, hasher, min_words)
            if wanted is not None:
                lines.leave(wanted)
            words, starts = lines.sets(ranks)
            if not len(words):
                continue
            ids, rest = _ids(words, starts), _more_ids(words, starts)
            sizes = np.diff(np.append(starts, len(words)))
            places = np.zeros(lines.n, _PLACE)
            places["set"], places["rest"], places["number"] = ids, rest, lines.number
            places["doc"] = batch.column("doc_id").to_numpy()[lines.text]
            # equal sets of these texts count once
            chosen = np.zeros(lines.n, bool)
            early = np.lexsort((places["number"], places["doc"], ids))
            chosen[early[np.unique(ids[early], return_index=True)[1]]] = True
            place = np.arange(len(words)) - np.repeat(starts, sizes)
            prefix = np.where(chosen, sizes - (3 * sizes + 3) // 4 + 1, 0)
            keep = place < np.repeat(prefix, sizes)
            tokens = words[keep]
            of_lines = (
                ids,
                *bit_maps(words, starts, sizes),
                places["doc"],
                places["number"],
                np.minimum(sizes, _LONG),
            )
            entries = [
                mix(tokens) % np.uint64(parts),
                # 32 bits are enough inside a part: words that agree in them only add candidates
                tokens & np.uint64(0xFFFFFFFF),
                *(np.repeat(x, prefix) for x in of_lines),
                np.minimum(place[keep], 255),
            ]
            # as the columns of _ENTRY
            kinds = ["<u8", *(_ENTRY[n] for n in _ENTRY.names)]
            entries = [x.astype(kind, copy=False) for x, kind in zip(entries, kinds)]
            if wanted is not None:
                some = passes(wanted, tokens)
                tokens, entries, places = tokens[some], [x[some] for x in entries], places[:0]
            held.append((entries, places))
            n_held += len(tokens) + len(places)
            if n_held > HELD_ENTRIES:
                yield from dealt(held)
                held, n_held = [], 0
        yield from dealt(held)

    return docs.mapInArrow(scan, "part int, kind int, data binary")


def bit_maps(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Four times 64 bits for each set: the larger it is, the more of them are used. A bit says
    whether an odd number of words falls on it, so that shared words hide no others."""
    scrambled = mix(words)
    bit = np.uint64(1) << (scrambled >> np.uint64(58))
    used = np.where(sizes <= _SMALL, 1, np.where(sizes <= _MIDDLE, 2, 4))
    if (used == 1).all():
        none = np.zeros(len(starts), np.uint64)
        return [np.bitwise_xor.reduceat(bit, starts), none, none, none]
    which = scrambled.astype(np.uint8) & np.repeat(used - 1, sizes).astype(np.uint8)
    return [
        np.bitwise_xor.reduceat(np.where(which == i, bit, np.uint64(0)), starts) for i in range(4)
    ]


def _differing(maps: list[np.ndarray], size: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Bits in which the maps of the sets a and b differ, folded to that of the smaller set."""
    least = np.minimum(size[a], size[b])
    one = maps[0] ^ maps[1] ^ maps[2] ^ maps[3]
    apart = np.bitwise_count(one[a] ^ one[b]).astype(np.int64)
    for some in (least > _SMALL) & (least <= _MIDDLE), least > _MIDDLE:
        if some.any():
            x, y = [m[a[some]] for m in maps], [m[b[some]] for m in maps]
            if least[some][0] <= _MIDDLE:
                x, y = ([m[0] ^ m[2], m[1] ^ m[3]] for m in (x, y))
            apart[some] = sum(np.bitwise_count(p ^ q).astype(np.int64) for p, q in zip(x, y))
    return apart


def listed(line: np.ndarray, other: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``end`` different others of each line in a mixed order that all tasks share."""
    order = np.lexsort((other, mix(line ^ mix(other)), line))
    line, other = line[order], other[order]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (other[1:] != other[:-1])
    line, other = line[new], other[new]
    cuts = np.flatnonzero(np.diff(line, prepend=line[:1] ^ np.uint64(1)))
    place = np.arange(len(line)) - np.repeat(cuts, np.diff(np.append(cuts, len(line))))
    return line[place < end], other[place < end]


def _order(entries: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """The order of the ``kept`` entries by word, size, line, document, number and place: the least
    place bounds the least. Most differ in the first two or in a line's first bits."""
    key = entries["token"][kept].astype(np.uint64) << np.uint64(32)
    key |= entries["size"][kept].astype(np.uint64) << np.uint64(16)
    key |= entries["line"][kept] >> np.uint64(48)
    order = np.argsort(key)
    key = key[order]
    tied = np.zeros(len(key), bool)
    tied[1:] = key[1:] == key[:-1]
    tied[:-1] |= tied[1:]
    tied = np.flatnonzero(tied)
    some = kept[order[tied]]
    by = [entries[n][some] for n in ("place", "number", "doc", "line")]
    order[tied] = order[tied[np.lexsort([*by, key[tied]])]]
    return order


def match_entries(
    entries: np.ndarray, end: int, asked: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Lines with earlier lines that share a prefix word and may overlap enough: the first ``end``
    of each line that the filter ``asked`` passes."""
    # words of one line say nothing: most are found by counting, the rest by sorting
    token = np.ascontiguousarray(entries["token"])
    some = (token & np.uint64(0x3FFFF)).astype(np.int64)
    kept = np.flatnonzero(np.bincount(some, minlength=1 << 18)[some] > 1)
    kept = kept[np.argsort(token[kept])]
    edge = np.append(np.flatnonzero(np.diff(token[kept])) + 1, len(kept))
    times = np.diff(edge, prepend=0)
    kept = kept[np.repeat(times > 1, times)]
    entries = entries[kept[_order(entries, kept)]]
    same = np.ones(len(entries), bool)
    for name in ("token", "line"):
        same[1:] &= entries[name][1:] == entries[name][:-1]
    same[:1] = False
    entries = entries[~same]  # of equal lines the first stays
    token, line, doc, number = (
        np.ascontiguousarray(entries[n]) for n in ("token", "line", "doc", "number")
    )
    maps = [np.ascontiguousarray(entries[n]) for n in _MAPS]
    size, place = entries["size"].astype(np.int64), entries["place"].astype(np.int64)
    huge = size >= _LONG  # longer than the entry can say: no bound applies
    rest = OVERLAP * (size - place)  # the shared word and all behind it, at most
    wanted = np.ones(len(line), bool) if asked is None else passes(asked, line)
    # sizes ascend within a word: what stands behind a's word bounds the sizes of its partners
    group = np.cumsum(np.diff(token, prepend=token[:1]) != 0) << 16
    most_words = np.where(huge, _LONG, np.clip(rest // SIZES - size, 0, _LONG))
    ends = np.searchsorted(group + size, group + most_words, "right")
    none = np.zeros(0, np.uint64)
    left, right, held, most = [none], [none], 0, HELD_PAIRS
    for a, b in _ranges(ends):
        total = size[a] + size[b]
        fits = (rest[b] >= SIZES * total) | huge[b]
        a, b, total = a[fits], b[fits], total[fits]
        some = (OVERLAP * (total - _differing(maps, size, a, b)) >= 2 * SIZES * total) | huge[b]
        a, b = a[some], b[some]
        later = (doc[a] > doc[b]) | ((doc[a] == doc[b]) & (number[a] > number[b]))
        apart = (doc[a] != doc[b]) | (number[a] != number[b])
        some = (line[a] != line[b]) & apart & np.where(later, wanted[a], wanted[b])
        a, b, later = a[some], b[some], later[some]
        left.append(line[np.where(later, a, b)])
        right.append(line[np.where(later, b, a)])
        held += len(a)
        if held > most:
            kept = listed(np.concatenate(left), np.concatenate(right), end)
            left, right, held = [kept[0]], [kept[1]], len(kept[0])
            most = 2 * held + HELD_PAIRS
    return listed(np.concatenate(left), np.concatenate(right), end)


def _ranges(ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) of each place a with all b behind it and before ``ends[a]``, in blocks."""
    counts = np.maximum(ends - np.arange(1, len(ends) + 1), 0)
    some = np.flatnonzero(counts)
    block = np.cumsum(counts[some]) // BLOCK_PAIRS
    for part in np.split(some, np.flatnonzero(np.diff(block)) + 1):
        n = counts[part]
        a = np.repeat(part, n)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)


def _candidates(
    entries: np.ndarray, start: int, end: int, asked: np.ndarray | None
) -> list[tuple]:
    """(line, n, others): for each line the earlier lines that it may match, those from ``start``
    to ``end`` in a mixed order. Where n is more than ``end`` there are others."""
    # words by words, which bounds the memory that sorting takes
    n = max(1, -(-len(entries) // CHUNK_ENTRIES))
    chunk = mix(entries["token"]) >> np.uint64(32)
    chunk = (chunk % np.uint64(n)).astype(np.uint16 if n < _LONG else np.uint64)
    order = np.argsort(chunk, kind="stable")
    cuts = np.searchsorted(chunk[order], np.arange(1, n))
    found = [match_entries(entries[some], end + 1, asked) for some in np.split(order, cuts)]
    line, other = listed(*map(np.concatenate, zip(*found)), end + 1)
    cuts = np.flatnonzero(np.diff(line, prepend=line[:1] ^ np.uint64(1)))
    ends = np.append(cuts[1:], len(line))
    keys = line[cuts].view(np.int64).tolist()
    return [
        (k, int(e - s), other[s + start : min(e, s + end)].tobytes())
        for k, s, e in zip(keys, cuts, ends)
        if e - s > start
    ]


def _copies(places: np.ndarray) -> np.ndarray:
    """The places of equal sets but the first."""
    places = places[
        np.lexsort((places["number"], places["doc"], places["rest"], places["set"]))
    ]
    new = np.ones(len(places), bool)
    new[1:] = (places["set"][1:] != places["set"][:-1]) | (places["rest"][1:] != places["rest"][:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    own = (places["doc"] == places["doc"][first]) & (places["number"] == places["number"][first])
    return places[~own]


def _match(
    scanned: DataFrame, start: int, end: int, asked: np.ndarray | None = None
) -> DataFrame:
    """(kind, line, n, others): candidates of lines (kind 0), see ``_candidates``; and lines equal
    to an earlier one (kind 1), as document and packed numbers."""

    def match(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = [(0, *r) for r in _candidates(_unpacked(table, 0, _ENTRY), start, end, asked)]
        give_back()
        gone = _copies(_unpacked(table, 1, _PLACE))
        gone = gone[np.argsort(gone["doc"], kind="stable")]
        cuts = np.flatnonzero(np.diff(gone["doc"], prepend=gone["doc"][:1] - 1))
        for a, b in zip(cuts, np.append(cuts[1:], len(gone))):
            numbers = gone["number"][a:b].astype("<i8").tobytes()
            rows.append((1, int(gone["doc"][a]), int(b - a), numbers))
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.table(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "line", "n", "others"]
        )

    return scanned.groupBy("part").applyInArrow(match, "kind int, line long, n long, others binary")


def _passing(batch: pa.RecordBatch, wanted: np.ndarray) -> pa.RecordBatch:
    """The rows of ``batch`` whose line a filter passes."""
    return batch.filter(pa.array(passes(wanted, batch.column("line").to_numpy().view(np.uint64))))


def _portion(
    candidates: DataFrame, start: int, end: int, wanted: np.ndarray | None = None
) -> DataFrame:
    """Pairs (a, b) of the candidates from ``start`` to ``end`` of each line's lists. With a filter
    of lines, of those that it passes."""

    def take(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if wanted is not None:
                batch = _passing(batch, wanted)
            lines = batch.column("line").to_numpy()
            lists = [
                np.frombuffer(x, np.int64)[start:end] for x in batch.column("others").to_pylist()
            ]
            a = np.repeat(lines, [len(x) for x in lists])
            b = np.concatenate([np.zeros(0, np.int64), *lists])
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], names=["a", "b"])

    some = candidates.filter(F.length("others") > 8 * start).select("line", "others")
    return some.mapInArrow(take, "a long, b long").distinct()


def _nodes(candidates: DataFrame) -> DataFrame:
    """(line) of all lines that are or have candidates."""

    def flatten(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(x, np.int64) for x in batch.column("others").to_pylist()]
            found = np.unique(np.concatenate([batch.column("line").to_numpy(), *lists]))
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["line"])

    return candidates.select("line", "others").mapInArrow(flatten, "line long").distinct()


def _prefix_words(sets: DataFrame) -> DataFrame:
    """(line) of the hashed words in the prefixes of the lines, as a filter takes them."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x, np.int64) for x in batch.column(0).to_pylist()]
            found = [x[: len(x) - (3 * len(x) + 3) // 4 + 1] for x in found]
            words = np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
            yield pa.RecordBatch.from_arrays([pa.array(words)], names=["line"])

    return sets.select("tokens").mapInArrow(cut, "line long")


def _filter(lines: DataFrame) -> np.ndarray:
    """One bit for each of the lines."""
    return _filter_and_sum(lines.select("line"))[0]


def _filter_and_sum(lines: DataFrame) -> tuple[np.ndarray, int]:
    """One bit for each of the lines, and the sum of their ``n`` if they have it."""
    slot_ = F.pmod("line", F.lit(FILTER_BITS))
    sums = [F.sum(n).alias(n) for n in lines.columns if n == "n"]
    words = lines.select(
        F.shiftright(slot_, 6).alias("word"),
        F.expr(f"shiftleft(1L, cast(pmod(line, {FILTER_BITS}) & 63 AS INT))").alias("bit"),
        *(n for n in lines.columns if n == "n"),
    )
    found = np.zeros(FILTER_BITS >> 6, np.int64)
    # at most FILTER_BITS / 64 rows
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits"), *sums).toArrow()
    found[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return found.view(np.uint64), int(rows.column("n").to_numpy().sum()) if sums else 0


def passes(filled: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Whether a filter's bits of the lines are set."""
    bit = lines % np.uint64(FILTER_BITS)
    found = filled[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))
    return (found & np.uint64(1)).astype(bool)


def _line_sets(
    docs: DataFrame,
    ranks: np.ndarray,
    filled: np.ndarray,
    min_words: int,
    wanted: np.ndarray | None = None,
) -> DataFrame:
    """(line, doc_id, number, tokens) of the lines that the filter passes; with a filter of words,
    of those that have one of the words."""

    def list_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = LineHasher()
        for batch, data in texts(batches, most=SLICE_BYTES):
            lines = Lines(data, hasher, min_words)
            if wanted is not None:
                lines.leave(wanted)
            words, starts = lines.sets(ranks)
            ids = _ids(words, starts)
            some = np.flatnonzero(passes(filled, ids))
            docs_ = batch.column("doc_id").to_numpy()[lines.text[some]]
            # of equal sets of these texts the first
            order = np.lexsort((lines.number[some], docs_, ids[some]))
            some, docs_ = some[order], docs_[order]
            first = np.unique(ids[some], return_index=True)[1]
            some, docs_ = some[first], docs_[first]
            ends = np.append(starts[1:], len(words))
            raw = words.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[some].view(np.int64)),
                    pa.array(docs_.astype(np.int64)),
                    pa.array(lines.number[some].astype(np.int32)),
                    pa.array([raw[8 * starts[i] : 8 * ends[i]] for i in some], pa.binary()),
                ],
                names=["line", "doc_id", "number", "tokens"],
            )

    return docs.mapInArrow(list_lines, "line long, doc_id long, number int, tokens binary")


def _sets_of(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``sets`` of the lines in ``pairs``, and a few more: no exchange of all finds them."""
    wanted = _filter(pairs.select(F.col("a").alias("line")).unionAll(pairs.select("b")))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _passing(batch, wanted)

    kept = sets.select("line", "first.doc_id", "first.number", "tokens")
    kept = kept.mapInArrow(keep, kept.schema)
    return kept.select("line", F.struct("doc_id", "number").alias("first"), "tokens")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(line) of the later line of each pair whose sets are similar enough.

    A line's words go to each of its pairs; a line of many pairs is a hot key of a join, which
    adaptive execution splits, as a line has one row in ``sets``."""

    def end(name: str) -> DataFrame:
        own = [F.col("line").alias(name), F.col("first").alias(f"{name}_first")]
        return sets.select(*own, F.col("tokens").alias(f"{name}_tokens"))

    joined = pairs.join(end("a"), "a").join(end("b"), "b").filter("a_first <> b_first")
    later = F.when(F.col("a_first") > F.col("b_first"), F.col("a")).otherwise(F.col("b"))

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, words, pair, sizes = batch.num_rows, [], [], 0
            for side in (1, 2):
                data = batch.column(side).to_pylist()
                lengths = np.array([len(x) // 8 for x in data], np.int64)
                words.append(np.frombuffer(b"".join(data), np.uint64))
                pair.append(np.repeat(np.arange(n), lengths))
                sizes = sizes + lengths
            words, pair = np.concatenate(words), np.concatenate(pair)
            order = np.lexsort((words, pair))
            words, pair = words[order], pair[order]
            shared = (words[1:] == words[:-1]) & (pair[1:] == pair[:-1])
            both = np.bincount(pair[1:][shared], minlength=n)
            similar = pa.array(OVERLAP * both >= SIZES * sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(similar)], names=["line"])

    rows = joined.select(later.alias("line"), "a_tokens", "b_tokens")
    return rows.mapInArrow(check, "line long")


def _numbers(copies: DataFrame) -> DataFrame:
    """(doc_id, number) of packed numbers."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [np.frombuffer(x, np.int64) for x in batch.column("others").to_pylist()]
            docs = np.repeat(batch.column("line").to_numpy(), [len(x) for x in numbers])
            joined = np.concatenate([np.zeros(0, np.int64), *numbers]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs), pa.array(joined)], names=["doc_id", "number"]
            )

    return copies.select("line", "others").mapInArrow(split, "doc_id long, number int")


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc_id, number): the lines of ``docs``, numbered from 0, that match an earlier one.

    Lines end at line feeds. Words are divided by ASCII white space, A-Z lower-cased; two lines
    match if their sets of words have a similarity (Jaccard) of 0.75 or more. Earlier is by
    doc_id, then number. Every line is compared with all of the input, also with those that go
    themselves. Lines with fewer than ``min_words`` words, or none, match nothing. Null texts have no lines; rows
    with a null id take no part. Lines of one number in rows that share an id count as one place,
    so none of them is earlier than the other. An empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.filter("doc_id is not null and text is not null")
    ranks = word_ranks(rows)
    width = GROUPS * shuffle_width(docs.sparkSession)
    matched_parts = cut_lineage(_match(_scan(rows, ranks, width, min_words), 0, LISTED))
    copies = _numbers(matched_parts.filter("kind = 1"))
    candidates = matched_parts.filter("kind = 0")
    near, start, end, words = copies, 0, LISTED, None
    while not candidates.isEmpty():
        matched, sets = _matched(rows, ranks, candidates, end - start, min_words, words)
        gone = sets.join(matched, "line", "left_semi")
        near = near.unionAll(gone.select("first.doc_id", "first.number"))
        open_ = candidates.filter(F.col("n") > end).select("line").distinct()
        open_ = open_.join(matched, "line", "left_anti")
        if open_.isEmpty():
            break
        start, end = end, end * LISTED_GROWTH
        # what open lines may match has a word of their prefixes in its own
        words = _filter(_prefix_words(sets.join(open_, "line", "left_semi")))
        scanned = _scan(rows, ranks, width, min_words, words)
        further = _match(scanned, start, end, _filter(open_)).filter("kind = 0")
        candidates = cut_lineage(further.join(open_, "line", "left_semi"))
    return near


def _matched(
    rows: DataFrame,
    ranks: np.ndarray,
    candidates: DataFrame,
    most: int,
    min_words: int,
    words: np.ndarray | None,
) -> tuple[DataFrame, DataFrame]:
    """(line) of the lines that match a candidate, and the (line, first, tokens) of all lines
    that are or have candidates. Lists hold at most ``most`` candidates. With a filter of words,
    all these lines have one of the words."""
    nodes = cut_lineage(_nodes(candidates))
    found = _line_sets(rows, ranks, _filter(nodes), min_words, words)
    sets = found.groupBy("line").agg(F.min(F.struct("doc_id", "number", "tokens")).alias("of"))
    sets = sets.join(nodes, "line", "left_semi").select(
        "line", F.struct("of.doc_id", "of.number").alias("first"), F.col("of.tokens").alias("tokens")
    )
    sets = cut_lineage(sets)
    matched = cut_lineage(_verify(_portion(candidates, 0, FIRST_PORTION), sets).distinct())
    start, end = FIRST_PORTION, FIRST_PORTION * GROWTH
    while start < most:
        # filters pick lists and sets where they are: joins would exchange all of both each time
        longer = candidates.filter(F.length("others") > 8 * start)
        rest = longer.select("line", F.expr(f"length(others) div 8 - {start}").alias("n"))
        open_, n = _filter_and_sum(rest.join(matched, "line", "left_anti"))
        if not n:
            break
        if n <= FEW_PAIRS * shuffle_width(rows.sparkSession):
            end = most  # further portions would cost more than the pairs that they may save
        pairs = cut_lineage(_portion(longer, start, end, open_))
        found = _verify(pairs, _sets_of(pairs, sets)).unionAll(matched)
        matched = cut_lineage(found.distinct())
        start, end = end, end * GROWTH
    return matched, sets


def line_report(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed and removed (sorted numbers of the
    lines that go). A null text has no lines, an empty one has one."""
    lines = F.size(F.split(text, "\n", -1)).cast("long")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.when(F.col(text).isNull(), 0).otherwise(lines).cast("long").alias("n_lines"),
    )
    gone = _by_document(repeated_lines(docs, doc_id, text, min_words))
    joined = rows.join(gone, rows.doc_id == gone.gone_id, "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select(
        "doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed")
    )


def _by_document(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.col("doc_id").alias("gone_id")).agg(
        F.array_sort(F.collect_set("number")).alias("removed")
    )


def drop_repeated_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: str = "n_chars",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``docs`` without the lines that match an earlier one, see ``repeated_lines``.

    A document that loses all lines stays with an empty text. The column ``size``, if there
    is one, gets the new number of characters; other columns stay.
    """
    gone = _by_document(repeated_lines(docs, doc_id, text, min_words))
    gone = gone.withColumnRenamed("removed", "_removed").withColumnRenamed("gone_id", "_gone_id")
    joined = docs.join(gone, F.col(doc_id) == F.col("_gone_id"), "left")
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.array_contains("_removed", i))
    new = F.when(F.col("_removed").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    changed = {text: new}
    if size in docs.columns:
        kind = docs.schema[size].dataType
        length = F.length(new).cast(kind if isinstance(kind, T.NumericType) else "long")
        changed[size] = F.when(F.col("_removed").isNull(), F.col(size)).otherwise(length)
    return joined.withColumns(changed).select(*docs.columns)
