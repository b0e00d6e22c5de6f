"""Best-fit packing of tokenised documents into sequences.

Lengths are whole numbers up to the capacity, so a packing of all pieces follows from how many
there are of each length. On these counts pieces above a third of the capacity, of which at most
two share a bin, are matched greedily: the longest with the longest that still fits. Shorter
ones then go, longest first, to the tightest gap. The plan is a short list of bin patterns;
each piece finds its place by its number among the pieces of its length.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import Cached, cut_lineage, shuffle_width, texts

CAPACITY = 2048
#: Words whose ids a worker remembers, about 150 bytes each.
WORD_ENTRIES = 500_000
#: Words that are encoded together: their tokens take some 1,000 bytes for each meanwhile.
ENCODED_WORDS = 512
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_TOKENIZERS: dict[int, WordIds] = {}


#: Bytes of text that are divided together, which takes some 25 bytes for each; the more there are,
#: the fewer words are looked up.
STRETCH_BYTES = 1 << 21
# Anything but ASCII and the precomposed letters U+00C0 to U+00FF, or the beginning of a special
# token. Composing and lower case may change such words together, so they keep their spelling.
_ODD = re.compile(rb"[\xc2\xc4-\xff]|\xc3[\x97\xb7]|<\|")
_ODD_PAIRS = (b"\xc3\x97", b"\xc3\xb7", b"<|")
_USUAL = bytes(x for x in range(256) if x < 0xC4 and x != 0xC2)
_BLANK = re.compile(rb"\s")
# How the tokenizer divides words of the other characters: runs of one kind, each digit alone;
# bytes beyond ASCII are letters there.
_GAP, _LETTER, _DIGIT, _OTHER = range(4)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[list(b" \t\n\r\f\v")] = _GAP
_KINDS[list(range(ord("a"), ord("z") + 1)) + list(range(0x80, 0x100))] = _LETTER
_KINDS[list(b"0123456789")] = _DIGIT
# what behind a run's leading apostrophe is a part with it: 's, 't, 'm, 'd, 're, 've, 'll
_S, _T, _M, _D, _R, _V, _E, _L = b"stmdrvel"


def _valid(body: bytes) -> bytes:
    """UTF-8, with U+FFFD for what is not."""
    try:
        body.decode()
    except UnicodeDecodeError:
        return body.decode("utf-8", "replace").encode()
    return body


def _stretches(body: bytes) -> Iterator[bytes]:
    """A text cut at white space."""
    start = 0
    while start < len(body):
        blank = _BLANK.search(body, start + STRETCH_BYTES)
        end = blank.start() if blank else len(body)
        yield body[start:end]
        start = end


def _odd_words(text: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Which bytes are in words that ``_ODD`` finds, and not the first of one."""
    odd = (text == 0xC2) | (text > 0xC3)
    for pair in _ODD_PAIRS:
        odd[:-1] |= (text[:-1] == pair[0]) & (text[1:] == pair[1])
    starts = np.flatnonzero(~gaps[1:] & gaps[:-1]) + 1
    starts = np.append([0], starts) if not gaps[0] else starts
    ends = np.flatnonzero(gaps[1:] & ~gaps[:-1]) + 1
    found = np.unique(np.searchsorted(starts, np.flatnonzero(odd), "right") - 1)
    edges = np.zeros(len(text) + 1, np.int8)
    edges[starts[found] + 1] += 1
    edges[ends[found]] -= 1
    return np.cumsum(edges[:-1], dtype=np.int8).view(bool)


def divide(joined: bytes) -> tuple[np.ndarray, pa.Array, bool]:
    """Where the parts of some text begin, and the parts: A-Z lower-cased, but words that ``_ODD``
    finds whole and as they are spelled; whether there are such. The text must end in three blanks."""
    text = np.frombuffer(joined.lower(), np.uint8)
    kinds = _KINDS[text]
    inside = kinds != _GAP
    begins = inside.copy()
    begins[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
    if b"'" in joined:
        at = np.flatnonzero((text == ord("'")) & begins)
        one, two = text[at + 1], text[at + 2]
        short = (one == _S) | (one == _T) | (one == _M) | (one == _D)
        long = ((one == _R) | (one == _V)) & (two == _E) | (one == _L) & (two == _L)
        at, size = at[short | long], np.where(short, 2, 3)[short | long]
        begins[at + 1] = False
        begins[at + size] |= kinds[at + size] == _LETTER
    odd = bool(joined.translate(None, _USUAL)) or any(x in joined for x in _ODD_PAIRS)
    if odd:
        own = np.frombuffer(joined, np.uint8)
        whole = _odd_words(own, ~inside)
        begins &= ~whole
        first = np.append(whole[1:] & ~whole[:-1], False)  # the byte before is of the word too
        text = np.where(whole | first, own, text)
    starts = np.flatnonzero(begins)
    data = text[inside]
    offsets = np.append(np.flatnonzero(begins[inside]), len(data))
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    return starts, pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), odd


def _byte_letters() -> str:
    """The character that byte-level tokenizers write for each byte, but blanks as they are."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    letters = [chr(x if x in kept else next(others)) for x in range(256)]
    letters[32] = " "
    return "".join(letters)


_BYTE_LETTERS = _byte_letters()
#: How a tokenizer must normalise and divide texts for its ids to be those of the parts.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_DIVIDERS = [
    {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def _divides(definition: dict) -> bool:
    """Whether a tokenizer divides texts as ``divide`` and its special tokens begin odd words."""
    return (
        definition["normalizer"] == {"type": "Sequence", "normalizers": _NORMALIZERS}
        and definition["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": _DIVIDERS}
        and definition["model"]["type"] == "BPE"
        and all(t["content"].startswith("<|") for t in definition["added_tokens"])
        and not definition["truncation"]
        and not definition["padding"]
    )


class WordIds(Cached):
    """Token ids of the parts that the tokenizer divides words into, as little-endian 32-bit bytes.

    New parts go to the tokenizer's model as it would divide and spell them itself. Words with
    characters that could change with their neighbours are encoded whole, as they are spelled, and
    so are all texts where a tokenizer divides them in another way.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        super().__init__(self.encode)
        self.own = Cached(self.encode)
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model if _divides(json.loads(definition)) else None

    def encode(self, word: bytes) -> bytes:
        found = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def learn(self, parts: list[bytes]) -> list[bytes]:
        """The ids of ``parts``, which differ. New ones are encoded. Where there are too many words,
        those of ``parts`` that are known, mostly frequent ones, stay."""
        found = list(map(self.get, parts))
        new = [p for p, x in zip(parts, found) if x is None]
        if not new:
            return found
        if len(self) + len(new) > WORD_ENTRIES:
            known = {p: x for p, x in zip(parts, found) if x is not None}
            self.clear()
            self.update(known)
        for at in range(0, len(new), ENCODED_WORDS):
            self._learn(new[at : at + ENCODED_WORDS])
        return [self[p] if x is None else x for p, x in zip(parts, found)]

    def _learn(self, new: list[bytes]) -> None:
        joined = b" ".join(new)
        if not joined.isascii():
            joined = joined.decode().lower().encode()
        letters = codecs.charmap_decode(joined, "strict", _BYTE_LETTERS)[0].split(" ")
        tokens = list(map(self.model.tokenize, letters))
        ids = np.array([t.id for found in tokens for t in found], "<u4").tobytes()
        cuts = np.cumsum([0, *(4 * len(found) for found in tokens)]).tolist()
        self.update(zip(new, map(ids.__getitem__, map(slice, cuts, cuts[1:]))))

    def _ids(self, bodies: list[bytes]) -> list[bytes]:
        starts, parts, odd = divide(b"\n".join([*bodies, b"\n\n"]))
        if not len(starts):
            return [b""] * len(bodies)
        coded = parts.dictionary_encode()
        _, places, letters = coded.dictionary.buffers()
        places = np.frombuffer(places, np.int64, len(coded.dictionary) + 1).tolist()
        words = list(map(letters.to_pybytes().__getitem__, map(slice, places, places[1:])))
        if odd:
            plain = [w for w in words if not _ODD.search(w)]
            known = dict(zip(plain, self.learn(plain)))
            ids = [known[w] if w in known else self.own[w] for w in words]
        else:
            ids = self.learn(words)
        taken = pa.array(ids, pa.large_binary()).take(coded.indices)
        _, places, found = taken.buffers()
        edges = np.searchsorted(starts, np.cumsum([0, *(len(x) + 1 for x in bodies)]))
        edges = np.frombuffer(places, np.int64)[edges].tolist()
        found = memoryview(found)
        return [bytes(found[a:b]) for a, b in zip(edges, edges[1:])]

    def texts(self, data: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        if self.model is None:
            return list(map(self.encode, data))
        data = list(map(_valid, data))
        short = iter(self._ids([x for x in data if len(x) <= STRETCH_BYTES]))
        return [
            next(short)
            if len(x) <= STRETCH_BYTES
            else b"".join(self._ids([stretch])[0] for stretch in _stretches(x))
            for x in data
        ]


def word_ids(definition: str) -> WordIds:
    """One tokenizer for each definition in a worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
    key = zlib.crc32(definition.encode())
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = WordIds(definition)
    return _TOKENIZERS[key]


def cut_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of each document: its token ids, then ``end_id``, cut every ``capacity`` ids.

    A null text is empty and gives one piece with ``end_id`` alone. Null ids stay null, repeated
    rows give repeated pieces. ``with_ids`` adds the ids themselves.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()  # a vocabulary file: its size does not depend on the documents
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(definition)
        for part, data in texts(batches, most=STRETCH_BYTES):
            keys = part.column("doc_id").to_pylist()
            del part  # it holds its whole batch, beside which the next one is read
            rows: list[list] = [[], [], [], [], [], []]
            for key, own_ids in zip(keys, ids.texts([x or b"" for x in data])):
                all_ids = own_ids + end
                for i, start in enumerate(range(0, len(all_ids), 4 * capacity)):
                    own = all_ids[start : start + 4 * capacity]
                    values = (key, i, start // 4, len(own) // 4, zlib.crc32(own), own)
                    for column, value in zip(rows, values):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            n = 6 if with_ids else 5
            columns = [pa.array(r, k) for r, k in zip(rows[:n], kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names[:n])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


@dataclass
class Pattern:
    """``bins`` equal bins: lengths with how many of each, in order; room that is left."""

    bins: int
    items: tuple[tuple[int, int], ...]
    gap: int


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Bin patterns that hold ``counts[length]`` pieces of each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    large = sorted(n for n in left if 3 * n > capacity)
    done: list[Pattern] = []
    while large:
        first = large[-1]
        fit = bisect_left(large, capacity - first + 1) - 1
        if fit < 0:
            done.append(Pattern(left.pop(large.pop()), ((first, 1),), capacity - first))
            continue
        second = large[fit]
        if first == second:
            n, odd = divmod(left[first], 2)
            if not n:  # a single one; the next shorter may still fit
                n, odd = 1, 0
                second = large[fit - 1] if fit else None
            if second is None:
                done.append(Pattern(1, ((first, 1),), capacity - first))
                taken = {first: 1}
            elif second == first:
                done.append(Pattern(n, ((first, 2),), capacity - 2 * first))
                taken = {first: 2 * n}
            else:
                done.append(Pattern(1, ((first, 1), (second, 1)), capacity - first - second))
                taken = {first: 1, second: 1}
        else:
            n = min(left[first], left[second])
            done.append(Pattern(n, ((first, 1), (second, 1)), capacity - first - second))
            taken = {first: n, second: n}
        for length, n in taken.items():
            left[length] -= n
            if not left[length]:
                del left[length]
                large.remove(length)
    gaps: dict[int, list[Pattern]] = {}
    order: list[int] = []

    def put(pattern: Pattern) -> None:
        if not pattern.bins:
            return
        if pattern.gap not in gaps:
            gaps[pattern.gap] = []
            insort(order, pattern.gap)
        gaps[pattern.gap].append(pattern)

    for pattern in done:
        put(pattern)
    for length in sorted(left, reverse=True):
        rest = left[length]
        while rest:
            at = bisect_left(order, length)
            if at == len(order):
                # no gap is left: new bins, as many as hold the rest
                each = capacity // length
                bins, odd = divmod(rest, each)
                put(Pattern(bins, ((length, each),), capacity - each * length))
                if odd:
                    put(Pattern(1, ((length, odd),), capacity - odd * length))
                break
            gap = order[at]
            pattern = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            each = min(gap // length, rest)
            bins = min(pattern.bins, rest // each)
            put(Pattern(pattern.bins - bins, pattern.items, gap))
            put(Pattern(bins, (*pattern.items, (length, each)), gap - each * length))
            rest -= bins * each
    return [p for gap in order for p in gaps[gap]]


def _places(patterns: list[Pattern], capacity: int) -> list[np.ndarray]:
    """For runs of pieces of a length: key of the first, first bin, pieces in a bin, offset."""
    rows, taken, base = [], {}, 0
    for p in patterns:
        offset = 0
        for length, each in p.items:
            first = taken.get(length, 0)
            rows.append((length << 40 | first, base, each, offset))
            taken[length] = first + p.bins * each
            offset += length * each
        base += p.bins
    rows.sort()
    return [np.array([r[i] for r in rows], np.int64) for i in range(4)]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: their place in as few sequences as the
    method finds, gapless from 0. Pieces are at most ``capacity`` long.

    Needs doc_id, piece and length. Equal rows take different places. Columns named
    sequence_id or offset are replaced. No pieces give no rows. ``pieces`` is read twice, so
    pass rows that are stored.
    """
    rows = pieces.drop("sequence_id", "offset")
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shuffle_width(pieces.sparkSession)))
    rows = rows.withColumn("_salt", salt.cast("int"))
    counts = rows.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    # a row for each length and salt: bounded by the capacity and the width of shuffles
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        "length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    totals = counts.groupBy("length").agg(F.sum("_n").alias("n"))
    # at most a row for each length up to the capacity
    patterns = plan_bins({r["length"]: r["n"] for r in totals.collect()}, capacity)
    keys, bases, eaches, offsets = _places(patterns, capacity)
    order = Window.partitionBy("length", "_salt").orderBy(
        *[c for c in ("doc_id", "piece") if c in rows.columns]
    )
    numbered = rows.withColumn("_number", F.row_number().over(order) - 1)
    numbered = numbered.join(firsts, ["length", "_salt"])
    numbered = numbered.withColumn("_number", F.col("_number") + F.col("_first"))
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in names)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            number = batch.column("_number").to_numpy(zero_copy_only=False).astype(np.int64)
            run = np.searchsorted(keys, length << 40 | number, "right") - 1
            within = number - (keys[run] & ((1 << 40) - 1))
            bins, slot = within // eaches[run], within % eaches[run]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            added = [pa.array(bases[run] + bins), pa.array(offsets[run] + slot * length)]
            yield pa.RecordBatch.from_arrays(
                [*kept, *added], names=[*names, "sequence_id", "offset"]
            )

    return numbered.select(*names, "_number").mapInArrow(
        place, f"{fields}, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with their places, see ``cut_pieces`` and ``pack``."""
    return pack(cut_lineage(cut_pieces(docs, tokenizer_path, capacity)), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """Whole sequences from placed pieces with ids: sequence_id, length, ids (binary, 32-bit)."""
    part = F.struct("offset", "ids")
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(
            F.array_sort(F.collect_list(part)),
            F.lit(b""),
            lambda all_ids, x: F.concat(all_ids, x["ids"]),
        ).alias("ids"),
    )
