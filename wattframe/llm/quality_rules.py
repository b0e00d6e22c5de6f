"""Quality rules as a short-circuit cascade.

Each rule refuses a text by some measures of it. How long a rule's measures take and which texts it
refuses are estimated on a bounded sample; rules then run in the order of texts refused per second,
and a text that one rule refuses is not looked at by the rules after it. The order changes the time
only, never the verdict: a text is kept if no rule refuses it.

Words are what stands between ASCII blanks. Measures are exact counts.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.llm.common import texts

#: Words of a window that counts as repeated when it occurs twice.
WINDOW = 8
#: Texts that costs and refusals are estimated on, about.
SAMPLE_ROWS = 2000
#: Bytes of a text whose words are looked at together.
PIECE_BYTES = 1 << 20

_BLANKS = b" \t\n\r\x0b\x0c"
_BLANK = re.compile(rb"[ \t-\r]")
_CONTINUED = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_DIGITS = b"0123456789"
# ASCII but letters, digits and blanks
_SIGNS = bytes(c for c in range(128) if not chr(c).isalnum() and c not in _BLANKS)


class Texts:
    """Measures of some texts, each made when it is first asked for."""

    def __init__(self, data: Sequence[bytes | None]):
        self.data = [x or b"" for x in data]
        self.known: dict[str, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.data)

    def __getitem__(self, measure: str) -> np.ndarray:
        if measure not in self.known:
            self.known[measure] = MEASURES[measure](self)
        return self.known[measure]

    def only(self, chosen: np.ndarray) -> Texts:
        """Some of the texts, with what is known of them."""
        some = Texts([self.data[i] for i in np.flatnonzero(chosen)])
        some.known = {k: v[chosen] for k, v in self.known.items()}
        return some

    def count(self, of: Callable[[bytes], int]) -> np.ndarray:
        return np.array([of(x) for x in self.data], np.int64)

    def without(self, signs: bytes) -> np.ndarray:
        """Bytes that each text has of ``signs``."""
        return self.count(lambda x: len(x) - len(x.translate(None, signs)))


def _lines(body: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [x for x in body.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def _pieces(body: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded part at a time."""
    start = 0
    while start < len(body):
        blank = _BLANK.search(body, start + PIECE_BYTES)
        end = blank.start() if blank else len(body)
        yield body[start:end].split()
        start = end


def _word_numbers(body: bytes) -> np.ndarray:
    """Words as numbers: equal words have equal numbers."""
    known: dict[bytes, int] = {}
    parts = [
        np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        for words in _pieces(body)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def repeated_words(words: np.ndarray, size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words (a power of two) that occur twice or more.

    Windows are numbered by pairs of numbered windows of half their size, so equal numbers are equal
    words. Only places whose shorter window occurs again are followed up."""
    length, at, numbers = 1, np.arange(len(words)), words
    while length < size and len(at):
        # windows that go on at their end with one that may occur again, too
        whole = np.full(len(words) + 1, -1, np.int64)
        whole[at] = numbers
        ends = np.minimum(at + length, len(words))
        fits = whole[ends] >= 0
        at, length = at[fits], 2 * length
        key = whole[at] * (len(words) + 1) + whole[at + length // 2]
        _, numbers, counts = np.unique(key, return_inverse=True, return_counts=True)
        again = counts[numbers] > 1
        at, numbers = at[again], numbers[again]
    if not len(at):
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + length, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def _repeats(body: bytes) -> int:
    words = _word_numbers(body)
    return repeated_words(words) if len(words) > WINDOW else 0


def _most_frequent(body: bytes) -> int:
    """Occurrences of the text's most frequent word."""
    words = _word_numbers(body)
    return int(np.bincount(words).max()) if len(words) else 0


def _shouted(body: bytes) -> int:
    """Words of more than one byte with a capital and without a small ASCII letter."""
    return sum(w.isupper() and len(w) > 1 for words in _pieces(body) for w in words)


def _unlettered(body: bytes) -> int:
    """Words without any letter: ASCII signs and digits only."""
    return sum(not w.strip(_SIGNS + _DIGITS) for words in _pieces(body) for w in words)


MEASURES: dict[str, Callable[[Texts], np.ndarray]] = {
    "n_words": lambda t: t.count(lambda x: sum(map(len, _pieces(x)))),
    # every byte but blanks and those that continue a code point
    "word_chars": lambda t: t.count(lambda x: len(x.translate(None, _BLANKS + _CONTINUED))),
    "n_symbols": lambda t: t.without(_SYMBOLS),
    "n_signs": lambda t: t.without(_SIGNS),
    "n_lines": lambda t: t.count(lambda x: _lines(x)[0]),
    "n_dup_lines": lambda t: t.count(lambda x: _lines(x)[1]),
    "n_repeat_words": lambda t: t.count(_repeats),
    "n_unlettered": lambda t: t.count(_unlettered),
    "n_most_frequent": lambda t: t.count(_most_frequent),
    "n_shouted": lambda t: t.count(_shouted),
}


@dataclass(frozen=True)
class Rule:
    """``refuses`` tells which of some texts the rule refuses."""

    name: str
    refuses: Callable[[Texts], np.ndarray]


RULES = (
    Rule("few_words", lambda t: t["n_words"] < 20),
    Rule("repeats", lambda t: 100 * t["n_repeat_words"] > 30 * t["n_words"]),
    Rule("short_words", lambda t: t["word_chars"] < 2 * t["n_words"]),
    Rule("long_words", lambda t: t["word_chars"] > 20 * t["n_words"]),
    Rule("symbols", lambda t: 10 * t["n_symbols"] > t["n_words"]),
    Rule("signs", lambda t: 2 * t["n_signs"] > t["word_chars"]),
    Rule("dup_lines", lambda t: 100 * t["n_dup_lines"] > 30 * t["n_lines"]),
    Rule("unlettered", lambda t: 10 * t["n_unlettered"] > 3 * t["n_words"]),
    Rule("one_word", lambda t: 10 * t["n_most_frequent"] > 3 * t["n_words"]),
    Rule("shouting", lambda t: 2 * t["n_shouted"] > t["n_words"]),
)


def estimate(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    given: Sequence[str] = (),
    rows: int = SAMPLE_ROWS,
    text: str = "text",
) -> tuple[list[float], list[int]]:
    """Seconds that each rule takes on a sample of about ``rows`` texts, and for each sampled text
    the rules that refuse it (bit k: rule k).

    A rule's time is that of its measures alone, without those in ``given``, which are known anyway.
    The sample is drawn from all rows; its texts stay in the tasks, a number for each comes back.
    """
    total = docs.count()
    if not total:
        return [0.0] * len(rules), []
    share = min(1.0, rows / total)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds = np.zeros(len(rules))
        masks: list[int] = []
        for _, data in texts(batches, text):
            base = Texts(data)
            for m in given:
                base[m]
            found = np.zeros(len(base), np.int64)
            for k, rule in enumerate(rules):
                alone = base.only(np.ones(len(base), bool))
                began = time.thread_time()
                refused = rule.refuses(alone)
                seconds[k] += time.thread_time() - began
                found |= refused.astype(np.int64) << k
            masks += found.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([seconds.tolist()], pa.list_(pa.float64())), pa.array([masks], pa.list_(pa.int64()))],
            names=["seconds", "masks"],
        )

    sample = docs.select(text).sample(share, seed=11)
    found = sample.mapInArrow(measure, "seconds array<double>, masks array<long>").collect()
    seconds = [float(sum(r["seconds"][k] for r in found)) for k in range(len(rules))]
    return seconds, [m for r in found for m in r["masks"]]


def cheapest_order(seconds: Sequence[float], masks: Sequence[int]) -> list[int]:
    """The rules, each next one the rule that refuses most of the texts that are left for its
    seconds; rules that refuse none of them come last, the quickest first."""
    order, left = [], list(masks)
    open_ = list(range(len(seconds)))
    while open_:
        refused = {k: sum(m >> k & 1 for m in left) for k in open_}
        # a clock that stood still must not divide by zero
        best = min(open_, key=lambda k: (-refused[k] / max(seconds[k], 1e-9), seconds[k], k))
        order.append(best)
        open_.remove(best)
        left = [m for m in left if not m >> best & 1]
    return order


def judge(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    measures: Sequence[str] = (),
    sample_rows: int = SAMPLE_ROWS,
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``measures`` (long, of every text), refused_by (the rule that refused the text,
    else null) and kept (no rule refuses it).

    Of several rules that refuse a text, refused_by names the one that came first, which depends on
    the times measured; kept doesn't. A null or empty text has no words. Rows keep their other
    columns, those named like the new ones are replaced; equal rows are judged alike; an empty table
    gives no rows.
    """
    rules = list(rules)
    new = [*measures, "refused_by", "kept"]
    rows = docs.drop(*new).withColumn(text, F.col(text).cast("string"))
    order = cheapest_order(*estimate(rows, rules, measures, sample_rows, text))
    own = rows.columns
    schema = T.StructType(
        [
            *rows.schema.fields,
            *(T.StructField(m, T.LongType()) for m in measures),
            T.StructField("refused_by", T.StringType()),
            T.StructField("kept", T.BooleanType()),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data in texts(batches, text):
            all_texts = Texts(data)
            columns = [pa.array(all_texts[m], pa.int64()) for m in measures]
            refused = np.full(len(data), None, object)
            alive = np.arange(len(data))
            left = all_texts
            for k in order:
                if not len(alive):
                    break
                out = rules[k].refuses(left)
                if out.any():
                    refused[alive[out]] = rules[k].name
                    alive, left = alive[~out], left.only(~out)
            by = pa.array(refused.tolist(), pa.string())
            kept = [part.column(part.schema.get_field_index(c)) for c in own]
            yield pa.RecordBatch.from_arrays([*kept, *columns, by, by.is_null()], names=[*own, *new])

    return rows.mapInArrow(run, schema)
