"""The text operators on small tables with nulls, ties, repeated rows and clashing names."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from importlib import metadata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattframe.llm import (
    common,
    decontamination,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    quality,
    substring_dedup,
    top_k,
    toxicity,
    url_filter,
)
from wattframe.llm.common import held_out
from wattframe.llm.license_texts import TEXTS
from wattframe.llm.queries import URL_RULES, tokenizer_path
from wattframe.llm.suffix_array import permuted_common_prefixes, suffix_array

SCHEMA = "doc_id long, text string, score string, sequence_id int, n_words string"


@pytest.fixture(scope="module")
def docs(spark):
    """Made from a few words, so that copies, near copies and shared passages occur."""
    pick = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    lines = [" ".join(pick.choices(words, k=pick.randint(4, 30))) for _ in range(30)]
    rows = []
    for i in range(80):
        text = "\n".join(pick.choices(lines, k=pick.randint(1, 5)))
        if i % 3 == 0:
            text = text.replace("w1", "x1", 1)
        rows.append((i, text, "s", 1, None))
    rows += [
        (80, None, None, None, None),
        (81, "", None, None, None),
        (82, " \n\t", None, None, None),
        (None, rows[0][1], None, None, None),
        (83, rows[1][1], None, None, None),
        (83, rows[1][1], None, None, None),
        (84, " ".join(words * 20), None, None, None),
        (85, "É!!\u00a0ß " * 30, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def empty(docs):
    return docs.filter("false")


def words_of(text):
    return (text or "").encode().lower().split()


def test_urls(spark):
    rows = [
        (1, "https://WWW.Example.com/en/1?x#y"),
        (2, "http://a.example.com/en/1"),
        (3, "http://example.com"),
        (4, "http://x.net/es/"),
        (5, "no scheme"),
        (6, None),
        (6, None),
        (None, "http://notexample.com/fr/"),
    ]
    pages = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, host string")
    judged = url_filter.judge_urls(pages, url_filter.rule_table(spark, URL_RULES))
    got = [(r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in judged.collect()]
    got.sort(key=lambda r: r[0])
    assert got == [
        (0, "notexample.com", "/fr/", "com/", "allow"),
        (1, "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (2, "a.example.com", "/en/1", "example.com/en/", "block"),
        (3, "example.com", "", None, "allow"),
        (4, "x.net", "/es/", "net/es/", "block"),
        (5, "", "", None, "allow"),
        (6, "", "", None, "allow"),
        (6, "", "", None, "allow"),
    ]
    nothing = url_filter.judge_urls(pages, url_filter.rule_table(spark, []))
    assert {r.verdict for r in nothing.collect()} == {"allow"}
    assert url_filter.judge_urls(empty(pages), url_filter.rule_table(spark, URL_RULES)).count() == 0


def test_long_and_deep_urls(spark):
    """Paths and hosts of half a million parts are divided as deep as the rules go only."""
    deep, wide = "a/" * 500_000, "b." * 500_000
    rows = [
        (1, f"http://x.net/es/{deep}"),
        (2, f"http://{wide}net/fr/{deep}"),
        (3, f"http://{wide}org/{deep}"),
        (4, f"http://d.c.b.org/x/y/z/{deep}"),
        (5, "http://d.c.b.org/x/y"),
        (6, "http://b.org//"),
    ]
    rules = [*URL_RULES, ("block", "c.b.org", "/x/y/z/a/a"), ("block", "b.org", "//"), ("block", "b.org", "/x/y")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    judged = url_filter.judge_urls(pages, url_filter.rule_table(spark, rules))
    got = {r.page_id: (r.rule, r.verdict) for r in judged.select("page_id", "rule", "verdict").collect()}
    assert got == {
        1: ("net/es/", "block"),
        2: ("net/fr/", "block"),
        3: (None, "allow"),
        4: ("c.b.org/x/y/z/a/a", "block"),
        5: ("b.org/x/y", "block"),
        6: ("b.org//", "block"),
    }


def test_contamination(spark, docs):
    items = [(1, "w1 w2 w3"), (2, None), (None, "w1"), (3, ""), (4, "zz"), (4, "zz")]
    items += [(10 + i, t) for i, (_, t) in enumerate(texts(docs)[:6])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_contamination(docs, benchmark)
    assert found.columns[:4] == ["doc_id", "text", "score", "sequence_id"]
    split = lambda t: [w for w in "".join(
        c if ord(c) > 127 or c.isalnum() else " " for c in (t or "").lower()
    ).split(" ") if w]
    windows = {}
    for i, t in items:
        w = split(t)
        if i is not None:
            size = min(13, len(w))
            for j in range(len(w) - size + 1 if size else 0):
                windows.setdefault(tuple(w[j : j + size]), set()).add(str(i))
    for r in found.collect():
        w, hit, ids = split(r.text), set(), set()
        for size in {len(x) for x in windows}:
            for j in range(len(w) - size + 1):
                if tuple(w[j : j + size]) in windows:
                    hit |= set(range(j, j + size))
                    ids |= windows[tuple(w[j : j + size])]
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(w), len(hit), len(ids), digest)
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    assert decontamination.find_contamination(empty(docs), benchmark).count() == 0
    clean = decontamination.find_contamination(docs, benchmark.filter("false"))
    assert not any(r.contaminated for r in clean.collect())


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers(spark, docs, operator):
    rows = [(i, i % 2, 1 - i % 2) for i in range(60)] + [(None, 1, 0), (3, None, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    model = operator.fit(docs, labels)
    judge = quality.score_documents if operator is quality else toxicity.grade_documents
    scored = judge(docs, model).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert judge(empty(docs), model).count() == 0
    unfitted = operator.fit(docs, labels.filter("false"))
    assert judge(docs, unfitted).count() == docs.count()


def test_packing(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    placed = packing.pack(packing.cut_pieces(docs, tokenizer_path(), with_ids=True)).collect()
    expected = []
    for i, t in texts(docs):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for p, s in enumerate(range(0, len(ids), 2048)):
            own = ids[s : s + 2048]
            expected.append((i, p, s, len(own), zlib.crc32(own.tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    filled = {}
    for r in sorted(placed, key=lambda r: r.offset):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048
    assert packing.pack_documents(empty(docs), tokenizer_path()).count() == 0


def test_plan_holds_all():
    pick = random.Random(5)
    for _ in range(50):
        counts = {pick.randint(1, 100): pick.randint(1, 40) for _ in range(pick.randint(1, 30))}
        held = {}
        for p in packing.plan_bins(counts, 100):
            assert p.gap == 100 - sum(n * k for n, k in p.items) >= 0
            for n, k in p.items:
                held[n] = held.get(n, 0) + k * p.bins
        assert held == counts


def test_top_k(spark):
    pick = np.random.default_rng(1)
    rows = [(i, pick.integers(-3, 4, 5).astype(float).tolist()) for i in range(1300)]
    rows += [(1400, None), (1500, [1.0, None, 0.0, 0.0, 0.0]), (1600, [float("nan")] * 5), (7, rows[7][1])]
    table = spark.createDataFrame(rows, "id long, embedding array<double>")
    weights = top_k.integer_vector(F.col("embedding"), 1)
    vectors = table.select("id", weights.alias("weights"))
    vectors = vectors.withColumn("terms", top_k.dense_terms(F.col("weights")))
    index = top_k.build_index(vectors)
    got = top_k.top_k(index, vectors.filter("id % 100 = 0"), 10).collect()
    known = {i: np.array(v) for i, v in rows[:1300]}
    expected = []
    for q in range(0, 1300, 100):
        best = sorted((-int(known[q] @ v), i) for i, v in known.items() if i != q)[:10]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted((r.query_id, r.rank, r.id, r.score) for r in got) == expected
    none = top_k.build_index(vectors.filter("false"))
    assert top_k.top_k(none, vectors, 10).count() == 0


def test_near_duplicates(docs):
    sets = {}
    for i, t in texts(docs):
        w = words_of(t)
        if i is not None:
            sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(root.values())) and None in ids
    assert near_dedup.near_duplicates(empty(docs)).count() == 0


def test_chains_of_short_texts(spark):
    """Windows of 11 to 39 words that move on: each is linked with the next only, at 0.75."""
    rows, root = [], {}
    for chain in range(80):
        step = (1, 2, 3, 5)[chain % 4]
        size = 7 * step + 4
        words = [f"c{chain}w{i}" for i in range(size + 12 * step)]
        for k in range(12):
            root[len(rows)] = chain * 12
            rows.append((len(rows), " ".join(words[k * step : k * step + size])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_dedup.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in found} == root


def test_small_links_share_a_bucket():
    pick = np.random.default_rng(6)
    for i in range(3000):
        n = (4, 8, 12, 20)[i % 4]  # 3 of 4 in common
        union = np.sort(pick.integers(0, 2**64, n, dtype=np.uint64))
        part = np.delete(union, pick.choice(n, n // 4, replace=False))
        one, two = (near_dedup.band_keys(near_dedup.bin_minima(x)) for x in (union, part))
        assert (one == two).any()


def test_no_link_of_small_sets_is_refused():
    pick = np.random.default_rng(4)
    for n in [4, 8, 16, 20, 40, 80, 200, 400, 800, 1200] * 40:
        union = pick.integers(0, 2**64, n, dtype=np.uint64)
        sets = [np.sort(union[n // 8 :]), np.sort(np.append(union[: n // 8], union[n // 4 :]))]
        size = np.array([len(x) for x in sets])
        maps = [np.frombuffer(near_dedup.bit_map(x), np.uint64) for x in sets]
        none = np.zeros((2, near_dedup.BINS // 64), np.uint64)
        assert near_dedup.may_link(size, np.array(maps), none, 0, np.array([1]))[0]


def repeated(docs):
    """The (doc_id, number) of lines that match an earlier one, by comparing all."""
    lines = []
    for i, t in sorted({x for x in texts(docs) if None not in x}):
        for j, line in enumerate(t.split("\n")):
            if len(words_of(line)) >= 5:
                lines.append((i, j, set(words_of(line))))
    return {
        (i, j)
        for n, (i, j, s) in enumerate(lines)
        if any(4 * len(s & e) >= 3 * len(s | e) for _, _, e in lines[:n])
    }


def test_lines(docs):
    gone = repeated(docs)
    report = line_dedup.line_report(docs).collect()
    assert len(report) == docs.count()
    assert {(r.doc_id, n) for r in report for n in r.removed} == gone
    left = line_dedup.drop_repeated_lines(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert line_dedup.line_report(empty(docs)).count() == 0


def test_short_lines(spark, tmp_path):
    """The query and the pipeline's stage compare all lines that have a word."""
    import corpus_pipeline
    from wattframe.llm.queries import op8_line_dedup

    rows = [
        (1, "All rights reserved.\na b c d\nx\n\n"),
        (2, "all RIGHTS reserved.\nd c a\ny\n \nx x\nc d"),
        (3, "reserved. all rights\nz\nb a c\n\nnew words here\nall rights"),
        (4, "one two three four five\nz"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = [(i, j, set(words_of(x))) for i, t in rows for j, x in enumerate(t.split("\n"))]
    gone = {
        (i, j)
        for n, (i, j, s) in enumerate(lines)
        if any(s and 4 * len(s & e) >= 3 * len(s | e) for _, _, e in lines[:n])
    }
    assert gone == {(2, 0), (2, 1), (2, 4), (3, 0), (3, 2), (4, 1)}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    report = op8_line_dedup(spark, str(tmp_path)).collect()
    assert {(r.doc_id, n) for r in report for n in r.removed} == gone
    left = corpus_pipeline.line_deduplication(spark, docs, str(tmp_path)).collect()
    expected = {
        i: "\n".join(x for j, x in enumerate(t.split("\n")) if (i, j) not in gone) for i, t in rows
    }
    assert {r.doc_id: r.text for r in left} == expected


def test_lines_joined_again(spark, monkeypatch):
    """A group of lines around the threshold, of which a join lists one candidate at first."""
    monkeypatch.setattr(line_dedup, "LISTED", 1)
    monkeypatch.setattr(line_dedup, "LISTED_GROWTH", 6)
    pick = random.Random(5)
    base = [f"w{i}" for i in range(14)]
    rows = []
    for i in range(60):
        line = list(base)
        for at in pick.sample(range(14), 3):
            line[at] = f"v{pick.randint(0, 5)}"
        rows.append((i, " ".join(line)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    gone = repeated(docs)
    assert 0 < len(gone) < 59
    assert {tuple(r) for r in line_dedup.repeated_lines(docs).collect()} == gone
    assert line_dedup.repeated_lines(docs).count() == len(gone)


def test_some_hundred_candidates_need_one_scan(spark, monkeypatch):
    scans = []
    scan = line_dedup._scan
    monkeypatch.setattr(line_dedup, "_scan", lambda *a: scans.append(a) or scan(*a))
    common = " ".join(f"c{i}" for i in range(20))
    # 20 of 28 words in common: no match, but many pass the bit maps
    lines = [" ".join([common, *(f"u{i}_{k}" for k in range(4))]) for i in range(600)]
    texts = ["\n".join(lines[i : i + 6]) for i in range(0, 600, 6)] + [lines[0] + " more"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.number) for r in line_dedup.repeated_lines(frame).collect()}
    assert got == {(100, 0)} and len(scans) == 1


def test_later_portions_exchange_only_the_sets_of_open_lines(spark, monkeypatch):
    sizes = []
    verify = line_dedup._verify
    monkeypatch.setattr(
        line_dedup, "_verify", lambda pairs, sets: sizes.append(sets.count()) or verify(pairs, sets)
    )
    near = [" ".join(f"p{i}_{k}" for k in range(20)) for i in range(100)]
    near += [x + " more" for x in near]  # settled by the first candidates
    common = " ".join(f"c{i}" for i in range(20))
    own = [[f"u{i}_{k}" for k in range(4)] for i in range(40)]
    # 20 of 28 words in common, the rarest ones
    rows = list(enumerate([" ".join([common, *words]) for words in own] + near))
    rows.append((240, " ".join(w for words in own for w in 60 * words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.number) for r in line_dedup.repeated_lines(frame).collect()}
    assert got == {(i, 0) for i in range(140, 240)}
    assert len(sizes) > 1 and sizes[0] > 200 and max(sizes[1:]) <= 40


def test_few_pairs_need_one_more_portion(spark, monkeypatch):
    verified = []
    verify = line_dedup._verify
    monkeypatch.setattr(
        line_dedup, "_verify", lambda pairs, sets: verified.append(pairs) or verify(pairs, sets)
    )
    common = " ".join(f"c{i}" for i in range(20))
    own = [[f"u{i}_{k}" for k in range(4)] for i in range(40)]
    # 20 of 28 words in common, the rarest ones
    rows = list(enumerate(" ".join([common, *words]) for words in own))
    rows.append((40, " ".join(w for words in own for w in 60 * words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert line_dedup.repeated_lines(frame).count() == 0
    assert len(verified) == 2
    verified.clear()
    monkeypatch.setattr(line_dedup, "FEW_PAIRS", 0)
    assert line_dedup.repeated_lines(frame).count() == 0
    assert len(verified) > 2


def test_hashes_of_words_of_eight_bytes_at_a_time():
    """Equal words have equal hashes, others do not, wherever they stand and however long they are."""
    pick = random.Random(3)
    known = ["a", "a\0", "\0", "ab", "a" * 7, "a" * 8, "a" * 9, "a" * 8 + "\0", "a" * 16, "a" * 17]
    known += ["é" * n for n in (1, 4, 5, 9)] + ["b" * n for n in (264, 265, 272, 3000)]
    known += ["b" * 2999 + "c", "c" * 264 + "d", "c" * 264 + "e"]
    words = [pick.choice([w, w.upper()]) for w in pick.choices(known, k=400)]
    gaps = [pick.choice([" ", "\t", "\n\n", "\r", "\x0b\x0c"]) for _ in words]
    joined = "".join(x for both in zip(words, gaps) for x in both)
    for text in (joined, " " + joined, joined.strip()):
        text = text.encode()
        starts, hashes = line_dedup.LineHasher()(text)
        assert starts.tolist() == line_dedup.WordHasher()(text)[0].tolist()
        names = [bytes(w.encode()).lower() for w in words]
        assert len(set(zip(names, hashes.tolist()))) == len(set(names)) == len(set(hashes.tolist()))
    for empty in (b"", b" \n"):
        assert [len(x) for x in line_dedup.LineHasher()(empty)] == [0, 0]


def test_a_task_gives_back_what_it_has_freed(monkeypatch):
    """A worker is kept after its task, beside those that do the next one."""
    held = [np.ones(12_000) for _ in range(2_000)]  # 192 MB, each too small to be mapped alone
    last = np.ones(12_000)
    del held
    before = resident()
    common.give_back()
    assert resident() < before - 100e6
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    batch = pa.record_batch({"text": ["a b", None, "c"]})
    assert len(list(common.texts([batch, batch]))) == len(given) == 2
    assert len(last)


def resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_bit_maps_of_long_lines():
    """A map never shows more than what differs, and sets of hundreds of words don't fill it."""
    draw = np.random.default_rng(3)
    for n, shared in ((6, 5), (40, 30), (90, 10), (140, 0), (400, 0), (400, 390)):
        common = draw.integers(0, 2**64, shared, "u8")
        sets = [np.append(common, draw.integers(0, 2**64, n - shared, "u8")) for _ in range(2)]
        size = np.array([n, n])
        maps = line_dedup.bit_maps(np.concatenate(sets), np.array([0, n]), size)
        (apart,) = line_dedup._differing(maps, size, np.array([0]), np.array([1]))
        assert apart <= 2 * (n - shared)
        if not shared:  # such pairs are refused
            assert 7 * (2 * n - apart) < 6 * 2 * n


def test_words_that_agree_in_the_bits_of_an_entry():
    """A line's entries of two words that agree there bound no pair more than the first of them."""
    entries = np.zeros(3, line_dedup._ENTRY)
    entries["token"], entries["line"], entries["doc"] = 7, [5, 5, 6], [1, 1, 2]
    entries["size"], entries["place"] = 8, [2, 0, 0]
    line, other = line_dedup.match_entries(entries, 9)
    assert (line.tolist(), other.tolist()) == ([6], [5])
    # a line's words cost a scan less: four bytes say which word it is
    assert line_dedup._ENTRY["token"].itemsize == 4


def test_lines_with_a_wanted_word():
    hasher = line_dedup.WordHasher()
    data = [b"a b\nc\n\nd a", None, b"e", b"", b"c f\na"]
    wanted = np.zeros(line_dedup.FILTER_BITS >> 6, np.uint64)
    for word in hasher(b"a f")[1]:
        bit = int(word) % line_dedup.FILTER_BITS
        wanted[bit >> 6] |= np.uint64(1 << (bit & 63))
    lines = line_dedup.Lines(data, hasher)
    assert (lines.text.tolist(), lines.number.tolist()) == ([0, 0, 0, 2, 4, 4], [0, 1, 3, 0, 0, 1])
    lines.leave(wanted)
    assert (lines.text.tolist(), lines.number.tolist()) == ([0, 0, 4, 4], [0, 3, 0, 1])
    assert lines.line.tolist() == [0, 0, 1, 1, 2, 2, 3]
    assert (lines.words == hasher(b"a b d a c f a")[1]).all()
    two = line_dedup.Lines(data, hasher, 2)
    assert (two.text.tolist(), two.number.tolist()) == ([0, 0, 4], [0, 3, 0])
    assert (two.words == hasher(b"a b d a c f")[1]).all() and two.line.tolist() == [0, 0, 1, 1, 2, 2]


def test_listed_in_parts():
    draw = np.random.default_rng(1)
    line, other = draw.integers(0, 9, 900).astype("u8"), draw.integers(0, 90, 900).astype("u8")
    whole = line_dedup.listed(line, other, 7)
    first = line_dedup.listed(line[:500], other[:500], 7)
    parts = [np.concatenate(x) for x in zip(first, (line[500:], other[500:]))]
    for x, y in zip(whole, line_dedup.listed(*parts, 7)):
        assert (x == y).all()
    assert set(zip(*line_dedup.listed(line, other, 999))) == set(zip(line, other))


def test_repeated_bytes(docs):
    known = {i: (t or "").encode() for i, t in texts(docs) if i is not None}
    first = {}
    for i in sorted(known):
        for j in range(len(known[i]) - 49):
            first.setdefault(known[i][j : j + 50], i)
    found = substring_dedup.remove_repeated(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        body = known[r.doc_id]
        gone = np.zeros(len(body), bool)
        for j in range(len(body) - 49):
            if first[body[j : j + 50]] < r.doc_id:
                gone[j : j + 50] = True
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        assert (r.n_bytes, r.n_removed) == (len(body), gone.sum())
        assert r.n_spans == (np.diff(gone.astype(int), prepend=0) == 1).sum()
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert substring_dedup.remove_repeated(empty(docs)).count() == 0


def test_suffix_array():
    pick = np.random.default_rng(0)
    for _ in range(100):
        text = pick.integers(0, pick.integers(1, 5), pick.integers(1, 150)).astype(np.uint8)
        data = text.tobytes()
        order = suffix_array(text, 1000)
        assert list(order) == sorted(range(len(data)), key=lambda i: data[i:])
        shared = permuted_common_prefixes(text, order, 50)
        for a, b in zip(order, order[1:]):
            n = 0
            while n < 50 and max(a, b) + n < len(data) and data[a + n] == data[b + n]:
                n += 1
            assert shared[b] == n


def test_licenses(spark):
    mit = "Released under the MIT licence"
    rows = [
        (1, "Copyright 2020 Someone\n" + mit.upper() + "!"),
        (2, "prose\nReleased under the MIT License.\nprose"),
        (3, None),
        (4, ""),
        (4, ""),
        (None, mit),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan_licenses(docs, licenses.known_table(spark)).collect()
    got = {r.doc_id: (r.license, r.n_license_lines, tuple(r.line_licenses)) for r in found}
    assert len(found) == 6
    assert got[1] == ("MIT", 1, ("MIT",)) and got[2] == (None, 1, ("MIT",))
    assert got[3] == got[4] == (None, 0, ()) and got[None] == ("MIT", 0, ())


def test_quality_does_not_depend_on_the_sample(spark):
    """Three good texts to one bad, of which a sample holds as many of each."""
    rows = [(i, "Aa bb cc. " * (1 + i % 3), int(i % 4 > 0)) for i in range(400)]
    rows += [(1000, " \t\n", 0), (1001, None, 0), (1002, "Aa", None), (1003, " ", 1), (1003, "A", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", "quality")
    known = table.filter("doc_id < 400").filter(~held_out(F.col("doc_id"))).toPandas()
    prior = known["quality"].mean()
    near = []
    for per_class in (1000, 20):
        model = quality.fit(docs, labels, per_class=per_class)
        model.neighbours = 10_000
        assert model.prior == pytest.approx(prior)
        sampled = model.weights * (model.labels == 1), model.weights * (model.labels == 0)
        assert sampled[0].sum() / model.weights.sum() == pytest.approx(prior)
        assert quality.score_documents(docs, model).filter("doc_id = 1001").first().score == model.prior
        terms = np.zeros((1, quality.TERMS), np.float32)
        numbers, shares = quality.Terms()(b"Aa bb cc. Aa bb cc.")
        terms[0, numbers] = shares
        near.append(model.score(terms)[0])
    assert near == pytest.approx([prior, prior], abs=0.15)


def test_whole_license_texts(spark):
    common = {n: f"/usr/share/common-licenses/{n}" for n in (
        "Apache-2.0", "BSD", "CC0-1.0", "GPL-2", "GPL-3", "LGPL-2.1", "MPL-2.0"
    )}
    rows = [(n, open(f).read()) for n, f in common.items() if os.path.exists(f)]
    names = {n: n for n, _ in rows} | {"BSD": "BSD-3-Clause", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0"}
    for package, name in (("pluggy", "MIT"), ("urllib3", "MIT"), ("idna", "BSD-3-Clause")):
        for file in metadata.files(package):
            if file.name.startswith("LICENSE"):
                rows.append((package, file.locate().read_text()))
                names[package] = name
    rows.append(("isc", "ISC License\n\nCopyright (c) 2024, A\n\n" + next(t for n, t in TEXTS if n == "ISC")))
    names["isc"] = "ISC"
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = licenses.scan_licenses(docs, licenses.known_table(spark)).collect()
    assert {r.doc_id: r.license for r in found} == {n: names[n] for n, _ in rows}
    assert licenses.known_table(spark, (), ()).count() == 0
    assert licenses.known_table(spark, licenses.KNOWN, ()).count() == len(licenses.KNOWN)
    assert licenses.known_table(spark, (), licenses.DIGESTS).count() == len(licenses.DIGESTS)
