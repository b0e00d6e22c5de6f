"""Divergence audit, quality rules and whitening against plain loops, on small odd tables."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattframe.llm import quality_rules, source_divergence, whitening
from wattframe.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_words string, kept int, term int, value int"


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(5)
    words = ["the", "The", "été", "a", "naïve", "x9y", "of", "Über", "rare1", "two"]
    out = []
    for i in range(160):
        text = " ".join(pick.choices(words, weights=[9, 5, 4, 8, 2, 3, 7, 1, 1, 2], k=pick.randint(0, 60)))
        if i % 5 == 0:
            text = "\n".join([text, "same line here", "same line here", text])
        lang = pick.choice(["en", "en", "fr", None, ""])
        out.append((i, text, lang, pick.choice(["a", "b", "c", None, "dé"])))
    out += [
        (200, None, "en", "empty"),
        (201, "", "en", "empty"),
        (202, "42 -- 17", "tiny", "s"),
        (203, "lone words", "tiny", "t"),
        (204, "THE END!! " * 20, "en", "a"),
        (205, "one word　wide   x", "en", "b"),
        (206, "### $$$ %%% " * 10, "fr", "a"),
        (206, "### $$$ %%% " * 10, "fr", "a"),
        (None, "of the two " * 2000, "en", None),
        (207, " \t\x0b\x0c\r\n ", "en", "a"),
        (208, "w" * 3000, "en", "a"),
    ]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "own", 1, 2, 3) for r in rows], DOCS).repartition(5)


def terms_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def divergences(rows, min_df, top):
    df, total, own = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = terms_of(text)
        df[lang].update(set(found))
        total[lang].update(found)
        own[lang, source].update(found)
    out = set()
    for lang in df:
        kept = [t for t, n in df[lang].items() if n >= min_df]

        def shares(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        q = shares(total[lang])
        groups = {s: shares(c) for (g, s), c in own.items() if g == lang}
        for s, p in groups.items():
            pairs = [(o, sum(f(p[t], r[t]) for t in kept)) for o, r in groups.items() if o != s]
            mine = [(t, f(p[t], q[t])) for t in kept if own[lang, s][t] and p[t] > q[t]]
            for part, found, n in (("pair", pairs, len(pairs)), ("term", mine, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(found[:n])}
    return out


@pytest.mark.parametrize("block, cells", [(64, 1 << 20), (2, 7)])
def test_divergence(docs, rows, monkeypatch, block, cells):
    monkeypatch.setattr(source_divergence, "BLOCK_SOURCES", block)
    monkeypatch.setattr(source_divergence, "_CELLS", cells)
    got = source_divergence.audit(docs, min_df=10, top_terms=3).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == divergences(rows, 10, 3)


def test_divergence_of_many_sources(spark):
    pick = random.Random(6)
    rows = [
        (i, " ".join(pick.choices("abcdefgh", k=pick.randint(1, 9))), "en", f"s{i % 150}")
        for i in range(600)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {tuple(r) for r in source_divergence.audit(docs).collect()}
    assert got == divergences(rows, 10, 10)
    assert sum(r[2] == "pair" for r in got) == 150 * 149


def test_divergence_without_terms(spark, docs):
    assert source_divergence.audit(docs.filter("false")).count() == 0
    none = source_divergence.audit(docs, min_df=10_000).collect()
    assert none and {(r.part, r.value) for r in none} == {("pair", 0)}


def test_counts_beyond_64_bits_are_exact(spark):
    rows = spark.createDataFrame([(10**13, 3 * 10**13, 7)], "c long, n long, v long")
    got = rows.select(source_divergence._share(F.col("c"), F.col("n"), F.col("v"))).first()[0]
    assert got == 1 + 10**9 * (10**13 + 2) // (3 * 10**13 + 14)


def test_long_text_vector(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "PIECE_BYTES", 10)
    text = "Aa bb " * 50 + "c" * 40
    docs = spark.createDataFrame([(text, None, None)], "text string, lang string, source string")
    (row,) = source_divergence.document_vectors(docs).collect()
    assert (row.lang, row.source) == ("", "")
    assert {(x.term, x["count"]) for x in row.vector} == {("aa", 50), ("bb", 50), ("c" * 40, 1)}


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {
        k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)
    }
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@pytest.mark.parametrize("piece", [1 << 20, 5])
def test_rule_measures(docs, rows, monkeypatch, piece):
    monkeypatch.setattr(quality_rules, "PIECE_BYTES", piece)
    judged = quality_rules.judge(docs, measures=BASE)
    # clashing names are replaced, other columns stay
    assert sorted(judged.columns) == sorted(
        ["doc_id", "text", "lang", "source", "term", "value", *BASE, "refused_by", "kept"]
    )
    got = Counter((r.doc_id, r.text, *(r[c] for c in BASE)) for r in judged.collect())
    assert got == Counter((r[0], r[1], *plain_counts(r[1])) for r in rows)


def test_repeated_windows():
    pick = random.Random(8)
    for n in [0, 7, 8, 9, *[pick.randint(8, 80) for _ in range(200)]]:
        words = [pick.randint(0, 2) for _ in range(n)]
        text = " ".join(map(str, words))
        assert quality_rules.repeated_words(np.array(words, np.int64)) == plain_counts(text)[-1]


def test_verdict_needs_no_order(docs, rows, monkeypatch):
    """Whatever rule comes first, the same texts are kept: those that no rule refuses."""
    texts = quality_rules.Texts([(r[1] or "").encode() for r in rows])
    refused = np.any([rule.refuses(texts) for rule in quality_rules.RULES], axis=0)
    assert 0 < refused.sum() < len(rows)
    expected = Counter((r[0], not x) for r, x in zip(rows, refused))
    n = len(quality_rules.RULES)
    for order in (list(range(n)), list(range(n))[::-1]):
        monkeypatch.setattr(quality_rules, "cheapest_order", lambda *_, o=order: o)
        judged = quality_rules.judge(docs).select("doc_id", "kept", "refused_by").collect()
        assert Counter((r.doc_id, r.kept) for r in judged) == expected
        assert all(r.kept == (r.refused_by is None) for r in judged)


def test_order_by_refusals_for_their_seconds():
    # rule 2 is dear but refuses most, rule 1 refuses what rule 0 leaves, rule 3 nothing
    masks = [0b0001, 0b0101, 0b0110, 0b0100, 0b0100, 0]
    assert quality_rules.cheapest_order([1.0, 1.0, 10.0, 0.1], masks) == [0, 1, 2, 3]
    assert quality_rules.cheapest_order([1.0, 1.0, 0.1, 0.1], masks) == [2, 0, 3, 1]
    assert quality_rules.cheapest_order([0.0, 0.0], []) == [0, 1]


def test_refused_texts_are_not_looked_at_again(spark):
    seen = spark.sparkContext.accumulator(0)

    def dear(texts):
        seen.add(len(texts))
        return np.zeros(len(texts), bool)

    rules = [
        quality_rules.Rule("dear", dear),
        quality_rules.Rule("short", lambda t: t["n_words"] < 3),
    ]
    docs = spark.createDataFrame([("a b c d",)] * 5 + [("a",)] * 95, "text string").coalesce(1)
    judged = quality_rules.judge(docs, rules, sample_rows=100)
    before = seen.value
    assert Counter(r.refused_by for r in judged.collect()) == {"short": 95, None: 5}
    assert seen.value - before == 5


def test_rules_on_nothing(docs):
    assert quality_rules.judge(docs.filter("false"), measures=BASE).count() == 0


def vectors(spark, rows, kind="float"):
    schema = f"vec_id long, embedding array<{kind}>, n string, whitened string, dim int"
    return spark.createDataFrame([(i, v, "own", "own", 1) for i, v in rows], schema).repartition(4)


@pytest.fixture(scope="module")
def embedded():
    pick = np.random.default_rng(4)
    mix = pick.normal(size=(6, 6))
    points = (pick.normal(size=(200, 6)) @ mix).astype(np.float32)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(300, None), (301, [None] + [1.0] * 5), (302, [float("nan")] + [1.0] * 5)]
    rows += [(303, [float("-inf")] * 6), (5, rows[5][1]), (None, rows[6][1])]
    return rows


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]


def test_whitening(spark, embedded):
    kept = usable(embedded)
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in kept]
    n, dims = len(x), 6
    sums = [sum(r[d] for r in x) for d in range(dims)]
    centred = [[n * r[d] - sums[d] for d in range(dims)] for r in x]
    cov = [
        [Fraction(sum(r[i] * r[j] for r in centred), n**3) for j in range(dims)] for i in range(dims)
    ]
    rows = vectors(spark, embedded)
    model = whitening.fit(rows, components=4)
    assert (model.n, list(model.sums)) == (n, sums)
    e, v = np.linalg.eigh(np.array(cov, float))
    assert np.allclose(model.values, e[::-1][:4], rtol=1e-12)
    assert np.allclose(np.abs((model.vectors * v[:, ::-1][:, :4]).sum(0)), 1, rtol=1e-12)
    assert np.isclose(model.trace, float(sum(cov[d][d] for d in range(dims))), rtol=1e-15)
    white = whitening.whiten(rows, model)
    assert sorted(white.columns) == sorted(["vec_id", "embedding", "n", "dim", "whitened", "deviation"])
    got = {r.vec_id: r for r in white.collect()}
    assert white.count() == n
    for (i, _), r in zip(kept, centred):
        assert int(got[i].deviation) == sum(c * c for c in r)
        plain = np.array(r, float) / n @ model.vectors / np.sqrt(model.values)
        assert np.allclose(got[i].whitened, plain, rtol=1e-9, atol=1e-9)
    points = np.array([got[i].whitened for i, _ in kept])
    apart = np.abs(np.cov(points.T, bias=True) - np.eye(4)).max()
    error = whitening.identity_error(white).first()[0]
    assert error < 1e-9 and abs(error - apart) < 1e-12


def test_covariance_is_exact(spark, monkeypatch):
    """Also where squares need more than 64 bits, and over several blocks of rows."""
    monkeypatch.setattr(whitening, "_ROWS", 16)
    pick = random.Random(2)
    rows = [(i, [pick.uniform(-1, 1) * 2.0 ** pick.randint(0, 38) for _ in range(3)]) for i in range(90)]
    frame = vectors(spark, rows, "double")
    n, sums = whitening._sums(frame, "embedding", 1024, 100_000)
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in rows]
    assert sums == [sum(r[d] for r in x) for d in range(3)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    squares = whitening._squares(frame, "embedding", centre, 1024, 100_000)
    got = whitening.covariance(n, [s - n * c for s, c in zip(sums, centre)], squares)
    for i in range(3):
        for j in range(3):
            products = sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x)
            assert got[i][j] == Fraction(products, n**3)


def test_whitening_of_odd_tables(spark):
    for rows in ([], [(1, None)], [(1, []), (2, [])], [(1, [2.0, 3.0])] * 3):
        frame = vectors(spark, rows)
        model = whitening.fit(frame)
        assert not len(model.values)
        white = whitening.whiten(frame, model)
        assert [(r.whitened, r.deviation) for r in white.collect()] == [([], 0)] * len(usable(rows))
        assert whitening.identity_error(white).first()[0] == 0
    # a dimension that never changes, and fewer components than asked for
    model = whitening.fit(vectors(spark, [(i, [float(i), 1.0]) for i in range(5)]))
    assert len(model.values) == 1 and model.explained.tolist() == [1.0]
    with pytest.raises(Exception, match="different lengths"):
        whitening.fit(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))
    with pytest.raises(Exception, match="beyond"):
        whitening.fit(vectors(spark, [(1, [1e30]), (2, [1.0])]))


def test_whitening_query(spark, embedded, tmp_path):
    vectors(spark, embedded).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op13_whitening"](spark, str(tmp_path)).collect()
    kept = usable(embedded)
    assert Counter(r.component for r in got) == {k: len(kept) for k in range(1, 7)}
    assert {r.n for r in got} == {len(kept)}
    assert abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-12
    assert max(r.identity_error for r in got) < 1e-9
