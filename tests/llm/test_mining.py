"""Whitening and phrase mining against plain single-machine versions."""

from __future__ import annotations

import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))

import brute  # noqa: E402

from mercadal.llm import phrases, whitening  # noqa: E402
from mercadal.llm.queries import QUERIES  # noqa: E402
from mercadal.llm.tables import show_package  # noqa: E402
from mercadal.session import local_table  # noqa: E402

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(autouse=True)
def package(spark):
    show_package(spark)


# -------------------------------------------------------------------- whitening
def spectrum_of(x):
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    return values[::-1], vectors[:, ::-1]


def test_secular_roots_interlace_and_are_roots():
    dice = np.random.default_rng(2)
    for m in (1, 2, 5, 40):
        poles = np.sort(dice.normal(size=m)) * 10.0 ** dice.integers(-3, 4)
        weights = dice.uniform(1e-9, 1, m) ** 2
        gaps, roots = whitening.secular_roots(poles, weights)
        want = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(weights), np.sqrt(weights)))
        assert np.allclose(roots, want, rtol=1e-12, atol=1e-12 * np.abs(want).max())
        assert (roots >= poles).all() and (roots[:-1] <= poles[1:]).all()
        assert np.allclose(gaps, poles[None, :] - roots[:, None], atol=1e-12 * max(1, np.abs(want).max()))


@pytest.mark.parametrize("kind", ["random", "repeated", "low rank", "constant"])
def test_rank_one_updates_match_the_whole(kind):
    dice = np.random.default_rng(3)
    x = np.floor(dice.normal(size=(120, 9)) * 40).astype(np.int64)
    if kind == "repeated":
        x[10:70] = x[3]
    elif kind == "low rank":
        x[:, 4:] = x[:, :1] * np.arange(1, 6)
    elif kind == "constant":
        x[:] = 17
    parts = [whitening.Spectrum(9) for _ in range(3)]
    for part, rows in zip(parts, np.split(x, [50, 51]), strict=True):
        part.add(rows)
    joined = whitening.Spectrum.of(parts[0].state())
    joined.join(parts[1])
    joined.join(parts[2])
    joined.join(whitening.Spectrum(9))
    scatter = np.cov(x.T, bias=True) * len(x)
    scale = max(scatter.max(), 1.0)
    assert joined.n == 120 and (joined.total == x.sum(axis=0)).all()
    assert np.allclose(joined.mean, x.mean(axis=0))
    assert np.abs(joined.vectors * joined.values @ joined.vectors.T - scatter).max() < 1e-10 * scale
    assert np.abs(joined.vectors.T @ joined.vectors - np.eye(9)).max() < 1e-10


def check_whitened(rows, vectors, components=32):
    """Rows of the operator against a plain eigendecomposition."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in vectors], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    values, found = spectrum_of(x - 1_000_000.0)
    k = min(components, x.shape[1])
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert len(rows) == n * k and set(by_id) == {i for i, _ in vectors}
    got = np.array([[by_id[i][c + 1].whitened for c in range(k)] for i, _ in vectors])
    for (i, _), row in zip(vectors, x, strict=True):
        r = by_id[i][1]
        assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True))
    live = values[:k] > 1e-9 * max(values[0], 1e-300)
    want = (x - s / n) @ found[:, :k] / np.sqrt(np.where(live, values[:k], 1.0)) * live
    for c in range(k):
        assert np.allclose(np.abs(got[:, c]), np.abs(want[:, c]), atol=1e-6), c
        trace = values.sum()
        assert by_id[vectors[0][0]][c + 1].explained == pytest.approx(values[c] / trace if trace > 0 else 0, rel=1e-8, abs=1e-12)
    cov = np.cov(got[:, live].T, bias=True) if live.any() else np.eye(0)
    assert np.abs(cov - np.eye(int(live.sum()))).max(initial=0) <= 1e-4
    error = {r.identity_error for r in rows}
    assert len(error) == 1 and 0 <= error.pop() <= 1e-4


def test_whitened_embeddings_match_plain_numpy(spark):
    rows = QUERIES["op11_whitening"](spark, SMALL).collect()
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    check_whitened(rows, [(r.vec_id, r.embedding) for r in table])


def test_whitening_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    dice = random.Random(5)
    good = [(i, [float(np.float32(dice.gauss(0, 1 + j))) for j in range(5)]) for i in range(60)]
    good += [(100 + i, good[0][1]) for i in range(40)]  # one frequent vector
    good.append((None, good[3][1]))
    bad = [(200, None), (201, [1.0, None, 2.0, 0.0, 0.0]), (202, [float("nan")] * 5), (203, [float("inf")] + [0.0] * 4), (204, []), (205, [1.0])]
    table = local_table(spark, [(i, v, 0) for i, v in good + bad], VECTORS)
    table = table.withColumnRenamed("label", "component").selectExpr("*", "1 AS x", "2 AS whitened").repartition(7)
    check_whitened(whitening.whitened(table).collect(), good)
    few = local_table(spark, [(1, [1.0, 2.0, 4.0], 0), (2, [1.0, 3.0, 4.0], 0)], VECTORS)
    check_whitened(whitening.whitened(few).collect(), [(1, [1.0, 2.0, 4.0]), (2, [1.0, 3.0, 4.0])])
    alone = whitening.whitened(local_table(spark, [(1, [1.0, 2.0], 0)], VECTORS)).collect()
    assert [(r.whitened, r.explained, r.deviation, r.identity_error) for r in alone] == [(0.0, 0.0, 0, 0.0)] * 2
    for rows in ([], bad[:1], bad[4:5]):
        assert whitening.whitened(local_table(spark, [(i, v, 0) for i, v in rows], VECTORS)).count() == 0


# ---------------------------------------------------------------------- phrases
def brute_collocations(rows, least, top=2000):
    """{lang: [(phrase, a, l, r, n, score)]} by counting every phrase."""
    count, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower_ascii(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    count.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = {}
    for lang, seen in count.items():
        chosen = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in chosen.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 100 * a >= 80 * seen[p[i:j]]:
                        covered.add(p[i:j])
        kept = []
        for p, a in chosen.items():
            if p in covered:
                continue
            score, k = min((2_000_000 * a // (seen[p[:k]] + seen[p[k:]]), k) for k in range(1, len(p)))
            kept.append((" ".join(p), a, seen[p[:k]], seen[p[k:]], totals[lang], score))
        kept.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        if kept:
            out[lang] = kept[:top]
    return out


def as_dict(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.lang, r["rank"])):
        out.setdefault(r.lang, []).append((r.phrase, r.a, r.l, r.r, r.n, r.score))
        assert r["rank"] == len(out[r.lang])
    return out


def table_of(spark, rows):
    return local_table(spark, [(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], brute.DOCS)


ODD = [
    ("en", "A b\tc d. a B c d! a b c\nd a b"), (None, "a b c d " * 9), ("und", "a b"), ("en", None), ("en", ""), ("xx", " \t. ,"),
    ("en", "é É x y z\x85w é É x y" + " tail" * 40), ("fr", "\x0b".join(["la la la la la"] * 8)), ("fr", "la " * 50), ("en", "a" * 5000 + " b a b"),
]


def test_collocations_match_brute_force(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.lang, r.text) for r in table.collect()]
    for least in (30, 12):
        want = brute_collocations(rows, least)
        assert as_dict(phrases.collocations(table, least)) == want and want


def test_collocations_of_odd_rows(spark):
    docs = table_of(spark, ODD * 3)
    docs = docs.withColumnRenamed("source", "phrase").selectExpr("*", "1 AS n", "2 AS salt", "3 AS rank").repartition(5)
    assert as_dict(phrases.collocations(docs, 3)) == brute_collocations(ODD * 3, 3)
    assert as_dict(phrases.collocations(docs, 3, top=2)) == brute_collocations(ODD * 3, 3, 2)
    for rows in ([], [("en", None)], [("en", " . ")]):
        assert phrases.collocations(table_of(spark, rows)).count() == 0


@pytest.mark.parametrize("sample", [1 << 40, 1])
def test_border_failures_are_counted_in_further_passes(spark, monkeypatch, sample):
    """With an empty sample every frequent phrase is a failure of the border."""
    monkeypatch.setattr(phrases, "SAMPLE_ONE_IN", sample)
    monkeypatch.setattr(phrases, "SLICE", 64)  # texts meet in several parts
    passes = []
    plain = phrases.counts
    monkeypatch.setattr(phrases, "counts", lambda *a: passes.append(a[0]) or plain(*a))
    rows = [("en", "one two three four five"), ("en", "two three, one two three four"), ("de", "one two")] * 10
    assert as_dict(phrases.collocations(table_of(spark, rows), 10)) == brute_collocations(rows, 10)
    assert len(passes) == 5


def test_scores_beyond_64_bits_are_exact(spark):
    big = 6 * 10**18
    rows = [("en", "a b", big - 1), ("en", "a", big), ("en", "b", big + 1)]
    frequent = local_table(spark, rows, "lang string, phrase string, n long")
    totals = local_table(spark, [("en", big)], "lang string, n long")
    (row,) = phrases.scored(frequent, totals).collect()
    assert row.score == 2_000_000 * (big - 1) // (2 * big + 1) == 999_999


def test_failures_around_failures_are_counted_in_the_second_pass(spark, monkeypatch):
    """The sample knows half of the words, so failures of all lengths contain one another."""
    rows = [("en", "the cat sat on the mat, new york city hall")] * 12
    rows += [("en", f"n{i} the rare cat sat rare words on make. new hall york city. on the") for i in range(12)]
    rows += [("en", "york city new hall\nthe rare cat on the mat")] * 12
    docs, ends, plain, closed = table_of(spark, rows), [], phrases.counts, phrases.closed

    def counted(docs, known, done, least, *rest):
        if least == 10:
            ends.append(done is not None)
        return plain(docs, known, done, least, *rest)

    def poorly_proposed(docs, least, known, buckets):
        return closed(docs if known else docs.where("text LIKE '% hall' AND text LIKE 'the%'"), least, known, buckets)

    monkeypatch.setattr(phrases, "SAMPLE_ONE_IN", 1)
    monkeypatch.setattr(phrases, "SLICE", 300)
    monkeypatch.setattr(phrases, "counts", counted)
    monkeypatch.setattr(phrases, "closed", poorly_proposed)
    want = brute_collocations(rows, 10)
    assert any(len(w[0].split()) == 4 and "rare" in w[0] for w in want["en"])
    assert as_dict(phrases.collocations(docs, 10)) == want
    assert ends == [False, True]


def test_words_around_failures_keep_their_order():
    hashes = phrases.word_hashes([b"%d" % i for i in range(30)], 1)
    failed = phrases.Filter(16, np.zeros(1 << 10, dtype=np.uint64))
    pair = phrases.follow(hashes[12:13], hashes[13:14])
    for at in np.concatenate(phrases.places(np.concatenate([hashes[3:4], pair]), 16)).tolist():
        failed.table[at >> 6] |= np.uint64(1 << (at & 63))
    ids = np.arange(30)
    ids[5] = -1
    got = phrases.around(ids, hashes, failed)
    assert got.tolist() == [0, 1, 2, 3, 4, -1, 6, -1, 10, 11, 12, 13, 14, 15]
    assert not len(phrases.around(ids[20:], hashes, failed)) and not len(phrases.around(ids[:0], hashes, failed))
