"""Quality, duplicates, decontamination, personal data, packing and the pipeline."""

from __future__ import annotations

import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from mercadal.llm import bradley_terry, disclosure, packing, simhash, tokens, winnowing  # noqa: E402
from mercadal.llm.queries import QUERIES  # noqa: E402
from mercadal.llm.tables import show_package  # noqa: E402
from mercadal.session import local_table  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "one", "Two words", "a b c", "a b c", "x" * 5000, "é ñ ß z   q", "İ İstanbul ẞ"]


@pytest.fixture(autouse=True)
def package(spark):
    show_package(spark)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return [r.text for r in rows]


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]


def by_id(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_contamination_matches_brute_force(spark, texts, items):
    long_item = items[0][1]
    words = long_item.split()
    more = [
        *ODD,
        " ".join(words[:13]),
        "zz " + " ".join(words[1:14]).upper() + ", zz",
        " ".join(words[:12]),
        " ".join([*words[:13], *words[5:20]]),
        "seven words are just a short item here seven words are just a short item",
        "pre the short one post " * 30,
        long_item * 3,
    ]
    extra_items = [(9001, "seven words are just a short item"), (9002, "The short, one"), (9003, None), (9004, "..!")]
    extra_items += [(9005, long_item), (None, "two words")]
    docs = brute.documents(spark, texts + more)
    bench = local_table(spark, items + extra_items, "item_id long, text string")
    got = by_id(winnowing.contamination(docs, bench))
    named = [("" if i is None else i, t) for i, t in items + extra_items]
    assert [r[1:] for r in got] == brute.contamination(texts + more, named)
    assert any(r[2] for r in got)
    kept = winnowing.without_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in got if not r[-1]]


def test_contamination_of_empty_tables(spark):
    none = local_table(spark, [], "item_id long, text string")
    docs = brute.documents(spark, ["a b", None])
    assert [r[1:3] for r in by_id(winnowing.contamination(docs, none))] == [(2, 0), (0, 0)]
    assert winnowing.contamination(brute.documents(spark, []), none).count() == 0


def test_short_grams_are_not_lost_between_texts():
    words = winnowing.Words([b"a b", b"c d e", b""])
    assert list(words.bounds) == [0, 2, 5, 5]
    at, _ = words.every(2)
    assert list(at) == [0, 2, 3]
    assert len(words.winnowed()[0]) == 0


def test_fingerprints_match_the_definition(texts):
    for t in [*texts[:60], *ODD]:
        assert simhash.fingerprint_of((t or "").encode()) == brute.simhash(t)


def test_close_pairs_match_all_distances():
    dice = np.random.default_rng(1)
    values = dice.integers(0, 1 << 63, 300, dtype=np.uint64)
    values[100:200] = values[:100] ^ (np.uint64(1) << dice.integers(0, 64, 100).astype(np.uint64))
    values[200:] = values[:100] ^ np.uint64(0b1011) ^ (np.uint64(1) << dice.integers(0, 2, 100).astype(np.uint64) * np.uint64(40))
    for radius in range(4):
        got = set(zip(*(x.tolist() for x in simhash.close_pairs(values[:70], values, radius)), strict=True))
        want = {(i, j) for i in range(70) for j in range(300) if int(values[i] ^ values[j]).bit_count() <= radius}
        assert got == want


def test_components_match_brute_force(spark, texts, monkeypatch):
    dice = random.Random(3)
    base = [dice.getrandbits(64) for _ in range(12)]
    prints = list(base)
    for b in base[:5]:  # chains that reach far from where they began
        for _ in range(25):
            b ^= 1 << dice.randrange(64) | 1 << dice.randrange(64)
            prints.append(b)
    prints += [base[0] ^ 7] * 40 + [0, 0]
    ids = list(range(len(prints)))
    dice.shuffle(ids)
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in zip(ids, prints, strict=True)]
    for chunk in (8192, 4):  # the second cuts every key that more than four share
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        rows = local_table(spark, signed, "doc_id long, fp long")
        found = {r.fp: r.component_id for r in simhash.fingerprint_components(rows).collect()}
        assert [found[s] for _, s in signed] == brute.least_reachable(ids, prints)


def test_near_duplicates_of_odd_rows(spark, texts):
    rows = texts + ODD
    docs = brute.documents(spark, rows, [(None, "unlike the rest of it all", "en", "s", 1), (3, texts[3], "x", "y", 0)])
    got = [r for r in by_id(simhash.near_duplicates(docs.withColumn("fp", docs.lang)))]
    prints = [brute.simhash(t) for t in rows]
    want = brute.least_reachable(list(range(len(rows))), prints)
    assert len(got) == len(rows) + 2
    for doc_id, fp, component in got:
        if doc_id is None:
            assert component is None
        else:
            assert (int(fp, 16), component) == (prints[doc_id], want[doc_id])
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(want))
    assert kept.where("doc_id is null").count() == 1
    assert simhash.near_duplicates(brute.documents(spark, [])).count() == 0


def test_base_spans_match_brute_force(spark, texts):
    odd = [
        "a@b.c.@d.e x@y z.@q.w_p@r.s..t@u.v", "1.2.3.4.5.6.7.8 256.1.1.1 999999999999999999999.1.1.1 01.002.3.255",
        "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 00000000000000", "+1 (555) 123-4567 ++12 +1-- +123456789012345678 +1 2",
        "é4111111111111111é\n+44 20 7946 0958\na.b@c-d.e\U0001F600f@g.h", "9" * 9000 + "." + "1" * 50, "1 2 " * 9000, "a" * 9000 + "@",
        "x@y.z" * 400,
    ]
    rows = texts + odd + ODD
    docs = brute.documents(spark, rows)
    got = by_id(disclosure.personal_data(docs.withColumn("row", docs.doc_id)))
    for (i, *counts, digest, spans), text in zip(got, rows, strict=True):
        want = brute.base_spans(text)
        assert counts == [sum(s.startswith(k) for s in want) for k in brute.KINDS], text
        assert digest == brute.sha(",".join(want)), text
        listed = [s for s in spans.split(",") if s and not s.startswith("term:")]
        assert listed == want
    assert disclosure.personal_data(brute.documents(spark, [])).count() == 0


def test_terms_that_disclose(spark):
    fill = [f"plain line {w} talks about other things {i}" for i, w in enumerate("abcdefghij" * 30)]
    told = [f"Call Zorblatt{'' if i else 'o'} or Quimby at jo@x.org today number {i} plain" for i in range(3)]
    docs = brute.documents(spark, [*told, *fill, "Quimby and nothing else"])
    spans = {r[0]: r[-1] for r in by_id(disclosure.personal_data(docs))}
    text = told[1]
    shown = {text[int(a) : int(b)] for k, a, b in (s.split(":") for s in spans[1].split(",")) if k == "term"}
    assert "Quimby" in shown and "Zorblatt" in shown
    assert "plain" not in shown
    assert spans[len(told) + len(fill)] == ""
    clean = {r.doc_id: r for r in disclosure.redact(docs).collect()}
    assert "jo@x.org" not in clean[1].text and "[EMAIL]" in clean[1].text and "Quimby" not in clean[1].text
    assert clean[1].n_chars == len(clean[1].text)
    assert clean[5].text == fill[2] and clean[5].n_chars == len(fill[2])


def test_redaction_leaves_no_base_span_and_keeps_the_rest(spark, texts):
    rows = [*texts, *ODD, "a@b.cd 1.2.3.4 x", "+1 555 123 4567 4111 1111 1111 1111"]
    docs = brute.documents(spark, rows)
    clean = {r.doc_id: r.text for r in disclosure.redact(docs).collect()}
    for i, t in enumerate(rows):
        assert not brute.base_spans(clean[i])
        if not brute.base_spans(t):
            assert clean[i] == t


@pytest.mark.parametrize("plain_specials", [False, True])
def test_encoder_equals_the_tokenizer(texts, plain_specials):
    from tokenizers import Tokenizer

    rng = random.Random(11)
    letters = "abzAZ0189'sStTlLvVeErRdDmM<|>endoftextEND$#@_-\t\r\n  ÀÞ×ßÿ÷üÜª²İ\u0301Σ一\u0085\u00a0"
    rows = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(4000)]
    rows += [*[t or "" for t in texts[:40]], *[t or "" for t in ODD], "it's\nIT'S $'s 'll'", "a<|endoftext|>b <|ENDOFTEXT|>"]
    coder = Tokenizer.from_file(tokens.vocabulary_path())
    coder.encode_special_tokens = plain_specials
    own = tokens.PieceEncoder(tokens.vocabulary_path(), plain_specials)
    for text, got in zip(rows, own.encode(rows), strict=True):
        wanted = coder.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, dtype="<u2").tolist() == wanted, text


def test_encoder_forgets_and_finds_again(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    own = tokens.PieceEncoder(tokens.vocabulary_path(), False)
    text = "one two three four five one two 7 seven"
    assert own.encode([text, text]) == [tokens.PieceEncoder(tokens.vocabulary_path(), False).encode([text])[0]] * 2
    assert len(own.words) <= 3


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    rows = [*texts[:80], *ODD, "<|endoftext|> it's 42,000　ok\tx\r\ny <|startoftext|>"]
    docs = brute.documents(spark, rows, [(None, "nameless", "en", "s", 1)]).repartition(5)
    pieces = packing.concat_and_cut(docs, window=64).collect()
    coder = Tokenizer.from_file(tokens.vocabulary_path())
    for i, text in [*enumerate(rows), (None, "nameless")]:
        ids = coder.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert own[0].start == 0 and own[0].doc_tokens == len(ids)
        at = 0
        for p in own:
            assert p.start == at
            raw = np.array(ids[at : at + p.length], dtype="<u4").tobytes()
            assert zlib.crc32(raw) == p.ids_crc32
            at += p.length
        assert at == len(ids)
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert filled.get(p.sequence_id, 0) == p.offset
        filled[p.sequence_id] = p.offset + p.length
    assert sorted(filled) == list(range(len(filled)))
    assert all(n == 64 for s, n in filled.items() if s < len(filled) - 1)
    assert packing.concat_and_cut(brute.documents(spark, [])).count() == 0


def test_quality_scores(spark):
    folder = "/root/testdata/sf0.01"
    scores = QUERIES["op10_bradley_terry"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scores.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_of_odd_rows_and_without_labels(spark):
    docs = brute.documents(spark, ODD, [(None, "no id", "en", "s", 1), (1, "again", "en", "s", 1)])
    none = local_table(spark, [], "doc_id long, quality int, toxic int")
    got = bradley_terry.quality_scores(docs, none).collect()
    assert len(got) == len(ODD) + 2 and {r.score for r in got} == {0.5}
    some = local_table(spark, [(0, 1, 0), (3, 0, None), (3, 0, 1), (None, 1, 0), (4, None, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    assert bradley_terry.quality_scores(docs, some).count() == len(ODD) + 2
    assert bradley_terry.quality_scores(brute.documents(spark, []), some).count() == 0


def test_pair_fit_orders_what_features_tell():
    dice = np.random.default_rng(5)
    rows = dice.normal(size=(400, bradley_terry.FEATURES))
    labels = (rows[:, 3] > -0.8).astype(int)
    model = bradley_terry.fit_pairs(rows, labels)
    assert ((model.scores(rows) >= 0.3) == (labels == 1)).mean() > 0.97


def test_learning_sample_is_the_lowest_hashes(spark):
    ids = spark.range(5000).select(F.col("id").alias("doc_id"))
    ranked = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    for most in (0, 1, 7, 700, 4999, 5000, 9000):
        assert [r.doc_id for r in bradley_terry.lowest_hashes(ids, most).collect()] == ranked[:most], most
    assert bradley_terry.lowest_hashes(ids.limit(0), 5).count() == 0


def test_pair_fit_matches_descent_over_all_pairs():
    dice = np.random.default_rng(11)
    rows = np.zeros((60, bradley_terry.FEATURES))
    rows[:, :6] = dice.normal(size=(60, 6))
    labels = (rows[:, 0] - rows[:, 1] + dice.normal(size=60) > 0).astype(int)
    model = bradley_terry.fit_pairs(rows, labels, pairs=40_000)
    z = np.zeros(rows.shape)
    z[:, :6] = ((rows - rows.mean(axis=0))[:, :6] / rows.std(axis=0)[:6]).clip(-8, 8)
    gaps = np.array([a - b for a in z[labels == 1] for b in z[labels == 0]])

    def loss(w):
        return np.log1p(np.exp(-(gaps @ w))).mean() + 0.5e-4 * w @ w

    w = np.zeros(bradley_terry.FEATURES)
    for _ in range(250):  # plain Newton steps
        p = 1 / (1 + np.exp(gaps @ w))
        slope = -gaps.T @ p / len(gaps) + 1e-4 * w
        bend = (gaps * (p * (1 - p))[:, None]).T @ gaps / len(gaps) + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
    got = model.weights
    assert loss(w) <= loss(got) + 1e-6 and loss(got) < loss(w) + 0.02
    order, want = np.argsort(model.raw(rows)), np.argsort(z @ w)
    assert np.corrcoef(np.argsort(order), np.argsort(want))[0, 1] > 0.98


def test_pipeline_decisions_take_effect(spark):
    columns = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    show_package(spark)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before)
        ids = sorted(before)
        if name == "near_duplicates":
            assert sorted(after) == sorted(set(brute.least_reachable(ids, [brute.simhash(before[i]) for i in ids])))
        if name == "decontamination":
            verdicts = brute.contamination([before[i] for i in ids], items)
            assert sorted(after) == [i for i, v in zip(ids, verdicts, strict=True) if not v[-1]]
        if name == "personal_data":
            assert not any(brute.base_spans(t) for t in after.values())
            assert all(re.search(r"\[(EMAIL|IP|CARD|PHONE|TERM|REMOVED)\]", after[i]) or after[i] == before[i] for i in after)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in pieces.collect()} == set(after)
