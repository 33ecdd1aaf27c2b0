"""Exact passages: the suffix sort and the operator against plain versions."""

from __future__ import annotations

import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))

import brute  # noqa: E402

from mercadal.llm import suffixes  # noqa: E402
from mercadal.llm.queries import QUERIES  # noqa: E402
from mercadal.llm.tables import show_package  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def package(spark):
    show_package(spark)


def brute_removal(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha) of each row, in order."""
    least = {}
    texts = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for a in range(len(t) - length + 1):
            w = t[a : a + length]
            least[w] = min(i, least.get(w, i))
    out = []
    for (doc_id, _), (i, t) in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if least[t[a : a + length]] < i:
                gone[a : a + length] = b"\1" * length
        spans = sum(1 for a in range(len(t)) if gone[a] and not (a and gone[a - 1]))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return tuple((v is None, v or 0) if not isinstance(v, str) else v for v in row)


def check(spark, rows, parts=3):
    docs = brute.documents(spark, [], [(i, t, "en", "s", 0) for i, t in rows]).repartition(parts)
    docs = docs.withColumnRenamed("source", "slice").selectExpr("*", "1 AS bucket", "2 AS data")
    got = sorted(map(tuple, suffixes.repeats_removed(docs).collect()), key=key)
    assert got == sorted(brute_removal(rows), key=key)
    return got


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_suffixes_are_sorted_by_their_bytes(letters, monkeypatch):
    dice = random.Random(1)
    once = bytes(dice.choice(letters.encode()) for _ in range(700))
    data = np.frombuffer(once * 3 + b"a" * 300 + once[:100], np.uint8)
    starts = np.array([dice.randrange(len(data) - 50) for _ in range(1500)])
    groups = np.array([dice.randrange(3) for _ in range(1500)])
    for collide in (False, True):
        if collide:  # hashes that tell nothing: the check by bytes has to sort
            monkeypatch.setattr(suffixes.Prefixes, "of", lambda self, at, length: np.zeros(len(at), dtype=np.uint64))
        numbers, equal = suffixes.sorted_suffixes(data, starts, groups)
        keys = [(groups[i], data[starts[i] : starts[i] + 50].tobytes()) for i in numbers]
        assert sorted(numbers) == list(range(1500)) and keys == sorted(keys)
        assert equal.tolist() == [False] + [a == b for a, b in zip(keys, keys[1:], strict=False)]


def test_common_extensions():
    dice = random.Random(2)
    data = np.frombuffer(bytes(dice.choice(b"ab") for _ in range(400)), np.uint8)
    a = np.array([dice.randrange(350) for _ in range(300)])
    b = np.array([dice.randrange(350) for _ in range(300)])
    got = suffixes.common(suffixes.Prefixes(data), a, b, 50)
    for x, y, n in zip(a, b, got, strict=True):
        assert n == next((k for k in range(50) if data[x + k] != data[y + k]), 50)


def test_removal_matches_brute_force_on_the_given_documents(spark):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op13_suffix_array"](spark, SMALL).collect()), key=key)
    assert got == sorted(brute_removal(table), key=key)
    assert any(r[2] for r in got)


def odd_rows():
    dice = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "é", "\x00", "long" * 9]
    prose = lambda n: " ".join(dice.choice(words) for _ in range(n))
    common = prose(40)
    rows = [(i, prose(dice.randrange(5, 60)) + common[: dice.randrange(len(common))] + prose(9)) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x" * 49), (103, "x" * 49), (104, "y" * 50), (105, "y" * 50), (106, "z" * 4000), (107, "z" * 500)]
    rows += [(108, prose(4000)), (109, common * 3), (50, common), (50, common), (5, common), (None, common), (None, "n" * 60), (None, "n" * 60)]
    rows += [(110 + i, f"{dice.random()} {common} {dice.random()}" * 2) for i in range(30)]  # one hot passage, other neighbours
    return rows


def test_removal_of_odd_rows(spark, monkeypatch):
    rows = odd_rows()
    got = check(spark, rows)
    assert {r[0]: r[2:4] for r in got if r[0] in (102, 103, 104, 105, 106)} == {102: (0, 0), 103: (0, 0), 104: (0, 0), 105: (50, 1), 106: (0, 0)}
    for rows in ([], [(1, None)], [(1, "a" * 60)], [(2, "a" * 60), (2, "a" * 60)]):
        check(spark, rows, 1)


def test_slices_blocks_and_split_grams_do_not_show(spark, monkeypatch):
    """Small slices and blocks, many groups, and grams that are split by passages:
    the functions run in other processes, so the work of the tasks is called here."""
    monkeypatch.setattr(suffixes, "BLOCK", 700)
    monkeypatch.setattr(suffixes, "SLICE", 900)
    for hot, buckets in ((4096, 7), (3, 7), (1, 1)):
        monkeypatch.setattr(suffixes, "HOT", hot)
        rows = odd_rows()
        assert sorted(worked_by_hand(rows, buckets), key=key) == sorted(brute_removal(rows), key=key)


def worked_by_hand(rows, buckets):
    import pyarrow as pa

    blobs, held, number = {}, [], 0
    for row in rows:
        held.append(row)
        if sum(len(t or "") for _, t in held) > 900:
            blobs[number], held, number = held, [], number + 1
    blobs[number] = held
    for n, some in blobs.items():
        texts = [(t or "").encode() for _, t in some]
        ids = np.array([suffixes.NO_ID if i is None else i for i, _ in some], dtype=np.int64)
        sizes = np.array(list(map(len, texts)), dtype=np.int64)
        blobs[n] = suffixes.packed(ids, sizes, np.frombuffer(b"".join(texts), dtype=np.uint8))
    slices = pa.RecordBatch.from_arrays([pa.array(list(blobs)), pa.array(list(blobs.values()))], names=["slice", "blob"])

    def grouped(tables, by):
        whole = pa.concat_tables(tables)
        return {k.as_py(): whole.filter(pa.compute.equal(whole[by], k)) for k in whole[by].unique()}

    empty = pa.Table.from_batches([suffixes.rows_of({"slice": [], "bucket": [], "data": []}, suffixes.ANSWERS)])
    reports = [pa.Table.from_batches([b]) for b in suffixes.report_grams(buckets)([slices])]
    grams = [suffixes.shared_grams(g) for g in grouped(reports, "bucket").values()]
    told = grouped([*grams, empty], "slice")
    whole = pa.Table.from_batches([slices])
    one = {n: whole.filter(pa.compute.equal(whole["slice"], n)) for n in blobs}
    sent = [suffixes.send_stretches(buckets)(one[n], told.get(n, empty)) for n in blobs]
    answers = [suffixes.answer_stretches(g) for g in grouped(sent, "bucket").values()]
    told = grouped([*grams, *answers, empty], "slice")
    out = [suffixes.removal(buckets)(one[n], told.get(n, empty)) for n in blobs]
    return [tuple(r.values()) for t in out for r in t.to_pylist()]
