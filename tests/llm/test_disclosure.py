"""Terms that disclose an entity across line ends and anywhere in its document."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))

import brute  # noqa: E402

from mercadal.llm import disclosure  # noqa: E402
from mercadal.llm.tables import show_package  # noqa: E402


@pytest.fixture(autouse=True)
def package(spark):
    show_package(spark)


def test_no_border_hides_a_term(spark):
    fill = [f"plain line {w} talks about other things {i}" for i, w in enumerate("abcdefghij" * 30)]
    plain = " ".join(["plain"] * 31)
    told = ["Name: Zorblatt\nEmail: jo@x.org"] * 3  # across a line end
    told += [f"{plain} Quimby al@y.org talks {i}" for i in range(3)]  # across the 32nd token
    far = " ".join(["things"] * 200)
    told += [f"Wexford bo@z.org other {i} {far}\nline\nwexford again" for i in range(3)]  # a later mention
    told += [f"ci@q.org {i} {far} Yarrow" for i in range(3)]  # too far from the entity
    told += ["di@v.org Umbra\nUmbra"]  # a term of two lines, an entity of one
    docs = brute.documents(spark, [*[f"{t} talks {i}" for i, t in enumerate(told)], *fill])
    clean = {r.doc_id: r.text.lower() for r in disclosure.redact(docs).collect()}
    texts = [clean[i] for i in range(len(told))]
    for word, ids in (("zorblatt", range(3)), ("quimby", range(3, 6)), ("wexford", range(6, 9))):
        assert not any(word in texts[i] for i in ids), word
    assert all("yarrow" in texts[i] for i in range(9, 12))
    assert texts[12].count("umbra") == 2
    assert all("plain" in texts[i] and "talks" in texts[i] for i in range(3, 6))
    assert [clean[i + len(told)] for i in range(len(fill))] == fill
