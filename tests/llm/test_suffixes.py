"""Repeated passages against a table of all 50-word runs."""

import random
from collections import defaultdict

import pytest

from farelens.llm import suffixes
from farelens.llm.common import documents
from tests.conftest import SF_SMALL
from tests.llm.fixtures import no_docs, odd_docs


def _spans(rows, n=suffixes.MIN_WORDS):
    texts, owners = [(i, (t or "").encode().split()) for i, t in rows if i is not None], defaultdict(set)
    for i, w in texts:
        for k in range(len(w) - n + 1):
            owners[tuple(w[k : k + n])].add(i)
    out = set()
    for i in {i for i, _ in texts}:
        runs = sorted({(k, k + n) for j, w in texts if j == i for k in range(len(w) - n + 1) if len(owners[tuple(w[k : k + n])]) > 1})
        while runs:
            begin, end = runs.pop(0)
            while runs and runs[0][0] <= end:
                end = max(end, runs.pop(0)[1])
            out.add((i, begin, end - begin))
    return out


def _found(df):
    rows = [tuple(r) for r in suffixes.repeated_passages(df).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def _planted():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(4))
    text = lambda n: [word() for _ in range(n)]
    a, b, c = text(200), text(60), text(51)
    rows, docs = [], []
    for i in range(12):
        docs.append(text(80) + a[i * 5 : i * 5 + 45 + i] + text(40))  # around the limit, and sliding
        docs.append(text(30) + b + text(rnd.randrange(90)))
        docs.append(text(rnd.randrange(3)) + c)
        # the same right part after other left parts: the longest neighbour is not the partner
        docs.append(text(20) + a[100 - 2 * i : 140] + text(20))
    docs += [["same"] * 120, ["same"] * 60, text(49), a[:50], a[:49], ["z"] * 30 + b[:50] + ["z"] * 30 + b[:50]]
    rows = [(i, " ".join(w) if i % 2 else "\n".join(w), "en", "a", 0) for i, w in enumerate(docs)]
    return rows


@pytest.mark.parametrize("part_rows", [suffixes.PART_ROWS, 7, 1])
def test_planted_passages(spark, monkeypatch, part_rows):
    """Small parts put neighbours on both sides of many borders."""
    monkeypatch.setattr(suffixes, "PART_ROWS", part_rows)
    rows = _planted()
    assert _found(odd_docs(spark, rows)) == _spans([(r[0], r[1]) for r in rows])


def test_given_documents(spark):
    docs = documents(spark, SF_SMALL)
    assert _found(docs) == _spans([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows_and_empty_table(spark):
    docs = odd_docs(spark)
    assert _found(docs) == set()
    assert suffixes.repeated_passages(no_docs(spark)).count() == 0
    long = [(1, "w " * 3000 + "end", None, None, None), (2, None, None, None, None), (None, "w " * 3000, None, None, None), (3, "w " * 60, None, None, None)]
    assert _found(odd_docs(spark, long * 2)) == {(1, 0, 3000), (3, 0, 60)}
