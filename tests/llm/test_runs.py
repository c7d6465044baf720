"""Periodic runs against trying every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from farelens.llm import runs
from farelens.llm.queries import op12_periodic_runs, with_planted_periods
from tests.llm.fixtures import no_docs, odd_docs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _every(words, min_length=12):
    """(start, length, period) by trying every period."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(min_length, 2 * q):
                out.setdefault((s, i + q), q)
            i = max(i, s) + (i == s) or i
    return sorted((s, e - s, q) for (s, e), q in out.items())


def _collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _texts(seed, n):
    rng = random.Random(seed)
    for it in range(n):
        size, kind = rng.randint(0, 130), it % 6
        if kind == 0:
            w = [rng.randint(0, 1) for _ in range(size)]
        elif kind == 1:
            w = ([rng.randint(0, 2) for _ in range(rng.randint(1, 25))] * 200)[:size]
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.randint(0, 3)
        elif kind == 2:  # stretches of one period that meet
            p, k = rng.randint(1, 5), rng.randint(1, 40)
            a = [rng.randint(0, 1) for _ in range(p)]
            w = (a * 40)[:k] + [rng.randint(0, 1)] * rng.randint(0, 3) + (a * 40)[rng.randint(0, p) :][: rng.randint(1, 60)]
            w = w + w[: rng.randint(0, len(w))]
        elif kind == 3:  # Fibonacci words
            x, w = [0], [0, 1]
            while len(w) < size:
                x, w = w, w + x
            w = w[:size]
        elif kind == 4:  # powers of powers
            u = [rng.randint(0, 1) for _ in range(rng.randint(1, 6))] * rng.randint(1, 12) + [rng.randint(0, 2)]
            w = (u * 3)[: size + 20]
        else:
            w = [rng.randint(0, 4) for _ in range(size)]
            for _ in range(2):
                i, k = rng.randint(0, len(w)), rng.randint(1, 30)
                w = w[:i] + w[max(0, i - k) : i] * rng.randint(1, 5) + w[i:]
        yield [str(x) for x in w]


@pytest.mark.parametrize("min_length", [12, 20])
def test_runs_match_every_period(min_length):
    for words in _texts(min_length, 900):
        got = runs.find_runs(np.array([int(x) for x in words], np.int64), min_length)
        assert list(zip(*(x.tolist() for x in got))) == _every(words, min_length), words


def test_wavelet_tree():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 300, 500)
    tree = runs.WaveletTree(values)
    lo = rng.integers(0, 500, 400)
    hi = lo + rng.integers(0, 500 - lo + 1)
    x = rng.integers(0, 600, 400)
    for a, b, v, below, after in zip(lo, hi, x, tree.below(lo, hi, x), tree.successor(lo, hi, x)):
        own = values[a:b]
        assert below == (own < v).sum() and after == min(own[own >= v], default=-1)


def _want(rows):
    out = []
    for i, text in rows:
        words = WORDS.findall(text or "")
        found = _every(words)
        out.append((i, len(words), found, _collapsed(words, found)))
    return sorted(out, key=repr)


def _found(df):
    return sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in df.collect()), key=repr)


def test_documents(spark, monkeypatch):
    rows = [(i, " \n".join(w), "en", "a", 1) for i, w in enumerate(_texts(5, 120))]
    rows += [(500, "a b c d e f " * 400 + "tail", "en", "a", 1), (501, "Ü ß x " * 30, "de", "b", 1), (501, "Ü ß x " * 30, "de", "b", 1)]
    docs = odd_docs(spark, rows)
    want = _want([(r[0], r[1]) for r in rows])
    assert _found(runs.periodic_runs(docs)) == want


def test_odd_rows(spark):
    docs = odd_docs(spark).where("doc_id is null or doc_id <> 6")
    assert _found(runs.periodic_runs(docs)) == _want([(r.doc_id, r.text) for r in docs.collect()])
    assert runs.periodic_runs(no_docs(spark)).count() == 0


def test_one_word_many_times(spark):
    text = "word " * 200_000 + "end"
    r = runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [tuple(x) for x in r.runs] == [(0, 200_000, 1)] and r.collapsed == "word end"


def test_texts_do_not_mix():
    """A run does not cross from one text to the next."""
    counts, start, length, period, kept = runs._detect([[b"a", b"b"] * 5, [b"a", b"b"] * 5, [], [b"c"] * 12])
    assert counts.tolist() == [0, 0, 0, 1] and (start[0], length[0], period[0]) == (0, 12, 1) and kept[3] == b"c"


def test_query(spark, tmp_path):
    rows = [(i, " ".join(f"{i}w{j}" for j in range(i % 97))) for i in range(300)] + [(None, "x " * 20), (301, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    planted = {r.doc_id: r.text for r in with_planted_periods(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect()}
    got = {r.doc_id: tuple(r)[1:] for r in op12_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        words = WORDS.findall(text or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
            assert planted[i] == " ".join(words)
        found = _every(words)
        s, k, q = min(((s, k, q) for s, k, q in found), key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        want = (len(found), s, k, q, None if s is None else 1000 * k // q, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(_collapsed(words, found).encode()).hexdigest())
        assert got[i] == want, i
