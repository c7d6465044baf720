"""Document fingerprints against plain Python."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from farelens.llm import sketches
from tests.llm.fixtures import no_docs, odd_docs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _hashes(text, words=5):
    own = WORDS.findall(text or "")
    n = max(len(own) - words + 1, min(len(own), 1))
    return {hashlib.md5(" ".join(own[i : i + words]).encode()).hexdigest()[:16] for i in range(n)}


def _sketch(text, scale=8):
    every = _hashes(text)
    return sorted(h for h in every if int(h, 16) < 16**16 // scale) or ([min(every)] if every else [])


def _next(rows):
    """(row, the text that follows): rows of an id by the digest of id and text."""
    order = sorted(rows, key=lambda r: (math.inf if r[0] is None else -r[0], hashlib.md5(f"{'' if r[0] is None else r[0]}\n{r[1] or ''}".encode()).hexdigest()))
    return [(r, order[(i + 1) % len(order)][1] or "") for i, r in enumerate(order)]


def _want(rows):
    out = Counter()
    for (i, text, *_), after in _next(rows):
        text = text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out[(i, len(text), edited, tuple(_sketch(text)), tuple(_sketch(edited)), tuple(_sketch(after)))] += 1
    return out


def _found(df):
    return Counter((r.doc_id, r.n_chars, r.edited, tuple(r.hashes), tuple(r.edited_hashes), tuple(r.next_hashes)) for r in df.collect())


def test_documents_beside_the_next(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert _found(sketches.beside_next(docs)) == _want(rows)


@pytest.mark.parametrize("rows", [[(1, "one two three four five six")], [(None, None)], [(3, "a b")] * 4])
def test_few_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert _found(sketches.beside_next(docs)) == _want(rows)


def test_many_equal_rows_and_null_ids(spark):
    rows = [(None, "the same words again and again " * 3)] * 2500 + [(None, f"other text number {i} " * 9) for i in range(400)] + [(7, "last")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert _found(sketches.beside_next(docs)) == _want(rows)


def test_long_text_is_hashed_in_blocks(spark):
    text = " ".join(f"w{i * i % 7919}" for i in range(3 * sketches.BLOCK + 17))
    got = spark.createDataFrame([(text,)], "t string").select(sketches.sketch(F.col("t")).alias("s")).first().s
    assert got == _sketch(text) and len(got) > 100


def test_empty_table(spark):
    assert sketches.beside_next(no_docs(spark)).count() == 0
    assert sketches.fingerprints(no_docs(spark)).count() == 0


def test_every_row_has_a_fingerprint(spark):
    docs = odd_docs(spark)
    got = Counter((r.doc_id, tuple(r.hashes)) for r in sketches.fingerprints(docs).collect())
    assert got == Counter((r.doc_id, tuple(_sketch(r.text))) for r in docs.collect())


def test_sketches_merge(spark):
    a = " ".join(f"a{i}" for i in range(300))
    cases = [(a, "x y z"), ("p q", "r s t u"), ("", "r s t u v w"), ("", ""), (a, a + " and more of it")]
    df = spark.createDataFrame(cases, "a string, b string").select("a", "b", sketches.merge(sketches.sketch(F.col("a")), sketches.sketch(F.col("b"))).alias("m"))
    for r in df.collect():
        both = _hashes(r.a) | _hashes(r.b)
        assert r.m == (sorted(h for h in both if int(h, 16) < 16**16 // 8) or ([min(both)] if both else []))


def test_containment_between_unequal_documents(spark):
    long = [f"w{i}" for i in range(40_000)]
    part = " ".join(long[5000:7000])
    df = spark.createDataFrame([(part, " ".join(long)), (part, part), ("", ""), ("", part), (part, "")], "a string, b string")
    s = df.select(sketches.sketch(F.col("a")).alias("a"), sketches.sketch(F.col("b")).alias("b"))
    got = s.select(sketches.containment(F.col("a"), F.col("b")), sketches.containment(F.col("b"), F.col("a")), sketches.resemblance(F.col("a"), F.col("b"))).collect()
    assert got[0][0] == 1.0 and abs(got[0][1] - 0.05) < 0.01 and abs(got[0][2] - 0.05) < 0.01
    assert [tuple(r) for r in got[1:]] == [(1.0, 1.0, 1.0), (1.0, 1.0, 1.0), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0)]


def test_no_python_on_the_path(spark):
    plan = sketches.beside_next(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|InArrow|InPandas", plan)
