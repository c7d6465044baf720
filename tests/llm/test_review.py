"""Exact statistics at block borders, sums of the fit, split cells, class numbers, null ids."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelens.llm import embeddings, langid, lines, quality, urls
from farelens.llm.common import discard, stored

TEXTS = [
    "", "one", "The same the same word, 12 times!\nThe same the same word, 12 times!\n\n next  LINE here.",
    "a" * 50 + " b", " \n\t ", "x1 y2. Z3, ± é É ß 漢字   wide space", "go go go go stop. go go",
]


def _plain(text):
    """The twelve statistics, one by one."""
    words = text.split()
    letters = sum(c.isalpha() for c in text)
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    n, w = max(1, len(text)), max(1, len(words))
    marks = sum(not c.isalpha() and not c.isdigit() and not c.isspace() and c not in ".," and c.isprintable() for c in text)
    return [
        math.log1p(len(words)), math.log1p(max(1, letters) / w), math.sqrt(sum(c.isalpha() and c.isupper() for c in text) / max(1, letters)),
        math.sqrt(sum(c.isdigit() and not c.isalpha() for c in text) / n), math.sqrt(sum(c in ".," for c in text) / w), math.sqrt(marks / w),
        math.sqrt(sum(a == b for a, b in zip(words, words[1:])) / w), math.log1p(len(set(words))) - math.log1p(len(words)),
        math.sqrt(max(Counter(words).values(), default=0) / w), math.log1p(n / max(1, len(lines))),
        math.sqrt(1 - len(set(lines)) / max(1, len(lines))), math.sqrt(max(1, letters) / n),
    ]


@pytest.mark.parametrize("block", [1, 3, 10, quality.BLOCK])
def test_features_do_not_depend_on_blocks(monkeypatch, block):
    monkeypatch.setattr(quality, "BLOCK", block)
    for t in TEXTS + ["".join(TEXTS) * 5]:
        assert np.allclose(quality.features(t), _plain(t), atol=1e-12), t


def test_a_text_longer_than_a_block_is_exact():
    text = "".join(f"word{i % 977} " for i in range(300_000))
    assert len(text) > 2 * quality.BLOCK
    assert np.allclose(quality.features(text), _plain(text), atol=1e-12)


def test_fit_adds_up_all_labelled_rows(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["good", "bad.", "Ugly", "12", "!!"], size=rng.integers(1, 60))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 3 % 2) for i in range(0, 300, 2)] + [(None, 1), (7, None)], "doc_id bigint, quality int")
    found = quality.fit(quality.statistics(docs), labels)
    moments = {}
    for c in (0, 1):
        x = np.array([_plain(texts[i]) for i in range(0, 300, 2) if i % 3 % 2 == c])
        moments[c] = len(x), x.sum(axis=0), x.T @ x
    want = quality.Discriminant(moments)
    for c in (0, 1):
        for got, expected in zip(found.classes[c], want.classes[c]):
            assert np.allclose(got, expected, atol=1e-8)


def test_crowded_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_SHARE", 4)
    monkeypatch.setattr(embeddings, "CELL_BLOCKS", 3)
    rows = [(i, 1 if i % 3 == 0 else i % 40, i % 2 == 0) for i in range(600)]
    entries = spark.createDataFrame(rows, "class bigint, cell bigint, home boolean")
    got = sorted(map(tuple, embeddings._meetings(entries).collect()))
    assert got == sorted((a, b) for a, c, h in rows if h for b, d, k in rows if not k and c == d)


def test_a_number_shared_by_two_classes_is_given_up(spark, monkeypatch):
    seeds = []

    class Functions:
        def __getattr__(self, name):
            return getattr(F, name)

        def xxhash64(self, *cols):
            seeds.append(cols)
            return F.lit(5).cast("bigint") if len(seeds) == 1 else F.xxhash64(*cols)

    monkeypatch.setattr(embeddings, "F", Functions())
    rows = spark.createDataFrame([(1, 0, [1.0, 0.0]), (2, 0, [0.0, 1.0]), (3, 0, [1.0, 0.0])], "vec_id bigint, label bigint, v array<double>")
    classes, _ = embeddings._numbered(rows)
    assert len(seeds) == 2 and sorted(r.n for r in classes.collect()) == [1, 2]


def test_rows_without_an_id_teach_languages(spark):
    rows = [(None, f"the quick word number {i} is here", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    used = langid._training_rows(docs, "text", "lang", "doc_id", F.lit(True), 500).count()
    assert 400 < used < 600 and set(langid.fit(docs, most=500)) == {"en"}


def test_discarded_tables_are_gone(spark):
    kept = stored(spark.range(10), "ten")
    assert kept.count() == 10
    discard(kept)
    with pytest.raises(Exception):
        spark.read.parquet(kept.stored_at).count()


def test_rule_lists_are_literals_of_the_plan(spark, monkeypatch):
    seen, build = [], urls.build

    def watched(listed, universe, *more):
        seen.append(listed._jdf.queryExecution().executedPlan().toString())
        return build(listed, universe, *more)

    monkeypatch.setattr(urls, "build", watched)
    pages = spark.createDataFrame([(1, "https://example.org/es/x")], "page_id bigint, url string")
    assert urls.judge(spark, pages).first().verdict == "block"
    assert len(seen) == 2 and not any("RDD" in p or "Python" in p for p in seen)


def test_pairs_are_made_of_near_lines_only(spark):
    """Lines on 2, 10 and 200 sites: a distinct count for the one at the threshold."""
    rows = [(h, f"s{i}") for h, n in ((1, 2), (2, 10), (3, 200)) for i in range(n)]
    found = {r.h: (r.sites, r.exact) for r in lines.site_spread(spark.createDataFrame(rows * 3, "h bigint, site string"), 10).collect()}
    assert found[2] == (10, True) and 1 not in found and not found[3][1] and abs(found[3][0] - 200) < 12
