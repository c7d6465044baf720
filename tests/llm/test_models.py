"""Language ID, quality and embeddings: brute force, held-out accuracy, recall."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelens.llm import embeddings, langid, quality
from farelens.llm.common import documents
from tests.conftest import SF_ORACLE
from tests.llm.fixtures import no_docs, odd_docs


def _grams(text):
    out = Counter()
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        p = f" {w} "
        out.update(g for n in (1, 2, 3) for i in range(len(p) - n + 1) if (g := p[i : i + n]).strip())
    return out


def _number(g):
    code = [0 if c == " " else ord(c) for c in g]
    n = 0
    for c in code:
        n = n << 21 | c
    return -n if len(g) == 2 else n


@pytest.mark.parametrize("text", ["", "  ", "a", "Ab ab, ABC! d1e_f", "x" * 300, "é ü\n漢字 ß" * 50, "one two  two"])
def test_counts_are_those_of_padded_words(text, monkeypatch):
    monkeypatch.setattr(langid, "BLOCK", 7)
    got = dict(zip(*(x.tolist() for x in langid.counts(text))))
    assert got == {_number(g): n for g, n in _grams(text).items()}


def test_prediction_is_the_nearest_profile(spark):
    docs = documents(spark, SF_ORACLE).limit(150)
    profiles = langid.fit(docs, usable=~langid.held_out())
    rows = docs.collect()
    train = {}
    for r in rows:
        if __import__("zlib").crc32(str(r.doc_id).encode()) % 4 != 2:
            train.setdefault(r.lang, Counter()).update(_grams(r.text))
    top = lambda c: [g for _, g in sorted((-n, _number(x)) for x, n in c.items())][: langid.PROFILE]
    assert profiles == {k: top(c) for k, c in train.items()}
    got = {r.doc_id: r for r in langid.predict(docs, profiles).collect()}
    for r in rows:
        own = top(_grams(r.text))
        far = {k: sum(min(abs(p.index(g) - i), 300) if g in p else 300 for i, g in enumerate(own)) for k, p in profiles.items()}
        best = min(far, key=lambda k: (far[k], k))
        assert (got[r.doc_id].lang_pred, got[r.doc_id].distance) == (best, far[best])
        assert math.isclose(got[r.doc_id].score, 1 - far[best] / (300 * len(own)))


def test_language_of_held_out_documents(spark):
    docs = documents(spark, SF_ORACLE)
    profiles = langid.fit(docs, usable=~langid.held_out())
    found = langid.predict(docs, profiles).join(docs.where(langid.held_out()).select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)


def test_language_odd_rows(spark):
    docs = odd_docs(spark)
    profiles = langid.fit(docs)
    assert set(profiles) == {"en", "de", "fr", "es"} - {"de", "es"} | {k for k in ("de", "es") if k in profiles}
    got = langid.predict(docs, profiles).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {3, 4, 5, 8}
    left = langid.drop_undetermined(docs, profiles, 0.0)
    assert left.columns == docs.columns and left.count() == docs.count() - 4
    assert langid.fit(no_docs(spark)) == {} and langid.predict(no_docs(spark), profiles).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, {}).collect()} == {"und"}


def test_quality_of_held_out_documents(spark):
    docs, labels = documents(spark, SF_ORACLE), documents(spark, SF_ORACLE, "labels")
    found = quality.quality(docs, labels, usable=~quality.held_out())
    rows = found.join(labels, "doc_id").where(quality.held_out()).collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.95 and sum(r.predicted == r.quality for r in rows) > 0.93 * len(rows)


def test_discriminant_equals_the_formula(spark):
    rng = np.random.default_rng(1)
    p = len(quality.FEATURES)
    x = {c: rng.standard_normal((200, p)) @ rng.standard_normal((p, p)) + c for c in (0, 1)}
    model = quality.Discriminant({c: (len(v), v.sum(0), v.T @ v) for c, v in x.items()}, pooled=0.0, sphere=0.0)
    test = rng.standard_normal((20, p))
    want = []
    for c in (0, 1):
        cov, mean = np.cov(x[c].T, bias=True), x[c].mean(0)
        d = test - mean
        want.append(np.log(0.5) - 0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1]))
    assert np.allclose(model.score(test), 1 / (1 + np.exp((want[0] - want[1]) / p)), atol=1e-8)


def test_quality_odd_rows(spark, monkeypatch):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (7, 0, None), (11, None, 1), (None, 1, 0), (2, 1, 0), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.quality(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert {r.score for r in quality.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(no_docs(spark), labels).count() == 0
    assert quality.features(None) == quality.features("") and all(map(math.isfinite, quality.features("")))
    whole = quality.features("ab cd. " * 4000)
    monkeypatch.setattr(quality, "BLOCK", 7 * 1000)
    assert np.allclose(whole, quality.features("ab cd. " * 4000), atol=0.02)


def test_nearest_lattice_point():
    """Against all lattice points around."""
    rng = np.random.default_rng(3)
    steps = embeddings.roots()
    assert steps.shape == (240, 8) and np.allclose((steps**2).sum(1), 2) and len({tuple(r) for r in steps}) == 240
    x = rng.standard_normal((300, 8)) * 3
    near = embeddings.nearest_e8(x)
    twice = np.rint(2 * near)
    assert np.allclose(twice, 2 * near) and (np.rint(near.sum(1)) % 2 == 0).all()
    assert ((twice % 2 == 0).all(1) | (twice % 2 == 1).all(1)).all()
    own = ((x - near) ** 2).sum(1)
    assert (own <= 1 + 1e-9).all()  # the covering radius
    assert (((x[:, None] - near[:, None] - steps) ** 2).sum(2).min(1) >= own - 1e-9).all()


def _vectors():
    rng = np.random.default_rng(7)
    rows = []
    for label in (1, 2):
        centers = rng.standard_normal((30, 32))
        for k, c in enumerate(centers):
            for _ in range(1 + k % 6):
                rows.append((c + rng.standard_normal(32) * 0.08 * np.linalg.norm(c) / math.sqrt(32), label))
    rows += [(rows[0][0], 1)] * 12 + [(rows[0][0] * 3, 1), (rows[0][0], 2)]
    out = [(i, [float(np.float32(v)) for v in x], lab) for i, (x, lab) in enumerate(rows)]
    n = len(out)
    out += [(n, None, 1), (n + 1, [0.0] * 32, 1), (n + 2, [None] + [1.0] * 31, 1), (n + 3, [float("nan")] + [1.0] * 31, 1)]
    out += [(n + 4, [float("inf")] * 32, 1), (n + 5, [], 1), (n + 6, out[0][1], None), (n + 7, [1.0, 2.0], 1), (n + 8, [2.0, 4.0], 1)]
    return out


def test_vectors_match_brute_force(spark):
    rows = _vectors()
    good = {i: (np.array(v) / np.linalg.norm(v), lab) for i, v, lab in rows if v and lab is not None and None not in v and np.isfinite(v).all() and any(v)}
    near = {i: [j for j in good if j != i and good[j][1] == good[i][1] and len(good[j][0]) == len(good[i][0]) and good[i][0] @ good[j][0] >= 0.98] for i in good}
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("class", "n", "v", "a", "b", "cell")})
    got = {r.vec_id: r for r in embeddings.near_vectors(df).collect()}
    assert set(got) == {i for i, *_ in rows}
    links, found = sum(map(len, near.values())), sum(r.n_links for r in got.values())
    assert 0.98 * links <= found <= links and links > 300
    for i, r in got.items():
        assert r.n_links <= len(near.get(i, [])) and r.kept == (r.component_id == i)
        if not near.get(i):
            assert r.component_id == i
    if found == links:
        for i in good:
            seen, todo = {i}, [i]
            while todo:
                todo += (new := [j for j in near[todo.pop()] if j not in seen])
                seen.update(new)
            assert got[i].component_id == min(seen)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_rows_are_rejected_by_their_own_text(spark):
    """A rejected and a clean row share a null id, two others share an id."""
    clean = "the cat sat on the mat and the dog lay by the door"
    rows = [(None, "12345 !!!", "en", "a", 1), (None, clean, "en", "a", 2), (7, None, "en", "b", 3), (7, clean, None, "b", 4), (8, clean, "en", "b", 5)]
    docs = odd_docs(spark, rows)
    profiles = langid.fit(odd_docs(spark, [(1, clean, "en", "a", 1)]))
    left = langid.drop_undetermined(docs, profiles, 0.25)
    assert left.columns == docs.columns
    kept = {r.n_chars: r for r in left.collect()}
    assert kept == {r.n_chars: r for r in docs.collect() if r.n_chars in (2, 4, 5)}
