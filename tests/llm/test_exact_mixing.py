"""Exact dedup and mixing against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from farelens.llm import exact, mixing
from tests.llm.fixtures import odd_docs, no_docs

BLANKS = re.compile(r"[\x20\x09-\x0D]")


def _groups(rows):
    held = defaultdict(list)
    for i, t in rows:
        held[BLANKS.sub("", t or "")].append((i, t or ""))
    out = Counter()
    for norm, group in held.items():
        best = min(group, key=lambda r: (-len(r[1]), math.inf if r[0] is None else r[0]))[0]
        for i, _ in group:
            out[(i, best, len(group), i == best, hashlib.sha256(norm.encode()).hexdigest())] += 1
    return out


def _found(df):
    return Counter(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()))


@pytest.mark.parametrize("bits,bucket_keys", [(60, 1024), (60, 2), (2, 1)])
def test_groups_match_brute_force_with_splits_and_collisions(spark, bits, bucket_keys):
    """Two bits force chains of colliding texts, tiny buckets force doublings."""
    docs = odd_docs(spark)
    want = _groups([(r.doc_id, r.text) for r in docs.collect()])
    assert _found(exact.exact_groups(docs, bits=bits, bucket_keys=bucket_keys)) == want


def test_directory_splits_only_overfull_buckets(spark):
    keys = spark.createDataFrame([(k,) for k in [*range(8), 200]], "key bigint")
    leaves, depth = exact.directory(keys, bits=8, bucket_keys=2)
    rows = sorted(map(tuple, leaves.collect()))
    assert depth == 7 and sum(n for *_, n in rows) == 9 and max(n for *_, n in rows) <= 2
    assert (128, 2, 1) in rows or any(b >= 128 and d < depth for b, d, _ in rows)


def test_empty_table(spark):
    assert exact.exact_groups(no_docs(spark)).count() == 0
    assert exact.drop_exact(no_docs(spark)).count() == 0
    assert mixing.curriculum(no_docs(spark)).count() == 0
    assert mixing.mix(no_docs(spark)).count() == 0


def test_drop_exact_keeps_columns_and_one_row_of_each_text(spark):
    docs = odd_docs(spark)
    left = exact.drop_exact(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    norms = [BLANKS.sub("", r.text or "") for r in rows]
    assert sorted(norms) == sorted({BLANKS.sub("", r.text or "") for r in docs.collect()})
    assert {r.doc_id for r in rows} >= {2, 5, 9} and all(r.kept == "own kept" for r in rows)


def test_drop_exact_keeps_the_longest_of_a_repeated_id(spark):
    rows = [(1, "a b", "z"), (1, "ab", "y"), (1, "a  b", "x"), (1, "a  b", "w"), (2, "a b c d", "v"), (None, "n n", "u"), (None, "n  n", "t"), (None, "nn", "s")]
    for parts in (1, 3, 8):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, note string").repartition(parts, "note")
        assert sorted(map(tuple, exact.drop_exact(docs).collect()), key=str) == [(1, "a  b", "w"), (2, "a b c d", "v"), (None, "n  n", "t")]


def test_hot_texts_are_combined_before_they_are_sent(spark):
    """Hot and other keys meet in one index, with chains of colliding texts."""
    rows = [(i, "the very common text" if i % 3 == 0 else f"text {i % 700}" + " " * (i % 4)) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    for bits, keys in ((60, 64), (5, 2)):
        assert _found(exact.exact_groups(docs, bits=bits, bucket_keys=keys)) == _groups(rows)


def test_owners_hold_whole_buckets(spark):
    rows = [(i, f"text {i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    digests = exact.digests(docs)
    index = exact.build_index(docs, digests, 600, bucket_keys=16)
    held = index.groupBy("bucket", "local_depth").agg(F.countDistinct("key").alias("n")).collect()
    assert max(r.n for r in held) <= 16 and sum(r.n for r in held) == 600
    for r in held:  # a bucket is the key range of its leading bits
        assert r.bucket % (1 << (exact.KEY_BITS - r.local_depth)) == 0


def _targets(sizes, weights=(5, 2, 1)):
    """Reshare the excess until none is above, step by step."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, target = 1.5 * sum(sizes.values()), {}
    open_ = set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def test_mix_matches_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), None, f"s{i % 7}" if i % 11 else None, 0) for i in range(400)]
    docs = odd_docs(spark, rows)
    out = mixing.curriculum(docs).collect()
    assert len(out) == 400
    sizes = Counter()
    source = {r[0]: r[3] for r in rows}
    for r in out:
        sizes[source[r.doc_id]] += r.size
    want, taken = _targets(sizes), Counter()
    for r in out:
        assert r.size == 1 + r.doc_id * 7 % 40 and 0 <= r.taken <= 2 * r.size
        assert r.source_size == sizes[source[r.doc_id]]
        assert math.isclose(r.target, want[source[r.doc_id]], rel_tol=1e-12)
        taken[source[r.doc_id]] += r.taken
    assert all(taken[s] == math.floor(want[s] + 1e-9) for s in sizes)
    at = [r.position for r in out if r.position is not None]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    again = mixing.curriculum(docs.repartition(5)).collect()
    assert again == out


def test_documents_without_an_id_queue_by_their_text(spark):
    rows = [(None, f"text {i} " * (1 + i % 5), None, "s", 0) for i in range(300)]
    placed = mixing.placements(odd_docs(spark, rows))
    assert placed.select("ord").distinct().count() == 300
    taken = [r.taken for r in placed.collect()]
    assert sum(taken) == math.floor(1.5 * sum(2 * (1 + i % 5) for i in range(300)))


def test_schedule_shifts_positions():
    fade, flat = mixing.SCHEDULES[0], mixing.SCHEDULES[1]
    assert mixing.integral(fade) == mixing.integral(flat) == 1.0


def test_inverse_demand_inverts_the_integral(spark):
    knots = ((0.0, 0.2), (0.25, 3.0), (0.5, 0.0), (1.0, 1.0))
    whole = mixing.integral(knots)

    def demand(t):
        done = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            if t <= t0:
                break
            u = min(t, t1)
            done += (u - t0) * (w0 + w0 + (w1 - w0) * (u - t0) / (t1 - t0)) / 2
        return done / whole

    df = spark.range(1, 100).select((F.col("id") / 100.0).alias("f"))
    for f, t in df.select("f", mixing.inverse_demand(F.col("f"), knots)).collect():
        assert math.isclose(demand(t), f, abs_tol=1e-9)


def test_mix_returns_whole_documents(spark):
    docs = odd_docs(spark)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    times = Counter((r.doc_id, r.text) for r in out.collect())
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    assert set(times) <= texts and not any((t or "").strip() == "" for _, t in times)
