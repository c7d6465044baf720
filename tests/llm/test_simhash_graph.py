"""SimHash fingerprints, links and components against plain Python."""

import random
import re
from collections import Counter

import xxhash

from farelens.llm import graph, simhash
from tests.llm.fixtures import no_docs, odd_docs


def _fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _labels(values, linked):
    """Smallest value reachable, by repeated search."""
    out = {}
    for v in sorted(values):
        if v in out:
            continue
        todo = [v]
        out[v] = v
        while todo:
            x = todo.pop()
            for y in values:
                if y not in out and linked(x, y):
                    out[y] = v
                    todo.append(y)
    return out


def test_fingerprints(spark):
    docs = odd_docs(spark)
    got = Counter(map(tuple, simhash.near_groups(docs).select("doc_id", "fingerprint").collect()))
    assert got == Counter((r.doc_id, f"{_fingerprint(r.text):016x}") for r in docs.collect())


def test_components_of_fingerprints_match_brute_force(spark):
    """Dense balls, chains of three-bit steps and random values."""
    rnd = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(6):
        center = rnd.getrandbits(64)
        fps.add(center)
        bits = rnd.sample(range(64), 12)
        for _ in range(60):
            fps.add(center ^ sum(1 << b for b in rnd.sample(bits, rnd.randrange(1, 5))))
        step = center
        for _ in range(8):
            step ^= sum(1 << b for b in rnd.sample(range(64), 3))
            fps.add(step)
    fps |= {rnd.getrandbits(64) for _ in range(100)}
    want = _labels(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp bigint"))
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 3 for r in links.collect())
    root = {r.node % 2**64: r.component % 2**64 for r in graph.components(links).collect()}
    groups, expected = {}, {}
    for f in fps:
        groups.setdefault(root.get(f, f), set()).add(f)
        expected.setdefault(want[f], set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_groups_on_texts(spark):
    base = [f"word{i}" for i in range(120)]
    rows = [(100 + i, " ".join([*base[:i], "changed", *base[i + 1 :]]), "en", "a", 0) for i in range(30)]
    rows += [(i, " ".join(base), "en", "b", 0) for i in range(40, 45)] + [(3, "", "en", "a", 0), (2, None, "en", "a", 0)]
    docs = odd_docs(spark, rows)
    fp = {r[0]: _fingerprint(r[1]) for r in rows}
    want = _labels(fp, lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 3)
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs).collect()}
    assert got == want
    left = simhash.drop_near(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(set(want.values()))


def test_rows_that_share_an_id_are_decided_by_their_own_text(spark):
    base = [f"w{i}" for i in range(300)]
    near = " ".join([*base[:9], "changed", *base[10:]])
    own = " ".join(f"other{i}" for i in range(300))
    rows = [(1, " ".join(base), "en", "a", 1), (5, near, "en", "a", 2), (5, own, "en", "a", 3), (6, own, "en", "a", 4), (None, near, "en", "a", 5)]
    fp = [_fingerprint(r[1]) for r in rows]
    assert (fp[0] ^ fp[1]).bit_count() <= 3 < (fp[0] ^ fp[2]).bit_count()
    assert sorted(r.n_chars for r in simhash.drop_near(odd_docs(spark, rows)).collect()) == [1, 3, 5]


def test_components(spark):
    rnd = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(1000, x) for x in range(1001, 1100)]
    pairs += [(rnd.randrange(2000, 2300), rnd.randrange(2000, 2300)) for _ in range(200)] + [(5, 5)]
    rnd.shuffle(pairs)
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    nodes = {x for a, b in pairs if a != b for x in (a, b)}
    want = _labels(nodes, lambda a, b: b in near[a])
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == want


def test_empty(spark):
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert simhash.near_groups(no_docs(spark)).count() == 0
    assert simhash.drop_near(no_docs(spark)).count() == 0
