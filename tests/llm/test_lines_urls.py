"""Boilerplate lines and URL rules against plain Python."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from farelens.llm import lines, urls
from tests.llm.fixtures import no_docs, odd_docs


def _clean(rows, min_sites):
    sites = defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            sites[line.strip(" \t\r")].add(source)
    bad = {x for x, s in sites.items() if x and len(s) >= min_sites}
    out = []
    for i, text, _ in rows:
        parts = [] if text is None else text.split("\n")
        kept = [p for p in parts if p.strip(" \t\r") not in bad]
        out.append((i, None if text is None else "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_sites", [2, 10])
def test_boilerplate(spark, min_sites):
    rows = [(i, f"own {i}\n Footer \nshared {i % 3}\n\nnear {i % 4}", "en", f"s{i % 23}", 0) for i in range(60)]
    rows += [(70, "Footer\r\nlast", "en", None, 0), (71, None, None, None, None), (72, "", "en", "s1", 0), (73, "\n\n", "en", "s1", 0)]
    rows += [(None, "Footer\nx", "en", "s1", 0)] * 2 + [(200 + i, f"edge{i}", "en", f"t{j}", 0) for i in range(8) for j in range(8 + i % 4)]
    docs = odd_docs(spark, rows)
    got = lines.drop_boilerplate(docs, min_sites=min_sites).collect()
    assert sorted(map(tuple, got), key=repr) == _clean([(r[0], r[1], r[3]) for r in rows], min_sites)


def test_sketch_decides_far_from_the_threshold(spark):
    refs = spark.range(400).select((F.col("id") % 2).alias("h"), F.concat(F.lit("s"), (F.col("id") % 300).cast("string")).alias("site"))
    found = {r.h: (r.sites, r.exact) for r in lines.site_spread(refs, 10).collect()}
    assert set(found) == {0, 1} and all(not exact and abs(n - 150) < 10 for n, exact in found.values())


def test_empty(spark):
    assert lines.drop_boilerplate(no_docs(spark)).count() == 0


def _parse(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def _judge(url, rules):
    host, path = _parse(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://example.org", "http://example.org/", "https://A.Example.ORG/es/x?q=/fr/", "http://example.org/en/1",
    "http://example.org/en/12/3", "http://example.org/en/2", "http://badexample.org/es/", "ftp://x.com/fr/1#a://b", "http://x.com/de/", "http://x.com?/de/",
    "http://com/de/9", "http://x.net/de/", "http://user@x.com:80/de/", "http://x.com/DE/", "http://É.com/fr/ü", "://x.org/", "http://x.org#/", "http://..org/",
]


@pytest.mark.parametrize("max_bits", [urls.MAX_BITS, 1])
def test_rules(spark, max_bits):
    """With one bit allowed the lists are asked by a join instead."""
    rows = [(i, u) for i, u in enumerate(URLS * 2)] + [(None, "http://q.org/")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumns({c: F.lit("x") for c in ("host", "path", "keys", "rule", "key")})
    got = urls.judge(spark, pages, max_bits=max_bits).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *_judge(u, urls.RULES)) for i, u in rows), key=repr)


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = universe.where("cast(substr(key, 2) as int) % 37 = 0")
    cascade = urls.build(listed, universe)
    assert len(cascade.levels) > 1
    wrong = universe.withColumn("yes", cascade.member(F.col("key"))).where("yes <> (cast(substr(key, 2) as int) % 37 = 0)")
    assert wrong.count() == 0
    assert not urls.build(listed.limit(0), universe).levels
    whole = urls.build(listed, listed)
    assert listed.where(whole.member(F.col("key"))).count() == listed.count()


def test_no_pages_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    assert urls.judge(spark, pages.limit(0)).count() == 0
    assert tuple(urls.judge(spark, pages, rules=(), default="block").first()) == (1, "a.org", "/", None, "block")
