"""The registered query of each corpus operator, with production parameters over
whole tables, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dialogue, embeddings, exact, langid, lines, mixing, pieces, quality, runs, simhash, sketches, suffixes, urls
from .common import BLANK, doc_crc, documents


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    profiles = langid.fit(docs, usable=~langid.held_out())
    own = langid.held_out().alias("held_out")
    return langid.predict(docs, profiles).select("doc_id", own, "lang_pred", "score", "distance")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(documents(spark, sf_dir))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    found = quality.quality(docs, labels, usable=~quality.held_out())
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(documents(spark, sf_dir, "embeddings"))


def piece_model(path: str | None = None) -> bytes:
    return pieces.read_model(path or public_tokenizers.path("piece_bpe_32k.model"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_spans(documents(spark, sf_dir), piece_model(), end=True, names=False, back=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.xxhash64("begins", "ends").alias("spans_hash"),
    )


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark, documents(spark, sf_dir, "pages"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_groups(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.curriculum(documents(spark, sf_dir))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketches.beside_next(documents(spark, sf_dir))
    own, edited, after = F.col("hashes"), F.col("edited_hashes"), F.col("next_hashes")
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketches.fingerprint(own).alias("fingerprint"),
        sketches.fingerprint(edited).alias("edited_fingerprint"),
        sketches.containment(own, edited).alias("near_edited"),
        sketches.containment(own, after).alias("near_next"),
        sketches.resemblance(own, edited).alias("resemblance_edited"),
        sketches.resemblance(own, after).alias("resemblance_next"),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` in which the hash of the id picks one document in ten, whose words from
    some word on repeat with some period; its text is then the words joined by a space."""
    h = doc_crc()
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, source(i))), " ")

    words = F.filter(F.split("text", f"{BLANK}+"), lambda w: w != "")
    planted = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))
    return docs.withColumn("text", F.when(h % 10 == 0, F.get(planted, F.lit(0))).otherwise(F.col("text")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_periods(documents(spark, sf_dir).select("doc_id", "text")))
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("early"), (-r["period"]).alias("small")))
    best = F.array_max(ranked)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.early")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.small")).alias("period"),
        F.expr("(1000 * best.length) div -best.small").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that the hash of ``conv_id:turn``
    deals to a row (nulls are one space): dropped, emptied, without sentence ends,
    repeated, or given to the user."""
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled["text"], "[.!?]", "")).otherwise(filled["text"])
    role = F.when(kind == 4, "user").otherwise(filled["role"])
    times = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "conversations")
    found = dialogue.digests(dialogue.edits(damaged_conversations(rows))).withColumnRenamed("conv_id", "__id")
    every = rows.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    every = every.join(found, F.col("conv_id").eqNullSafe(F.col("__id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    sha = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), sha)


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_language_id,
        op3_suffix_dedup,
        op4_simhash_near_dedup,
        op5_quality_classifier,
        op6_embedding_near_dedup,
        op7_sentencepiece,
        op8_url_filters,
        op9_exact_dedup,
        op10_source_mixing,
        op11_fingerprints,
        op12_periodic_runs,
        op13_conversation_repair,
    )
}

ORACLE = {
    "op1_line_dedup": r"""
WITH l AS (
  SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents),
c AS (SELECT trim(line, ' ' || chr(9) || chr(13)) AS line FROM l
  GROUP BY ALL HAVING count(DISTINCT coalesce('s' || source, 't')) >= 10),
x AS (SELECT coalesce(list(line), []) AS bad FROM c WHERE line <> ''),
d AS (SELECT doc_id, text, coalesce(string_split(text, chr(10)), []) AS lines FROM documents),
k AS (SELECT doc_id, text, lines,
  list_filter(lines, lambda y: NOT list_contains(bad, trim(y, ' ' || chr(9) || chr(13)))) AS kept FROM d, x)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text,
  CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_removed
FROM k
""",
    "op8_url_filters": r"""
WITH a AS (
  SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0
    THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, any_value(host) AS host, any_value(path) AS path,
  max_by(h || p, length(h || p)) AS rule, coalesce(max_by(v, length(h || p)), 'allow') AS verdict
FROM u LEFT JOIN r ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id
""",
    "op9_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
""",
    "op10_source_mixing": r"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, 't') AS src, md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')) AS ord,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY src),
r AS (SELECT *, (row_number() OVER (ORDER BY src) - 1) % 3 AS weight_no FROM s),
w AS (SELECT *, CAST(CASE weight_no WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight,
    2 * source_size AS cap FROM r),
b AS (SELECT *, coalesce(sum(cap) OVER o, 0) AS cap_before, coalesce(sum(weight) OVER o, 0) AS weight_before,
    CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS words, sum(weight) OVER () AS weights,
    row_number() OVER (ORDER BY cap / weight, src) AS place
  FROM w WINDOW o AS (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (words - CAST(cap_before AS DOUBLE)) / (weights - weight_before) AS level FROM b),
f AS (SELECT level AS reached FROM l WHERE level * weight <= cap ORDER BY place LIMIT 1),
t AS (SELECT l.*, least(CAST(cap AS DOUBLE), coalesce((SELECT reached FROM f) * weight, CAST(cap AS DOUBLE))) AS target FROM l),
p AS (SELECT d.*, t.source_size, t.target, t.weight_no, CAST(floor(t.target) AS BIGINT) AS goal,
    CAST(coalesce(sum(d.size) OVER (PARTITION BY d.src ORDER BY
      CAST(('0x' || substr(ord, 1, 8)) AS BIGINT) % (SELECT CAST(1 AS BIGINT) << CAST((floor(log2(count(*))) // 2) AS BIGINT) FROM d),
      ord, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN t USING (src)),
m AS (SELECT *, greatest(0, least(size, goal - start)) + greatest(0, least(size, goal - source_size - start)) AS taken,
    least(CAST(1 AS DOUBLE), (CAST(start AS DOUBLE) + size / CAST(2 AS DOUBLE)) / target) AS f FROM p)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
  CASE WHEN taken > 0 THEN round(CAST(least(greatest(CASE weight_no
    WHEN 0 THEN 2 * f / (CAST(1.5 AS DOUBLE) + sqrt(greatest(CAST(2.25 AS DOUBLE) + CAST(-2 AS DOUBLE) * f, 0)))
    WHEN 1 THEN 2 * f / (1 + sqrt(CAST(1 AS DOUBLE)))
    ELSE 2 * f / (CAST(0.5 AS DOUBLE) + sqrt(CAST(0.25 AS DOUBLE) + CAST(2 AS DOUBLE) * f)) END, 0), 1) AS DOUBLE), 9) END AS position
FROM m
""",
    "op11_fingerprints": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
x AS (SELECT doc_id, n, t, coalesce(lead(t) OVER o, first_value(t) OVER o) AS nt FROM d WINDOW o AS (ORDER BY doc_id DESC NULLS LAST)),
e AS (SELECT doc_id, n, t, nt, left(t, n - n // 2) || left(nt, n // 2) AS et FROM x),
v AS (SELECT doc_id, 0 AS k, t AS s FROM e UNION ALL SELECT doc_id, 1, et FROM e UNION ALL SELECT doc_id, 2, nt FROM e),
w AS (SELECT doc_id, k, regexp_extract_all(s, '[^\x20\x09-\x0D]+') AS w FROM v),
h AS (SELECT doc_id, k, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) ELSE
  list_transform(range(greatest(len(w) - 4, 1)), lambda i: left(md5(array_to_string(w[i + 1:i + 5], ' ')), 16)) END AS h FROM w),
f AS (SELECT doc_id, k, list_sort(list_distinct(list_filter(h, lambda y: y < '2000000000000000'))) AS f, h FROM h),
g AS (SELECT doc_id, k, CASE WHEN len(f) > 0 OR len(h) = 0 THEN f ELSE [list_min(h)] END AS f FROM f),
p AS (SELECT e.doc_id, n, et, a.f AS a, b.f AS b, c.f AS c, len(list_intersect(a.f, b.f)) AS ab, len(list_intersect(a.f, c.f)) AS ac
  FROM e JOIN g a ON a.doc_id = e.doc_id AND a.k = 0 JOIN g b ON b.doc_id = e.doc_id AND b.k = 1 JOIN g c ON c.doc_id = e.doc_id AND c.k = 2)
SELECT doc_id, n AS n_chars, sha256(et) AS edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
  CASE WHEN len(a) + len(b) = 0 THEN 1.0 WHEN len(a) = 0 THEN 0.0 ELSE ab / len(a) END AS near_edited,
  CASE WHEN len(a) + len(c) = 0 THEN 1.0 WHEN len(a) = 0 THEN 0.0 ELSE ac / len(a) END AS near_next,
  CASE WHEN len(a) + len(b) = 0 THEN 1.0 ELSE ab / (len(a) + len(b) - ab) END AS resemblance_edited,
  CASE WHEN len(a) + len(c) = 0 THEN 1.0 ELSE ac / (len(a) + len(c) - ac) END AS resemblance_next
FROM p
""",
    "op13_conversation_repair": r"""
WITH RECURSIVE
tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
  lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS t),
crc AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ord(c) AS BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind FROM conversations, tab),
dam AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM crc WHERE kind <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM dam),
flt AS (SELECT conv_id, turn, role, text, i, left(role, 1) AS w,
    CASE WHEN bare = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS v FROM num),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (v IS NOT NULL AND v || w NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM flt GROUP BY conv_id),
opt AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS more,
    CASE w WHEN 'u' THEN 'K' ELSE 'R' END AS lu, chr(10) || CASE w WHEN 'u' THEN role ELSE 'user' END || ':' || text AS ru,
    CASE w WHEN 'a' THEN 'K' ELSE 'R' END AS la, chr(10) || CASE w WHEN 'a' THEN role ELSE 'assistant' END || ':' || text AS ra FROM flt),
cst AS (SELECT *, CASE WHEN gone THEN 1000000000000 ELSE more + CASE w WHEN 'u' THEN 0 ELSE 3 END END AS cu,
    CASE WHEN gone THEN 1000000000000 ELSE more + CASE w WHEN 'a' THEN 0 ELSE 3 END END AS ca,
    CASE WHEN gone OR w <> 's' THEN 1000000000000 ELSE more END AS cs FROM opt),
vit AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {'c': CAST(0 AS BIGINT), 'e': '', 'r': ''} AS o, {'c': CAST(1000000000000 AS BIGINT), 'e': '', 'r': ''} AS s,
    {'c': CAST(1000000000000 AS BIGINT), 'e': '', 'r': ''} AS u, {'c': CAST(1000000000000 AS BIGINT), 'e': '', 'r': ''} AS a FROM sums
  UNION ALL
  SELECT x.conv_id, y.i, {'c': o.c + 4, 'e': o.e || 'D', 'r': o.r},
    list_min([{'c': s.c + 4, 'e': s.e || 'D', 'r': s.r}, {'c': o.c + cs, 'e': o.e || 'K', 'r': o.r || chr(10) || role || ':' || text}]),
    list_min([{'c': u.c + 4, 'e': u.e || 'D', 'r': u.r}, {'c': o.c + cu, 'e': o.e || lu, 'r': o.r || ru}, {'c': s.c + cu, 'e': s.e || lu, 'r': s.r || ru},
      {'c': a.c + cu, 'e': a.e || lu, 'r': a.r || ru}, {'c': u.c + cu + 3, 'e': u.e || 'I' || lu, 'r': u.r || chr(10) || 'assistant:' || ru}]),
    list_min([{'c': a.c + 4, 'e': a.e || 'D', 'r': a.r}, {'c': u.c + ca, 'e': u.e || la, 'r': u.r || ra},
      {'c': o.c + ca + 3, 'e': o.e || 'I' || la, 'r': o.r || chr(10) || 'user:' || ra}, {'c': s.c + ca + 3, 'e': s.e || 'I' || la, 'r': s.r || chr(10) || 'user:' || ra},
      {'c': a.c + ca + 3, 'e': a.e || 'I' || la, 'r': a.r || chr(10) || 'user:' || ra}])
  FROM vit x JOIN cst y ON x.conv_id IS NOT DISTINCT FROM y.conv_id AND y.i = x.i + 1),
fin AS (SELECT v.conv_id, list_min([o, a, {'c': u.c + 3, 'e': u.e || 'I', 'r': u.r || chr(10) || 'assistant:'},
    {'c': s.c + 6, 'e': s.e || 'II', 'r': s.r || chr(10) || 'user:' || chr(10) || 'assistant:'}]) AS b
  FROM vit v JOIN sums z ON v.conv_id IS NOT DISTINCT FROM z.conv_id AND v.i = z.n)
SELECT d.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.e, '') AS audit,
  sha256(coalesce(substr(b.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN sums z ON d.conv_id IS NOT DISTINCT FROM z.conv_id LEFT JOIN fin f ON d.conv_id IS NOT DISTINCT FROM f.conv_id
""",
}
