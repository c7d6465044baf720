"""Cross-site boilerplate lines: HyperLogLog spread per line hash, exact near the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, stored

MIN_SITES = 10
LG_K = 12
#: Standard errors of the sketch within which a line is counted exactly.
BAND = 3.0


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def line_hash(line: Column) -> Column:
    return F.xxhash64(trimmed(line))


def _lines(text: str) -> Column:
    return F.split(F.col(text).cast("string"), "\n")


def site_spread(refs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(h, occurrences, sites, exact) of the lines on at least ``min_sites`` sites.

    ``refs``: h, site. Every task sketches the sites of its own lines and the sketches
    of a line merge, so a line that holds a third of all rows brings one row per task. A
    line whose estimate is within BAND standard errors (and at least one site) of the
    threshold gets a distinct count instead: only its (line, site) pairs are made."""
    sketches = refs.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"), F.count(F.lit(1)).alias("occurrences"))
    spread = stored(sketches.select("h", "occurrences", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") > 1), "spread")
    width = max(1.0, BAND * 1.04 / 2 ** (lg_k / 2) * min_sites)
    near = F.abs(F.col("sites") - min_sites) <= width
    asked = join_hot(refs, spread.where(near).select("h", "occurrences"), "h", "occurrences", refs.count())
    pairs = asked.groupBy("h", "site").agg(F.first("occurrences").alias("occurrences"))
    exact = pairs.groupBy("h").agg(F.first("occurrences").alias("occurrences"), F.count(F.lit(1)).alias("sites"))
    sure = spread.where(~near & (F.col("sites") > min_sites)).withColumn("exact", F.lit(False))
    return sure.unionByName(exact.where(F.col("sites") >= min_sites).withColumn("exact", F.lit(True)))


def drop_boilerplate(
    docs: DataFrame, text: str = "text", site: str = "source", id_col: str = "doc_id", min_sites: int = MIN_SITES
) -> DataFrame:
    """One row per document: doc_id, text without the lines found on at least
    ``min_sites`` sites, n_lines, n_removed.

    Lines are compared by the 64-bit hash of the line without outer blanks; blank
    lines are neither counted nor removed. A null site is a site of its own. A null
    text stays null with 0 lines, an empty one has one blank line. Rows that repeat
    an id are each returned; extra columns are ignored; an empty table gives no rows.

    Hits are gathered per document (no more than its own lines) and joined back on
    the id, so texts move once."""
    own = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("t")).alias("site"),
        F.col(text).cast("string").alias("text"),
    )
    line = own.select("doc_id", "site", F.explode(_lines("text")).alias("line")).where(trimmed(F.col("line")) != "")
    refs = stored(line.select("doc_id", "site", line_hash(F.col("line")).alias("h")), "refs")
    common = stored(site_spread(refs.select("h", "site"), min_sites), "common")
    hits = join_hot(refs.select("doc_id", "h"), common.select("h", "occurrences"), "h", "occurrences", refs.count())
    per_doc = hits.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("h").alias("bad"))
    found = own.join(per_doc, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    keep = F.filter(
        F.col("lines"), lambda x: F.col("bad").isNull() | ~F.array_contains("bad", line_hash(x)) | (trimmed(x) == "")
    )
    found = found.withColumn("lines", F.coalesce(_lines("text"), F.array().cast("array<string>")))
    found = found.withColumn("kept", keep)
    clean = F.when(F.col("text").isNotNull(), F.array_join("kept", "\n"))
    n, left = F.size("lines").cast("bigint"), F.size("kept").cast("bigint")
    return found.select("doc_id", clean.alias("text"), n.alias("n_lines"), (n - left).alias("n_removed"))
