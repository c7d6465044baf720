"""SimHash fingerprints and near-duplicate classes by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import clean_text, join_hot, stored, whole_row
from .graph import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Shingles hashed at a time; bounds the memory beside the text itself.
BLOCK = 1 << 15


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the shingles' XXH64; no words (or null): 0.

    ``bytes.lower`` and ``bytes.split`` touch ASCII only: A-Z and the six blanks.
    Words joined by one space make every shingle a slice of one buffer."""
    if not text:
        return 0
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle_words + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1))
    ends = ends[shingle_words - 1 :] if len(words) >= shingle_words else ends[-1:]
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        pairs = zip(starts[i : i + BLOCK].tolist(), ends[i : i + BLOCK].tolist())
        h = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in pairs], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def _digest(text: str) -> Column:
    return F.sha2(clean_text(text), 256)


def fingerprints(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle_words: int = SHINGLE_WORDS, digest: bool = False
) -> DataFrame:
    """(doc_id, fp): one row per document, fp as a signed 64-bit integer; with
    ``digest`` also the text's SHA-256 (null as empty) as ``sha``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle_words) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], names=["doc_id", "fp", *b.schema.names[2:]])

    own = [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")]
    if digest:
        return docs.select(*own, _digest(text).alias("sha")).mapInArrow(hashed, "doc_id bigint, fp bigint, sha string")
    return docs.select(*own).mapInArrow(hashed, "doc_id bigint, fp bigint")


def _bits(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def signatures(fps: DataFrame) -> DataFrame:
    """Deletion variants (sig, fp) of distinct fingerprints. The 64 bits are cut
    into two segments of 32; of two fingerprints that differ in at most three
    bits one segment differs in at most one, so they share the variant of that
    segment with this bit left out. sig packs segment, left-out bit and the rest."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    cut = fps.select("fp", F.posexplode(F.array(low, high)).alias("segment", "half"))
    cut = cut.select("fp", "segment", "half", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("bit"))
    rest = F.col("half").bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, bit)")))
    place = F.shiftleft((F.col("segment") * 32 + F.col("bit")).cast("bigint"), 32)
    return cut.select(place.bitwiseOR(rest).alias("sig"), "fp")


def near_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) whose connected components are those of all pairs of distinct
    fingerprints ``fps`` within ``max_bits`` (at most 3) bits, without listing
    the pairs of a dense group.

    First every bucket is ordered by fingerprint and neighbours are verified. The
    components of these links label the buckets' rows; only in a bucket of three
    or more rows under several labels are pairs still open, and each open pair has
    an end outside the bucket's largest label. Those rows are equality-joined with
    their bucket and verified, pairs of one label left out."""
    order = Window.partitionBy("sig").orderBy("fp")
    rows = signatures(fps).select(
        "sig", "fp", F.lag("fp").over(order).alias("last"), F.lead("fp").over(order).alias("next")
    )
    held = stored(rows.where("last is not null or next is not null"), "buckets")
    first = held.where(F.col("last").isNotNull() & (_bits("fp", "last") <= max_bits)).select(
        F.col("last").alias("a"), F.col("fp").alias("b")
    )
    first = stored(first.distinct(), "links")
    label = components(first)
    # a bucket of two rows is settled by its one comparison
    some = held.where("last is not null and next is not null").select("sig").distinct()
    open_rows = held.select("sig", "fp").join(some, "sig", "left_semi")
    tagged = open_rows.join(label, F.col("fp") == F.col("node"), "left")
    tagged = stored(tagged.select("sig", "fp", F.coalesce("component", "fp").alias("label")), "tagged")
    sizes = tagged.groupBy("sig", "label").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("sig").agg(F.max(F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
    main = main.where("labels > 1").select("sig", F.col("main.label").alias("main"))
    outside = tagged.join(main, "sig").where("label <> main").select("sig", F.col("fp").alias("a"), F.col("label").alias("la"))
    within = tagged.select("sig", F.col("fp").alias("b"), F.col("label").alias("lb"))
    near = (outside["sig"] == within["sig"]) & (F.col("la") != F.col("lb")) & (_bits("a", "b") <= max_bits)
    return first.unionByName(outside.join(within, near).select("a", "b").distinct())


def near_groups(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
    digest: bool = False,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id
    (smallest id reachable over links of at most ``max_bits`` bits), and with
    ``digest`` the text's SHA-256 as ``sha``.

    Null, empty and blank texts have fingerprint zero, linked like any other.
    Texts of fewer words than a shingle are one shingle. Rows that repeat an id
    are each returned; a null id is ignored when the smallest is taken. Extra
    columns are ignored; an empty table gives no rows."""
    rows = stored(fingerprints(docs, text, id_col, shingle_words, digest), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "nodes")
    label = components(near_links(nodes.select("fp"), max_bits))
    named = nodes.join(label, F.col("fp") == F.col("node"), "left")
    named = stored(named.select("fp", "least", "n", F.coalesce("component", "fp").alias("label")), "labels")
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("held"))
    table = join_hot(named.select("fp", "n", "label"), smallest, "label", "held", named.count()).select("fp", "n", "component_id")
    out = join_hot(rows, table, "fp", "n", rows.count())
    extra = ["sha"] if digest else []
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", *extra)


def drop_near(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` (all columns, whatever their names) with one document of each
    near-duplicate group, the smallest id; rows with a null id stay. An empty table
    gives no rows.

    Rows that repeat an id are each decided by the group of their own text: one goes
    if its group holds a smaller id, whatever becomes of the others. All rows of a
    group that have its smallest id stay."""
    gone = near_groups(docs, text, id_col, digest=True).where("doc_id <> component_id").select("doc_id", "sha").distinct()
    # the fingerprint is a function of the text, so the text's digest stands for it
    own = docs.select(whole_row(docs), F.col(id_col).cast("bigint").alias("doc_id"), _digest(text).alias("sha"))
    return own.join(gone, ["doc_id", "sha"], "left_anti").select("row.*")
