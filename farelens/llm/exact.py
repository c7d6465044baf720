"""Exact dedup over an extendible-hash index kept on shared files.

The key of a text is the leading bits of the SHA-256 of its normalised form. A first
pass writes every row's digest; from the keys the directory is doubled until no bucket
holds more than ``bucket_keys`` of them. Then the texts are sent to the owner of their
bucket, a key range: there the texts of a key are chained and compared byte by byte, and
an entry takes the count and the best row of its copies. Copies of a hot key are combined
on the map side before they are sent. The entries are the index, on shared files in the
order of the buckets; documents are answered from it alone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, HOT_SHARE, clean_text, join_hot, stored, whole_row

KEY_BITS = 60
BUCKET_KEYS = 1024


def normalised(text: str = "text") -> Column:
    """The text (null: empty) without its blanks."""
    return F.regexp_replace(clean_text(text), f"{BLANK}+", "")


def _key(digest: Column, bits: int) -> Column:
    whole = F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")
    return F.shiftright(whole, KEY_BITS - bits)


def _slot(key: str | Column, depth: int, bits: int) -> Column:
    return F.shiftright(key, bits - depth) if depth else F.lit(0).cast("bigint")


def _best(text: str, id_col: str) -> Column:
    """Code points and id packed in one decimal, so that a hash aggregate can
    take the longest original and, among equals, the smallest id (null last)."""
    after = F.expr(f"coalesce(9223372036854775808BD - cast(`{id_col}` as decimal(20,0)), 0BD)")
    return F.length(clean_text(text)).cast("decimal(12,0)") * F.expr("36893488147419103232BD") + after


def _best_id(packed: str) -> Column:
    after = F.expr(f"{packed} % 36893488147419103232BD")
    return F.when(after > 0, F.expr("9223372036854775808BD") - after).cast("bigint")


def directory(keys: DataFrame, bits: int = KEY_BITS, bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """(buckets, global depth) for a frame of distinct ``key``s.

    Starts at the depth where the mean bucket is full and doubles while a bucket
    overflows: overfull buckets split, the others keep their local depth. Columns:
    bucket (the first key of its range), local_depth, n_keys."""
    n = keys.count()
    depth = min(bits, max(0, math.floor(math.log2(max(1, n) / bucket_keys))))
    leaves, open_keys = None, keys
    while True:
        held = open_keys.groupBy(_slot("key", depth, bits).alias("slot")).agg(F.count(F.lit(1)).alias("n_keys"))
        full = F.col("n_keys") > bucket_keys if depth < bits else F.lit(False)
        done = held.where(~full).select(
            F.shiftleft("slot", bits - depth).alias("bucket"), F.lit(depth).alias("local_depth"), "n_keys"
        )
        leaves = done if leaves is None else leaves.unionByName(done)
        over = held.where(full).select("slot")
        if depth == bits or over.isEmpty():
            return leaves, depth
        open_keys = open_keys.withColumn("slot", _slot("key", depth, bits)).join(over, "slot", "left_semi").select("key")
        depth += 1


def digests(docs: DataFrame, text: str = "text", id_col: str = "doc_id", bits: int = KEY_BITS) -> DataFrame:
    """(doc_id, sha, key) of every row, written once."""
    sha = F.sha2(normalised(text), 256)
    rows = stored(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), sha.alias("sha")), "rows")
    return rows.withColumn("key", _key(F.col("sha"), bits))


def owned_entries(docs: DataFrame, chains: DataFrame, n_rows: int, depth: int, text: str, id_col: str, bits: int) -> DataFrame:
    """(key, chain_length, text_sha256, keep_id, group_size): one entry per distinct
    normalised text, made by the owner task of its key range (slots of ``depth`` bits).

    Rows of a hot key are combined by (key, text) before they leave their task; there
    are fewer than HOT_SHARE such keys. The others, few rows a key, are sent as they
    are, once."""
    texts = docs.select(normalised(text).alias("norm"), _best(text, id_col).alias("best"))
    texts = texts.withColumn("key", _key(F.sha2("norm", 256), bits))
    hot = chains.where(F.col("key_rows") > n_rows // HOT_SHARE).select("key")
    sent = texts.withColumn("n", F.lit(1).cast("bigint"))
    if not hot.isEmpty():
        many = texts.join(F.broadcast(hot), "key", "left_semi").groupBy("key", "norm")
        many = many.agg(F.max("best").alias("best"), F.count(F.lit(1)).alias("n"))
        sent = sent.join(F.broadcast(hot), "key", "left_anti").unionByName(many)
    owned = sent.withColumn("owner", _slot("key", depth, bits)).repartition("owner")
    # inside the owner: texts of a key are told apart by their bytes
    chained = owned.groupBy("owner", "key", "norm").agg(F.sum("n").alias("group_size"), F.max("best").alias("best"))
    entry = chained.select("owner", "key", F.sha2("norm", 256).alias("text_sha256"), _best_id("best").alias("keep_id"), "group_size")
    length = F.count(F.lit(1)).over(Window.partitionBy("owner", "key"))
    return entry.withColumn("chain_length", length).drop("owner")


def build_index(
    docs: DataFrame, rows: DataFrame, n_rows: int, text: str = "text", id_col: str = "doc_id", bits: int = KEY_BITS, bucket_keys: int = BUCKET_KEYS
) -> DataFrame:
    """The index on shared files, range-ordered by bucket and key: key, bucket,
    local_depth, key_rows, chain_length (distinct texts under the key), text_sha256,
    keep_id, group_size. ``rows``: the ``digests`` of docs.

    An empty table gives an empty index."""
    chains = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("key_rows")), "chains")
    buckets, depth = directory(chains.select("key"), bits, bucket_keys)
    buckets = stored(buckets, "buckets")
    # the shallowest buckets' depth: a slot of it is one bucket, or a range of split ones
    shallow = buckets.agg(F.min("local_depth")).first()[0] or 0
    entries = stored(owned_entries(docs, chains, n_rows, shallow, text, id_col, bits), "entries")
    # a bucket of local depth d owns 2^(depth - d) neighbouring slots of the doubled directory
    owned = buckets.select(
        F.explode(
            F.expr(f"sequence(0, cast(shiftleft(1L, {depth} - local_depth) as int) - 1)")
        ).alias("i"), "bucket", "local_depth",
    ).select((_slot("bucket", depth, bits) + F.col("i")).alias("slot"), "bucket", "local_depth")
    placed = chains.withColumn("slot", _slot("key", depth, bits)).join(owned, "slot").drop("slot")
    return stored(entries.join(placed, "key").repartitionByRange("bucket", "key").sortWithinPartitions("key"), "index")


def _answers(rows: DataFrame, index: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` (sha, key) with the entry of their text."""
    # key_rows counts every row of the key, so the hot ones are known before the join
    found = join_hot(rows, index, "key", "key_rows", n_rows)
    return found.where((F.col("chain_length") == 1) | (F.col("sha") == F.col("text_sha256")))


def _kept() -> Column:
    return F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("doc_id").isNull() & F.col("keep_id").isNull())


def _row_key(doc_id: str, sha: str) -> Column:
    return F.concat_ws(":", F.col(doc_id).cast("string"), F.col(sha)).alias("rk")


def exact_groups(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", bits: int = KEY_BITS, bucket_keys: int = BUCKET_KEYS
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, bucket.

    Texts are equal when identical without blanks; null counts as empty, and all
    empty texts are one group. The longest original stays, then the smallest id
    (a null id comes last). Rows that repeat an id and a text share one decision.
    Extra columns are ignored; an empty table gives no rows."""
    rows = digests(docs, text, id_col, bits)
    n_rows = rows.count()
    found = _answers(rows, build_index(docs, rows, n_rows, text, id_col, bits, bucket_keys), n_rows)
    return found.select("doc_id", "keep_id", "group_size", _kept().alias("kept"), "text_sha256", "bucket")


def drop_exact(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` (all columns, whatever their names) with one row of each group of equal
    texts: the one that ``exact_groups`` keeps. Where several rows of a group have the
    kept id, the longest original stays, then the smallest text, then the smallest
    row as JSON. An empty table gives no rows."""
    rows = digests(docs, text, id_col)
    n_rows = rows.count()
    groups = _answers(rows, build_index(docs, rows, n_rows, text, id_col), n_rows)
    # rows that are not the only one of their id and text, or go
    told = groups.groupBy(_row_key("doc_id", "sha")).agg(F.count(F.lit(1)).alias("n"), F.max(_kept()).alias("stays"))
    told = stored(told.where("n > 1 or not stays"), "told")
    # the caller's columns travel in one struct, so that no name of theirs meets one of ours
    sha = F.sha2(normalised(text), 256)
    own = docs.select(whole_row(docs), F.col(id_col).cast("bigint").alias("doc_id"), sha.alias("sha"))
    own = own.select("row", _row_key("doc_id", "sha"))
    hot = F.col("n") > n_rows // HOT_SHARE  # fewer than HOT_SHARE, by counting
    others = own.join(F.broadcast(told.where(hot).select("rk")), "rk", "left_anti")
    left = others.join(told.where(~hot).select("rk"), "rk", "left_anti")
    if told.where("stays").isEmpty():
        return left.select("row.*")
    again = own.join(F.broadcast(told.where(hot & F.col("stays")).select("rk")), "rk", "left_semi")
    again = again.unionByName(others.join(told.where(~hot & F.col("stays")).select("rk"), "rk", "left_semi"))
    original = F.coalesce(F.col("row").getField(text).cast("string"), F.lit(""))
    order = F.struct(-F.length(original), original, F.to_json("row"))
    one = again.groupBy("rk").agg(F.min_by("row", order).alias("row"))
    return left.select("row").unionByName(one.select("row")).select("row.*")
