"""Document fingerprints: threshold-scaled sketches of word shingles.

Every shingle hash below a fixed fraction of the hash space is kept, so the sketch of
a text grows with it, the sketch of two texts together is the union of theirs, and the
share of a sketch that another one holds estimates how much of the text the other text
holds, however unequal their lengths. A text without a hash below the threshold keeps
its smallest one: also a union's smallest hash is the smaller of two."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, clean_text, stored

SHINGLE_WORDS = 5
#: One of so many hashes is kept.
SCALE = 8
#: Hex digits of a hash (the first of its MD5).
DIGITS = 16
#: Shingles hashed at a time, which bounds the hashes of a long text in memory.
BLOCK = 4096
#: Equal rows that one task writes.
COPIES = 1000


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def limit(scale: int = SCALE) -> str:
    """The hex digits that a kept hash is below."""
    return f"{16**DIGITS // scale:0{DIGITS}x}"


def _settled(hashes: Column, smallest: Callable[[], Column]) -> Column:
    return _let(hashes, lambda kept: F.when(F.size(kept) > 0, F.array_sort(F.array_distinct(kept))).otherwise(smallest()))


def sketch(text: Column, words: int = SHINGLE_WORDS, scale: int = SCALE) -> Column:
    """The kept hashes of a text, sorted (array of hex strings). A text of fewer words
    than a shingle has one, the whole sequence; a text without words has none."""
    none = F.array().cast("array<string>")

    def hashed(own: Column, first: Column, last: Column) -> Column:
        shingle = lambda i: F.array_join(F.slice(own, i + 1, words), " ")
        return F.transform(F.sequence(first, last), lambda i: F.substring(F.md5(shingle(i).cast("binary")), 1, DIGITS))

    def kept(own: Column) -> Column:
        n = F.greatest(F.size(own) - (words - 1), F.lit(1))
        blocks = F.sequence(F.lit(0), ((n - 1) / BLOCK).cast("int"))

        def of_block(b: Column) -> Column:
            return F.filter(hashed(own, b * BLOCK, F.least((b + 1) * BLOCK, n) - 1), lambda h: h < limit(scale))

        return F.when(
            F.size(own) > 0,
            _settled(F.flatten(F.transform(blocks, of_block)), lambda: F.array(F.array_min(hashed(own, F.lit(0), n - 1)))),
        ).otherwise(none)

    return _let(F.filter(F.split(text, f"{BLANK}+"), lambda w: w != ""), kept)


def merge(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    both = F.array_union(a, b)
    return F.when(F.size(both) == 0, both).otherwise(
        _settled(F.filter(both, lambda h: h < limit(scale)), lambda: F.array(F.array_min(both)))
    )


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; of two empty sketches 1, of one 0."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(F.size(a) == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of shared shingles among all of a and b; of two empty sketches 1."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(
        _let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n))
    )


def packed(hashes: Column) -> Column:
    """Half the bytes, to travel in."""
    return F.unhex(F.array_join(hashes, ""))


def unpacked(data: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.hex(data)), F.lit(f".{{{DIGITS}}}"), F.lit(0))


def fingerprint(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = SHINGLE_WORDS, scale: int = SCALE) -> DataFrame:
    """(doc_id, hashes) of every row: null texts count as empty; repeated rows and null
    ids are kept; extra columns are ignored; an empty table gives no rows."""
    own = F.col(id_col).cast("bigint").alias("doc_id")
    return docs.select(own, sketch(clean_text(text), words, scale).alias("hashes"))


def _chain(rows: DataFrame) -> DataFrame:
    """(key, doc_id, n_chars, copies, next_key) of distinct rows (key, doc_id, n_chars)
    in descending order of id (null last), then key; the last is followed by the first.

    The small rows are range-sorted and numbered: a place is that in its sorted range
    and the sizes of the ranges before, of which there is one row per range."""
    held = rows.groupBy("key", "doc_id", "n_chars").agg(F.count(F.lit(1)).alias("copies"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    placed = held.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = stored(placed, "order").withColumn("part", F.shiftright("place", 33))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = F.expr("sum(rows) OVER (ORDER BY part) - rows")
    at = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.join(F.broadcast(sizes.select("part", before.alias("before"))), "part").withColumn("at", at)
    n = placed.count()
    follower = placed.select(F.pmod(F.col("at") - 1, F.lit(max(n, 1))).alias("at"), F.col("key").alias("next_key"))
    return stored(placed.join(follower, "at").select("key", "doc_id", "n_chars", "copies", "next_key"), "chain")


def beside_next(docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = SHINGLE_WORDS, scale: int = SCALE) -> DataFrame:
    """One row per document, in which the last half of the text gives way to the start
    of the next document's (by descending id): doc_id, n_chars, edited, hashes,
    edited_hashes, next_hashes.

    Null texts are empty. Rows of one id follow by the digest of their text; equal rows
    follow one another, the last of them is followed by the next other one. Null ids
    come last. Extra columns are ignored; an empty table gives no rows.

    Texts move once, with their sketch; beside them only the start that the document
    before needs. Equal rows are one on the way, so no key is hot."""
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), clean_text(text).alias("text"))
    own = own.withColumn("key", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), F.col("text")).cast("binary")))
    chain = _chain(own.select("key", "doc_id", F.length("text").alias("n_chars")))
    texts = own.select("key", "text", packed(sketch(F.col("text"), words, scale)).alias("kept")).dropDuplicates(["key"])
    half = F.expr("n_chars div 2").cast("int")
    asked = chain.select(F.col("next_key").alias("key"), F.col("key").alias("before"), half.alias("need"))
    heads = texts.join(asked, "key").select(F.col("before").alias("key"), F.left("text", F.col("need")).alias("head"), F.col("kept").alias("next_kept"))
    both = texts.join(chain.drop("next_key"), "key").join(heads, "key")
    follower = F.struct("head", "next_kept", F.lit(1).cast("bigint").alias("times"))
    itself = F.struct(F.left("text", half).alias("head"), F.col("kept").alias("next_kept"), (F.col("copies") - 1).alias("times"))
    cases = both.withColumn("case", F.explode(F.when(F.col("copies") > 1, F.array(follower, itself)).otherwise(F.array(follower))))
    made = cases.select(
        "doc_id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.concat(F.left("text", F.col("n_chars") - half), F.col("case.head")).alias("edited"),
        unpacked(F.col("kept")).alias("hashes"),
        unpacked(F.col("case.next_kept")).alias("next_hashes"),
        F.col("case.times").alias("times"),
    )
    made = made.withColumn("edited_hashes", sketch(F.col("edited"), words, scale))
    names = ["doc_id", "n_chars", "edited", "hashes", "edited_hashes", "next_hashes"]
    if chain.where(F.col("copies") > COPIES).isEmpty():
        return made.select(*names, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("i")).drop("i")
    # many equal rows are written by many tasks
    most = F.lit(COPIES).cast("bigint")
    blocks = made.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(times - 1) div {COPIES}"))))
    few = blocks.where(F.col("times") <= COPIES).drop("block")
    many = blocks.where(F.col("times") > COPIES).repartition("doc_id", "block").withColumn("times", F.least(most, F.col("times") - F.col("block") * most))
    every = few.unionByName(many.drop("block"))
    return every.select(*names, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("i")).drop("i")
