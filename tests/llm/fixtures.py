"""Small tables with the odd rows every operator must take."""

from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for their own columns.
CLASHES = ("kept", "score", "size", "key", "sha", "fp", "class", "label", "row", "at", "h", "bad", "lines", "position", "taken", "norm", "n",
           "__id", "__sha", "__gone_id", "__gone_sha", "__at", "__due", "__text", "__lang", "__place", "ord", "due", "keep_id", "text_sha256", "key_rows",
           "chain_length", "bucket", "owner", "kept_rows", "group_size", "fingerprint", "component_id")

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a", 1),
    (2, "The quick  brown fox\tjumps over the lazy dog near the river bank", "en", "b", 2),
    (3, None, "en", "a", None),
    (4, "", None, None, 0),
    (5, " \t\n ", "de", "b", 3),
    (6, "word " * 3000 + "end", "en", "a", 9),
    (7, "x" * 40_000, "fr", "c", 9),
    (8, "12345 !!! 678", "es", "c", 9),
    (None, "a row without an id", None, "a", 5),
    (9, "repeated row", "en", "b", 5),
    (9, "repeated row", "en", "b", 5),
    (-10, "Été déjà vu, ça va ▁ 漢字 😀 \x00   end", "fr", None, 5),
    (11, "The quick brown fox jumps over the lazy dog near the river bank", "en", "c", 1),
    (12, "The quick brown fox\njumps over the lazy dog near the river bank ", "en", "c", 1),
]


def odd_docs(spark, rows=ROWS):
    """Two partitions, with extra columns whose names clash."""
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES}).repartition(2)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
