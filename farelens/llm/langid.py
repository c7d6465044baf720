"""Language identification by rank-order n-gram profiles.

A profile is the ``PROFILE`` most frequent n-grams of a language's training texts,
most frequent first. A document's own profile is compared with each: the distance
is the sum over its n-grams of how far out of place they are, at most ``PROFILE``
for one that the language's profile lacks. The nearest language wins."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import doc_crc, stored, whole_row

PROFILE = 300
UNDETERMINED = "und"
#: Training documents a language at most, the ones with the smallest hash of id and text: a bound on the fit.
TRAIN_DOCS = 2000
#: Labels at most; their counts are broadcast.
MAX_LANGUAGES = 10_000
#: Characters read at a time; bounds the memory beside the text itself.
BLOCK = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Code point -> itself for a letter, else 0."""
    kept = np.zeros(0x110000, np.int64)
    for c in range(0x110000):
        if chr(c).isalpha():
            kept[c] = c
    return kept


def _summed(grams: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if not len(grams):
        return grams, np.empty(0, np.int64)
    if times is None:
        grams = np.sort(grams)
    else:
        order = np.argsort(grams)
        grams, times = grams[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    counts = np.diff(np.append(first, len(grams))) if times is None else np.add.reduceat(times, first)
    return grams[first], counts


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts) of a whole text: one to three letters of its lower-cased
    words, each word between two blanks. An n-gram is a number of 21 bits a
    character (blank 0); two-character ones are negative to keep them apart."""
    code = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
    code = np.concatenate(([0], code, [0]))
    code = code[np.concatenate((code[1:] != 0, [False])) | (code != 0) | np.concatenate(([False], code[:-1] != 0))]
    # of neighbouring blanks one is left: the blank after a word is the one before the next
    code = code[np.concatenate(([True], (code[1:] != 0) | (code[:-1] != 0)))] if len(code) else code
    parts = []
    for i in range(0, len(code), BLOCK):
        one, two, three = code[i : i + BLOCK], code[i : i + BLOCK + 1], code[i : i + BLOCK + 2]
        threes = three[:-2] << 42 | three[1:-1] << 21 | three[2:]
        parts.append(_summed(np.concatenate((one[one != 0], -(two[:-1] << 21 | two[1:]), threes[three[1:-1] != 0]))))
    return _merged(parts)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    parts = [p for p in parts if len(p[0])]
    if len(parts) < 2:
        return parts[0] if parts else (np.empty(0, np.int64), np.empty(0, np.int64))
    return _summed(*map(np.concatenate, zip(*parts)))


def most_frequent(text: str, size: int = PROFILE) -> np.ndarray:
    """The text's profile; equal counts are ordered by the n-gram's number."""
    grams, n = counts(text)
    return grams[np.argsort(-n, kind="stable")[:size]]


def _training_rows(docs: DataFrame, text: str, lang: str, id_col: str, usable: Column, most: int) -> DataFrame:
    """(lang, text) of about ``most`` documents a language: those whose hash of id and
    text is below the share that ``most`` is of the language's documents."""
    own = docs.where(usable & F.col(lang).isNotNull() & F.col(text).isNotNull())
    have = own.groupBy(F.col(lang).cast("string").alias("__lang")).agg(F.count(F.lit(1)).alias("__n")).limit(MAX_LANGUAGES + 1).collect()
    if len(have) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    have = docs.sparkSession.createDataFrame(have, "__lang string, __n bigint")
    place = F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string"), F.col(text).cast("string"), F.lit("profile")), 1).cast("double") / F.lit(float(1 << 63))
    rows = own.select(F.col(lang).cast("string").alias("__lang"), F.col(text).cast("string").alias("__text"), place.alias("__place"))
    return rows.join(F.broadcast(have), "__lang").where(F.col("__place") * F.col("__n") < most).select("__lang", "__text")


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", usable: Column | None = None,
    size: int = PROFILE, most: int = TRAIN_DOCS,
) -> dict[str, list[int]]:
    """Language -> its profile (n-gram hashes, most frequent first), learnt from the
    rows where ``usable`` holds and language and text are not null. Tasks hand over
    counts of n-grams, Spark sums them and keeps each language's top ``size``.
    The languages are the few label values; no rows: no profiles."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[str, list] = {}
            for name, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found.setdefault(name, []).append(counts(t))
            for name, parts in found.items():
                g, n = _merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(g), pa.string()), pa.array(g), pa.array(n)], names=["lang", "gram", "n"])

    rows = _training_rows(docs, text, lang, id_col, F.lit(True) if usable is None else usable, most)
    sums = rows.mapInArrow(counted, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the top of each language is cut in every task before it moves
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = sums.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size).select("lang", "place", "gram")
    out: dict[str, list[int]] = {}
    for r in sorted(best.collect()):
        out.setdefault(r.lang, []).append(r.gram)
    return out


def _judge(profiles: dict[str, list[int]]) -> Callable[[str | None], tuple[str, float, int | None]]:
    """Text -> (nearest language, score, distance)."""
    names = sorted(profiles)
    pairs = [np.array(sorted((g, i) for i, g in enumerate(profiles[n])), np.int64).reshape(-1, 2) for n in names]

    def one(t: str | None) -> tuple[str, float, int | None]:
        own = most_frequent(t or "")
        if not len(own) or not names:
            return UNDETERMINED, 0.0, None
        place = np.arange(len(own))
        best = None
        for name, known in zip(names, pairs):
            at = np.minimum(np.searchsorted(known[:, 0], own), len(known) - 1)
            out = np.where(known[at, 0] == own, np.minimum(np.abs(known[at, 1] - place), PROFILE), PROFILE)
            if best is None or out.sum() < best[0]:
                best = int(out.sum()), name
        return best[1], 1 - best[0] / (PROFILE * len(own)), best[0]

    return one


def predict(
    docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """(doc_id, lang_pred, score, distance): the nearest profile over the whole text.

    score is the mean share of places in which the document's n-grams agree with
    the language's (1: the same order, 0: no n-gram in common). Null texts and texts
    without a letter, and all texts if there is no profile, are ``und`` with score 0.
    Equal distances go to the language that sorts first. Extra columns are ignored,
    repeated rows and null ids are scored like any other."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _judge(profiles)
        for b in batches:
            cols = list(zip(*map(one, b.column(1).to_pylist()))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64())],
                names=["doc_id", "lang_pred", "score", "distance"],
            )

    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(scored, "doc_id bigint, lang_pred string, score double, distance bigint")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(doc_crc(id_col) % 4 == 2, F.lit(False))


def drop_undetermined(docs: DataFrame, profiles: dict[str, list[int]], min_score: float, text: str = "text") -> DataFrame:
    """``docs`` (all columns, whatever their names) without the documents whose language is undetermined or
    whose score is below ``min_score``. Each row is judged by its own text, in the pass
    that hands it on, so null and repeated ids have no part in it. An empty table gives no rows."""
    read = docs.select(whole_row(docs), F.col(text).cast("string").alias("text"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _judge(profiles)
        for b in batches:
            found = map(one, b.column(1).to_pylist())
            stays = [name != UNDETERMINED and score >= min_score for name, score, _ in found]
            yield b.select([0]).filter(pa.array(stays, pa.bool_()))

    return read.mapInArrow(kept, StructType([StructField("row", docs.schema)])).select("row.*")
