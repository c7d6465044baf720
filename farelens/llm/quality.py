"""Quality scores by a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_crc, stored

#: Share of the pooled covariance in a class covariance, and of its mean variance in each.
POOLED, SPHERE = 0.05, 0.01
#: Characters read at a time, and on to the end of the word.
BLOCK = 1 << 20
_BLANK = re.compile(r"\s")
FEATURES = (
    "words", "word_length", "upper", "digits", "stops", "symbols", "same_next", "distinct", "commonest", "line_length", "same_lines", "letters",
)
OTHER, LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL = range(7)


@cache
def _kinds() -> np.ndarray:
    """Code point -> kind of character."""
    kind = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            kind[c] = UPPER if x.isupper() else LOWER
        elif x.isdigit():
            kind[c] = DIGIT
        elif x.isspace():
            kind[c] = SPACE
        elif x in ".,":
            kind[c] = STOP
        elif x.isprintable():
            kind[c] = SYMBOL
    return kind


def features(text: str | None) -> list[float]:
    """The transformed statistics of a whole text (null: empty): logarithms of
    sizes, square roots of shares."""
    text = text or ""
    kinds = np.zeros(7, np.int64)
    words = same_next = 0
    seen: dict[str, int] = {}
    i, last = 0, None
    while i < len(text):
        blank = _BLANK.search(text, i + BLOCK)
        part = text[i : blank.start()] if blank else text[i:]
        i += len(part)
        kinds += np.bincount(_kinds()[np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)], minlength=7)
        own = part.split()
        words += len(own)
        same_next += sum(map(eq, own, own[1:])) + (own[:1] == [last])
        last = own[-1] if own else last
        for w in own:
            seen[w] = seen.get(w, 0) + 1
    lines = [line for r in text.split("\n") if (line := r.strip())]
    n, letters = max(1, len(text)), max(1, int(kinds[LOWER] + kinds[UPPER]))
    w = max(1, words)
    shares = {
        "upper": kinds[UPPER] / letters, "digits": kinds[DIGIT] / n, "stops": kinds[STOP] / w, "symbols": kinds[SYMBOL] / w,
        "same_next": same_next / w, "commonest": max(seen.values(), default=0) / w, "same_lines": 1 - len(set(lines)) / max(1, len(lines)),
        "letters": letters / n,
    }
    sizes = {
        "words": np.log1p(words), "word_length": np.log1p(letters / w), "line_length": np.log1p(n / max(1, len(lines))),
        "distinct": np.log1p(len(seen)) - np.log1p(words),
    }
    return [float(sizes[f]) if f in sizes else float(np.sqrt(shares[f])) for f in FEATURES]


def statistics(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, features array<double>) of every row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "features"])

    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(read, "doc_id bigint, features array<double>")


class Discriminant:
    """Per class: log prior, mean, Cholesky factor of the shrunk covariance."""

    def __init__(self, moments: dict[int, tuple[int, np.ndarray, np.ndarray]], pooled: float = POOLED, sphere: float = SPHERE):
        """``moments``: class -> count, sum, sum of outer products."""
        p = len(FEATURES)
        total = sum(n for n, *_ in moments.values())
        own = {}
        for c, (n, s, ss) in moments.items():
            mean = s / n
            own[c] = n, mean, (ss - np.outer(s, mean)) / n
        shared = sum(n * cov for n, _, cov in own.values()) / max(1, total)
        self.scale = np.sqrt(np.maximum(np.diag(shared), 1e-12)) if own else np.ones(p)
        self.classes = {}
        for c, (n, mean, cov) in own.items():
            cov = ((1 - pooled) * cov + pooled * shared) / np.outer(self.scale, self.scale)
            cov = (1 - sphere) * cov + sphere * max(np.trace(cov) / p, 1e-6) * np.eye(p)
            factor = np.linalg.cholesky(cov)
            self.classes[c] = np.log(n / total), mean / self.scale, factor, 2 * np.log(np.diag(factor)).sum()

    def log_density(self, c: int, x: np.ndarray) -> np.ndarray:
        prior, mean, factor, logdet = self.classes[c]
        z = np.linalg.solve(factor, (x / self.scale - mean).T)
        return prior - 0.5 * ((z * z).sum(axis=0) + logdet)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Logistic of the log-density difference per feature, 0.5 where it is zero.
        With one class only the score is that class's."""
        if len(self.classes) < 2:
            return np.full(len(x), float(next(iter(self.classes), 0.5)))
        d = (self.log_density(1, x) - self.log_density(0, x)) / len(FEATURES)
        return 1 / (1 + np.exp(-np.clip(d, -700, 700)))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", usable: Column | None = None) -> Discriminant:
    """The discriminant of the labelled rows where ``usable`` holds (a column of
    doc_id). Tasks hand over counts, sums and outer products, which Spark adds up,
    so every labelled row counts and the driver sees a few hundred numbers."""
    y = labels.where(F.col(label).isin(0, 1)).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    rows = stats.where(F.lit(True) if usable is None else usable).join(y.where(F.lit(True) if usable is None else usable), "doc_id")
    p = len(FEATURES)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ys = b.column(0).to_numpy()
            x = b.column(1).values.to_numpy().reshape(-1, p) if len(ys) else np.empty((0, p))
            for c in np.unique(ys):
                own = x[ys == c]
                values = np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c] * len(values), pa.int32()), pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], names=["y", "i", "v"]
                )

    parts = rows.select("y", "features").mapInArrow(summed, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v"))
    held: dict[int, np.ndarray] = {}
    for r in parts.collect():  # two classes of 1 + p + p * p numbers
        held.setdefault(r.y, np.zeros(1 + p + p * p))[r.i] = r.v
    return Discriminant({c: (int(v[0]), v[1 : p + 1], v[p + 1 :].reshape(p, p)) for c, v in held.items()})


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``statistics``."""
    p = len(FEATURES)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).values.to_numpy().reshape(-1, p) if b.num_rows else np.empty((0, p))
            s = model.score(x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return stats.select("doc_id", "features").mapInArrow(scored, "doc_id bigint, score double, predicted int")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(doc_crc(id_col) % 3 == 1, F.lit(False))


def quality(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, label: str = "quality", text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """(doc_id, score, predicted): one row per document, from a discriminant fitted
    to the labelled rows where ``usable`` holds.

    Null and empty texts are scored by their (zero) statistics. Without labelled
    rows every score is 0.5. Rows that repeat an id are each scored, and each of
    them counts in the fit if labelled; null ids are scored but never labelled.
    Extra columns are ignored; an empty table gives no rows."""
    stats = stored(statistics(docs, text, id_col), "statistics")
    return score(stats, fit(stats, labels, label, id_col, usable))
