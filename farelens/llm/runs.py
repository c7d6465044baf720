"""Periodic runs of words, by internal pattern matching.

The texts of a batch stand one after the other. Ranks of all their stretches of 1, 2,
4, ... words (by doubling; only stretches that still occur twice are sorted again) give
the suffix array, and the longest common extension of two places in as many steps as
there are ranks. A run of period q holds, near its start, an aligned block of a power of
two words that comes again q words later. So each such block asks for its occurrences in
the windows after it: they are an interval of the suffix array, whose wavelet tree
answers "the next place at or after x". The occurrences in a window are a progression;
two are candidate periods as they are, of three or more only those differences can be
periods that keep the ends of the block's own progression in step, or that meet where two
such stretches overlap. Every candidate is extended both ways and kept if the stretch is
long enough; of equal stretches the smallest period stays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
#: Words that stand together, about; a longer text stands alone.
TOGETHER = 1 << 18
#: (block length, first and last difference + 1) for short periods. A run of MIN_LENGTH
#: words or more and period q holds a whole aligned block of m words before its last q
#: words if it is q + 2m - 1 long: 4 words do but for q = 6.
SHORT = ((2, ((6, 7),)), (4, ((1, 5), (5, 9), (9, 13), (13, 16))))


def _starts(changed: np.ndarray) -> np.ndarray:
    """For each row the first row of its group, where ``changed`` marks first rows."""
    return np.maximum.accumulate(np.where(changed, np.arange(len(changed)), 0))


def _changes(x: np.ndarray) -> np.ndarray:
    return np.concatenate(([True], x[1:] != x[:-1])) if len(x) else np.empty(0, bool)


class Ranks:
    """``levels[k][i]``: the first place in suffix order of the suffixes that share the
    2^k words at i; ``order``: the suffix array. At the last level all ranks differ."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        at = np.argsort(symbols, kind="stable")
        rank = np.empty(n, np.int32)
        first = _starts(_changes(symbols[at]))
        rank[at] = first
        self.levels, width = [rank], 1
        while True:
            same = first[1:] == first[:-1]
            open_ = at[np.concatenate((same, [False])) | np.concatenate(([False], same))] if n else at
            if not len(open_):
                break
            ahead = open_ + width
            second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
            key = rank[open_].astype(np.int64) * (n + 1) + second + 1
            by = np.argsort(key, kind="stable")
            at, key = open_[by], key[by]
            old = rank[at]
            first = _starts(_changes(key))
            rank = rank.copy()
            rank[at] = old + (first - _starts(_changes(old)))
            self.levels.append(rank)
            width *= 2
        self.order = np.empty(n, np.int32)
        self.order[rank] = np.arange(n, dtype=np.int32)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words of the texts from i and from j on (i < j)."""
        n, done = len(self.order), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = i + done, j + done
            same = self.levels[k][np.minimum(x, n - 1)] == self.levels[k][np.minimum(y, n - 1)]
            done += np.where(same & (y < n), 1 << k, 0)
        return done

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words of the texts up to i and up to j, backwards (i < j)."""
        done = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = i - done - (1 << k), j - done - (1 << k)
            same = self.levels[k][np.maximum(x, 0)] == self.levels[k][np.maximum(y, 0)]
            done += np.where(same & (x >= 0), 1 << k, 0)
        return done


class WaveletTree:
    """A wavelet tree in matrix form, for many questions at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            self.zeros.append(np.concatenate(([0], np.cumsum(zero, dtype=np.int32))).astype(np.int32))
            values = np.concatenate((values[zero], values[~zero]))

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [lo, hi) are below x."""
        found = np.where(x >= 1 << self.bits, hi - lo, 0)
        over = x >= 1 << self.bits
        for level, zeros in enumerate(self.zeros):
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            a, b = zeros[lo], zeros[hi]
            found += np.where(one & ~over, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return found

    def nth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value of [lo, hi), k from 0."""
        value, k = np.zeros(len(lo), np.int64), k.copy()
        for zeros in self.zeros:
            a, b = zeros[lo], zeros[hi]
            one = k >= b - a
            k -= np.where(one, b - a, 0)
            value = value << 1 | one
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value of [lo, hi) that is x or more; -1: none."""
        k = self.below(lo, hi, x)
        found = np.full(len(lo), -1, np.int64)
        some = k < hi - lo
        found[some] = self.nth(lo[some], hi[some], k[some])
        return found


def _questions(ranks: Ranks) -> tuple[np.ndarray, ...]:
    """(block, first and last + 1 of its suffix interval, window begin and end)."""
    n, parts = len(ranks.order), []
    for k in range(1, len(ranks.levels)):
        m, rank = 1 << k, ranks.levels[k]
        blocks = np.arange(0, n, m)
        size = np.bincount(rank, minlength=n)[rank[blocks]]
        blocks, size = blocks[size > 1], size[size > 1]
        lo = rank[blocks].astype(np.int64)
        for begin, end in dict(SHORT).get(m, ((2 * m, 3 * m), (3 * m, 4 * m))):
            parts.append((blocks, lo, lo + size, blocks + begin, blocks + end))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else tuple(np.empty((5, 0), np.int64))


def _candidates(ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(place, difference) of every two places that may be one period apart."""
    block, lo, hi, begin, end = _questions(ranks)
    if not len(block):
        return block, block
    # only suffixes whose first two words come twice are asked for; they keep their order
    twice = np.bincount(ranks.levels[1], minlength=len(ranks.order))[ranks.levels[1]] > 1
    slots = np.concatenate(([0], np.cumsum(twice[ranks.order])))
    places = np.flatnonzero(twice)
    tree = WaveletTree(np.searchsorted(places, ranks.order[twice[ranks.order]]))
    lo, hi = slots[lo], slots[hi]
    before = tree.below(lo, hi, np.searchsorted(places, begin))
    count = tree.below(lo, hi, np.searchsorted(places, end)) - before

    def occurrence(which: np.ndarray, k: int) -> np.ndarray:
        return places[tree.nth(lo[which], hi[which], before[which] + k)]

    one = count > 0
    two = count > 1
    found = [(block[one], occurrence(one, 0) - block[one]), (block[count == 2], occurrence(count == 2, 1) - block[count == 2])]
    many = count > 2
    if many.any():
        b, times, first = block[many], count[many], occurrence(many, 0)
        p = occurrence(many, 1) - first
        # the stretches of period p around the block and around its occurrences
        left, right = b - ranks.behind(b, b + p), b + p + ranks.ahead(b, b + p)
        left2, right2 = first - ranks.behind(first, first + p), first + p + ranks.ahead(first, first + p)
        other = left != left2
        found += [(b, p), (b[other], (left2 - left)[other]), (b[other], (right2 - right)[other])]
        # where the two overlap, every step of the progression that fits in both
        meet = other & (right >= left2)
        least = np.minimum(left2 - left, right2 - right)[meet] + p[meet]
        steps = np.clip(-(((first - b)[meet] - least) // p[meet]), 0, times[meet])
        which = np.repeat(np.flatnonzero(meet), steps)
        t = np.arange(len(which)) - np.repeat(np.cumsum(steps) - steps, steps)
        found.append((b[which], (first - b)[which] + t * p[which]))
    place, q = (np.concatenate(x) for x in zip(*found))
    place, q = place[q > 0], q[q > 0]
    fits = place + q < len(ranks.order)
    return place[fits], q[fits]


def find_runs(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period: the longest
    stretches of smallest period q, at least ``min_length`` and 2q long."""
    ranks = Ranks(symbols)
    place, q = _candidates(ranks)
    start = place - ranks.behind(place, place + q)
    end = place + q + ranks.ahead(place, place + q)
    long = end - start >= np.maximum(min_length, 2 * q)
    start, end, q = start[long], end[long], q[long]
    by = np.lexsort((q, end, start))
    start, end, q = start[by], end[by], q[by]
    # a stretch's other periods are multiples of the smallest
    first = _changes(start) | _changes(end)
    start, end, q = start[first], end[first], q[first]
    by = np.lexsort((q, start))
    return start[by], (end - start)[by], q[by]


def _grouped(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about TOGETHER words, as ranges."""
    begin = held = 0
    for i, words in enumerate(texts):
        if held and held + len(words) > TOGETHER:
            yield begin, i
            begin, held = i, 0
        held += len(words)
    if begin < len(texts):
        yield begin, len(texts)


def _detect(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(runs per text, their start, length, period, the collapsed texts)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    words = [w for t in texts for w in t]
    codes = pa.array(words, pa.binary()).dictionary_encode()
    doc = np.repeat(np.arange(len(texts)), sizes)
    # words of two texts are never the same symbol
    start, length, period = find_runs(doc * max(1, len(codes.dictionary)) + codes.indices.to_numpy())
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    gone = np.cumsum(edge)[:-1] > 0
    some = np.bincount(doc[gone], minlength=len(texts)) > 0
    kept = []
    for i, t in enumerate(texts):
        if some[i]:
            t = [w for w, g in zip(t, gone[begins[i] : begins[i + 1]].tolist()) if not g]
        kept.append(b" ".join(t))
    of = doc[start]
    return np.bincount(of, minlength=len(texts)), start - begins[of], length, period, kept


def periodic_runs(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start,
    then period), collapsed (the words that no run holds after its first period, joined
    by one space).

    Words are separated by the six ASCII blanks and numbered from 0. A run is a stretch
    of words of smallest period q, at least MIN_LENGTH and 2q long, that no neighbouring
    word extends. Null, empty and short texts have none. Repeated rows and null ids are
    kept; extra columns are ignored; an empty table gives no rows. A task holds about
    ``TOGETHER`` words at a time, or one longer text with some 8 bytes a word and
    doubling of its longest repeat."""
    fields = [pa.field(c, pa.int64(), False) for c in ("start", "length", "period")]
    item = pa.struct(fields)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                texts = [(t or "").encode().split() for t in part.column(1).to_pylist()]
                for begin, end in _grouped(texts):
                    counts, *run, kept = _detect(texts[begin:end])
                    values = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in run], fields=fields)
                    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                    cols = [
                        part.column(0).slice(begin, end - begin),
                        pa.array([len(t) for t in texts[begin:end]], pa.int64()),
                        pa.ListArray.from_arrays(offsets, values),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "runs", "collapsed"])

    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(
        found, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )
