"""Passages that documents share, by a sparse suffix array.

Only suffixes at minimiser positions are kept: of every window of ``WINDOW``
neighbouring k-word grams the smallest hash is an anchor, so any common passage of
``MIN_WORDS`` words has an anchor at the same place in both texts. An anchor's context,
all words that a passage of ``MIN_WORDS`` words around its gram can have, is hashed as a
whole. Equal contexts of a gram (by 64 bits beside the gram's 64) are one: if two
documents have it, everything in it is shared, and that settles most anchors without
their words. What is left are the contexts of one document whose gram other documents
have too. One suffix of each context of such a gram, cut to ``MIN_WORDS`` words and
followed by the words before the anchor read backwards, is sorted; each is compared with
its neighbours from other documents, word for word, and the match is extended to the
right and to the left. Matches that the order can hide are found by a 64-bit hash of the
passage beside the gram's."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, discard, join_hot, stored

MIN_WORDS = 50
GRAM = 8
#: Grams in a window: a passage of MIN_WORDS words holds one whole window.
WINDOW = MIN_WORDS - GRAM + 1
#: Words before an anchor that a passage around it can have.
REACH = MIN_WORDS - GRAM
#: Sorted suffixes that a task holds at a time.
PART_ROWS = 20_000
#: Distinct words whose hash a task remembers.
MEMORY = 500_000
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(GRAM)], np.uint64)
#: The base of context hashes and its inverse, modulo 2^64.
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of every ``width`` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


def word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    if len(known) > MEMORY:
        known.clear()
    hashes = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        if (h := known.get(w)) is None:
            h = known[w] = xxhash.xxh64_intdigest(w)
        hashes[i] = h
    return hashes


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes) of a text's anchors, from its word hashes; none below
    MIN_WORDS words."""
    if len(hashes) < MIN_WORDS:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    n = len(hashes) - GRAM + 1
    grams = np.zeros(n, np.uint64)
    for i in range(GRAM):
        grams += hashes[i : i + n] * _FACTORS[i]
    grams ^= grams >> np.uint64(31)
    least = _sliding(grams, WINDOW, np.minimum)
    # an anchor is the smallest of some window, so the largest minimum around it is itself
    most = np.concatenate((np.zeros(WINDOW - 1, np.uint64), least, np.zeros(WINDOW - 1, np.uint64)))
    at = np.flatnonzero(_sliding(most, WINDOW, np.maximum) == grams)
    return at.astype(np.int32), grams[at].view(np.int64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def contexts_of(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words before, words from the anchor on, hash) of each anchor's context: a
    polynomial of its word hashes, from running sums, and the two counts."""
    n = len(hashes)
    before, after = np.minimum(REACH, at), np.minimum(MIN_WORDS, n - at)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, n), dtype=np.uint64)))
    found = (sums[at + after] - sums[at - before]) * _powers(_INVERSE, n + 1)[at - before]
    found ^= found >> np.uint64(29)
    found += (before * 64 + after).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return before.astype(np.int32), after.astype(np.int32), found.view(np.int64)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _common(a: bytes, b: bytes) -> int:
    """Leading words that two space-joined sequences share."""
    n = min(len(a), len(b))
    if a[:n] != b[:n]:
        low = 0
        while low < n:  # the longest common prefix is at least low and below n
            middle = (low + n) // 2
            if a[low : middle + 1] == b[low : middle + 1]:
                low = middle + 1
            else:
                n = middle
        n = low
    whole = n > 0 and (n == len(a) or a[n] == 32) and (n == len(b) or b[n] == 32)
    return a.count(b" ", 0, n) + whole


class Suffix:
    """One context: its words to the right and, backwards, to the left. ``doc`` is None
    if several documents have it."""

    __slots__ = ("gram", "doc", "context", "right", "left")

    def __init__(self, gram: int, doc: int | None, context: bytes):
        self.gram, self.doc, self.context = gram, doc, context
        self.right, _, self.left = context.partition(b"\n")

    @property
    def room(self) -> int:
        return self.left.count(b" ") + 1 if self.left else 0

    def differs(self, s: Suffix) -> bool:
        """Whether another document than that of ``s`` has this context."""
        return self.doc is None or self.doc != s.doc

    def match(self, x: Suffix) -> tuple[int, int]:
        return _common(self.left, x.left), _common(self.right, x.right)


def _carried(rows: list[Suffix]) -> list[Suffix]:
    """Of rows in order, the last one and before it the last of another document."""
    if not rows:
        return []
    lone = next((r for r in reversed(rows) if r.doc != rows[-1].doc), None)
    return [r for r in (lone, rows[-1]) if r]


def _neighbours(rows: list[Suffix], before: list[Suffix]) -> list[Suffix | None]:
    """For each row the nearest earlier one of another document with its gram."""
    out: list[Suffix | None] = []
    last = lone = None
    for s in [*before, *rows]:
        out.append(next((x for x in (last, lone) if x and x.gram == s.gram and x.differs(s)), None))
        if last and last.doc != s.doc:
            lone = last
        last = s
    return out[len(before) :]


def _seen(s: Suffix, x: Suffix | None, min_words: int) -> tuple[int, int, int]:
    """(back, ahead) of the match with a neighbour (0, 0 below ``min_words``), and
    how far ahead it reaches in any case."""
    if x is None:
        return 0, 0, 0
    back, ahead = s.match(x)
    return (back, ahead, ahead) if back + ahead >= min_words else (0, 0, ahead)


def _unknown(one: tuple[int, int, int], two: tuple[int, int, int], room: int, min_words: int) -> tuple[int | None, int | None]:
    """The least and greatest start (words before the anchor) of a passage of
    ``min_words`` that a farther suffix may share and neither match shows."""
    least = max(0, min_words - max(one[2], two[2]))
    if any(a and min_words - a <= least and b >= room for b, a, _ in (one, two)):
        return None, None
    left = [k for k in range(least, room + 1) if not any(min_words - a <= k <= b for b, a, _ in (one, two) if a)]
    return (left[0], left[-1]) if left else (None, None)


def _passages(s: Suffix, least: int, most: int, min_words: int) -> tuple[int, list[int]]:
    """(least, hashes) of the passages of ``min_words`` words that begin ``least`` to
    ``most`` words before the anchor."""
    out: list[int] = []
    if most < least:
        return least, out
    left = s.left.split(b" ") if s.left else []
    line = left[::-1] + s.right.split(b" ")
    for back in range(least, min(most, len(left)) + 1):
        i = len(left) - back
        if i + min_words <= len(line):
            out.append(xxhash.xxh3_64_intdigest(b" ".join(line[i : i + min_words]), back) - (1 << 63))
        elif not out:
            least += 1  # too few words are left after the anchor
    return least, out


_COMPARED = (
    "gram bigint, ctx bigint, lo bigint, hi bigint, back1 int, ahead1 int, reach1 int, back2 int, ahead2 int, reach2 int, "
    "lacks int, part bigint, first int, last int, start int, passages array<bigint>, context binary"
)
_TYPES = [*[pa.int64()] * 4, *[pa.int32()] * 7, pa.int64(), *[pa.int32()] * 3, pa.list_(pa.int64()), pa.binary()]
_NAMES = [c.split()[0] for c in _COMPARED.split(", ")]
BEFORE, AFTER = 1, 2


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=_NAMES)


def _rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names))


def _compared(part: int, held: list[tuple], min_words: int) -> list[tuple]:
    """The rows of ``_COMPARED`` of one part: (gram, context, ctx, lo, hi) in order."""
    rows = [Suffix(g, lo if lo == hi else None, c) for g, c, _, lo, hi in held]
    before, after = _neighbours(rows, []), _neighbours(rows[::-1], [])[::-1]
    # what other parts may need: the last row and the last of another document, and the same at the start
    last = {id(s): i for i, s in enumerate(_carried(rows)[::-1])}
    first = {id(s): i for i, s in enumerate(_carried(rows[::-1])[::-1])}
    # a context of several documents is matched as a whole: it is only a partner
    whole = [s.doc is None for s in rows]
    sides = [((0, 0, min_words),) * 2 if w else (_seen(s, x, min_words), _seen(s, y, min_words)) for s, x, y, w in zip(rows, before, after, whole)]
    lacks = [
        0 if w else (BEFORE if not x and s.gram == rows[0].gram else 0) | (AFTER if not y and s.gram == rows[-1].gram else 0)
        for s, x, y, w in zip(rows, before, after, whole)
    ]
    out, begin = [], 0
    for end in [i for i in range(1, len(rows) + 1) if i == len(rows) or rows[i].gram != rows[i - 1].gram]:
        run = range(begin, end)
        starts = [k for i in run if not whole[i] for k in _unknown(*sides[i], rows[i].room, min_words) if k is not None]
        # of a gram at the border other rows may ask for any passage
        border = rows[begin].gram in (rows[0].gram, rows[-1].gram)
        least, most = (0, min_words) if border else (min(starts, default=1), max(starts, default=0))
        for i in run:
            s, (one, two), (_, _, ctx, lo, hi) = rows[i], sides[i], held[i]
            reach = min_words if lacks[i] else max(one[2], two[2])
            start, passages = _passages(s, max(least, min_words - reach), most, min_words)
            shown = lacks[i] or id(s) in last or id(s) in first
            out.append((s.gram, ctx, lo, hi, *one, *two, lacks[i], part, first.get(id(s)), last.get(id(s)), start, passages, s.context if shown else None))
        begin = end
    return out


_NEAR = "array<struct<gram: bigint, doc: bigint, context: binary>>"


def _around(compared: DataFrame) -> DataFrame:
    """(part, side, near): for each part with rows that lack a neighbour at a side, the
    nearest row beyond that border and the nearest of another document, the nearest last.

    A part shows at most two rows at each end. Where those of the next part are all of
    one document, the part after it is asked too, and so on; every step is a join."""
    doc = F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("doc")
    row = F.struct("gram", doc, "context")
    order = Window.orderBy("part")  # a row per part
    parts = compared.select("part").distinct().withColumn("no", F.row_number().over(order))
    numbered = compared.where("first is not null or last is not null or lacks > 0").join(parts, "part")

    def shown(place: str) -> DataFrame:
        rows = numbered.where(F.col(place).isNotNull()).groupBy("no").agg(F.sort_array(F.collect_list(F.struct((-F.col(place)).alias("o"), row.alias("r")))).alias("x"))
        return rows.select(F.col("no").alias("at"), F.transform("x", lambda r: r["r"]).alias("more"))

    found = None
    for side, place, step in ((BEFORE, "last", -1), (AFTER, "first", 1)):
        ends = stored(shown(place), "ends")
        asked = numbered.where(F.col("lacks").bitwiseAND(F.lit(side)) > 0).groupBy("part", "no").agg(F.first("gram").alias("gram"))
        open_ = asked.select("part", "gram", (F.col("no") + step).alias("at"), F.array().cast(_NEAR).alias("near"))
        while True:
            every = F.concat("more", "near")
            nearest = F.element_at(every, -1)
            other = F.try_element_at(F.filter(every, lambda x: ~x["doc"].eqNullSafe(nearest["doc"])), F.lit(-1))
            met = open_.join(ends, "at").select(
                "part", "gram", (F.col("at") + step).alias("at"), F.filter(F.array(other, nearest), lambda x: x.isNotNull()).alias("near")
            )
            met = stored(met, "met")
            ready = (F.size("near") == 2) | F.exists("near", lambda x: x["doc"].isNull() | (x["gram"] != F.col("gram")))
            # a part whose border rows are the last ones of the order is answered by what it has met
            done = met.join(ends.select("at"), "at", "left_anti").unionByName(met.where(ready)).select("part", F.lit(side).alias("side"), "near").distinct()
            found = done if found is None else found.unionByName(done)
            open_ = met.where(~ready).join(ends.select("at"), "at", "left_semi")
            if open_.isEmpty():
                break
    return found


def compare_neighbours(kinds: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(gram, ctx, lo, hi, back, ahead, start, passages) of contexts (gram, ctx, lo, hi,
    context), where lo and hi are the least and greatest document that has it: how far a
    match of ``min_words`` or more with another document reaches before and after the
    anchor (0, 0: none), and for ``settle`` the hashes of the passages that begin
    ``start`` and more words before the anchor.

    The contexts are range-sorted, so neither a gram nor a document that a third of them
    share stays in one task. A task compares PART_ROWS at a time; the rows at the borders
    of such parts that lack a neighbour are compared with those beyond in a second, small
    step."""
    by = ["gram", "context", "ctx", "lo", "hi"]
    order = kinds.select(*by).repartitionByRange(*by).sortWithinPartitions(*by)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId() << 32, []
        for b in batches:
            for row in _rows(b, *by):
                held.append(row)
                if len(held) == PART_ROWS:
                    yield _batch(_compared(part, held, min_words))
                    part, held = part + 1, []
        if held:
            yield _batch(_compared(part, held, min_words))

    compared = stored(order.mapInArrow(inside, _COMPARED), "compared", "zstd")
    around = _around(compared)
    sides = {s: around.where(F.col("side") == s).select("part", F.col("near").alias(f"near{s}")) for s in (BEFORE, AFTER)}
    lacking = compared.where("lacks > 0").join(sides[BEFORE], "part", "left").join(sides[AFTER], "part", "left")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in _rows(b, *_NAMES, f"near{BEFORE}", f"near{AFTER}"):
                gram, ctx, lo, hi, *known, lacks, part, first, last, start, passages, context = row[:-2]
                s, found = Suffix(gram, lo, context), [tuple(known[:3]), tuple(known[3:])]
                for k, (side, near) in enumerate(zip((BEFORE, AFTER), row[-2:])):
                    if lacks & side and near:
                        rows = [Suffix(x["gram"], x["doc"], x["context"]) for x in near]
                        found[k] = _seen(s, _neighbours([s], rows)[0], min_words)
                out.append((gram, ctx, lo, hi, *found[0], *found[1], 0, part, first, last, start, passages, None))
            yield _batch(out)

    settled = compared.where("lacks = 0").unionByName(lacking.select(*_NAMES, f"near{BEFORE}", f"near{AFTER}").mapInArrow(across, _COMPARED))
    best = [F.greatest(f"{c}1", f"{c}2").alias(c) for c in ("back", "ahead")]
    return stored(settled.select("gram", "ctx", "lo", "hi", *best, "start", "passages"), "found", "zstd")


def settle(found: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(gram, ctx, back, ahead) of the matches that the order hides: a suffix's partner to
    the left may be no neighbour when another one reaches farther right.

    Two places share a passage only if both reach to its end, and it is open only
    between the least and the greatest start that some place of the gram leaves open;
    those passages are compared by gram and hash."""
    seen = found.select("ctx", "gram", "lo", "hi", "start", F.posexplode("passages").alias("i", "passage"))
    seen = seen.select("ctx", "gram", "lo", "hi", (F.col("start") + F.col("i")).alias("back"), F.struct("gram", "passage").alias("key"))
    twice = seen.groupBy("key").agg(F.min("lo").alias("least"), F.max("hi").alias("most"), F.count(F.lit(1)).alias("n"))
    twice = stored(twice.where("least <> most").select("key", "n"), "twice")
    hidden = join_hot(seen.where("lo = hi"), twice, "key", "n", found.agg(F.sum(F.size("passages"))).first()[0] or 0)
    return hidden.select("gram", "ctx", "back", (F.lit(min_words) - F.col("back")).alias("ahead"))


def repeated_passages(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per repeated passage: doc_id, first_word, n_words. A passage is a
    longest run of words of the document of which every word is in some run of
    MIN_WORDS or more that another document has too.

    Words are separated by the six ASCII blanks and compared as they are (contexts and
    hidden passages by hash, see the module). Null, empty and short texts have no passage,
    and a run that comes twice in one document only is none. Rows that repeat an id are
    one document for this, rows with a null id are left out; extra columns are ignored;
    an empty table gives no rows."""
    own = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    own = own.withColumn("row", F.xxhash64("doc_id", "text"))
    names = ["row", "doc_id", "pos", "gram", "before", "after", "ctx"]

    def selected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                found = []
                for t in part.column(2):
                    hashes = word_hashes(_words(t.as_py()), known)
                    at, grams = anchors(hashes)
                    found.append((at, grams, *contexts_of(hashes, at)))
                times = [len(f[0]) for f in found]
                cols = [np.repeat(part.column(c).to_numpy(), times) for c in (0, 1)]
                cols += [np.concatenate([f[k] for f in found]) for k in range(5)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, cols)), names=names)

    schema = "row bigint, doc_id bigint, pos int, gram bigint, before int, after int, ctx bigint"
    places = stored(own.select("row", "doc_id", "text").mapInArrow(selected, schema), "anchors", "zstd")
    n_places = places.count()
    # one row per context; of a gram that two documents have, all of its contexts
    kinds = places.groupBy("gram", "ctx").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    kinds = stored(kinds, "kinds", "zstd")
    grams = kinds.groupBy("gram").agg(
        F.min("lo").alias("least"), F.max("hi").alias("most"), F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("lo") == F.col("hi")).alias("lone")
    )
    grams = stored(grams.where("least <> most").select("gram", "kinds", ((F.col("kinds") > 1) & (F.col("lone") > 0)).alias("open")), "grams")
    shared = stored(join_hot(kinds, grams, "gram", "kinds", kinds.count()).drop("kinds"), "shared", "zstd")
    # the anchors that are left, with what is known of their context; hot contexts, shared
    # or not, are fewer than HOT_SHARE, and their places never leave their tasks
    least = n_places // HOT_SHARE
    hot = F.broadcast(kinds.where(F.col("n") > least).select("ctx"))
    told = shared.select("ctx", F.col("gram").alias("own_gram"), "n", "lo", "hi", "open", F.col("row").alias("of"))
    members = places.join(F.broadcast(told.where(F.col("n") > least)), "ctx")
    members = members.unionByName(places.join(hot, "ctx", "left_anti").join(told.where(F.col("n") <= least), "ctx"))
    members = stored(members.where(F.col("gram") == F.col("own_gram")).drop("own_gram", "n"), "members", "zstd")
    discard(places, kinds, grams)
    # a context that two documents have is shared as a whole
    span = lambda back, ahead: ["doc_id", (F.col("pos") - F.col(back)).alias("begin"), (F.col("pos") + F.col(ahead)).alias("end")]
    runs = stored(members.where("lo <> hi").select(*span("before", "after")).distinct(), "equal", "zstd")

    # the words of one place of each context that is to be compared
    chosen = members.where(F.col("open") & (F.col("row") == F.col("of")))
    # a document's anchors, never more than its words
    per_row = chosen.groupBy(F.col("row").alias("at_row")).agg(F.collect_list(F.struct("pos", "gram", "ctx", "lo", "hi")).alias("at"))
    chosen = own.dropDuplicates(["row"]).join(per_row, F.col("row") == F.col("at_row")).select("text", "at")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text_, at in zip(b.column(0), b.column(1)):
                words = _words(text_.as_py())
                # a context that the text has several times is one
                want = {(a["gram"], a["ctx"]): a for a in at.as_py()}.values()
                made = [
                    b" ".join(words[p : p + MIN_WORDS]) + b"\n" + b" ".join(words[max(0, p - REACH) : p][::-1]) for p in (a["pos"] for a in want)
                ]
                cols = [pa.array([a[c] for a in want], pa.int64()) for c in ("gram", "ctx", "lo", "hi")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(made, pa.binary())], names=["gram", "ctx", "lo", "hi", "context"])

    seen = stored(chosen.mapInArrow(contexts, "gram bigint, ctx bigint, lo bigint, hi bigint, context binary"), "contexts", "zstd")
    found = compare_neighbours(seen)
    discard(seen)
    reach = found.where("lo = hi and ahead > 0").select("gram", "ctx", "back", "ahead").unionByName(settle(found))
    # a context's matches, at most one for each word before the anchor
    reach = reach.groupBy("gram", "ctx").agg(F.collect_set(F.struct("back", "ahead")).alias("matches"))
    lone = shared.where("open and lo = hi").select("gram", "ctx", "n")
    reach = stored(reach.join(lone, ["gram", "ctx"]).withColumnRenamed("gram", "own_gram"), "reach", "zstd")
    alone = members.where("open and lo = hi").select("doc_id", "pos", "gram", "ctx")
    matched = join_hot(alone, reach, "ctx", "n", n_places).where(F.col("gram") == F.col("own_gram"))
    matched = matched.select("doc_id", "pos", F.explode("matches").alias("m"))
    return merged(runs.unionByName(matched.select(*span("m.back", "m.ahead"))).distinct())


def merged(runs: DataFrame) -> DataFrame:
    """(doc_id, first_word, n_words): overlapping or touching runs as one."""
    order = Window.partitionBy("doc_id").orderBy("begin", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.withColumn("new", (F.coalesce(reached, F.lit(-1)) < F.col("begin")).cast("int"))
    island = starts.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = island.groupBy("doc_id", "island").agg(F.min("begin").alias("first_word"), F.max("end").alias("end"))
    return spans.select("doc_id", F.col("first_word").cast("bigint").alias("first_word"), (F.col("end") - F.col("first_word")).cast("bigint").alias("n_words"))
