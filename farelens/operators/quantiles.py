"""Quantiles: approximate (one sketch pass, proved by a counting pass) and exact
(repeated narrowing).

Exact order statistics never gather a column's values, nor those of a bracket, into
one task (Spark's ``percentile`` keeps every distinct value of a group in one buffer):

1. one sketch pass counts the rows and brackets every wanted rank: the sketch's
   rank error is known, so the values two errors below and above enclose it;
2. one pass over the data groups each value by its place among the brackets:
   values inside one keep their value (about four errors of the rows, equal ones
   as one), all values of a gap between brackets are one group. Both are partial
   aggregates, so a value that holds a third of all rows is one row per task;
3. gap and bracket totals (a few numbers per wanted rank) tell which place holds a
   rank and how many rows lie before it there;
4. a place of more than ``FEW`` values is narrowed: a sketch of its values cuts it into
   ``PARTS`` parts, the rows of each part are counted (an aggregate again), and the
   part that holds the rank is the next place. Places of few values end the search:
   at most ``FEW`` rows a wanted rank come to the driver.

The quantiles use Spark's ``percentile`` interpolation: position ``p * (n - 1)``,
linear between the values at its floor and ceiling ranks. Null and NaN are
skipped, as the approximate path does.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

#: Blocks of equal rank that the sketch tells apart: its rank error is a block.
BLOCKS = 10_000
#: Distinct values of a place that are read as they are; a place of more is cut into PARTS.
FEW = 5_000
PARTS = 64


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float], rel_error: float = 0.01) -> DataFrame:
    """(column, prob, value) from one aggregate pass (mergeable GK sketches,
    ``accuracy = 1 / rel_error``). Empty input gives null values."""
    accuracy = max(1, int(round(1.0 / rel_error)))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        clean = F.when(~F.isnan(x), x)
        aggs.append(F.percentile_approx(clean, list(probs), accuracy).alias(f"q{i}"))
    wide = df.agg(*aggs)
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob"), F.col(f"q{i}")[j].alias("value"))
        for i, c in enumerate(cols)
        for j, p in enumerate(probs)
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _brackets(df: DataFrame, cols: list[str], probs: list[float], blocks: int) -> dict[int, tuple[int, list[tuple[float, float]]]]:
    """Column number -> (rows, disjoint ascending brackets of values that hold the
    wanted ranks), for the columns that have values."""
    edges = sorted({min(1.0, max(0.0, p + side * 2.0 / blocks)) for p in probs for side in (-1, 1)})
    clean = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols]
    row = df.agg(
        *[F.count(x).alias(f"n{i}") for i, x in enumerate(clean)],
        *[F.min(x).alias(f"lo{i}") for i, x in enumerate(clean)],
        *[F.max(x).alias(f"hi{i}") for i, x in enumerate(clean)],
        *[F.percentile_approx(x, edges, blocks).alias(f"q{i}") for i, x in enumerate(clean)],
    ).first()
    out = {}
    for i in range(len(cols)):
        if not row[f"n{i}"]:
            continue
        if row[f"n{i}"] < blocks:  # a block is less than a rank: the range is the bracket
            out[i] = row[f"n{i}"], [(row[f"lo{i}"], row[f"hi{i}"])]
            continue
        value = dict(zip(edges, row[f"q{i}"]))
        found: list[tuple[float, float]] = []
        for p in sorted(probs):
            low, high = p - 2.0 / blocks, p + 2.0 / blocks
            low = row[f"lo{i}"] if low <= 0 else value[low]
            high = row[f"hi{i}"] if high >= 1 else value[high]
            if found and low <= found[-1][1]:
                found[-1] = found[-1][0], max(high, found[-1][1])
            else:
                found.append((low, high))
        out[i] = row[f"n{i}"], found
    return out


def _place(x: Column, brackets: list[tuple[float, float]]) -> Column:
    """(place, v): 2k + 1 and the value inside bracket k, 2k and null in the gap before it."""
    below = sum((F.when(x > high, 1).otherwise(0) for _, high in brackets), F.lit(0))
    inside = F.lit(False)
    for low, high in brackets:
        inside = inside | x.between(low, high)
    return F.struct((below * 2 + inside.cast("int")).alias("place"), F.when(inside, x).alias("v"))


def order_statistics(df: DataFrame, cols: list[str], probs: list[float], ranks_of, blocks: int | None = None) -> dict[int, tuple[int, dict[int, float]]]:
    """Column number -> (rows, {rank: value}) for the columns that have values, exact
    (see module doc). ``ranks_of(n)`` gives the wanted ranks (from 0) of n rows; they
    lie within a row of ``probs``.

    Two passes over the input for all columns together; between them and the
    narrowing, the values inside the brackets are kept."""
    found = _brackets(df, cols, probs, max(1, int(blocks or BLOCKS)))
    if not found:
        return {}
    tagged = []
    for i, (_, brackets) in found.items():
        x = F.col(cols[i]).cast("double")
        tagged.append(F.when(x.isNotNull() & ~F.isnan(x), F.struct(F.lit(i).alias("cid"), _place(x, brackets).alias("p"))))
    placed = df.select(F.explode(F.array(*tagged)).alias("t")).where("t is not null").select("t.cid", "t.p.place", "t.p.v")
    counted = placed.groupBy("cid", "place", "v").agg(F.count(F.lit(1)).alias("c")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # at most two rows a wanted rank and one more
        totals = counted.groupBy("cid", "place").agg(F.sum("c").alias("n"), F.count("v").alias("values")).collect()
        held = {(r["cid"], r["place"]): (r["n"], r["values"]) for r in totals}
        places: dict[tuple, _Wanted] = {}
        for i, (n, brackets) in found.items():
            ends = list(accumulate(held.get((i, k), (0, 0))[0] for k in range(2 * len(brackets) + 1)))
            for rank in ranks_of(n):
                k = bisect_right(ends, rank)
                low, high = brackets[k // 2]
                start = ends[k - 1] if k else 0
                places.setdefault((i, low, high, True, held[i, k][1]), {})[rank] = rank - start
        values = _narrowed(counted.where("v is not null").select("cid", "v", "c"), places)
    finally:
        counted.unpersist()
    return {i: (n, {k: values[i, k] for k in ranks_of(n)}) for i, (n, _) in found.items()}


#: Wanted rank -> rows of its place before it.
_Wanted = dict[int, int]


def _inside(places: list[tuple]) -> Column:
    """Whether a row (cid, v) lies in one of the places, and its number there (null: none)."""
    number = F.lit(None).cast("int")
    for k, (i, low, high, closed, _) in enumerate(places):
        above = F.col("v") >= F.lit(low) if closed else F.col("v") > F.lit(low)
        number = F.when((F.col("cid") == i) & above & (F.col("v") <= F.lit(high)), F.lit(k)).otherwise(number)
    return number


def _narrowed(rows: DataFrame, places: dict[tuple, _Wanted]) -> dict[tuple[int, int], float]:
    """(column, rank) -> value, from counted values (cid, v, c) and the places that hold
    the ranks: (column, low, high, low inclusive, values) -> {rank: rows before it}.

    Every round cuts all wide places at once: one sketch aggregate, one count."""
    out: dict[tuple[int, int], float] = {}
    while places:
        wide = [p for p in places if p[4] > FEW]
        few = [p for p in places if p[4] <= FEW]
        if few:  # at most FEW rows a wanted rank
            own: dict[int, list[tuple[float, int]]] = {}
            for r in rows.withColumn("at", _inside(few)).where("at is not null").select("at", "v", "c").collect():
                own.setdefault(r["at"], []).append((r["v"], r["c"]))
            for k, p in enumerate(few):
                ordered = sorted(own[k])
                ends = list(accumulate(c for _, c in ordered))
                for rank, before in places[p].items():
                    out[p[0], rank] = ordered[bisect_right(ends, before)][0]
        if not wide:
            return out
        cut = rows.withColumn("at", _inside(wide)).where("at is not null")
        shares = [j / PARTS for j in range(1, PARTS)]
        edges = {r["at"]: sorted(set(r["e"])) for r in cut.groupBy("at").agg(F.percentile_approx("v", shares, PARTS * 20).alias("e")).collect()}
        part = F.lit(None).cast("int")
        for k in range(len(wide)):
            below = F.size(F.filter(F.array(*[F.lit(e) for e in edges[k]]), lambda e: e < F.col("v")))
            part = F.when(F.col("at") == k, below).otherwise(part)
        counts = cut.withColumn("part", part).groupBy("at", "part").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("values"))
        held = {(r["at"], r["part"]): (r["n"], r["values"]) for r in counts.collect()}  # PARTS numbers a place
        after: dict[tuple, _Wanted] = {}
        for k, p in enumerate(wide):
            borders = [p[1], *edges[k], p[2]]
            ends = list(accumulate(held.get((k, j), (0, 0))[0] for j in range(len(borders) - 1)))
            for rank, before in places[p].items():
                j = bisect_right(ends, before)
                new = (p[0], borders[j], borders[j + 1], p[3] if j == 0 else False, held[k, j][1])
                after.setdefault(new, {})[rank] = before - (ends[j - 1] if j else 0)
        places = after
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], blocks: int | None = None) -> DataFrame:
    """(column, prob, value), exact, distributed (see module doc).

    Eager, like ``DataFrame.approxQuantile``. ``blocks`` sets how fine the brackets are,
    never the result. The result (len(cols) * len(probs) rows) comes back as a small
    DataFrame; a column without values has null ones."""
    probs = [float(p) for p in probs]

    def ranks_of(n: int) -> set[int]:
        return {k for p in probs for k in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}

    found = order_statistics(df, cols, probs, ranks_of, blocks)
    rows = []
    for i, c in enumerate(cols):
        for p in probs:
            value = None
            if i in found:
                n, at = found[i]
                pos = p * (n - 1)
                low, high = math.floor(pos), math.ceil(pos)
                value = at[low] if low == high else (high - pos) * at[low] + (pos - low) * at[high]
            rows.append((c, p, value))
    schema = StructType(
        [
            StructField("column", StringType(), False),
            StructField("prob", DoubleType(), False),
            StructField("value", DoubleType(), True),
        ]
    )
    return df.sparkSession.createDataFrame(rows, schema)


def within(n: Column, below: Column, upto: Column, prob: float, rel_error: float) -> Column:
    """Whether a value with ``below`` rows under it and ``upto`` rows up to it has a rank
    within ``rel_error * n`` (and one row) of ``prob * n``; null without rows."""
    wanted, most = F.lit(float(prob)) * n, F.lit(float(rel_error)) * n + 1
    return F.when(n > 0, (upto >= wanted - most) & (below + 1 <= wanted + most))


def proved_quantiles(df: DataFrame, cols: list[str], probs: list[float], rel_error: float = 0.01) -> DataFrame:
    """(column, prob, value, rows, rows_below, rows_upto, within): the approximate
    quantiles, each with the rank interval that one counting pass finds for its value,
    and whether a rank of that interval is within ``rel_error`` rows of ``prob * rows``.

    Without values there are no rows, and ``within`` is null."""
    found = approx_quantiles(df, cols, probs, rel_error).collect()  # len(cols) * len(probs) rows
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        clean = F.when(~F.isnan(x), x)
        aggs.append(F.count(clean).alias(f"n{i}"))
        for j, r in enumerate(found):
            if r["column"] == c:
                v = F.lit(r["value"]).cast("double")
                aggs += [F.count_if(clean < v).alias(f"b{j}"), F.count_if(clean <= v).alias(f"u{j}")]
    wide = df.agg(*aggs)
    out = []
    for j, r in enumerate(found):
        n, below, upto = F.col(f"n{cols.index(r['column'])}"), F.col(f"b{j}"), F.col(f"u{j}")
        out.append(
            F.struct(
                F.lit(r["column"]).alias("column"), F.lit(r["prob"]).alias("prob"), F.lit(r["value"]).cast("double").alias("value"),
                n.alias("rows"), below.alias("rows_below"), upto.alias("rows_upto"), within(n, below, upto, r["prob"], rel_error).alias("within"),
            )
        )
    return wide.select(F.explode(F.array(*out)).alias("r")).select("r.*")


def quantiles(df: DataFrame, cols: list[str], probs: list[float], method: str = "approx", rel_error: float = 0.01,
              blocks: int | None = None) -> DataFrame:
    if method == "exact":
        return exact_quantiles(df, cols, probs, blocks)
    return approx_quantiles(df, cols, probs, rel_error)
