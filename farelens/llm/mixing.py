"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight schedule over the training run (piecewise linear).
Its integral is the source's weight; water-filling turns weights into word
targets, none above ``max_repeat`` times its source. A document's place in its
source's (hashed) order gives the words demanded before it; inverting the
source's cumulative demand gives the training position, and the mix is
range-sorted by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, clean_text, stored, whole_row

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MAX_REPEAT = 2
#: (time, relative weight) knots per weight: heavy sources fade, rare ones rise; each integrates to 1.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def integral(knots: tuple[tuple[float, float], ...]) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def inverse_demand(fraction: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time by which ``fraction`` of a source's words have been demanded."""
    whole, done, out = integral(knots), 0.0, None
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        rest = fraction * F.lit(whole) - F.lit(done)
        slope = (w1 - w0) / (t1 - t0)
        here = F.lit(t0) + F.lit(2.0) * rest / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2.0 * slope) * rest, F.lit(0.0))))
        done += (t1 - t0) * (w0 + w1) / 2
        out = F.when(fraction * F.lit(whole) <= F.lit(done), here) if out is None else out.when(fraction * F.lit(whole) <= F.lit(done), here)
    return F.least(F.greatest(out.otherwise(F.lit(1.0)), F.lit(0.0)), F.lit(1.0))


def word_count(text: str = "text") -> Column:
    return F.regexp_count(clean_text(text), F.lit(WORD)).cast("bigint")


def source_targets(sources: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Targets from a summary of one row per source: src (a key that orders the
    sources, null last), source_size. Adds weight_no and target.

    Water-filling in closed form: ordered by cap / weight, the sources before the
    level are at their cap and the others share what is left by weight. The two
    running windows see one row per source, never documents."""
    n = len(weights)
    rank = F.row_number().over(Window.orderBy("src")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("weight_no") + 1).cast("int"))
    ranked = sources.withColumn("weight_no", rank % n).withColumn("weight", weight)
    ranked = ranked.withColumn("cap", F.col("source_size") * max_repeat)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranked.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weight_before"),
        (F.sum("source_size").over(every) * F.lit(float(budget))).alias("words"),
        F.sum("weight").over(every).alias("weights"),
    )
    level = (F.col("words") - F.col("cap_before")) / (F.col("weights") - F.col("weight_before"))
    ranked = ranked.withColumn("level", level).withColumn("place", F.row_number().over(order))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    reached = F.min(fits).over(every)["level"]  # of the first source below its cap
    target = F.least(F.col("cap").cast("double"), F.coalesce(reached * F.col("weight"), F.col("cap").cast("double")))
    return ranked.select("src", "source_size", "weight_no", target.alias("target"))


def queue_key(text: str = "text", id_col: str = "doc_id") -> Column:
    """The MD5 of id and text, by which documents queue: rows of one id, or of none, part."""
    own_id = F.coalesce(F.col(id_col).cast("bigint").cast("string"), F.lit(""))
    return F.md5(F.concat(own_id, F.lit("\n"), clean_text(text)).cast("binary"))


def placements(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    id_col: str = "doc_id",
    weights=WEIGHTS,
    schedules=SCHEDULES,
    budget: float = BUDGET,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's),
    taken (words, repeats counted), positions (0 to 1, one per pass; null beyond
    the target).

    A source's documents are queued in the order of a hash of id and text, pass after
    pass, until its target is met: every document is taken whole in each pass but
    for the one where the target falls. Null or blank texts have size 0 and are
    never taken; a null source is a source of its own, last; ties and repeated
    rows are queued one after the other. An empty table gives no rows.

    Prefix sums run in two levels of about sqrt(rows) each (blocks of the hash,
    then documents in a block), so no window holds a whole source."""
    src = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("t"))
    own_id = F.col(id_col).cast("bigint")
    order = queue_key(text, id_col)
    sized = stored(docs.select(own_id.alias("doc_id"), src.alias("src"), order.alias("ord"), word_count(text).alias("size")), "sizes")
    n = sized.count()
    blocks = 1 << max(0, (max(1, n).bit_length() - 1) // 2)
    sized = sized.withColumn("block", F.conv(F.substring("ord", 1, 8), 16, 10).cast("bigint") % blocks)
    held = sized.groupBy("src", "block").agg(F.sum("size").alias("block_size"))
    sums = held.groupBy("src").agg(F.sum("block_size").alias("source_size"))
    ahead = Window.partitionBy("src").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.withColumn("block_start", F.coalesce(F.sum("block_size").over(ahead), F.lit(0))).drop("block_size")
    starts = starts.join(source_targets(sums, weights, budget, max_repeat), "src")
    inside = Window.partitionBy("src", "block").orderBy("ord", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["src", "block"])
    start = F.col("block_start") + F.col("inner")
    goal = F.floor(F.col("target")).cast("bigint")
    taken = F.lit(0).cast("bigint")
    for again in range(max_repeat):
        left = goal - F.col("source_size") * again - start
        taken = taken + F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), left))
    positions = []
    for again in range(max_repeat):
        words = start + F.col("source_size") * again
        middle = (words.cast("double") + F.col("size") / F.lit(2.0)) / F.col("target")
        at = F.lit(None).cast("double")
        for i, knots in enumerate(schedules):
            at = F.when(F.col("weight_no") == i, inverse_demand(F.least(middle, F.lit(1.0)), knots)).otherwise(at)
        positions.append(F.round(F.when((words < goal) & (F.col("size") > 0), at), 9))
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.array(*positions).alias("positions"), "ord")


def curriculum(docs: DataFrame, **params) -> DataFrame:
    """``placements`` range-sorted by ``position``, that of the first copy (null:
    not taken, last)."""
    first = placements(docs, **params).withColumn("position", F.element_at("positions", 1)).drop("positions", "ord")
    return first.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mix(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", **params) -> DataFrame:
    """``docs`` (all columns, whatever their names) as the mix takes them, in training
    order: a document comes once for every whole size taken, and the one where a
    source's target falls comes whole if at least half of it was due. Texts are never
    cut. Rows that share id and text share the largest number of copies among them.
    An empty table gives no rows."""
    plan = placements(docs, text, source, id_col, **params).where("taken > 0")
    copies = F.floor(F.col("taken") / F.col("size") + F.lit(0.5)).cast("int")
    plan = plan.groupBy("ord").agg(F.max(F.struct(copies.alias("n"), "positions")).alias("due"))
    own = docs.select(whole_row(docs), F.col(id_col).cast("bigint").alias("doc_id"), queue_key(text, id_col).alias("ord"))
    due = own.join(plan.where("due.n > 0"), "ord")
    placed = due.withColumn("at", F.explode(F.slice("due.positions", F.lit(1), F.col("due.n"))))
    return placed.orderBy("at", "doc_id", "ord").select("row.*")
