"""Near-duplicate vectors by lattice hashing.

Unit vectors are projected at random to eight dimensions, once per table, and
decoded to the nearest point of the E8 lattice. A vector lies in its own cell and
asks the neighbouring cells nearest to it; equal cells give candidate pairs, whose
cosine is then computed in double precision."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, count, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, stored
from .graph import components

MIN_COSINE = 0.98
TABLES = 5
PROBES = 16
#: Lattice unit in the projected space, where a pair at the threshold is about 0.57 apart.
WIDTH = 0.44
SEED = 17
#: A cell of more than one in CELL_SHARE home vectors is split into CELL_BLOCKS, each of which every asker visits.
CELL_SHARE, CELL_BLOCKS = 1024, 64


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8, which lead to the neighbouring cells."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            whole.append(v)
    half = [np.array(s) / 2 for s in product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(whole + half)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: if odd, the worst coordinate goes the other way."""
    near = np.rint(x)
    off = x - near
    odd = near.sum(axis=1) % 2 != 0
    worst = np.abs(off).argmax(axis=1)
    rows = np.flatnonzero(odd)
    near[rows, worst[rows]] += np.where(off[rows, worst[rows]] >= 0, 1, -1)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8 = D8 and D8 shifted by one half, of each row."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def _cell_ids(points: np.ndarray) -> np.ndarray:
    """64-bit ids of lattice points (rows of the last axis), of doubled coordinates."""
    mix = np.random.default_rng(SEED + 1).integers(1 << 62, size=8, dtype=np.int64) | 1
    out = ((2 * points).astype(np.int64) * mix).sum(axis=-1)
    return out ^ (out >> 29)


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Home cell (rows, tables) and asked cells (rows, tables, 1 + probes)."""
    d, step = unit.shape[1], roots()
    home = np.empty((len(unit), tables), np.int64)
    asked = np.empty((len(unit), tables, 1 + probes), np.int64)
    for t in range(tables):
        x = unit @ np.random.default_rng((SEED, d, t)).standard_normal((d, 8)) / width
        own = nearest_e8(x)
        near = np.argpartition(-((x - own) @ step.T), probes, axis=1)[:, :probes]
        home[:, t] = _cell_ids(own)
        asked[:, t, 0] = home[:, t]
        asked[:, t, 1:] = _cell_ids(own[:, None, :] + step[near])
    return home, asked


def _numbered(own: DataFrame) -> tuple[DataFrame, Column]:
    """The classes (class, label, v, least, n) of equal vectors of a label, which combine
    on the map side, and the hash that is their number. A seed under which two classes
    share a number is given up for the next one, so a number stands for its vector."""
    held = own.groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    for seed in count():
        number = F.xxhash64(F.lit(seed), "label", "v")
        classes = stored(held.select(number.alias("class"), "label", "v", "least", "n"), "classes")
        if classes.groupBy("class").agg(F.count(F.lit(1)).alias("k")).where("k > 1").isEmpty():
            return classes, number


def _meetings(entries: DataFrame) -> DataFrame:
    """(a, b): a lies in a cell that b asks. Home vectors of a crowded cell, of which
    there are fewer than CELL_SHARE, are dealt to CELL_BLOCKS blocks and each asker
    goes to all of them, so no task holds the cell."""
    lies = entries.where("home").select("cell", F.col("class").alias("a"))
    asks = entries.where(~F.col("home")).select("cell", F.col("class").alias("b"))
    sizes = stored(lies.groupBy("cell").agg(F.count(F.lit(1)).alias("held")), "sizes")
    most = max(CELL_BLOCKS, (sizes.agg(F.sum("held")).first()[0] or 0) // CELL_SHARE)
    crowded = sizes.where(F.col("held") > most).select("cell")
    if crowded.isEmpty():
        return lies.join(asks, "cell").select("a", "b")
    crowded = F.broadcast(crowded)
    even = lies.join(crowded, "cell", "left_anti").join(asks.join(crowded, "cell", "left_anti"), "cell")
    block = F.pmod(F.xxhash64("a"), F.lit(CELL_BLOCKS)).cast("int").alias("block")
    some = lies.join(crowded, "cell").select("cell", "a", block)
    every = asks.join(crowded, "cell").select("cell", "b", F.explode(F.sequence(F.lit(0), F.lit(CELL_BLOCKS - 1))).alias("block"))
    return even.select("a", "b").unionByName(some.join(every, ["cell", "block"]).select("a", "b"))


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
    min_cosine: float = MIN_COSINE, tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors of its label found at
    ``min_cosine`` or more), component_id (smallest id reachable), kept.

    Vectors that are null, empty, zero or hold null or non-finite components, and
    vectors without a label, link with nothing. Equal vectors of a label are one
    class and count through its size; links run between classes, so a group of
    copies makes no pairs. Vectors of different lengths never meet. Rows that repeat
    an id are vectors of their own; a null id counts but names no component unless
    alone. Extra columns are ignored; an empty table gives no rows."""
    own = rows.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    good = F.col("label").isNotNull() & (F.size("v") > 0) & F.exists("v", lambda x: x != 0)
    good = good & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = F.coalesce(good, F.lit(False))
    classes, number = _numbered(own.where(good))
    ids = stored(own.select("vec_id", F.when(good, number).alias("class")), "ids")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_length: dict[int, list[int]] = {}
            vectors = b.column(2)
            for i, v in enumerate(vectors):
                by_length.setdefault(len(v), []).append(i)
            for d, at in by_length.items():
                x = np.array([vectors[i].as_py() for i in at], np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                home, asked = cells(x / np.sqrt((x * x).sum(axis=1, keepdims=True)), tables, probes)
                who, lab = b.column(0).to_numpy()[at], b.column(1).to_numpy()[at]
                salt = np.arange(tables) * 1_000_003 + d
                keys = np.concatenate((home[:, :, None], asked), axis=2) * 31 + salt[None, :, None] + (lab * 0x2545F4914F6CDD1D)[:, None, None]
                times = tables * (2 + probes)
                first = np.tile(np.arange(2 + probes) == 0, len(at) * tables)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(who, times)), pa.array(keys.ravel()), pa.array(first)], names=["class", "cell", "home"])

    entries = stored(classes.select("class", "label", "v").mapInArrow(hashed, "class bigint, cell bigint, home boolean"), "cells")
    pairs = _meetings(entries).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one = classes.select(F.col("class").alias("a"), F.col("v").alias("va"), F.col("label").alias("la"))
    two = classes.select(F.col("class").alias("b"), F.col("v").alias("vb"), F.col("label").alias("lb"))
    both = pairs.join(one, "a").join(two, "b").where("la = lb AND size(va) = size(vb)").select("a", "b", "va", "vb")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column(2)])
            for d in np.unique(lengths):
                part = batch.filter(pa.array(lengths == d))
                x = part.column(2).flatten().to_numpy().reshape(-1, d)
                y = part.column(3).flatten().to_numpy().reshape(-1, d)
                x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
                cosine = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
                near = part.filter(pa.array(cosine >= min_cosine))
                yield near.select(["a", "b"])

    links = stored(both.mapInArrow(verified, "a bigint, b bigint"), "links")
    sizes = classes.select("class", "n", "least")
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = ends.join(sizes, F.col("b") == F.col("class")).groupBy("a").agg(F.sum("n").alias("others"))
    named = sizes.join(linked, F.col("class") == F.col("a"), "left").join(components(links), F.col("class") == F.col("node"), "left")
    named = stored(named.select("class", "n", "least", F.coalesce("others", F.lit(0)).alias("others"), F.coalesce("component", "class").alias("root")), "named")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("held"))
    table = join_hot(named, smallest, "root", "held", named.count()).select(
        "class", "n", (F.col("others") + F.col("n") - 1).alias("n_links"), "component_id"
    )
    usable = join_hot(ids.where(F.col("class").isNotNull()), table, "class", "n", ids.count()).select("vec_id", "n_links", "component_id")
    alone = ids.where(F.col("class").isNull()).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = usable.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
