"""Shared helpers: the hot-key join and the shared folder."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from farelens.llm import common, queries


@pytest.mark.parametrize("share", [4, 1024])
def test_join_hot_equals_the_plain_join(spark, monkeypatch, share):
    monkeypatch.setattr(common, "HOT_SHARE", share)
    rows = spark.range(600).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 7")
    want = sorted(map(tuple, rows.join(table, "k").select("k", "id", "n").collect()))
    assert sorted(map(tuple, common.join_hot(rows, table, "k", "n", 600).select("k", "id", "n").collect())) == want


def _shuffled(df):
    """Records that the exchanges of the executed plan wrote, and their number."""
    rows, todo, seen = 0, [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            seen += 1
            rows += node.metrics().get("shuffleRecordsWritten").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows, seen


def test_hot_rows_stay_out_of_the_shuffle(spark):
    """A third of the rows hold one key: only the others and the table are shuffled."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(old, ("false", "-1")):
        spark.conf.set(k, v)
    try:
        rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
        table = common.stored(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "table")
        joined = common.join_hot(rows, table, "k", "n", 30_000)
        assert len(joined.collect()) == 30_000
        written, exchanges = _shuffled(joined)
        assert exchanges == 2 and written == 20_000 + 20_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_cluster_must_name_the_shared_folder():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(session)
    session.conf.get = lambda *_: "/shared"
    assert common.shared_folder(session) == "/shared"


def test_registered_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
