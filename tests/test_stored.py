"""Stored tables: untouched files of other sources, and keyed joins without a shuffle of the stored side."""

import glob
import os

from waymark.sources.shared import shared_dir
from waymark.sources.stored import StoredTable


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path.removeprefix('file://')}/source=*/*.parquet")}


def test_sources_are_apart(spark):
    schema = "id long, name string, source string"
    path = shared_dir(spark)
    t = StoredTable(spark, "stored_nodes", ("id",), path=path).create(spark.createDataFrame([(i, f"n{i}", "ab"[i % 2]) for i in range(100)], schema))
    before = files(path)
    t.upsert(spark.createDataFrame([(1, "new", "b"), (3, None, "b"), (777, "added", "b")], schema))
    now = files(path)
    assert {f for f in before if "source=a" in f} == {f for f in now if "source=a" in f} and all(now[f] == m for f, m in before.items() if "source=a" in f)
    got = {r.id: r.name for r in t.rows().where("source = 'b'").collect()}
    assert got == {**{i: f"n{i}" for i in range(1, 100, 2)}, 1: "new", 777: "added"}
    t.reset("a")
    assert {r.source for r in t.rows().collect()} == {"b"} and {f for f in files(path) if "source=b" in f} == {f for f in now if "source=b" in f}
    t.reset("nowhere")
    assert t.rows().count() == 51
    spark.sql("DROP TABLE stored_nodes")


def test_stored_side_of_a_join_is_not_shuffled(spark):
    path = shared_dir(spark)
    t = StoredTable(spark, "stored_edges", ("src",), path=path).create(spark.range(2000).selectExpr("id as src", "id % 7 as dst", "'s' as source"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hit = t.present(spark.range(1990, 2010).selectExpr("id as src").union(spark.sql("select cast(null as bigint)")))
        plan = hit._jdf.queryExecution().executedPlan().toString()
        keyed, scan = plan.split("Union")[1], "Bucketed: true"
        first = keyed[: keyed.index(scan) + len(scan)]  # the keyed join down to the stored side's scan: one exchange, that of the new rows
        assert first.count("Exchange hashpartitioning(") == 1
        assert sorted(r.src for r in hit.collect()) == list(range(1990, 2000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.sql("DROP TABLE stored_edges")
