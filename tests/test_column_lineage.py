"""Column lineage read off plans."""

from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegate.plans import column_lineage as CL
from tidegate.plans import governance
from tidegate.runtime import stage


@pytest.fixture
def tables(spark):
    a = spark.createDataFrame([(1, 2, "x")], "k int, v int, t string")
    b = spark.createDataFrame([(1, 9)], "k int, w int")
    return a, b


def short(columns):
    return {c: sorted(s) for c, s in columns.items()}


def test_expressions_joins_groups_and_windows(tables):
    with CL.tracing() as trace:
        a, b = trace.source(tables[0], "a"), trace.source(tables[1], "b")
        joined = a.join(b, "k").where("w > 1").select("k", (F.col("v") + F.col("w")).alias("sum"), F.lit(1).alias("one"), "t")
        assert short(trace.columns(joined)) == {"k": ["a.k"], "sum": ["a.v", "b.w"], "one": [], "t": ["a.t"]}
        grouped = joined.groupBy("k").agg(F.sum("sum").alias("s"), F.max(F.when(F.col("t") == "x", F.col("one"))).alias("m"))
        assert short(trace.columns(grouped)) == {"k": ["a.k"], "s": ["a.v", "b.w"], "m": ["a.t"]}
        week = Window.partitionBy("t").orderBy("k").rowsBetween(-1, 0)
        windowed = a.select("k", F.sum("v").over(week).alias("run"), F.row_number().over(Window.orderBy("v")).alias("n"))
        assert short(trace.columns(windowed)) == {"k": ["a.k"], "run": ["a.v"], "n": []}


def test_unions_explodes_self_joins_and_pandas(tables):
    with CL.tracing() as trace:
        a, b = trace.source(tables[0], "a"), trace.source(tables[1], "b")
        both = a.select("k", F.col("v").alias("n")).union(b)
        assert short(trace.columns(both)) == {"k": ["a.k", "b.k"], "n": ["a.v", "b.w"]}
        lines = a.select("k", F.explode(F.split("t", "")).alias("c"))
        assert short(trace.columns(lines)) == {"k": ["a.k"], "c": ["a.t"]}
        again = a.alias("l").join(a.alias("r"), F.col("l.k") == F.col("r.v")).select("l.t", F.col("r.v").alias("rv"))
        assert short(trace.columns(again)) == {"t": ["a.t"], "rv": ["a.v"]}
        kept = a.join(b, "k", "left_semi")
        assert short(trace.columns(kept)) == {"k": ["a.k"], "v": ["a.v"], "t": ["a.t"]}
        mapped = a.select("k", "v").mapInPandas(lambda x: x, "k int, z int")
        assert short(trace.columns(mapped)) == {"k": ["a.k", "a.v"], "z": ["a.k", "a.v"]}


def test_columns_are_followed_through_staging(spark, tables):
    with CL.tracing() as trace:
        a = trace.source(tables[0], "a")
        kept = stage(a.select((F.col("v") * 2).alias("double"), "t"), "traced")
        out = kept.groupBy("t").agg(F.max("double").alias("top"))
        assert short(trace.columns(out)) == {"t": ["a.t"], "top": ["a.v"]}
        assert out.collect()[0]["top"] == 4
    assert short(trace.columns(stage(out, "untraced"))) == {"t": [], "top": []}
    rows = CL.as_rows(spark, "m", {"x": frozenset(["zone.a.v", "b.w"]), "one": frozenset()})
    assert sorted(map(tuple, rows.collect()), key=str) == [
        ("m", "one", None, None), ("m", "x", "b", "w"), ("m", "x", "zone.a", "v"),
    ]


def test_plans_against_the_declared_graph(spark, tables):
    from tidegate.plans import intermediate, staging
    from tidegate.schemas import PUBLISHED_USERS

    users = spark.createDataFrame([], PUBLISHED_USERS)
    with CL.tracing() as trace:
        stg = staging.stg_users(trace.source(users, "prod.raw_users"), datetime(2024, 1, 1))
        found = {"staging.stg_raw_users": CL.tables_of(trace.columns(stg))}
    names = {governance.node_id(n): n for n, *_ in governance.NODES}
    declared = {}
    for a, b, _ in governance.EDGES:
        declared.setdefault(governance.node_id(b), set()).add(governance.node_id(a))
    assert names["staging.stg_raw_users"] == "stg_raw_users"
    only = {k: v for k, v in declared.items() if k in found}
    assert CL.against_declared(found, only) == []
    assert CL.against_declared(found, {"staging.stg_raw_users": {"x"}}) == [
        ("staging.stg_raw_users", "prod.raw_users", "not declared"), ("staging.stg_raw_users", "x", "declared only"),
    ]
    assert intermediate.completed is not None
