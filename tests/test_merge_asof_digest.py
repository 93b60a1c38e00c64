"""Merges that delete, digests against exceptAll, and the sorted as-of lookup."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion_ops.operators.asof import asof_join
from medallion_ops.operators.digest import changed_keys, digests
from medallion_ops.operators.merge import merge, merge_changes, upsert_partitioned
from medallion_ops.operators.scd import scd2_lookup
from medallion_ops.session import scratch_path

SCHEMA = "k int, i int, v string, m int"


def _set(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_actions_of_a_merge(spark):
    target = spark.createDataFrame([(1, 1, "a", 1), (1, 2, "b", 1), (2, 1, "c", 1), (None, 1, "n", 1), (3, 1, None, 1)], SCHEMA)
    source = spark.createDataFrame([(1, 1, "a", 1), (2, 1, "C", 1), (4, 1, "new", 1), (None, 1, "N", 1)], SCHEMA)
    got = {(r.k, r.i): (r["__action"], r.v) for r in merge_changes(target, source, ["k", "i"]).collect()}
    assert got == {(1, 1): ("same", "a"), (1, 2): ("delete", "b"), (2, 1): ("update", "C"), (None, 1): ("update", "N"),
                   (3, 1): ("delete", None), (4, 1): ("insert", "new")}
    scope = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    kept = {(r.k, r.i): r["__action"] for r in merge_changes(target, source, ["k", "i"], scope).collect()}
    assert kept[(1, 2)] == "delete" and kept[(3, 1)] == "keep"
    once = merge(target, source, ["k", "i"])
    assert _set(once) == _set(source) == _set(merge(once, source, ["k", "i"]))


def test_partitioned_merge_removes_rows_and_emptied_partitions(spark):
    path = scratch_path(spark, "merge")
    rows = [(k, i, "x", 10 + k) for k in range(5) for i in range(2)] + [(9, 1, "y", None)]
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("m").parquet(path)
    source = spark.createDataFrame([(0, 0, "X", 10), (1, 0, "moved", 13), (2, 0, "x", 12), (2, 1, "x", 12)], SCHEMA)
    scope = spark.createDataFrame([(k,) for k in (0, 1, 2, 9)], "k int")
    upsert_partitioned(path, source, ["k", "i"], "m", delete_missing=True, scope=scope)
    got = spark.read.parquet(path)
    assert _set(got.select("k", "i", "v", "m")) == _set(source.unionByName(spark.createDataFrame(
        [r for r in rows if r[0] in (3, 4)], SCHEMA)))
    assert {r.m for r in got.select("m").distinct().collect()} == {10, 12, 13, 14}          # 11 and null are gone
    upsert_partitioned(path, source, ["k", "i"], "m", delete_missing=True)
    assert _set(spark.read.parquet(path).select("k", "i", "v", "m")) == _set(source)


VALUE = st.one_of(st.none(), st.sampled_from(["", "a", "b", "0"]))
ROW = st.tuples(st.one_of(st.none(), st.integers(0, 4)), VALUE, VALUE, st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5])))


@settings(max_examples=6, deadline=None)
@given(st.lists(ROW, max_size=14), st.lists(ROW, max_size=14), st.integers(0, 14))
def test_digests_differ_where_the_rows_do(spark, old, new, keep):
    new = old[:keep] + new
    a, b = (spark.createDataFrame(x, "k int, p string, q string, d double") for x in (old, new))
    diff = a.exceptAll(b).select("k").unionByName(b.exceptAll(a).select("k"))
    want = {r.k for r in diff.collect()}
    got = changed_keys(digests({"t": a}, "k"), digests({"t": b.repartition(3)}, "k"), "k").collect()
    assert {r.k for r in got} == want and len(got) == len(want)
    for r in got:
        olds, news = any(x[0] == r.k for x in old), any(x[0] == r.k for x in new)
        assert r.change == ("changed" if olds and news else "new" if news else "gone")


def test_digest_tells_tables_apart_and_shuffles_digests_only(spark):
    a = spark.createDataFrame([(1, "x" * 1000)], "k int, wide string")
    none = a.limit(0)
    assert changed_keys(digests({"s": a, "t": none}, "k"), digests({"s": none, "t": a}, "k"), "k").count() == 1
    plan = digests({"s": a}, "k")._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange")[1]
    assert "partial_sum" in below and "wide" not in plan.split("Exchange")[0]


DAY = dt.date(2020, 1, 1)


def _asof(facts, versions):
    out = []
    for f, k, day in facts:
        fit = [(b, e, s) for s, vk, b, e in versions if None not in (k, day, vk, b) and vk == k and b <= day and e > b]
        best = max(fit) if fit else None
        out.append((f, best[2] if best and day < best[1] else None))
    return sorted(out)


def test_asof_equals_brute_force_over_partition_borders(spark):
    rnd = random.Random(3)
    day = lambda n: DAY + dt.timedelta(days=n)
    versions = [(s, rnd.choice([None, 1, 1, 1, 2, 3]), None if rnd.random() < 0.05 else day(b), day(b + rnd.randint(0, 9)))
                for s, b in enumerate(rnd.choices(range(100), k=120))]
    facts = [(f, rnd.choice([None, 1, 1, 2, 3, 4]), None if rnd.random() < 0.05 else day(rnd.randint(-5, 110))) for f in range(300)]
    facts += [(1000 + f, 1, day(50)) for f in range(200)]
    f = spark.createDataFrame(facts, "f int, k int, day date")
    v = spark.createDataFrame(versions, "s int, k int, b date, e date")
    got = asof_join(f, v, "k", "day", "b", "s", end="e", partitions=9)
    assert sorted((r.f, r.s) for r in got.collect()) == _asof(facts, versions) and got.columns == ["f", "k", "day", "s"]
    assert asof_join(f.limit(0), v, "k", "day", "b", "s", end="e").count() == 0
    none = asof_join(f, v.limit(0), "k", "day", "b", "s", end="e").collect()
    assert len(none) == len(facts) and all(r.s is None for r in none)


def test_asof_of_a_hot_person_with_many_versions(spark):
    """A third of the facts and 10,000 versions are one person's; no task holds them all and none multiply."""
    versions = spark.range(10_000).selectExpr("1 as k", "id as sk", "date_add(date'1970-01-01', cast(id as int)) as effective_date",
                                              "date_add(date'1970-01-01', cast(id + 1 as int)) as end_date", "false as is_current")
    facts = spark.range(0, 30_000, 1, 4).selectExpr(
        "id as f", "case when id % 3 = 0 then 1 else id end as k", "date_add(date'1970-01-01', cast(id % 10007 as int)) as day")
    got = scd2_lookup(facts, versions, "k", sk="sk", mode="point_in_time", at="day")
    n = got.agg(F.count(F.lit(1)).alias("n"), F.count("sk").alias("hit"),
                F.sum((F.col("sk") != F.datediff("day", F.lit("1970-01-01"))).cast("int")).alias("wrong")).collect()[0]
    want = sum(1 for i in range(0, 30_000, 3) if i % 10007 < 10_000) + (1 < 10_000)
    assert (n.n, n.wrong) == (30_000, 0) and n.hit == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__key" in plan and "(k" not in "".join(x for x in plan.splitlines() if "Join" in x)
