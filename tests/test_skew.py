"""A key holding a third of the rows: results stay whole and exact."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from medallion_ops.operators.dedup import dedup_latest
from medallion_ops.operators.keys import dense_surrogate_key
from medallion_ops.operators.quality import table_checks
from medallion_ops.operators.windows import per_key_total

N = 3000


def _hot(spark):
    # key 0 holds a third of all rows; the rest are spread over 200 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200 + 1).alias("k"),
        F.col("id"), (F.col("id") * 7 % 101).cast("double").alias("v")).repartition(8)


def test_dedup_latest_with_hot_key(spark):
    df = _hot(spark)
    got = {r.k: r.id for r in dedup_latest(df, ["k"], [("v", "desc")], tie_break=[("id", "desc")]).collect()}
    w = Window.partitionBy("k").orderBy(F.col("v").desc(), F.col("id").desc())
    ref = {r.k: r.id for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").collect()}
    assert got == ref and len(got) == 201


def test_per_key_total_with_hot_key(spark):
    df = _hot(spark)
    out = per_key_total(df, "k", "v", "tot", scale=None)
    assert out.count() == N
    hot = out.filter("k = 0").select("tot").distinct().collect()
    assert len(hot) == 1 and hot[0].tot == df.filter("k = 0").agg(F.sum("v")).first()[0]


def test_dense_key_spreads_a_hot_key_with_tie_break(spark):
    df = _hot(spark)
    out = dense_surrogate_key(df, ["k"], tie_break=["id"], partitions=8)
    w = Window.orderBy("k", "id")
    ref = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert {r.id: r.sk for r in out.collect()} == ref


def test_quality_counts_with_hot_key(spark):
    df = _hot(spark)
    r = {x.check_name: x.failures for x in table_checks("t", df, unique="k").collect()}
    assert r["unique(k)"] == N - 201


def test_per_key_total_matches_the_window_for_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (1, 5.0)], "k int, v double")

    def triples(frame):
        return sorted(((r.k if r.k is not None else -1), r.v, r.tot) for r in frame.collect())

    got = triples(per_key_total(df, "k", "v", "tot", scale=None))
    ref = triples(df.withColumn("tot", F.sum("v").over(Window.partitionBy("k"))))
    assert got == ref == [(-1, 1.0, 3.0), (-1, 2.0, 3.0), (1, 5.0, 5.0)]
