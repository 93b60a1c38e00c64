import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion_ops.operators.calendar import date_bounds, date_dimension, date_spine
from medallion_ops.operators.quality import (QualityError, enforce, orphan_check, quality_report,
                                             table_checks, unique_flag)
from medallion_ops.session import scratch_path
from medallion_ops.sources import files


def test_table_checks_one_pass_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "k int, v string")
    got = {r.check_name: (r.failures, r.passed) for r in table_checks("t", df, unique="k", not_null=["k", "v"]).collect()}
    assert got == {"not_empty": (0, True), "unique(k)": (1, False), "not_null(k)": (1, False), "not_null(v)": (1, False)}


def test_empty_table_fails_not_empty(spark):
    df = spark.createDataFrame([], "k int")
    got = {r.check_name: r.failures for r in table_checks("t", df, unique="k").collect()}
    assert got == {"not_empty": 1, "unique(k)": 0}


def test_orphans_count_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    r = orphan_check("c", child, parent, "k", "p").first()
    assert (r.failures, r.passed, r.check_name) == (2, False, "orphans(k->p)")


def test_enforce_raises_and_passes(spark):
    good = spark.createDataFrame([(1,), (2,)], "k int")
    bad = spark.createDataFrame([(1,), (1,)], "k int")
    assert len(enforce(quality_report([table_checks("good", good, unique="k")]))) == 2
    with pytest.raises(QualityError, match="bad.unique"):
        enforce(quality_report([table_checks("bad", bad, unique="k")]))


def test_unique_flag(spark):
    assert unique_flag(spark.createDataFrame([(1,), (2,)], "k int"), "k").first().is_unique
    assert not unique_flag(spark.createDataFrame([(1,), (1,)], "k int"), "k").first().is_unique


def test_date_spine_pads_to_whole_years(spark):
    a = spark.createDataFrame([(dt.datetime(2016, 9, 4, 13),), (None,)], "t timestamp")
    b = spark.createDataFrame([(dt.date(2018, 10, 17),)], "d date")
    bounds = date_bounds([(a, ["t"]), (b, ["d"])])
    spine = date_spine(bounds)
    r = spine.agg(F.min("date"), F.max("date"), F.count("*")).first()
    assert tuple(r) == (dt.date(2016, 1, 1), dt.date(2018, 12, 31), 1096)


def test_date_dimension_attributes(spark):
    spine = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2024, 2, 29),)], "date date")
    rows = {r.date: r for r in date_dimension(spine).collect()}
    sun = rows[dt.date(2023, 1, 1)]
    assert (sun.date_key, sun.day_of_week, sun.is_weekend, sun.day_name, sun.week_of_year) == \
        (20230101, 1, True, "Sunday", 52)
    leap = rows[dt.date(2024, 2, 29)]
    assert (leap.quarter_name, leap.month_name, leap.year_month, leap.last_day_of_month,
            leap.first_day_of_month) == ("Q1", "February", "2024-02", dt.date(2024, 2, 29), dt.date(2024, 2, 1))
    assert date_dimension(spine).columns[:2] == ["date_key", "date"]


REVIEWS = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("review_score", T.IntegerType()),
    T.StructField("review_comment_message", T.StringType()),
])

GOOD = "a" * 32
CSV_TEXT = (
    "review_id,order_id,review_score,review_comment_message\n"
    f'{GOOD},o1,5,"spans\ntwo lines"\n'
    f'{"b" * 32},o2,4,"says ""hi"""\n'
    f'{"c" * 32},o3,five,"bad int"\n'
    f'short,o4,3,"short id"\n'
    f',o5,2,"null id"\n'
)


def test_permissive_csv_and_quarantine(spark, tmp_path):
    p = tmp_path / "reviews.csv"
    p.write_text(CSV_TEXT)
    parsed = files.csv_permissive_scan(spark, str(p), REVIEWS)
    clean, rejects = files.quarantine_split(parsed, [F.length("review_id") == 32])
    c = {r.review_id: r for r in clean.collect()}
    assert set(c) == {GOOD, "b" * 32}
    assert c[GOOD].review_comment_message == "spans\ntwo lines"
    assert c["b" * 32].review_comment_message == 'says "hi"'
    rej = rejects.collect()
    assert len(rej) == 3
    assert [r[files.CORRUPT] is not None for r in rej if r.order_id == "o3"] == [True]


def test_lineage_columns_on_a_file_scan(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b\n1,x\n2,y\n")
    df = files.lineage_columns(files.csv_scan(spark, str(p), infer=True), load_ts="2024-06-01 00:00:00")
    rows = df.collect()
    assert len(rows) == 2 and all(r._source_file.endswith("t.csv") for r in rows)
    assert all(r._load_timestamp == dt.datetime(2024, 6, 1) for r in rows)


def test_scratch_paths_live_in_the_checkpoint_folder(spark):
    base = spark.sparkContext.getCheckpointDir()
    p = scratch_path(spark, "x")
    assert p.startswith(base.rstrip("/")) and p != scratch_path(spark, "x")


def test_row_preserving_guard_detects_fan_out(spark):
    from medallion_ops.operators.joins import RowPreservingJoin

    items = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    dup_dim = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "k int, sk int")
    ok_dim = spark.createDataFrame([(1, 10), (2, 20)], "k int, sk int")
    good = RowPreservingJoin("good")
    good.after(items.join(ok_dim, "k", "left")).write.format("noop").mode("overwrite").save()
    assert good.check(items) == (2, 2)
    bad = RowPreservingJoin("bad")
    bad.after(items.join(dup_dim, "k", "left")).write.format("noop").mode("overwrite").save()
    with pytest.raises(AssertionError, match="fan-out"):
        bad.check(items)


def test_quarantine_counts_work_without_rules(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("a,b\n1,x\nbad,y\n3,z\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    clean, rejects = files.quarantine_split(files.csv_permissive_scan(spark, str(p), schema))
    assert (clean.count(), rejects.count()) == (2, 1)


def test_scale_conf_sizes_partitions():
    from medallion_ops.session import scale_conf

    big = scale_conf(100 * 10**12, 8000)
    assert big["spark.sql.shuffle.partitions"] == "93133"          # ~1 GiB of input each
    assert scale_conf(10**9, 8)["spark.sql.shuffle.partitions"] == "16"   # floor: 2 tasks per core


def test_schema_conform_fails_loudly_and_fills_missing(spark):
    from medallion_ops.sources.sinks import schema_conform

    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("score", T.IntegerType()),
                           T.StructField("is_current", T.BooleanType())])
    ok = schema_conform(spark.createDataFrame([("1", "5", "x")], "id string, score string, extra string"), target)
    assert ok.columns == ["id", "score", "is_current"] and tuple(ok.first()) == (1, 5, None)
    bad = schema_conform(spark.createDataFrame([("1", "five")], "id string, score string"), target)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        bad.collect()


def test_bronze_ingest_report_matches_observed_counts(spark, tmp_path):
    a = tmp_path / "a.csv"
    a.write_text("x,y\n1,p\n2,q\n3,r\n")
    b = tmp_path / "b.csv"
    b.write_text("x,y\n9,z\n")
    schema = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])
    out = scratch_path(spark, "ingest")

    def write(name, df):
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return f"{out}/{name}"

    report, observed = files.bronze_ingest(spark, {"a": (str(a), schema), "b": (str(b), schema)}, write)
    assert {r.table_name: r.n_rows for r in report.collect()} == observed == {"a": 3, "b": 1}
    landed = spark.read.parquet(f"{out}/a")
    assert {"_load_timestamp", "_source_file"} <= set(landed.columns)
