"""One multi-line file read by many tasks gives the rows of the one-task reader."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from medallion_ops.session import scratch_path
from medallion_ops.sources.files import csv_permissive_scan
from medallion_ops.sources.split_csv import csv_records, split_csv_scan

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("text", T.StringType()),
                       T.StructField("n", T.DoubleType())])


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "40"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k in keys:
        spark.conf.unset(k)


def _write(spark, texts):
    path = scratch_path(spark, "csv")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for i, text in enumerate(texts):
        out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/part{i}.csv"))
        out.write(bytearray(text.encode()))
        out.close()
    return path


def _csv(rows, end="\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    w.writerow(["id", "text", "n"])
    w.writerows(rows)
    return out.getvalue()


def _both(spark, path):
    return [sorted(map(str, f(spark, path, SCHEMA).collect())) for f in (csv_permissive_scan, split_csv_scan)]


def test_one_file_in_many_tasks(small_splits):
    spark, rnd = small_splits, random.Random(5)
    word = lambda: rnd.choice(["a", "b c", 'say "x"', "line\nbreak", "\n\n", ",", "é中", "end.", '"', 'x' * 90 + "\n" + "y" * 200])
    rows = [(i, " ".join(word() for _ in range(rnd.randint(0, 4))), rnd.choice(["1.5", "", "n/a"])) for i in range(150)]
    path = _write(spark, [_csv(rows), _csv(rows[:3]), "id,text,n\n"])
    one, many = _both(spark, path)
    assert one == many and len(many) == 153
    assert spark.read.text(path).rdd.getNumPartitions() >= 30
    assert sum(r["head"] for r in csv_records(spark, path).select("head").collect()) == 3


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 99), st.text(alphabet='ab",\n é', max_size=12)), max_size=12))
def test_any_quoted_text(spark, rows):
    # a text of white space alone is trimmed to an unquoted one by neither reader
    path = _write(spark, [_csv([(i, t, "2") for i, t in rows])])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        one, many = _both(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert one == many and len(many) == len(rows)


def test_windows_line_ends_and_empty_lines(small_splits):
    spark = small_splits
    path = _write(spark, [_csv([(1, "a b", "1"), (2, "c", "x"), (3, 'q "q"', "")], "\r\n") + "\r\n\r\n"])
    one, many = _both(spark, path)
    assert one == many and len(many) == 3


def test_a_quote_that_never_closes_raises(small_splits):
    spark = small_splits
    path = _write(spark, ['id,text,n\n1,"open,2\n' + "3,x,4\n" * 300])
    with pytest.raises(ValueError, match="does not close"):
        split_csv_scan(spark, path, SCHEMA, max_record_bytes=1000)
