import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion_ops.operators.merge import DuplicateKeyError, upsert
from medallion_ops.operators.scd import current_unique_violations, scd2_apply, scd2_lookup, scd2_seed

SCHEMA = "k int, v string"


def _kv(df):
    return sorted(((r.k, r.v) for r in df.collect()), key=lambda t: (t[0] is None, t[0] or 0, t[1]))


def test_upsert_update_insert_untouched(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], SCHEMA)
    source = spark.createDataFrame([(2, "B"), (4, "D")], SCHEMA)
    assert _kv(upsert(target, source, "k")) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]


def test_upsert_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, "t"), (1, "a")], SCHEMA)
    source = spark.createDataFrame([(None, "s")], SCHEMA)
    assert _kv(upsert(target, source, "k")) == [(1, "a"), (None, "s"), (None, "t")]


def test_upsert_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], SCHEMA)
    source = spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        upsert(target, source, "k")


def test_upsert_rejects_different_columns(spark):
    target = spark.createDataFrame([(1, "a")], SCHEMA)
    with pytest.raises(ValueError):
        upsert(target, spark.createDataFrame([(1,)], "k int"), "k")


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(st.integers(0, 20), st.text("abc", max_size=2), max_size=12),
       st.dictionaries(st.integers(0, 20), st.text("abc", max_size=2), max_size=12))
def test_upsert_is_idempotent(spark, t, s):
    target = spark.createDataFrame(list(t.items()), SCHEMA)
    source = spark.createDataFrame(list(s.items()), SCHEMA)
    once = upsert(target, source, "k")
    twice = upsert(once, source, "k")
    assert _kv(once) == _kv(twice) == sorted({**t, **s}.items())


AS_OF = dt.date(2024, 2, 1)
ATTRS = ["city", "state"]


def _seed(spark):
    base = spark.createDataFrame(
        [("u", "A", "X"), ("c", "B", "Y"), ("nul", None, "Z"), ("gone", "G", "G")],
        "id string, city string, state string")
    return scd2_seed(base, "id", ATTRS, effective="2024-01-01")


def test_scd2_seed_shape(spark):
    dim = _seed(spark)
    assert dim.columns == ["sk", "id", "city", "state", "effective_date", "end_date", "is_current"]
    assert sorted(r.sk for r in dim.collect()) == [1, 2, 3, 4]
    assert all(r.is_current and r.end_date == dt.date(9999, 12, 31) for r in dim.collect())


def test_scd2_apply_classifies_unchanged_changed_new(spark):
    dim = _seed(spark)
    incoming = spark.createDataFrame(
        [("u", "A", "X"), ("c", "B2", "Y"), ("nul", "now", "Z"), ("n", "N", "N")],
        "id string, city string, state string")
    out = scd2_apply(dim, incoming, "id", ATTRS, AS_OF)
    by = {}
    for r in out.collect():
        by.setdefault(r.id, []).append(r)
    # unchanged: one current row, untouched
    assert len(by["u"]) == 1 and by["u"][0].is_current
    # changed: old version expired at as_of, new one open from as_of
    old, new = sorted(by["c"], key=lambda r: r.effective_date)
    assert (old.is_current, old.end_date) == (False, AS_OF)
    assert (new.is_current, new.effective_date, new.city) == (True, AS_OF, "B2")
    # null -> value is a change (null-safe compare)
    assert len(by["nul"]) == 2
    # new key: exactly one current row
    assert len(by["n"]) == 1 and by["n"][0].is_current
    # absent from incoming: stays current (hard deletes ignored)
    assert len(by["gone"]) == 1 and by["gone"][0].is_current
    # new surrogate keys continue after the old maximum, all distinct
    sks = [r.sk for r in out.collect()]
    assert len(set(sks)) == len(sks) == 7 and max(sks) == 7      # 4 seeded + 3 inserted
    assert current_unique_violations(out, "id").count() == 0


def test_scd2_rerun_same_snapshot_is_stable(spark):
    dim = _seed(spark)
    incoming = spark.createDataFrame([("c", "B2", "Y")], "id string, city string, state string")
    once = scd2_apply(dim, incoming, "id", ATTRS, AS_OF)
    twice = scd2_apply(once, incoming, "id", ATTRS, AS_OF)
    assert sorted(tuple(r) for r in once.collect()) == sorted(tuple(r) for r in twice.collect())


def test_scd2_intervals_do_not_overlap(spark):
    dim = _seed(spark)
    inc1 = spark.createDataFrame([("c", "B2", "Y")], "id string, city string, state string")
    inc2 = spark.createDataFrame([("c", "B3", "Y")], "id string, city string, state string")
    out = scd2_apply(scd2_apply(dim, inc1, "id", ATTRS, AS_OF), inc2, "id", ATTRS, dt.date(2024, 3, 1))
    versions = sorted((r.effective_date, r.end_date) for r in out.collect() if r.id == "c")
    assert len(versions) == 3
    for (s1, e1), (s2, e2) in zip(versions, versions[1:]):
        assert e1 == s2 and s1 < e1
    assert sum(1 for r in out.collect() if r.id == "c" and r.is_current) == 1


def test_scd2_apply_rejects_duplicate_incoming(spark):
    dim = _seed(spark)
    incoming = spark.createDataFrame([("c", "x", "y"), ("c", "z", "y")], "id string, city string, state string")
    with pytest.raises(DuplicateKeyError):
        scd2_apply(dim, incoming, "id", ATTRS, AS_OF)


def test_scd2_lookup_current_and_point_in_time(spark):
    dim = _seed(spark)
    incoming = spark.createDataFrame([("c", "B2", "Y")], "id string, city string, state string")
    out = scd2_apply(dim, incoming, "id", ATTRS, AS_OF)
    facts = spark.createDataFrame(
        [(1, "c", dt.date(2024, 1, 15)), (2, "c", dt.date(2024, 2, 15)), (3, "zz", dt.date(2024, 2, 15)),
         (4, "c", dt.date(2023, 1, 1))], "f int, id string, d date")
    cur = {r.f: r.sk for r in scd2_lookup(facts, out, "id", mode="current").collect()}
    pit = {r.f: r.sk for r in scd2_lookup(facts, out, "id", mode="point_in_time", at="d").collect()}
    new_sk = [r.sk for r in out.collect() if r.id == "c" and r.is_current][0]
    old_sk = [r.sk for r in out.collect() if r.id == "c" and not r.is_current][0]
    assert cur == {1: new_sk, 2: new_sk, 3: None, 4: new_sk}
    assert pit == {1: old_sk, 2: new_sk, 3: None, 4: None}
    assert scd2_lookup(facts, out, "id", mode="point_in_time", at=F.col("d")).count() == 4


def test_upsert_partitioned_rewrites_only_touched_partitions(spark):
    import glob
    import os

    from medallion_ops.operators.merge import upsert_partitioned
    from medallion_ops.session import scratch_path

    path = scratch_path(spark, "upsert_parts")
    spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", None)], "k int, v string, p int") \
        .write.partitionBy("p").parquet(path)
    local = path[len("file:"):] if path.startswith("file:") else path
    before = {f: os.path.getmtime(f) for f in glob.glob(local + "/p=*/*.parquet")}
    source = spark.createDataFrame([(2, "B", 1), (5, "E", 1), (6, "F", None)], "k int, v string, p int")
    upsert_partitioned(path, source, "k", "p")
    got = sorted(map(tuple, spark.read.parquet(path).select("k", "v", "p").collect()))
    assert got == [(1, "a", 1), (2, "B", 1), (3, "c", 2), (4, "d", None), (5, "E", 1), (6, "F", None)]
    untouched = [f for f in before if "/p=2/" in f]
    assert untouched and all(os.path.getmtime(f) == before[f] for f in untouched)


def test_upsert_partitioned_moves_rows_between_partitions(spark):
    from medallion_ops.operators.merge import upsert_partitioned
    from medallion_ops.session import scratch_path

    path = scratch_path(spark, "upsert_moves")
    spark.createDataFrame([(1, 1, 199501), (2, 1, None), (3, 1, 199504), (4, 1, 199505)], "k int, v int, p int") \
        .write.partitionBy("p").parquet(path)
    source = spark.createDataFrame([(1, 2, 199502), (2, 2, 199503), (3, 2, None)], "k int, v int, p int")
    for _ in range(2):      # and again: nothing changes
        upsert_partitioned(path, source, "k", "p")
        got = sorted(map(tuple, spark.read.parquet(path).select("k", "v", "p").collect()))
        assert got == [(1, 2, 199502), (2, 2, 199503), (3, 2, None), (4, 1, 199505)]


def _dim(spark, rows):
    return spark.createDataFrame(rows, "sk long, id string, attr string, effective_date date, end_date date, "
                                       "is_current boolean")


def test_scd2_null_key_is_one_key(spark):
    import datetime as dt

    from medallion_ops.operators.scd import scd2_apply, scd2_seed

    dim = scd2_seed(spark.createDataFrame([("a", "x")], "id string, attr string"), "id", ["attr"], effective="2020-01-01")
    for i, attr in enumerate(["p", "p", "q"]):
        inc = spark.createDataFrame([(None, attr)], "id string, attr string")
        dim = scd2_apply(dim, inc, "id", ["attr"], dt.date(2021 + i, 1, 1))
    got = [r for r in dim.collect() if r.id is None]
    assert sorted((r.attr, r.is_current) for r in got) == [("p", False), ("q", True)]


def test_scd2_keeps_rows_whose_flag_is_null(spark):
    import datetime as dt

    from medallion_ops.operators.scd import scd2_apply

    old = _dim(spark, [(1, "a", "x", dt.date(2019, 1, 1), dt.date(2020, 1, 1), None),
                       (2, "a", "y", dt.date(2020, 1, 1), dt.date(9999, 12, 31), True)])
    out = scd2_apply(old, spark.createDataFrame([("a", "z")], "id string, attr string"), "id", ["attr"], "2021-01-01")
    assert sorted((r.sk, r.attr, r.is_current) for r in out.collect()) == [(1, "x", None), (2, "y", False), (3, "z", True)]


def test_scd2_same_day_corrects_in_place_and_earlier_day_raises(spark):
    import datetime as dt

    import pytest

    from medallion_ops.operators.scd import scd2_apply

    old = _dim(spark, [(1, "a", "x", dt.date(2020, 1, 1), dt.date(9999, 12, 31), True)])
    inc = spark.createDataFrame([("a", "z")], "id string, attr string")
    same = scd2_apply(old, inc, "id", ["attr"], "2020-01-01").collect()
    assert [(r.sk, r.attr, r.effective_date, r.is_current) for r in same] == [(1, "z", dt.date(2020, 1, 1), True)]
    with pytest.raises(ValueError, match="before the versions"):
        scd2_apply(old, inc, "id", ["attr"], "2019-06-01")
