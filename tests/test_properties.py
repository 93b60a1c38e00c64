"""Property tests from the survey's test strategy."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from medallion_ops.operators.dedup import dedup_latest
from medallion_ops.operators.scd import scd2_apply, scd2_seed

rows = st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 9)), st.integers(0, 99)),
                max_size=40)


@settings(max_examples=12, deadline=None)
@given(rows)
def test_dedup_is_idempotent_and_unique(spark, data):
    df = spark.createDataFrame(data, "k int, t int, v int")
    once = dedup_latest(df, ["k"], [("t", "desc")], tie_break=[("v", "desc")])
    twice = dedup_latest(once, ["k"], [("t", "desc")], tie_break=[("v", "desc")])
    a = sorted(map(tuple, once.collect()))
    assert a == sorted(map(tuple, twice.collect()))
    assert len({r[0] for r in a}) == len(a) == len({r[0] for r in data})


snapshot = st.dictionaries(st.sampled_from([None, *"abcdef"]), st.one_of(st.none(), st.sampled_from("xyz")), max_size=6)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(snapshot, st.booleans()), min_size=1, max_size=3))
def test_scd2_intervals_never_overlap_and_one_open_row(spark, loads):
    """Loads on later days or (True) on the day of the load before; null keys included."""
    snaps = [s for s, _ in loads]
    schema = "id string, attr string"
    dim = scd2_seed(spark.createDataFrame(list(snaps[0].items()), schema), "id", ["attr"], effective="2020-01-01")
    day = dt.date(2020, 1, 1)
    for i, (snap, same_day) in enumerate(loads[1:], start=1):
        day = day if same_day else dt.date(2020, 1 + i, 1)
        dim = scd2_apply(dim, spark.createDataFrame(list(snap.items()), schema), "id", ["attr"], day)
    got = [r.asDict() for r in dim.collect()]
    seen = set().union(*[set(s) for s in snaps])
    assert {r["id"] for r in got} == seen
    for k in seen:
        versions = sorted((r for r in got if r["id"] == k), key=lambda r: r["effective_date"])
        assert sum(r["is_current"] for r in versions) == 1
        assert versions[-1]["is_current"] and versions[-1]["end_date"] == dt.date(9999, 12, 31)
        for a, b in zip(versions, versions[1:]):
            assert a["end_date"] == b["effective_date"] and not a["is_current"]
        assert all(v["effective_date"] < v["end_date"] for v in versions)
        # the open version carries the attribute of the last snapshot that had the key
        last = [s[k] for s in snaps if k in s][-1]
        assert versions[-1]["attr"] == last
    assert len({r["sk"] for r in got}) == len(got)
