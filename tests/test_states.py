"""States that loads add to: distinct bitmaps, cohorts, quality, backdated versions; each against a full computation."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from medallion_ops.operators.cohorts import add_activity, no_cohorts, retention
from medallion_ops.operators.distinct import dense_ids, distinct_counts, distinct_state, unite
from medallion_ops.operators.quality import table_checks
from medallion_ops.operators.quality_state import quality_state, replace_partitions, state_report
from medallion_ops.operators.registry import KeyRegistry
from medallion_ops.operators.scd import scd2_apply, scd2_backdate
from medallion_ops.session import scratch_path


def _set(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_bitmaps_count_distinct_ids_over_loads_and_groups(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("abc"), rnd.choice([None, "x", "y"]), rnd.choice([None, 0, -1, 1, 32768, 32769, -40000, 10 ** 12, rnd.randint(0, 50)]))
            for _ in range(400)]
    loads = [spark.createDataFrame(x, "g string, h string, id long") for x in (rows[:250], rows[150:])]
    state = unite([distinct_state(x, "id", ["g", "h"]) for x in loads], ["g", "h"])
    every = spark.createDataFrame(rows, "g string, h string, id long")
    for by in (["g", "h"], ["h"], []):
        want = every.filter("id is not null").groupBy(*by).agg(F.countDistinct("id").alias("n_distinct"))
        assert _set(distinct_counts(state, by)) == _set(want)
    assert distinct_counts(distinct_state(every.limit(0), "id")).collect()[0][0] == 0


def test_strings_are_counted_by_registered_numbers(spark):
    registry = KeyRegistry(spark, scratch_path(spark, "ids"), "word")
    loads = [spark.createDataFrame([(w,) for w in ws], "word string") for ws in (["a", "b", None, "a"], ["b", "c", None])]
    states = [distinct_state(dense_ids(x, registry), "sk") for x in loads]
    assert distinct_counts(unite(states)).collect()[0][0] == 4           # a registered null is a value


def _retention(pairs):
    first, sizes = {}, {}
    for p, m in pairs:
        first[p] = min(first.get(p, m), m)
    for p, m in set(pairs):
        sizes[first[p], m - first[p]] = sizes.get((first[p], m - first[p]), 0) + 1
    peak = {}
    for (c, _), n in sizes.items():
        peak[c] = max(peak.get(c, 0), n)
    return sorted((f"{(c - 1) // 12:04d}-{(c - 1) % 12 + 1:02d}", o, n, round(100 * n / peak[c], 5)) for (c, o), n in sizes.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_cohorts_of_any_order_of_loads(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randint(1, 25), 12 * 2000 + rnd.randint(1, 30)) for _ in range(160)]
    loads = [rnd.choices(pairs, k=60), pairs, [], pairs[:5]]
    rnd.shuffle(loads)
    state = no_cohorts(spark)
    for load in loads:
        state = add_activity(state, spark.createDataFrame([*load, (None, 1), (1, None)], "person long, month int"))
    got = [(r.cohort_month, r.month_offset, r.active_customers, round(r.retention_rate, 5)) for r in retention(state).collect()]
    assert got == _retention(pairs) and state.activity.count() == len(set(pairs))


def test_quality_state_gives_the_full_report(spark):
    rows = [(1, "a", 10), (1, "a", 11), (2, None, 10), (2, "b", 12), (None, None, 12), (None, None, 12), (3, "c", None)]
    schema = "k int, v string, month int"
    full = spark.createDataFrame(rows, schema)
    old = spark.createDataFrame([(9, "old", 10), (9, "old", 10), (1, "a", 11), (7, "left", 13)], schema)
    state = quality_state(old, F.col("month"), ["k", "v"], ["k", "v"])
    written = full.filter("month is null or month in (10, 12)")
    state = replace_partitions(state, quality_state(written, F.col("month"), ["k", "v"], ["k", "v"]),
                               emptied=spark.createDataFrame([(13,)], "part int"))
    assert _set(state_report("t", state, ["k", "v"], ["k", "v"])) == _set(table_checks("t", full, ["k", "v"], ["k", "v"]))
    none = quality_state(full.limit(0), F.col("month"), "k")
    assert _set(state_report("t", none, "k")) == _set(table_checks("t", full.limit(0), "k"))


DAY = dt.date(2020, 1, 1)
DIM = "sk bigint, k string, a string, b int, effective_date date, end_date date, is_current boolean"
OPEN = dt.date(9999, 12, 31)


def _timeline(statements):
    """Versions (day, a, b, sk) of one key from its first versions (with sk) and late statements (without)."""
    by_day = {}
    for day, a, b, sk in statements:
        was = by_day.get(day)
        if was is None or sk is not None:
            by_day[day] = (a, b, sk) if was is None else (was[0], was[1], sk)
        else:
            late = max((was[0], was[1]), (a, b), key=lambda x: (x[0] is not None, x)) if was[2] is None else (a, b)
            by_day[day] = (*late, was[2])
    out, held = [], None
    for day in sorted(by_day):
        a, b, sk = by_day[day]
        if sk is not None or held is None or (a, b) != held:
            out.append((day, a, b, sk))
        held = (a, b)
    return out


def test_backdated_rows_leave_no_gap_and_no_overlap(spark):
    rnd = random.Random(8)
    day = lambda n: DAY + dt.timedelta(days=n)
    dim, late, want, sk = [], [], {}, 0
    for k in [None, *"abcdefghij"]:
        days = sorted(rnd.sample(range(0, 60), rnd.randint(1, 4)))
        told = []
        for i, d in enumerate(days):
            sk += 1
            a, b = rnd.choice("xy"), rnd.choice([None, 1])
            dim.append((sk, k, a, b, day(d), day(days[i + 1]) if i + 1 < len(days) else OPEN, i + 1 == len(days)))
            told.append((day(d), a, b, sk))
        mine = [(day(d), rnd.choice("xyz"), rnd.choice([None, 1]), None) for d in rnd.sample(range(-5, 65), rnd.randint(0, 4))]
        mine += [(day(days[0]), "z", 1, None)] if k in ("a", None) and all(m[0] != day(days[0]) for m in mine) else []
        late += [(k, a, b, d) for d, a, b, _ in mine]
        want[k] = _timeline(told + mine)
    late.append(("new", "n", 5, day(3)))
    want["new"] = [(day(3), "n", 5, None)]
    d = spark.createDataFrame(dim, DIM)
    rows = spark.createDataFrame(late, "k string, a string, b int, effective_date date")
    got = scd2_backdate(d, rows, "k", ["a", "b"])
    by_key = {}
    for r in got.collect():
        by_key.setdefault(r.k, []).append(r)
    assert set(by_key) == set(want)
    issued, all_sk = {x[0] for x in dim}, []
    for k, versions in by_key.items():
        versions.sort(key=lambda r: r.effective_date)
        assert [(r.effective_date, r.a, r.b, r.sk if r.sk in issued else None) for r in versions] == want[k], k
        assert [r.end_date for r in versions] == [*[r.effective_date for r in versions[1:]], OPEN]
        assert [r.is_current for r in versions] == [False] * (len(versions) - 1) + [True]
        all_sk += [r.sk for r in versions]
    assert len(set(all_sk)) == len(all_sk) and max(all_sk) == len(all_sk)
    assert _set(scd2_backdate(got, rows, "k", ["a", "b"])) == _set(got)                    # a rerun changes nothing


def test_two_current_versions_are_noticed_whatever_is_stated_about_the_source(spark):
    dim = spark.createDataFrame([(1, "a", "x", 1, DAY, OPEN, True), (2, "a", "y", 1, DAY, OPEN, True)], DIM)
    incoming = spark.createDataFrame([("a", "z", 1)], "k string, a string, b int")
    with pytest.raises(ValueError, match="current versions"):
        scd2_apply(dim, incoming, "k", ["a", "b"], "2021-01-01", incoming_unique=True)
