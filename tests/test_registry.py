"""Surrogate keys over several loads: nothing is issued twice, nothing issued is lost."""

from hypothesis import given, settings
from hypothesis import strategies as st

from medallion_ops.operators.keys import dense_surrogate_key, extend_surrogate_keys
from medallion_ops.operators.registry import KeyRegistry, keyed_dimension
from medallion_ops.session import materialize, scratch_path


def _rows(df):
    return {tuple(r)[1:]: r[0] for r in df.collect()}


def test_a_number_is_not_issued_again_after_its_key_went(spark):
    registry = KeyRegistry(spark, scratch_path(spark, "registry"), "k", "sk")
    load = lambda *ks: spark.createDataFrame([(k, f"v{k}") for k in ks], "k string, v string")
    one = materialize(keyed_dimension(registry, load("A", "B")))
    assert _rows(one) == {("A", "vA"): 1, ("B", "vB"): 2}
    two = materialize(keyed_dimension(registry, load("A"), one))
    assert _rows(two) == {("A", "vA"): 1, ("B", "vB"): 2}                  # issued rows stay
    three = materialize(keyed_dimension(registry, load("A", "C"), two))
    assert _rows(three) == {("A", "vA"): 1, ("B", "vB"): 2, ("C", "vC"): 3}
    alone = keyed_dimension(registry, load("B", "D"))                      # even without the earlier state
    assert _rows(alone) == {("B", "vB"): 2, ("D", "vD"): 4} and registry.high_water() == 4


def test_null_keys_are_one_value_and_keep_their_number(spark):
    registry = KeyRegistry(spark, scratch_path(spark, "registry"), ["a", "b"], "sk")
    for pairs in ([(None, 1), (None, None), ("x", None)], [("x", None), (None, None)], [(None, None), (None, 1), ("y", 2)]):
        out = _rows(registry.register(spark.createDataFrame(pairs, "a string, b int")).select("sk", "a", "b"))
    assert out == {(None, None): 1, (None, 1): 2, ("x", None): 3, ("y", 2): 4}


def test_extend_is_null_safe(spark):
    existing = spark.createDataFrame([(1, None), (2, "B")], "sk bigint, k string")
    got = _rows(extend_surrogate_keys(existing, spark.createDataFrame([(None,), ("B",), ("C",)], "k string"), "k"))
    assert got == {(None,): 1, ("B",): 2, ("C",): 3}


def test_a_failed_load_loses_numbers_but_repeats_none(spark, monkeypatch):
    registry = KeyRegistry(spark, scratch_path(spark, "registry"), "k")
    registry.register(spark.createDataFrame([("a",)], "k string"))
    from medallion_ops.operators import registry as module

    def broken(*_, **__):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(module, "dense_surrogate_key", broken)
        try:
            registry.register(spark.createDataFrame([("b",), ("c",)], "k string"))
        except RuntimeError:
            pass
    got = _rows(registry.register(spark.createDataFrame([("b",), ("d",)], "k string")).select("sk", "k"))
    assert got == {("a",): 1, ("b",): 4, ("d",): 5}


def test_empty_loads(spark):
    registry = KeyRegistry(spark, scratch_path(spark, "registry"), "k")
    none = spark.createDataFrame([], "k string")
    assert registry.high_water() == 0 and registry.register(none).count() == 0
    assert registry.register(spark.createDataFrame([("z",)], "k string")).count() == 1
    assert registry.register(none).count() == 1 and registry.high_water() == 1


@settings(max_examples=4, deadline=None)
@given(st.lists(st.sets(st.one_of(st.none(), st.integers(0, 12)), max_size=8), min_size=1, max_size=4))
def test_numbers_are_those_of_a_dictionary(spark, loads):
    registry, known = KeyRegistry(spark, scratch_path(spark, "registry"), "k"), {}
    for keys in loads:
        for k in sorted(keys - set(known), key=lambda k: (k is not None, k)):
            known[k] = len(known) + 1
        got = _rows(registry.register(spark.createDataFrame([(k,) for k in keys], "k int")).select("sk", "k"))
    assert got == {(k,): n for k, n in known.items()}


def test_equal_keys_spread_over_partitions(spark):
    df = spark.range(0, 4000, 1, 4).selectExpr("cast(1 as int) as k", "id")
    out = dense_surrogate_key(df, ["k"], partitions=8)
    assert sorted(r.sk for r in out.collect()) == list(range(1, 4001))
    assert len(set(out.selectExpr("spark_partition_id() as p").distinct().collect())) >= 1
