"""Type-2 slowly changing dimensions.

Validity is the half-open interval ``[effective_date, end_date)``; the open
version has ``end_date = 9999-12-31`` and ``is_current = true``.

``scd2_apply`` classifies each incoming row against the current version by
one null-safe left join on the natural key (new / changed / corrected /
same, with a null-safe compare), then emits

    history  UNION ALL  current (expired when changed)  UNION ALL  inserts

so unchanged and new keys get exactly one current row (the two-copy MERGE
source duplicates them).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion_ops.operators.asof import asof_join
from medallion_ops.operators.dedup import latest_per_entity
from medallion_ops.operators.keys import dense_surrogate_key, match
from medallion_ops.operators.merge import assert_unique
from medallion_ops.session import materialize, materialize_observed

OPEN_END = "9999-12-31"          # fixed value: end date of the current version
VALIDITY = ["effective_date", "end_date", "is_current"]


def _date(v) -> Column:
    if isinstance(v, Column):
        return v.cast("date")
    if isinstance(v, (_dt.date, _dt.datetime)):
        v = v.isoformat()[:10]
    return F.lit(v).cast("date")


def scd2_seed(df: DataFrame, key: str, attrs, effective=None, recency=None,
              sk: str = "sk", start: int = 1, tie_break=None) -> DataFrame:
    """First load: one current version per key.

    ``recency`` picks the latest record per key (null times last);
    ``effective`` is the start of validity: a date, a date string or a
    Column (e.g. the key's first activity, so point-in-time lookups of past
    facts find it).
    """
    attrs = list(attrs)
    base = latest_per_entity(df, key, recency, tie_break) if recency else df
    eff = _date(effective if effective is not None else F.current_date())
    dim = base.select(
        key, *attrs,
        eff.alias("effective_date"),
        F.lit(OPEN_END).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
    )
    return dense_surrogate_key(dim, [key], name=sk, start=start)


def _changed(check_cols, left: str, right: str) -> Column:
    cond = F.lit(False)
    for c in check_cols:
        cond = cond | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def scd2_apply(dim: DataFrame, incoming: DataFrame, key: str, check_cols, as_of,
               sk: str = "sk", hard_deletes: str = "ignore", max_sk: int | None = None,
               incoming_unique: bool = False) -> DataFrame:
    """Expire changed current versions at ``as_of`` and insert new versions.

    ``incoming`` must be unique on ``key``: checked (raises) unless the
    caller states it holds by construction (``incoming_unique=True``, e.g. a
    ``groupBy`` on the key). Keys are compared null-safely, so a null key is
    one more key, with one current version. Keys absent from ``incoming``
    stay current (``hard_deletes="ignore"``); a version whose ``is_current``
    is null counts as history and is kept as it is.

    A change dated on the day its current version began corrects that
    version in place (same key, no zero-length interval); a change dated
    earlier raises, as it would end a version before it began
    (``scd2_backdate`` takes such rows). New versions
    get surrogate keys after ``max(sk)`` (pass ``max_sk`` when already known,
    e.g. observed while writing ``dim``). Attributes not in ``check_cols``
    are carried from the incoming row on insert and correction.
    """
    if hard_deletes != "ignore":
        raise ValueError("only hard_deletes='ignore' is supported")
    check_cols = list(check_cols)
    attrs = [c for c in dim.columns if c not in {sk, key, *VALIDITY}]
    as_of_d = _date(as_of)

    is_open = F.coalesce(F.col("is_current"), F.lit(False))
    cur, hist = dim.filter(is_open), dim.filter(~is_open)

    # one row per incoming row, tagged new / changed / fixed / late / same; stored once because
    # the inserts and the expiry keys both read it
    inc = incoming.select(key, *attrs).alias("i")
    cur_cmp = cur.select(key, *check_cols, "effective_date", F.lit(True).alias("__there")).alias("c")
    begun = F.col("c.effective_date")
    classified, seen = materialize_observed(
        inc.join(cur_cmp, F.col(f"i.{key}").eqNullSafe(F.col(f"c.{key}")), "left").select(
            "i.*",
            F.when(F.col("c.__there").isNull(), F.lit("new"))
             .when(~_changed(check_cols, "i", "c"), F.lit("same"))
             .when(begun > as_of_d, F.lit("late"))
             .when(begun == as_of_d, F.lit("fixed"))
             .otherwise(F.lit("changed")).alias("__change")),
        "scd_classified", late=F.sum((F.col("__change") == "late").cast("bigint")))
    if seen.get("late"):
        raise ValueError(f"{seen['late']} changes dated {as_of} begin before the versions they would end")
    if not incoming_unique:
        assert_unique(incoming, [key], "incoming")
    assert_unique(cur, [key], "current versions")         # two of a key would be expired and followed twice
    to_insert = classified.filter(F.col("__change").isin("new", "changed")).drop("__change")
    touched = classified.filter(F.col("__change").isin("changed", "fixed")).select(
        F.col(key).alias("__key"), *[F.col(a).alias(f"__{a}") for a in attrs], "__change")

    fixed, ended = F.col("__change") == "fixed", F.col("__change") == "changed"
    expired_or_kept = cur.join(touched, F.col(key).eqNullSafe(F.col("__key")), "left").select(
        sk, key, *[F.when(fixed, F.col(f"__{a}")).otherwise(F.col(a)).alias(a) for a in attrs],
        "effective_date",
        F.when(ended, as_of_d).otherwise(F.col("end_date")).alias("end_date"),
        F.when(ended, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
    )

    next_sk = max_sk if max_sk is not None else dim.agg(F.max(sk).alias("m")).collect()[0]["m"]
    inserts = dense_surrogate_key(
        to_insert.select(
            key, *attrs, as_of_d.alias("effective_date"),
            F.lit(OPEN_END).cast("date").alias("end_date"), F.lit(True).alias("is_current")),
        [key], name=sk, start=(next_sk or 0) + 1)

    cols = [sk, key, *attrs, *VALIDITY]
    return (hist.select(*cols)
            .unionByName(expired_or_kept.select(*cols))
            .unionByName(inserts.select(*cols)))


def scd2_backdate(dim: DataFrame, late: DataFrame, key: str, check_cols, as_of=None, sk: str = "sk",
                  max_sk: int | None = None) -> DataFrame:
    """Lets rows that arrive late fall into the history where their date puts them.

    ``late`` states a key's attributes from a day on (``as_of``, or its own
    column ``effective_date``). The versions of its keys are re-cut: every
    version ends where the next one begins, the last one is current.

    * A late row dated inside a version splits it; before the first version it
      begins the history.
    * Dated on the day a version began, it corrects that version, which keeps
      its key.
    * One that says (null-safe, in ``check_cols``) what held on that day anyway
      adds nothing.

    Versions keep their keys and begins, new ones get keys after ``max(sk)`` in
    (key, date) order. Keys are compared null-safely; of several late rows of a
    key and day the largest counts; other keys' rows pass as they are, and a
    rerun changes nothing.
    """
    check_cols = list(check_cols)
    attrs = [c for c in dim.columns if c not in {sk, key, *VALIDITY}]
    begin = _date(as_of) if as_of is not None else F.col("effective_date").cast("date")
    late = late.select(F.col(key), F.struct(*attrs).alias("__a"), begin.alias("effective_date")).filter("effective_date is not null")
    late = late.groupBy(key, "effective_date").agg(F.max("__a").alias("__late"))
    touched = late.select(key).distinct()
    old = match(dim, touched, [key], "left_semi").select(
        key, "effective_date", F.struct(*attrs).alias("__old"), F.col(sk).alias("__sk"))
    new = late.select(F.col(key).alias("__k"), F.col("effective_date").alias("__d"), "__late")
    same = F.col(key).eqNullSafe(F.col("__k")) & (F.col("effective_date") == F.col("__d"))
    events = old.join(new, same, "full_outer").select(
        F.when(F.col("__sk").isNull(), F.col("__k")).otherwise(F.col(key)).alias(key),
        F.coalesce("effective_date", "__d").alias("effective_date"), F.coalesce("__late", "__old").alias("__a"), "__sk")

    by_day = Window.partitionBy(key).orderBy("effective_date")      # a row per version of the key
    compared = F.struct(*[F.col(f"__a.{c}").alias(c) for c in check_cols])
    events = events.withColumn("__says", compared).withColumn("__before", F.lag("__says").over(by_day))
    events = events.filter(F.col("__sk").isNotNull() | F.col("__before").isNull() | ~F.col("__says").eqNullSafe(F.col("__before")))
    ends = F.lead("effective_date").over(by_day)
    cut = events.select("__sk", key, *[F.col(f"__a.{a}").alias(a) for a in attrs], "effective_date",
                        F.coalesce(ends, F.lit(OPEN_END).cast("date")).alias("end_date"), ends.isNull().alias("is_current"))
    cut = materialize(cut, "scd_recut")
    next_sk = max_sk if max_sk is not None else dim.agg(F.max(sk).alias("m")).collect()[0]["m"]
    cols = [key, *attrs, *VALIDITY]
    added = dense_surrogate_key(cut.filter(F.col("__sk").isNull()).select(*cols), [key, "effective_date"], name=sk,
                                start=(next_sk or 0) + 1)
    kept = cut.filter(F.col("__sk").isNotNull()).select(F.col("__sk").alias(sk), *cols)
    others = match(dim, touched, [key], "left_anti")
    return others.select(sk, *cols).unionByName(kept).unionByName(added)


def snapshot_check(dim: DataFrame, incoming: DataFrame, unique_key: str, check_cols, as_of,
                   sk: str = "sk", hard_deletes: str = "ignore", max_sk: int | None = None,
                   incoming_unique: bool = False) -> DataFrame:
    """Check-strategy snapshot: a new version when any ``check_cols`` value
    differs (null-safe); rows gone from the source stay current."""
    return scd2_apply(dim, incoming, unique_key, check_cols, as_of, sk, hard_deletes, max_sk, incoming_unique)


def scd2_lookup(fact: DataFrame, dim: DataFrame, key: str, sk: str = "sk",
                mode: str = "current", at: str | Column | None = None,
                fact_key: str | None = None) -> DataFrame:
    """Attach ``sk`` to every fact row (left join: no fact is lost).

    ``mode="current"``: the open version of the key. ``mode="point_in_time"``:
    the version whose ``[effective_date, end_date)`` holds ``at``, found by one
    sorted merge (``operators/asof.py``).
    """
    fk = fact_key or key
    if mode == "current":
        d = dim.filter(F.col("is_current")).select(F.col(key).alias("__nk"), sk)
        return fact.join(d, F.col(fk) == F.col("__nk"), "left").drop("__nk")
    if mode != "point_in_time" or at is None:
        raise ValueError("mode must be 'current' or 'point_in_time' with at=")
    at_c = (F.col(at) if isinstance(at, str) else at).cast("date")
    return asof_join(fact, dim, key, at_c, "effective_date", sk, end="end_date", fact_key=fk)


def current_unique_violations(dim: DataFrame, key: str) -> DataFrame:
    """Keys with more than one current version (should be empty)."""
    return (dim.filter(F.col("is_current")).groupBy(key)
              .agg(F.count(F.lit(1)).alias("current_versions"))
              .filter(F.col("current_versions") > 1))
