"""medallion_ops: bronze/silver/gold table operators on Spark DataFrames.

Every public function takes and returns DataFrames built from built-in
Spark expressions; Catalyst plans the work. Only ``plans.build`` and
``sources`` touch storage.

Operators (``medallion_ops.operators``):
    dedup.dedup_latest / dedup_any / latest_per_entity   keyed dedup, latest wins
    keys.dense_surrogate_key / extend_surrogate_keys      dense keys without one-task sorts
    registry.KeyRegistry / keyed_dimension                keys issued once and for all, over loads
    merge.upsert / merge / merge_changes / upsert_partitioned   MERGE as relations, deletes included; partition-scoped rewrite
    digest.digests / changed_keys                         change detection by order-insensitive digests
    scd.scd2_seed / scd2_apply / scd2_backdate / snapshot_check / scd2_lookup   type-2 dimensions
    asof.asof_join                                        last version before a time, by one sorted merge
    distinct.distinct_state / unite / distinct_counts     exact distinct counts that add up over loads
    cohorts.add_activity / retention                      retention cohorts as a state
    quality_state.quality_state / replace_partitions / state_report   the gate over changed partitions only
    quality.table_checks / orphan_check / quality_report / enforce   one-pass checks, fail loudly
    calendar.date_bounds / date_spine / date_dimension   the date dimension
    joins.left_join_using / orphans / RowPreservingJoin / row_number_join
    windows.per_key_agg / per_key_total / *_over / ratio_to_max
Sources and sinks (``medallion_ops.sources``): tables (driver tables and
bronze adapters), files (CSV, permissive CSV, quarantine, lineage, ingest),
split_csv (multi-line CSV read by as many tasks as it has splits),
sinks (overwrite, round trip, schema conformance, catalog registration).
Plans (``medallion_ops.plans``): silver, gold, analytics, build, catalog
(the registered queries) and oracle (their DuckDB SQL).
"""

from medallion_ops.session import checkpoint_dir, get_session, materialize, scale_conf

__all__ = ["get_session", "checkpoint_dir", "materialize", "scale_conf"]
