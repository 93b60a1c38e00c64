"""Session settings and lineage cutting.

The session is pinned to UTC with ANSI casts (bad values raise: fail loud)
and adaptive execution (coalescing, skew-join splitting). On a cluster the
shared checkpoint folder comes from ``spark.checkpoint.dir``; a folder of
our own is only created when that setting is absent and the master is
local (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1 << 20


def scale_conf(input_bytes: int, cores: int) -> dict:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of Parquet.

    About 1 GiB of input per initial shuffle partition (AQE then coalesces
    small ones towards the 256 MiB advisory size and splits skewed ones over
    512 MiB), never fewer than 2 tasks per core; scan splits of 256 MiB. For
    100 TB on 8,000 cores: about 95,000 shuffle partitions and 400,000 scan
    tasks.
    """
    shuffle = max(2 * cores, -(-input_bytes // (1024 * MB)))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "medallion_ops", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only a local master
    without that setting gets a private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if sc.master != "local" and not sc.master.startswith("local["):     # local-cluster is a cluster
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="medallion-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet to a fresh path in the shared folder and scan it back.

    Cuts lineage where a frame is read by several jobs (sampling, counting,
    lookups, the final pass): each job reads the stored rows instead of
    recomputing shuffles, every job sees the same rows even if the input is
    nondeterministic, and a lost executor costs a re-read, not a recompute.
    Unlike an RDD checkpoint, the Parquet copy keeps column pruning, filter
    pushdown and file-size statistics for the join planner.
    """
    return materialize_counted(df, name)[0]


def materialize_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``materialize`` for several independent frames at once, so that small jobs do not wait for one another."""
    with ThreadPoolExecutor(max(1, len(frames))) as pool:
        stored = {name: pool.submit(materialize, df, name) for name, df in frames.items()}
        return {name: f.result() for name, f in stored.items()}


def materialize_counted(df: DataFrame, name: str = "stage") -> tuple[DataFrame, int]:
    """``materialize`` that also returns the row count, observed during the write."""
    out, metrics = materialize_observed(df, name)
    return out, int(metrics["n"])


def materialize_observed(df: DataFrame, name: str = "stage", **metrics) -> tuple[DataFrame, dict]:
    """``materialize`` plus aggregate metrics computed by the writing job itself.

    ``metrics`` are named aggregate Columns (``n`` = row count is always
    added); no extra pass over the data is made.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"obs_{name}_{uuid.uuid4().hex[:8]}")
    aggs = [F.count(F.lit(1)).alias("n")] + [c.alias(k) for k, c in metrics.items()]
    df.observe(obs, *aggs).write.mode("overwrite").parquet(path)
    # the schema is the one just written: passing it skips an inference job
    return spark.read.schema(df.schema).parquet(path), dict(obs.get)


