"""Approximate nearest neighbours: inverted lists with an adaptive dimension scan.

Largest inner product becomes smallest Euclidean distance by one more
component, sqrt(M^2 - |x|^2) for rows (M: the largest norm) and 0 for
queries. A random rotation makes the first t of D rotated components a fair
sample of the distance, so that after each column block a hypothesis test
can abandon a candidate: if partial * D / t > (1 + epsilon / sqrt(t))^2 r^2,
it is further than the k-th best so far (distance r) with high probability.
Survivors of the last block are scored exactly, in double precision, on the
original vectors.

Index: centroids by k-means on a bounded sample (``sample_rows``, chosen by
hash), as many lists as the square root of the row count, but no more than an
eighth of the sample; every row is indexed. How many lists a query probes is fitted as well: the share
of lists that finds ``fit_recall`` of the true neighbours of sample rows
among the sample, which is harder than among all rows. Each query scans its
nearest list first; the k-th score found there is r for the others.

Scale: equal vectors are searched once, as a query and as a candidate (of a
candidate vector's copies the k + 1 smallest ids suffice, exactly, for any
query), so a vector that a third of all rows share costs no more than
another. A list is cut into blocks of ``block_rows`` rows and the queries that
probe it into parts of ``block_queries``; a task holds one pair of them, and
rows are copied to the parts of their own list only. Per block
and query k + 1 rows leave a task. The driver sees the sample only.

Defined cases: vectors that are null, zero, of another length than most, or
that hold null or non-finite components take no part, nor rows without id;
rows that repeat id and vector count once; rows with the query's id are the
query's own; ties go to the smaller id; fewer candidates than k give all of
them; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion_ops.llm.common import col
from medallion_ops.session import materialize, materialize_counted

COLUMN_BLOCKS = (16, 16, 16)       # widths of the tested column blocks; the rest of the columns is the last block
EPSILON = 2.1                      # of the test; larger abandons less
FOUND = "rep bigint, vec_id bigint, score double"


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and vec (array<double>) of the rows that take part, repeated rows once."""
    vec = col(vec_col).cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    named = rows.select(col(id_col).cast("bigint").alias("vec_id"), vec.alias("vec"))
    named = named.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", fine)
                        & F.exists("vec", lambda x: x != 0))
    # 0.0 and -0.0 are equal as numbers
    return named.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0))).distinct()


def kmeans(x: np.ndarray, lists: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), lists, replace=False)].copy()
    for _ in range(rounds):
        near = nearest_lists(x, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=lists)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
        centres[~full] = x[rng.choice(len(x), int((~full).sum()))]
    return centres


def nearest_lists(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centroids of each row, nearest first."""
    out, half = [], 0.5 * (centres ** 2).sum(axis=1)
    for at in range(0, len(x), 4096):
        far = half - x[at:at + 4096] @ centres.T
        if n == 1:
            out.append(np.argmin(far, axis=1)[:, None])
        else:
            out.append(np.argsort(far, axis=1, kind="stable")[:, :n])
    return np.concatenate(out) if out else np.empty((0, n), np.int64)


def augmented(x: np.ndarray, most: float, query: bool) -> np.ndarray:
    extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(most - (x ** 2).sum(axis=1), 0.0))
    return np.concatenate([x, extra[:, None]], axis=1)


def probes_needed(x: np.ndarray, most: float, centres: np.ndarray, k: int, recall: float, seed: int,
                  queries: int = 256) -> int:
    """Lists to probe so that ``recall`` of the k nearest sample rows of sample queries are met."""
    rng = np.random.default_rng(seed)
    pick = rng.choice(len(x), min(queries, len(x)), replace=False)
    home = nearest_lists(augmented(x, most, False), centres, 1)[:, 0]
    order = nearest_lists(augmented(x[pick], most, True), centres, len(centres))
    place = np.argsort(order, axis=1)                       # place[q, list]: how early q probes the list
    score = x[pick] @ x.T
    score[np.arange(len(pick)), pick] = -np.inf
    k = min(k, len(x) - 1)
    if k < 1:
        return len(centres)
    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
    needed = np.sort(place[np.arange(len(pick))[:, None], home[best]].ravel())
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) + 1


def adaptive_scan(rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, bound: np.ndarray, rotation: np.ndarray,
                  most: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of up to ``k`` rows per query; ``bound``: a score that k rows are known to reach.

    Rows and queries are original vectors; the partial distances use their
    augmented and rotated forms in column blocks.
    """
    z = (augmented(rows, most, False) @ rotation).astype(np.float32)
    q = (augmented(queries, most, True) @ rotation).astype(np.float32)
    dim = z.shape[1]
    edges = [0]
    for w in COLUMN_BLOCKS:
        if edges[-1] + w < dim:
            edges.append(edges[-1] + w)
    edges.append(dim)
    sq = (queries ** 2).sum(axis=1)
    radius = np.maximum(sq + most - 2 * bound, 0.0)        # squared distance of the bound; inf where there is none
    b = edges[1]
    part = np.maximum((q[:, :b] ** 2).sum(axis=1)[:, None] + (z[:, :b] ** 2).sum(axis=1)[None, :]
                      - 2 * (q[:, :b] @ z[:, :b].T), 0)
    n = len(rows)
    if n > k:                                              # k full distances bound the k-th best within the block
        seeds = np.argpartition(part, k - 1, axis=1)[:, :k]
        exact = np.einsum("qkd,qd->qk", rows[seeds], queries)
        radius = np.minimum(radius, np.maximum(sq + most - 2 * exact.min(axis=1), 0.0))
        keep = part * (dim / b) <= ((1 + EPSILON / math.sqrt(b)) ** 2 * radius)[:, None]
        np.put_along_axis(keep, seeds, True, axis=1)
        seeded = np.zeros_like(keep)
        np.put_along_axis(seeded, seeds, True, axis=1)
    else:
        keep = np.ones(part.shape, bool)
        seeded = keep
    qi, zi = np.nonzero(keep)
    far, sure = part[qi, zi].astype(np.float64), seeded[qi, zi]
    for lo, hi in zip(edges[1:-1], edges[2:]):
        far = far + ((z[zi, lo:hi] - q[qi, lo:hi]) ** 2).sum(axis=1)
        slack = (1 + EPSILON / math.sqrt(hi)) ** 2 if hi < dim else 1 + 1e-4
        stay = sure | (far * (dim / hi) <= slack * radius[qi] + (1e-6 if hi == dim else 0))
        qi, zi, far, sure = qi[stay], zi[stay], far[stay], sure[stay]
    score = (rows[zi] * queries[qi]).sum(axis=1)
    order = np.lexsort((ids[zi], -score, qi))
    qi, zi, score = qi[order], zi[order], score[order]
    first = np.searchsorted(qi, qi, side="left")
    top = np.arange(len(qi)) - first < k
    return qi[top], ids[zi[top]], score[top]


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _assign(model, dim: int, query: bool, probes: int):
    """Adds the nearest list (rows) or the array of lists to probe (queries), nearest first."""
    def run(batches):
        centres, most = model.value[0], model.value[1]
        for batch in batches:
            names = batch.schema.names
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = augmented(_matrix(part.column("vec"), dim), most, query)
                near = nearest_lists(x, centres, probes).astype(np.int32)
                if query:
                    lists = pa.ListArray.from_arrays(np.arange(0, near.size + 1, probes, dtype=np.int32), near.ravel())
                else:
                    lists = pa.array(near[:, 0])
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*names, "list"])
    return run


def _scan_group(model, dim: int, k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        _, most, rotation = model.value
        if not rows.num_rows or not queries.num_rows:
            qi, ids, score, reps = [np.empty(0, np.int64)] * 2 + [np.empty(0)] + [np.empty(0, np.int64)]
        else:
            qi, ids, score = adaptive_scan(
                _matrix(rows.column("vec"), dim), rows.column("vec_id").to_numpy(), _matrix(queries.column("vec"), dim),
                queries.column("bound").fill_null(-math.inf).to_numpy(), rotation, most, k)
            reps = queries.column("rep").to_numpy()[qi]
        return pa.table({"rep": pa.array(reps, pa.int64()), "vec_id": pa.array(ids, pa.int64()),
                         "score": pa.array(score, pa.float64())})
    return run


def _probe(queries: DataFrame, rows: DataFrame, sizes: DataFrame, block_queries: int, model, dim: int, k: int) -> DataFrame:
    """Scans each (query, list) pair: ``queries`` has rep, vec, bound and list; ``rows`` vec_id, vec, list and block.

    The queries of a list are cut into parts of about ``block_queries``; a row
    meets the parts of its own list only, and none where no query probes it.
    """
    parts = queries.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("parts"))
    parts = materialize(parts, "ann_parts")                            # a row per list
    blocked = queries.join(sizes, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocked = blocked.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    spread = rows.join(parts, "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keys = ["list", "block", "part"]
    return (spread.select(*keys, "vec_id", "vec").groupBy(*keys)
            .cogroup(blocked.select(*keys, "rep", "vec", "bound").groupBy(*keys))
            .applyInArrow(_scan_group(model, dim, k), FOUND))


def search(rows: DataFrame, k: int = 20, queries=None, id_col: str = "vec_id", vec_col: str = "embedding",
           sample_rows: int = 32_768, fit_recall: float = 0.98, block_rows: int = 4096, block_queries: int = 4096,
           seed: int = 7) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (inner product) of each query's ``k`` nearest rows found.

    ``queries``: condition on ``vec_id`` that picks the query rows
    (default: divisible by 20).
    """
    spark = rows.sparkSession
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    pick = F.col("vec_id") % 20 == 0 if queries is None else queries
    valid, count = materialize_counted(valid_vectors(rows, id_col, vec_col), "ann_rows")
    dims = (valid.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect())
    if not dims:
        return spark.createDataFrame([], empty)
    dim = dims[0]["d"]
    valid = valid.where(F.size("vec") == dim).withColumn("h", F.xxhash64("vec"))

    # copies: of equal vectors the k + 1 smallest ids can come into a result
    nth = F.row_number().over(Window.partitionBy("h", "vec").orderBy("vec_id"))
    rows_of = valid.withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth")
    rows_of = materialize(rows_of, "ann_distinct")
    asked = valid.where(pick)
    reps = asked.groupBy("h", "vec").agg(F.min("vec_id").alias("rep"))
    reps, n_queries = materialize_counted(reps, "ann_queries")
    if not n_queries:
        return spark.createDataFrame([], empty)
    mine = asked.select(F.col("vec_id").alias("query_id"), "h", "vec").join(reps, ["h", "vec"]).select("query_id", "rep")

    # fit on a bounded sample, chosen by hash so that reruns agree
    share = min(1.0, 0.9 * sample_rows / count)
    chosen = rows_of.where(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    chosen = chosen.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample_rows)
    picked = sorted((r["vec_id"], r["vec"]) for r in chosen.collect())
    x = np.array([v for _, v in picked], np.float64).reshape(-1, dim)
    top = rows_of.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v)).alias("m")).collect()[0]["m"]
    most = float(top) * (1 + 1e-12)
    lists = max(1, min(math.ceil(math.sqrt(count)), len(x) // 8))
    if len(x) == 0:
        x = np.array([rows_of.limit(1).collect()[0]["vec"]], np.float64)
    centres = kmeans(augmented(x, most, False), lists, 6, seed)
    probes = probes_needed(x, most, centres, k, fit_recall, seed)
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim + 1, dim + 1)))[0]
    model = spark.sparkContext.broadcast((centres, most, rotation))     # sizes bounded by sample and dimension

    homed = materialize(rows_of.select("vec_id", "vec").mapInArrow(
        _assign(model, dim, False, 1), "vec_id bigint, vec array<double>, list int"), "ann_lists")
    sizes = homed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).select(
        "list", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    sizes = materialize(sizes, "ann_sizes")                             # a row per list
    homed = homed.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    aimed = materialize(reps.select("rep", "vec").mapInArrow(
        _assign(model, dim, True, probes), "rep bigint, vec array<double>, list array<int>"), "ann_probes")

    first = aimed.select("rep", "vec", F.lit(None).cast("double").alias("bound"), F.element_at("list", 1).alias("list"))
    near = materialize(_probe(first, homed, sizes, block_queries, model, dim, k + 1), "ann_near")
    best = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    kth = near.withColumn("r", F.row_number().over(best)).where(F.col("r") == k + 1).select("rep", F.col("score").alias("bound"))
    others = aimed.withColumn("list", F.explode(F.slice("list", 2, max(probes - 1, 1)))).join(kth, "rep", "left")
    far = _probe(others.select("rep", "vec", "bound", "list"), homed, sizes, block_queries, model, dim, k + 1)
    found = near.unionByName(far)
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")

    out = mine.join(found, "rep").where(F.col("query_id") != F.col("vec_id"))
    out = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
