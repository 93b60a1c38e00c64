"""Hard negatives from Hilbert-ordered blocks with zone maps.

Vectors become integers, ``floor(scale x)``, so that inner products are exact.
Candidates are ordered by label and by their place on a Hilbert curve through
the components that vary most, and stored as Parquet blocks of ``block_rows``
neighbours: a row per block with its ids and vectors and, as its zone map, the
least and largest value of every component.

For an anchor a and a block's intervals [lo, hi], interval arithmetic bounds
the inner products of all its rows:

    sum(min(a lo, a hi)) <= a . x <= sum(max(a lo, a hi))

An anchor's positives are searched in the blocks of its label whose upper
bound reaches what the lower bounds already guarantee; its negatives in the
blocks of other labels whose bounds meet one of its windows
``[low% of a positive's score, high% of it]``, without those that must lose
against blocks which lie wholly inside a window. Zone maps are read without
the vectors; only chosen blocks meet the anchors that chose them.

Scale: blocks and parts of ``anchor_rows`` anchors are single rows of bounded
size, and a task scans one pair of them at a time; equal vectors of a label are
searched once as anchors, and as candidates only their smallest ids (as many as
one result can hold) are kept, which is exact. Per block and window at most
``negatives`` rows leave a task. The driver sees a row per component.

Defined cases: rows with a null id, label or vector, with null or non-finite
components, of another length than most, or with components so large that a
score could pass 55 bits take no part; of rows that share an id the one with
the smallest label and vector stands; ties go to the smaller id; a positive
without a negative gives no row; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion_ops.llm.common import col, running_total
from medallion_ops.session import materialize, materialize_counted

CURVE_DIMS, CURVE_BITS = 8, 7                # components and bits of each that place a row on the curve
SCORE_BITS = 55
ZONES = 1024                                 # zone maps that meet a part of the anchors at once
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def integer_vectors(rows: DataFrame, scale: int, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """vec_id, label and vec (array<bigint>) of the rows that can take part, one per id."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    named = rows.select(col(id_col).cast("bigint").alias("vec_id"), col(label_col).cast("bigint").alias("label"),
                        col(vec_col).cast("array<double>").alias("vec"))
    named = named.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
                        & F.forall("vec", fine))
    named = named.withColumn("vec", F.transform("vec", lambda x: x * F.lit(float(scale))))
    most = F.sqrt(F.lit(2.0 ** SCORE_BITS) / F.greatest(F.size("vec"), F.lit(1))) - 1
    named = named.where(F.forall("vec", lambda x: F.abs(x) < most))
    named = named.withColumn("vec", F.transform("vec", lambda x: F.floor(x).cast("bigint")))
    return named.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("one")).select("vec_id", "one.label", "one.vec")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (rows x dimensions, below 2^bits)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:                                        # undo the turns of the larger cubes
        p = q - 1
        for i in range(n):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(turned, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):                               # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) > 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _spread(dim: int):
    """Per batch and component: rows, sum, sum of squares, least and largest value."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("vec"), dim)
                f = x.astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(dim)), pa.array(np.full(dim, len(x))), pa.array(f.sum(axis=0)),
                     pa.array((f * f).sum(axis=0)), pa.array(x.min(axis=0)), pa.array(x.max(axis=0))],
                    names=["d", "n", "total", "squares", "lo", "hi"])
    return run


def _place(dim: int, dims: list[int], lo: list[int], hi: list[int]):
    def run(batches):
        low, width = np.array(lo, np.float64), np.maximum(np.array(hi, np.float64) - np.array(lo, np.float64), 1)
        for batch in batches:
            x = _matrix(batch.column("vec"), dim)[:, dims]
            cells = np.minimum((x - low) / width * (1 << CURVE_BITS), (1 << CURVE_BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_index(cells, CURVE_BITS))],
                                             names=[*batch.schema.names, "curve"])
    return run


def _pack_block(dim: int, kind: str):
    """The rows of a block as one row, in the order of their ids, with its zone map."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id")
        x = _matrix(rows.column("vec"), dim)
        return pa.table({"label": rows.column("label").slice(0, 1), "block": rows.column("block").slice(0, 1),
                         "lo": pa.array([x.min(axis=0)], pa.list_(pa.int64())), "hi": pa.array([x.max(axis=0)], pa.list_(pa.int64())),
                         "ids": pa.array([rows.column("vec_id").to_numpy()], pa.list_(pa.int64())),
                         "vectors": pa.array([x.astype(kind).tobytes()], pa.binary())})
    return run


BLOCK = "label bigint, block bigint, lo array<bigint>, hi array<bigint>, ids array<bigint>, vectors binary"


def _pack_anchors(dim: int, kind: str):
    """A part of the anchors as one row; ``scores`` holds each one's positive scores (none before they are known)."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rep")
        x = _matrix(rows.column("vec"), dim)
        one = lambda values: pa.array([values], pa.list_(pa.int64()))
        return pa.table({"part": rows.column("part").slice(0, 1), "reps": one(rows.column("rep").to_numpy()),
                         "labels": one(rows.column("label").to_numpy()), "anchors": pa.array([x.astype(kind).tobytes()], pa.binary()),
                         "scores": pa.array([rows.column("scores").to_pylist()], pa.list_(pa.list_(pa.int64())))})
    return run


ANCHORS = "part int, reps array<bigint>, labels array<bigint>, anchors binary, scores array<array<bigint>>"


def product(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as integers; ``exact``: double precision holds every partial sum."""
    if exact:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) possible inner product of each anchor with a row of each block, by interval arithmetic."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return product(up, lo, exact) + product(down, hi, exact), product(up, hi, exact) + product(down, lo, exact)


def guaranteed(least: np.ndarray, rows: np.ndarray, k: int) -> int | None:
    """The largest value that ``k`` rows reach for sure, given blocks' lower bounds and sizes."""
    order = np.argsort(-least)
    enough = np.flatnonzero(np.cumsum(rows[order]) >= k)
    return int(least[order[enough[0]]]) if len(enough) else None


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Integers n with low * score <= 100 n <= high * score."""
    return -(-low * score // 100), high * score // 100


def _choose(dim: int, kind: str, exact: bool, positives: int, negatives: int, low: int, high: int):
    """label, block, part and the anchors (by place in their part) that must read the block."""
    def run(zones: pa.Table, anchors: pa.Table) -> pa.Table:
        out: dict[str, list] = {"label": [], "block": [], "part": [], "chosen": []}
        if zones.num_rows and anchors.num_rows:
            x = np.frombuffer(anchors.column("anchors")[0].as_py(), kind).reshape(-1, dim)
            own = np.array(anchors.column("labels")[0].as_py())
            scores = anchors.column("scores")[0].as_py()
            label, rows = zones.column("label").to_numpy(), zones.column("rows").to_numpy()
            least, most = bounds(x, _matrix(zones.column("lo"), dim), _matrix(zones.column("hi"), dim), exact)
            need = np.zeros(least.shape, bool)
            for i in range(len(x)):
                same = label == own[i]
                if scores[i] is None:                                   # looking for positives
                    sure = guaranteed(least[i][same], rows[same], positives)
                    need[i] = same & (most[i] >= sure if sure is not None else True)
                    continue
                for score in scores[i]:
                    lo, hi = window(score, low, high)
                    meets = ~same & (most[i] >= lo) & (least[i] <= hi)
                    inside = ~same & (least[i] >= lo) & (most[i] <= hi)
                    sure = guaranteed(least[i][inside], rows[inside], negatives)
                    need[i] |= meets & (most[i] >= sure if sure is not None else True)
            part = anchors.column("part")[0].as_py()
            for j in np.flatnonzero(need.any(axis=0)):
                out["label"].append(int(label[j]))
                out["block"].append(zones.column("block")[int(j)].as_py())
                out["part"].append(part)
                out["chosen"].append(np.flatnonzero(need[:, j]).tolist())
        return pa.table(out, pa.schema([("label", pa.int64()), ("block", pa.int64()), ("part", pa.int32()),
                                        ("chosen", pa.list_(pa.int32()))]))
    return run


def _scan(dim: int, kind: str, exact: bool, positives: int, negatives: int, low: int, high: int):
    """rep, positive score (null while looking for positives), vec_id and score of the best rows of one block."""
    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        rep, of, ids, score = [], [], [], []
        if block.num_rows and asked.num_rows:
            names = np.array(block.column("ids")[0].as_py(), np.int64)
            x = np.frombuffer(block.column("vectors")[0].as_py(), kind).reshape(-1, dim)
            chosen = np.array(asked.column("chosen")[0].as_py(), np.int64)
            a = np.frombuffer(asked.column("anchors")[0].as_py(), kind).reshape(-1, dim)[chosen]
            reps = np.array(asked.column("reps")[0].as_py(), np.int64)[chosen]
            scores = asked.column("scores")[0].as_py()
            values = product(a, x, exact)
            order = np.argsort(-values, axis=1, kind="stable")             # rows are in the order of their ids
            for i, place in enumerate(chosen.tolist()):
                if scores[place] is None:
                    spans = [(None, order[i, :positives])]
                else:
                    falling = -values[i, order[i]]
                    spans = []
                    for s in scores[place]:
                        lo, hi = window(s, low, high)
                        b, e = np.searchsorted(falling, -hi, "left"), np.searchsorted(falling, -lo, "right")
                        spans.append((s, order[i, b:min(e, b + negatives)]))
                for s, at in spans:
                    rep += [int(reps[i])] * len(at)
                    of += [s] * len(at)
                    ids += names[at].tolist()
                    score += values[i, at].tolist()
        return pa.table({"rep": pa.array(rep, pa.int64()), "positive_score": pa.array(of, pa.int64()),
                         "vec_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.int64())})
    return run


def mine_negatives(rows: DataFrame, anchors: Column | None = None, positives: int = 5, negatives: int = 10, low: int = 30,
                   high: int = 90, scale: int = 256, id_col: str = "vec_id", label_col: str = "label",
                   vec_col: str = "embedding", block_rows: int = 2048, anchor_rows: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    ``anchors``: condition on ``vec_id`` and ``label`` that picks the anchors
    (default: ids divisible by 100). Negatives of a positive with score p are
    the best ``negatives`` rows of other labels that score from ``low`` to
    ``high`` percent of p.
    """
    spark = rows.sparkSession
    pick = F.col("vec_id") % 100 == 0 if anchors is None else anchors
    valid = materialize(integer_vectors(rows, scale, id_col, label_col, vec_col), "negatives_rows")
    dims = valid.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dims or not dims[0]["d"]:
        return spark.createDataFrame([], RESULT)
    dim = dims[0]["d"]
    valid = valid.where(F.size("vec") == dim)
    spread = valid.select("vec").mapInArrow(_spread(dim), "d long, n long, total double, squares double, lo long, hi long")
    spread = spread.groupBy("d").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
                                     F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("d").collect()   # a row per component
    varied = sorted(spread, key=lambda r: (-(r["squares"] / r["n"] - (r["total"] / r["n"]) ** 2), r["d"]))[:CURVE_DIMS]
    largest = max(max(-r["lo"], r["hi"]) for r in spread)
    kind = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<i8"
    exact = largest ** 2 * dim < 1 << 52
    task = (dim, kind, exact, positives + 1, negatives, low, high)          # one more positive: the anchor itself

    # candidates: of a label's equal vectors no more ids can come into one result
    nth = F.row_number().over(Window.partitionBy("label", "vec").orderBy("vec_id"))
    some = valid.withColumn("nth", nth).where(F.col("nth") <= max(positives + 1, negatives)).drop("nth")
    placed = some.mapInArrow(_place(dim, [r["d"] for r in varied], [r["lo"] for r in varied], [r["hi"] for r in varied]),
                             "vec_id bigint, label bigint, vec array<bigint>, curve bigint")
    order = [F.col("label"), F.col("curve"), F.col("vec_id")]
    numbered = running_total(placed.withColumn("one", F.lit(1).cast("bigint")), order, {"place": "one"}, "negatives_curve")
    numbered = numbered.withColumn("block", F.floor((F.col("place") - 1) / block_rows).cast("bigint"))
    blocks = materialize(numbered.select("label", "block", "vec_id", "vec").groupBy("label", "block")
                         .applyInArrow(_pack_block(dim, kind), BLOCK), "negatives_blocks")
    zones = blocks.select("label", "block", "lo", "hi", F.size("ids").cast("bigint").alias("rows"))

    asked = valid.where(pick)
    reps = asked.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"))
    reps, n_reps = materialize_counted(reps, "negatives_anchors")
    if not n_reps:
        return spark.createDataFrame([], RESULT)
    members = asked.join(reps, ["label", "vec"]).select(F.col("vec_id").alias("anchor_id"), "rep")
    parts = -(-n_reps // anchor_rows)
    reps = reps.withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(parts)).cast("int"))
    zone_parts = -(-blocks.count() // ZONES)

    def search(asked: DataFrame) -> DataFrame:
        packed = materialize(asked.groupBy("part").applyInArrow(_pack_anchors(dim, kind), ANCHORS), "negatives_parts")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        dealt = zones.withColumn("zone", F.pmod(F.xxhash64("label", "block"), F.lit(zone_parts)).cast("int"))
        chosen = (dealt.withColumn("part", every(parts)).groupBy("zone", "part")
                  .cogroup(packed.withColumn("zone", every(zone_parts)).groupBy("zone", "part"))
                  .applyInArrow(_choose(*task), "label bigint, block bigint, part int, chosen array<int>"))
        chosen = materialize(chosen, "negatives_chosen")
        keys = ["label", "block", "part"]
        read = blocks.select("label", "block", "ids", "vectors").join(chosen.select(*keys), ["label", "block"])
        asking = chosen.join(packed, "part").withColumns({f"to_{k}": F.col(k) + F.lit(0) for k in keys}).drop(*keys)
        return read.groupBy(*keys).cogroup(asking.groupBy(*[f"to_{k}" for k in keys])).applyInArrow(
            _scan(*task), "rep bigint, positive_score bigint, vec_id bigint, score bigint")

    best = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    found = search(reps.withColumn("scores", F.lit(None).cast("array<bigint>")))
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= positives + 1).drop("r", "positive_score")
    mine = members.join(found, "rep").where(F.col("anchor_id") != F.col("vec_id"))
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    mine = mine.withColumn("r", F.row_number().over(first)).where(F.col("r") <= positives)
    mine = materialize(mine.select("anchor_id", "rep", F.col("vec_id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), "negatives_positives")

    wanted = mine.groupBy("rep").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))   # few per anchor
    found = search(reps.join(wanted, "rep"))
    best = Window.partitionBy("rep", "positive_score").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return mine.join(found, ["rep", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
