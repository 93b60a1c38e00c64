"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint: of all ``shingle``-word shingles (A-Z lower-cased, words split
at ASCII white space, repeats included) the XXH64 with seed 42; a bit is 1
if it is set in more than half of them. Texts of fewer words are one
shingle; texts without words have fingerprint 0.

Links (fingerprints at most ``distance`` bits apart) are searched among the
distinct fingerprints:

1. Bit statistics of all distinct fingerprints (counts per bit and per pair
   of bits, summed in Spark) give the correlation of every pair of bits.
2. The bits are put in a row with correlated ones side by side, so that what
   is redundant can sit together and the other partitions stay selective.
3. The row is cut into partitions, each with its own threshold t_i >= -1,
   with sum(t_i) = distance - parts + 1: if two fingerprints are within
   ``distance``, some partition has them within t_i. Dynamic programming
   chooses number and widths of the partitions and the thresholds of least
   estimated cost: rows sent plus candidates met, from the bits' mismatch
   probabilities and the number of fingerprints. Small corpora get more and
   narrower partitions of few probes, large ones fewer and wider ones, whose
   buckets stay selective. The links found are the same for every plan.
4. Every fingerprint is indexed by the value of each used partition and
   probes all values within t_i of its own; candidates are verified on all
   64 bits in the join itself, so only true links leave it.
5. Components by alternating large-star and small-star steps over the links.

Scale: fingerprints are computed where the texts lie; after that rows are a
few bytes wide. Copies, however many, are one fingerprint; the hot group's
rows meet the component table in a join that adaptive execution can split.
Nothing per document reaches the driver, only 64 x 64 bit counts.

Defined cases: null text has no words (fingerprint 0, linked like any
other); a null doc_id is a document without an id: it links others, and is
its component's id only if all its members lack one; repeated rows each get
a result row; an empty table gives an empty result. Extra columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion_ops.llm.common import col, give_back_memory, text_chunks
from medallion_ops.session import materialize, materialize_counted

BITS = 64
SEED = 42
SLICE = 2 << 20
HASHES = 1 << 16                 # shingles whose bits are unpacked at once
NEAR = 8                         # bits in the row that the next one is compared with
CANDIDATE = 0.1                  # cost of a candidate compared in the join, against a row sent through the shuffle


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()     # bytes: ASCII letters and white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, np.int64), max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes: Iterator[int] | list[int] = [digest(joined, SEED)]
        starts = ends = None
    else:
        edge = np.cumsum([len(w) + 1 for w in words])
        starts, ends = np.concatenate(([0], edge[:n - 1])).tolist(), (edge[shingle - 1:] - 1).tolist()
    for at in range(0, n, HASHES):
        if starts is not None:
            hashes = [digest(joined[b:e], SEED) for b, e in zip(starts[at:at + HASHES], ends[at:at + HASHES])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "__text", SLICE):
            found = np.array([fingerprint(t, shingle) for t in batch.column("__text").to_pylist()], np.uint64)
            keep = [i for i, n in enumerate(batch.schema.names) if n != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(found.view(np.int64))],
                names=[*[batch.schema.names[i] for i in keep], "fp"])
        give_back_memory()
    return run


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a 64-bit hash of the text (which row of that id) and the fingerprint as a signed long, per row."""
    rows = docs.select(col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(col(text_col)).alias("row"),
                       col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id bigint, row bigint, fp bigint")


def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
        for at in range(0, len(values), HASHES):
            bits = np.unpackbits(values[at:at + HASHES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += (bits.astype(np.float32).T @ bits.astype(np.float32)).astype(np.int64)   # exact: sums < 2^24
    if total.any():
        i, j = np.nonzero(np.triu(total))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                          pa.array(total[i, j])], names=["i", "j", "n"])


def bit_statistics(prints: DataFrame, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Share of ones per bit and the correlation matrix of the bits, over all distinct fingerprints."""
    sums = (prints.select("fp").mapInArrow(_bit_counts, "i int, j int, n bigint")
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())           # 64 x 65 / 2 rows at most
    both = np.zeros((BITS, BITS))
    for r in sums:
        both[r["i"], r["j"]] = both[r["j"], r["i"]] = r["n"] / max(count, 1)
    p = np.diag(both).copy()
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return p, (both - np.outer(p, p)) / np.outer(spread, spread)


def bit_order(corr: np.ndarray) -> list[int]:
    """All bits in a row, correlated ones side by side: each next bit is the one closest to the last few."""
    strength = np.abs(corr) - np.eye(BITS) * 2
    row = [int(x) for x in np.unravel_index(int(np.argmax(strength)), strength.shape)]
    while len(row) < BITS:
        rest = [b for b in range(BITS) if b not in row]
        row.append(rest[int(np.argmax(strength[np.ix_(rest, row[-NEAR:])].mean(axis=1)))])
    return row


def _probes(width: int, t: int) -> int:
    return sum(comb(width, k) for k in range(t + 1))


def _chances(row: list[int], p: np.ndarray, corr: np.ndarray, most: int) -> np.ndarray:
    """[i, j, t]: the chance that two fingerprints differ in at most t of the bits row[i:j].

    A bit differs with chance 2p(1-p); correlated bits count as fewer
    independent ones.
    """
    miss = np.minimum(2 * p[row] * (1 - p[row]), 0.5)
    shared = np.zeros((BITS + 1, BITS + 1))
    shared[1:, 1:] = np.cumsum(np.cumsum(corr[np.ix_(row, row)] ** 2, axis=0), axis=1)
    out = np.ones((BITS + 1, BITS + 1, most + 1))
    for i in range(BITS):
        exactly = np.zeros(most + 1)
        exactly[0] = 1.0
        for j in range(i + 1, BITS + 1):
            m = miss[j - 1]
            exactly[1:] = exactly[1:] * (1 - m) + exactly[:-1] * m
            exactly[0] *= 1 - m
            within = shared[j, j] - shared[i, j] - shared[j, i] + shared[i, i]
            independent = (j - i) ** 2 / max(within, 1e-9)
            out[i, j] = np.minimum(np.cumsum(exactly), 1.0) ** min(1.0, independent / (j - i))
    return out


def plan_partitions(p: np.ndarray, corr: np.ndarray, count: int, distance: int,
                    parts: int | None = None) -> tuple[list[list[int]], list[int]]:
    """The partitions (their number and widths too, unless ``parts`` fixes the number) and thresholds of least
    estimated cost.

    Partitions are runs of the bits in ``bit_order``. With thresholds t_i >= 0
    the sum of t_i + 1 must be distance + 1, whatever the number of
    partitions; a partition without a threshold (-1) is not probed and costs
    nothing. Dynamic programming over (bits dealt, sum so far, partitions)
    finds the cheapest. Threshold t on a run costs the rows that ``count``
    fingerprints send (one for the index, one per probe) and the candidates
    they meet, a candidate being CANDIDATE of a row.
    """
    n, need = float(max(count, 1)), distance + 1
    row = bit_order(corr)
    chance = _chances(row, p, corr, distance)
    width = np.arange(BITS + 1)
    rows = np.array([[1.0 + _probes(int(w), t) for t in range(need)] for w in width])
    best: list[dict[tuple[int, int], tuple[float, list[tuple[int, int, int]]]]] = [{} for _ in range(BITS + 1)]
    best[0][0, 0] = 0.0, []
    for j in range(1, BITS + 1):
        for i in range(j):
            cost = n * rows[j - i] + CANDIDATE * n * n * chance[i, j]
            for (spent, k), (so_far, runs) in best[i].items():
                if parts is not None and k == parts:
                    continue
                for t in range(-1, min(distance - spent, j - i) + 1):
                    state = spent + t + 1, 0 if parts is None else k + 1
                    total = so_far + (cost[t] if t >= 0 else 0.0)
                    if state not in best[j] or total < best[j][state][0]:
                        best[j][state] = total, [*runs, (i, j, t)]
    goal = need, parts or 0
    if goal not in best[BITS]:
        raise ValueError(f"{parts} partitions cannot cover a distance of {distance}")
    runs = best[BITS][goal][1]
    return [sorted(row[i:j]) for i, j, _ in runs], [t for _, _, t in runs]


def _gather(fp: Column, bits: list[int]) -> Column:
    """The partition's bits of a fingerprint; the other bits are 0."""
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask).cast("bigint"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def links(prints: DataFrame, partitions: list[list[int]], thresholds: list[int], distance: int) -> DataFrame:
    """Pairs a < b of distinct fingerprints at most ``distance`` bits apart (a pair may come twice)."""
    used = [(k, bits, t) for k, (bits, t) in enumerate(zip(partitions, thresholds)) if t >= 0]
    own = [F.struct(F.lit(k).cast("tinyint").alias("part"), _gather(F.col("fp"), bits).alias("sig"))
           for k, bits, _ in used]
    index = prints.select(F.col("fp").alias("b"), F.explode(F.array(*own)).alias("x")).select("b", "x.*")
    probe = None
    for k, bits, t in used:
        masks = [_signed(sum(1 << b for b in flip)) for n in range(t + 1) for flip in combinations(bits, n)]
        rows = prints.select(F.col("fp").alias("a"), F.lit(k).cast("tinyint").alias("part"),
                             F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])).alias("flip"),
                             _gather(F.col("fp"), bits).alias("sig0"))
        rows = rows.select("a", "part", F.col("sig0").bitwiseXOR(F.col("flip")).alias("sig"))
        probe = rows if probe is None else probe.unionByName(rows)
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    i, q = index.alias("i"), probe.alias("q")
    return q.join(i, (F.col("q.part") == F.col("i.part")) & (F.col("q.sig") == F.col("i.sig")) & near).select("a", "b")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph: ``node`` and ``root`` (its smallest node), for linked nodes.

    Alternates large-star and small-star (each node hands its larger, then
    its smaller neighbours to the smallest one) until no edge changes. Edges
    stay in Spark, each round is stored; the number of rounds grows with the
    logarithm of the longest path.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        """(node, other) with both directions -> node, other and the least of node and its others."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return pairs.join(least, "u")

    cur = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(),
                      "links")
    state = None
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        down = large.distinct()                                        # u > v
        near = smallest(down)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            near.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        cur, n = materialize_counted(small, "links")
        mark = cur.agg(F.bit_xor(F.xxhash64("u", "v")).alias("x")).collect()[0]["x"]
        if (n, mark) == state:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = n, mark


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, parts: int | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, row (hash of the text), fp, component (smallest doc_id reachable) and
    keep (whether this id and text stand for the component)."""
    if not 0 <= distance <= BITS or not (parts is None or 1 <= parts <= BITS):
        raise ValueError("distance must be 0 to 64 and parts, if given, 1 to 64")
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    ids = rows.select("fp", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("first"))
    prints, count = materialize_counted(ids.groupBy("fp").agg(F.min("first").alias("first")), "prints")
    p, corr = bit_statistics(prints, count)
    partitions, thresholds = plan_partitions(p, corr, count, distance, parts)
    found = components(links(prints.select("fp"), partitions, thresholds, distance))
    rooted = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min("first").alias("top"))
    classes = materialize(rooted.select("fp", "root").join(first, "root").select("fp", "top"), "classes")
    out = rows.join(classes, "fp")
    keep = F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("row") == F.col("top.row"))
    return out.select("doc_id", "row", "fp", F.col("top.doc_id").alias("component"), keep.alias("keep"))


def deduplicate(docs: DataFrame, shingle: int = 3, distance: int = 3, parts: int | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id (no id last).

    Rows that repeat that id and text are one document: one of them stays.
    """
    names = docs.columns
    classes = near_duplicates(docs, shingle, distance, parts, id_col, text_col)
    key = lambda doc_id, row: F.concat_ws("/", F.coalesce(doc_id.cast("string"), F.lit("none")), row.cast("string"))
    kept = classes.where("keep").select(key(F.col("doc_id"), F.col("row")).alias("__simhash_key")).distinct()
    mine = docs.withColumn("__simhash_key", key(col(id_col).cast("bigint"), F.xxhash64(col(text_col))))
    return mine.join(kept, "__simhash_key", "left_semi").dropDuplicates(["__simhash_key"]).select(*[col(c) for c in names])
