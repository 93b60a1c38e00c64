"""Benchmark decontamination: training windows against a broadcast hash set of test n-grams.

Words are maximal runs of digits, letters a-z (A-Z lower-cased) and
non-ASCII characters. A test item gives every window of ``n`` consecutive
words; an item of fewer words is one window of its own length. The scan
hashes all windows of a document at once with numpy (a polynomial hash of
each word from prefix sums, combined over the window), looks them up in a
bitmap and the sorted hashes, and compares the words of every hit with the
window's own, so a hash collision cannot make a hit.

The broadcast set is checked: the bytes of all (window, item) pairs are summed
first and the pairs dealt by hash into blocks of about ``max_bytes`` (one pair
at least); with one block the set is broadcast whole, with more the documents
are scanned once per block, one block after the other, and the covered spans
united, so a test set of any size gives the same result in the same memory.

Scale: one narrow scan of the documents, no shuffle of texts; a document is
cut into slices of 1 MB for hashing, its word table (24 bytes a word)
is the largest thing in memory. Only hits leave the scan.

Defined cases: null or wordless texts have no words and no hits; null item
texts give no window; repeated rows are scanned each for itself; empty
tables give an empty result (or no hits); a null item_id counts as the item
"null"; extra columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion_ops.llm.common import col, give_back_memory, text_chunks
from medallion_ops.session import materialize

# bytes outside 0-9, A-Z, a-z and 0x80.. separate words; A-Z become a-z
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
             for b in range(256))
BASE = np.uint64(0x9E3779B97F4A7C15)      # odd, so it has an inverse modulo 2^64
STEP = np.uint64(0xD6E8FEB86659FD93)
SLICE = 1 << 20                            # bytes hashed at once
BITS = 22                                  # a bitmap's size is 2^BITS at most
PAIR_BYTES = 64                            # of a (window, item) pair in the set, besides its words and item id


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out, dtype=np.uint64)


class _Tables:
    """Powers of BASE and of its inverse, grown as longer slices come."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> None:
        if len(cls.up) < n:
            cls.up = _powers(n, BASE)
            cls.down = _powers(n, np.uint64(pow(int(BASE), -1, 1 << 64)))


def words_of(folded: bytes, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes) and hash of each word of ``folded``; words also end at the offsets ``cuts``."""
    raw = np.frombuffer(folded, np.uint8)
    inside = raw != 32
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    if cuts is not None and len(cuts):
        opens[cuts] = inside[cuts]
        at = cuts[cuts > 0]
        closes[at - 1] = inside[at - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = np.empty(len(starts), np.uint64)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(starts):
            # words that end within a slice, one at least
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + SLICE, side="right")))
            b, e = int(starts[lo]), int(ends[hi - 1])
            _Tables.to(e - b + 1)
            sums = np.zeros(e - b + 1, np.uint64)
            np.cumsum((raw[b:e].astype(np.uint64) + np.uint64(1)) * _Tables.up[:e - b], out=sums[1:])
            h = (sums[ends[lo:hi] - b] - sums[starts[lo:hi] - b]) * _Tables.down[starts[lo:hi] - b]
            h ^= h >> np.uint64(29)
            h *= STEP
            hashes[lo:hi] = h ^ (h >> np.uint64(32))
            lo = hi
    return starts, ends, hashes


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on (len - n + 1 of them)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = hashes[:m].copy()
        for k in range(1, n):
            out *= STEP
            out += hashes[k:k + m]
        out ^= out >> np.uint64(31)
        out *= BASE
        return out ^ (out >> np.uint64(33))


def item_windows(text: str | None, n: int) -> list[tuple[int, int, bytes]]:
    """(length, hash, words joined by a space) of each window of a test item."""
    folded = (text or "").encode().translate(FOLD)
    starts, ends, hashes = words_of(folded)
    if not len(starts):
        return []
    long = min(n, len(starts))
    words = [folded[b:e] for b, e in zip(starts.tolist(), ends.tolist())]
    return [(long, int(h), b" ".join(words[i:i + long])) for i, h in enumerate(window_hashes(hashes, long))]


@dataclass
class Grams:
    """Windows of one length, sorted by hash: flat arrays, so that the set takes little more than its texts."""

    known: np.ndarray            # hashes; equal ones (collisions) stand side by side
    bitmap: np.ndarray           # over the hashes' top bits
    texts: bytes                 # words of all windows; window k has texts[ends[k]:ends[k + 1]]
    ends: np.ndarray
    items: np.ndarray            # numbers of the items of all windows; window k has items[lists[k]:lists[k + 1]]
    lists: np.ndarray

    @classmethod
    def of(cls, pairs: list[tuple[int, bytes, int]]) -> Grams:
        """``pairs``: distinct (hash, words, item number), sorted."""
        firsts = [k for k, p in enumerate(pairs) if not k or pairs[k - 1][:2] != p[:2]]
        known = np.array([pairs[k][0] for k in firsts], np.uint64)
        bits = min(BITS, max(10, (16 * len(firsts)).bit_length()))
        bitmap = np.zeros(1 << bits, bool)
        bitmap[known >> np.uint64(64 - bits)] = True
        return cls(known, bitmap, b"".join(pairs[k][1] for k in firsts),
                   np.cumsum([0, *[len(pairs[k][1]) for k in firsts]]),
                   np.array([p[2] for p in pairs], np.int32), np.array([*firsts, len(pairs)], np.int64))

    def candidates(self, w: np.ndarray) -> np.ndarray:
        """Places of ``w`` whose top bits some window has."""
        return np.flatnonzero(self.bitmap[w >> np.uint64(65 - len(self.bitmap).bit_length())])


@dataclass
class GramSet:
    """The hash set that is broadcast: the windows by length, and the names of the items."""

    lengths: dict[int, Grams]
    names: list[str]

    @classmethod
    def of(cls, pairs: pa.Table) -> GramSet:
        """``pairs``: distinct rows (long, hash (signed), words, item)."""
        item = pairs.column("item").combine_chunks().dictionary_encode()
        names = item.dictionary.to_pylist()
        hashes = pairs.column("hash").to_numpy().astype(np.int64).view(np.uint64).tolist()
        by_length: dict[int, list[tuple[int, bytes, int]]] = {}
        for long, h, words, k in zip(pairs.column("long").to_pylist(), hashes, pairs.column("words").to_pylist(),
                                     item.indices.to_pylist()):
            by_length.setdefault(long, []).append((h, words, k))
        return cls({long: Grams.of(sorted(own)) for long, own in by_length.items()}, names)

    def parts(self) -> tuple:
        """Plain values, which any worker can unpickle."""
        return {long: tuple(vars(g).values()) for long, g in self.lengths.items()}, self.names

    @classmethod
    def from_parts(cls, parts: tuple) -> GramSet:
        return cls({long: Grams(*g) for long, g in parts[0].items()}, parts[1])

    def hits(self, folded: bytes, starts, ends, hashes, first) -> list[tuple[int, int, list[str]]]:
        """(first word, length, item ids) of each verified window; ``first`` = word at which each word's document begins."""
        found = []
        for long, own in self.lengths.items():
            w = window_hashes(hashes, long)
            at = own.candidates(w)
            at = at[first[at] == first[at + long - 1]]   # within one document
            place = np.searchsorted(own.known, w[at])
            hit = own.known[np.minimum(place, len(own.known) - 1)] == w[at]
            for i, k in zip(at[hit].tolist(), place[hit].tolist()):
                words = b" ".join(folded[b:e] for b, e in zip(starts[i:i + long].tolist(), ends[i:i + long].tolist()))
                while k < len(own.known) and own.known[k] == w[i]:
                    if own.texts[own.ends[k]:own.ends[k + 1]] == words:
                        found.append((i, long, [self.names[x] for x in own.items[own.lists[k]:own.lists[k + 1]]]))
                    k += 1
        return found


SPAN = T.StructType([T.StructField(c, T.LongType()) for c in ("first", "last", "start", "end")])
FOUND = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
         T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(SPAN))]
ARROW_ITEMS = pa.list_(pa.string())
ARROW_SPANS = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")]))


def _scan(grams, keep: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = GramSet.from_parts(grams.value)
        for batch in text_chunks(batches, text, SLICE):
            values = batch.column(text).fill_null("").cast(pa.large_binary())
            offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
            folded = memoryview(values.buffers()[2] or b"")[offsets[0]:offsets[-1]].tobytes().translate(FOLD)
            offsets = offsets - offsets[0]
            cuts = np.unique(offsets[offsets < len(folded)])
            starts, ends, hashes = words_of(folded, cuts) if folded else (np.empty(0, np.int64),) * 3
            bounds = np.searchsorted(starts, offsets)          # words of row r: bounds[r] .. bounds[r + 1]
            per = np.diff(bounds)
            row = np.repeat(np.arange(len(per)), per)
            hits: list[list] = [[] for _ in per]
            for i, long, items in own.hits(folded, starts, ends, hashes, bounds[row]) if len(starts) else []:
                hits[row[i]].append((i, long, items))
            n_hit, all_items, spans = [], [], []
            for r, found in enumerate(hits):
                covered = _united([(i, i + long) for i, long, _ in found]) if found else []
                n_hit.append(sum(e - b for b, e in covered))
                all_items.append(sorted({x for _, _, items in found for x in items}))
                spans.append([{"first": b - int(bounds[r]), "last": e - int(bounds[r]),
                               "start": int(starts[b] - offsets[r]), "end": int(ends[e - 1] - offsets[r])}
                              for b, e in covered])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(per.astype(np.int64)), pa.array(n_hit, pa.int64()),
                 pa.array(all_items, ARROW_ITEMS), pa.array(spans, ARROW_SPANS)],
                names=[*keep, "n_words", "n_hit", "items", "spans"])
        give_back_memory()
    return run


def _united(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((b, e))
    return out


def benchmark_windows(benchmark: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows of the test items, a row per window and item: long, hash (signed), words, item."""
    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            out = [(long, h - (1 << 64) if h >= 1 << 63 else h, words, i) for i, t in zip(ids, b.column(1).to_pylist())
                   for long, h, words in set(item_windows(t, n))]
            cols = list(zip(*out)) if out else [(), (), (), ()]
            types = [pa.int32(), pa.int64(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                             names=["long", "hash", "words", "item"])
    items = benchmark.select(F.coalesce(col(id_col).cast("string"), F.lit("null")).alias("item"),
                             col(text_col).cast("string").alias("text"))
    return items.mapInArrow(run, "long int, hash bigint, words binary, item string").distinct()


def _blocks(windows: DataFrame, max_bytes: int) -> tuple[int, Column]:
    """How many blocks keep each within ``max_bytes`` (or at one pair), and the number of a pair's block."""
    weight = F.octet_length("words") + F.octet_length("item") + F.lit(PAIR_BYTES)
    rows, size = windows.agg(F.count(F.lit(1)), F.coalesce(F.sum(weight), F.lit(0))).collect()[0]
    blocks = -(-size // max_bytes) or 1
    while True:
        mine = F.pmod(F.xxhash64("words", "item"), F.lit(blocks))
        if blocks == 1:
            return blocks, mine
        most = windows.groupBy(mine.alias("k")).agg(F.sum(weight).alias("size")).agg(F.max("size")).collect()[0][0]
        if most <= max_bytes * 1.25 or blocks >= 4 * rows:    # pairs are dealt by hash: a quarter over the mean is even
            return blocks, mine
        blocks *= 2


def scan_benchmark(docs: DataFrame, benchmark: DataFrame, n: int = 10, keep: list[str] | None = None,
                   text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                   max_bytes: int = 48 << 20) -> DataFrame:
    """Each row's hits: the columns ``keep`` (default: all), then
    n_words, n_hit (words inside a window), items (ids of items with an
    occurring window, sorted as strings) and spans (covered runs: first and
    last word, exclusive, and byte offsets in the UTF-8 text, end exclusive).

    ``max_bytes`` bounds the (window, item) pairs of one broadcast block.
    """
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    windows = materialize(benchmark_windows(benchmark, n, item_id, item_text), "test_windows")
    blocks, mine = _blocks(windows, max_bytes)
    names = [f"__c{i}" for i in range(len(keep))]      # free of clashes with the new columns
    typed = docs.select(*[col(c).alias(k) for c, k in zip(keep, names)], col(text_col).cast("string").alias("__text"))
    if blocks > 1:   # each block's scan must know a row by the same number
        typed = materialize(typed.withColumn("__row", F.monotonically_increasing_id()), "decontaminate_input")
        names = [*names, "__row"]
    fields = [f for f in typed.schema if f.name in names]

    def scan(pairs: pa.Table, carry: list):
        grams = spark.sparkContext.broadcast(GramSet.of(pairs).parts())
        run = _scan(grams, [f.name for f in carry], "__text")
        return typed.mapInArrow(run, T.StructType(carry + FOUND)), grams

    if blocks == 1:
        out, _ = scan(windows.toArrow(), fields)
    else:
        parts = []
        for k in range(blocks):                        # one block at a time is on the driver and the workers
            hits, grams = scan(windows.where(mine == k).toArrow(), [f for f in fields if f.name == "__row"])
            parts.append(materialize(hits.where("n_hit > 0"), "decontaminate_hits"))
            grams.unpersist()
        counted, _ = scan(windows.limit(0).toArrow(), fields)
        out = _join_blocks(counted, parts)
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(keep)], "n_words", "n_hit", "items", "spans")


def _join_blocks(counted: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """``counted`` with the blocks' hits of each row united; a word covered in two blocks counts once."""
    found = reduce(DataFrame.unionByName, [p.select("__row", "items", "spans") for p in parts])
    many = found.groupBy("__row").agg(          # as many rows of a document as blocks
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("all"))

    def unite(done: Column, x: Column) -> Column:
        top = F.element_at(done, -1)
        joined = F.struct(top["first"].alias("first"), F.greatest(top["last"], x["last"]).alias("last"),
                          top["start"].alias("start"), F.greatest(top["end"], x["end"]).alias("end"))
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))
        return F.when((F.size(done) > 0) & (x["first"] <= F.try_element_at(done, F.lit(-1))["last"]), grown) \
                .otherwise(F.concat(done, F.array(x)))

    none = F.array().cast(T.ArrayType(SPAN))
    many = many.withColumn("spans", F.aggregate("all", none, unite)).drop("all")
    count = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["last"] - s["first"])
    base = counted.drop("n_hit", "items", "spans")
    out = base.join(many, "__row", "left").withColumns({
        "items": F.coalesce("items", F.array().cast("array<string>")), "spans": F.coalesce("spans", none)})
    return out.withColumn("n_hit", count)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text",
                  **params) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with the covered spans cut from the text.

    Columns stay as they are. Cut texts keep what stands between the spans,
    joined by one space.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove!r}")
    names = docs.columns
    plain = docs.select(*[col(c).alias(f"__d{i}") for i, c in enumerate(names)])
    at = f"__d{names.index(text_col)}"
    found = scan_benchmark(plain, benchmark, text_col=at, **params)
    if remove == "documents":
        found = found.where("n_hit = 0")
        return found.select(*[F.col(f"__d{i}").alias(c) for i, c in enumerate(names)])
    raw = F.col(at).cast("binary")
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.octet_length(raw).cast("bigint")))
    gaps = F.transform(F.arrays_zip(begins.alias("b"), ends.alias("e")),
                       lambda g: raw.substr((g["b"] + 1).cast("int"), (g["e"] - g["b"]).cast("int")).cast("string"))
    left = F.array_join(F.filter(gaps, lambda g: g != ""), " ")
    found = found.withColumn(at, F.when(F.col("n_hit") > 0, left).otherwise(F.col(at)))
    return found.select(*[F.col(f"__d{i}").alias(c) for i, c in enumerate(names)])
