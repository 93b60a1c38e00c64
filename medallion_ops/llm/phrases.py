"""Phrase collocations by best-first branch and bound over prefix counts.

Words (ASCII lower-cased, between blanks) are counted per language within
pieces of text; phrases of two and three words grow from them. A phrase is
scored by the worse of its cuts, ``floor(10^6 a^2 / (l r))`` with its own
count ``a`` and those of the two parts, and falls away if a longer candidate
that holds it is at least ``overlap`` percent as frequent.

Growth: a child never occurs more often than its prefix or its suffix, so a
prefix p of first word w bounds every phrase grown from it by
``10^6 f(p) / f(w)``, and a suffix bounds it likewise from its last word.
Prefixes and suffixes below a language's threshold are not grown: only
three-word phrases with both bounds above it, and those that could displace
a two-word phrase above it, are counted. The threshold starts at the score of
the ``2 top``-th best two-word phrase. If fewer than ``top`` phrases at or
above it survive, the language's frontier is expanded (four times as many
two-word phrases) and its documents are gone through again; at 0 everything
is grown. When ``top`` survive at or above the threshold, all others score
less, ties included, and the language is settled.

Scale: words are counted and grown as 64-bit hashes of (language, word),
combined inside a slice of texts before the shuffle, so a frequent word or
phrase is a row per slice. Hashes are exact: the table of all words is
checked for two words with one hash, and another seed is taken if there are
any. What can grow travels to the tasks as bitmaps of a fixed size
(``BITS``): a false positive costs a counted row, never a result. Ranks are
taken by a range sort over all languages, not by a window over one. The
driver sees the bitmaps and a count of unsettled languages.

Defined cases: null texts and texts without words have none; a null language
is ``und``, as one of that name; repeated rows count each; ties go to the
more frequent and then to the smaller phrase in UTF-8 order; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion_ops.llm.common import col, give_back_memory, running_total, text_chunks
from medallion_ops.session import materialize, materialize_counted

SLICE = 4 << 20                 # bytes of text whose words and phrases are combined at once
BITS = 26                       # a bitmap has 2^BITS bits (8 MB)
LONG = 64                       # longer words are hashed one by one
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"


def byte_tables(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kind of each byte (0 of a word, 1 blank, 2 separator), its lower case, its hash, and powers for its place."""
    kind, lower = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
    kind[list(BLANKS)], kind[list(SEPARATORS)] = 1, 2
    lower[ord("A"):ord("Z") + 1] += 32
    rng = np.random.default_rng(seed)
    value = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = rng.integers(1, 1 << 62, dtype=np.uint64) * np.uint64(4) + np.uint64(3)
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(LONG - 1, base)]))
    return kind, lower, value, power


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h``, one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed_words(text: pa.Array, langs: np.ndarray, tables, seed: int):
    """(hash, piece, document, begin, end) of every word of a slice and the slice's lower-cased bytes."""
    import xxhash

    kinds, lower, value, power = tables
    text = text.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    body = text.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    kind, low = kinds[data], lower[data]
    edge = np.zeros(len(data) + 1, bool)                        # a document begins here
    edge[offsets] = True
    word = kind == 0
    begin = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
    end = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    piece = np.cumsum((kind == 2) | edge[:-1])[begin]
    document = np.searchsorted(offsets[1:], begin, side="right")
    size = end - begin
    if not len(begin):
        return np.empty(0, np.uint64), piece, document, begin, end, low
    first = np.cumsum(size) - size
    place = np.minimum(np.arange(size.sum()) - np.repeat(first, size), LONG - 1)
    h = np.add.reduceat(value[low[word]] * power[place], first)
    for i in np.flatnonzero(size > LONG):
        h[i] = xxhash.xxh3_64_intdigest(low[begin[i]:end[i]].tobytes(), seed)
    return mixed(mixed(h) ^ langs[document]), piece, document, begin, end, low


def _lang_hashes(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("lang_hash").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _count_words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = byte_tables(seed)
        for batch in text_chunks(batches, "text", SLICE):
            h, _, document, begin, end, low = hashed_words(batch.column("text"), _lang_hashes(batch), tables, seed)
            if not len(h):
                continue
            h, at, n = np.unique(h, return_index=True, return_counts=True)
            raw = low.tobytes()
            words = [raw[b:e].decode() for b, e in zip(begin[at].tolist(), end[at].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(document[at])).cast(pa.string()), _signed(h), pa.array(words, pa.string()),
                 pa.array(n.astype(np.int64))], names=["lang", "h", "word", "n"])
        give_back_memory()
    return run


def _inside(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h >> np.uint64(64 - BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Place of a pair of words in a bitmap; ``_pair`` is the same in SQL."""
    return a ^ (b << np.uint64(21) | b >> np.uint64(43))


def _pair(a: str, b: str) -> Column:
    turned = F.shiftleft(b, 21).bitwiseOR(F.shiftrightunsigned(b, 43))
    return F.col(a).bitwiseXOR(turned)


def _grown(batch: pa.RecordBatch, tables, seed: int, words: np.ndarray):
    """Distinct word hashes of a slice, each word's index into them, and whether the next word may follow it in a phrase."""
    h, piece, *_ = hashed_words(batch.column("text"), _lang_hashes(batch), tables, seed)
    distinct, which = np.unique(h, return_inverse=True)
    may = _inside(words, distinct)[which]
    follows = (piece[1:] == piece[:-1]) & may[1:] & may[:-1]
    return distinct, which.astype(np.int64), follows


def _count_pairs(seed: int, words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = byte_tables(seed)
        for batch in text_chunks(batches, "text", SLICE):
            distinct, which, follows = _grown(batch, tables, seed, words.value)
            at = np.flatnonzero(follows)
            if not len(at):
                continue
            key, n = np.unique(which[at] * len(distinct) + which[at + 1], return_counts=True)
            first, second = np.divmod(key, len(distinct))
            yield pa.RecordBatch.from_arrays([_signed(distinct[first]), _signed(distinct[second]),
                                              pa.array(n.astype(np.int64))], names=["h1", "h2", "n"])
        give_back_memory()
    return run


def _count_triples(seed: int, words, frontier):
    """Phrases of three words whose pairs are both frequent and that the frontier asks for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = byte_tables(seed)
        frequent, prefix, suffix, contender = frontier.value
        for batch in text_chunks(batches, "text", SLICE):
            distinct, which, follows = _grown(batch, tables, seed, words.value)
            at = np.flatnonzero(follows)
            pair = pair_hash(distinct[which[at]], distinct[which[at + 1]])
            keep = _inside(frequent, pair)
            at, pair = at[keep], pair[keep]
            left = np.flatnonzero(at[1:] == at[:-1] + 1)              # pairs that the next pair overlaps
            if not len(left):
                continue
            p, s = pair[left], pair[left + 1]
            ask = (_inside(prefix, p) & _inside(suffix, s)) | _inside(contender, p) | _inside(contender, s)
            at = at[left[ask]]
            if not len(at):
                continue
            n = len(distinct)                                        # under 2^21: no word is without a byte between
            key, count = np.unique((which[at] * n + which[at + 1]) * n + which[at + 2], return_counts=True) if n < 1 << 21 \
                else _unique_rows(which, at, n)
            key, third = np.divmod(key, n)
            first, second = np.divmod(key, n)
            first, second, third = (x.astype(np.int64) for x in (first, second, third))
            yield pa.RecordBatch.from_arrays([_signed(distinct[x]) for x in (first, second, third)]
                                             + [pa.array(count.astype(np.int64))], names=["h1", "h2", "h3", "n"])
        give_back_memory()
    return run


def _unique_rows(which: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``np.unique`` of the triples' keys, which pass 63 bits in the slice of one very long text: Python's integers."""
    keys = (which[at].astype(object) * n + which[at + 1]) * n + which[at + 2]
    key, count = np.unique(keys, return_counts=True)
    return key, count


def bitmap(places: DataFrame, place: Column) -> np.ndarray:
    """2^BITS bits, those of the leading bits of ``place`` set; of fixed size whatever the table."""
    at = F.shiftrightunsigned(place, 64 - BITS) + F.lit(1)
    parts = places.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for part, bits in parts.collect():                               # 2^BITS / 32768 rows of 4 KB at most
        out[(part - 1) * 4096:part * 4096] = np.frombuffer(bits, np.uint8)
    return out


def _score(a: str, left: str, right: str) -> Column:
    """floor(10^6 a^2 / (l r)) in exact arithmetic of up to 38 digits."""
    wide = lambda c: f"cast({c} as decimal(14,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({wide(a)} * {wide(a)})) div ({wide(left)} * {wide(right)})")


def _bound(a: str, whole: str) -> Column:
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast({a} as decimal(14,0))) div cast({whole} as decimal(14,0))")


def word_table(texts: DataFrame, seed: int) -> tuple[DataFrame, int]:
    """lang, h, word and f of every word, stored, and a seed for which no two words have the same hash."""
    while True:
        found = texts.mapInArrow(_count_words(seed), "lang string, h bigint, word string, n bigint")
        words = materialize(found.groupBy("lang", "h", "word").agg(F.sum("n").alias("f")), "phrase_words")
        if not words.groupBy("h").count().where("count > 1").limit(1).collect():
            return words, seed
        seed += 1


def thresholds(pairs: DataFrame, langs: DataFrame, k: int) -> DataFrame:
    """lang and the score of its ``k``-th best two-word phrase, 0 if it has fewer.

    Counted by score: a language has at most 10^6 + 1 rows in the window.
    """
    by_score = pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = by_score.withColumn("run", F.sum("n").over(best)).where(F.col("run") >= k)
    found = reached.groupBy("lang").agg(F.max("score").alias("least"))
    return langs.join(found, "lang", "left").select("lang", F.coalesce("least", F.lit(0)).cast("bigint").alias("least"))


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, overlap: int = 50, lang_col: str = "lang",
                 text_col: str = "text", seed: int = 13) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n (words of the language) and score of each language's ``top`` phrases.

    ``least``: occurrences of a candidate. ``overlap``: percentage of its
    occurrences that a longer candidate must have to displace it.
    """
    lang = F.coalesce(col(lang_col).cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"), col(text_col).cast("string").alias("text"))
    sc = docs.sparkSession.sparkContext
    words, seed = word_table(texts, seed)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= least)
    allowed = sc.broadcast(bitmap(frequent, F.col("h")))

    counted = texts.mapInArrow(_count_pairs(seed, allowed), "h1 bigint, h2 bigint, n bigint")
    pairs = counted.groupBy("h1", "h2").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    one = lambda i, f: frequent.select(F.col("h").alias(f"h{i}"), F.col("f").alias(f))
    pairs = pairs.join(frequent.select("lang", F.col("h").alias("h1"), F.col("f").alias("l")), "h1").join(one(2, "r"), "h2")
    pairs = materialize(pairs.select("lang", "h1", "h2", "a", "l", "r", _score("a", "l", "r").alias("score"),
                                     _bound("a", "l").alias("prefix"), _bound("a", "r").alias("suffix")), "phrase_pairs")
    every = bitmap(pairs, _pair("h1", "h2"))

    open_langs, k, settled = materialize(totals.select("lang"), "phrase_langs"), 2 * top, []
    while True:
        least_score = materialize(thresholds(pairs, open_langs, k), "phrase_least")
        here = pairs.join(least_score, "lang")
        front = [bitmap(here.where(F.col(c) >= F.col("least")), _pair("h1", "h2")) for c in ("prefix", "suffix", "score")]
        frontier = sc.broadcast((every, *front))                     # four bitmaps
        mine = texts.join(open_langs, "lang", "left_semi") if settled else texts
        counted = mine.mapInArrow(_count_triples(seed, allowed, frontier), "h1 bigint, h2 bigint, h3 bigint, n bigint")
        triples = counted.groupBy("h1", "h2", "h3").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
        found = _survivors(materialize(triples, "phrase_triples"), pairs, here, one, overlap, least_score)
        found = materialize(found, "phrase_survivors")
        per = found.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        ended = least_score.join(per, "lang", "left").withColumn(
            "done", (F.col("least") == 0) | (F.coalesce("n", F.lit(0)) >= top))
        ended = materialize(ended.select("lang", "done"), "phrase_ended")
        settled.append(found.join(ended.where("done"), "lang", "left_semi"))
        open_langs, left = materialize_counted(ended.where("not done").select("lang"), "phrase_langs")
        frontier.unpersist()
        if not left:
            break
        k *= 4

    rows = settled[0]
    for more in settled[1:]:
        rows = rows.unionByName(more)
    for i in (1, 2, 3):                                              # back from hashes to words
        rows = rows.join(frequent.select(F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}")), f"h{i}", "left")
    rows = rows.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", "score",
                       F.lit(1).cast("bigint").alias("one"))
    order = [F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase")]
    numbered = materialize(running_total(rows, order, {"place": "one"}, "phrase_order"), "phrase_places")
    first = numbered.groupBy("lang").agg(F.min("place").alias("first"))
    ranked = numbered.join(first, "lang").withColumn("rank", F.col("place") - F.col("first") + 1).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _survivors(triples: DataFrame, pairs: DataFrame, here: DataFrame, one, overlap: int, least_score: DataFrame) -> DataFrame:
    """lang, h1, h2, h3, a, l, r, score of the phrases at or above their language's threshold that no longer one displaces."""
    left = pairs.select("lang", "h1", "h2", F.col("a").alias("f12"))
    right = pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"))
    full = triples.join(left, ["h1", "h2"]).join(right, ["h2", "h3"]).join(one(1, "f1"), "h1").join(one(3, "f3"), "h3")
    full = full.withColumns({"s1": _score("a", "f1", "f23"), "s2": _score("a", "f12", "f3")})
    earlier = F.col("s1") <= F.col("s2")
    long = full.select("lang", "h1", "h2", "h3", "a", F.when(earlier, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                       F.when(earlier, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    long = long.join(least_score, "lang").where(F.col("score") >= F.col("least")).drop("least")
    holders = triples.select("h1", "h2", "a").unionByName(triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    holders = holders.groupBy("h1", "h2").agg(F.max("a").alias("longer"))
    short = here.where(F.col("score") >= F.col("least")).join(holders, ["h1", "h2"], "left")
    short = short.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * overlap))
    return short.select("lang", "h1", "h2", F.lit(None).cast("bigint").alias("h3"), "a", "l", "r", "score").unionByName(long)
