"""Decontamination, SimHash, token files and token counts against brute force and the libraries themselves."""

import pickle
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer, models, pre_tokenizers

from medallion_ops.llm import decontaminate as decontaminate_module
from medallion_ops.llm import simhash
from medallion_ops.llm.decontaminate import decontaminate, scan_benchmark
from medallion_ops.llm.simhash import deduplicate, fingerprint, near_duplicates
from medallion_ops.llm.token_counts import CountOnlyViterbi, count_tokens, ranked_vocabulary
from medallion_ops.llm.token_files import ChunkEncoder, TokenFile, filesystem, read_documents, read_index, write_token_files

from .odd import LONG, TEXTS, documents, empty

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def _hits(text, items, n=10):
    words, hit, found = _words(text), set(), set()
    for item, t in items:
        w = _words(t)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            for i in range(len(words) - size + 1):
                if words[i:i + size] == w[k:k + size]:
                    hit.update(range(i, i + size))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"
ITEMS = [(1, PASSAGE), (2, "short Item"), (3, None), (4, "!!"), (10, "ONE, two three four five six seven eight nine ten")]
CASES = [(20, f"before {PASSAGE} after"), (21, "one two three four five six seven eight nine"), (22, "a short item b SHORT-item"),
         (23, "One two; three\nfour five six seven eight nine ten!"), (24, "x " * 50 + PASSAGE + " y" * 50 + " " + PASSAGE),
         (25, "shortitem"), (26, PASSAGE[:-6])]


@pytest.mark.parametrize("max_bytes", [48 << 20, 600])
def test_decontamination_matches_brute_force(spark, max_bytes):
    """Also with the windows split into blocks that are scanned one after the other."""
    docs = documents(spark, TEXTS + CASES)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = scan_benchmark(docs, bench, keep=["doc_id", "size"], max_bytes=max_bytes).collect()
    assert len(got) == len(TEXTS) + len(CASES)
    texts = dict(TEXTS + CASES)
    for r in got:
        assert (r.n_words, r.n_hit, list(r["items"])) == _hits(texts[r.doc_id], ITEMS), r.doc_id
        raw = (texts[r.doc_id] or "").encode()
        assert sum(len(_words(raw[s.start:s.end].decode())) for s in r.spans) == r.n_hit


def test_decontaminate_removes_documents_or_spans(spark):
    docs = documents(spark, TEXTS + CASES)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, t in TEXTS + CASES if not _hits(t, ITEMS)[1]}
    cut = {r.doc_id: r.text for r in decontaminate(docs, bench, remove="spans").collect()}
    assert cut[20] == "before   after" and cut[4] == LONG and cut[1] is None
    assert all(not _hits(t, ITEMS)[1] for t in cut.values())
    assert decontaminate(empty(spark), bench).count() == 0
    assert decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_words_of_long_texts_are_cut_in_slices_alike(monkeypatch):
    from medallion_ops.llm import decontaminate as d

    folded = LONG.encode().translate(d.FOLD)
    whole = d.words_of(folded)
    monkeypatch.setattr(d, "SLICE", 1000)
    assert all((a == b).all() for a, b in zip(whole, d.words_of(folded)))


def _fp(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_match_the_definition():
    texts = [t for _, t in TEXTS if t is not LONG] + ["one", "one two", "A b C", "a b c d", "ß É x y z"]
    assert [fingerprint(t) for t in texts] == [_fp(t) for t in texts]


def _components(prints, distance=3):
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_broadcast_set_stays_within_its_bytes():
    """A window that a third of the pairs share, hashes that meet by chance, and a set as large as counted."""
    pairs = [(10, i - 5000, f"w{i} b c d e f g h i j".encode(), f"item{i % 700}") for i in range(10000)]
    pairs += [(10, 7, b"one for all", f"item{i}") for i in range(5000)] + [(10, 7, b"same hash", "other")]
    columns = list(zip(*pairs))
    types = [pa.int32(), pa.int64(), pa.binary(), pa.string()]
    table = pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["long", "hash", "words", "item"])
    grams = decontaminate_module.GramSet.of(table)
    counted = sum(len(w) + len(i) + decontaminate_module.PAIR_BYTES for _, _, w, i in pairs)
    assert len(pickle.dumps(grams.parts())) <= counted
    own = grams.lengths[10]
    found = {own.texts[own.ends[k]:own.ends[k + 1]]: [grams.names[x] for x in own.items[own.lists[k]:own.lists[k + 1]]]
             for k in np.flatnonzero(own.known == 7)}
    assert set(found) == {b"one for all", b"same hash", b"w5007 b c d e f g h i j"}
    assert len(found[b"one for all"]) == 5000 and found[b"same hash"] == ["other"]


@pytest.mark.parametrize("parts", [1, 2, 3, 4, None])
def test_links_and_components_match_brute_force(spark, parts):
    rnd = random.Random(parts or 0)
    prints = [0, (1 << 64) - 1]
    for _ in range(40):
        p = rnd.getrandbits(64)
        prints.append(p)
        for _ in range(rnd.randint(0, 6)):       # chains of near ones
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                p ^= 1 << b
            prints.append(p)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in sorted(set(prints))]
    df = spark.createDataFrame(signed, "fp long")
    share, corr = simhash.bit_statistics(df, len(signed))
    groups, thresholds = simhash.plan_partitions(share, corr, len(signed), 3, parts)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert len(groups) == len(thresholds) == (parts or len(groups))
    assert sum(thresholds) == 3 - len(groups) + 1
    if parts == 1:
        return                                   # a radius of 3 on 64 bits: too many probes for a test
    found = simhash.links(df, groups, thresholds, 3).distinct().collect()
    want = {(a, b) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 3}
    assert {(r.a, r.b) for r in found} == want
    linked = {r.node: r.root for r in simhash.components(spark.createDataFrame([tuple(r) for r in found], "a long, b long")).collect()}
    groups_of = {}
    for p, r in _components([s[0] % (1 << 64) for s in signed]).items():
        groups_of.setdefault(r, set()).add(p - (1 << 64) if p >> 63 else p)
    for members in groups_of.values():
        assert {linked.get(m, m) for m in members} == {min(members)}


def _even():
    return np.full(64, 0.5), np.eye(64)


def test_partitions_follow_the_number_of_fingerprints():
    widths = {}
    for count in (10 ** 3, 10 ** 6, 10 ** 9, 5 * 10 ** 10):
        groups, thresholds = simhash.plan_partitions(*_even(), count, 3)
        assert sum(t + 1 for t in thresholds) == 4
        widths[count] = sorted(len(g) for g, t in zip(groups, thresholds) if t >= 0)
    assert len(widths[10 ** 3]) == 4                                # one probe each
    assert len(widths[5 * 10 ** 10]) == 2 and min(widths[5 * 10 ** 10]) >= 30
    counts = [len(w) for w in widths.values()]
    assert counts == sorted(counts, reverse=True)


def test_uneven_statistics_give_uneven_partitions():
    """Sixteen bits that hardly ever differ and sixteen that always agree with one another stay unselective."""
    p, corr = _even()
    p[:16] = 0.01
    corr[16:32, 16:32] = 1.0
    groups, thresholds = simhash.plan_partitions(p, corr, 10 ** 7, 3)
    used = [(len(g), t) for g, t in zip(groups, thresholds) if t >= 0]
    assert len({w for w, _ in used}) > 1
    groups, thresholds = simhash.plan_partitions(p, corr, 10 ** 7, 3, parts=3)
    assert len(set(thresholds)) > 1 and sum(thresholds) == 1
    assert len({len(g) for g in groups}) > 1


def test_the_plan_is_the_cheapest_of_all():
    """Against every cut of the row of bits into two runs and every share of the distance."""
    rnd = np.random.default_rng(5)
    p = rnd.uniform(0.05, 0.5, 64)
    corr = np.eye(64)
    row, n = simhash.bit_order(corr), 10 ** 8
    chance = simhash._chances(row, p, corr, 3)

    def cost(i, j, t):
        return 0 if t < 0 else n * (1 + simhash._probes(j - i, t)) + simhash.CANDIDATE * n * n * chance[i, j, t]

    want = min(cost(0, c, t) + cost(c, 64, 2 - t) for c in range(1, 64) for t in range(-1, 4)
               if t <= c and 2 - t <= 64 - c)
    (a, b), (s, t) = simhash.plan_partitions(p, corr, n, 3, parts=2)
    assert cost(0, len(a), s) + cost(len(a), 64, t) == pytest.approx(want)


def test_near_duplicates_of_odd_rows(spark):
    base = " ".join(f"tok{i}" for i in range(400))
    cases = [(31, base), (30, base.upper()), (32, base + " end"), (33, "\t" + base.replace(" ", "  "))]
    docs = documents(spark, TEXTS + cases)
    got = near_duplicates(docs).collect()
    assert len(got) == len(TEXTS) + len(cases)
    root = _components([_fp(t) if t is not LONG else fingerprint(t) for _, t in TEXTS + cases])
    first = {}
    for i, t in TEXTS + cases:
        r = root[fingerprint(t)]
        if i is not None:
            first[r] = min(first.get(r, i), i)
    for r in got:
        assert r.component == first.get(root[r.fp % (1 << 64)])
    kept = deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        [*first.values(), *([None] if root[fingerprint("no id at all")] not in first else [])], key=str)
    assert near_duplicates(empty(spark)).count() == 0 and deduplicate(empty(spark)).count() == 0


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _tokenizer():
    return Tokenizer.from_file(VOCABULARY)


@pytest.mark.parametrize("cache,special_as_text", [(1_500_000, False), (5, False), (5, True)])
def test_chunks_give_the_tokenizers_ids(monkeypatch, cache, special_as_text):
    import pyarrow as pa

    from medallion_ops.llm import token_files

    monkeypatch.setattr(token_files, "CACHE", cache)
    rnd, t = random.Random(cache), _tokenizer()
    if special_as_text:                                # not the library's default: the option of the encoder
        t.encode_special_tokens = True
    parts = [" ", " ", "\n", "\t", "a", "the", "The", "'s", "'", "1", "²", "½", "é", "　", " ", "\x85", "!", "###",
             "<|endoftext|>", "中", "\x1c", "​", "᠎", "﻿", " ", "\xa0", ".", ",", "_", "-", "\x00"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(3000)] + [
        "", "x" * 300, " " * 50, "a. b.\nC d", "\nThe", "The\nThe the\nThe", "\n中 b", "b\n中 中\n中!"]
    got = ChunkEncoder(VOCABULARY, special_as_text=special_as_text).encode(pa.array(texts))
    assert got == [struct.pack(f"<{len(i)}I", *i) for i in (t.encode(x, add_special_tokens=False).ids for x in texts)]


def test_token_files_round_trip(spark):
    t = _tokenizer()
    docs = documents(spark)
    folder, manifest = write_token_files(docs, VOCABULARY)
    got = sorted(read_index(folder, manifest).collect(), key=lambda r: r.start)
    want = {}
    for i, x in TEXTS:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        want.setdefault(i, []).append((len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    assert [r.doc_id for r in got] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in got:
        assert (r.n_tokens, r.ids_crc32) in want[r.doc_id] and r.start == start
        start += r.n_tokens
    few = read_documents(folder, manifest, [6, 4]).collect()
    assert {r.doc_id: list(r.ids) for r in few} == {
        i: t.encode(x, add_special_tokens=False).ids + [0] for i, x in TEXTS if i in (4, 6)}

    # the whole file is one ordinary stream; a damaged frame is found by its checksum
    store, base = filesystem(folder)
    name = manifest.collect()[0].file
    raw = store.open_input_stream(f"{base}/{name}", compression=None).read()
    file = TokenFile(f"{base}/{name}", store)
    body = b"".join(file.document(k) for k in range(file.n_docs))
    assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == body
    bad = bytearray(raw)
    bad[file.offsets[1] - 6] ^= 255
    with store.open_output_stream(f"{base}/damaged", compression=None) as out:
        out.write(bytes(bad))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        TokenFile(f"{base}/damaged", store).document(0)
    folder, manifest = write_token_files(empty(spark), VOCABULARY)
    assert read_index(folder, manifest).count() == 0


@pytest.mark.parametrize("cache", [1_500_000, 5])
def test_added_tokens_in_a_text_are_the_librarys(monkeypatch, spark, cache):
    """Against a tokenizer as it is loaded: the string of an added token is its id."""
    import pyarrow as pa

    from medallion_ops.llm import token_files

    monkeypatch.setattr(token_files, "CACHE", cache)
    rnd, t = random.Random(cache), Tokenizer.from_file(VOCABULARY)
    ids = lambda x: t.encode(x, add_special_tokens=False).ids
    assert ids("a <|endoftext|> b") == [64, 220, 50256, 275]
    parts = [" ", " ", "\n", "a", "The", "'s", "é", "!", "<|endoftext|>", "<|endof", "text|>", "\xa0"]
    texts = ["a <|endoftext|> b", "x  <|endoftext|>  y", "no token here", "", "<|endoftext|>"] + [
        "".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(2000)]
    encode = ChunkEncoder(VOCABULARY, special_as_text=False).encode
    want = [struct.pack(f"<{len(i)}I", *i) for i in map(ids, texts)]
    assert encode(pa.array(texts)) == want
    assert encode(pa.array(texts[2:4])) == want[2:4] and encode(pa.array(texts[:1])) == want[:1]
    assert encode(pa.array([], pa.string())) == []

    folder, manifest = write_token_files(documents(spark, list(enumerate(texts[:40]))), VOCABULARY)
    got = read_documents(folder, manifest, list(range(40))).collect()
    assert {r.doc_id: list(r.ids) for r in got} == {i: ids(x) + [0] for i, x in enumerate(texts[:40])}


PIECES = ranked_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("fallback", [False, True])
@pytest.mark.parametrize("ties", [False, True])
def test_counts_are_the_unigram_tokenizers(fallback, ties):
    import pyarrow as pa

    pieces = [(p, -float(len(p) % 3)) for p, _ in PIECES] if ties else PIECES
    t = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    rnd = random.Random(3)
    parts = [" ", " ", "a", "b", "the", "\n", "▁", "é", "中", "𝒳", "<s>", "<0x41>", "ing", "!", "\t", "qzx", "😀"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 20))) for _ in range(1500)] + [x or "" for _, x in TEXTS]
    _, tokens, _ = CountOnlyViterbi(pieces, fallback).counts(pa.array(texts))
    assert tokens.tolist() == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_token_counts_of_odd_rows(spark):
    got = count_tokens(documents(spark), PIECES, keep=["doc_id", "size"]).collect()
    assert len(got) == len(TEXTS) and np.all([r.n_tokens == 0 for r in got if r.doc_id in (1, 2)])
    assert count_tokens(empty(spark), PIECES).count() == 0
