"""Personal data, hard negatives and phrases against brute force."""

import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion_ops.llm import negatives, phrases, pii_crf
from medallion_ops.llm.negatives import mine_negatives
from medallion_ops.llm.phrases import collocations
from medallion_ops.llm.pii_crf import base_spans, example_table, find_pii, fit_pii, mask_pii

from .odd import TEXTS, documents, empty

# ---------------------------------------------------------------- personal data

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _plain_spans(text):
    def good(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            even = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
            return 13 <= len(digits) <= 19 and even % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if good(k, m.group())]


@pytest.fixture(scope="module")
def model():
    return pii_crf.train(pii_crf.example_sentences())


@pytest.mark.parametrize("alphabet", ["ab.@-1", "123.. ", "0123456789 -", "+12 ().-345", "a@b.é1+ 2-3\n"])
def test_base_spans_are_the_patterns(alphabet):
    rnd = random.Random(alphabet)
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 60))) for _ in range(3000)]
    for t in [*texts, "4111 1111 1111 1111", "a@b.c@d.e", "@b.c@d.e", "1.2.3.4.5.6.7.8", "001.2.3.0255", "+1 (743) 555-3824."]:
        assert base_spans(t) == _plain_spans(t), t


@pytest.mark.parametrize("text", ["a" * 10 ** 6, "1" * 10 ** 6, "1." * 500_000, "+1" + "(" * 10 ** 6, "@" * 10 ** 6, "1 " * 500_000,
                                  "a.b" * 300_000 + "@", "\n" * 10 ** 6])
def test_hostile_texts_take_linear_time(model, text):
    t = time.process_time()
    assert all(b < e for _, b, e, _ in pii_crf.all_spans([text], model)[0])
    assert time.process_time() - t < 20


def test_viterbi_is_the_best_path(model):
    rng = np.random.default_rng(3)
    counts = np.array([1, 3, 4, 2])
    first = np.cumsum(counts) - counts
    score, trans = rng.normal(size=(counts.sum(), pii_crf.STATES)), rng.normal(size=(pii_crf.STATES,) * 2)
    got = pii_crf.viterbi(score, first, counts, trans)
    for b, n in zip(first, counts):
        def value(path):
            return sum(score[b + i, s] for i, s in enumerate(path)) + sum(trans[x, y] for x, y in zip((0, *path), (*path, 0)))
        best = max(itertools.product(range(pii_crf.STATES), repeat=int(n)), key=value)
        assert tuple(got[b:b + n]) == best


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(4)
    score, trans = rng.normal(size=(3, pii_crf.STATES)), rng.normal(size=(pii_crf.STATES,) * 2)
    p, pairs = pii_crf._marginals(score, np.array([[0, 1, 2]]), np.ones((1, 3), bool), trans)
    want, moves, total = np.zeros((3, pii_crf.STATES)), np.zeros_like(trans), 0.0
    for path in itertools.product(range(pii_crf.STATES), repeat=3):
        steps = list(zip((0, *path), (*path, 0)))
        w = np.exp(sum(score[i, s] for i, s in enumerate(path)) + sum(trans[x] for x in steps))
        total += w
        for i, s in enumerate(path):
            want[i, s] += w
        for x in steps:
            moves[x] += w
    np.testing.assert_allclose(p[0], want / total, atol=1e-9)
    np.testing.assert_allclose(pairs, moves / total, atol=1e-9)


def test_cut_sentences_give_the_same_labels(model):
    texts = [t for t, _ in pii_crf.example_sentences(300, seed=5)] + [" ".join(["plain words and 12 numbers"] * 400)]
    tokens = pii_crf.tokenize(texts, model["table"])
    ids = pii_crf.feature_ids(tokens, model["known"])
    whole = pii_crf.decode(ids, tokens["sentence"], model, cut=False)
    assert (pii_crf.decode(ids, tokens["sentence"], model) == whole).all() and (whole > 0).sum() > 300


def test_disguised_forms_are_found_and_clean_text_is_left_alone(model):
    held_out = pii_crf.example_sentences(500, seed=77)
    want = {(i, *s) for i, (_, spans) in enumerate(held_out) for s in spans}
    got = {(i, *s) for i, s in enumerate(pii_crf.chain_spans([t for t, _ in held_out], model)) for s in s}
    assert len(want & got) >= 0.9 * len(want) and len(got - want) <= 0.02 * len(want)
    text = "write to bob [at] mail3 [dot] example [dot] com or call (743) 555-3824 today."
    assert [(k, text[b:e], base) for k, b, e, base in pii_crf.all_spans([text], model)[0]] == [
        ("email", "bob [at] mail3 [dot] example [dot] com", False), ("phone", "(743) 555-3824", False)]
    clean = ["The invoice of 2021-05-12 over 1,234.50 is version 1.2.3 at 12:30.", "look at dot and @home; see #1234 and 10 000 000."]
    assert pii_crf.all_spans(clean, model) == [[], []]


def test_find_and_mask(spark, model):
    docs = documents(spark)
    out = find_pii(docs, model)
    assert out.columns == [c for c in docs.columns if c != "spans"] + ["spans"] and out.count() == len(TEXTS)
    assert find_pii(empty(spark), model).count() == 0
    texts = [(1, "a@b.com, é 10.0.0.1"), (2, None), (3, "(743) 555-3824 or a@b.com")]
    got = {r.doc_id: r.text for r in mask_pii(documents(spark, texts), model).collect()}
    assert got == {1: "<email>, é <ip>", 2: None, 3: "<phone> or <email>"}
    rows = {r.doc_id: [tuple(s) for s in r.spans] for r in find_pii(documents(spark, texts), None).collect()}
    assert rows[1] == [("email", 0, 7, True), ("ip", 11, 19, True)] and rows[2] == []
    assert len(rows[3]) == 1


def test_labelled_table_is_bounded_and_may_be_empty(spark):
    assert fit_pii(example_table(spark).where("size(spans) = 0")) is None
    assert fit_pii(example_table(spark).limit(0)) is None


# ---------------------------------------------------------------- hard negatives

def _mined(rows, positives, negatives, low, high):
    """rows: (id, label, vector of integers)."""
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for i, label, a in rows:
        if i % 100:
            continue
        same = sorted((-dot(a, b), j) for j, other, b in rows if other == label and j != i)[:positives]
        rest = sorted((-dot(a, b), j) for j, other, b in rows if other != label)
        for s, p in same:
            fit = [(n, j) for n, j in rest if low * -s <= 100 * -n <= high * -s][:negatives]
            out |= {(i, p, rank, j, -s, -n) for rank, (n, j) in enumerate(fit, 1)}
    return out


@pytest.mark.parametrize("dim,copies,block_rows,anchor_rows", [(3, 0.0, 7, 2), (6, 0.4, 16, 3), (2, 0.8, 2048, 256)])
def test_hard_negatives_are_those_of_all_pairs(spark, dim, copies, block_rows, anchor_rows):
    rnd = random.Random(dim)
    hot = [rnd.randint(1, 6) / 4 for _ in range(dim)]
    rows = []
    for i in rnd.sample(range(2000), 350):
        v = hot if rnd.random() < copies else [rnd.randint(-6, 6) / 4 for _ in range(dim)]
        rows.append((i, rnd.randint(0, 2), v))
    rows += [(100 * k, k % 3, [rnd.randint(-6, 6) / 4 for _ in range(dim)]) for k in range(30, 40)]
    odd = [(5000, None, hot), (5100, 1, None), (5200, 1, [float("nan")] * dim), (5300, 1, [None] * dim), (None, 1, hot),
           (5400, 1, [1.0] * (dim + 1)), (5500, 1, [float("inf")] * dim), (5600, 1, [1e300] * dim), rows[0], rows[0]]
    df = spark.createDataFrame(rows + odd, "vec_id long, label int, embedding array<double>") \
        .withColumn("block", F.lit("x")).withColumn("part", F.lit(1)).withColumn("rank", F.lit(2))
    got = {tuple(r) for r in mine_negatives(df, positives=3, negatives=4, scale=4, block_rows=block_rows,
                                            anchor_rows=anchor_rows).collect()}
    want = _mined([(i, y, [int(4 * x) for x in v]) for i, y, v in rows], 3, 4, 30, 90)
    assert got == want and len(want) > 20


def test_hard_negatives_of_nothing(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert mine_negatives(spark.createDataFrame([], schema)).count() == 0
    assert mine_negatives(spark.createDataFrame([(1, 1, [1.0]), (2, 1, [1.0])], schema)).count() == 0      # no anchor
    assert mine_negatives(spark.createDataFrame([(100, 1, [1.0]), (2, 1, [1.0])], schema)).count() == 0    # no negative


def test_curve_visits_neighbours():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    place = negatives.hilbert_index(cells, 3)
    assert sorted(place) == list(range(512))
    path = cells[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_interval_bounds_hold_and_window_is_exact():
    rng = np.random.default_rng(1)
    x, a = rng.integers(-9, 9, (50, 4)), rng.integers(-9, 9, (20, 4))
    least, most = negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None], True)
    values = a @ x.T
    assert (least[:, 0] <= values.min(axis=1)).all() and (most[:, 0] >= values.max(axis=1)).all()
    for p in range(-20, 40):
        lo, hi = negatives.window(p, 30, 90)
        assert [n for n in range(-60, 60) if 30 * p <= 100 * n <= 90 * p] == list(range(lo, hi + 1))
    big = np.array([[1 << 26, 3]])
    assert negatives.product(big, big, False)[0, 0] == (1 << 52) + 9


# ---------------------------------------------------------------- phrases

def _best(rows, top, least, overlap):
    count, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    key = lang, tuple(words[i:i + k])
                    count[key] = count.get(key, 0) + 1
    kept = []
    long = {key: a for key, a in count.items() if len(key[1]) == 3 and a >= least}
    for (lang, w), a in count.items():
        if len(w) < 2 or a < least:
            continue
        if len(w) == 2 and any(x == lang and w in (t[:2], t[1:]) and 100 * f >= overlap * a for (x, t), f in long.items()):
            continue
        cuts = [(1_000_000 * a * a // (count[lang, w[:k]] * count[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        kept.append((lang, -score, -a, " ".join(w).encode(), count[lang, w[:k]], count[lang, w[k:]]))
    out = []
    for _, mine in itertools.groupby(sorted(kept), key=lambda r: r[0]):
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -score)
                for rank, (lang, score, a, p, left, right) in enumerate(itertools.islice(mine, top), 1)]
    return out


@pytest.mark.parametrize("seed,top,least,overlap", [(1, 4, 2, 50), (2, 30, 2, 50), (3, 7, 3, 100), (4, 1000, 2, 1), (5, 2, 1, 20)])
def test_phrases_are_those_of_full_counts(spark, seed, top, least, overlap):
    rnd = random.Random(seed)
    words = ["a", "the", "The", "é", "ÉÀ", "x1", "\U0001d573", "zz", "b c"] + [f"w{i}" for i in range(25)]
    fixed = [" ".join(rnd.choices(words[9:], k=4)) for _ in range(6)]
    rows = []
    for _ in range(150):
        parts = [rnd.choice([rnd.choice(words), rnd.choice(words[:4]), rnd.choice(fixed)]) for _ in range(rnd.randint(0, 14))]
        rows.append((rnd.choice(["en", "en", None, "und", "de"]), rnd.choice([" ", "  ", "\t"]).join(
            p + rnd.choice(["", "", "", ".", ", ", "\n", "!"]) for p in parts)))
    rows += [("en", None), ("fr", "only once here"), ("en", "A" * 100 + " the " + "A" * 100 + " the"), ("nothing", ".,;")]
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("h", F.lit(1)).withColumn("word", F.lit("x"))
    got = [tuple(r) for r in collocations(df, top=top, least=least, overlap=overlap).orderBy("lang", "rank").collect()]
    want = [(*r[:6], r[6], r[7]) for r in _best(rows, top, least, overlap)]
    assert got == want and want


def test_equal_hashes_are_noticed_and_another_seed_taken(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_count_words", _weak(phrases._count_words))
    docs = spark.createDataFrame([("en", "one two three one two three")], "lang string, text string")
    texts = docs.select("lang", F.lit(1).cast("bigint").alias("lang_hash"), "text")
    words, seed = phrases.word_table(texts, 0)
    assert seed == 1 and words.count() == 3


def _weak(count):
    """All words of seed 0 get the same hash."""
    def made(seed):
        inner = count(seed)
        if seed:
            return inner

        def run(batches):
            for b in inner(batches):
                yield b.set_column(1, "h", b.column("n"))
        return run
    return made


def test_phrases_of_odd_rows_and_of_nothing(spark):
    assert collocations(empty(spark)).count() == 0
    got = collocations(documents(spark), top=5, least=2).collect()
    assert {r.rank for r in got} <= set(range(1, 6)) and any(r.phrase == "same text twice" for r in collocations(
        documents(spark), top=10 ** 6, least=2).collect())
