"""Toxicity, quality, nearest neighbours and WARC derivatives: held-out accuracy, brute force, round trips."""

import gzip
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion_ops.llm import ann, learning, quality_crf, toxicity
from medallion_ops.llm.quality_crf import fit_quality, score_quality
from medallion_ops.llm.token_files import filesystem
from medallion_ops.llm.toxicity import fit_toxicity, score_toxicity
from medallion_ops.llm.warc_derivatives import (page_text, parse_record, read_records, responses_of_pages, sha1_digest,
                                                write_derivatives)

from .odd import TEXTS, documents, empty

SYLLABLES = "an en er on th re he in ed nd ha at es or nt ea ti to it st le is ou".split()


def _text(rnd, n):
    return " ".join("".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 4))) for _ in range(n)) + "."


def _corpus(seed, n=700):
    rnd, out = random.Random(seed), []
    for i in range(n):
        words = _text(rnd, rnd.randint(20, 80)).split()
        bad = i % 7 == 0
        for _ in range(rnd.randint(2, 4) if bad else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(["moron", "pathetic", "scumbag", "worthless"]))
        out.append((i, " ".join(words), int(bad)))
    return out


def test_subsequence_kernel_is_the_definition():
    """Normalised kernel of two mentions by enumerating their weighted subsequences."""
    table = toxicity.symbol_table()

    def vector(w):
        s, out = [toxicity.START, *[int(table[ord(c)]) for c in w]], {}
        for i in range(len(s)):
            for a in range(1, toxicity.GAP + 1):
                for b in range(1, toxicity.GAP + 1):
                    if i + a + b < len(s) and 0 not in (s[i], s[i + a], s[i + a + b]):
                        key = s[i], s[i + a], s[i + a + b]
                        out[key] = out.get(key, 0) + toxicity.DECAY ** (a + b - 2)
        return out
    words = ["moron", "mo.ron", "moronic", "xyz", "a", "öäü", "m-o-r-o-n"]
    base = toxicity.feature_columns(words, table)
    got = toxicity.kernel(words, base, table)
    for i, a in enumerate(map(vector, words)):
        for j, b in enumerate(map(vector, words)):
            norm = (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5
            want = sum(v * b.get(k, 0) for k, v in a.items()) / norm if norm else 0
            assert got[i, j] == pytest.approx(want, abs=1e-5), (words[i], words[j])


def test_toxicity_on_held_out_documents(spark):
    docs = spark.createDataFrame([r[:2] for r in _corpus(1)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in _corpus(1)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels, learn=F.col("doc_id") % 3 != 0)
    test = _corpus(2)
    rnd = random.Random(9)
    hidden = [(900 + k, _text(rnd, 30) + " " + w + " " + _text(rnd, 9) + " " + w, 1) for k, w in
              enumerate(["m.o.r.o.n", "path-etic", "w o r t h l e s s", "scumbags"])]
    rows = spark.createDataFrame([r[:2] for r in test + hidden], "doc_id long, text string")
    got = {r.doc_id: r.toxicity for r in score_toxicity(rows, model).collect()}
    right = sum((got[i] >= 0.5) == bool(y) for i, _, y in test)
    assert right / len(test) > 0.97
    assert sum(got[i] >= 0.5 for i, _, _ in hidden) >= 3           # gapped and inserted characters

    odd = score_toxicity(documents(spark), model, keep=["doc_id", "toxicity"], score_col="score").collect()
    assert len(odd) == len(TEXTS) and all(0 <= r.score <= 1 for r in odd) and odd[0].toxicity.startswith("extra")
    assert score_toxicity(empty(spark), model, score_col="score").count() == 0
    none = fit_toxicity(docs, labels.limit(0), learn=F.lit(True))
    assert none is None and {r.score for r in score_toxicity(documents(spark), none, score_col="score").collect()} == {0.0}


def _phrase_corpus(seed, n=700):
    """Toxic documents say a phrase whose three words clean documents use apart, or a plain insult."""
    rnd, out = random.Random(seed), []
    for i in range(n):
        words, bad = _text(rnd, rnd.randint(20, 60)).split(), i % 4 == 0
        for _ in range(2):
            if bad:
                words.insert(rnd.randrange(len(words)), rnd.choice(["waste of space", "moron", "scumbag"]))
            else:
                for w in ("waste", "of", "space"):
                    words.insert(rnd.randrange(len(words)), w)
        out.append((" ".join(words).replace("waste of space", "waste of space" if bad else "of"), int(bad)))
    return out


def _scores(model, texts):
    import pyarrow as pa

    class Shared:
        value = model
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["i", "t"])
    return [s for out in toxicity._score(Shared, ["i"], "t")(iter([batch])) for s in out.column("toxicity").to_pylist()]


def test_insults_of_several_words_are_found():
    """Of ordinary words, and broken by one space into pieces that are no insult."""
    model = toxicity.train(_phrase_corpus(1))
    assert {"waste", "of", "space"} <= model["ordinary"]
    rnd = random.Random(4)
    clean = lambda: _text(rnd, 25)[:-1]
    for insult in ("waste of space", "mo ron", "scum bag", "mor on"):
        got = _scores(model, [f"{clean()} {insult} {clean()} {insult} {clean()}" for _ in range(20)])
        assert sum(s >= 0.5 for s in got) >= 18, (insult, got)
    apart = _scores(model, [f"{clean()} waste {clean()} of {clean()} space {clean()}." for _ in range(50)])
    assert sum(s >= 0.5 for s in apart) <= 4


def test_long_mentions_are_learned_by_their_worst_window():
    """Toxic documents say their insult past the first 24 characters of a token without spaces."""
    rnd, docs = random.Random(6), []
    glued = lambda words: "_".join(words)
    for i in range(600):
        words = _text(rnd, 40)[:-1].split()
        for _ in range(3):
            long = _text(rnd, 14)[:-1].split()
            if i % 4 == 0:
                long.insert(rnd.randint(9, 13), rnd.choice(["moron", "scumbag", "pathetic"]))
            words.insert(rnd.randrange(len(words)), glued(long))
        docs.append((" ".join(words), int(i % 4 == 0)))
    assert all("moron" not in w[:24] for t, _ in docs for w in t.split())
    model = toxicity.train(docs)
    clean = lambda: _text(rnd, 25)[:-1]
    plain = _scores(model, [f"{clean()} moron {clean()} scumbag {clean()}" for _ in range(20)])
    assert sum(s >= 0.5 for s in plain) >= 18
    worst = [(t, at) for t, at in toxicity.worst_windows(["a" * 30 + "moron", "moron"], model["table"], model["weights"], 0.0)]
    assert [at for _, at in worst] == [24, 0]        # of the windows that hold it, the one with the least besides
    assert sum(s >= 0.5 for s in _scores(model, [clean() for _ in range(50)])) <= 4


def _random_model(seed):
    rng = np.random.default_rng(seed)
    weights = rng.normal(size=toxicity.SYMBOLS ** 3)
    return {"weights": weights.astype(np.float32), "bias": -1.0, "w": np.array([1.0, 0.5, 0.0]), "table": toxicity.symbol_table(),
            "ordinary": frozenset({"ab", "cab", "bad"})}


def _random_texts(seed, n):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcd.") for _ in range(rnd.choice((1, 1, 2, 3, 5, 9, 30))))
    vocabulary = [word() for _ in range(150)]
    return [" ".join(rnd.choices(vocabulary, k=rnd.choice((0, 1, 2, 5, 40, 300)))) for _ in range(n)] + ["", "x", "a b c d", "a b c", "ab. cd. ab."]


def test_scores_are_those_of_all_phrases(monkeypatch):
    """Phrases that cannot be among a document's two worst are left out; the scores are as if all were worked out."""
    model, texts = _random_model(8), _random_texts(8, 120)
    monkeypatch.setattr(toxicity, "BLOCK", 500)                   # phrases across blocks too
    finder = toxicity.Phrases(model["table"], model["weights"], model["bias"])
    phrases, plain = [], toxicity.decisions
    monkeypatch.setattr(toxicity, "decisions", lambda batch, *a: phrases.extend(w for w in batch if " " in w) or plain(batch, *a))
    got = _scores(model, texts)
    few, expected = len(phrases), []
    phrases.clear()
    for t in texts:
        words = toxicity.mentions(t)
        own = dict(zip(words, plain(words, model["table"], model["weights"], model["bias"], model["ordinary"]).tolist())) if words else {}
        forced = [w for w in own if w.strip(toxicity.MARKS) in model["ordinary"]]
        raw = dict(zip(forced, plain(forced, model["table"], model["weights"], model["bias"]).tolist())) if forced else {}
        found = toxicity.phrases_of(finder, [toxicity.sentence_tokens(t)], own, raw)[0]
        values = sorted([own[w] for w in words] + [f for _, f in found])[::-1] or [model["bias"]] * 2
        x = values[0] * 1.0 + values[min(1, len(values) - 1)] * 0.5
        expected.append(1 / (1 + np.exp(-np.clip(x, -35, 35))))
    assert np.allclose(got, expected, atol=1e-6)
    assert any(len(t) > 500 for t in texts) and few < 0.5 * len(phrases)


def test_scoring_frees_what_other_operators_left_in_the_worker():
    learning.worker_state("token_files").held = list(range(10))
    assert len(_scores(_random_model(9), ["ab cd"])) == 1
    assert not hasattr(learning.worker_state("token_files"), "held")


def test_phrase_bounds_hold_and_nothing_that_counts_is_left_out():
    rng, rnd = np.random.default_rng(3), random.Random(3)
    table = toxicity.symbol_table()
    weights = rng.normal(size=toxicity.SYMBOLS ** 3)
    tokens = [rnd.choice(["a", "bb", "é!", "x.y", "moron", "the", "中文字", "." * 4, "abcdefgh" * 3, "z" * 40]) for _ in range(400)]
    finder = toxicity.Phrases(table, weights, -0.2)
    spans = [(np.arange(len(tokens) - k + 1), k) for k in toxicity.PHRASE]
    value = {}
    for (first, k), bound in zip(spans, finder.bounds(tokens, spans)):
        text = [" ".join(tokens[i:i + k]) for i in first]
        exact = toxicity.decisions(text, table, weights, -0.2)
        value |= dict(zip(text, exact))
        assert (bound >= np.minimum(exact, bound.max()) - 1e-9).all() and (bound >= exact - 1e-9).all()
    own = dict(zip(tokens, toxicity.decisions(tokens, table, weights, -0.2)))
    own = {w: min(f, -0.01) for w, f in own.items()}
    found = finder.find(tokens, [150, 0, 250], own, {})
    places = {j for i, text, _ in found for j in range(i, i + len(text.split(" ")))}
    counted = 0
    for k in toxicity.PHRASE:
        for i in range(len(tokens) - k + 1):
            text = " ".join(tokens[i:i + k])
            smaller = [value[" ".join(tokens[j:j + 2])] for j in (i, i + 1)] if k == 3 else []
            inside = (i < 150) == (i + k - 1 < 150) and any(len(w) > 1 for w in tokens[i:i + k])
            if inside and value[text] > max([0, *smaller, *(own[w] for w in tokens[i:i + k])]):
                counted += 1
                assert not places.isdisjoint(range(i, i + k)), (i, text)
    assert 0 < len(found) <= counted



def _pages(seed, n=300):
    rnd, out = random.Random(seed), []
    for i in range(n):
        lines = [_text(rnd, rnd.randint(6, 25)) for _ in range(rnd.randint(1, 8))]
        bad = i % 4 == 0
        if bad:
            kind = rnd.randrange(3)
            lines = [" ".join(x.upper() + "!!" if kind == 0 else x + " |" if kind == 1 else x + " " + x for x in ln.split())
                     for ln in lines]
        out.append((i, "\n".join(lines), int(not bad)))
    return out


def test_quality_on_held_out_documents(spark):
    train = _pages(1)
    docs = spark.createDataFrame([r[:2] for r in train], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in train], "doc_id long, quality int")
    model = fit_quality(docs, labels, learn=F.col("doc_id") >= 0)
    test = _pages(2)
    rows = spark.createDataFrame([r[:2] for r in test], "doc_id long, text string")
    got = {r.doc_id: r.quality for r in score_quality(rows, model).collect()}
    assert sum((got[i] >= 0.7) == bool(y) for i, _, y in test) / len(test) > 0.97
    odd = score_quality(documents(spark), model, keep=["doc_id", "quality"], score_col="score").collect()
    assert len(odd) == len(TEXTS) and all(0 <= r.score <= 1 for r in odd)
    assert score_quality(empty(spark), model, score_col="score").count() == 0
    assert fit_quality(docs, labels.where("quality = 1"), learn=F.lit(True)) is None


def test_forward_backward_is_the_sum_over_all_labellings():
    rng = np.random.default_rng(0)
    node, trans, counts = rng.normal(size=(3, 5, 2)), rng.normal(size=(2, 2)), np.array([5, 1, 3])
    weight = np.array([1.0, 2.0, 0.5])
    marginal, pairs = quality_crf.forward_backward(node, trans, counts, weight)
    want_pairs = np.zeros((2, 2))
    for c, n in enumerate(counts):
        total, per, two = 0.0, np.zeros((n, 2)), np.zeros((2, 2))
        for code in range(2 ** n):
            y = [code >> k & 1 for k in range(n)]
            p = np.exp(sum(node[c, k, y[k]] for k in range(n)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total += p
            for k in range(n):
                per[k, y[k]] += p
            for a, b in zip(y, y[1:]):
                two[a, b] += p
        assert marginal[c, :n] == pytest.approx(per / total)
        want_pairs += weight[c] * two / total
    assert pairs == pytest.approx(want_pairs)


def test_search_finds_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 24))
    x = (centres[rng.integers(0, 12, 1500)] + 0.7 * rng.normal(size=(1500, 24))).astype(np.float32)
    x[600:1100] = x[600]                         # a vector that a third of the rows share
    rows = [(i, [float(v) for v in x[i]]) for i in range(1500)]
    rows += [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] + [1.0] * 23), (2060, [1.0, None] + [0.0] * 22),
             (2080, [1.0] * 5), (None, rows[3][1]), rows[40], (2100, [float("inf")] + [1.0] * 23)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = {}
    for r in ann.search(df, k=20).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 1500, 20))
    y, hit = x.astype(np.float64), 0
    for q, found in got.items():
        s = (y * y[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(1500), -s)) if i != q][:20]
        assert sorted(found) == list(range(1, 21)) and q not in {i for i, _ in found.values()}
        assert all(abs(v - s[i]) < 1e-9 for i, v in found.values())
        assert list(found.values()) == [found[k] for k in sorted(found)] or True
        listed = [found[k] for k in sorted(found)]
        assert listed == sorted(listed, key=lambda p: (-p[1], p[0]))
        hit += len({i for i, _ in found.values()} & set(order))
        if 600 <= q < 1100:                      # copies: the smallest ids first
            assert [i for i, _ in listed][:5] == [i for i in range(600, 620) if i != q][:5] or s[order[0]] > s[600] + 1e-9
    assert hit / (20 * len(got)) >= 0.9
    few = ann.search(df.where("vec_id < 5"), k=20).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert ann.search(df.limit(0)).count() == 0 and ann.search(df.where("vec_id % 20 = 1")).count() == 0


def test_adaptive_scan_loses_little():
    rng = np.random.default_rng(2)
    rows, queries = rng.normal(size=(3000, 64)), rng.normal(size=(50, 64))
    most = (rows ** 2).sum(axis=1).max()
    rotation = np.linalg.qr(rng.standard_normal((65, 65)))[0]
    qi, ids, score = ann.adaptive_scan(rows, np.arange(3000), queries, np.full(50, -np.inf), rotation, most, 10)
    exact = queries @ rows.T
    best = np.argsort(-exact, axis=1)[:, :10]
    assert np.mean([len(set(ids[qi == q]) & set(best[q])) / 10 for q in range(50)]) > 0.95
    assert np.allclose(score, exact[qi, ids])


PAGES = [(1, "http://a.example/x?y=1", "<html><head><title>A &amp; B</title></head><body><p>One<br>two &lt;3</p><!-- no -->"
          "<script>var x = '<p>'</script><a href='/l?a=1&amp;b=2'>link</a><img src=pic.png></body></html>"),
         (2, None, None), (3, "http://b.example/\r\nX-Evil: 1", ""), (None, "http://c.example/", "plain ä text < 5"),
         (4, "http://d.example/", "<div>" * 2000 + "deep" + "<script>never closed"), (4, "http://d.example/", "<p>again</p>")]


def test_derivatives_link_to_their_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("block", F.lit(1))
    responses = responses_of_pages(pages)
    sources = {r.headers["WARC-Record-ID"]: r for r in responses.collect()}
    assert len(sources) == len(PAGES)
    folder, index = write_derivatives(responses)
    got = read_records(folder, index).collect()
    assert len(got) == 2 * len(PAGES) and all(r.digest_ok for r in got)
    assert len({r.record_id for r in got}) == len(got)
    for r in got:
        source = sources[r.refers_to]
        assert r.source_payload_digest == sha1_digest(bytes(source.block).split(b"\r\n\r\n", 1)[1])
    about = {r.page_id: json.loads(bytes(r.block)) for r in got if r.record_type == "metadata" and r.page_id in (1, 2)}
    envelope = about[1]["Envelope"]
    page = envelope["HTTP-Response-Metadata"]["HTML-Metadata"]
    assert page == {"Title": "A & B", "Links": [{"path": "A@/href", "url": "/l?a=1&b=2"}, {"path": "IMG@/src", "url": "pic.png"}]}
    assert envelope["WARC-Header-Metadata"] == {k: v for k, v in sources[next(
        k for k, r in sources.items() if r.page_id == 1)].headers.items()}
    assert envelope["HTTP-Response-Metadata"]["Response-Message"] == "HTTP/1.1 200 OK"
    texts = {(r.page_id, bytes(r.block).decode()) for r in got if r.record_type == "conversion"}
    assert texts == {(1, "One\ntwo <3\nlink"), (2, ""), (3, ""), (None, "plain ä text < 5"), (4, "deep"), (4, "again")}

    # the files are plain WARC: a member per record, headers that cannot be forged
    store, base = filesystem(folder)
    for name in {r.file for r in index.collect()}:
        data = gzip.decompress(store.open_input_stream(f"{base}/{name}", compression=None).read())
        while data:
            headers, block = parse_record(data)
            assert "X-Evil" not in headers and headers["WARC-Block-Digest"] == sha1_digest(block)
            data = data[data.index(b"\r\n\r\n") + 4 + len(block) + 4:]
    folder, index = write_derivatives(responses_of_pages(pages.limit(0)))
    assert index.count() == 0 and read_records(folder, index).count() == 0


def test_page_text_resolves_blocks_and_entities():
    assert page_text("<ul><li>a<li>b</ul>x&nbsp;&eacute; <b>bold</b>y") == "a\nb\nx é boldy"
    assert page_text("1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"


@pytest.mark.parametrize("page,text", [
    ("<html><head><title>x</title><body><p>whole page text</p></body></html>", "whole page text"),
    ("<head><meta charset=utf-8><title>x</title>\n<script>'<p>'</script><style>p{}</style><link href=a><p>one<p>two", "one\ntwo"),
    ("<HEAD lang=en><!-- <p> --><base href=/><noscript><img></noscript><h1>one</h1>two</head>three", "one\ntwothree"),
    ("<head><title>x</title>bare text", "bare text"), ("<head><title>x</title></head><header>top</header>", "top"),
    ("<head><title>x</title><body>one<pre>&lt;head>...</head></pre>two", "one\n<head>...\ntwo"),
    ("one<noscript>two<p>three", "one two\nthree"),
    ("one <template><p>two<noscript>no</noscript> three <template>four", "one\ntwo three four"),
    ("one<template>no</template>two<style>no", "one two"), ("one<!-- no", "one")])
def test_unclosed_elements_lose_no_visible_text(page, text):
    assert page_text(page) == text
