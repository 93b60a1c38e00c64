"""Document quality from lines: a linear-chain conditional random field over good and bad lines.

Each line has features of its own (shares of upper case, digits, symbols,
separators, repeated and neighbouring equal words, word and line lengths,
whether the line came before in the text) and the same features of the line
before and after it. The chain's transitions let a line's neighbours speak
for it. Forward-backward gives each line's probability of being good; the
document's quality is their mean weighted by line length, mapped to a
probability by Platt's method.

Training: the lines of a labelled document carry its label, the chain is
fitted by maximum conditional likelihood (L2-regularised, Adam) on a bounded
sample of labelled documents (``max_good``, ``max_bad``; chosen by a hash of
the id). Scoring reads every text whole where it lies; nothing is shuffled.
Chains of similar length are padded together in groups of bounded size; a text
of very many lines goes through the chain in pieces.

Defined cases: a null or empty text is one empty line; documents without a
label are scored alike; repeated rows are scored each; without labels of
both kinds all scores are 0; an empty table gives an empty result; other
columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion_ops.llm.common import col, text_chunks
from medallion_ops.llm.learning import labelled_sample, logistic

SLICE = 2 << 20
PADDED = 1 << 16               # lines, padding included, that are run through the chain at once
PIECE = 1 << 14                # lines of a text that are looked at together; texts of more go through the chain in pieces
N_OWN = 16                     # features of a line
N = 3 * N_OWN + 2              # with its neighbours' and the ends of the text


def class_table() -> np.ndarray:
    """Class of each character of the basic plane: 0 space and rest, 1 lower, 2 upper, 3 digit, 4 punctuation,
    5 exclamation mark, 6 separator, 7 other symbol."""
    out = np.zeros(1 << 16, np.uint8)
    for c in range(1 << 16):
        x = chr(c)
        if 0xD800 <= c < 0xE000 or x.isspace():
            continue
        out[c] = (2 if x.isupper() else 1 if x.isalpha() else 3 if x.isdigit() else 5 if x == "!" else 6 if x in "|•·"
                  else 4 if x in ".,;:'\"?-()" else 7)
    return out


def line_features(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of all lines, length of each line, index of each text's first line and the end)."""
    return features_of_lines([t.split("\n") for t in texts], [set() for _ in texts], table)


def features_of_lines(lines: list[list[str]], before: list[set[str]], table: np.ndarray
                      ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for texts given as lines; ``before`` holds the lines that each text had already, and is added to."""
    first = np.cumsum([0, *map(len, lines)])
    every = [x for ls in lines for x in ls]
    long = np.fromiter(map(len, every), np.int64, len(every))
    points = np.frombuffer("".join(every).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = table[np.where(points < 1 << 16, points, 0)].astype(np.int64)
    kinds = np.bincount(np.repeat(np.arange(len(every)) * 8, long) + kind, minlength=8 * len(every)).reshape(-1, 8)
    own = np.empty((len(every), 5))
    for i, ls in enumerate(lines):
        seen = before[i]
        for j, line in enumerate(ls):
            words = line.split()
            n = len(words)
            own[first[i] + j] = (n, len(set(words)), sum(map(eq, words, words[1:])), line in seen and n > 0,
                                 sum([w[-1] in "!#$%&*|" for w in words]))
            seen.add(line)
    n, distinct, same, before, tail = own.T
    words = np.maximum(n, 1)
    chars = np.maximum(kinds[:, 1:].sum(axis=1), 1)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)
    upper = kinds[:, 2] / letters
    out = np.stack([
        np.ones(len(every)), upper, (upper > 0.5) & (n > 1), kinds[:, 3] / chars, kinds[:, 4] / chars,
        np.minimum(kinds[:, 5] / words, 2), np.minimum(kinds[:, 6] / words, 2), np.minimum(kinds[:, 7] / words, 3),
        1 - distinct / words, same / words, np.minimum(chars / words, 30) / 10, np.log1p(long) / 10, before, tail / words,
        n == 0, kinds[:, 1] / chars], axis=1).astype(np.float64)
    return out, long, first


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before and of the line after (0 at the ends of a text, which are flagged)."""
    out = np.zeros((len(own), N))
    out[:, :N_OWN] = own
    out[1:, N_OWN:2 * N_OWN] = own[:-1]
    out[:-1, 2 * N_OWN:3 * N_OWN] = own[1:]
    starts, ends = first[:-1], first[1:] - 1
    out[starts, N_OWN:2 * N_OWN] = 0
    out[ends, 2 * N_OWN:3 * N_OWN] = 0
    out[starts, -2] = 1
    out[ends, -1] = 1
    return out


def _chains(first: np.ndarray) -> Iterator[np.ndarray]:
    """Groups of texts with similar numbers of lines, padded to PADDED lines at most (one text at least)."""
    counts = np.diff(first)
    order = np.argsort(counts, kind="stable")
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and counts[order[to]] * (to + 1 - at) <= PADDED:
            to += 1
        yield order[at:to]
        at = to


def forward_backward(node: np.ndarray, trans: np.ndarray, counts: np.ndarray,
                     weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of padded chains, and their pair marginals per transition summed with ``weight`` per chain.

    ``node``: (chains, lines, 2) scores, ``trans``: 2 x 2 scores; chain c has
    counts[c] lines. Both passes are scaled to sum 1 at every line.
    """
    c, t, _ = node.shape
    e = np.exp(np.clip(node - node.max(axis=2, keepdims=True), -60, 0))
    m = np.exp(np.clip(trans - trans.max(), -60, 0))
    alpha, beta = np.empty_like(e), np.ones_like(e)
    now = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    alpha[:, 0] = now
    for k in range(1, t):
        now = (now @ m) * e[:, k]
        now = now / now.sum(axis=1, keepdims=True)
        alpha[:, k] = now
    inner = np.arange(t)[None, :] < (counts - 1)[:, None]        # lines that another one follows
    for k in range(t - 2, -1, -1):
        out = (e[:, k + 1] * beta[:, k + 1]) @ m.T
        beta[:, k] = np.where(inner[:, k, None], out / out.sum(axis=1, keepdims=True), 1.0)
    marginal = alpha * beta
    marginal /= marginal.sum(axis=2, keepdims=True)
    pairs = np.zeros((2, 2))
    if weight is not None and t > 1:
        joint = alpha[:, :-1, :, None] * m * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
        joint *= (inner[:, :-1] * weight[:, None] / joint.sum(axis=(2, 3)))[..., None, None]
        pairs = joint.sum(axis=(0, 1))
    return marginal, pairs


def _padded(x: np.ndarray, first: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts = np.diff(first)[group]
    index = first[group][:, None] + np.minimum(np.arange(counts.max())[None, :], counts[:, None] - 1)
    inside = np.arange(counts.max())[None, :] < counts[:, None]
    return index, inside, counts


def good_lines(x: np.ndarray, first: np.ndarray, theta: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Probability of each line to be good."""
    score = x @ theta
    out = np.empty(len(x))
    for group in _chains(first):
        index, inside, counts = _padded(x, first, group)
        node = np.stack([np.zeros(index.shape), score[index]], axis=2)
        marginal, _ = forward_backward(node, trans, counts)
        out[index[inside]] = marginal[..., 1][inside]
    return out


def fit_chain(x: np.ndarray, first: np.ndarray, labels: np.ndarray, l2: float = 1e-3, steps: int = 100,
              rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Node weights and transitions of maximum conditional likelihood; both kinds of lines weigh alike in all."""
    counts = np.diff(first)
    lines = np.array([max(1, counts[labels == k].sum()) for k in (0, 1)])
    weight = 0.5 / lines[labels]                                 # of a chain, per line
    groups = [(g, *_padded(x, first, g)) for g in _chains(first)]
    params = np.zeros(N + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        theta, trans = params[:N], params[N:].reshape(2, 2)
        grad = np.zeros_like(params)
        score = x @ theta
        for group, index, inside, n in groups:
            node = np.stack([np.zeros(index.shape), score[index]], axis=2)
            w, y = weight[group], labels[group]
            marginal, pairs = forward_backward(node, trans, n, w)
            miss = (marginal[..., 1] - y[:, None]) * inside * w[:, None]
            grad[:N] += np.bincount(index[inside], miss[inside], len(x)) @ x
            true = [(w * (n - 1))[y == k].sum() for k in (0, 1)]     # a chain's true transitions are all k -> k
            grad[N:] += (pairs - np.diag(true)).ravel()
        grad += l2 * params
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        params = params - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return params[:N], params[N:].reshape(2, 2)


def long_text(text: str, table: np.ndarray, theta: np.ndarray, trans: np.ndarray) -> float:
    """Length-weighted mean of the lines' probabilities of a text of any number of lines, piece by piece.

    A line's features are reduced to what they add to its own score and its
    neighbours'. The chain's messages pass through the pieces as odds of good
    against bad, forwards and then backwards: 24 bytes a line are kept.
    """
    lines, seen = text.split("\n"), set()
    n = len(lines)
    score, long = np.zeros(n), np.zeros(n)
    weights = theta[:3 * N_OWN].reshape(3, N_OWN)
    for at in range(0, n, PIECE):
        own, size, _ = features_of_lines([lines[at:at + PIECE]], [seen], table)
        end = at + len(own)
        long[at:end] = np.maximum(size, 1)
        score[at:end] += own @ weights[0]
        after, before = own @ weights[1], own @ weights[2]              # to the line behind, to the line before
        to = min(end + 1, n)
        score[at + 1:to] += after[:to - at - 1]
        score[max(at - 1, 0):end - 1] += before[0 if at else 1:]
    score[0] += theta[-2]
    score[-1] += theta[-1]
    del lines, seen
    odds = np.exp(np.clip(score, -60, 60))
    (m00, m01), (m10, m11) = np.exp(np.clip(trans - trans.max(), -60, 0)).tolist()
    forward, r = score, 0.0                                                # reuses the scores' place
    for at in range(0, n, PIECE):
        out = []
        for k, e in enumerate(odds[at:at + PIECE].tolist()):
            r = e * (m01 + r * m11) / (m00 + r * m10) if at + k else e
            out.append(r)
        forward[at:at + PIECE] = out
    total, b = 0.0, 1.0
    for at in range((n - 1) // PIECE * PIECE, -1, -PIECE):
        out = []
        for e in odds[at:at + PIECE][::-1].tolist():
            out.append(b)
            q = e * b
            b = (m10 + m11 * q) / (m00 + m01 * q)
        both = forward[at:at + PIECE] * np.array(out[::-1])
        total += float((both / (1 + both) * long[at:at + PIECE]).sum())
    return total / float(long.sum())


def _means(p: np.ndarray, long: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of the lines' probabilities per text, weighted by length (an empty line counts as one character)."""
    weight = np.maximum(long, 1).astype(np.float64)
    return np.add.reduceat(p * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])


def train(documents: list[tuple[str, int]], share: float) -> dict | None:
    """Fits the chain on (text, quality) pairs; ``share``: of label 1 among all labels. None unless both kinds are there."""
    labels = np.array([int(y) for _, y in documents], np.int64)
    if not len(labels) or labels.min() == labels.max():
        return None
    table = class_table()
    own, long, first = line_features([t or "" for t, _ in documents], table)
    x = with_neighbours(own, first)
    theta, trans = fit_chain(x, first, labels)
    f = _means(good_lines(x, first, theta, trans), long, first)
    a, b = logistic(f, labels, share)
    return {"theta": theta, "trans": trans, "a": float(a), "b": float(b), "table": table}


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, max_good: int = 1500, max_bad: int = 1000,
                label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """Trains on at most ``max_good`` + ``max_bad`` labelled documents that meet ``learn``."""
    sample = labelled_sample(docs, labels, label_col, learn, {1: max_good, 0: max_bad}, id_col, text_col)
    share = labels.where(learn).agg(F.avg(col(label_col).cast("double"))).collect()[0][0]
    return train(sample, float(share if share is not None else 0.5))


def _score(model, keep: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in text_chunks(batches, text, SLICE):
            texts = batch.column(text).fill_null("").to_pylist()
            many = [i for i, t in enumerate(texts) if t.count("\n") >= PIECE]
            raw, long, first = line_features(["" if i in many else t for i, t in enumerate(texts)], own["table"])
            p = good_lines(with_neighbours(raw, first), first, own["theta"], own["trans"])
            mean = _means(p, long, first)
            for i in many:
                mean[i] = long_text(texts[i], own["table"], own["theta"], own["trans"])
            score = 1 / (1 + np.exp(-np.clip(own["a"] * mean + own["b"], -35, 35)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(mean), pa.array(score)],
                                             names=[*keep, "good_share", "quality"])
    return run


def score_quality(docs: DataFrame, model: dict | None, keep: list[str] | None = None, text_col: str = "text",
                  score_col: str = "quality") -> DataFrame:
    """The columns ``keep`` (default: all), good_share (length-weighted mean of the lines) and the probability ``score_col``."""
    keep = docs.columns if keep is None else keep
    if model is None:
        return docs.select(*[col(c) for c in keep], F.lit(0.0).alias("good_share"), F.lit(0.0).alias(score_col))
    names = [f"__c{i}" for i in range(len(keep))]
    typed = docs.select(*[col(c).alias(n) for c, n in zip(keep, names)], col(text_col).cast("string").alias("__text"))
    schema = T.StructType([f for f in typed.schema if f.name != "__text"]
                          + [T.StructField(c, T.DoubleType()) for c in ("good_share", "quality")])
    shared = docs.sparkSession.sparkContext.broadcast(model)          # of fixed size
    out = typed.mapInArrow(_score(shared, names, "__text"), schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "good_share", F.col("quality").alias(score_col))
