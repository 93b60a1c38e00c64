"""Toxicity by a gapped subsequence-kernel support vector machine with Nystroem landmarks.

The kernel compares two mentions (white-space separated tokens; a run of
single characters counts as one token) by their common subsequences of
three letters with up to two characters between neighbours, each gap
weighted down by ``DECAY``, normalised to 1 for equal mentions. Letters are
folded to their base letter; any other character only takes up a place, so
inserted dots, dashes or spaces and changed endings leave most of an
insult's subsequences in common.

Instances of a sentence are its mentions and its phrases: windows of two or
three neighbouring tokens, whose subsequences may cross the spaces. So an
insult of several words, or one that a space breaks, is found too. A phrase
counts where its decision value is above 0 and above those of the tokens and
phrases it consists of (else it adds nothing to them), and no token of it
counts by itself.

Nystroem: features of a mention are its kernel values with ``landmarks``
training mentions, whitened by the landmarks' own kernel matrix. A linear
SVM (squared hinge, Newton steps) is trained on them. Sentences are as bad as
their mentions; only documents are labelled, so training alternates
(multiple-instance SVM): the worst mentions of the toxic documents'
sentences are the positive examples, mentions of clean sentences the
negative ones, the hardest added each round. A mention of more than ``WIDTH``
characters stands by its worst window, as in scoring. Platt's method maps a
document's two worst decision values to a probability (a single accidental
likeness is weaker evidence than two).

Scoring needs no kernel matrix: the decision function is a sum over
landmarks, and the landmarks' subsequence weights add up to one table of
42^3 entries (the same number, rearranged), looked up for the subsequences
of each distinct mention of a task, with its exact norm. Phrases are mostly
distinct: running totals over the text give each one's value but for equal
subsequences in its norm, an upper bound, and only phrases that could be
among a document's two worst by that bound are worked out.

The model is fitted on a bounded sample of labelled documents
(``max_toxic``, ``max_clean``; chosen by a hash of the id) and every text is
scored whole where it lies; nothing is shuffled.

Defined cases: a null or empty text has no mention and gets the score of
one without a letter; documents without label are scored alike; repeated
rows are scored each; without labels of both kinds all scores are 0; an
empty table gives an empty result; other columns pass through unread.
"""

from __future__ import annotations

import re
import string
import sys
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion_ops.llm.common import col, give_back_memory, text_chunks
from medallion_ops.llm.learning import drop_worker_states, labelled_sample, logistic

SYMBOLS = 42                     # 0: no letter, 1-26: a-z, 27: start of a mention, 28-41: other letters
START = 27
GAP = 3                          # neighbours of a subsequence stand at most so far apart
DECAY = 0.6
COST = 3_000.0                  # of the SVM's errors
POWER = 0.5                      # a clean mention weighs as its document count to this power
COMMON = 3                       # clean documents that make a mention ordinary, unless toxic ones have it LIFT times as often
LIFT = 3.0                       # how much more often a first guess is in toxic documents
WIDTH = 24                       # longer mentions are read in windows of this width, half overlapping
MARKS = string.punctuation
CACHE = 200_000                  # distinct mentions a task remembers
SLICE = 1 << 20
PHRASE = (2, 3)                  # tokens of a phrase
BLOCK = 1 << 14                  # tokens whose phrases are bounded at once
STEPS = (8, 64, np.inf)          # how many of a document's phrases are worked out, by bound, until its score is settled
COMBOS = [(a, b, DECAY ** (a + b - 2)) for a in range(1, GAP + 1) for b in range(1, GAP + 1)]
ONES = array("I", [1, 1, 1]).tobytes()
SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
SENTENCE = re.compile(r"[.!?\n]+(?:\s|$)")
BREAK = re.compile(r"(?<=[.!?])\s+|\n\s+")        # the same, but the marks stay with their token


def symbol_table() -> np.ndarray:
    """Symbol of each character of the basic plane: a letter a-z, one of fourteen classes of other letters, or 0."""
    out = np.zeros(1 << 16, np.uint8)
    for c in range(1 << 16):
        x = chr(c).lower()[0]
        out[c] = ord(x) - 96 if "a" <= x <= "z" else 28 + ord(x) % 14 if x.isalpha() else 0
    return out


def mentions(text: str | None) -> list[str]:
    """The tokens of a text in lower case, spelled-out runs also as one token."""
    low = (text or "").lower()
    out = low.split()
    return out + spelled_out(low, out)


def spelled_out(low: str, tokens: list[str]) -> list[str]:
    """The runs of single characters in a lower-case text with these tokens; without three such in a row nothing is looked for."""
    if ONES not in array("I", map(len, tokens)).tobytes():
        return []
    return ["".join(run.split()) for run in SPACED.findall(low)]


def sentence_tokens(text: str | None) -> tuple[list[str], list[int]]:
    """The tokens of a text in lower case, and how many each sentence has."""
    parts = [s.split() for s in BREAK.split((text or "").lower())]
    return [w for p in parts for w in p], list(map(len, parts))


def distinct(tokens: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct tokens, and which of them each token is."""
    index: defaultdict[str, int] = defaultdict()
    index.default_factory = index.__len__
    which = np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens))
    return list(index), which


def windows(length: int) -> range:
    """Where the windows of a mention begin."""
    return range(0, max(1, length - 2) if length > WIDTH else 1, WIDTH // 2)


def codes(batch: list[str], table: np.ndarray, at: list[int] | None = None
          ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(indices into ``batch``, begins, matrix of symbols padded with 0) by groups of similar length; long mentions by windows.

    With ``at``, only the window of each mention that begins there.
    """
    lengths = np.fromiter(map(len, batch), np.int64, len(batch))
    points = np.frombuffer("".join(batch).encode("utf-32-le", "surrogatepass"), np.uint32)
    flat = np.concatenate([table[np.where(points < 1 << 16, points, 0)], np.zeros(WIDTH, np.uint8)])
    starts = np.cumsum(lengths) - lengths
    owner, begin, size = np.arange(len(batch)), starts, lengths
    if at is not None:
        begin = starts + np.array(at, np.int64)
        size = np.minimum(starts + lengths - begin, WIDTH)
    elif (lengths > WIDTH).any():
        more = [(i, starts[i] + b, min(WIDTH, lengths[i] - b)) for i in np.flatnonzero(lengths > WIDTH)
                for b in windows(int(lengths[i]))[1:]]
        if more:
            o, b, s = map(np.array, zip(*more))
            owner, begin, size = np.concatenate([owner, o]), np.concatenate([begin, b]), np.concatenate([size, s])
        size = np.minimum(size, WIDTH)
    lo = 0
    for hi in (5, 7, 9, 12, 16, WIDTH):
        here = np.flatnonzero((size > lo) & (size <= hi))
        for i in range(0, len(here), 4096):
            part = here[i:i + 4096]
            m = np.zeros((len(part), hi + 1), np.int32)
            m[:, 1:] = flat[begin[part][:, None] + np.arange(hi)]
            m[:, 1:][np.arange(hi)[None, :] >= size[part][:, None]] = 0
            m[:, 0] = np.where(begin[part] == starts[owner[part]], START, 0)
            yield owner[part], begin[part] - starts[owner[part]], m
        lo = hi


def subsequences(m: np.ndarray) -> np.ndarray:
    """Keys of the weighted subsequences of each row: triple code x 16 + combination, -1 for none."""
    out = []
    for n, (a, b, _) in enumerate(COMBOS):
        if m.shape[1] > a + b:
            x, y, z = m[:, :m.shape[1] - a - b], m[:, a:m.shape[1] - b], m[:, a + b:]
            key = ((x * SYMBOLS + y) * SYMBOLS + z) * 16 + n
            key[(x == 0) | (y == 0) | (z == 0)] = -1
            out.append(key)
    return np.concatenate(out, axis=1) if out else np.full((len(m), 1), -1, np.int32)


WEIGHTS = np.zeros(16)
WEIGHTS[:len(COMBOS)] = [w for _, _, w in COMBOS]


def weighted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, triple code, weight) of every distinct subsequence of every row."""
    keys = np.sort(keys, axis=1)
    row = np.repeat(np.arange(len(keys)), keys.shape[1])
    flat = keys.ravel()
    use = flat >= 0
    row, flat = row[use], flat[use]
    if not len(flat):
        return row, flat, np.empty(0)
    code = flat >> 4
    new = np.empty(len(code), bool)
    new[0] = True
    new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], code[at], np.add.reduceat(WEIGHTS[flat & 15], at)


def feature_columns(batch: list[str], table: np.ndarray, at: list[int] | None = None) -> np.ndarray:
    """Normalised subsequence vectors of the windows of a few mentions (first ones, or ``at``), as the columns of a dense matrix."""
    out = np.zeros((SYMBOLS ** 3, len(batch)), np.float32)
    for owner, _, m in codes(batch, table, at or [0] * len(batch)):
        row, code, w = weighted(subsequences(m))
        norm = np.sqrt(np.bincount(row, w * w, len(m)))
        out[code, owner[row]] = w / norm[row]
    return out


def landmark_features(batch: list[str], table: np.ndarray, at: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """``feature_columns`` without the rows of subsequences that no mention has: (row of each code, -1 for none; matrix)."""
    parts = []
    for owner, _, m in codes(batch, table, at):
        row, code, w = weighted(subsequences(m))
        norm = np.sqrt(np.bincount(row, w * w, len(m)))
        parts.append((code, owner[row], (w / norm[row]).astype(np.float32)))
    code, owner, value = map(np.concatenate, zip(*parts)) if parts else [np.empty(0, np.int64)] * 3
    place = np.full(SYMBOLS ** 3, -1, np.int32)
    used = np.unique(code)
    place[used] = np.arange(len(used))
    out = np.zeros((len(used) + 1, len(batch)), np.float32)        # the last row is that of all others
    out[place[code], owner] = value
    return place, out


def kernel(batch: list[str], base: np.ndarray, table: np.ndarray, at: list[int] | None = None,
           place: np.ndarray | None = None, white: np.ndarray | None = None) -> np.ndarray:
    """Kernel values of the windows of mentions (first ones, or ``at``) with the columns of ``base``.

    ``place`` has the row of ``base`` that a subsequence's code stands in, if
    not its own. With ``white`` the values are multiplied by it row by row and
    a column of ones follows, so that no second matrix is held.
    """
    out = np.zeros((len(batch), base.shape[1] if white is None else white.shape[1] + 1))
    if white is not None:
        out[:, -1] = 1
    for owner, _, m in codes(batch, table, at or [0] * len(batch)):
        for i in range(0, len(m), 256):
            row, code, w = weighted(subsequences(m[i:i + 256]))
            if len(row):
                first = np.flatnonzero(np.diff(row, prepend=-1))
                norm = np.sqrt(np.add.reduceat(w * w, first))[:, None]
                rows = base[code if place is None else place[code]]
                rows *= w[:, None].astype(np.float32)
                values = np.add.reduceat(rows, first) / norm
                if white is None:
                    out[owner[i + row[first]]] = values
                else:
                    out[owner[i + row[first]], :-1] = values @ white
    return out


def decisions(batch: list[str], table: np.ndarray, weights: np.ndarray, bias: float,
              ordinary: frozenset[str] = frozenset()) -> np.ndarray:
    """Decision value of each mention: normalised subsequence vector times the collapsed weights.

    ``ordinary`` mentions, known from clean documents, are -1 however like an insult they look.
    """
    out = np.full(len(batch), -np.inf)
    for owner, _, m in codes(batch, table):
        row, code, w = weighted(subsequences(m))
        dot = np.bincount(row, weights[code] * w, len(m))
        norm = np.sqrt(np.bincount(row, w * w, len(m)))
        np.maximum.at(out, owner, np.where(norm > 0, dot / np.where(norm > 0, norm, 1), 0.0) + bias)
    out = np.where(np.isfinite(out), out, bias)
    if ordinary:
        out[[i for i, w in enumerate(batch) if w.strip(MARKS) in ordinary]] = -1.0
    return out


class Phrases:
    """Finds the phrases that count under a decision function."""

    def __init__(self, table: np.ndarray, weights: np.ndarray, bias: float):
        self.table, self.weights, self.bias = table, weights, bias
        cube = np.indices((SYMBOLS,) * 3) > 0
        self.letters = cube.all(axis=0).ravel()                  # triples without a gap symbol
        # real part: weight, imaginary part: whether it counts in the norm; one gather fetches both
        self.triple = (np.where(self.letters, weights, 0) + 1j * self.letters).astype(np.complex64)

    def bounds(self, tokens: list[str], spans: list[tuple[np.ndarray, int]], lengths: np.ndarray | None = None) -> list[np.ndarray]:
        """Upper bounds of the decision values of phrases given as (first tokens, number of tokens)."""
        if lengths is None:
            lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        points = np.frombuffer((" ".join(tokens) + " " * 8).encode("utf-32-le", "surrogatepass"), np.uint32)
        flat = self.table[np.where(points < 1 << 16, points, 0)].astype(np.int32)
        starts = np.cumsum(lengths + 1) - lengths - 1
        n, before = len(flat) - 2 * GAP, starts - 1
        first_letter, second = flat * (SYMBOLS * SYMBOLS), flat * SYMBOLS
        stop = starts + lengths
        sums = []                                                # by distance from first to last letter
        all_value, all_square = np.zeros(n), np.zeros(n)
        cut, heads = np.zeros(len(tokens), np.complex64), np.zeros(len(tokens), np.complex64)
        for d in range(2, 2 * GAP + 1):
            both, head = np.zeros(n, np.complex64), np.zeros(len(tokens), np.complex64)
            ends, tail = first_letter[:n] + flat[d:n + d], START * SYMBOLS * SYMBOLS + flat[before + d]
            for a in range(max(1, d - GAP), min(GAP, d - 1) + 1):
                both += self.triple[ends + second[a:n + a]]
                head += self.triple[tail + second[before + a]]
            w = DECAY ** (d - 2)
            value, square = both.real * np.float32(w), both.imag * np.float32(w * w)
            both = value + 1j * square
            heads += head.real * np.float32(w) + 1j * (head.imag * np.float32(w * w))
            for j in range(1, d + 1):                            # what begins before a token's end and ends behind it
                cut += both[np.maximum(stop - j, 0)]
            all_value += value
            all_square += square
            sums.append((d, both, head.real * w, head.imag * (w * w)))
        run_value, run_square = (np.concatenate([[0.0], np.cumsum(x)]) for x in (all_value, all_square))
        out = []
        for first, k in spans:
            last = first + k - 1
            begin, end = starts[first], stop[last]
            dot = run_value[end] - run_value[begin] - cut.real[last] + heads.real[first]
            norm = run_square[end] - run_square[begin] - cut.imag[last] + heads.imag[first]
            best = np.maximum(dot, 0) / np.sqrt(np.maximum(norm - 1e-4, 1e-6))
            odd = np.flatnonzero((end - begin > WIDTH) | (end - begin < 2 * GAP))   # in windows, or shorter than some distance
            if len(odd):
                best[odd] = self._by_windows(sums, n, first[odd], begin[odd], end[odd])
            out.append(best + self.bias + 1e-4)
        return out

    def _by_windows(self, sums, n: int, first: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The same for phrases of any length, by the windows that ``codes`` reads."""
        more = np.maximum(0, -(-(end - begin - 2 - WIDTH // 2) // (WIDTH // 2))) * (end - begin > WIDTH)
        step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        owner = np.concatenate([np.arange(len(first)), np.repeat(np.arange(len(first)), more)])
        at = np.concatenate([np.zeros(len(first), np.int64), step * (WIDTH // 2)])
        s = begin[owner] + at
        e = np.minimum(end[owner], s + WIDTH)
        dot, norm = np.zeros(len(s)), np.zeros(len(s))
        place = np.minimum(s[:, None] + np.arange(WIDTH), n - 1)
        for d, both, head, head_square in sums:
            inside = place + d < e[:, None]
            here = both[place] * inside
            started = (at == 0) & (d <= e - s)
            dot += here.real.sum(axis=1, dtype=np.float64) + head[first[owner]] * started
            norm += here.imag.sum(axis=1, dtype=np.float64) + head_square[first[owner]] * started
        best = np.full(len(first), -np.inf)
        np.maximum.at(best, owner, np.maximum(dot, 0) / np.sqrt(np.maximum(norm - 1e-4, 1e-6)))
        return best

    def find(self, tokens: list[str], sizes: list[int], own: dict[str, float], raw: dict[str, float],
             least: float = 0.0) -> list[tuple[int, str, float]]:
        """(first token, phrase, decision value) of the phrases above ``least`` that count, none overlapping a worse one.

        ``sizes`` are the sentences' numbers of tokens. ``own`` has the value
        of every token as a mention; ``raw`` that of the ordinary ones by
        their likeness alone, which is all that a phrase is held against.
        """
        first, size, floor, _ = self.candidates(tokens, sizes, own, raw, np.full(len(tokens), least))
        return apart(self.counting(tokens, first, size, floor))

    def candidates(self, tokens: list[str], sizes: list[int], own: dict[str, float], raw: dict[str, float],
                   least: np.ndarray, words: tuple[list[str], np.ndarray] | None = None
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First token, number of tokens, what it must exceed and upper bound of each phrase that could count.

        ``least`` is by first token, ``words`` what ``distinct`` gives; the rest is as in ``find``.
        """
        index, which = words or distinct(tokens)
        size = np.fromiter(map(len, index), np.int64, len(index))[which]
        alone = np.fromiter(map(own.__getitem__, index), np.float64, len(index))
        like = np.maximum(alone, np.fromiter(map(raw.get, index, repeat(-np.inf)), np.float64, len(index)))[which]
        quiet, long = (alone <= 0)[which], size > 1
        sentence = np.repeat(np.arange(len(sizes)), sizes)
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0))]
        for at in range(0, len(tokens), BLOCK):
            to = min(len(tokens), at + BLOCK + max(PHRASE) - 1)
            spans, floors = [], []
            for k in PHRASE:
                n = max(0, min(BLOCK, to - at - k + 1))          # those that begin in the block
                fit, some, floor = sentence[at:at + n] == sentence[at + k - 1:at + k - 1 + n], np.zeros(n, bool), least[at:at + n]
                for j in range(at, at + k):
                    # a run of single characters is a mention already
                    fit &= quiet[j:j + n]
                    some |= long[j:j + n]
                    floor = np.maximum(floor, like[j:j + n])
                first = np.flatnonzero(fit & some)
                spans.append((first, k))
                floors.append(floor[first])
            if any(len(first) for first, _ in spans):
                for (first, k), floor, bound in zip(spans, floors, self.bounds(tokens[at:to], spans, size[at:to])):
                    keep = np.flatnonzero(bound > floor)
                    out.append((at + first[keep], np.full(len(keep), k), floor[keep], bound[keep]))
        return tuple(map(np.concatenate, zip(*out)))

    def counting(self, tokens: list[str], first: np.ndarray, size: np.ndarray, floor: np.ndarray) -> list[tuple[int, str, float]]:
        """(first token, phrase, decision value) of the candidates that count."""
        found, parts = [], {}
        for i, k, least in zip(first.tolist(), size.tolist(), floor.tolist()):
            text = " ".join(tokens[i:i + k])
            if text not in parts:
                parts[text] = [" ".join(tokens[i + j:i + j + m]) for m in PHRASE if m < k for j in range(k - m + 1)]
            found.append((i, text, least))
        if not found:
            return []
        batch = sorted(set(parts).union(*parts.values()))
        value = dict(zip(batch, decisions(batch, self.table, self.weights, self.bias).tolist()))
        own = {text: max([value[x] for x in inner], default=-np.inf) for text, inner in parts.items()}
        return [(i, text, value[text]) for i, text, least in found if value[text] > least and value[text] > own[text]]


def apart(phrases: list[tuple[int, str, float]]) -> list[tuple[int, str, float]]:
    """The phrases that overlap no worse one, given and returned as (first token, phrase, decision value)."""
    taken: set[int] = set()
    kept = []
    for i, text, f in sorted(phrases, key=lambda x: (-x[2], x[0])):
        places = range(i, i + text.count(" ") + 1)
        if taken.isdisjoint(places):
            taken.update(places)
            kept.append((i, text, f))
    return kept


def worst_windows(batch: list[str], table: np.ndarray, weights: np.ndarray, bias: float) -> list[tuple[str, int]]:
    """Each mention with the begin of its window of the highest decision value."""
    best, out = np.full(len(batch), -np.inf), np.zeros(len(batch), np.int64)
    for owner, begin, m in codes(batch, table):
        row, code, w = weighted(subsequences(m))
        norm = np.sqrt(np.bincount(row, w * w, len(m)))
        value = np.where(norm > 0, np.bincount(row, weights[code] * w, len(m)) / np.where(norm > 0, norm, 1), 0.0) + bias
        for k in np.lexsort((-begin, value)):                    # the worst one last, the first one among equals
            if (value[k], -begin[k]) > (best[owner[k]], -out[owner[k]]):
                best[owner[k]], out[owner[k]] = value[k], begin[k]
    return list(zip(batch, out.tolist()))


def linear_svm(ones: np.ndarray, y: np.ndarray, often: np.ndarray, c: float) -> tuple[np.ndarray, float]:
    """L2-regularised squared-hinge SVM by Newton steps on the active examples; the last column of ``ones`` is 1.

    An example weighs as ``often`` as it occurs; the classes weigh alike.
    Examples are gone through in blocks, so no weighted copy of them is held.
    """
    share = [often[y == k].sum() or 1.0 for k in (-1, 1)]
    cost = often / np.where(y > 0, share[1], share[0]) * c / 2
    w = np.zeros(ones.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    active = None
    for _ in range(30):
        now = y * (ones @ w) < 1
        if active is not None and (now == active).all():
            break
        active = now
        at = np.flatnonzero(now)
        left, right = ridge.copy(), np.zeros(len(w))
        for i in range(0, len(at), 1024):
            a, k = ones[at[i:i + 1024]], cost[at[i:i + 1024]]
            left += (a * k[:, None]).T @ a
            right += a.T @ (k * y[at[i:i + 1024]])
        w = np.linalg.solve(left, right)
    return w[:-1], float(w[-1])


def first_guess(toxic: list[list[str]], clean: list[list[str]]) -> tuple[list[list[str]], set[int]]:
    """The mentions of each toxic document that look toxic before any training, perhaps none, and hashes of the runs that show it.

    They hold a run of 4 to 6 characters (the start of the mention is one)
    that is in significantly more toxic than clean documents: z of 6 for
    equal shares and ten times as often, or z of 12 and ``LIFT`` times.
    """
    grams = lambda w: {hash(f" {w} "[i:i + n]) for n in (4, 5, 6) for i in range(max(1, len(w) + 3 - n))}
    mine = lambda words: np.fromiter(set().union(*map(grams, words)), np.int64)
    seen, often = np.unique(np.concatenate([np.empty(0, np.int64), *map(mine, toxic)]), return_counts=True)
    seen, often = seen[often >= 3], often[often >= 3]
    other = np.zeros(len(seen))
    for words in clean:
        other += np.isin(seen, mine(words), assume_unique=True)
    p, n = len(toxic), len(clean)
    share = (often + other) / (p + n)
    z = (often / p - other / n) / np.sqrt(share * (1 - share) * (1 / p + 1 / n) + 1e-12)
    sure = set(seen[(often / p >= np.where(z >= 12, LIFT, 10) * other / n) & (z >= 6)].tolist())
    looks = {w: not sure.isdisjoint(grams(w)) for w in {w for words in toxic for w in words}}
    return [[w for w in words if looks[w]] for words in toxic], sure


def guessed_window(mention: str, sure: set[int], step: int = 1) -> int:
    """Begin of the window that has most of the runs ``sure``; of the mention with dots between its letters if ``step`` is 2."""
    def runs(b):
        part = f" {mention} "[b // step + (b > 0):(b + WIDTH) // step + 2]
        return sum(hash(part[i:i + n]) in sure for n in (4, 5, 6) for i in range(len(part) + 1 - n))
    return max(windows(step * len(mention) - step + 1), key=lambda b: (runs(b), -b))


def first_phrases(toxic: list[tuple[list[str], list[int]]], clean: list[tuple[list[str], list[int]]],
                  guessed: set[str]) -> list[list[str]]:
    """The phrases of each toxic document that are in significantly more toxic than clean ones, as in ``first_guess``.

    Marks around the tokens do not count, and phrases with a ``guessed``
    mention are left to it.
    """
    def phrases(document):
        tokens, sizes = document
        bare, at = [w.strip(MARKS) for w in tokens], 0
        for n in sizes:
            for k in PHRASE:
                for i in range(at, at + n - k + 1):
                    yield " ".join(bare[i:i + k]), i, k
            at += n
    keys = lambda document: np.fromiter({hash(x) for x, _, _ in phrases(document)}, np.int64)
    none = [np.empty(0, np.int64)]
    seen, often = np.unique(np.concatenate(none + [keys(x) for x in toxic]), return_counts=True)
    seen, often = seen[often >= 3], often[often >= 3]
    usual = np.zeros(len(seen))
    for x in clean:
        usual += np.isin(seen, keys(x), assume_unique=True)
    p, n = len(toxic), len(clean)
    share = (often + usual) / (p + n)
    z = (often / p - usual / n) / np.sqrt(share * (1 - share) * (1 / p + 1 / n) + 1e-12)
    sure = set(seen[(often / p >= np.where(z >= 12, LIFT, 10) * usual / n) & (z >= 6)].tolist())
    return [sorted({" ".join(x[0][i:i + k]) for text, i, k in phrases(x)
                    if hash(text) in sure and guessed.isdisjoint(x[0][i:i + k])}) if sure else [] for x in toxic]


def train(documents: list[tuple[str, int]], landmarks: int = 400, rounds: int = 4, seed: int = 5) -> dict | None:
    """Fits the model on (text, toxic) pairs; None unless both kinds are there."""
    table = symbol_table()
    rng = np.random.default_rng(seed)
    said: dict[int, list[list[str]]] = {0: [], 1: []}
    told: dict[int, list[tuple[list[str], list[int]]]] = {0: [], 1: []}
    for text, label in documents:
        sentences = SENTENCE.split(text or "")
        words = Counter(sys.intern(w) for s in sentences for w in mentions(s))
        if words:
            parts = [list(map(sys.intern, s.lower().split())) for s in sentences]
            told[int(label)].append(([w for p in parts for w in p], list(map(len, parts))))
            said[int(label)].append([*words, *(w for w, n in words.items() if n > 1)])   # twice is as good as often
    toxic, clean = ([sorted(set(words)) for words in said[k]] for k in (1, 0))
    if not toxic or not clean:
        return None
    usual = Counter(w for words in clean for w in words)
    pool = sorted(usual)
    often_clean = np.log2(1.0 + np.array([usual[w] for w in pool]))
    negative = [pool[i] for i in rng.choice(len(pool), min(6000, len(pool)), replace=False)]
    hard: list[str] = []
    vocabulary = sorted({w for words in toxic for w in words})
    where = {w: i for i, w in enumerate(vocabulary)}
    blamed = Counter(w for words in toxic for w in {w.strip(MARKS) for w in words})
    plain = Counter(w for words in clean for w in {w.strip(MARKS) for w in words})
    ordinary = frozenset(w for w, n in plain.items()
                         if n >= COMMON and blamed[w] / len(toxic) < LIFT * n / len(clean))
    guess, sure = first_guess(toxic, clean)
    guess = [[w for w in words if w.strip(MARKS) not in ordinary] for words in guess]
    phrases = first_phrases(told[1], told[0], {w for words in guess for w in words})
    guess = [a + b for a, b in zip(guess, phrases)]
    worst = [w for words in guess for w in words]
    for i in rng.permutation(len(told[0]))[:2000]:               # a phrase of each of so many clean documents
        tokens, sizes = told[0][i]
        at = int(rng.integers(len(tokens)))
        phrase = " ".join(tokens[at:at + PHRASE[int(rng.integers(len(PHRASE)))]])
        if " " in phrase and phrase not in usual:
            usual[phrase] = 1
            negative.append(phrase)
    weights, bias = np.zeros(SYMBOLS ** 3), 0.0
    clear: list[tuple[str, int]] = []
    for r in range(rounds):
        counts = Counter(worst)
        if not counts:
            return None
        bad = list(counts)
        spelt = list(map(".".join, bad))                         # spelled out with dots as well
        if r:                                                    # a toxic mention stands by its worst window
            at, dotted = ([b for _, b in worst_windows(x, table, weights, bias)] for x in (bad, spelt))
        else:
            at, dotted = ([guessed_window(w, sure, step) for w in bad] for step in (1, 2))
        # no window of a clean mention is toxic: the first ones and, round by round, the worst ones
        clear = list(dict.fromkeys([*clear, *[(w, 0) for w in negative], *worst_windows(negative, table, weights, bias)]))
        marks = [w for w, _ in counts.most_common(landmarks * 5 // 8)]
        marks = list(dict.fromkeys([*marks, *hard[:landmarks // 4], *negative[:landmarks]]))[:landmarks]
        begin = dict(worst_windows(marks, table, weights, bias)) | {w: b for w, b in zip(bad, at)}
        place, base = landmark_features(marks, table, [begin[w] for w in marks])
        values, vectors = np.linalg.eigh((base.T @ base).astype(np.float64))
        good = values > 1e-6
        white = vectors[:, good] / np.sqrt(values[good])
        x = kernel([*bad, *spelt, *[w for w, _ in clear]], base, table, [*at, *dotted, *[b for _, b in clear]], place, white)
        y = np.concatenate([np.ones(2 * len(bad)), -np.ones(len(clear))])
        seen = np.array([counts[w] for w in bad], np.float64)
        often = np.concatenate([seen, 0.5 * seen, [usual[w] ** POWER for w, _ in clear]])
        w, bias = linear_svm(x, y, often, c=COST)
        del x
        weights = np.where(place >= 0, (base @ (white @ w).astype(np.float32))[place], 0).astype(np.float64)
        del base
        f = decisions(vocabulary, table, weights, bias, ordinary)
        g = decisions(pool, table, weights, bias, ordinary)
        value = dict(zip(vocabulary, f.tolist())) | dict(zip(pool, g.tolist()))
        forced = [w for w in value if w.strip(MARKS) in ordinary]
        raw = dict(zip(forced, decisions(forced, table, weights, bias).tolist()))
        finder = Phrases(table, weights, bias)
        best = [words[int(np.argmax(f[[where[w] for w in words]]))] for words in toxic]
        worst = [w for words in guess for w in words] + [w for w in best if f[where[w]] > 0]
        if r + 1 < rounds:
            silent = [x for words, w, x in zip(guess, best, told[1]) if not words and f[where[w]] <= 0]
            for more in phrases_of(finder, silent, value, raw):  # a phrase where no mention tells
                worst += [t for t, _ in more[:1]]
            mined = told[0][r::rounds - 1]                       # every clean document is gone through in one round
            likely = {t: v for more in phrases_of(finder, mined, value, raw) for t, v in more}
            for t in likely:
                usual[t] = max(1, usual[t])
            negative = list(dict.fromkeys([*negative, *sorted(likely, key=lambda t: (-likely[t], t))[:500]]))
            hard = [pool[i] for i in np.argsort(-(np.maximum(g, -0.5) + 0.5) * often_clean)[:500]]
            negative = list(dict.fromkeys([*negative, *hard]))
    every = told[1] + told[0]
    top = np.array([worst_two(words, value) for words in said[1] + said[0]])
    top = np.concatenate([worst_of(finder, every[a:b], top[a:b], value, raw) for a, b in by_block(every, 8 * BLOCK)])
    w = logistic(top, np.array([1] * len(toxic) + [0] * len(clean)))
    return {"weights": weights.astype(np.float32), "bias": bias, "w": w, "table": table,
            "ordinary": ordinary}


def by_block(documents: list[tuple[list[str], list[int]]], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``most`` tokens together, but for one document of more."""
    ends = np.cumsum([len(tokens) for tokens, _ in documents])
    at = 0
    while at < len(documents):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield at, to
        at = to


def phrases_of(finder: Phrases, documents: list[tuple[list[str], list[int]]], value: dict[str, float],
               raw: dict[str, float], least: float = 0.0) -> list[list[tuple[str, float]]]:
    """The phrases of each document that count, as often as they do, with their decision values; many documents at once."""
    out: list[list[tuple[str, float]]] = [[] for _ in documents]
    for at, to in by_block(documents, BLOCK):
        tokens = [w for x, _ in documents[at:to] for w in x]
        sizes = [n for _, x in documents[at:to] for n in x]
        ends = np.cumsum([len(x) for x, _ in documents[at:to]])
        for i, phrase, f in finder.find(tokens, sizes, value, raw, least):
            out[at + int(np.searchsorted(ends, i, side="right"))].append((phrase, f))
    return out


def worst_of(finder: Phrases, told: list[tuple[list[str], list[int]]], top: np.ndarray, value: dict[str, float],
             raw: dict[str, float], words: tuple[list[str], np.ndarray] | None = None) -> np.ndarray:
    """Decision values of the two worst mentions or phrases of documents, of which ``top`` has those of their mentions.

    A phrase that is no worse than the second of them changes neither, nor
    does it keep a worse one out. So phrases are gone through by their upper
    bounds, a document's highest ``STEPS`` first, until the second value is
    above all bounds that are left; the values are those of all phrases.
    """
    out = top.copy()
    tokens = [w for x, _ in told for w in x]
    lengths = [len(x) for x, _ in told]
    ends = np.cumsum(lengths)
    first, size, floor, bound = finder.candidates(tokens, [n for _, x in told for n in x], value, raw,
                                                  np.repeat(np.maximum(top[:, 1], 0.0), lengths), words)
    owner = np.searchsorted(ends, first, side="right")
    order = np.lexsort((-bound, owner))
    first, size, floor, bound, owner = (x[order] for x in (first, size, floor, bound, owner))
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)    # among its document's, by bound
    for step in STEPS:
        now = place < step
        more: dict[int, list[tuple[str, float]]] = {}
        for i, phrase, f in apart(finder.counting(tokens, first[now], size[now], floor[now])):
            more.setdefault(int(np.searchsorted(ends, i, side="right")), []).append((phrase, f))
        for k, phrases in more.items():
            out[k] = with_phrases(top[k].tolist(), phrases)
        left = place == step                                         # of each document the highest bound that is left
        again = np.isin(owner, owner[left][out[owner[left], 1] <= bound[left]])
        if not again.any():
            break
        first, size, floor, bound, owner, place = (x[again] for x in (first, size, floor, bound, owner, place))
    return out


def worst_two(words: list[str], value: dict[str, float]) -> tuple[float, float]:
    """Decision values of the two worst mentions; one that is said twice is both, and so is a single one."""
    top = sorted(map(value.__getitem__, words))[-2:]
    return top[-1], top[0]


def worst_tokens(lengths: list[int], values: np.ndarray, bias: float) -> np.ndarray:
    """``worst_two`` of the tokens of each document, given all their values; ``bias`` for a document without any."""
    lengths = np.array(lengths)
    out = np.full((len(lengths), 2), bias)
    some = np.flatnonzero(lengths)
    if len(some):
        begin = (np.cumsum(lengths) - lengths)[some]
        first = np.maximum.reduceat(values, begin)
        at = np.flatnonzero(values == np.repeat(first, lengths[some]))
        rest = values.copy()
        rest[at[np.searchsorted(at, begin)]] = -np.inf               # one of them, so an equal one stays
        second = np.maximum.reduceat(rest, begin)
        out[some] = np.column_stack([first, np.where(lengths[some] > 1, second, first)])
    return out


def with_phrases(top: list[float], phrases: list[tuple[str, float]]) -> list[float]:
    """The two worst values when phrases that count, as often as they do, are added to mentions."""
    return sorted([*top, *(f for _, f in phrases)])[:-3:-1]


def _score(model, keep: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_states()
        own = model.value
        known: dict[str, float] = {}
        raw: dict[str, float] = {}                       # of ordinary mentions, by their likeness alone
        finder = Phrases(own["table"], own["weights"], own["bias"])
        for batch in text_chunks(batches, text, SLICE):
            low = [(t or "").lower() for t in batch.column(text).to_pylist()]
            told = [sentence_tokens(t) for t in low]
            runs = {k: r for k, (t, (x, _)) in enumerate(zip(low, told)) if (r := spelled_out(t, x))}
            del low
            words, which = distinct([w for x, _ in told for w in x])
            every = [*words, *set().union(*runs.values()).difference(words)]
            new = [w for w in every if w not in known]
            if len(known) + len(new) > CACHE:
                known.clear()
                raw.clear()
                new = every
            if new:
                known.update(zip(new, decisions(new, own["table"], own["weights"], own["bias"], own["ordinary"]).tolist()))
                forced = [w for w in new if w.strip(MARKS) in own["ordinary"]]
                raw.update(zip(forced, decisions(forced, own["table"], own["weights"], own["bias"]).tolist()))
            values = np.fromiter(map(known.__getitem__, words), np.float64, len(words))[which]
            f = worst_tokens([len(x) for x, _ in told], values, own["bias"])
            for k, r in runs.items():
                f[k] = worst_two(told[k][0] + r, known)
            f = worst_of(finder, told, f, known, raw, (words, which))
            score = 1 / (1 + np.exp(-np.clip(f @ own["w"][:2] + own["w"][2], -35, 35)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score)],
                                             names=[*keep, "toxicity"])
        known.clear()
        give_back_memory()
    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, max_toxic: int = 1200, max_clean: int = 3000,
                 label_col: str = "toxic", **cols) -> dict | None:
    """Trains on at most ``max_toxic`` + ``max_clean`` labelled documents that meet ``learn``."""
    model = train(labelled_sample(docs, labels, label_col, learn, {1: max_toxic, 0: max_clean}, **cols))
    give_back_memory()
    return model


def score_toxicity(docs: DataFrame, model: dict | None, keep: list[str] | None = None,
                   text_col: str = "text", score_col: str = "toxicity") -> DataFrame:
    """The columns ``keep`` (default: all) and the probability ``score_col`` of each row."""
    keep = docs.columns if keep is None else keep
    if model is None:
        return docs.select(*[col(c) for c in keep], F.lit(0.0).alias(score_col))
    names = [f"__c{i}" for i in range(len(keep))]
    typed = docs.select(*[col(c).alias(n) for c, n in zip(keep, names)], col(text_col).cast("string").alias("__text"))
    schema = T.StructType([f for f in typed.schema if f.name != "__text"] + [T.StructField("toxicity", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)          # a table of fixed size
    out = typed.mapInArrow(_score(shared, names, "__text"), schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], F.col("toxicity").alias(score_col))
