"""Personal data in texts: base patterns, and a linear-chain conditional random field for the forms they miss.

Base patterns (email, ip, card, phone) are matched leftmost and without
overlap, kind by kind; matches that fail their kind's check are dropped. They
are written so that no text takes more than linear time.

The chain labels the tokens of every sentence O, or begin or inside of a kind.
Its features are word shapes: runs of upper case, lower case, digits (with
their number) and single marks, of the whole token and without the marks at
its ends; the number of digits; and the words known from training; of the
token and of its two neighbours on either side. It is trained by maximum
conditional likelihood on a small labelled table (``example_sentences``, or any
table of texts and spans; at most ``max_sentences`` rows, chosen by a hash of
the text) and decoded by Viterbi for whole slices of texts at once in numpy.
So it finds addresses with ``[at]`` and ``dot``, numbers without ``+`` or with
other separators. What it finds must pass its kind's check in plain form
(four parts up to 255, Luhn's sum, number of digits) and must not touch a
base match; it adds spans and never removes one.

Sentences are lines, cut behind a token that ends with . ! or ? where the next
one begins with a capital. A token whose own score for O exceeds all others by
more than any transitions can win back is O on the best path, so a long
sentence is cut there, with the same result. Nothing is shuffled.

Defined cases: a null text is an empty one and has no spans; repeated rows are
searched each; without labelled spans only base matches are returned; texts of
any length are searched whole; an empty table gives an empty result; columns
that are not kept are not read.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion_ops.llm.common import col, give_back_memory, text_chunks

KINDS = ("email", "ip", "card", "phone")
STATES = 1 + 2 * len(KINDS)                 # O, then begin and inside of each kind
REACH = 2                                   # neighbours on either side whose features a token sees
SLICE = 2 << 20                             # bytes of text decoded at once
PADDED = 1 << 17                            # tokens, padding included, of the chains that are decoded together
SPAN = "struct<kind:string,start:bigint,end:bigint,base:boolean>"

# Base patterns. Digit runs are taken whole and quantifiers do not give back, which changes no match: what follows a run
# can never match inside it.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")             # without its second part: a digit run that is no address
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind and start."""
    out, done = [], 0
    for m in DOMAIN.finditer(text):                       # every address has one @: its name is what stands before it
        at = m.start()
        while at > done and text[at - 1] in LOCAL:
            at -= 1
        if at < m.start():
            out.append(("email", at, m.end()))
            done = m.end()
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text)
            if m[1] and all(map(_small, m.group().split(".")))]
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37:               # 19 digits have 18 separators at most
            digits = "".join(DIGITS.findall(m.group()))
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(DIGITS.findall(m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


AT = re.compile(r"\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+at\s+|\s*@\s*", re.I)
DOT = re.compile(r"\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\s+\.\s+", re.I)
PLAIN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
PLAIN_CARD = re.compile(r"[0-9](?:[ ./_-]{0,3}[0-9])+")
PLAIN_PHONE = re.compile(r"(?:\+|00|\()?[0-9](?:[ ()./-]{0,3}[0-9])+")
ENDS = " \t.,;:!?\"'<>#*&%$|=~^"


def plausible(kind: str, found: str) -> bool:
    """Whether a span of the chain holds personal data of its kind once it is written plainly."""
    digits = "".join(DIGITS.findall(found))
    if kind == "email":
        return len(found) <= 320 and PLAIN_EMAIL.fullmatch(DOT.sub(".", AT.sub("@", found))) is not None
    if kind == "ip":
        parts = DOT.sub(".", found).split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and _small(p) for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and PLAIN_CARD.fullmatch(found) is not None
    return 9 <= len(digits) <= 15 and len(set(digits)) > 2 and len(digits) < len(found) \
        and PLAIN_PHONE.fullmatch(found) is not None


# ------------------------------------------------------------------------- tokens and their features

SPACE, UPPER, LOWER, DIGIT, WIDE, SIGN = 0, 1, 2, 3, 4, 5      # classes; marks of their own follow
MARKS = "@.-+():,/_[]"
EDGE = [SIGN, *[6 + MARKS.index(c) for c in ".,:"]]           # marks that do not count at the ends of a token
CLASSES = 6 + len(MARKS)
COUNTS = np.array([0, 1, 2, 3, 4, 5, 5, 6, 6, 7, 7, 8, 8] + [9] * 7 + [10], np.int64)     # groups of numbers of digits
TABLES = ("shape", "core", "word", "digits")


def class_table() -> tuple[np.ndarray, np.ndarray]:
    """Class of each character of the basic plane, and its lower case (others count as signs)."""
    kind, low = np.full(1 << 16, SIGN, np.uint8), np.arange(1 << 16, dtype=np.uint32)
    for c in range(1 << 16):
        x = chr(c)
        if 0xD800 <= c < 0xE000:
            continue
        if x.isspace():
            kind[c] = SPACE
        elif x in MARKS:
            kind[c] = 6 + MARKS.index(x)
        elif "0" <= x <= "9":
            kind[c] = DIGIT
        elif x.isalpha():
            kind[c] = WIDE if c >= 0x2E80 else UPPER if x.isupper() else LOWER
            low[c] = ord(x.lower()[0])
    return kind, low


def _powers(n: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


PLACES = 32                                                   # runs and letters beyond share one multiplier
RUN_POWER, CORE_POWER, WORD_POWER = (_powers(PLACES, s) for s in (1, 2, 3))


def tokenize(texts: list[str], table: tuple[np.ndarray, np.ndarray]) -> dict[str, np.ndarray]:
    """Begin, end, document, sentence and feature values of every token of many texts.

    Places count characters of the texts joined by line breaks; ``offset`` has
    where each text begins.
    """
    kinds, low = table
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(points < 1 << 16, points, 0xFFFF)
    kind = kinds[points]
    offset = np.cumsum([0, *[len(t) + 1 for t in texts]])
    word, wide = kind != SPACE, kind == WIDE
    first = word.copy()
    first[1:] &= ~word[:-1] | (wide[1:] != wide[:-1])          # scripts without spaces are tokens of their own
    last = word.copy()
    last[:-1] &= ~word[1:] | (wide[1:] != wide[:-1])
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    n = len(begin)
    out = {"offset": offset, "begin": begin, "end": end, "document": np.searchsorted(offset[1:], begin, side="right")}
    if not n:
        return out | {"sentence": begin, **{c: begin for c in TABLES}}
    line = np.cumsum((points == 10) | (points == 13))[begin]
    stop = np.isin(points[end - 1], [ord(c) for c in ".!?"])
    new = np.ones(n, bool)
    new[1:] = (line[1:] != line[:-1]) | (stop[:-1] & (kind[begin[1:]] == UPPER))
    out["sentence"] = np.cumsum(new) - 1

    token = np.cumsum(first) - 1                               # of each character, where it is of a word
    run = first.copy()
    run[1:] |= word[1:] & (kind[1:] != kind[:-1])
    at = np.flatnonzero(run)
    size = np.diff(np.append(np.cumsum(word)[at] - 1, word.sum()))
    own, what = token[at], kind[at].astype(np.uint64)
    code = what * np.uint64(64) + np.where(what == DIGIT, np.minimum(size, 20), np.where(what > SIGN, np.minimum(size, 3), 1)
                                           ).astype(np.uint64)
    heads = np.flatnonzero(np.diff(own, prepend=-1))
    nth = np.arange(len(at)) - heads[own]
    many = np.diff(np.append(heads, len(at)))
    side = np.isin(what, EDGE)
    bare = side & ((nth == 0) | (nth == many[own] - 1))
    skipped = (side[heads] & (many > 0)).astype(np.int64)
    spread = (code + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    spread ^= spread >> np.uint64(29)
    place = np.minimum(nth, PLACES - 1)
    out["shape"] = np.add.reduceat(spread * RUN_POWER[place], heads)
    inner = np.clip(nth - skipped[own], 0, PLACES - 1)
    out["core"] = np.add.reduceat(np.where(bare, np.uint64(0), spread * CORE_POWER[inner]), heads)

    letter = (kind == UPPER) | (kind == LOWER)
    places = np.cumsum(letter)
    since = places - 1 - (places[begin] - letter[begin])[np.maximum(token, 0)]
    value = np.where(letter, (low[points].astype(np.uint64) + np.uint64(7)) * WORD_POWER[np.clip(since, 0, PLACES - 1)], np.uint64(0))
    edges = np.empty(2 * n, np.int64)
    edges[0::2], edges[1::2] = begin, end
    within = lambda x: np.add.reduceat(np.append(x, x.dtype.type(0)), edges)[0::2]
    out["word"] = within(value)
    out["digits"] = COUNTS[np.minimum(within((kind == DIGIT).astype(np.int64)), 20)]
    return out


def feature_ids(tokens: dict[str, np.ndarray], known: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Row of each token's value in its feature table; the last row is of values not met in training."""
    out = {}
    for name in TABLES:
        if name == "digits":
            out[name] = tokens[name].astype(np.int64)
            continue
        at = np.minimum(np.searchsorted(known[name], tokens[name]), max(len(known[name]) - 1, 0))
        same = known[name][at] == tokens[name] if len(known[name]) else np.zeros(len(tokens[name]), bool)
        out[name] = np.where(same, at, len(known[name]))
    return out


def _neighbour(sentence: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(which of the tokens ``at`` have a neighbour ``step`` places on in their sentence, that neighbour)."""
    there = at + step
    there = np.clip(there, 0, len(sentence) - 1)
    has = np.flatnonzero((sentence[there] == sentence[at]) & (there == at + step))
    return has, there[has]


def _kinds_of_tokens(ids: dict[str, np.ndarray], weights: dict[str, np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The kind of each token (tokens of equal features are one) and, per place of a neighbour, each kind's scores."""
    key = np.zeros(len(ids["shape"]), np.int64)
    for name in TABLES:
        key = key * weights[name].shape[1] + ids[name]
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    return which, [sum(weights[name][i][ids[name][first]] for name in TABLES) for i in range(2 * REACH + 1)]


def emissions(which: np.ndarray, rows: list[np.ndarray], sentence: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Scores of the states of the tokens ``at``."""
    out = np.zeros((len(at), STATES))
    for row, step in zip(rows, range(-REACH, REACH + 1)):
        has, there = _neighbour(sentence, at, step)
        out[has] += row[which[there]]
    return out


def least_lead(which: np.ndarray, rows: list[np.ndarray], sentence: np.ndarray) -> np.ndarray:
    """By how much each token's score for O exceeds all others at least."""
    out = np.zeros(len(which))
    for row, step in zip(rows, range(-REACH, REACH + 1)):
        lead = (row[:, 0] - row[:, 1:].max(axis=1))[which]
        a, b = max(0, -step), max(0, step)
        n = len(which) - a - b
        if n > 0:
            out[a:a + n] += lead[b:b + n] * (sentence[a:a + n] == sentence[b:b + n]) if step else lead
    return out


# ------------------------------------------------------------------------- the chain

def _groups(first: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chains, index of their tokens, which of these are not padding) of chains of similar length."""
    order = np.argsort(counts, kind="stable")
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and counts[order[to]] * (to + 1 - at) <= PADDED:
            to += 1
        group = order[at:to]
        place = np.arange(counts[group].max())[None, :]
        yield group, first[group][:, None] + np.minimum(place, counts[group][:, None] - 1), place < counts[group][:, None]
        at = to


def viterbi(score: np.ndarray, first: np.ndarray, counts: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best states of chains that begin and end in O; of equal paths the one of smaller states from the end on."""
    out = np.zeros(len(score), np.int8)
    for group, index, inside in _groups(first, counts):
        now = trans[0] + score[index[:, 0]]
        back = np.zeros((index.shape[1], len(group), STATES), np.int8)
        for t in range(1, index.shape[1]):
            step = now[:, :, None] + trans                     # chain, from, to
            back[t] = step.argmax(axis=1)
            moved = step.max(axis=1) + score[index[:, t]]
            now = np.where(inside[:, t, None], moved, now)
        state = (now + trans[:, 0]).argmax(axis=1)
        rows = np.arange(len(group))
        for t in range(index.shape[1] - 1, -1, -1):
            out[index[inside[:, t], t]] = state[inside[:, t]]
            state = np.where(inside[:, t], back[t, rows, state], state)
    return out


def win_back(trans: np.ndarray) -> float:
    """The most that two transitions can gain by a state other than O between any neighbours."""
    best = -np.inf
    for k in range(1, STATES):
        best = max(best, float((trans[:, k][:, None] + trans[k] - trans[:, 0][:, None] - trans[0]).max()))
    return best


def decode(ids: dict[str, np.ndarray], sentence: np.ndarray, model: dict, cut: bool = True) -> np.ndarray:
    """Viterbi states of every token; with ``cut``, sentences are cut at tokens that can only be O."""
    trans = model["trans"]
    which, rows = _kinds_of_tokens(ids, model["weights"])
    out = np.zeros(len(sentence), np.int8)
    open_ = np.flatnonzero(least_lead(which, rows, sentence) <= win_back(trans) + 1e-9) if cut else np.arange(len(sentence))
    if len(open_):
        new = np.ones(len(open_), bool)
        new[1:] = (open_[1:] != open_[:-1] + 1) | (sentence[open_[1:]] != sentence[open_[:-1]])
        first = np.flatnonzero(new)
        out[open_] = viterbi(emissions(which, rows, sentence, open_), first, np.diff(np.append(first, len(open_))), trans)
    return out


def _marginals(score: np.ndarray, index: np.ndarray, inside: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: state probabilities (chains x tokens x states) and expected transitions, with O at both ends."""
    c, t = index.shape
    e = np.exp(score[index] - score[index].max(axis=2, keepdims=True))
    m = np.exp(trans)
    alpha, beta = np.empty_like(e), np.empty_like(e)
    now = m[0] * e[:, 0]
    alpha[:, 0] = now = now / now.sum(axis=1, keepdims=True)
    for k in range(1, t):
        now = (now @ m) * e[:, k]
        alpha[:, k] = now = now / now.sum(axis=1, keepdims=True)
    ends = inside & ~np.concatenate([inside[:, 1:], np.zeros((c, 1), bool)], axis=1)
    after = np.repeat(m[:, 0][None, :], c, axis=0)
    beta[:, t - 1] = after
    for k in range(t - 2, -1, -1):
        on = (e[:, k + 1] * beta[:, k + 1]) @ m.T
        beta[:, k] = np.where(ends[:, k, None], after, on / on.sum(axis=1, keepdims=True))
    p = alpha * beta
    p /= p.sum(axis=2, keepdims=True)
    pairs = np.zeros((STATES, STATES))
    if t > 1:
        joint = alpha[:, :-1, :, None] * m * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
        joint *= (inside[:, 1:] / joint.sum(axis=(2, 3)))[..., None, None]
        pairs += joint.sum(axis=(0, 1))
    pairs[0] += p[:, 0].sum(axis=0)
    pairs[:, 0] += p[ends].sum(axis=0)
    return p, pairs


def true_states(tokens: dict[str, np.ndarray], spans: list[list[tuple[str, int, int]]]) -> np.ndarray:
    """Labelled state of every token: begin or inside of the span that its characters share."""
    out = np.zeros(len(tokens["begin"]), np.int64)
    for i, mine in enumerate(spans):
        for kind, start, end in mine:
            start, end = start + tokens["offset"][i], end + tokens["offset"][i]
            hit = np.flatnonzero((tokens["begin"] < end) & (tokens["end"] > start))
            out[hit] = 2 + 2 * KINDS.index(kind)
            out[hit[:1]] -= 1
    return out


def train(sentences: list[tuple[str, list[tuple[str, int, int]]]], steps: int = 100, l2: float = 0.02,
          rate: float = 0.15) -> dict | None:
    """Fits the chain on (text, spans) pairs by conditional likelihood (Adam); None without any span."""
    sentences = [(t or "", [s for s in spans if s[0] in KINDS]) for t, spans in sentences]
    if not any(spans for _, spans in sentences):
        return None
    table = class_table()
    tokens = tokenize([t for t, _ in sentences], table)
    truth = true_states(tokens, [s for _, s in sentences])
    known = {}
    for name in TABLES[:-1]:
        value, often = np.unique(tokens[name], return_counts=True)
        known[name] = value[often >= 2] if name != "word" else value[(often >= 4) & (value > 0)]
    ids, sentence = feature_ids(tokens, known), tokens["sentence"]
    size = {name: len(known[name]) + 1 if name in known else int(COUNTS.max()) + 1 for name in TABLES}
    weights = {name: np.zeros((2 * REACH + 1, n, STATES)) for name, n in size.items()}
    trans = np.zeros((STATES, STATES))
    begin = np.flatnonzero(np.diff(sentence, prepend=-1))
    counts = np.diff(np.append(begin, len(sentence)))
    groups = list(_groups(begin, counts))
    seen = np.zeros((STATES, STATES))
    inner = sentence[1:] == sentence[:-1]
    np.add.at(seen, (truth[:-1][inner], truth[1:][inner]), 1)
    np.add.at(seen, (0, truth[begin]), 1)
    np.add.at(seen, (truth[begin + counts - 1], 0), 1)
    right = np.zeros((len(truth), STATES))
    right[np.arange(len(truth)), truth] = 1
    every = np.arange(len(sentence))
    near = [_neighbour(sentence, every, step) for step in range(-REACH, REACH + 1)]
    params = [*weights.values(), trans]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        score = emissions(*_kinds_of_tokens(ids, weights), sentence, every)
        miss, pairs = np.zeros_like(right), np.zeros_like(trans)
        for _, index, inside in groups:
            p, more = _marginals(score, index, inside, trans)
            miss[index[inside]] = p[inside]
            pairs += more
        miss -= right
        grads = []
        for name in TABLES:
            g = l2 * weights[name]
            for i, (here, there) in enumerate(near):
                np.add.at(g[i], ids[name][there], miss[here])
            grads.append(g)
        grads.append(pairs - seen + l2 * trans)
        for p, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return {"known": known, "weights": weights, "trans": trans, "table": table}


def chain_spans(texts: list[str], model: dict) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) that the chain finds in each text and that pass their kind's check."""
    tokens = tokenize(texts, model["table"])
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if not len(tokens["begin"]):
        return out
    state = decode(feature_ids(tokens, model["known"]), tokens["sentence"], model)
    hit = np.flatnonzero(state)
    if not len(hit):
        return out
    kind = (state[hit] + 1) // 2
    new = np.ones(len(hit), bool)
    new[1:] = ((hit[1:] != hit[:-1] + 1) | (tokens["sentence"][hit[1:]] != tokens["sentence"][hit[:-1]])
               | (kind[1:] != kind[:-1]) | (state[hit[1:]] % 2 == 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hit)) - 1
    for b, e in zip(first, last):
        i = int(tokens["document"][hit[b]])
        start, end = (int(tokens[c][hit[k]] - tokens["offset"][i]) for c, k in (("begin", b), ("end", e)))
        name, text = KINDS[int(kind[b]) - 1], texts[i]
        while start < end and text[start] in ENDS:
            start += 1
        while start < end and (text[end - 1] in ENDS or (text[end - 1] in ")]" and not set("([") & set(text[start:end]))):
            end -= 1
        if start < end and plausible(name, text[start:end]):
            out[i].append((name, start, end))
    return out


def all_spans(texts: list[str], model: dict | None) -> list[list[tuple[str, int, int, bool]]]:
    """(kind, start, end, base) of each text, by kind and start: base matches, and what the chain adds clear of them."""
    found = chain_spans(texts, model) if model else [[] for _ in texts]
    out = []
    for text, more in zip(texts, found):
        base = base_spans(text)
        spans = [(*s, True) for s in base]
        spans += [(k, b, e, False) for k, b, e in more if all(e <= x or b >= y for _, x, y in base)]
        out.append(sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))
    return out


# ------------------------------------------------------------------------- the labelled table

def example_sentences(n: int = 800, seed: int = 11) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """A small labelled table made by rule: invented sentences with personal data in plain and disguised forms, and
    sentences with numbers and marks that are none."""
    rnd = random.Random(seed)
    syllables = "an en er on th re he in ed nd ha at es or le la de un ich der que ción mo ta pa ró ü ß é".split()
    plain = lambda: "".join(rnd.choices(syllables, k=rnd.randint(1, 4)))
    word = lambda: rnd.choices([str.lower, str.title, str.upper], [16, 3, 1])[0](plain()) + rnd.choices(
        ["", ",", ";", "&&&", "!"], [24, 2, 1, 1, 1])[0]
    digits = lambda k: "".join(rnd.choices("0123456789", k=k))

    def email() -> str:
        name = rnd.choice([f"{plain()}.{plain()}", plain() + digits(2), f"{plain()}.{digits(2)}", plain()])
        host, top = rnd.choice([plain(), f"mail{digits(1)}", f"{plain()}-{plain()}"]), rnd.choice(["com", "org", "net", "de", "example.com"])
        name, host = (x.encode("ascii", "ignore").decode().strip(".-") or "ab" for x in (name, host))
        at = rnd.choice(["@", "@", " at ", " [at] ", "[at]", "(at)", " (at) ", " @ "])
        dot = "." if at in ("@", " @ ") else rnd.choice([" dot ", " dot ", "[dot]", " [dot] ", "(dot)", "."])
        return name + at + (host + "." + top).replace(".", dot)

    def ip() -> str:
        return rnd.choice([".", ".", ".", "[.]", "(.)", " dot ", " . "]).join(str(rnd.randint(0, 255)) for _ in range(4))

    def card() -> str:
        body = rnd.choice("3456") + digits(14)
        body += next(c for c in "0123456789" if luhn(body + c))
        return rnd.choice(["", "", " ", "-", ".", "/", " - "]).join(body[i:i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return rnd.choice([f"+1 ({a}) {b}-{c}", f"+{rnd.randint(20, 99)} {digits(2)} {digits(3)} {digits(4)}", f"({a}) {b}-{c}",
                           f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"0{digits(3)}/{digits(6)}", f"00{digits(2)} {a} {b} {c}"])

    def other() -> str:
        return rnd.choice([
            f"{rnd.randint(1900, 2030)}", f"{rnd.randint(1, 12):02}:{digits(2)}", f"20{digits(2)}-0{rnd.randint(1, 9)}-1{digits(1)}",
            f"${digits(3)}.{digits(2)}", f"{digits(1)}.{digits(1)}.{digits(1)}", f"v{digits(1)}.{digits(2)}", digits(5), digits(8),
            digits(12), digits(16), digits(24), f"{digits(3)} {digits(3)}", "".join(rnd.choices("0123456789abcdef", k=32)),
            f"{digits(1)},{digits(3)},{digits(3)}", f"§{digits(2)}", f"#{digits(4)}", f"{word()}_{digits(3)}", f"{word()}*** {word()}###",
            f"token = \"{digits(4)}{word()}\"", f"| {digits(2)} | {digits(3)} |", f"{word()}&&& {word()}%%%", "at dot",
            f"https://{word()}.example.com/{word()}", f"@{word()}", f"{word()} at {word()}", f"{digits(4)} {digits(4)}"])

    led = {"email": ["write to", "email:", "mail"], "ip": ["from", "host", "ip"], "card": ["card", "card no.", "visa"],
           "phone": ["call", "phone:", "tel."]}
    make = {"email": email, "ip": ip, "card": card, "phone": phone}
    out = []
    for i in range(n):
        parts, spans, at = [], [], 0

        def say(text: str) -> int:
            nonlocal at
            parts.append(text)
            at += len(text) + 1
            return at - len(text) - 1
        for _ in range(rnd.randint(1, 8)):
            say(word())
        if rnd.random() < 0.7 and len(parts[0].title()) == len(parts[0]):
            parts[0] = parts[0].title()
        if i % 3:
            for kind in rnd.sample(KINDS, rnd.randint(1, 2)):
                if rnd.random() < 0.4:
                    say(rnd.choice(led[kind]))
                value = make[kind]()
                start = say(value + rnd.choice(["", "", "", ",", "###"]))
                spans.append((kind, start, start + len(value)))
                for _ in range(rnd.randint(1, 4)):
                    say(word())
        else:
            for _ in range(rnd.randint(0, 3)):
                say(other())
                for _ in range(rnd.randint(0, 3)):
                    say(word())
        parts[-1] += rnd.choice([".", "", "!"])
        out.append((" ".join(parts), spans))
    return out


LABELLED = "text string, spans array<struct<kind:string,start:bigint,end:bigint>>"


def example_table(spark: SparkSession, n: int = 800, seed: int = 11) -> DataFrame:
    """``example_sentences`` as a table: text, spans."""
    return spark.createDataFrame(example_sentences(n, seed), LABELLED)


def fit_pii(labelled: DataFrame, text_col: str = "text", spans_col: str = "spans", max_sentences: int = 2000) -> dict | None:
    """Trains on at most ``max_sentences`` rows of a table of texts and spans (kind, start, end in characters)."""
    rows = labelled.select(col(text_col).cast("string").alias("text"), col(spans_col).alias("spans")).where("text is not null")
    rows = rows.orderBy(F.xxhash64("text"), "text").limit(max_sentences).collect()
    return train([(r["text"], [(s["kind"], s["start"], s["end"]) for s in r["spans"] or []]) for r in rows])


def _find(model, keep: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in text_chunks(batches, text, SLICE):
            found = all_spans(batch.column(text).fill_null("").to_pylist(), model.value)
            rows = [[dict(zip(("kind", "start", "end", "base"), s)) for s in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(rows, span)], names=[*keep, "__spans"])
        give_back_memory()
    return run


def find_pii(docs: DataFrame, model: dict | None, keep: list[str] | None = None, text_col: str = "text",
             spans_col: str = "spans") -> DataFrame:
    """The columns ``keep`` (default: all) and ``spans_col``: array of (kind, start, end, base), by kind and start.

    Places count characters, the end exclusive. A kept column of that name is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != spans_col]
    names = [f"__c{i}" for i in range(len(keep))]
    typed = docs.select(*[col(c).alias(n) for c, n in zip(keep, names)], col(text_col).cast("string").alias("__text"))
    schema = T.StructType([f for f in typed.schema if f.name != "__text"]
                          + [T.StructField("__spans", T._parse_datatype_string(f"array<{SPAN}>"))])
    shared = docs.sparkSession.sparkContext.broadcast(model)          # bounded by the labelled sentences
    out = typed.mapInArrow(_find(shared, names, "__text"), schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], F.col("__spans").alias(spans_col))


def mask_pii(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by its kind in angle brackets; of spans that meet the first counts."""
    found = find_pii(docs, model, text_col=text_col, spans_col="__found")
    ordered = F.array_sort(F.transform("__found", lambda s: F.struct(s["start"].alias("b"), (-s["end"]).alias("e"), s["kind"].alias("k"))))
    text = col(text_col).cast("string")
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))
    step = lambda a, s: F.when(s["b"] >= a["at"], F.struct(
        F.concat(a["done"], F.substr(text, a["at"].cast("int") + 1, (s["b"] - a["at"]).cast("int")), F.lit("<"), s["k"], F.lit(">"))
        .alias("done"), (-s["e"]).alias("at"))).otherwise(a)
    end = lambda a: F.concat(a["done"], F.substr(text, a["at"].cast("int") + 1))
    masked = F.when(F.size("__found") > 0, F.aggregate(ordered, start, step, end)).otherwise(text)
    return found.withColumn(text_col, masked).select(*[col(c) for c in docs.columns])
