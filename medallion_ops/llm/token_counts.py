"""Token counts of a unigram tokenizer without making tokens: a count-only Viterbi pass.

A text is split as the Metaspace pre-tokenizer does: every space opens a
chunk (the text's start does too, unless it is a space), and the space
stands as U+2581 before the chunk. In a chunk an Aho-Corasick automaton
enumerates all vocabulary pieces by their ends; dynamic programming keeps,
for each position, the best score of a segmentation that ends there and its
number of pieces, nothing else.

Ties are the tokenizer's: of equal scores the piece that starts first wins
(a later one must be strictly better). A character without a one-character
piece may be unknown, at the lowest score of the vocabulary less 10; unknown
neighbours are one token, or with ``byte_fallback`` (if the vocabulary has
the byte pieces) as many as bytes.

Chunks are independent, so each distinct chunk is computed once per Python
worker and slice; up to ``CACHE`` counts are remembered. Nothing is
shuffled: a document's count is summed where its text lies.

Defined cases: a null or empty text has no chunk and no token; a text of
spaces has a chunk for each; repeated rows are counted each; an empty table
gives an empty result; other columns pass through unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion_ops.llm.common import col, give_back_memory, text_chunks
from medallion_ops.llm.learning import worker_state

SPACE = "▁"
PENALTY = 10.0                 # an unknown character scores so much less than the worst piece
CACHE = 700_000                # distinct chunks that a Python worker remembers
LONGEST = 64                   # characters of a chunk that is remembered
SLICE = 4 << 20


def ranked_vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Pieces of a public sentencepiece file with log-probabilities by Zipf's law of their rank.

    The file's own scores are merge ranks; as a unigram model the r-th of n
    pieces gets probability 1 / (r H_n). No training takes place.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    total = math.log(sum(1 / r for r in range(1, n + 1)))
    return [(model.id_to_piece(i), -math.log(i + 1) - total) for i in range(n)]


class CountOnlyViterbi:
    """Piece counts of chunks under a unigram vocabulary; piece 0 is the unknown token."""

    def __init__(self, vocabulary: Sequence[tuple[str, float]], byte_fallback: bool = False):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        scores = {}
        for piece, score in vocabulary:
            if piece:
                scores[piece] = score          # a piece that comes twice counts as its last entry
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in scores if len(p) == 1}
        self.unknown = min(score for _, score in vocabulary) - PENALTY
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in scores for b in range(256))
        self.known: dict[str, tuple[int, int]] = {}

    def count(self, chunk: str) -> tuple[int, int]:
        """Number of tokens and of unknown characters in the best segmentation of ``chunk``."""
        n = len(chunk)
        best = [0.0] + [-math.inf] * n
        pieces, strange, open_ = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        single, done = self.single, 0
        matches = self.automaton.iter(chunk)
        match = next(matches, None)
        for end in range(1, n + 1):
            # all matches that end here come together, the longest first
            while match is not None and match[0] + 1 == end:
                size, score = match[1]
                value = score + best[end - size]
                if value > best[end]:
                    best[end], pieces[end], strange[end] = value, pieces[end - size] + 1, strange[end - size]
                    open_[end] = False
                match = next(matches, None)
            c = chunk[end - 1]
            if c not in single:
                value = self.unknown + best[end - 1]
                if value > best[end]:
                    best[end], strange[end], open_[end] = value, strange[end - 1] + 1, True
                    more = len(c.encode("utf-8", "surrogatepass")) if self.bytes else 0 if open_[end - 1] else 1
                    pieces[end] = pieces[end - 1] + more
            done = end
        return pieces[done], strange[done]

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunks, tokens and unknown characters of each text (a string array without nulls)."""
        words = pc.split_pattern(pc.replace_substring(texts, SPACE, " "), " ")
        flat, offsets = words.flatten(), words.offsets.to_numpy()
        coded = flat.dictionary_encode()
        of, vocabulary = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        known, found = self.known, []
        for c in vocabulary:
            x = known.get(c)
            if x is None:
                x = self.count(SPACE + c)
                if len(known) < CACHE and len(c) <= LONGEST:
                    known[c] = x
            found.append(x)
        each = np.array(found, np.int64).reshape(-1, 2)[of]
        each = np.concatenate([each, np.ones((len(of), 1), np.int64)], axis=1)
        first = pc.equal(flat.take(pa.array(offsets[:-1])), "").to_numpy(zero_copy_only=False)
        each[offsets[:-1][first]] = 0              # the empty chunk before a leading space, or of an empty text
        sums = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(each, axis=0)])[offsets]
        per = np.diff(sums, axis=0)
        return per[:, 2], per[:, 0], per[:, 1]


FOUND = [T.StructField(c, T.LongType()) for c in ("n_chunks", "n_tokens", "n_unknown")]


def _count(shared, keep: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, model = worker_state("token_counts"), None
        for batch in text_chunks(batches, text, SLICE):
            if model is None:
                tag, vocabulary, fallback = shared.value
                if getattr(held, "tag", None) != tag:
                    held.tag, held.model = tag, CountOnlyViterbi(vocabulary, fallback)
                model = held.model
            per = model.counts(batch.column(text).fill_null(""))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(x) for x in per]],
                                             names=[*keep, *[f.name for f in FOUND]])
        give_back_memory()
    return run


def count_tokens(docs: DataFrame, vocabulary: Sequence[tuple[str, float]], byte_fallback: bool = False,
                 keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (default: all), then n_chunks, n_tokens and n_unknown of each row's text.

    The vocabulary is broadcast: its size is the tokenizer's, not the data's.
    """
    keep = docs.columns if keep is None else keep
    names = [f"__c{i}" for i in range(len(keep))]
    typed = docs.select(*[col(c).alias(n) for c, n in zip(keep, names)], col(text_col).cast("string").alias("__text"))
    schema = T.StructType([f for f in typed.schema if f.name != "__text"] + FOUND)
    pieces = [(str(p), float(s)) for p, s in vocabulary]
    shared = docs.sparkSession.sparkContext.broadcast((hash((tuple(pieces), byte_fallback)), pieces, byte_fallback))
    out = typed.mapInArrow(_count(shared, names, "__text"), schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], *[f.name for f in FOUND])
