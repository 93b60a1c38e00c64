"""Token ids in binary files: one zstandard frame per document and a trailing seek table.

File format, in order:

* a frame per document: its ids as little-endian unsigned 32-bit integers,
  compressed on its own, with zstandard's content checksum;
* a skippable frame (magic 0x184D2A5D) with the documents' ids: a byte per
  document (1: it has an id) and then an int64 each;
* the seek table of the public zstandard seekable format: a skippable frame
  (magic 0x184D2A5E) with compressed size, decompressed size and checksum
  (low 32 bits of the XXH64 of the decompressed bytes) per frame, the id
  frame included (0 decompressed bytes), and a 9-byte footer.

Any zstandard reader reads the whole file as one stream of ids; a reader
that knows the table reads and decompresses only the frames it wants.

Writing: the documents are range-partitioned by id (ties by a hash of the
text), sorted, and each partition becomes one file under a name that no
other task attempt uses. A file counts only once its row is in the stored
manifest, so files of lost or repeated attempts are never read. Files go
through ``pyarrow.fs`` to the shared folder, whatever store that is.

The tokenizers library encodes each distinct space-led chunk once per
Python worker: a byte-level BPE whose pre-tokenizer starts a new piece at
every space before a non-space gives the same ids for a text as for its
chunks. At most ``CACHE`` chunks are remembered, so memory stays bounded.
A text that holds the string of an added token (``<|endoftext|>``) is encoded
whole, with the library's defaults: the string becomes the token's id, and
the space around it is cut otherwise than at chunk borders.

Defined cases: null text is the empty text (its ids are just the end id);
a null id sorts first and is stored as such; repeated rows are documents of
their own; an empty table gives no file. Only the named columns are read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion_ops.llm.common import col, give_back_memory, text_chunks
from medallion_ops.llm.learning import worker_state
from medallion_ops.session import materialize, scratch_path

ID_MAGIC, TABLE_MAGIC, SEEKABLE = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
CACHE = 450_000                # distinct chunks that a Python worker remembers, about 200 bytes each
LONGEST = 64                   # characters of a chunk that is remembered
SLICE = 6 << 20                # bytes of text encoded at once
BORDER = re.compile(r"(?= \S)")
# a word, marks (no apostrophe, which may join a word), and perhaps a line break, a word and marks
SIMPLE = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]{0,8})(?:(\n)([^\W\d_]+)([!-&(-/:-@\[-`{-~]{0,8}))?")
# a space before white space or the end, or at the start: there not every space is a border
ODD_SPACE = r" [\s\p{Z}\x0b\x1c-\x1f\x{85}]| \z|\A "
MANIFEST = "file string, pid int, n_docs bigint, n_tokens bigint"
DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def filesystem(uri: str):
    """The store of a Spark path and the path within it."""
    from pyarrow import fs

    if ":" not in uri.split("/", 1)[0]:
        return fs.LocalFileSystem(), uri
    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(uri)


def byte_letters() -> dict[int, str]:
    """The printable letter by which byte-level vocabularies write each byte: itself, or the next one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


class ChunkEncoder:
    """Ids of a text as little-endian unsigned 32-bit integers, by distinct chunks.

    A chunk is a space and what follows up to the next border; the dictionary
    leaves the space out, the first chunk of a text (no space) is apart. Up
    to ``CACHE`` chunks are kept for good, later ones for their slice only.
    """

    def __init__(self, tokenizer_file: str, special_as_text: bool = True):
        """``special_as_text``: strings of special tokens are ordinary text, not the library's default; op8 sets it off."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()
                 if t.content and not (special_as_text and t.special)]
        self.added = "|".join(f"(?:{re.escape(x)})" for x in added)
        self.known: dict[str, bytes] = {}                # by chunk without its space
        self.bare: dict[str, bytes] = {}                 # by word that no space precedes
        self.marks = {"": b"", "\n": self._ids(["\n"])[0]}   # ids of runs of marks
        self.letters = byte_letters()
        self.packed = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]

    @classmethod
    def of_worker(cls, tokenizer_file: str) -> ChunkEncoder:
        """The Python worker's own encoder: what earlier tasks of the worker have encoded stays known."""
        held = worker_state("token_files")
        if not hasattr(held, "by_file"):
            held.by_file = {}
        if tokenizer_file not in held.by_file:
            held.by_file[tokenizer_file] = cls(tokenizer_file, special_as_text=False)
        return held.by_file[tokenizer_file]

    def _ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 4096):
            for e in self.tokenizer.encode_batch_fast(texts[at:at + 4096], add_special_tokens=False):
                ids = e.ids
                out.append(struct.pack(f"<{len(ids)}I", *ids))
        return out

    @staticmethod
    def odd_chunks(text: str) -> list[str]:
        """The first chunk and the others without their space, for a text with other spacing than single spaces.

        A border is before each space that a non-space follows: there the
        pre-tokenizer always starts a new piece.
        """
        first, *rest = BORDER.split(text)
        return [first, *[c[1:] for c in rest]]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (a string array without nulls)."""
        if self.added:
            whole = pc.match_substring_regex(texts, self.added)
            if pc.any(whole).as_py():
                rest = iter(self._by_chunks(texts.filter(pc.invert(whole))))
                ids = iter(self._ids(texts.filter(whole).to_pylist()))
                return [next(ids if w else rest) for w in whole.to_pylist()]
        return self._by_chunks(texts)

    def _by_chunks(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts without the string of an added token."""
        odd = pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        usual = np.flatnonzero(~odd)
        if len(usual):
            words = pc.split_pattern(texts.take(pa.array(usual)), " ")
            for at, body in zip(usual.tolist(), self._joined(words.flatten(), words.offsets.to_numpy())):
                out[at] = body
        if odd.any():
            cut = [self.odd_chunks(texts[at].as_py()) for at in np.flatnonzero(odd).tolist()]
            ends = np.cumsum([0, *map(len, cut)])
            for at, body in zip(np.flatnonzero(odd).tolist(), self._joined(pa.array([c for x in cut for c in x]), ends)):
                out[at] = body
        return out

    def _joined(self, chunks: pa.Array, offsets: np.ndarray) -> list[bytes]:
        """Ids of lists of chunks; the first chunk of each list is taken as it is, the others without their space."""
        coded = chunks.dictionary_encode()
        of, vocabulary = coded.indices.to_numpy().copy(), coded.dictionary.to_pylist()
        heads = chunks.take(pa.array(offsets[:-1])).to_pylist()
        of[offsets[:-1]] = len(vocabulary) + np.arange(len(heads))
        self.known[""] = b""                             # only a first chunk can be empty
        bodies = list(map(self.known.get, vocabulary))
        missing = [i for i, body in enumerate(bodies) if body is None]
        found = self._new([vocabulary[i] for i in missing])
        for i in missing:
            bodies[i] = found[vocabulary[i]]
        if len(self.known) + len(found) <= CACHE and max(map(len, found), default=0) <= LONGEST:
            self.known.update(found)
        ids = pa.array(bodies + self._ids(heads), pa.binary()).take(pa.array(of)).cast(pa.large_binary())
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, ids.offset * 8)
        data, cuts = memoryview(ids.buffers()[2] or b""), ends[offsets].tolist()
        return [bytes(data[b:e]) for b, e in zip(cuts[:-1], cuts[1:])]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of single pieces (letters, perhaps behind a space): the library's model without its pre-tokenizer."""
        if not words:
            return []
        spelt = "\n".join(words).encode().decode("latin-1").translate(self.letters).split(self.letters[10])
        model, packed = self.tokenizer.model.tokenize, self.packed
        return [b"".join([packed[t.id] for t in model(w)]) for w in spelt]

    def _new(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks that are not known yet.

        Letters, marks and a line break in between are pieces of their own,
        so a chunk of the form word, marks, break, word, marks needs only
        its words encoded.
        """
        known, bare, parts, todo, words, lines = self.known, self.bare, {}, set(), set(), set()
        for c in chunks:
            m = SIMPLE.fullmatch(c)
            if m and m[1].isalpha() and (not m[4] or m[4].isalpha()):
                parts[c] = m[1], m[2], m[4], m[5] or ""
                words.add(m[1])
                if m[3]:
                    lines.add(m[4])                      # a word without a space
            else:
                todo.add(c)
        rest = list(todo.difference(known))
        found = dict(zip(rest, self._ids([" " + c for c in rest])))
        new = list(words.difference(known))
        found.update(zip(new, self._words([" " + c for c in new])))
        new = list(lines.difference(bare))
        begun = dict(zip(new, self._words(new)))
        marks = self.marks
        for x in {x for p in parts.values() for x in (p[1], p[3])}.difference(marks):
            marks[x] = self._ids([x])[0]
        for c, (a, p, b, q) in parts.items():
            if c not in found:
                body = (known[a] if a in known else found[a]) + marks[p]
                if b:
                    body += marks["\n"] + (bare[b] if b in bare else begun[b]) + marks[q]
                found[c] = body
        if len(bare) + len(begun) <= CACHE // 4:
            bare.update(begun)
        return found


def _write(folder: str, tokenizer_file: str, end_id: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard
        from pyspark import TaskContext

        encoder, end = None, struct.pack("<I", end_id)
        press = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        store, base = filesystem(folder)
        name, out, sizes, ids, tokens = "", None, [], [], 0
        for batch in text_chunks(batches, "text", SLICE):
            if out is None:
                encoder = ChunkEncoder.of_worker(tokenizer_file)
                store.create_dir(base, recursive=True)
                name = f"{base}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zst"
                out = store.open_output_stream(name, compression=None)
            bodies = encoder.encode(batch.column("text").fill_null(""))
            for doc, body in zip(batch.column("doc_id").to_pylist(), bodies):
                body += end
                frame = press.compress(body)
                out.write(frame)
                sizes.append((len(frame), len(body), xxhash.xxh64_intdigest(body) & 0xFFFFFFFF))
                ids.append(doc)
                tokens += len(body) // 4
        if out is None:
            return
        table = bytes(i is not None for i in ids) + struct.pack(f"<{len(ids)}q", *[i or 0 for i in ids])
        id_frame = struct.pack("<II", ID_MAGIC, len(table)) + table
        out.write(id_frame)
        entries = b"".join(struct.pack("<III", *s) for s in [*sizes, (len(id_frame), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)])
        footer = struct.pack("<IBI", len(sizes) + 1, 0x80, SEEKABLE)     # 0x80: the table has checksums
        out.write(struct.pack("<II", TABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([name.rsplit("/", 1)[1]]), pa.array([TaskContext.get().partitionId()], pa.int32()),
             pa.array([len(ids)], pa.int64()), pa.array([tokens], pa.int64())],
            names=["file", "pid", "n_docs", "n_tokens"])
        give_back_memory()
    return run


def write_token_files(docs: DataFrame, tokenizer_file: str, end_id: int = 0, folder: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text", level: int = 1) -> tuple[str, DataFrame]:
    """Writes all documents in ascending id order; returns the folder and its manifest.

    The manifest has file, pid, n_docs, n_tokens and start (ids in all files
    before it) and is stored beside the files.
    """
    folder = folder or scratch_path(docs.sparkSession, "token_files")
    named = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    dealt = named.repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = materialize(dealt.mapInArrow(_write(folder, tokenizer_file, end_id, level), MANIFEST), "token_manifest")
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)     # a row per file
    start = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint")
    return folder, materialize(manifest.withColumn("start", start), "token_index")


class TokenFile:
    """Random access to one file: reads the tables, then only the frames asked for."""

    def __init__(self, path: str, store=None):
        import zstandard

        if store is None:
            store, path = filesystem(path)
        self.file = store.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or not flags & 0x80:
            raise ValueError(f"{path}: no seek table with checksums")
        whole = 12 * n + 9
        head = struct.unpack("<II", self._at(size - whole - 8, 8))
        if head != (TABLE_MAGIC, whole):
            raise ValueError(f"{path}: the seek table is damaged")
        flat = struct.unpack(f"<{3 * n}I", self._at(size - whole, 12 * n))
        self.sizes, self.lengths, self.sums = flat[0::3], flat[1::3], flat[2::3]
        self.offsets = [0]
        for s in self.sizes:
            self.offsets.append(self.offsets[-1] + s)
        self.n_docs = n - 1
        raw = self._at(self.offsets[-2] + 8, 9 * self.n_docs)
        values = struct.unpack(f"<{self.n_docs}q", raw[self.n_docs:])
        self.ids = [v if has else None for has, v in zip(raw, values)]
        self._zstd = zstandard.ZstdDecompressor()

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def document(self, k: int) -> bytes:
        """The ids of the k-th document, checked against its frame's checksum in the table."""
        import xxhash

        body = self._zstd.decompress(self._at(self.offsets[k], self.sizes[k]), max_output_size=self.lengths[k])
        if len(body) != self.lengths[k] or xxhash.xxh64_intdigest(body) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} is damaged")
        return body

    def close(self) -> None:
        self.file.close()


def _read(folder: str, wanted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(f"{base}/{row['file']}", store)
                starts = [row["start"]]
                for n in file.lengths[:file.n_docs]:
                    starts.append(starts[-1] + n // 4)
                only = set(row["wanted"]) if wanted else None
                picked = [k for k in range(file.n_docs) if only is None or file.ids[k] in only]
                for at in range(0, len(picked), 4096):
                    part = picked[at:at + 4096]
                    columns = [pa.array([file.ids[k] for k in part], pa.int64()),
                               pa.array([starts[k] for k in part], pa.int64()),
                               pa.array([file.lengths[k] // 4 for k in part], pa.int64())]
                    names = ["doc_id", "start", "n_tokens"]
                    if wanted:
                        columns.append(pa.array([np.frombuffer(file.document(k), "<u4").astype(np.int64) for k in part],
                                                pa.list_(pa.int64())))
                        names.append("ids")
                    else:
                        columns.append(pa.array([zlib.crc32(file.document(k)) for k in part], pa.int64()))
                        names.append("ids_crc32")
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                file.close()
    return run


def read_index(folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the CRC-32 of its ids. One task per file."""
    files = manifest.select("file", "start").repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4, "file")
    return files.mapInArrow(_read(folder, False), DOCS)


def read_documents(folder: str, manifest: DataFrame, doc_ids: list[int]) -> DataFrame:
    """The ids of a stated list of documents; only their frames are read and decompressed."""
    files = manifest.select("file", "start", F.lit(list(doc_ids)).cast("array<bigint>").alias("wanted"))
    return files.mapInArrow(_read(folder, True), "doc_id bigint, start bigint, n_tokens bigint, ids array<bigint>")
