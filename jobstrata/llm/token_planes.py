"""Token ids in binary files: fixed-size blocks of ids stored as compressed bit (or byte) planes with a chunk index.

File layout, all numbers little-endian:

    magic "IDPLANE1"
    chunk*        the planes of one block of ids, each its own zstandard frame, lowest bit (byte) first
    footer        zstandard frame of 64-bit integers:
                  kind (1 bit, 8 byte planes), chunks, documents,
                  per chunk: offset, ids, planes; then the size of every plane; then doc_id, has_id, ids per document
    trailer       footer offset, footer size, magic "IDPLANE1"

Documents are range-partitioned by id, every range is encoded and written by one task, and the ranges in order make up
the whole sequence. A task writes to a name of its own, so a repeated task never harms a finished file; only files
named in the stored manifest count. The driver sees no ids.

Defined results: NULL text counts as empty (one id, the end id); rows with NULL id come first; rows of the same id are
ordered by a hash of their text, then the text; other columns are not stored; an empty table gives an empty manifest.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobstrata.llm.files import filesystem, fresh
from jobstrata.session import materialise, new_path

MAGIC = b"IDPLANE1"
END_ID = 1
BLOCK_IDS = 1 << 16
CACHE_WORDS = 700_000
_PIECE = 1 << 20
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


# ---- encoding ----------------------------------------------------------------------------------------------------


def _stays_letter(char: str) -> bool:
    """Whether the vocabulary's clean-up (composition, lower case) leaves one letter or number of the character."""
    return char.isalnum() and len(char.lower()) == 1 and unicodedata.normalize("NFC", char) == char


def _one_piece(word: str) -> bool:
    """Whether a word is letters only, before and after the clean-up; the splitter keeps those together."""
    return word.isalpha() and (word.isascii() or word.lower().isalpha() and unicodedata.is_normalized("NFC", word))


class Encoder:
    """Ids of whole texts as the tokenizers library gives them, remembering what single words give.

    The vocabulary's splitter never joins characters across white space, and a run of ASCII marks at the end of a word is
    always a piece of its own, so a text may be encoded word by word. Texts with added tokens or with separators that
    Python and the splitter class differently are given to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        vocabulary = self.library.get_vocab()
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that end a piece
        self.closes[[k for token, k in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)  # no offsets are needed
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _joined(self, words: list[str]) -> list[bytes]:
        """The same for words of one piece each, in one call. No word has less than a piece, so as many ends as words tell
        that every end is that of a word; otherwise the words are asked for one by one."""
        ids = np.array(self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
        if len(ends) != len(words) or ends[-1] != 4 * len(ids):
            return self._library(words)
        data, ends = ids.tobytes(), ends.tolist()
        return [data[begin:end] for begin, end in zip([0, *ends], ends)]

    def _learn(self, words: set[str]) -> None:
        parts = {}
        for word in words:
            stem = word.rstrip(_MARKS)
            if not (0 < len(stem) < len(word) and _stays_letter(stem[-1])):
                stem = word
            key = stem.lower() if stem.isascii() else stem  # the vocabulary knows lower case only
            if key != word:
                parts[word] = (key, word[len(stem):])
        ask = {w for w in words if w not in parts}
        ask.update(p for pair in parts.values() for p in pair)
        ask = ask.difference(self.known)
        single = [w for w in ask if _one_piece(w)]
        for some, ids_of in ((single, self._joined), (list(ask.difference(single)), self._library)):
            for begin in range(0, len(some), 5000):
                part = some[begin:begin + 5000]
                self.known.update(zip(part, ids_of(part)))
        for word, (stem, tail) in parts.items():
            self.known[word] = self.known[stem] + self.known[tail]

    def encode(self, text: str) -> Iterator[bytes]:
        """Little-endian 32-bit ids of one text, in pieces of bounded size."""
        if "<|" in text or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            yield self._library([text])[0]
            return
        for piece in pieces(text):
            words = piece.split()
            known = self.known
            found = list(map(known.get, words))
            if new := {w for w, ids in zip(words, found) if ids is None}:
                if len(known) > CACHE_WORDS:
                    known.clear()
                self._learn(new)
                found = [known[w] if ids is None else ids for w, ids in zip(words, found)]
            yield b"".join(found)


def pieces(text: str, size: int = _PIECE) -> Iterator[str]:
    """The text cut before white space into parts of about ``size`` characters."""
    begin = 0
    space = re.compile(r"\s")
    while len(text) - begin > size:
        found = space.search(text, begin + size)
        if not found:
            break
        yield text[begin:found.start()]
        begin = found.start()
    yield text[begin:] if begin else text


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker, which serves many tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---- planes ------------------------------------------------------------------------------------------------------


def to_planes(ids: np.ndarray, kind: int) -> list[bytes]:
    """Planes of unsigned 32-bit ids, lowest first, as many as the largest id needs."""
    width = max(1, -(-int(ids.max(initial=0)).bit_length() // kind))
    if kind == 8:
        return [np.ascontiguousarray(ids.view(np.uint8).reshape(-1, 4)[:, k]).tobytes() for k in range(width)]
    return [np.packbits(((ids >> np.uint32(k)) & np.uint32(1)).astype(np.uint8)).tobytes() for k in range(width)]


def from_planes(planes: list[bytes], n: int, kind: int) -> np.ndarray:
    ids = np.zeros(n, np.uint32)
    for k, plane in enumerate(planes):
        part = np.frombuffer(plane, np.uint8)
        part = part if kind == 8 else np.unpackbits(part, count=n)
        ids |= part.astype(np.uint32) << np.uint32(k * kind)
    return ids


class Writer:
    def __init__(self, out, kind: int, block: int):
        self.out, self.kind, self.block = out, kind, block
        self.squeeze = zstandard.ZstdCompressor(level=1)
        self.at, self.held, self.held_bytes, self.total = len(MAGIC), [], 0, 0
        self.chunks, self.sizes, self.docs = [], [], []
        out.write(MAGIC)

    def _chunk(self, ids: np.ndarray) -> None:
        planes = [self.squeeze.compress(p) for p in to_planes(ids, self.kind)]
        self.chunks.append((self.at, len(ids), len(planes)))
        for plane in planes:
            self.out.write(plane)
            self.sizes.append(len(plane))
            self.at += len(plane)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        whole = len(ids) if all_of_it else len(ids) // self.block * self.block
        for begin in range(0, whole, self.block):
            self._chunk(ids[begin:begin + self.block])
        rest = ids[whole:].tobytes()
        self.held, self.held_bytes = [rest], len(rest)

    def add(self, doc_id: int | None, parts: Iterator[bytes]) -> None:
        n = 0
        for part in parts:
            self.held.append(part)
            self.held_bytes += len(part)
            n += len(part) // 4
            if self.held_bytes >= 4 * self.block:
                self._flush(False)
        self.docs.append((0 if doc_id is None else doc_id, int(doc_id is not None), n))
        self.total += n

    def close(self) -> None:
        self._flush(True)
        numbers = np.concatenate([
            np.array([self.kind, len(self.chunks), len(self.docs)], "<i8"), np.array(self.chunks, "<i8").reshape(-1, 3).T.ravel(),
            np.array(self.sizes, "<i8"), np.array(self.docs, "<i8").reshape(-1, 3).T.ravel()])
        footer = self.squeeze.compress(numbers.astype("<i8").tobytes())
        self.out.write(footer + np.array([self.at, len(footer)], "<i8").tobytes() + MAGIC)


class Reader:
    """Random access to one file: the chunk index first, then any block on its own."""

    def __init__(self, file):
        self.file, size = file, file.size()
        file.seek(size - 24)
        tail = file.read(24)
        if tail[16:] != MAGIC:
            raise ValueError("not an id plane file, or cut off")
        at, length = np.frombuffer(tail[:16], "<i8").tolist()
        file.seek(at)
        self.open = zstandard.ZstdDecompressor()
        numbers = np.frombuffer(self.open.decompress(file.read(length)), "<i8")
        self.kind, chunks, docs = numbers[:3].tolist()
        self.offset, self.ids, self.planes = numbers[3:3 + 3 * chunks].reshape(3, chunks)
        sizes = numbers[3 + 3 * chunks:3 + 3 * chunks + int(self.planes.sum())]
        self.sizes = np.split(sizes, np.cumsum(self.planes)[:-1]) if chunks else []
        self.doc_id, self.has_id, self.n_tokens = numbers[len(numbers) - 3 * docs:].reshape(3, docs)

    def chunk(self, k: int) -> np.ndarray:
        self.file.seek(int(self.offset[k]))
        planes = [self.open.decompress(self.file.read(int(s))) for s in self.sizes[k]]
        return from_planes(planes, int(self.ids[k]), self.kind)

    def documents(self) -> Iterator[tuple[int | None, int, int, list[np.ndarray]]]:
        """``doc_id, start in the file, ids, parts`` one after the other; a part is what one chunk holds of it."""
        start, k, now, used = 0, 0, np.zeros(0, np.uint32), 0
        for doc, has, n in zip(self.doc_id.tolist(), self.has_id.tolist(), self.n_tokens.tolist()):
            parts, left = [], n
            while left:
                if used == len(now):
                    now, used, k = self.chunk(k), 0, k + 1
                take = min(left, len(now) - used)
                parts.append(now[used:used + take])
                used, left = used + take, left - take
            yield doc if has else None, start, n, parts
            start += n


# ---- Spark -------------------------------------------------------------------------------------------------------

MANIFEST = "part int, path string, n_tokens long, n_docs long"


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, kind: int = 1, block: int = BLOCK_IDS,
          end_id: int | None = END_ID) -> DataFrame:
    """Encode ``doc_id, text``, write one file per range of ids, and return the stored manifest."""
    folder = folder or new_path(docs.sparkSession, "ids")
    key = F.xxhash64("text")
    ranged = (docs.select("doc_id", "text", key.alias("_h")).repartitionByRange("doc_id", "_h")
              .sortWithinPartitions("doc_id", "_h", "text").drop("_h"))
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, out, path = TaskContext.get().partitionId(), None, None, ""
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                if writer is None:
                    path, out = fresh(folder, part, "ids")
                    writer = Writer(out, kind, block)
                writer.add(doc_id, _with_end(encoder(tokenizer).encode(text or ""), end))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([path]), pa.array([writer.total]),
                                              pa.array([len(writer.docs)])], ["part", "path", "n_tokens", "n_docs"])

    return materialise(ranged.mapInArrow(run, MANIFEST), "manifest")


def _with_end(parts: Iterator[bytes], end: bytes) -> Iterator[bytes]:
    yield from parts
    if end:
        yield end


def read(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    before = F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    based = manifest.select("part", "path", F.coalesce(before, F.lit(0)).alias("base"))  # a row per file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist()):
                place, inner = filesystem(path)
                rows: tuple[list, ...] = ([], [], [], [])
                with place.open_input_file(inner) as file:
                    for doc, start, n, parts in Reader(file).documents():
                        crc = 0
                        for part in parts:
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        for column, value in zip(rows, (doc, base + start, n, crc)):
                            column.append(value)
                        if len(rows[0]) >= 20_000:
                            yield _batch(rows)
                            rows = ([], [], [], [])
                yield _batch(rows)

    spread = based.repartition(max(1, manifest.count()), "part")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows],
                                      ["doc_id", "start", "n_tokens", "ids_crc32"])
