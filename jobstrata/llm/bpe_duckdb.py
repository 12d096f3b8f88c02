"""Byte-level BPE by DuckDB recursive queries inside every partition.

A recursive query holds token-position rows ``(word, pos, len, id)``. Each step joins neighbours with the merge table,
finds every word's leftmost minimum-rank pair and contracts it, until no word has a pair left. The merge table has every way to split a
token into two tokens, so a pair's rank is that of the joined bytes. Other pairs of the same rank in the word are
contracted in the same step unless the contraction makes a neighbour pair of a lower rank, which would come first; so
long runs take few steps and the result is that of one pair at a time.
Decoding joins ids with the vocabulary and concatenates the pieces by an ordered aggregation.

Words are looked up in a bounded memory of the worker first, so that only new ones go through the recursion; when it is full,
the words that were not met since it last was are forgotten. Texts are worked on in pieces of about a million characters, whatever the length of a text.

Defined results: NULL counts as an empty text (no ids); ill-formed surrogates become question marks; repeated rows are
encoded alike; further columns pass through, except that the result's own names win.
"""

from __future__ import annotations

import base64
import hashlib
import re
import string
from collections.abc import Iterable, Iterator
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_WORDS = 200_000  # in each of two generations
_PIECE = 1 << 20
_GROUP = 1 << 20  # characters encoded together
_NEW_BYTES = 1 << 18  # of new words in one recursion

# spaces that may belong to a run of white space, and spaces that begin a word
_ODD = re.compile(r" (?:(?<!\S )|(?!\S))")
_CUT = re.compile(r"(?<=\S) (?=\S)")

# Words of up to SHORT bytes: each step contracts one pair in every word that still has one, the leftmost of the lowest rank.
# A row knows the id of the next row; the last step of each word is its result.
_SHORT = """
WITH RECURSIVE s(step, w, pos, len, id, next_id) AS (
  SELECT 0, w, pos, 1, id, next_id FROM start
  UNION ALL
  (WITH low AS (SELECT s.w, min((m.id::BIGINT << 16) | (s.pos << 8) | (s.pos + s.len)) AS x
                FROM s JOIN merges m ON m.pair = (s.id::BIGINT << 32) | s.next_id
                WHERE s.next_id >= 0 GROUP BY s.w),
   hit AS (SELECT low.w, (x >> 16)::INT AS id, ((x >> 8) & 255)::INT AS pos, b.pos AS second, b.len AS more, b.next_id AS after
           FROM low JOIN s b ON b.w = low.w AND b.pos = (x & 255)::INT)
   SELECT s.step + 1, s.w, s.pos, CASE WHEN s.pos = h.pos THEN s.len + h.more ELSE s.len END,
          CASE WHEN s.pos = h.pos THEN h.id ELSE s.id END,
          CASE WHEN s.pos = h.pos THEN h.after WHEN s.pos + s.len = h.pos THEN h.id ELSE s.next_id END
   FROM s JOIN hit h ON h.w = s.w WHERE s.pos <> h.second)
)
SELECT w, id FROM s JOIN (SELECT w, max(step) AS step FROM s GROUP BY w) USING (w, step) ORDER BY w, pos
"""
SHORT = 64

# Longer words: all pairs of the lowest rank in one step, and rows replaced in place, so that memory stays linear. A merged
# token is a new version of its first row; its second row gets id -1.
_MERGE = """
WITH RECURSIVE s(w, pos, len, id) USING KEY (w, pos) AS (
  SELECT w, pos, 1, id FROM start
  UNION
  (WITH live AS (SELECT r.w, r.pos, r.len, r.id FROM recurring.s r WHERE r.id >= 0 AND r.w IN (SELECT w FROM s)),
   pair AS (SELECT a.w, a.pos, a.len AS al, b.len AS bl, m.l, m.r, m.id, b.pos AS second
            FROM live a JOIN live b ON b.w = a.w AND b.pos = a.pos + a.len JOIN merges m ON m.l = a.id AND m.r = b.id),
   low AS (SELECT w, x >> 31 AS id, x & 2147483647 AS head
           FROM (SELECT w, min((id::BIGINT << 31) | pos) AS x FROM pair GROUP BY w)),
   hit AS (SELECT p.*, low.head FROM pair p JOIN low ON low.w = p.w AND low.id = p.id),
   one AS (SELECT h.w FROM hit h JOIN early_after e ON e.r = h.id JOIN live p ON p.w = h.w AND p.pos + p.len = h.pos
                  AND p.id = e.l
           UNION ALL SELECT h.w FROM hit h JOIN early_before e ON e.l = h.id JOIN live n ON n.w = h.w
                  AND n.pos = h.second + h.bl AND n.id = e.r
           UNION ALL SELECT h.w FROM hit h JOIN early_after e ON e.r = h.id AND e.l = h.id),
   runs AS (SELECT *, sum(fresh) OVER (PARTITION BY w ORDER BY pos) AS run FROM
             (SELECT *, CASE WHEN lag(second) OVER (PARTITION BY w ORDER BY pos) = pos THEN 0 ELSE 1 END AS fresh
              FROM hit WHERE l = r)),
   odd AS (SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY pos) AS nth FROM runs),
   done AS (SELECT w, pos, al, bl, id, second FROM hit ANTI JOIN one USING (w) WHERE l <> r
            UNION ALL SELECT w, pos, al, bl, id, second FROM odd ANTI JOIN one USING (w) WHERE nth % 2 = 1
            UNION ALL SELECT w, pos, al, bl, id, second FROM hit SEMI JOIN one USING (w) WHERE pos = head)
   SELECT w, pos, al + bl, id FROM done UNION ALL SELECT w, second, 0, -1 FROM done)
)
SELECT w, id FROM s WHERE id >= 0 ORDER BY w, pos
"""
# one thread adds up rows in the order they come in
_DECODE = """
SELECT d, string_agg(piece, '') AS text
FROM (SELECT t.d, v.piece FROM ids t JOIN vocabulary v USING (id) ORDER BY t.pos) GROUP BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def merge_rows(ranks: dict[bytes, int]) -> np.ndarray:
    """``left, right, id`` of every split of a token into two."""
    rows = [(ranks[t[:k]], ranks[t[k:]], rank) for t, rank in ranks.items() for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks]
    return np.array(rows, np.int32).reshape(-1, 3)


class Bpe:
    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        table = merge_rows(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "300MB", "temp_directory": ""})
        self._register("merges_in", {"l": table[:, 0], "r": table[:, 1], "id": table[:, 2]})
        self.db.execute("CREATE TABLE merges AS SELECT *, (l::BIGINT << 32) | r AS pair FROM merges_in")
        # pairs that rank before their right or left half was made
        self.db.execute("CREATE TABLE early_after AS SELECT l, r FROM merges WHERE id < r")
        self.db.execute("CREATE TABLE early_before AS SELECT l, r FROM merges WHERE id < l")
        tokens = list(ranks)
        self._register("vocabulary_in", {"id": np.array([ranks[t] for t in tokens], np.int32),
                                         "piece": [t.decode("latin-1") for t in tokens]})
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_in")
        for name in ("merges_in", "vocabulary_in"):
            self.db.unregister(name)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _register(self, name: str, columns: dict) -> None:
        self.db.register(name, pa.table(columns))

    def _merge(self, words: list[str], data: list[bytes], sizes: np.ndarray) -> None:
        """Run the recursion for new words, given with their bytes, and remember their ids."""
        raw = np.frombuffer(b"".join(data), np.uint8)
        first = np.cumsum(sizes) - sizes
        ids = self.byte_ids[raw]
        after = np.append(ids[1:], np.int32(-1))
        after[first + sizes - 1] = -1
        self._register("start", {"w": np.repeat(np.arange(len(data), dtype=np.int32), sizes),
                                 "pos": (np.arange(len(raw)) - np.repeat(first, sizes)).astype(np.int32),
                                 "id": ids, "next_id": after})
        found = self.db.execute(_SHORT if sizes.max() <= SHORT else _MERGE).fetchnumpy()
        self.db.unregister("start")
        coded = np.asarray(found["id"]).astype("<u4").tobytes()
        cut = (4 * np.searchsorted(np.asarray(found["w"]), np.arange(len(data) + 1))).tolist()
        self.known.update((w, coded[a:b]) for w, a, b in zip(words, cut, cut[1:]))

    def _unknown(self, some: set[str]) -> set[str]:
        """Those that are new; what is met again in the older generation moves to the younger one."""
        new = some.difference(self.known)
        again = new.intersection(self.older)
        self.known.update((w, self.older[w]) for w in again)
        return new - again

    def _learn(self, words: set[str]) -> None:
        new = list(words)
        data = [w.encode("utf-8", "replace") for w in new]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        order = np.argsort(sizes, kind="stable")  # words of like length together, few long ones at a time
        ends = np.cumsum(sizes[order])
        first, short = 0, int(np.searchsorted(sizes[order], SHORT, "right"))
        while first < len(order):
            before = ends[first - 1] if first else 0
            last = int(np.searchsorted(ends, before + _NEW_BYTES, "right")) + 1
            last = min(last, short if first < short else len(order))
            some = order[first:last]
            self._merge([new[k] for k in some], [data[k] for k in some], sizes[some])
            first = last

    def _find(self, met: set[str]) -> tuple[dict[str, list[str]], set[str]]:
        """The stretches that are several words, with these words, and all words that are new."""
        new = self._unknown(met)
        parts = {c: _word_and_marks(c) or self.split(c) for c in new if not _one_word(c)}
        return parts, self._unknown(new.difference(parts).union(chain.from_iterable(parts.values())))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of every text. Texts are cut before single spaces, where no match can span."""
        cut = [self.split(t) if _ODD.search(t) else _words(t) for t in texts]
        met = set(chain.from_iterable(cut))
        parts, new = self._find(met)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known, self.older = {}, self.known
            parts, new = self._find(met)
        if new:
            self._learn(new)
        known = self.known
        words = met.difference(parts)
        ids = dict(zip(words, map(known.__getitem__, words)))
        ids.update((c, b"".join([known[p] for p in split])) for c, split in parts.items())
        return [b"".join(map(ids.__getitem__, c)) for c in cut]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of every sequence of ids."""
        numbers = [np.frombuffer(i, "<u4") for i in ids]
        sizes = [len(n) for n in numbers]
        flat = np.concatenate([*numbers, np.zeros(0, np.uint32)]).astype(np.int32)
        self._register("ids", {"d": np.repeat(np.arange(len(ids), dtype=np.int32), sizes),
                               "pos": np.arange(len(flat), dtype=np.int64), "id": flat})
        out = [b""] * len(ids)
        for d, text in self.db.execute(_DECODE).fetchall():
            out[d] = text.encode("latin-1")
        self.db.unregister("ids")
        return out


def _one_word(chunk: str) -> bool:
    """Whether the pattern surely matches it whole: Latin letters, perhaps behind a space."""
    letters = chunk[1:] if chunk[0] == " " else chunk
    return letters.isalpha() and (letters.isascii() or max(letters) < "\u0250")


def _word_and_marks(chunk: str) -> list[str] | None:
    """Both matches of a chunk that surely is one word and ASCII punctuation behind it."""
    word = chunk.rstrip(string.punctuation)
    return [word, chunk[len(word):]] if len(word) < len(chunk) and word and _one_word(word) else None


def _words(text: str) -> list[str]:
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + r for r in rest]


def pieces(text: str, size: int = _PIECE) -> Iterator[str]:
    """The text cut before single spaces between words into parts of about ``size`` characters."""
    begin = 0
    while len(text) - begin > size and (found := _CUT.search(text, begin + size)):
        yield text[begin:found.start()]
        begin = found.start()
    yield text[begin:] if begin else text


_LOADED: dict[tuple[str, str], Bpe] = {}


def load(path: str, pattern: str) -> Bpe:
    """One per Python worker, which serves many tasks."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Bpe(path, pattern)
    return _LOADED[path, pattern]


def _groups(texts: Iterable[str | None]) -> Iterator[list[tuple[int, str]]]:
    group, size = [], 0
    for k, text in enumerate(texts):
        for piece in pieces(text or ""):
            group.append((k, piece))
            size += len(piece)
            if size >= _GROUP:
                yield group
                group, size = [], 0
    if group:
        yield group


def round_trip(docs: DataFrame, ranks: str, pattern: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Replace the text by ``n_tokens, ids_sha256, decoded_sha256`` (and ``ids``, little-endian 32-bit, if asked for)."""
    new = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids
    rest = [c for c in docs.columns if c != text and c not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks, pattern)
        for batch in batches:
            rows = range(batch.num_rows)
            count, kept = [0] * len(rows), [[] for _ in rows]
            sha, back = ([hashlib.sha256() for _ in rows] for _ in range(2))
            for group in _groups(text.as_py() for text in batch["_text"]):  # never a whole batch as strings
                coded = bpe.encode([piece for _, piece in group])
                for (k, _), ids, data in zip(group, coded, bpe.decode(coded)):
                    count[k] += len(ids) // 4
                    sha[k].update(ids)
                    back[k].update(data)
                    if keep_ids:
                        kept[k].append(ids)
            columns = [pa.array(count, pa.int64()), pa.array([h.hexdigest() for h in sha]),
                       pa.array([h.hexdigest() for h in back])]
            if keep_ids:
                columns.append(pa.array([b"".join(k) for k in kept], pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], [*rest, *new])
            # the worker lives on and would keep the memory of its largest batch of any stage
            del batch, kept, columns
            pa.default_memory_pool().release_unused()

    ordered = docs.select(F.col(text).alias("_text"), *[F.col(f"`{c}`") for c in rest])
    schema = ordered.drop("_text").schema.add("n_tokens", "long").add("ids_sha256", "string").add(
        "decoded_sha256", "string")
    return ordered.mapInArrow(run, schema.add("ids", "binary") if keep_ids else schema)
