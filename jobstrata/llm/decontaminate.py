"""Benchmark decontamination by spaced seeds: hashes of token windows that ignore fixed positions.

Tokens are the maximal runs of letters, digits and non-ASCII characters of the lower-cased text, without non-ASCII punctuation;
characters of scripts that are written without blanks are tokens of their own. Every mask picks some
tokens of a window; equal hashes of a benchmark window and a document window are a hit, whatever stands at the ignored
positions. Around a hit the item is laid over the document. A document is contaminated by an item if some stretch of that
alignment, at most a fifth of it substituted, has ``NEED`` matching tokens, or four fifths of an item shorter than that.
Items of fewer than ``LEAST`` tokens are matched exactly: a document is contaminated if it has the whole sequence, or, for one or
two tokens, if it consists of nothing else.

The benchmark is the stated query set. It is split by a hash into blocks of about ``BLOCK_TOKENS`` tokens; each block is
broadcast and meets all documents in one pass, so what is broadcast never grows beyond that bound. Documents are never
shuffled and each row is judged on its own.

Defined results: NULL or empty texts and an empty benchmark contaminate nothing; a NULL benchmark text is skipped; an item without id contaminates like any
other, but no id is told for it; equal
rows get equal verdicts; columns of the documents pass through, except that the result's own names win. A run of over
a megabyte without white space is hashed in pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.quality_ftrl import blocks
from jobstrata.llm.text import mix, span_hashes
from jobstrata.session import materialise

MASKS = ["11111", "1101011", "110010011", "101100101"]
NEED = 13
LEAST = 8
BLOCK_TOKENS = 2_000_000
_FILTER_BITS = 22
_STEP = 1 << 20
_FACTORS = mix(np.arange(1, 33, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

# scripts written without blanks, and punctuation outside ASCII (fixed values)
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0002ffff"
_POINTS = "\u00a1\u00ab\u00b7\u00bb\u00bf\u2010-\u2027\u2030-\u205e\u3000-\u303f\ufe30-\ufe6f\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65"
_SET_APART = re.compile(f"[{_UNSPACED}{_POINTS}]")
_ALONE, _POINT = re.compile(f"([{_UNSPACED}])"), re.compile(f"[{_POINTS}]+")

_TOKEN = np.zeros(256, bool)
_TOKEN[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = True


def _spaced(text: str | None) -> str:
    text = (text or "").lower()
    if text.isascii() or not _SET_APART.search(text):
        return text
    return _ALONE.sub(r" \1 ", _POINT.sub(" ", text))


def tokens(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token hashes and numbers of their texts; all tokens of one text come together."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for data, at, numbers, goes_on in blocks([_spaced(t) for t in texts]):
        raw = np.frombuffer(data, np.uint8)
        inside = np.concatenate([[False], _TOKEN[raw], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        owner = np.asarray(numbers)[np.searchsorted(np.asarray(at), starts, "right") - 1]
        if not goes_on and held:
            yield tuple(np.concatenate(c) for c in zip(*held))
            held = []
        held.append((span_hashes(raw, starts, ends), owner))
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def seeds(h: np.ndarray, owner: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows inside one text, and their hashes under the mask."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(n, np.uint64(len(mask)))
        for k, bit in enumerate(mask):
            if bit == "1":
                out += h[k:k + n] * _FACTORS[k]
    whole = np.flatnonzero(owner[:n] == owner[len(mask) - 1:])
    return whole, out[whole]


class Items:
    """One block of the benchmark: its tokens, and for every mask the sorted seeds with their places."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        parts = list(tokens(texts))
        h = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.uint64)])
        owner = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)])
        size = np.bincount(owner, minlength=len(texts))
        long_enough = size[owner] >= LEAST if len(owner) else np.zeros(0, bool)
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # number of tokens -> sorted keys of whole items, and the items
        for n in range(1, LEAST):
            at, key = seeds(h, owner, "1" * n)
            some = size[owner[at]] == n
            order = np.argsort(key[some], kind="stable")
            if len(order):
                self.short[n] = key[some][order], owner[at][some][order]
        self.h, self.owner = h[long_enough], owner[long_enough]
        self.ids = ids
        self.begin = np.searchsorted(self.owner, np.arange(len(texts)))
        self.end = np.searchsorted(self.owner, np.arange(len(texts)), "right")
        self.index = []
        for mask in MASKS:
            place, key = seeds(self.h, self.owner, mask)
            order = np.argsort(key, kind="stable")
            present = np.zeros(1 << _FILTER_BITS, bool)
            present[mix(key) >> np.uint64(64 - _FILTER_BITS)] = True
            self.index.append((mask, key[order], place[order], present))

    def hits(self, h: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """``document place - item place, item place, document place`` of all seeds in common."""
        found = []
        for begin in range(0, len(h), _STEP):
            part = slice(begin, begin + _STEP + 32)
            for mask, keys, places, present in self.index:
                at, key = seeds(h[part], owner[part], mask)
                some = np.flatnonzero(present[mix(key) >> np.uint64(64 - _FILTER_BITS)])
                low = np.searchsorted(keys, key[some])
                n = np.searchsorted(keys, key[some], "right") - low
                some, low, n = some[n > 0], low[n > 0], n[n > 0]
                if len(n):
                    first = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    place = places[first]
                    here = np.repeat(at[some] + begin, n)
                    found.append(np.stack([here - place, place, here], 1))
        return np.concatenate(found) if found else np.zeros((0, 3), np.int64)

    def whole_items(self, h: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``text, item, tokens`` of short items that stand in a text."""
        size = np.bincount(owner) if len(owner) else owner
        for n, (keys, items) in self.short.items():
            for begin in range(0, len(h), _STEP):
                part = slice(begin, begin + _STEP + n - 1)
                at, key = seeds(h[part], owner[part], "1" * n)
                low = np.searchsorted(keys, key)
                met = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == key)
                if n < 3:
                    met = met[size[owner[part][at[met]]] == n]
                pairs = {(int(t), int(b)) for t, b in zip(owner[part][at[met]], low[met])}
                for t, b in pairs:
                    for k in items[b:np.searchsorted(keys, keys[b], "right")]:  # items with the same tokens
                        yield t, int(k), n

    def overlaps(self, h: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``text, item, matching tokens`` of every alignment that contaminates."""
        rows = self.hits(h, owner)
        if not len(rows):
            return
        item, text = self.owner[rows[:, 1]], owner[rows[:, 2]]
        for diagonal, k, t in np.unique(np.stack([rows[:, 0], item, text], 1), axis=0).tolist():
            a, b = int(self.begin[k]), int(self.end[k])
            need = min(NEED, -(-4 * (b - a) // 5))
            first = np.searchsorted(owner, t)
            last = np.searchsorted(owner, t, "right")
            low, high = max(a, first - diagonal), min(b, last - diagonal)
            same = h[low + diagonal:high + diagonal] == self.h[low:high]
            if same.sum() < need:
                continue
            total = np.concatenate([[0], np.cumsum(np.where(same, 1, -4))])
            count = np.concatenate([[0], np.cumsum(same)])
            # for every end, the earliest start from which the total has not fallen
            start = np.searchsorted(-np.minimum.accumulate(total), -total, "left")
            if (matched := int((count - count[start]).max())) >= need:
                yield t, k, matched


def _pass(docs: DataFrame, items: Items, text: str) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        for batch in batches:
            found: list[set[int]] = [set(i) for i in batch["items"].to_pylist()]
            best = batch["n_matched"].to_pylist()
            for h, owner in tokens(batch[text].to_pylist()):
                for t, k, matched in chain(block.overlaps(h, owner), block.whole_items(h, owner)):
                    if block.ids[k] is not None:
                        found[t].add(block.ids[k])
                    best[t] = max(best[t], matched)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array([sorted(f) for f in found], pa.list_(pa.int64())),
                 pa.array(best, pa.int32())], batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def benchmark_blocks(benchmark: DataFrame, block_tokens: int = BLOCK_TOKENS) -> Iterator[Items]:
    """The benchmark in parts whose expected size is bounded, whatever its own."""
    known = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    known = materialise(known.dropDuplicates(), "benchmark")  # copies of a row would all fall in one block
    size = known.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // (6 * block_tokens))
    for k in range(n):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").toArrow()
        yield Items(rows["item_id"].to_pylist(), rows["text"].to_pylist())


def _judged(docs: DataFrame, benchmark: DataFrame, text: str, block_tokens: int) -> DataFrame:
    """The columns as ``own_0``, ``own_1``, ... with ``items`` and ``n_matched`` last."""
    names = [f"own_{k}" for k in range(len(docs.columns))]
    now = docs.toDF(*names).select(*names, F.array().cast("array<long>").alias("items"), F.lit(0).alias("n_matched"))
    for k, items in enumerate(benchmark_blocks(benchmark, block_tokens)):
        now = _pass(materialise(now, "pass") if k else now, items, names[docs.columns.index(text)])
    return now


def flag(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Add ``contaminated``, ``items`` (sorted ids of the items found) and ``n_matched`` (most matching tokens)."""
    own = [(f"own_{k}", c) for k, c in enumerate(docs.columns) if c not in ("contaminated", "items", "n_matched")]
    return _judged(docs, benchmark, text, block_tokens).select(
        *[F.col(a).alias(c) for a, c in own], (F.col("n_matched") > 0).alias("contaminated"), "items", "n_matched")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that no benchmark item contaminates, with all their columns."""
    return _judged(docs, benchmark, text, BLOCK_TOKENS).where("n_matched = 0").select(
        *[F.col(f"own_{k}").alias(c) for k, c in enumerate(docs.columns)])
