"""Removal of byte strings that already occur in an earlier document, found by a depth-limited radix sort of suffixes.

A suffix matters only through its first ``window`` bytes: after sorting to that depth, equal groups are exactly the repeated
windows. Digits are taken from the most significant one on, and a suffix leaves as soon as no other document shares the
digits so far.

1. First digit. Shuffling every suffix would move many times the corpus. The digit that deals suffixes out therefore is the
   gram (``gram_of(window)`` bytes) of lowest hash inside the window: equal windows have it at the same place, and neighbouring
   windows mostly share it. A *segment* is a run of windows with one such gram. Only hashes of its gram and of its bytes are
   shuffled and sorted: a gram that one document alone has ends here with all its windows; of equal segments all but the
   earliest are repeats; a gram with one content is done.
2. Further digits. Of grams with several contents, the earliest segment of each is dealt out by gram. Each task sorts their
   windows through ``window`` bytes in passes of eight bytes, going on only inside groups that still hold several suffixes.
   Every group knows the earliest document it occurs in.
3. A gram with very many contents (the edge of a passage of a large part of all documents) is not one task's work: its
   segments are aggregated by content, then their windows, with partial aggregates on every task.
4. Repeated windows go back to their documents, whose segments are cut again in the same way, and their bytes are removed.

Defined results: texts are UTF-8 bytes, NULL counts as empty, texts under ``window`` bytes stay whole. "Earlier" is by the
whole-number id; rows without id come after all others; rows of equal id, or both without, are not earlier than each other.
Repeated rows get equal results. Whole segments are told apart by 128 bits of hashes (gram and content), windows in steps 2
and 3 by their bytes, and rows of one id by a 64-bit hash of their text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from jobstrata.llm.shares import attach
from jobstrata.llm.text import mix
from jobstrata.session import materialise, scratch

WINDOW = 50
DIGIT = 8  # bytes
HOT = 20_000  # segments of one gram in one task, if that is under a millionth of all
TASK_SEGMENTS = 60_000
RUN_ROWS = 50_000  # rows of one gram judged together
_BLOCK = 1 << 20  # bytes worked on at once
_POSITION = np.uint64((1 << 24) - 1)
_ODD = mix(np.arange(1, 1 << 12, dtype=np.uint64)) | np.uint64(1)  # a factor per digit of a gram
_LAST = (1 << 63) - 1  # rank of rows without id
_SPANS = ArrayType(StructType().add("begin", "integer").add("end", "integer"))


def gram_of(window: int) -> int:
    """Length of the grams; a segment then has at most 35 windows."""
    if window < DIGIT:
        raise ValueError(f"windows need {DIGIT} bytes or more")
    return max(DIGIT, window - 34)


def _offsets(length: int) -> list[int]:
    """Beginnings of the digits of a string; the last one may overlap the one before."""
    return [*range(0, length - DIGIT, DIGIT), length - DIGIT]


def _digits(buffer: bytes, kind: str) -> np.ndarray:
    """The eight bytes from every position on as one number."""
    return np.ndarray(shape=(max(len(buffer) - DIGIT + 1, 0),), dtype=kind, buffer=buffer, strides=(1,))


def _add(h: np.ndarray, digit: np.ndarray, k: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(h + digit * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1))


def _blocks(texts: list[bytes | None], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Pieces of documents of bounded size in all: their documents, first positions and bytes. The pieces of one document
    overlap, so that each window lies in exactly one piece."""
    docs, begins, pieces, size = [], [], [], 0
    for d, text in enumerate(texts):
        text = text or b""
        for begin in range(0, max(len(text) - window + 1, 0), _BLOCK):
            piece = text[begin:begin + _BLOCK + window - 1]
            docs.append(d)
            begins.append(begin)
            pieces.append(piece)
            size += len(piece)
            if size >= _BLOCK:
                yield np.array(docs), np.array(begins), pieces
                docs, begins, pieces, size = [], [], [], 0
    if pieces:
        yield np.array(docs), np.array(begins), pieces


def segments(texts: list[bytes | None], window: int = WINDOW, hashed: bool = True) -> Iterator[tuple[np.ndarray, ...]]:
    """``doc, start, n, gram, content`` of all segments, in order: index of the document, first byte, number of windows, and
    the hashes of the gram and, if asked for, of all bytes."""
    gram = gram_of(window)
    width = window - gram + 1
    for docs, begins, pieces in _blocks(texts, window):
        buffer = b"".join(pieces) + bytes(window)
        total = len(buffer) - window
        digits, h = _digits(buffer, "<u8"), np.zeros(total, np.uint64)
        with np.errstate(over="ignore"):
            for k, factor in zip(_offsets(gram), _ODD):
                h += digits[k:k + total] * factor
            h = mix(h)
        # the place of the lowest hash (leftmost of equals) in every window: minima over spans of doubled length
        low, span = (h & ~_POSITION) | np.arange(total, dtype=np.uint64), 1
        while 2 * span <= width:
            low, span = np.minimum(low[:-span], low[span:]), 2 * span
        if span < width:
            low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes)
        edge = np.zeros(total + 1, np.int8)
        edge[ends - sizes] += 1
        edge[ends - window + 1] -= 1  # pieces have a window at least
        at = np.flatnonzero(np.cumsum(edge)[:len(low)] > 0)
        place = (low[at] & _POSITION).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)]))
        piece = np.searchsorted(ends, at[new], "right")
        n, content = np.diff(np.append(new, len(at))), np.zeros(len(new), np.uint64)
        for first in (at[new], at[new] + n - 1):  # the first and the last window cover all
            for k in _offsets(window) if hashed else ():
                content = _add(content, digits[first + k], k)
        yield docs[piece], at[new] - (ends - sizes)[piece] + begins[piece], n, h[place[new]], content


def radix_groups(buffer: bytes, starts: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes (as indexes into ``starts``) whose first ``window`` bytes occur more than once, in order of these bytes, and
    the number of the group of each."""
    digits, index, group = _digits(buffer, ">u8"), np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for k in _offsets(window):
        digit = digits[starts[index] + k].astype(np.uint64)
        order = np.lexsort((digit, group)) if k else np.argsort(digit)
        index, digit, group = index[order], digit[order], group[order]
        new = np.concatenate([[True], (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])])[:len(index)]
        group = np.cumsum(new) - 1
        several = np.bincount(group, minlength=1)[group] > 1
        index, group = index[several], group[several]
    return index, group


def _firsts(doc: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """For every segment of a block the first one of its document with the same hashes."""
    with np.errstate(over="ignore"):
        key = h + doc.astype(np.uint64) * _ODD[0]
    _, first, group = np.unique(key, return_index=True, return_inverse=True)
    first = first[group]
    same = (h[first] == h) & (g[first] == g) & (doc[first] == doc)
    return np.where(same, first, np.arange(len(first)))  # where keys collide, a segment stands for itself


def _contents(rows: DataFrame, window: int) -> DataFrame:
    """``g, h, r, u, a``: every segment of a document, equal ones once per block, by the hashes of gram and content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r, u = batch["r"].to_numpy(), batch["u"].to_numpy()
            for doc, a, _, _, g, h in _by_document(batch["t"].to_pylist(), window, True):
                keep = np.flatnonzero(_firsts(doc, g, h) == np.arange(len(doc)))
                doc = doc[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (g[keep].view(np.int64), h[keep].view(np.int64), r[doc], u[doc], a[keep])],
                    ["g", "h", "r", "u", "a"])

    return rows.mapInArrow(run, "g long, h long, r long, u long, a long")


def _sorted_out(batches: Iterator[pa.RecordBatch], most: int = RUN_ROWS) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``g, h, r``: segments whose content occurs in an earlier document (``mask`` -1, all windows) and, of
    grams with several contents in several documents, the first segment of each content (no mask, but with the gram). The
    rows of a gram are judged together if they are no more than ``most``; beyond, one by one as if it were such a gram."""
    def judged(rows: pa.Table, content: int | None, low: int, whole: bool) -> tuple[pa.RecordBatch, int, int]:
        g, h, r = (rows[c].to_numpy() for c in ("g", "h", "r"))
        new_g = np.concatenate([[True], g[1:] != g[:-1]])
        new = np.concatenate([[content != h[0]], (h[1:] != h[:-1]) | new_g[1:]])
        first = np.flatnonzero(new)
        lows = np.append(r[first], low)[np.cumsum(new) - 1]  # of the content before, if the first row continues it
        check = r == lows
        if whole:
            begin, gram = np.flatnonzero(new_g), np.cumsum(new_g) - 1
            several = np.minimum.reduceat(r, begin) < np.maximum.reduceat(r, begin)
            check &= (several & (np.bincount(gram[first], minlength=len(begin)) > 1))[gram]
        late = r > lows
        keep = late | check
        mask = pa.array(np.full(int(keep.sum()), -1, np.int64), mask=check[keep])
        some = rows.filter(pa.array(keep)).combine_chunks()
        columns = [some[c].combine_chunks() if some.num_rows else pa.array([], pa.int64()) for c in ("r", "u", "a", "g")]
        return pa.RecordBatch.from_arrays([*columns, mask], ["r", "u", "a", "g", "mask"]), int(h[-1]), int(lows[-1])

    held, gram, content, low = None, None, None, 0  # rows of the last gram; or that gram, when it has too many
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        held, g = None, rows["g"].to_numpy()
        if gram is not None:
            n = int(np.searchsorted(g, gram, "right"))  # sorted
            if n:
                out, content, low = judged(rows.slice(0, n), content, low, False)
                yield out
            if n == len(g):
                continue
            rows, g, gram, content = rows.slice(n), g[n:], None, None
        begin = int(np.searchsorted(g, g[-1], "left"))
        if begin:
            yield judged(rows.slice(0, begin), None, 0, True)[0]
        held = rows.slice(begin)
        if held.num_rows > most:
            gram = int(g[-1])
            out, content, low = judged(held, None, 0, False)
            yield out
            held = None
    if held is not None:
        yield judged(held, None, 0, True)[0]


def _first_digit(rows: DataFrame, window: int) -> DataFrame:
    """``r, u, a, g, mask``: what is left when segments are sorted by gram and content."""
    dealt = _contents(rows, window).repartition("g").sortWithinPartitions("g", "h", "r")
    return materialise(dealt.mapInArrow(_sorted_out, "r long, u long, a long, g long, mask long"), "first_digit")


def _hot_grams(open_segments: DataFrame, hot: int) -> tuple[np.ndarray, int]:
    """Grams with more segments than one task should hold (less than a million in number), and the number of all segments."""
    total = open_segments.count()
    most = open_segments.groupBy("g").count().where(F.col("count") > max(hot, total // 1_000_000)).select("g")
    return np.sort(most.toArrow()["g"].to_numpy().astype(np.int64)), total


def _by_document(texts: list[bytes | None], window: int, hashed: bool = False) -> Iterator[tuple[np.ndarray, ...]]:
    """``segments`` with the number of each within its document: ``doc, a, start, n, gram, content``."""
    last, before = -1, 0
    for doc, start, n, g, h in segments(texts, window, hashed):
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        a = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
        if doc[0] == last:  # a long document goes on
            a[doc == last] += before
        last, before = int(doc[-1]), int(a[-1]) + 1
        yield doc, a, start, n, g, h


def _cut_segments(listed: DataFrame, hot: np.ndarray, window: int) -> DataFrame:
    """``key, g, hot, seg, r, u, a``: the bytes of the segments that the list ``segs`` of their document names."""
    held = listed.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, r, u, segs = batch["t"].to_pylist(), batch["r"].to_numpy(), batch["u"].to_numpy(), batch["segs"]
            size = np.diff(segs.offsets.to_numpy())
            wanted_doc, wanted = np.repeat(np.arange(len(texts)), size), segs.flatten().to_numpy()
            for doc, a, start, n, g, _ in _by_document(texts, window):
                here = np.concatenate([wanted[wanted_doc == d] + (int(d) << 40) for d in np.unique(doc)])
                at = np.flatnonzero(np.isin(a + (doc << 40), here))
                doc, a, g = doc[at], a[at], g[at].view(np.int64)
                pieces = [texts[d][b:e] for d, b, e in zip(doc.tolist(), start[at].tolist(), (start[at] + n[at] + window - 1).tolist())]
                much = np.isin(g, held.value)
                with np.errstate(over="ignore"):
                    spread = mix(r[doc].view(np.uint64) + a.astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.where(much, spread, g)), pa.array(g), pa.array(much), pa.array(pieces, pa.binary()), pa.array(r[doc]),
                     pa.array(u[doc]), pa.array(a)], ["key", "g", "hot", "seg", "r", "u", "a"])

    return listed.mapInArrow(run, "key long, g long, hot boolean, seg binary, r long, u long, a long")


def _first_of(segs: list[bytes], low: np.ndarray, window: int) -> np.ndarray:
    """Bit masks of the windows of each segment that occur in a segment of lower rank."""
    sizes = np.array([len(s) for s in segs])
    n = sizes - window + 1
    which = np.repeat(np.arange(len(segs)), n)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    index, group = radix_groups(b"".join(segs), (np.cumsum(sizes) - sizes)[which] + nth, window)
    masks = np.zeros(len(segs), np.int64)
    if len(index):
        first = np.full(group[-1] + 1, _LAST, np.int64)
        np.minimum.at(first, group, low[which[index]])
        late = index[low[which[index]] > first[group]]
        np.bitwise_or.at(masks, which[late], np.int64(1) << nth[late])
    return masks


def _marks(cut: DataFrame, window: int) -> DataFrame:
    """``r, u, a, mask, seg``: the windows of a segment that occur earlier; segments of hot grams go on without a mask."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts = ["r", "u", "a", "mask", "seg"], []
        for batch in batches:
            much = batch["hot"].to_numpy(zero_copy_only=False)
            if much.any():
                some = batch.filter(pa.array(much))
                yield pa.RecordBatch.from_arrays([some["r"], some["u"], some["a"], pa.nulls(some.num_rows, pa.int64()), some["seg"]], names)
            parts.append(batch.filter(pa.array(~much)))
        rows = pa.Table.from_batches(parts) if parts else None
        if rows is None or not rows.num_rows:
            return
        g, r = rows["g"].to_numpy(), rows["r"].to_numpy()
        number: dict[bytes, int] = {}
        seg = np.array([number.setdefault(s, len(number)) for s in rows["seg"].to_pylist()], np.int64)
        segs, low, gram = list(number), np.full(len(number), _LAST, np.int64), np.zeros(len(number), np.int64)
        np.minimum.at(low, seg, r)
        gram[seg] = g
        _, at, count = np.unique(gram, return_inverse=True, return_counts=True)
        several = np.flatnonzero(count[at] > 1)
        partly = np.zeros(len(segs), np.int64)
        if len(several):
            partly[several] = _first_of([segs[k] for k in several], low[several], window)
        full = (np.int64(1) << np.array([len(s) - window + 1 for s in segs], np.int64)) - 1
        mask = np.where(r > low[seg], full[seg], partly[seg])
        keep = mask != 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(r[keep]), pa.array(rows["u"].to_numpy()[keep]), pa.array(rows["a"].to_numpy()[keep]), pa.array(mask[keep]),
             pa.nulls(int(keep.sum()), pa.binary())], names)

    return cut.mapInArrow(run, "r long, u long, a long, mask long, seg binary")


def _hot_marks(rows: DataFrame, window: int) -> DataFrame:
    """``r, u, a, mask`` of segments of hot grams: by whole segments, then by whole windows of the different segments."""
    segs = materialise(rows.groupBy("seg").agg(F.min("r").alias("low"), F.count(F.lit(1)).alias("n")), "hot_segments")
    cut = F.transform(F.sequence(F.lit(1), F.octet_length("seg") - (window - 1)), lambda p: F.substring("seg", p, F.lit(window)))
    wins = segs.select("seg", "low", F.posexplode(cut).alias("j", "w"))
    firsts = wins.groupBy("w").agg(F.min("low").alias("first"), F.max("low").alias("last"), F.count(F.lit(1)).alias("n"))
    firsts = materialise(firsts.where("first < last"), "hot_windows")
    late = attach(wins, F.col("w"), firsts, "w", "n", ["first"]).where("first < low")
    partly = late.groupBy("seg").agg(F.bit_or(F.expr("shiftleft(1L, j)")).alias("partly"))
    known = materialise(segs.join(partly, "seg", "left"), "hot_partly")
    both = attach(rows.select("r", "u", "a", "seg"), F.col("seg"), known, "seg", "n", ["low", "partly"])
    full = F.expr(f"shiftleft(1L, octet_length(seg) - {window - 1}) - 1")
    mask = F.when(F.col("r") > F.col("low"), full).otherwise(F.coalesce("partly", F.lit(0)))
    return both.select("r", "u", "a", mask.alias("mask")).where("mask <> 0")


def removed(texts: list[bytes], marks: list[tuple[np.ndarray, np.ndarray]], window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """Maximal runs of bytes covered by marked windows (numbers of segments and their masks), as begins and ends, of every text."""
    edges = [np.zeros(len(t) + 1, np.int32) for t in texts]
    for docs, numbers, starts, counts, g, h in _by_document(texts, window, True):
        cut = [0, *(np.flatnonzero(docs[1:] != docs[:-1]) + 1).tolist(), len(docs)]
        own = np.zeros(len(docs), np.int64)
        for begin, end in zip(cut, cut[1:]):
            a, mask = marks[docs[begin]]
            inside = (a >= numbers[begin]) & (a <= numbers[end - 1])
            own[a[inside] - numbers[begin] + begin] = mask[inside]
        own = own[_firsts(docs, g, h)]  # only the first of equal ones has a mask
        for begin, end in zip(cut, cut[1:]):
            edge, mask, start, n = edges[docs[begin]], own[begin:end], starts[begin:end], counts[begin:end]
            whole = mask == -1
            np.add.at(edge, start[whole], 1)
            np.add.at(edge, start[whole] + n[whole] + window - 1, -1)
            for k in np.flatnonzero(mask > 0).tolist():
                at = int(start[k]) + np.flatnonzero(int(mask[k]) >> np.arange(int(n[k])) & 1)
                edge[at] += 1
                edge[at + window] -= 1
    out = []
    for edge in edges:
        inside = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        out.append(list(zip(turns[::2].tolist(), turns[1::2].tolist())))
    return out


def _cleaned(rows: DataFrame, window: int) -> DataFrame:
    """``row, t, ms`` to ``row, kept, spans``."""
    schema = rows.select("row").schema.add("kept", "binary").add("spans", _SPANS)
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, ms = [t or b"" for t in batch["t"].to_pylist()], batch["ms"].to_pylist()
            hit = [k for k, m in enumerate(ms) if m]
            spans: list[list] = [[] for _ in kept]
            marks = [tuple(np.array([m[c] for m in ms[k]], np.int64) for c in ("a", "mask")) for k in hit]
            for k, runs in zip(hit, removed([kept[k] for k in hit], marks, window)):
                spans[k] = [{"begin": b, "end": e} for b, e in runs]
                text, stays = kept[k], [0, *chain.from_iterable(runs), len(kept[k])]
                kept[k] = b"".join(text[b:e] for b, e in zip(stays[::2], stays[1::2]))
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(kept, pa.binary()), pa.array(spans, kind)], ["row", "kept", "spans"])

    return rows.select("row", "t", "ms").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, text: str = "text", id: str = "doc_id", *, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """All rows with ``kept`` (the remaining bytes) and ``spans`` (the removed runs, in bytes) in place of the text and of columns
    of these names. A byte is removed if it lies in a ``window`` that also starts in an earlier document of the input."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text, "kept", "spans")]
    repeated = docs.groupBy(F.col(f"`{id}`")).count().where("count > 1")
    # rows of one id are told apart by their text; where there are none, the rank says it all
    u = F.lit(0).cast("long") if repeated.isEmpty() else F.xxhash64(f"`{text}`")
    keyed = docs.select(F.struct(*rest).alias("row"), F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(_LAST)).alias("r"), u.alias("u"),
                        F.col(f"`{text}`").cast("binary").alias("t"))
    long_enough = keyed.where(F.octet_length("t") >= window).drop("row")
    with scratch(docs.sparkSession) as scope:
        first = _first_digit(long_enough, window)
        still = first.where("mask is null")
        much, total = _hot_grams(still, hot)
        lists = still.groupBy("r", "u").agg(F.collect_set("a").alias("segs"))
        tasks = max(1, -(-total // TASK_SEGMENTS))
        dealt = _cut_segments(long_enough.join(lists, ["r", "u"]), much, window).repartition(tasks, "key")
        marked = materialise(_marks(dealt, window), "marks")
        masks = first.where("mask is not null").select("r", "u", "a", "mask").unionByName(
            marked.where("mask is not null").select("r", "u", "a", "mask"))
        if len(much):
            masks = masks.unionByName(_hot_marks(marked.where("mask is null"), window))
        found = scope.result(masks.groupBy("r", "u").agg(F.collect_set(F.struct("a", "mask")).alias("ms")), "repeats")
    return _cleaned(keyed.join(found, ["r", "u"], "left"), window).select("row.*", "kept", "spans")
