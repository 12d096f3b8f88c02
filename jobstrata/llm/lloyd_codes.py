"""Vector codes by product quantisation, with codebooks from active-entry Lloyd rounds in exact whole numbers.

1. Every component x becomes ``floor(256 x)``; vectors are cut into ``parts`` equal parts. The codebook of a part position
   starts as that part of the ``entries`` smallest ids.
2. A round assigns every part to its nearest entry (squared distance, ties to the lower index) and replaces the entries by
   the floored means of their parts. Codes and exact distances are stored with the vectors.
3. From the second assignment on only active entries count. A part whose entry did not move keeps its stored distance and
   is compared with the moved entries alone: every other entry was farther, or as far with a higher index, and still is. A
   part whose entry moved is compared with all entries.

Assignment runs inside Arrow batches; each task adds up its sums per entry, so that the shuffle carries one row per task,
entry and component, and the driver one number per component of the codebooks, however many vectors there are.

Defined results: rows whose vector is NULL or holds a NULL, NaN or infinite component are left out. The length that most
vectors have counts (of equally frequent ones the larger); vectors of another length, or all if it is no multiple of
``parts``, get NULL as code and error. Rows without id are coded but start no codebook; of repeated ids each row counts,
in the order of its vector. An empty table gives an empty result. Components over 2**26 in size (of the whole numbers)
raise, as sums of squares might not fit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.shares import attach
from jobstrata.session import materialise, scratch

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
MOST = 1 << 26
_BLOCK = 4096  # vectors compared at once
_STATE = ["code", "dist", "error"]


def whole_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """Rows with finite vectors, these as arrays of whole numbers in ``v``."""
    x = F.col(vector)
    # NULL in every comparison with a NULL component, so test for it first
    broken = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = rows.where(x.isNotNull() & ~broken)
    scaled = F.transform(x, lambda c: c.cast("double") * SCALE)
    too_large = F.raise_error(F.lit("a component is too large to code")).cast("array<int>")
    return kept.withColumn("v", F.when(F.exists(scaled, lambda c: F.abs(c) > MOST), too_large).otherwise(
        F.transform(scaled, lambda c: F.floor(c).cast("int"))))


def distances(part: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of parts (n, w) to entries (k, w)."""
    out = np.zeros((len(part), len(book)), np.int64)
    for j in range(part.shape[1]):
        gap = part[:, j, None] - book[None, :, j]
        out += gap * gap
    return out


def nearest(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the lower of equals) and its distance."""
    d = distances(part, book)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(d)), best]


def reassign(part: np.ndarray, code: np.ndarray, dist: np.ndarray, book: np.ndarray, moved: np.ndarray) -> None:
    """Bring codes and distances of one part position, in place, up to date with a book in which some entries moved."""
    rescan = moved[code]
    active = np.flatnonzero(moved)
    stay = np.flatnonzero(~rescan)
    if len(active) and len(stay):
        at, d = nearest(part[stay], book[active])
        at = active[at]
        won = (d < dist[stay]) | ((d == dist[stay]) & (at < code[stay]))
        code[stay[won]], dist[stay[won]] = at[won], d[won]
    again = np.flatnonzero(rescan)
    if len(again):
        code[again], dist[again] = nearest(part[again], book)


def _blocks(batch: pa.RecordBatch, parts: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Slices of the batch and their vectors as (n, parts, w)."""
    column = batch["v"]
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    matrix = flat.reshape(len(column), parts, -1)
    for begin in range(0, len(column), _BLOCK):
        rows = slice(begin, min(begin + _BLOCK, len(column)))
        yield rows, matrix[rows]


def _assigned(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """Add (or renew) ``code``, one byte per part, ``dist``, the exact distances as 64-bit numbers, and their sum."""
    parts, rest = len(books), [c for c in rows.columns if c not in _STATE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.empty((batch.num_rows, parts), np.uint8)
            dists = np.empty((batch.num_rows, parts), np.int64)
            if moved is not None:
                codes[:] = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(-1, parts)
                dists[:] = np.frombuffer(b"".join(batch["dist"].to_pylist()), np.int64).reshape(-1, parts)
            for at, block in _blocks(batch, parts):
                for p in range(parts):
                    if moved is None:
                        codes[at, p], dists[at, p] = nearest(block[:, p], books[p])
                    else:
                        reassign(block[:, p], codes[at, p], dists[at, p], books[p], moved[p])
            made = [pa.array([x.tobytes() for x in codes], pa.binary()), pa.array([x.tobytes() for x in dists], pa.binary()),
                    pa.array(dists.sum(axis=1), pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in rest], *made], [*rest, *_STATE])

    schema = rows.select(*rest).schema.add("code", "binary").add("dist", "binary").add("error", "long")
    return rows.mapInArrow(run, schema)


def _means(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The books with every used entry at the floored mean of its parts."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), np.int64)
        used = np.zeros((parts, entries), np.int64)
        for batch in batches:
            codes = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(-1, parts)
            for at, block in _blocks(batch, parts):
                for p in range(parts):
                    np.add.at(sums[p], codes[at, p], block[:, p])
                    used[p] += np.bincount(codes[at, p], minlength=entries)
        p, k = np.nonzero(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(k, pa.int32()), pa.array(used[p, k], pa.int64()),
             pa.array(list(sums[p, k]), pa.list_(pa.int64()))], ["p", "k", "n", "sums"])

    # one row per part position and entry, ``parts * entries`` in all
    total = rows.select("v", "code").mapInArrow(run, "p int, k int, n long, sums array<long>").groupBy("p", "k").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)])
    new = books.copy()
    for r in total.collect():
        new[r.p, r.k] = [r[f"s{j}"] // r.n for j in range(width)]
    return new


def first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """(parts, entries, w): the parts of the vectors of the smallest ids."""
    first = rows.where(F.col("id").isNotNull()).orderBy("id", "v").limit(entries).select("v").collect()
    vectors = np.array([r.v for r in first], np.int64)
    return vectors.reshape(len(first), parts, -1).transpose(1, 0, 2).copy() if first else np.zeros((parts, 0, 1), np.int64)


def code_vectors(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", *, parts: int = PARTS, entries: int = ENTRIES,
                 rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The rows with finite vectors and all their columns but the vector, with ``code`` (binary, one byte per part) and
    ``error`` (squared distance to the coded vector); and the codebooks as (parts, entries, w)."""
    if not 0 < entries <= 256:
        raise ValueError("codes are bytes")
    rest = [c for c in rows.columns if c not in (vector, "code", "error")]
    # the columns that only pass through travel in one struct, so no name of theirs meets one used here
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(f"`{id}`").alias("id"),
                         F.col(f"`{vector}`").alias("x"))
    none = (F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    with scratch(rows.sparkSession) as scope:
        kept = whole_vectors(packed, "x").drop("x")
        sized = kept.groupBy(F.size("v").alias("w")).agg(F.count(F.lit(1)).alias("n"))
        top = sized.orderBy(F.desc("n"), F.desc("w")).first()
        width = top.w if top else 0
        fits = kept.where(F.size("v") == width)
        books = first_books(fits, parts, entries) if width and not width % parts else np.zeros((parts, 0, 0), np.int64)
        if not books.shape[1]:
            return scope.result(kept.select("row.*", *none), "codes"), books
        state = materialise(_assigned(fits.drop("id"), books, None), "assigned")
        for _ in range(rounds):
            new = _means(state, books)
            moved = (new != books).any(axis=2)
            books = new
            state = materialise(_assigned(state, books, moved), "assigned")
        others = kept.where(F.size("v") != width).select("row", *none)
        return scope.result(state.select("row", "code", "error").unionByName(others).select("row.*", "code", "error"), "codes"), books


def books_text(books: np.ndarray) -> str:
    """Decimal components by part, entry and position, joined by commas."""
    return ",".join(map(str, books.reshape(-1).tolist()))


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(books_text(books).encode()).hexdigest()


def with_label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """Add ``label_error``: the errors of all rows of the same label; rows without label share theirs."""
    totals = coded.groupBy(F.col(label).alias("label")).agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    return attach(coded, F.col(label), materialise(totals, "label_errors"), "label", "n", ["label_error"])
