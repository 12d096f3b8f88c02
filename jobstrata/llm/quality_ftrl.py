"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text becomes runs of letters, of digits (each digit counts as ``0``) and of one repeated mark; a run equal to the one
before it is replaced by a repeat sign. Unigrams and bigrams of runs are hashed to ``2**BITS`` features whose value is
count / sqrt(all grams). A score is the logistic of a sparse dot product, worked out for whole Arrow batches at a time.

Training uses at most about ``max_rows`` labelled rows, dealt to a few shards by a hash of their text; every shard
runs the updates on its own rows and the weights are averaged by one aggregation. The weight vector (``2**BITS`` single
precision numbers at most) is the only thing the driver holds or broadcasts.

Defined results: NULL and empty texts have no gram and get the score of the bias alone; labels that are NULL, not 0/1 or
contradict each other teach nothing; without training rows every score is 0.5; repeated rows score alike. A run of over
``BLOCK`` bytes without white space is hashed in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.quality_rules import one_label
from jobstrata.llm.text import mix, span_hashes

BITS = 18
BLOCK = 1 << 20
_SPACES = b" \t\n\x0b\x0c\r"
_REPEAT = np.uint64(0x5851F42D4C957F2D)
_PAIR = np.uint64(0xD1B54A32D192ED03)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind of every byte (0 white space, 1 letter, 2 digit, else the mark itself) and the byte it is hashed as."""
    kind, as_byte = np.arange(256, dtype=np.uint8), np.arange(256, dtype=np.uint8)
    kind[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = 1
    kind[48:58] = 2
    kind[list(_SPACES)] = 0
    as_byte[48:58] = 48
    return kind, as_byte


_KIND, _AS_BYTE = _tables()


def blocks(texts: list[str | None], block: int = BLOCK) -> Iterator[tuple[bytes, list[int], list[int], bool]]:
    """Bytes of consecutive texts, where each begins, its number, and whether the first goes on from the last block."""
    parts, at, numbers, size = [], [], [], 0
    for number, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace")
        if size and size + len(data) > block:
            yield b"".join(parts), at, numbers, False
            parts, at, numbers, size = [], [], [], 0
        begin, goes_on = 0, False
        while len(data) - begin > block:
            cut = max(data.rfind(bytes([c]), begin + 1, begin + block) for c in _SPACES)
            cut = cut if cut > begin else begin + block
            yield data[begin:cut], [0], [number], goes_on
            begin, goes_on = cut, True
        if goes_on:
            yield data[begin:], [0], [number], True
        else:
            parts += [data, b"\n"]
            at.append(size)
            numbers.append(number)
            size += len(data) + 1
    if parts:
        yield b"".join(parts), at, numbers, False


def grams(texts: list[str | None], block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each block of texts: numbers of texts, and the features of their unigrams and bigrams, one per occurrence."""
    shift, last = np.uint64(64 - BITS), None
    for data, at, numbers, goes_on in blocks(texts, block):
        raw = np.frombuffer(data, np.uint8)
        kind = _KIND[raw]
        new = np.empty(len(kind), bool)
        new[:1] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        edges = np.append(np.flatnonzero(new), len(kind))
        word = kind[edges[:-1]] != 0 if len(kind) else np.zeros(0, bool)
        starts, ends = edges[:-1][word], edges[1:][word]
        if not len(starts):
            if not goes_on:
                last = None
            continue
        h = span_hashes(_AS_BYTE[raw], starts, ends)
        owner = np.searchsorted(np.asarray(at), starts, "right") - 1
        before = np.concatenate([h[:1], h[:-1]])
        joined = np.concatenate([[False], owner[1:] == owner[:-1]])
        if goes_on and last is not None:
            before[0], joined[0] = last, True
        with np.errstate(over="ignore"):
            token = np.where(joined & (h == before), _REPEAT, h)
            pair = mix(before * _PAIR + token)[joined]
        number = np.asarray(numbers)[owner]
        last = h[-1]
        yield (np.concatenate([number, number[joined]]),
               (np.concatenate([mix(token), pair]) >> shift).astype(np.int64))


def sums(texts: list[str | None], weights: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the weights of every text's grams, and how many grams it has."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for number, feature in grams(texts, block):
        total += np.bincount(number, weights[feature], len(texts))
        count += np.bincount(number, minlength=len(texts))
    return total, count


class Ftrl:
    """Per-coordinate follow-the-regularised-leader with L1 and L2 terms; the last coordinate is the bias."""

    def __init__(self, alpha: float = 0.1, beta: float = 1.0, l1: float = 0.01, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, index=slice(None)) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(index)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30)))
        g = (p - label) * value
        n = self.n[index]
        self.z[index] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[index] = n + g * g


def _examples(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for number, feature in grams(texts):
        order = np.argsort(number, kind="stable")
        number, feature = number[order], feature[order]
        cut = np.flatnonzero(np.diff(number)) + 1
        for k, piece in zip(number[np.concatenate([[0], cut])], np.split(feature, cut)):
            parts[k].append(piece)
    out = []
    for own in parts:
        index, count = np.unique(np.concatenate(own) if own else np.zeros(0, np.int64), return_counts=True)
        out.append((np.append(index, 1 << BITS), np.append(count / np.sqrt(max(1, count.sum())), 1.0)))
    return out


def _train_shard(batches: Iterator[pa.RecordBatch], epochs: int) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[tuple[np.ndarray, np.ndarray], int]] = []
    for batch in batches:  # the bounded sample of one shard
        rows += zip(_examples(batch["text"].to_pylist()), batch["label"].to_pylist())
    if not rows:
        return
    model, order = Ftrl(), np.random.default_rng(0)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            model.update(*rows[k][0], rows[k][1])
    w = model.weights()
    kept = np.flatnonzero(w)
    kept = np.append(kept[kept < 1 << BITS], 1 << BITS)  # the bias is always there: it counts the shards
    yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(w[kept], pa.float64())], ["feature", "w"])


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """``text, label`` of about ``max_rows`` labelled rows at most, chosen by a hash of the id."""
    known = one_label(labels, "quality").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)
    share = min(1.0, max_rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 20)) < int(share * (1 << 20)))
    return docs.select("doc_id", "text").join(known, "doc_id").select("text", F.col("label").cast("int").alias("label"))


def fit(rows: DataFrame, shards: int = 4, epochs: int = 4) -> np.ndarray:
    """Averaged weights of the shards; the last one is the bias."""
    dealt = rows.repartition(shards, F.pmod(F.xxhash64("text"), F.lit(shards))).sortWithinPartitions("text", "label")
    parts = dealt.mapInArrow(lambda it: _train_shard(it, epochs), "feature int, w double")
    table = parts.groupBy("feature").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).toArrow()
    weights, feature = np.zeros((1 << BITS) + 1), table["feature"].to_numpy()
    if len(feature):
        weights[feature] = table["w"].to_numpy() / table["n"].to_numpy()[feature == 1 << BITS][0]
    return weights


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", score: str = "score") -> DataFrame:
    """Replace the text by its score; all other columns stay, ``score`` wins over a column of that name."""
    held = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    rest = [c for c in docs.columns if c not in (text, score)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value
        for batch in batches:
            total, count = sums(batch["_text"].to_pylist(), w[:-1])
            p = 1 / (1 + np.exp(-np.clip(total / np.sqrt(np.maximum(count, 1)) + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(p, pa.float64())], [*rest, score])

    fields = [docs.schema[c] for c in rest]
    schema = docs.select(*[F.col(f"`{f.name}`") for f in fields]).schema.add(score, "double")
    return docs.select(F.col(text).alias("_text"), *[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)
