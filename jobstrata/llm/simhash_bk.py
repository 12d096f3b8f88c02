"""SimHash near-duplicates: fingerprints linked at a small Hamming distance, found with BK-trees.

1. A fingerprint per text, taken inside Arrow batches; equal fingerprints collapse before anything else.
2. Two fingerprints within ``radius`` bits agree on at least one of ``radius + 1`` bit blocks. Every fingerprint is dealt
   to one shard per block, keyed by block and its bits. A shard that is still large is dealt again by blocks of its
   remaining bits, until it is small or so few bits remain that all its members are linked. No shard grows with a hot
   bit pattern, and no link is lost.
3. A BK-tree per shard: children are keyed by their integer Hamming distance to the parent, and a search follows only the
   edges within the radius. Trees live in the task that holds the shard; shipping all of them to every task would ship
   all fingerprints. Members join a union-find structure as they are inserted, so a shard emits one edge per linked
   member, never all pairs; a subtree known to be of the searcher's own class is skipped.
4. Classes of the edges (``components``), and the smallest id of each class.

Defined results: NULL, empty and blank texts have fingerprint 0 and are linked like any other; texts of one or two words
have the hash of the whole sequence; repeated rows share a class; a row without id gets the class id of the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.components import classes
from jobstrata.session import materialise

SEED = 42
SHINGLE = 3
RADIUS = 3
SHARD_ROWS = 2048
_CHUNK = 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None) -> int:
    """Majority bits of the XXH64 of all 3-word shingles; hashes are counted in bounded chunks."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return digest(b" ".join(words), SEED)
    ones, n = np.zeros(64, np.int64), len(words) - SHINGLE + 1
    for begin in range(0, n, _CHUNK):
        part = words[begin:begin + _CHUNK + SHINGLE - 1]
        found = [digest(b"%b %b %b" % s, SEED) for s in zip(part, part[1:], part[2:])]
        bits = np.unpackbits(np.array(found, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by ``fp``, its fingerprint as a signed long."""
    rest = [c for c in docs.columns if c not in (text, "fp")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signed(fingerprint(t)) for t in batch["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.int64())], [*rest, "fp"])

    ordered = docs.select(F.col(text).alias("_text"), *[F.col(f"`{c}`") for c in rest])
    return ordered.mapInArrow(run, ordered.drop("_text").schema.add("fp", "long"))


# ---- shards ----------------------------------------------------------------------------------------------------


def split_bits(bits: list[int], parts: int) -> list[list[int]]:
    """Near-equal blocks of the given bit positions."""
    return [b.tolist() for b in np.array_split(np.array(bits, int), parts)]


def mask_of(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def _deal(members: DataFrame, left: dict[str, list[int]], radius: int) -> tuple[DataFrame, dict[str, list[int]]]:
    """Members of shards to the shards of one block more: ``fp, path, held`` (the bits that all members share)."""
    choices, after = [], {}
    for path, bits in left.items():
        for k, block in enumerate(split_bits(bits, radius + 1)):
            name = f"{path}{k}"
            after[name] = [b for b in bits if b not in block]
            fixed = [b for b in range(64) if b not in after[name]]
            choices.append((path, name, mask_of(fixed)))
    table = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(n).alias("path"), F.lit(m).cast("long").alias("m"))
                      for p, n, m in choices])
    own = F.filter(table, lambda c: c["p"] == F.col("path"))
    dealt = members.select("fp", F.explode(own).alias("c")).select(
        "fp", F.col("c.path").alias("path"), F.col("fp").bitwiseAND(F.col("c.m")).alias("held"))
    return dealt, after


class _Tree:
    """BK-tree over one shard that keeps classes of linked members."""

    def __init__(self, radius: int):
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.parent: list[int] = []  # union-find
        self.alike: list[bool] = []  # the whole subtree is one class

    def find(self, k: int) -> int:
        parent = self.parent
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def add(self, value: int) -> None:
        """Insert a value after linking it to all members within the radius."""
        values, children, radius = self.values, self.children, self.radius
        new = len(values)
        values.append(value)
        children.append({})
        self.parent.append(new)
        self.alike.append(True)
        if not new:
            return
        mine, stack = new, [0]
        while stack:
            k = stack.pop()
            root = self.find(k)
            if root == mine and self.alike[k]:
                continue
            d = (values[k] ^ value).bit_count()
            if d <= radius and root != mine:
                low, high = min(root, mine), max(root, mine)
                self.parent[high] = mine = low
            if children[k]:
                stack += [c for e, c in children[k].items() if d - radius <= e <= d + radius]
        k = 0
        while True:  # insertion
            if self.alike[k] and self.find(k) != mine:
                self.alike[k] = False
            d = (values[k] ^ value).bit_count()
            if d not in children[k]:
                children[k][d] = new
                return
            k = children[k][d]


def _search(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Sorted ``path, held, fp`` to edges from each linked member to a member of its class."""
    mask = (1 << 64) - 1
    tree, shard, out = _Tree(radius), None, ([], [])

    def close() -> None:
        for k in range(len(tree.values)):
            if (root := tree.find(k)) != k:
                out[0].append(_signed(tree.values[k]))
                out[1].append(_signed(tree.values[root]))

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], ["a", "b"])
        for o in out:
            o.clear()
        return batch

    for batch in batches:
        for path, held, fp in zip(*[batch[c].to_pylist() for c in ("path", "held", "fp")]):
            if (path, held) != shard:
                close()
                tree, shard = _Tree(radius), (path, held)
            tree.add(fp & mask)
        if len(out[0]) > 50_000:
            yield flush()
    close()
    yield flush()


def links(distinct: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges ``a, b`` whose classes are those of all pairs of the distinct ``fp`` within the radius."""
    members = distinct.select("fp", F.lit("").alias("path"))
    left: dict[str, list[int]] = {"": list(range(64))}
    parts = []
    while True:
        dealt, left = _deal(members, left, radius)
        dealt = materialise(dealt, "shards")
        large = dealt.groupBy("path", "held").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_rows)
        large = materialise(large, "large_shards")
        if large.isEmpty():
            parts.append(dealt)
            break
        parts.append(dealt.join(large, ["path", "held"], "left_anti"))
        hot = dealt.join(large, ["path", "held"])
        few = [p for p, bits in left.items() if len(bits) <= radius]
        if few:  # whatever differs only in these bits is linked
            first = large.where(F.col("path").isin(few)).select("path", "held")
            inside = hot.join(first, ["path", "held"])
            heads = inside.groupBy("path", "held").agg(F.min("fp").alias("b"))
            linked = inside.join(heads, ["path", "held"]).where("fp <> b").select(F.col("fp").alias("a"), "b")
            hot, left = hot.where(~F.col("path").isin(few)), {p: b for p, b in left.items() if p not in few}
            parts.append(linked)
            if not left:
                break
        used = {r["path"] for r in large.select("path").distinct().collect()}  # paths are few: 4 per level
        left = {p: b for p, b in left.items() if p in used}
        members = hot.select("fp", "path")
    edges = None
    for part in parts:
        if "path" in part.columns:
            part = (part.repartition("path", "held").sortWithinPartitions("path", "held", "fp")
                    .mapInArrow(lambda it: _search(it, radius), "a long, b long"))
        edges = part if edges is None else edges.unionByName(part)
    return edges.distinct()


def _classes_of(marked: DataFrame, id: str, radius: int) -> DataFrame:
    """``fp, component_id`` of every distinct fingerprint."""
    firsts = materialise(marked.groupBy("fp").agg(F.min(id).alias("first_id")), "distinct_fingerprints")
    linked = classes(links(firsts.select("fp"), radius))
    named = firsts.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    best = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return materialise(named.select("fp", "root").join(best, "root"), "fingerprint_classes")


def near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``id, fp, component_id`` for every row."""
    marked = materialise(fingerprints(docs.select(id, text), text), "fingerprints")
    return marked.join(_classes_of(marked, id, radius), "fp").select(id, "fp", "component_id")


def hexadecimal(fp):
    """16 lower-case digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, text: str = "text", id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One row of every class: that of its smallest id; of several rows with that id, that of the smallest fingerprint."""
    marked = materialise(fingerprints(docs.select(id, text), text), "fingerprints")
    named = marked.join(_classes_of(marked, id, radius), "fp").where(F.col(id).eqNullSafe(F.col("component_id")))
    first = materialise(named.groupBy("root").agg(F.min(F.struct(F.col(id).alias("id"), F.col("fp").alias("fp"))).alias("x"))
                        .select(F.col("x.id").alias("_id"), F.col("x.fp").alias("_fp")), "kept_rows")
    if marked.groupBy(id).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return docs.join(first, F.col(f"`{id}`").eqNullSafe(F.col("_id")), "left_semi")
    again = fingerprints(docs.withColumn("_text", F.col(text)), "_text")  # ids repeat: tell rows apart by fingerprint
    kept = again.join(first, F.col(f"`{id}`").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")), "left_semi")
    return kept.dropDuplicates([id, "fp"]).select(*docs.columns)
