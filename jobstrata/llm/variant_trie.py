"""Spelling variants: words that differ in one letter from others, found by moving a frontier of states through a trie that
is a distributed table.

1. Words are counted inside the tasks first, so that the shuffle carries one row per word and task.
2. One edit leaves the first or the second half of a word as it was. Every word therefore enters two tries, of words and of
   reversed words, and starts at the node of its unchanged half. A word is listed from where words of up to one letter more
   or less may start. Nodes are named by a hash of their prefix; a node that one word alone passes ends its branch and
   names the word.
3. States ``(word, position, node, edits)`` of one depth are joined with the edges that leave the nodes of that depth; edges of
   a node are one row, as there are no more than letters. A state goes on along an edge that equals its next letters or
   differs from them by the one edit it may still make; after its edit only if what is left of the word may follow, by the bits
   that every node keeps of the ends of its words. Words at the ends of
   edges become neighbours if they are one edit away, which is compared on the whole words.
4. Edges have one letter down to a depth of 64; below, depths double, so that even words of 100,000 letters take few levels.

Defined results: NULL texts have no words; a NULL id counts as empty before the colon; repeated rows count each time; words are
told apart by code points, without any normalisation. ``form`` is the most frequent neighbour if it is ``ratio`` times as frequent
as the word, ``root`` the end of the chain of forms, which always grows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.session import materialise, scratch

LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
DELETE_EVERY = 31
SINGLE = 64  # depth down to which edges have one letter
_DEEPEST = 40  # doublings; far more letters than a text can have
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_MASKS = ("pairs", "rests", "rests_2")
_HELD = 200_000  # words counted in a task before they are passed on


def runs_of(text: str, least: int) -> list[str]:
    """Maximal runs of letters of at least this length, with A-Z made small."""
    if text.isascii():
        return re.findall(r"[a-z]{%d,}" % least, text.lower())
    found = re.findall(r"[A-Za-zÀ-ÿ]{%d,}" % least, text)
    return [w.lower() if w.isascii() else w.translate(_LOWER) for w in found]


def misspelt(run: str, seed: int, every: int = DELETE_EVERY) -> str:
    """The run, or for one run in ``every`` (by a checksum that goes on from ``seed``) the run without one letter."""
    h = zlib.crc32(run.encode(), seed)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def count_words(docs: DataFrame, text: str, id: str, least: int = LEAST_LETTERS, every: int = DELETE_EVERY) -> DataFrame:
    """``word, n`` of all words of at least ``least`` letters."""
    def flush(counts: Counter) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
        counts.clear()
        return batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for i, t in zip(batch["i"].to_pylist(), batch["t"].to_pylist()):
                seed = zlib.crc32(f"{i or ''}:".encode())
                # shorter runs cannot become words of that length
                counts.update([misspelt(r, seed, every) for r in runs_of(t or "", least)])
                if len(counts) > _HELD:
                    yield flush(counts)
        yield flush(counts)

    rows = docs.select(F.col(f"`{id}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t"))
    return (rows.mapInArrow(run, "word string, n long").where(F.length("word") >= least)
            .groupBy("word").agg(F.sum("n").alias("n")))


# ---- trie ------------------------------------------------------------------------------------------------------


def _depths() -> list[int]:
    return [*range(SINGLE + 1), *[SINGLE << k for k in range(1, _DEEPEST)]]


def _cut_at(letters: Column) -> Column:
    """The deepest node that a string of that many letters passes or ends at."""
    deep = F.lit(SINGLE).cast("long") * F.pow(F.lit(2), F.floor(F.log2(letters / SINGLE))).cast("long")
    return F.when(letters <= SINGLE, letters.cast("long")).otherwise(deep)


def _node(way: Column, prefix: Column) -> Column:
    return F.xxhash64(way, prefix)


def _oriented(words: DataFrame) -> DataFrame:
    """``way, s, size, begin, top``: words and reversed words with the depths where they start and where they are listed."""
    both = words.select(F.explode(F.array(F.struct(F.lit(0).alias("way"), F.col("word").alias("s")),
                                          F.struct(F.lit(1).alias("way"), F.reverse("word").alias("s")))).alias("x")).select("x.*")
    size = F.length("s")

    def half(letters: Column) -> Column:
        first = F.floor(letters / 2)
        return _cut_at(F.when(F.col("way") == 0, first).otherwise(letters - first))

    return both.select("way", "s", size.alias("size"), half(size).alias("begin"), half(size - 1).alias("top"))


def _passed(oriented: DataFrame) -> DataFrame:
    """A row per word and node it passes: ``node, parent, depth, label, s, ends``, and the next two letters (``pairs``) and all
    further ones (``rests``, ``rests_2``) as bits."""
    size = F.col("size").cast("long")
    deep = F.array(*[F.lit(d).cast("long") for d in _depths() if d > SINGLE])
    own = F.when(size <= SINGLE, F.sequence("top", size)).otherwise(F.concat(
        F.when(F.col("top") <= SINGLE, F.sequence("top", F.lit(SINGLE).cast("long"))).otherwise(F.array().cast("array<bigint>")),
        F.filter(deep, lambda d: (d >= F.col("top")) & (d < size)), F.array(size)))
    # the step from one depth to the next; the first node has no way in
    steps = F.transform(own, lambda d, k: F.struct(d.alias("depth"), F.when(k > 0, F.get(own, k - 1)).alias("before")))
    rows = oriented.select("way", "s", "size", F.explode(steps).alias("x")).select("way", "s", "size", "x.*")
    prefix, before = F.col("s").substr(F.lit(1), F.col("depth").cast("int")), F.col("before").cast("int")
    begins = F.col("depth").cast("int") + 1
    more = F.col("depth") < F.col("size")
    return rows.select(
        _node(F.col("way"), prefix).alias("node"),
        F.when(before.isNotNull(), _node(F.col("way"), F.col("s").substr(F.lit(1), before))).alias("parent"), "depth", "before",
        F.col("s").substr(before + 1, (F.col("depth") - before).cast("int")).alias("label"), "s",
        (F.col("depth") == F.col("size")).alias("ends"),
        F.when(more, _bit(F.col("s").substr(begins, F.lit(2)))).otherwise(F.lit(0).cast("long")).alias("pairs"),
        F.when(more, _bit(F.col("s").substr(begins, F.col("size")))).otherwise(F.lit(0).cast("long")).alias("rests"),
        F.when(more, _bit(F.col("s").substr(begins, F.col("size")), 6)).otherwise(F.lit(0).cast("long")).alias("rests_2"))


def _bit(letters: Column, skip: int = 0) -> Column:
    """One of 64 bits for a string, by its hash behind some digits. The bits of all that may follow a node tell most strings that do not from the others."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(F.xxhash64(letters), skip).bitwiseAND(F.lit(63)).cast("int"))


def edges(oriented: DataFrame) -> DataFrame:
    """``node, depth, out``: nodes that several words pass, with the edges that leave them: label, node below, whether several
    words pass that, what follows it, and the word that ends there (or the only one that passes)."""
    nodes = materialise(_passed(oriented).groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("before").alias("before"), F.count(F.lit(1)).alias("n"), F.max("label").alias("label"),
        F.bit_or("pairs").alias("pairs"), F.bit_or("rests").alias("rests"), F.bit_or("rests_2").alias("rests_2"),
        F.min(F.struct((~F.col("ends")).alias("passes"), "s")).alias("x")), "trie_nodes")
    several = nodes.where("n > 1").select(F.col("node").alias("parent"))
    below = nodes.where("parent is not null").join(several, "parent", "left_semi")
    word = F.when((F.col("n") == 1) | ~F.col("x.passes"), F.col("x.s"))
    out = F.collect_list(F.struct("label", F.col("node").alias("below"), (F.col("n") > 1).alias("goes_on"), "pairs", "rests", "rests_2", word.alias("word")))
    return materialise(below.groupBy("parent").agg(F.max("before").alias("depth"), out.alias("out")).select(
        F.col("parent").alias("node"), "depth", "out"), "trie_edges")


# ---- frontier --------------------------------------------------------------------------------------------------


def _neighbour(word: Column) -> Column:
    """The word if it is one edit away from ``s``."""
    close = F.abs(F.length(word) - F.length("s")) <= 1
    return F.when(F.when(close, F.levenshtein("s", word, 1)) == 1, word)


def _may_follow(at: Column) -> Column:
    """Whether what is behind a position, letter by letter, can come after the edge."""
    own = lambda mask, letters, skip=0: F.col(mask).bitwiseAND(_bit(F.col("s").substr(at + 1, letters), skip)) != 0
    return (at < F.length("s")) & own("pairs", F.lit(2)) & own("rests", F.length("s")) & own("rests_2", F.length("s"), 6)


def _step(x: Column, at: Column, edits: int) -> Column:
    return F.struct(x.alias("x"), at.alias("at"), F.lit(edits).alias("edits"))


def _after_edit(states: DataFrame) -> DataFrame:
    """States that made their edit: the one edge of the next letter, if there is one."""
    letter = F.col("s").substr(F.col("at") + 1, F.lit(1))
    one = states.where("edits = 1").select("way", "s", "at", F.explode(F.filter("out", lambda o: o["label"] == letter)).alias("o"))
    one = one.select("way", "s", "at", "o.*").select("way", "s", "at", "below", "goes_on", *_MASKS, _neighbour(F.col("word")).alias("x"))
    on = F.when(F.col("goes_on") & _may_follow(F.col("at") + 1), F.col("at") + 1)
    # exploded, so that what is computed is computed once and only then looked at
    return one.select("way", "s", F.col("below").alias("node"), F.explode(F.array(_step(F.col("x"), on, 1))).alias("r"))


def _before_edit(states: DataFrame) -> DataFrame:
    """States without an edit: along the edge of the next letter, or with an edit along any edge (this letter replaced; left
    out, if the edge has the letter after it; the edge's letter put in)."""
    tried = states.where("edits = 0").select("way", "s", "at", F.explode("out").alias("o")).select("way", "s", "at", "o.*")
    tried = tried.select("way", "s", "at", "label", "below", "goes_on", *_MASKS, _neighbour(F.col("word")).alias("x"))
    at, label, on = F.col("at"), F.col("label"), F.col("goes_on")
    next_letter, after_next = (F.col("s").substr(at + k, F.lit(1)) for k in (1, 2))
    none, same = F.lit(None).cast("string"), F.col("label") == F.col("s").substr(at + 1, F.lit(1))
    exact = on & same
    steps = F.array(
        F.when(F.col("x").isNotNull() | exact, _step(F.col("x"), F.when(exact, at + 1), 0)),
        F.when(on & ~same & (next_letter != "") & _may_follow(at + 1), _step(none, at + 1, 1)),
        F.when(on & (label == after_next) & _may_follow(at + 2), _step(none, at + 2, 1)),
        F.when(on & _may_follow(at), _step(none, at, 1)))
    return tried.select("way", "s", F.col("below").alias("node"), F.explode(steps).alias("r"))


def _by_longer_labels(states: DataFrame) -> DataFrame:
    """Both, for edges of more than one letter: along equal letters, or letters that one edit makes equal."""
    rest, size = F.col("s").substr(F.col("at") + 1, F.length("label") + 1), F.length("label")

    def move(taken: Column, edits: int) -> Column:
        return F.struct((F.col("at") + taken).alias("at"), F.lit(edits).alias("edits"))

    def one_off(taken: Column) -> Column:
        piece = rest.substr(F.lit(1), taken)
        return (F.length(piece) == taken) & (F.levenshtein(piece, F.col("label"), 1) == 1)

    fresh, equal = F.col("edits") == 0, rest.startswith(F.col("label"))
    options = F.array(F.when(equal & fresh, move(size, 0)), F.when(equal & ~fresh, move(size, 1)),
                      *[F.when(fresh & one_off(size + k), move(size + k, 1)) for k in (0, 1, -1)])
    tried = states.select("way", "s", "at", "edits", F.explode("out").alias("o")).select("way", "s", "at", "edits", "o.*")
    tried = tried.select("way", "s", F.col("below").alias("node"), _neighbour(F.col("word")).alias("x"), F.when(
        F.col("goes_on"), F.array_distinct(F.filter(options, lambda m: m.isNotNull()))).alias("moves"))
    return tried.select("way", "s", "node", F.explode(F.concat(
        F.array(F.struct("x", F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("edits"))),
        F.transform(F.coalesce("moves", F.array()), lambda m: F.struct(F.lit(None).cast("string").alias("x"), m["at"].alias("at"), m["edits"].alias(
            "edits"))))).alias("r"))


def _level(states: DataFrame, out: DataFrame, depth: int) -> DataFrame:
    """States of one depth to neighbours (``x``) and to states of the next (``at``)."""
    met = states.join(out.select("node", "out"), "node")
    after = _by_longer_labels(met) if depth >= SINGLE else _before_edit(met).unionByName(_after_edit(met))
    return after.where("r.x is not null or r.at is not null").select("way", "s", "node", "r.*")


def near_words(words: DataFrame) -> DataFrame:
    """``word, near``: both ways round, every pair of words that are one inserted, deleted or replaced letter apart."""
    with scratch(words.sparkSession) as scope:
        oriented = _oriented(words)
        out = edges(oriented)
        depths = sorted(r.depth for r in out.select("depth").distinct().collect())  # fewer than SINGLE + _DEEPEST
        starts = oriented.select("way", "s", "begin", _node(F.col("way"), F.col("s").substr(F.lit(1), F.col("begin").cast("int"))).alias("node"),
                                 F.col("begin").cast("int").alias("at"), F.lit(0).alias("edits"))
        found, carried = [], None
        for d in depths:
            states = starts.where(F.col("begin") == d).select("way", "s", "node", "at", "edits")
            if carried is not None:
                states = states.unionByName(carried)
            after = materialise(_level(states, out.where(F.col("depth") == d), d), "frontier")
            found.append(after.where("x is not null").select("way", "s", "x"))
            carried = after.where("at is not null").select("way", "s", "node", "at", "edits")
        if not found:
            return scope.result(words.select("word", F.col("word").alias("near")).limit(0), "near")
        turned = lambda c: F.when(F.col("way") == 0, F.col(c)).otherwise(F.reverse(c))
        pairs = reduce(DataFrame.unionByName, found).select(turned("s").alias("word"), turned("x").alias("near"))
        return scope.result(pairs.distinct(), "near")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: the end of the chain. Every round doubles the steps, and a chain has no more steps than
    the counts have digits."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        joined = now.join(on, F.col("root") == F.col("_at"), "left")
        if joined.where("_on is not null").isEmpty():
            return now
        now = materialise(joined.select("word", F.coalesce("_on", "root").alias("root")), "roots")


def variants(docs: DataFrame, text: str = "text", id: str = "doc_id", *, least: int = LEAST_LETTERS, times: int = LEAST_COUNT,
             ratio: int = RATIO, every: int = DELETE_EVERY) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of at least ``least`` letters that occurs ``times`` times."""
    with scratch(docs.sparkSession) as scope:
        words = materialise(count_words(docs, text, id, least, every).where(F.col("n") >= times), "words")
        pairs = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
        best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
        counted = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        frequent = -F.col("best.less") >= ratio * F.col("n")
        judged = materialise(words.join(counted, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("best.form")).alias("form"),
            F.when(frequent, -F.col("best.less")).alias("form_n")), "variants")
        ends = roots(judged.where("form is not null"))
        return scope.result(judged.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word")), "variants")
