"""Quality rules: an ordered list of threshold conjunctions, learned from labelled statistics.

Everything is expressed with built-in column functions. Per text a handful of statistics is taken in one pass over the
text. Learning works on *cells*: the labelled rows counted by binned statistics. Sequential covering grows one
conjunction after the other on two thirds of the rows, prunes it on the rest, and removes what it covers. Every step
is one aggregation whose result has a row per statistic and bin, whatever the size of the input.

Defined results: a NULL or empty text has zero words and fails the base rule; repeated rows are judged one by one;
rows of ``labels`` with NULLs or contradicting labels for one id teach nothing; without labels the list is empty and
only the base rule decides; further columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.shares import may_hold
from jobstrata.llm.text import NOT_SPACE, words
from jobstrata.session import materialise

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# the statistics rules may test, from the counted columns
STATISTICS: dict[str, str] = {
    "mean_word": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "upper_share": "n_upper / word_chars",
    "marks_per_word": "n_marks / n_words",
}
QUANTILES = [0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98, 0.995]


@dataclass(frozen=True)
class Test:
    """``statistic > threshold`` or ``statistic <= threshold``; ``bin`` is the threshold's place among the cuts."""

    statistic: str
    above: bool
    threshold: float
    bin: int

    def on_bins(self) -> Column:
        b = F.col("b_" + self.statistic)
        return b >= self.bin if self.above else b < self.bin

    def on_values(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = list[Test]


def _both(tests: Rule, side: str) -> Column:
    out = F.lit(True)
    for test in tests:
        out = out & getattr(test, side)()
    return out


def _repeat_words(ws: str) -> str:
    """Words inside 3-word windows that occur twice or more in the text.

    Window hashes and positions share one long (hash above, position below), so a plain sort brings equal windows
    together. Windows whose upper hash bits agree are then compared by their full 64-bit hash.
    """
    packed = (f"sort_array(transform(slice({ws}, 1, size({ws}) - 2), (x, i) -> "
              f"shiftleft(xxhash64(x, get({ws}, i + 1), get({ws}, i + 2)), _bits) | cast(i as bigint)))")
    return packed


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counted columns and ``base_failed``; helper columns are removed again."""
    ws, own = "_ws", df.columns
    taken = {c.lower() for c in own}
    if clash := [c for c in [*COUNTS, *STATISTICS, "base_failed"] if c.lower() in taken]:
        df = df.drop(*[c for c in own if c.lower() in clash])
        own = df.columns
    body = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn(ws, words(F.col(text)))
    out = out.withColumn("_bits", F.expr(f"length(bin(size({ws})))"))
    out = out.withColumn("_packed", F.expr(f"case when size({ws}) > 3 then {_repeat_words(ws)} else array() end"))
    out = out.withColumn("_near", F.expr(
        "transform(filter(_packed, (x, k) -> shiftright(x, _bits) = shiftright(get(_packed, k - 1), _bits) or "
        "shiftright(x, _bits) = shiftright(get(_packed, k + 1), _bits)), x -> cast(x & (shiftleft(1L, _bits) - 1) as int))"))
    # full hashes of the few candidates, then keep those that really occur twice
    out = out.withColumn("_full", F.expr(
        f"case when size(_near) = 0 then array() else array_sort(transform(_near, i -> struct("
        f"xxhash64(get({ws}, i), get({ws}, i + 1), get({ws}, i + 2)) as h, i as i))) end"))
    out = out.withColumn("_pos", F.expr(
        "transform(filter(_full, (x, k) -> x.h = get(_full, k - 1).h or x.h = get(_full, k + 1).h), x -> x.i)"))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(NOT_SPACE))
    out = out.withColumn("_lines", lines)
    return out.select(
        *own, F.size(ws).cast("long").alias("n_words"),
        F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("case when size(_pos) = 0 then 0L else cast(size(array_union(array_union(_pos, "
               "transform(_pos, i -> i + 1)), transform(_pos, i -> i + 2))) as bigint) end").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.regexp_count(body, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(body, F.lit("[!?]")).cast("long").alias("n_marks"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                 | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]


def with_ratios(counted: DataFrame) -> DataFrame:
    """Add the tested statistics; 0 where the divisor is 0."""
    return counted.withColumns({
        name: F.coalesce(F.try_divide(*[F.col(p).cast("double") for p in formula.split(" / ")]), F.lit(0.0))
        for name, formula in STATISTICS.items()})


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """``doc_id, label`` for the ids that all their rows agree on."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
    return (known.groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("_max"))
            .where("label = _max").drop("_max"))


def _cells(counted: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[str, list[float]]]:
    """Labelled rows that pass the base rule, counted by bins, fold and label; and the cuts of the bins."""
    rows = with_ratios(counted.where(~F.col("base_failed")).select("doc_id", *COUNTS)).join(
        one_label(labels, "quality"), "doc_id").select("doc_id", "label", *STATISTICS)
    found = rows.groupBy("label").agg(*[
        F.percentile_approx(s, QUANTILES, 2000).alias(s) for s in STATISTICS]).collect()  # a row per label
    cuts = {s: sorted({float(v) for r in found for v in r[s]}) for s in STATISTICS}
    binned = rows.select(
        (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("held"), (F.col("label") == 0).alias("bad"),
        *[sum((F.when(F.col(s) > t, 1).otherwise(0) for t in cuts[s]), F.lit(0)).alias("b_" + s) for s in STATISTICS])
    return materialise(binned.groupBy(*binned.columns).agg(F.count(F.lit(1)).alias("n")), "cells"), cuts


def _sums(cells: DataFrame, by: list[str]) -> DataFrame:
    bad = F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("p")
    good = F.sum(F.when(~F.col("bad"), F.col("n")).otherwise(0)).alias("q")
    return cells.groupBy(*by).agg(bad, good) if by else cells.agg(bad, good)


def _grow(cells: DataFrame, cuts: dict[str, list[float]], longest: int) -> Rule:
    """Add the test with the largest information gain until no good row is covered or nothing is gained."""
    rule: Rule = []
    one = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col("b_" + s).alias("b")) for s in STATISTICS]))
    while len(rule) < longest:
        here = cells.where(_both(rule, "on_bins")).select("bad", "n", one.alias("x")).select("bad", "n", "x.*")
        rows = _sums(here, ["s", "b"]).collect()  # at most a row per statistic and bin
        by = {s: sorted((r["b"], r["p"], r["q"]) for r in rows if r["s"] == s) for s in STATISTICS}
        all_p, all_q = (sum(x[k] for x in next(iter(by.values()), [])) for k in (1, 2))
        if not all_p or not all_q:
            break
        best = None
        for s, bins in by.items():
            below_p = below_q = 0
            for b, p, q in bins:
                if b > 0 and (below_p or below_q):
                    for above, cp, cq in ((True, all_p - below_p, all_q - below_q), (False, below_p, below_q)):
                        if cp:
                            gain = cp * (log2(cp / (cp + cq)) - log2(all_p / (all_p + all_q)))
                            if best is None or gain > best[0] + 1e-9:
                                best = (gain, Test(s, above, cuts[s][b - 1], b))
                below_p, below_q = below_p + p, below_q + q
        if best is None or best[0] <= 1e-6:
            break
        rule.append(best[1])
    return rule


def _prune(cells: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The beginning of the rule that separates the held rows best, and what it covers there."""
    parts = [rule[:k] for k in range(1, len(rule) + 1)]
    row = cells.where("held").agg(*[
        F.coalesce(F.sum(F.when(_both(p, "on_bins") & (F.col("bad") == bad), F.col("n"))), F.lit(0)).alias(f"{k}_{bad}")
        for k, p in enumerate(parts) for bad in (True, False)]).first()
    scored = [((row[f"{k}_True"] - row[f"{k}_False"]) / max(1, row[f"{k}_True"] + row[f"{k}_False"]), -k)
              for k in range(len(parts))]
    best = -max(scored)[1]
    return parts[best], row[f"{best}_True"], row[f"{best}_False"]


def learn(counted: DataFrame, labels: DataFrame, max_rules: int = 10, longest: int = 4, min_precision: float = 0.95,
          min_covered: int = 5) -> list[Rule]:
    """Rules that reject, most telling first. A rule stays only if it is precise on all rows it still covers.

    ``counted`` has ``doc_id`` and the columns of :func:`statistics`, ``labels`` has ``doc_id, quality``.
    """
    cells, cuts = _cells(counted, labels)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        rule = _grow(cells.where("not held"), cuts, longest)
        if not rule:
            break
        rule, _, _ = _prune(cells, rule)
        got = _sums(cells.where(_both(rule, "on_bins")), []).first()
        covered, wrong = got["p"] or 0, got["q"] or 0
        if covered < min_covered or covered < min_precision * (covered + wrong):
            break
        rules.append(rule)
        cells = cells.where(~_both(rule, "on_bins"))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: the number of the first rule that fires, 0 for none."""
    if not rules:
        return F.lit(0)
    out = F
    for k, rule in enumerate(rules, 1):
        out = out.when(_both(rule, "on_values"), F.lit(k))
    return out.otherwise(F.lit(0))


def judge(counted: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``rule`` (0: none fired) and ``kept``."""
    own = [c for c in counted.columns if c not in ("rule", "kept")]
    judged = with_ratios(counted.select(*own)).withColumn("rule", verdict(rules))
    return judged.select(*own, "rule", ((F.col("rule") == 0) & ~F.col("base_failed")).alias("kept"))


def filter_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass the base rule and the list learned from the labelled ones among them."""
    # no text is shuffled: labels meet the counts, and the few texts without a label that are counted as well drop out there
    learned = statistics(may_hold(docs.select("doc_id", "text"), labels, "doc_id")).drop("text")
    rules = learn(materialise(learned, "labelled_statistics"), labels, **options)
    own = docs.columns
    counted = statistics(docs.toDF(*[f"own_{k}" for k in range(len(own))]), f"own_{own.index('text')}")
    # a row number keeps the optimiser from moving the verdict, and with it all statistics, below the projections
    numbered = counted.withColumn("_row", F.monotonically_increasing_id())
    return judge(numbered, rules).where(F.col("kept") & (F.col("_row") >= 0)).select(
        *[F.col(f"own_{k}").alias(c) for k, c in enumerate(own)])
