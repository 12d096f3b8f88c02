"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a run of at least ``MIN_LENGTH`` letters, digits and ``+/_-`` that holds a digit, begins with sixteen
capitals or digits or with a vendor's prefix; a whole private key block (PEM) or web token (JWT); the password of a URL;
what follows ``Bearer``; or a value of at least four characters assigned to a name with a key word in it, up to the closing
quote or else the next blank. Splitting a text at its candidates gives
what stands before and after each, so finding, judging and redacting take one pass without regrouping.

The forest sees the length, changes of character kind, shares of digits and capitals, the share of the candidate that
dictionary words cover, the path and the neighbouring words. It is trained on labelled findings by counting: findings are
reduced to binned features with a weight per tree (a hash of the finding stands in for drawing with replacement), and
each level of all trees is one aggregation with a row per tree, node, feature and bin. A trained forest is a conditional
expression. Only built-in column functions are used.

Defined results: NULL and empty texts have no finding and stay as they are; a NULL path counts as an ordinary one; equal
findings get equal scores; labels other than 0 and 1 teach nothing; without labelled findings all scores are 0; further
columns pass through untouched.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.session import materialise

MIN_LENGTH = 12
CONTEXT = 60
SHARE = 1000
REPLACEMENT = "<SECRET>"
KEYS = "password|passphrase|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential"
_NAME = rf"(?i:{KEYS})s?(?:(?:[_.\-]|(?<=[a-z])[A-Z])[A-Za-z0-9_.\-]{{0,64}})?"  # also password_hash, secretKey, SECRET_KEY
_SIGN = r"[\"']?[ \t]{0,4}(?:=>|:=|[:=])[ \t]{0,4}"
_PEM = (r"-----BEGIN (?:[A-Z0-9]+ ){0,4}PRIVATE KEY(?: BLOCK)?-----(?:(?>[\s\S]*?(?=-----))-----END (?:[A-Z0-9]+ ){0,4}PRIVATE KEY"
        r"(?: BLOCK)?-----|(?:(?:\s|\\[nr]){0,4}[A-Za-z0-9+/=]{40,}+){0,2000}+)")  # a key that is cut off: up to 2,000 of its lines
_JWT = r"eyJ[A-Za-z0-9_\-]{6,}\.[A-Za-z0-9_\-]{6,}\.[A-Za-z0-9_\-]*"
_MAIL = r"SG\.[A-Za-z0-9_\-]{16,}\.[A-Za-z0-9_\-]{16,}"
_PREFIX = r"AIza|[rs]k_(?:live|test)_|whsec_|gh[pousr]_|github_pat_|xox[abprs]-|glpat-|npm_|pypi-|hf_|shp(?:at|ss|ca|pa)_|dop_v1_"
_IN_URL = r"://[^\s/?#@:\"'<>]{0,255}:"
_BEARER = r"\b(?:[Bb]earer|BEARER|(?i:authorization)[\"']?[ \t]{0,2}[:=][ \t]{0,2}[\"']?(?i:basic|token))[ \t]{1,4}"
CANDIDATE = (rf"{_PEM}|(?<![A-Za-z0-9+/_\-])(?:{_JWT}|{_MAIL})"
             rf"|(?<=:)(?<={_IN_URL})[^\s/?#\"'<>]{{1,}}(?=@[A-Za-z0-9\[])"
             # the short look-behinds only spare the long ones most places
             rf"|(?<=[\"'])(?<=[:=>][ \t]{{0,4}}.)(?<={_NAME}{_SIGN}.)(?:(?<=\")[^\"\r\n]{{4,}}+(?=\")|(?<=')[^'\r\n]{{4,}}+(?='))"
             rf"|(?<=[:=> \t\"'])(?<=[:=>][ \t]{{0,4}}[\"']?)(?<={_NAME}{_SIGN}[\"']?)(?!(?i:bearer|basic)[ \t])[^\s\"'`,;<>(){{}}\[\]]{{4,}}+"
             rf"|(?<=[ \t])(?<={_BEARER})(?=[A-Za-z._~+/\-]*[0-9])[A-Za-z0-9._~+/\-]{{8,}}=*"
             rf"|(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9]|[A-Z0-9]{{16}}|{_PREFIX})[A-Za-z0-9+/_\-]{{{MIN_LENGTH},}}")
_KEYED = rf"{_NAME}{_SIGN}[\"']?$"
_PLAIN = rf"{_NAME}(?:[\"']?[ \t]{{0,4}}(?:=>|:=|[:=])[ \t]{{0,4}}[\"']|=)$"  # in quotes, or right behind the sign
_SENT = rf"(?:{_IN_URL}|{_BEARER})$"
_WORD = r"^(?i:none|null|nil|true|false|required|optional|string|text|basic|bearer|undefined|[$%{<].*)$"
_NEAR = rf"(?i)\b(?:{KEYS})\b"
_SET = r"(?:=>|:=|[:=])\s*[\"']?$"
_SAMPLE = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|test|fake"
_PATH = r"(?i)(?:^|[/._-])(?:tests?|examples?|samples?|fixtures?|docs?|vendor|lock)(?:[/._-]|$)"
_CHANGE = (r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])|"
           r"(?<=[A-Za-z0-9])(?=[+/_\-])|(?<=[+/_\-])(?=[A-Za-z0-9])")
_VENDOR = (r"^(?:A[KS]IA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{22,}|xox[abprs]-[A-Za-z0-9-]{10,}|"
           r"sk-[A-Za-z0-9_-]{20,}|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}|whsec_[A-Za-z0-9+/]{24,}|glpat-.{20,}|AIza[A-Za-z0-9_-]{35}|"
           r"npm_[A-Za-z0-9]{36}|pypi-[A-Za-z0-9_-]{50,}|hf_[A-Za-z0-9]{30,}|shp(?:at|ss|ca|pa)_[A-Fa-f0-9]{32}|dop_v1_[a-f0-9]{64}|"
           rf"(?:com)?/?services/T[A-Z0-9]{{8,}}/B[A-Z0-9]{{8,}}/[A-Za-z0-9]{{20,}}|{_JWT}|{_MAIL}|-----BEGIN [\s\S]*)$")

# features and their cuts
CUTS: dict[str, list[float]] = {
    "length": [],  # quantiles of the labelled findings
    "changes": [0.001, 0.06, 0.12, 0.2, 0.3, 0.4, 0.5],
    "digits": [0.001, 0.15, 0.3, 0.5, 0.7, 0.999],
    "capitals": [0.001, 0.2, 0.4, 0.6, 0.8, 0.999],
    "covered": [0.1, 0.25, 0.4, 0.55, 0.7, 0.85],
    "path": [0.5],
    "keyed": [0.5, 1.5, 2.5, 3.5, 4.5, 5.5],
    "sample": [0.5],
}


def _segments(text: Column) -> tuple[Column, Column]:
    """Candidates, and the pieces of text before, between and after them."""
    body = F.coalesce(text, F.lit(""))
    return F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)), F.split(body, CANDIDATE, -1)


def _with_hits(df: DataFrame, text: str) -> DataFrame:
    found, pieces = _segments(F.col(text))
    df = df.withColumn("_found", found)
    df = df.withColumn("_pieces", F.when(F.size("_found") > 0, pieces).otherwise(F.array(F.lit(""))))
    return df.withColumn("_hits", F.transform("_found", lambda c, i: F.struct(
        c.alias("value"), F.right(F.get("_pieces", i), F.lit(CONTEXT)).alias("before"),
        F.left(F.get("_pieces", i + 1), F.lit(CONTEXT)).alias("after"))))


def findings(docs: DataFrame, text: str = "text", id: str = "doc_id", path: str | None = "source") -> DataFrame:
    """``id, path, nth, value, before, after``: a row per candidate, in text order."""
    where = F.col(path).cast("string") if path else F.lit(None).cast("string")
    hits = _with_hits(docs.select(F.col(id).alias("_id"), where.alias("_path"), F.col(text).alias("_text")), "_text")
    return hits.where(F.size("_found") > 0).select("_id", "_path", F.posexplode("_hits")).select(
        F.col("_id").alias(id), F.col("_path").alias("path"), F.col("pos").alias("nth"), "col.*")


def dictionary(found: DataFrame, share: int = SHARE) -> list[str]:
    """Words of at least three letters that make up one in ``share`` words or more around all findings, longest first: fewer than
    ``share`` by definition."""
    word = F.explode(F.regexp_extract_all(F.lower(F.concat_ws(" ", "before", "after")), F.lit(r"\b[a-z]{3,}\b"), F.lit(0)))
    counts = materialise(found.select(word.alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")), "context_words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") * share >= total).select("w").collect()
    return sorted((r["w"] for r in rows), key=lambda w: (-len(w), w))


def features(value: Column, before: Column, after: Column, path: Column, words: list[str]) -> dict[str, Column]:
    n = F.length(value).cast("double")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    left = F.length(F.regexp_replace(F.lower(value), "|".join(words), "")) if words else n
    near = before.rlike(_NEAR).cast("int") + before.rlike(_SET).cast("int")
    return {
        "length": n, "changes": share(_CHANGE), "digits": share("[0-9]"), "capitals": share("[A-Z]"),
        "covered": 1 - left / n, "path": F.coalesce(path.rlike(_PATH), F.lit(False)).cast("double"),
        "keyed": (F.when(value.rlike(_VENDOR), 6.0).when(before.rlike(_SENT), 5.0).when(_assigned(value, before), 4.0)
                  .when(before.rlike(_KEYED), 3.0).otherwise(near.cast("double"))),
        "sample": (value.rlike(_SAMPLE) | before.rlike(_SAMPLE) | after.rlike(_SAMPLE)).cast("double"),
    }


def _assigned(value: Column, before: Column) -> Column:
    """Whether the value of a key word is more than a word of prose: with a digit, in quotes or right behind the sign."""
    return before.rlike(_KEYED) & (value.rlike("[0-9]") | before.rlike(_PLAIN)) & ~value.rlike(_WORD)


def label_by_rule(found: DataFrame) -> DataFrame:
    """Findings with ``label``: 1 for published formats, passwords in URLs, what follows ``Bearer`` and values assigned to a
    key word that are no placeholders, 0 for all others. Stands in for labels by hand where there are none."""
    value, before = F.col("value"), F.col("before")
    known = value.rlike(_VENDOR) | before.rlike(_SENT) | _assigned(value, before)
    return found.withColumn("label", (known & ~value.rlike(_SAMPLE)).cast("int"))


# ---- forest ------------------------------------------------------------------------------------------------------


@dataclass
class Split:
    feature: str
    cut: float  # features above go right
    left: object
    right: object


Tree = Split | float


def _cuts(labelled: DataFrame) -> dict[str, list[float]]:
    """``CUTS`` with those of the length: quantiles of each label's findings, and just below them."""
    share = [k / 10 for k in range(1, 10)]
    rows = labelled.where(F.col("label").isin(0, 1)).groupBy("label").agg(
        F.percentile_approx(F.length("value"), share, 10_000).alias("q")).collect()
    return CUTS | {"length": sorted({n - d for r in rows for n in r["q"] for d in (0.5, -0.5)})}


def _cells(labelled: DataFrame, words: list[str], trees: int, held: dict[str, list[float]]) -> DataFrame:
    """Binned features and label, with the weight of each cell in every tree."""
    cols = features(F.col("value"), F.col("before"), F.col("after"), F.col("path"), words)
    rows = labelled.where(F.col("label").isin(0, 1)).withColumns({"_" + k: v for k, v in cols.items()})
    binned = rows.select(
        "label", F.xxhash64("value", "before", "after").alias("_key"),
        *[sum((F.when(F.col("_" + k) > c, 1).otherwise(0) for c in cuts), F.lit(0)).alias(k) for k, cuts in held.items()])

    def times(t: int) -> Column:  # how often a draw with replacement takes a row: 0, 1, 2 or 3 times
        u = F.pmod(F.xxhash64("_key", F.lit(t)), F.lit(1000))
        return F.when(u < 368, 0).when(u < 736, 1).when(u < 920, 2).otherwise(3)

    return materialise(binned.groupBy("label", *CUTS).agg(
        F.array(*[F.sum(times(t)) for t in range(trees)]).alias("weights")), "forest_cells")


def _place(splits: dict[int, tuple[str, int]], node: int = 1) -> Column:
    """Number of the node a cell is in, with the splits made so far; a node's children are 2k and 2k + 1."""
    if node not in splits:
        return F.lit(node)
    feature, cut = splits[node]
    return F.when(F.col(feature) >= cut, _place(splits, 2 * node + 1)).otherwise(_place(splits, 2 * node))


def fit(labelled: DataFrame, words: list[str], trees: int = 11, depth: int = 4, tried: int = 4, seed: int = 1) -> list[Tree]:
    """A forest from ``value, before, after, path, label``."""
    held, dice = _cuts(labelled), random.Random(seed)
    cells = _cells(labelled, words, trees, held)
    splits: list[dict[int, tuple[str, int]]] = [{} for _ in range(trees)]
    leaves: list[dict[int, float]] = [{} for _ in range(trees)]
    for level in range(depth + 1):
        at = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), _place(splits[t]).alias("k"), F.col("weights")[t].alias("w"))
                                 for t in range(trees)]))
        one = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in CUTS]))
        rows = (cells.select("label", *CUTS, at.alias("x")).where("x.w > 0").select("label", "x.*", one.alias("y"))
                .groupBy("t", "k", "y.f", "y.b").agg(F.sum(F.when(F.col("label") == 1, F.col("w")).otherwise(0)).alias("p"),
                                                     F.sum("w").alias("n")).collect())  # trees x nodes x bins at most
        table: dict[tuple[int, int], dict[str, list[tuple[int, int, int]]]] = {}
        for r in rows:
            table.setdefault((r["t"], r["k"]), {}).setdefault(r["f"], []).append((r["b"], r["p"], r["n"]))
        for (t, k), by in sorted(table.items()):
            p, n = (sum(x[j] for x in by["length"]) for j in (1, 2))
            leaves[t][k] = (p + 0.5) / (n + 1)
            if level == depth or k >> level != 1 or p in (0, n):
                continue
            best = None
            for f in dice.sample(sorted(CUTS), tried):
                below_p = below_n = 0
                for b, bp, bn in sorted(by[f]):
                    if below_n and below_n < n:
                        impurity = sum(x * (y - x) / y for x, y in ((below_p, below_n), (p - below_p, n - below_n)))
                        if best is None or impurity < best[0] - 1e-9:
                            best = (impurity, f, b)
                    below_p, below_n = below_p + bp, below_n + bn
            if best and best[0] < p * (n - p) / n - 1e-9:
                splits[t][k] = best[1:]

    def tree(t: int, k: int) -> Tree:
        if k not in splits[t]:
            return leaves[t].get(k, leaves[t].get(k // 2, 0.5))
        feature, cut = splits[t][k]
        return Split(feature, held[feature][cut - 1], tree(t, 2 * k), tree(t, 2 * k + 1))

    return [tree(t, 1) for t in range(trees) if leaves[t]]


def _tree_expression(tree: Tree, value) -> Column:
    if not isinstance(tree, Split):
        return F.lit(float(tree))
    return F.when(value(tree.feature) > tree.cut, _tree_expression(tree.right, value)).otherwise(
        _tree_expression(tree.left, value))


def score(forest: list[Tree], value) -> Column:
    """Mean leaf probability; ``value(name)`` gives a feature's column."""
    if not forest:
        return F.lit(0.0)
    return sum((_tree_expression(t, value) for t in forest), F.lit(0.0)) / len(forest)


def judge(found: DataFrame, forest: list[Tree], words: list[str]) -> DataFrame:
    """Findings with ``score`` and ``is_secret``."""
    cols = features(F.col("value"), F.col("before"), F.col("after"), F.col("path"), words)
    own = [c for c in found.columns if c not in ("score", "is_secret")]
    seen = found.select(*own, F.struct(*[v.alias(k) for k, v in cols.items()]).alias("_f"))
    return seen.select(*own, score(forest, lambda k: F.col("_f")[k]).alias("score")).withColumn(
        "is_secret", F.col("score") >= 0.5)


def train(docs: DataFrame, **options) -> tuple[DataFrame, list[Tree], list[str]]:
    """All findings of the documents, stored, and a forest trained on them with labels by rule."""
    found = materialise(findings(docs, **options), "findings")
    words = dictionary(found)
    return found, fit(label_by_rule(found), words), words


def redact(docs: DataFrame, forest: list[Tree], words: list[str], text: str = "text", path: str | None = "source",
           replacement: str = REPLACEMENT) -> DataFrame:
    """The documents with every secret in the text replaced; all other columns and rows stay."""
    own = docs.columns
    names = [f"own_{k}" for k in range(len(own))]
    body, where = names[own.index(text)], F.col(names[own.index(path)]).cast("string") if path else F.lit(None).cast("string")
    hits = _with_hits(docs.toDF(*names).withColumn("_path", where), body)
    seen = hits.withColumn("_seen", F.transform("_hits", lambda h: F.struct(*[
        v.alias(k) for k, v in features(h["value"], h["before"], h["after"], F.col("_path"), words).items()])))
    secret = seen.withColumn("_secret", F.transform("_seen", lambda f: score(forest, lambda k: f[k]) >= 0.5))
    parts = F.flatten(F.transform("_pieces", lambda s, i: F.array(s, F.when(F.get("_secret", i), F.lit(replacement)).otherwise(
        F.coalesce(F.get("_found", i), F.lit(""))))))
    changed = F.when(F.exists("_secret", lambda x: x), F.array_join(parts, "")).otherwise(F.col(body))
    return secret.select(*[(changed if n == body else F.col(n)).alias(c) for n, c in zip(names, own)])
