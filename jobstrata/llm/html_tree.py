"""Main text of pages by a tree-structured graphical model over the DOM.

Every block element and every run of inline text is a node with two states, article or not. A node has a potential for
what is seen of it (element name, words of class, id and role; for text its length, share of link text, final mark) and
every parent and child share a potential. One pass of sum-product messages from the leaves up and one down gives exact
marginals, the model being a tree; text whose marginal is at least one half is the article's.

Training counts states and features on labelled pages and smooths them; the model is a few hundred numbers. A page is the
work of one task and no page depends on another.

Defined results: NULL, empty and text-free pages give the empty text; a page without markup is all article; cut-off pages
end where they end; repeated rows give equal texts; further columns pass through, but ``text`` and ``n_chars`` win.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.dom import Node, parse

LEAF_WEIGHT = 0.5  # length, links and marks of one text depend on each other
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def features(node: Node) -> list[str]:
    if node.name == "#text":
        words = node.text.count(" ") + 1
        share = 4 * node.linked // max(1, len(node.text))
        return [f"words {min(words.bit_length(), 8)}", f"linked {min(share, 4)}", f"end {node.text[-1] in '.!?…'}"]
    out = ["<" + node.name]
    if node.about:
        out += sorted({"." + w for w in _WORD.findall(_CAMEL.sub(" ", node.about).lower())})
    return out


class Model:
    """Log potentials: ``seen[feature]`` (article minus not), ``pair[leaf][parent][child]``, ``root``."""

    def __init__(self, seen: dict[str, float], pair, root: float):
        self.seen, self.pair, self.root = seen, pair, root
        self.known: dict[tuple[str, str], float] = {}

    def potential(self, node: Node) -> float:
        if node.name == "#text":
            return LEAF_WEIGHT * sum(self.seen.get(f, 0.0) for f in features(node))
        key = (node.name, node.about)
        if key not in self.known:
            if len(self.known) > 10_000:
                self.known.clear()
            self.known[key] = sum(self.seen.get(f, 0.0) for f in features(node))
        return self.known[key]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of the article state of every node, by messages up and down the tree."""
        n = len(nodes)
        belief = [self.potential(v) for v in nodes]  # log odds of what is seen at and below a node
        belief[0] += self.root
        message = [0.0] * n
        for k in range(n - 1, 0, -1):
            (p00, p01), (p10, p11) = self.pair[nodes[k].name == "#text"]
            odds = exp(max(-500.0, min(500.0, belief[k])))
            message[k] = log((p10 + p11 * odds) / (p00 + p01 * odds))
            belief[nodes[k].parent] += message[k]
        for k in range(1, n):
            (p00, p01), (p10, p11) = self.pair[nodes[k].name == "#text"]
            odds = exp(max(-500.0, min(500.0, belief[nodes[k].parent] - message[k])))
            belief[k] += log((p01 + p11 * odds) / (p00 + p10 * odds))
        return [1 / (1 + exp(-max(-500.0, min(500.0, b)))) for b in belief]


def _labels(html: str) -> tuple[list[Node], list[int]]:
    """Nodes of a labelled page and their states, each that of the nearest labelled box; what is outside of all boxes is
    article if no text is labelled otherwise."""
    marked = re.sub(r"<(\w+)([^>]*?) data-label='([01])'>", lambda m: f"<{m[1]}{m[2]} role='label{m[3]}'>" if "role=" not in m[2]
                    else f"<{m[1]}{m[2][:-1]} label{m[3]}'>", html)
    nodes = parse(marked)
    state: list[int | None] = [None] * len(nodes)
    for k, node in enumerate(nodes):
        found = re.search(r"\blabel([01])\b", node.about)
        state[k] = int(found[1]) if found else state[node.parent] if node.parent >= 0 else None
        node.about = re.sub(r"\blabel[01]\b", "", node.about)
    whole = all(s != 0 for s, node in zip(state, nodes) if node.name == "#text")
    return nodes, [int(whole) if s is None else s for s in state]


def fit(labelled: list[str], smoothing: float = 0.5) -> Model:
    """Count features by state, and states by the parent's state."""
    seen = (Counter(), Counter())
    pair = [[[1.0, 1.0], [1.0, 1.0]] for _ in range(2)]
    roots = [1, 1]
    for html in labelled:
        nodes, state = _labels(html)
        roots[state[0]] += 1
        for k, node in enumerate(nodes):
            if k:
                pair[node.name == "#text"][state[node.parent]][state[k]] += 1
            kind = "#text" if node.name == "#text" else "element"
            seen[state[k]].update([kind, *features(node)])
    for by_parent in pair:
        for row in by_parent:
            row[:] = [x / sum(row) for x in row]
    weights = {}
    for f in seen[0].keys() | seen[1].keys():
        kind = "element" if f[0] in "<." else "#text"
        weights[f] = log((seen[1][f] + smoothing) / (seen[1][kind] + 2 * smoothing)) - log(
            (seen[0][f] + smoothing) / (seen[0][kind] + 2 * smoothing))
    weights.pop("element", None), weights.pop("#text", None)
    return Model(weights, pair, log(roots[1] / roots[0]))


def main_text(html: str | None, model: Model) -> str:
    nodes = parse(html or "")
    likely = model.marginals(nodes)
    return "\n\n".join(v.text for v, p in zip(nodes, likely) if v.name == "#text" and p >= 0.5)


def extract(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """Replace the page by ``text`` and ``n_chars``."""
    held = pages.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in pages.columns if c not in (html, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            texts = [main_text(h, own) for h in batch["_html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*rest, "text", "n_chars"])

    ordered = pages.select(F.col(html).alias("_html"), *[F.col(f"`{c}`") for c in rest])
    return ordered.mapInArrow(run, ordered.drop("_html").schema.add("text", "string").add("n_chars", "long"))
