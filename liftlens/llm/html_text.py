"""Main text of pages: boosted trees over DOM nodes, decoded along the tree.

Every block element is a node.  Its features are its tag, the words of its naming
attributes and of those above it, the density and make-up of its subtree (characters per
tag, links, sentence marks, paragraphs), its depth and its place among its siblings.
Gradient-boosted trees give the probability that a subtree holds text of the article.
They are trained on labelled pages of ``training_pages``; training draws no rows and no
features at random, so every session grows the same trees.

Decoding chooses the most likely labelling in which a dropped node drops everything below
it and a kept node lets its children choose, so no text is kept inside a dropped
ancestor.  The text runs of kept nodes are joined in page order.

Pages are independent rows.  Null and empty pages give an empty text, as do pages without
an article.  Broken markup is read as far as it goes: unclosed elements end with their
parent, text after a cut-off tag is kept.  Nothing is cut by length.  Input columns named
like output columns are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import boosting
from .common import map_text
from .dom import MARK, Node, describe, parse
from .training_pages import Page

TRAINING_PAGES = 1200
CHUNK = 256  # pages whose nodes are classified together


def training_rows(pages: int, first_seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all nodes with text."""
    x, y = [], []
    for seed in range(first_seed, first_seed + pages):
        nodes, texts = parse(Page(seed).html())
        held = set()
        for node, text in texts:
            while MARK in text and node is not None and id(node) not in held:
                held.add(id(node))
                node = node.parent
        rows = describe(nodes, [(n, t.replace(MARK, "")) for n, t in texts])
        for node, row in zip(nodes, rows):
            if node.chars and node.parent is not None:
                x.append(row)
                y.append(id(node) in held)
    return np.array(x), np.array(y, float)


@lru_cache(maxsize=2)
def trained(pages: int = TRAINING_PAGES) -> boosting.Boosted:
    return boosting.fit(*training_rows(pages))


def decode(nodes: list[Node], logits: np.ndarray) -> list[bool]:
    """Most likely consistent labels: keep[v] requires keep[parent]."""
    number = {id(n): i for i, n in enumerate(nodes)}
    kept_cost = np.logaddexp(0, -logits).tolist()   # -log p
    drop_cost = np.logaddexp(0, logits).tolist()    # -log (1 - p)
    below_drop, below_best = [0.0] * len(nodes), [0.0] * len(nodes)
    take = [True] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        drop = drop_cost[i] + below_drop[i]
        keep = kept_cost[i] + below_best[i]
        take[i] = keep < drop
        up = number[id(nodes[i].parent)]
        below_drop[up] += drop
        below_best[up] += min(keep, drop)
    for i in range(1, len(nodes)):
        take[i] = take[i] and take[number[id(nodes[i].parent)]]
    return take


def extract(pages: list[str | None], model: boosting.Boosted) -> list[str]:
    out: list[str] = []
    for a in range(0, len(pages), CHUNK):
        parsed = [parse(p or "") for p in pages[a:a + CHUNK]]
        # nodes without text decide nothing
        full = []
        for nodes, texts in parsed:
            rows = describe(nodes, texts)
            chosen = [i for i, n in enumerate(nodes) if n.chars or not i]
            full.append(([nodes[i] for i in chosen], [rows[i] for i in chosen], texts))
        logits = model.logits(np.array([r for _, rows, _ in full for r in rows]))
        at = 0
        for nodes, rows, texts in full:
            take = decode(nodes, logits[at:at + len(rows)])
            at += len(rows)
            kept = {id(n) for n, t in zip(nodes, take) if t and n.parent is not None}
            out.append(" ".join(text for node, text in texts if id(node) in kept or node.parent is None))
    return out


def main_text(df: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``text``: the article of ``html_col``."""
    shared = df.sparkSession.sparkContext.broadcast(trained())

    def make() -> Callable:
        return lambda pages: [pa.array(extract(pages, shared.value), type=pa.string())]
    return map_text(df, html_col, [T.StructField("text", T.StringType())], make, keep=keep)


def main_text_report(pages: DataFrame) -> DataFrame:
    """Contract columns for every page."""
    found = main_text(pages.select("page_id", "url", "html"), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
