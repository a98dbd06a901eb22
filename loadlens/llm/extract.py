"""Main text of web pages: gradient-boosted trees over DOM nodes and a decoder that keeps their choices consistent.

The trees score every block node of a page from the density of its subtree,
the words of its attributes, its depth and its siblings. The decoder then
picks the set of nodes with the greatest sum of log odds in which no node is
kept under one that is dropped.

The trees are fitted by Spark ML on the nodes of ``LAYOUT_PAGES`` made-up
labelled pages (the bound of the training sample); every page of the table is
then scored by the same trees in the tasks.

Null and empty pages, and pages without main text, give an empty text. Broken
markup is mended as in ``dom.parse``. Repeated rows give repeated results;
columns other than those named are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm import dom, layouts
from loadlens.llm.common import keyed, ship, unkeyed

LAYOUT_PAGES = 600
SEED = 11
TREES = 24
DEPTH = 5
STEP = 0.3


@dataclass(frozen=True)
class Trees:
    """Trees as arrays, one row each: a node's feature (-1: leaf), threshold, children and value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weights: np.ndarray

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of main text for each row; the trees are walked side by side."""
        t = np.arange(len(self.weights))[None, :]
        at = np.zeros((len(rows), len(self.weights)), np.int32)
        who = np.arange(len(rows))[:, None]
        while True:
            feature = self.feature[t, at]
            inner = feature >= 0
            if not inner.any():
                return 2 * (self.value[t, at] @ self.weights)
            low = rows[who, np.maximum(feature, 0)] <= self.threshold[t, at]
            at = np.where(inner, np.where(low, self.left[t, at], self.right[t, at]), at)


def _arrays(debug: str) -> list[tuple[int, float, int, int, float]]:
    """One tree's nodes from the text that Spark prints of it."""
    lines = [x.strip() for x in debug.splitlines()]
    lines = [x for x in lines if x.startswith(("If", "Else", "Predict"))]
    nodes: list[tuple[int, float, int, int, float]] = []
    at = 0

    def read() -> int:
        nonlocal at
        line, here = lines[at], len(nodes)
        at += 1
        nodes.append((-1, 0.0, 0, 0, 0.0))
        if line.startswith("Predict"):
            nodes[here] = (-1, 0.0, 0, 0, float(line.split(":")[1]))
            return here
        feature, threshold = re.search(r"feature (\d+) <= (\S+)\)", line).groups()
        left = read()
        at += 1  # Else
        nodes[here] = (int(feature), float(threshold), left, read(), 0.0)
        return here

    read()
    return nodes


def training_rows(n: int, seed: int) -> list[tuple[float, list[float]]]:
    """Label and features of every node of the made-up pages; a text has the label of the element it stands in."""
    out = []
    for page in layouts.pages(n, seed):
        order = dom.parse(page)
        for node, row in zip(order[1:], dom.features(order)[1:], strict=True):
            keep = node.parent.keep if node.text is not None else node.keep
            out.append((float(bool(keep)), [float(x) for x in row]))
    return out


def fit(spark: SparkSession, pages: int = LAYOUT_PAGES, seed: int = SEED, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees fitted with Spark ML."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    rows = pd.DataFrame(training_rows(pages, seed), columns=["label", "x"])
    train = spark.createDataFrame(rows, "label double, x array<double>").select("label", array_to_vector("x").alias("features"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=STEP, seed=seed, maxBins=64).fit(train.coalesce(2))
    each = [_arrays(t.toDebugString) for t in model.trees]
    size = max(map(len, each))
    table = np.zeros((len(each), size, 5))
    table[:, :, 0] = -1
    for k, nodes in enumerate(each):
        table[k, : len(nodes)] = nodes
    whole = lambda c: table[:, :, c].astype(np.int32)
    return Trees(whole(0), table[:, :, 1], whole(2), whole(3), table[:, :, 4], np.asarray(model.treeWeights))


# Pages whose nodes are scored at once.
PAGES_AT_ONCE = 128


def main_texts(pages: list[str], trees: Trees) -> list[str]:
    """The main text of each page."""
    out = []
    for lo in range(0, len(pages), PAGES_AT_ONCE):
        orders = [dom.parse(p) for p in pages[lo : lo + PAGES_AT_ONCE]]
        rows = [r for o in orders for r in dom.features(o)]
        scores = trees.log_odds(np.asarray(rows, np.float64)).tolist()
        at = 0
        for order in orders:
            out.append(dom.decode(order, scores[at : at + len(order)]))
            at += len(order)
    return out


def extract(pages: DataFrame, trees: Trees | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, ``text`` and ``n_chars``, its code points."""
    spark = ship(pages.sparkSession)
    model = spark.sparkContext.broadcast(trees or fit(spark))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = main_texts([p or "" for p in batch["html"]], model.value)
            yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    schema = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("url", pages.schema[url_col].dataType),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )
    made = keyed(pages, id_col, url=url_col, html=html_col).mapInPandas(run, schema)
    return unkeyed(made, pages, id_col).withColumnRenamed("url", url_col)
