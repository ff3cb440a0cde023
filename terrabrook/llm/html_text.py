"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into blocks at its block elements.  A block's features are its own and its neighbours'
numbers of words and link densities, and how the elements around it are named (page_blocks).  Spark
ML fits one decision tree on a small labelled table of hand-written pages; the tree goes to the tasks
as a few arrays and is applied to all blocks of an Arrow batch at once.  There is no shuffle: a page
is read, judged and written by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .labelled_pages import MARK, PAGES
from .page_blocks import Block, block_features, page_blocks

DEPTH = 6


def labelled_blocks() -> list[tuple[list[float], float]]:
    """Features and label of each block of the labelled pages; the marks don't count as text."""
    rows = []
    for page in PAGES:
        labels = [b.text.startswith(MARK) for b in page_blocks(page)]
        blocks = page_blocks(page.replace(MARK, ""))
        rows += zip(block_features(blocks), map(float, labels), strict=True)
    return rows


class Tree:
    """A fitted tree as arrays: feature (or -1 at a leaf), threshold, children, and whether a leaf is main text."""

    def __init__(self, root):
        """root: the JVM's root node; at most 2**(DEPTH + 1) nodes are walked."""
        self.feature, self.threshold, self.left, self.right, self.main = [], [], [], [], []
        self.add(root)
        self.feature, self.left, self.right = (np.array(x, np.int64) for x in (self.feature, self.left, self.right))
        self.threshold, self.main = np.array(self.threshold), np.array(self.main)

    def add(self, node) -> int:
        me = len(self.feature)
        inner = hasattr(node, "leftChild") and node.getClass().getSimpleName() == "InternalNode"
        for column, value in ((self.feature, node.split().featureIndex() if inner else -1), (self.threshold, node.split().threshold() if inner else 0.0), (self.left, me), (self.right, me), (self.main, node.prediction() > 0.5)):
            column.append(value)
        if inner:
            self.left[me] = self.add(node.leftChild())
            self.right[me] = self.add(node.rightChild())
        return me

    def predict(self, features: np.ndarray) -> np.ndarray:
        at = np.zeros(len(features), np.int64)
        rows = np.arange(len(features))
        for _ in range(DEPTH):
            feature = self.feature[at]
            left = features[rows, np.maximum(feature, 0)] <= self.threshold[at]
            at = np.where(feature < 0, at, np.where(left, self.left[at], self.right[at]))
        return self.main[at]


def fit_tree(spark: SparkSession) -> Tree:
    """The tree over the labelled pages; the same at each run, as the table is fixed and no rows are sampled."""
    rows = spark.createDataFrame(labelled_blocks(), "features array<double>, label double").coalesce(1)
    classifier = DecisionTreeClassifier(maxDepth=DEPTH, maxBins=256, minInstancesPerNode=2, seed=1)
    model = classifier.fit(rows.select(array_to_vector("features").alias("features"), "label"))
    return Tree(model._java_obj.rootNode())


def main_texts(pages: list[str | None], tree: Tree) -> list[str]:
    cut: list[list[Block]] = [page_blocks(page) for page in pages]
    features = [f for blocks in cut for f in block_features(blocks)]
    main = iter(tree.predict(np.array(features)).tolist() if features else [])
    return ["\n".join([b.text for b in blocks if next(main)]) for blocks in cut]


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """All columns of pages, with row (struct) and text: the main text of the whole page.

    A null or empty page, or one without main text, has an empty text.  A page is held whole by its
    task, however long; rows are independent, so repeated rows, ids and nulls elsewhere don't matter,
    and extra columns only travel in row.
    """
    tree = fit_tree(pages.sparkSession)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(main_texts([None if x is None or x != x else x for x in batch], tree))

    return pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != column]).alias("row"), text(F.col(f"`{column}`")).alias("text"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
