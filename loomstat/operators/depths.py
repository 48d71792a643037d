"""Every depth of a tree or forest from one fit of the deepest.

Trees grow level by level, so a tree of depth d is the head of a deeper one.
The nodes of a fitted model are kept with the class counts of the inner ones
too; cut at a depth, and with leaves merged that say the same, they are the
tree that a separate fit to that depth gives. All depths are read off in one
pass over the rows, which sends counts of (label, prediction) only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.operators.evaluate import score_settings, together
from loomstat.session import work_path
from loomstat.sources.tables import save_model


@dataclass(frozen=True)
class Nodes:
    """The nodes of all trees of a model, by position; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    prediction: np.ndarray
    shares: np.ndarray
    forest: bool

    def stops(self, depth: int) -> np.ndarray:
        """Where rows end in the trees cut at a depth: leaves, nodes at the depth, and nodes whose children would say the same."""
        ends = (self.left == np.arange(len(self.left))) | (self.depth >= depth)
        for level in range(min(depth, int(self.depth.max(initial=0))) - 1, -1, -1):
            at = np.flatnonzero((self.depth == level) & ~ends)
            left, right = self.left[at], self.right[at]
            ends[at] = ends[left] & ends[right] & (self.prediction[left] == self.prediction[right])
        return ends

    def predictions(self, rows: np.ndarray, depths: Sequence[int]) -> np.ndarray:
        """Predicted class of each row (down) at each depth (across); depths in rising order."""
        votes = np.zeros((len(depths), len(rows), self.shares.shape[1]))
        out = np.zeros((len(rows), len(depths)))
        each = np.arange(len(rows))
        stops = [self.stops(d) for d in depths]
        for root in self.roots:
            at = np.full(len(rows), root)
            for i, ends in enumerate(stops):
                while len(moving := np.flatnonzero(~ends[at])):
                    node = at[moving]
                    low = rows[each[moving], self.feature[node]] <= self.threshold[node]
                    at[moving] = np.where(low, self.left[node], self.right[node])
                if self.forest:
                    votes[i] += self.shares[at]
                else:
                    out[:, i] = self.prediction[at]
        return votes.argmax(axis=2).T.astype(float) if self.forest else out


def nodes_of(spark: SparkSession, model) -> Nodes:
    """The nodes of a fitted tree or forest, read from its stored form (no larger than the model that the driver holds)."""
    path = work_path(spark, "trees")
    save_model(model, path)
    stored = spark.read.parquet(f"{path}/data")
    forest = "treeID" in stored.columns
    rows = (stored.select("treeID", "nodeData.*") if forest else stored.select(F.lit(0).alias("treeID"), "*")).orderBy("treeID", "id").collect()
    if any(r.leftChild >= 0 and r.split.numCategories >= 0 for r in rows):
        raise ValueError("only splits of numbers are cut by depth")
    place = {(r.treeID, r.id): i for i, r in enumerate(rows)}
    own = np.arange(len(rows))
    left = np.array([place[r.treeID, r.leftChild] if r.leftChild >= 0 else i for i, r in enumerate(rows)])
    right = np.array([place[r.treeID, r.rightChild] if r.leftChild >= 0 else i for i, r in enumerate(rows)])
    depth = np.zeros(len(rows), dtype=np.int64)
    for i in own[left != own]:  # parents come before their children
        depth[left[i]] = depth[right[i]] = depth[i] + 1
    counts = np.array([r.impurityStats for r in rows], dtype=float)
    return Nodes(
        np.array([i for i, r in enumerate(rows) if r.id == 0]),
        np.array([max(r.split.featureIndex, 0) for r in rows]),
        np.array([r.split.leftCategoriesOrThreshold[0] if r.leftChild >= 0 else 0.0 for r in rows]),
        left, right, depth, np.array([r.prediction for r in rows]), counts / counts.sum(axis=1, keepdims=True), forest,
    )


def sweep_depths(
    df: DataFrame, name: str, make: Callable[[int], object], depths: Sequence[int], k: int = 5, fold: str = "fold", label: str = "label"
) -> DataFrame:
    """Cross-validated scores of every depth, as ``evaluate.sweep`` gives, from one fit a fold at the greatest depth."""
    spark = df.sparkSession
    rising = sorted(depths)
    models = together([partial(lambda i: make(rising[-1]).fit(df.filter(F.col(fold) != i)), i) for i in range(k)])
    nodes = {i: nodes_of(spark, m) for i, m in enumerate(models)}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows = batch.column(2)
            rows = rows.flatten().to_numpy().reshape(len(rows), -1)
            for i in np.unique(folds):
                own = folds == i
                found = nodes[int(i)].predictions(rows[own], rising)
                for j, depth in enumerate(rising):
                    pairs, n = np.unique(np.column_stack([labels[own], found[:, j]]), axis=0, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), depth)), pa.array(np.full(len(n), int(i))), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(n)],
                        names=["depth", "fold", "label", "prediction", "n"],
                    )

    held = df.select(F.col(fold).cast("long"), F.col(label).cast("double"), vector_to_array("features"))
    cells = held.mapInArrow(counts, "depth long, fold long, label double, prediction double, n long")
    cells = cells.groupBy("depth", "fold", "label", "prediction").agg(F.sum("n").alias("n"))
    order = {d: i for i, d in enumerate(depths)}
    position = F.coalesce(*[F.when(F.col("depth") == d, F.lit(i)) for d, i in order.items()])
    return score_settings(cells.select(position.alias("position"), F.col("depth").cast("string").alias(name), "fold", "label", "prediction", "n"), name)
