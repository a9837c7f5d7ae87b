"""A fitted tree ensemble as leaves, for explanations inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession

from cohortflow.sources.scratch import scratch_path

#: Rows whose contributions to one leaf are worked out at once.
ROWS_AT_ONCE = 4096
#: Rows whose mixes with the background are scored at once, fewer if they have more paths together, and leaves.
MIXED_AT_ONCE, PATHS_AT_ONCE, LEAVES_AT_ONCE = 1024, 1 << 22, 256


@dataclass(frozen=True)
class Leaf:
    """A leaf as the box of inputs that reach it: feature j's input lies in (low, high]."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray  # of the training rows that stay on the path when a feature is unknown

    def inside(self, columns: np.ndarray) -> list[np.ndarray]:
        """Per path feature, which rows meet its condition; ``columns`` is (inputs, rows)."""
        return [
            (columns[f] > low) & (columns[f] <= high)
            for f, low, high in zip(self.features, self.low, self.high)
        ]

    def contributions(self, columns: np.ndarray) -> np.ndarray:
        """(path features, rows): what each feature of the path adds to the leaf's value.

        A feature's Shapley value weighs, over the sets of other features that are known, the product of
        their conditions (0 or 1) and of the others' shares. With s known of k - 1 others the weight is
        s! (k - 1 - s)! / k!, the integral of u^s (1 - u)^(k - 1 - s) over [0, 1]; so the sum over all
        sets is the integral of the product of share (1 - u) + met u over the other features. That is a
        polynomial of degree k - 1 in u, which k / 2 Gauss points integrate exactly: k^2 / 2 products
        a row in place of 2^k sets.
        """
        k = len(self.features)
        if not k:
            return np.zeros((0, columns.shape[1]))
        at, weight = np.polynomial.legendre.leggauss((k + 1) // 2)
        at, weight = (at + 1) / 2, weight / 2
        met = np.stack(self.inside(columns)).astype(float)
        share = self.share[:, None]
        factor = share[:, None] * (1 - at)[:, None] + met[:, None, :] * at[:, None]  # feature, point, row
        before, behind = np.ones_like(factor), np.ones_like(factor)
        np.cumprod(factor[:-1], axis=0, out=before[1:])
        behind[:-1] = np.cumprod(factor[:0:-1], axis=0)[::-1]
        others = np.einsum("fpr,p->fr", before * behind, weight)
        return self.value * (met - share) * others


class Forest:
    """Leaves of all trees, values scaled by their tree's weight."""

    def __init__(self, leaves: list[Leaf], width: int):
        self.leaves = leaves
        self.width = width
        self.base = float(sum(leaf.value * leaf.share.prod() for leaf in leaves))

    def margin(self, inputs: np.ndarray) -> np.ndarray:
        columns, total = np.ascontiguousarray(inputs.T), np.zeros(len(inputs))
        for leaf in self.leaves:
            reached = np.ones(len(inputs), dtype=bool)
            for met in leaf.inside(columns):
                reached &= met
            total[reached] += leaf.value
        return total

    @property
    def probability(self) -> Probability:
        return Probability(self)

    def contributions(self, inputs: np.ndarray) -> np.ndarray:
        """(rows, inputs): what each input adds to the margin; leaves x depth^2 steps a row."""
        phi = np.zeros((self.width, len(inputs)))
        for i in range(0, len(inputs), ROWS_AT_ONCE):
            columns = np.ascontiguousarray(inputs[i : i + ROWS_AT_ONCE].T)
            for leaf in self.leaves:
                phi[leaf.features, i : i + ROWS_AT_ONCE] += leaf.contributions(columns)
        return phi.T


@dataclass(frozen=True)
class Probability:
    """The score of a forest, a function of a matrix of inputs."""

    forest: Forest

    def __call__(self, inputs: np.ndarray) -> np.ndarray:
        return _probability(self.forest.margin(inputs))

    def worths(self, rows: np.ndarray, background: np.ndarray, known: np.ndarray) -> np.ndarray:
        """(rows, sets): what ``coalitions.worths`` finds, every mix scored but none written out.

        A mix reaches a leaf if the row meets the path's conditions on known inputs and the background row
        those on all others. So the margins of the mixes of a set are a product of two matrices of zeros and
        ones, (rows, leaves) and (leaves, background), with the leaves' values in between. Sets that differ
        only in inputs that no path asks for have the same mixes as far as the forest can tell.
        """
        leaves = self.forest.leaves
        depth = max((len(leaf.features) for leaf in leaves), default=0)
        bit = np.left_shift(1, np.arange(depth)).astype(np.min_scalar_type((1 << depth) - 1))
        path = np.full((len(leaves), depth), known.shape[1])  # beyond a path's end an input that is never known
        for i, leaf in enumerate(leaves):
            path[i, : len(leaf.features)] = leaf.features
        asked = np.isin(np.arange(known.shape[1]), path)
        distinct, at = np.unique(known & asked, axis=0, return_inverse=True)
        padded = np.pad(distinct, ((0, 0), (0, 1)))
        value = np.array([leaf.value for leaf in leaves])

        found = np.zeros((len(rows), len(distinct)))
        at_once = max(1, min(MIXED_AT_ONCE, PATHS_AT_ONCE // max(1, len(leaves))))
        for b in range(0, len(background), at_once):
            other = self._missed(background[b : b + at_once], bit)
            for r in range(0, len(rows), at_once):
                own = self._missed(rows[r : r + at_once], bit)
                for s, inputs in enumerate(padded):
                    of_row = np.bitwise_or.reduce(np.where(inputs[path], bit, 0), axis=1, dtype=bit.dtype)
                    margin = np.zeros((len(own), len(other)))
                    for i in range(0, len(leaves), LEAVES_AT_ONCE):
                        part = slice(i, i + LEAVES_AT_ONCE)
                        met = (own[:, part] & of_row[part]) == 0
                        met_by_other = (other[:, part] & ~of_row[part]) == 0
                        margin += met.astype(float) @ (met_by_other * value[part]).T
                    found[r : r + at_once, s] += _probability(margin).sum(axis=1)
        return found[:, at.ravel()] / len(background)

    def _missed(self, inputs: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """(rows, leaves): the conditions of each path that a row does not meet, a bit each."""
        columns, leaves = np.ascontiguousarray(inputs.T), self.forest.leaves
        missed = np.zeros((len(leaves), len(inputs)), bit.dtype)
        for i, leaf in enumerate(leaves):
            for k, met in enumerate(leaf.inside(columns)):
                missed[i, ~met] |= bit[k]
        return np.ascontiguousarray(missed.T)


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-2.0 * margin))


def load_forest(spark: SparkSession, classifier) -> Forest:
    """Leaves of a fitted GBT classifier, read from its saved form.

    A model has a bounded number of nodes (trees x 2^depth); they come to the driver.
    """
    path = scratch_path(spark, "trees")
    classifier.write().overwrite().save(path)
    nodes: dict[int, dict[int, object]] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        nodes.setdefault(row["treeID"], {})[row["id"]] = row
    leaves = []
    for tree, weight in enumerate(classifier.treeWeights):
        leaves += _leaves(nodes[tree], 0, weight, {})
    return Forest(leaves, classifier.numFeatures)


def _leaves(nodes: dict, at: int, weight: float, path: dict) -> list[Leaf]:
    """Leaves below a node; ``path`` maps a feature to its (low, high, share) so far."""
    node = nodes[at]
    if node["leftChild"] < 0:
        features = sorted(path)
        low, high, share = (np.array([path[f][i] for f in features]) for i in range(3))
        return [Leaf(weight * node["prediction"], np.array(features, dtype=int), low, high, share)]
    split = node["split"]
    feature, cut = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
    low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
    found = []
    for child, bounds in (
        (node["leftChild"], (low, min(high, cut))),
        (node["rightChild"], (max(low, cut), high)),
    ):
        part = share * nodes[child]["rawCount"] / node["rawCount"]
        found += _leaves(nodes, child, weight, {**path, feature: (*bounds, part)})
    return found
