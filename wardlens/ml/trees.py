"""Tree ensembles grown level by level from sums over blocks of binned rows.

Training rows become blocks of at most ``BLOCK_ROWS`` rows: one byte per feature (the
number of bin edges below the value), label, fold and a hash of the row's ids.  A *fit* is
one model on one set of folds.  All fits share the blocks; a fit leaves the rows of its own
fold out by weight and sees its own preprocessing as a table from bin to bin, because
imputing, clipping and scaling are monotone in each column.

A level of a tree needs, per open node, feature and bin, sums of counts and weights or of
gradients.  ``level_sums`` takes them from a block and ``Growth.split`` chooses the splits
from their total.  Sums are whole numbers (gradients in units of 2^-24), so the trees do
not depend on how the rows are cut into blocks.

* Many blocks: a team of tasks that run at the same time (a barrier stage), each with some of the
  blocks in memory.  Per level the members tell each other their sums and all choose the same splits, so
  the growth of all trees is one job and rows are never read or routed again.  Spark's own exchange
  takes a second each time, so members on one machine use files that they all see.
* Many blocks that a team cannot hold (``TEAM_BYTES``), no slots for a team, or one on several machines: one aggregate per level
  serves every tree of every fit (a forest), or the current tree of every fit (boosting); blocks emit
  sums, Spark adds them up per tree, and only the chosen splits reach the driver.
* One block, a training set of at most ``BLOCK_ROWS`` rows (some 40 MB): the same two functions run in
  tasks that each hold the block and some of the trees, so that a level is no job.

Bootstrap counts, row samples, the features a node looks at and random cuts are hashes of
(seed, series, tree, node, row), so a lost task grows the same tree again.
"""

from __future__ import annotations

import heapq
import json
import math
import os
import tempfile
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import written
from .stages import apply_arrays

BLOCK_ROWS = 1 << 20
MAX_BINS = 64
MISSING = 255
UNIT = 1 << 24  # of gradients and second derivatives
FOREST_TREES = 25  # of a forest in one task
TEAM_ROWS = 1 << 17  # of a team's member, at the least
TEAM_SIZE = 32  # members at the most, as each hears all others
TEAM_TREES = 8  # of forests that a team grows side by side
TEAM_BYTES = 1 << 30  # of rows that a member holds at a time
TEAM_WAIT = 3600  # seconds after which a member gives the others up
LEVEL_TREES = 64  # whose sums one job adds up, where there are many blocks
SETTLE_TREES = 10  # boosted trees after which the scores of the rows are written
PACK = 26  # bits of a count that is added up beside another one
FEW_ROWS = 512  # a node, below which the nodes of a level are added up together
JOINT = 1 << 12  # cells of the table in which a node's features are counted together
_EPS = 1e-12


@dataclass(frozen=True)
class TreeSpec:
    """How an ensemble is grown.

    ``kind``: ``forest`` (bootstrap counts, best cut by Gini), ``extra`` (all rows, one random
    cut per feature) or ``boost`` (log loss).  ``node_features`` is the number of features a
    node looks at, ``tree_features`` the share a tree may use, ``row_share`` the rows of a
    boosted tree.  ``second_order`` gains use gradient and hessian sums with ``l2``; otherwise
    the friedman form on residuals.  ``max_leaves`` keeps the leaves that best-first growth
    would reach.  ``event_weight`` multiplies the events; ``balanced`` sets it from the counts.
    ``series`` tells the draws of one fit from another's; None: its place among the fits.
    """

    kind: str
    trees: int = 300
    depth: int = 8
    min_leaf: int = 20
    node_features: int | None = None
    tree_features: float = 1.0
    row_share: float = 1.0
    rate: float = 0.05
    second_order: bool = False
    l2: float = 0.0
    min_hessian: float = 0.0
    max_leaves: int | None = None
    event_weight: float = 1.0
    balanced: bool = False
    mean_start: bool = True
    seed: int = 42
    series: int | None = None


@dataclass
class Fit:
    """One ensemble on the rows outside ``fold`` (-1: on all rows)."""

    key: tuple
    spec: TreeSpec
    fold: int
    bin_map: np.ndarray  # (features, 256): raw bin -> bin after preprocessing
    edges: np.ndarray  # (features, MAX_BINS): upper end of each bin after preprocessing
    weights: tuple[float, float]  # of the two classes
    start: float = 0.0  # first score of a boosted ensemble
    number: int = 0

    @property
    def series(self) -> int:
        return self.number if self.spec.series is None else self.spec.series


# --- hashes ---------------------------------------------------------------------------------
def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(key: np.ndarray, *salts: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit keys, another series per salt."""
    return uniform_end(uniform_start(key), *salts)


def uniform_start(key: np.ndarray, *salts: int) -> np.ndarray:
    """The part of ``uniform`` that several series share whose salts begin alike."""
    x = np.asarray(key, np.uint64)
    for salt in salts:
        x = _mixed(x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64)))
    return x


def uniform_end(x: np.ndarray, *salts: int) -> np.ndarray:
    """``uniform`` from where ``uniform_start`` left off."""
    return (uniform_start(x, *salts) >> np.uint64(11)) * (1.0 / (1 << 53))


_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


# --- trees -------------------------------------------------------------------------------------
class Tree:
    """Nodes in arrays; a row goes left where its bin is at most ``cut``."""

    def __init__(self):
        self.feature, self.cut, self.left = [-1], [0], [-1]
        self.value, self.cover, self.gain = [0.0], [0.0], [0.0]

    def leaf_of(self, x: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """Node reached by each row of bins; by ``rows`` alone where they are given."""
        at, columns, todo = np.zeros(len(x), np.int64), x.T, [(0, np.arange(len(x)) if rows is None else rows)]
        while todo:
            node, rows = todo.pop()
            if self.feature[node] < 0:
                at[rows] = node
            else:
                todo += self.sides(node, columns, rows)
        return at

    def sides(self, node: int, columns: np.ndarray, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The two nodes below an inner node, each with those of its ``rows`` that go there."""
        right = columns[self.feature[node]].take(rows) > self.cut[node]
        return [(self.left[node], rows.compress(~right)), (self.left[node] + 1, rows.compress(right))]

    def to_dict(self) -> dict:
        return {k: list(getattr(self, k)) for k in ("feature", "cut", "left", "value", "cover", "gain")}

    @classmethod
    def from_dict(cls, d: dict) -> Tree:
        tree = cls()
        tree.__dict__.update(d)
        return tree


class Growth:
    """One tree while it grows: its open nodes, and how they are split."""

    def __init__(self, fit: Fit, number: int):
        self.fit, self.spec, self.number = fit, fit.spec, number
        self.tree = Tree()
        self.open = [0]
        self.level = 0
        k = len(fit.bin_map)
        usable = np.arange(k)
        if self.spec.tree_features < 1:
            order = np.argsort(uniform(usable, self.spec.seed, fit.series, number, 1))
            usable = np.sort(order[: max(1, round(self.spec.tree_features * k))])
        self.usable = usable

    def looked_at(self) -> np.ndarray:
        """(open nodes, features): what each open node may split on."""
        m = len(self.open)
        if self.level == self.spec.depth:  # nothing is split there, and any feature's bins give the totals
            return np.tile(self.usable[:1], (m, 1))
        if self.spec.node_features is None:
            return np.tile(self.usable, (m, 1))
        n = min(self.spec.node_features, len(self.usable))
        key = np.array(self.open, np.uint64)[:, None] * np.uint64(1 << 16) + self.usable.astype(np.uint64)
        drawn = uniform(key, self.spec.seed, self.fit.series, self.number, 2)
        return np.sort(self.usable[np.argsort(drawn, axis=1)[:, :n]], axis=1)

    def split(self, sums: np.ndarray, feats: np.ndarray) -> None:
        """Split the open nodes by sums (open nodes, features, bins, 3) over all rows."""
        tree, spec, nodes = self.tree, self.spec, self.open
        whole = sums[:, 0].sum(axis=1)  # any feature's bins hold all rows of the node
        for i, node in enumerate(nodes):
            tree.value[node], tree.cover[node] = self._value(whole[i])
        if self.level == spec.depth:
            self.open = []
            return
        gain = self._gains(sums, whole, feats)
        flat = gain.reshape(len(nodes), -1)
        best = flat.argmax(axis=1)
        self.open = []
        for i, node in enumerate(nodes):
            g = flat[i, best[i]]
            if not g > _EPS:
                continue
            f, cut = divmod(int(best[i]), gain.shape[2])
            left = len(tree.feature)
            tree.feature[node], tree.cut[node], tree.left[node], tree.gain[node] = int(feats[i, f]), cut, left, float(g)
            for values, blank in ((tree.feature, -1), (tree.cut, 0), (tree.left, -1), (tree.value, 0.0), (tree.cover, 0.0), (tree.gain, 0.0)):
                values += [blank, blank]
            self.open += [left, left + 1]
        self.level += 1

    def _value(self, total: np.ndarray) -> tuple[float, float]:
        if self.spec.kind == "boost":
            h = total[2] / UNIT + self.spec.l2
            return (self.spec.rate * float(total[1] / UNIT / h) if h > _EPS else 0.0), float(total[0])
        w0, w1 = total[1] * self.fit.weights[0], total[2] * self.fit.weights[1]
        return (float(w1 / (w0 + w1)) if w0 + w1 > 0 else 0.0), float(w0 + w1)

    def _gains(self, sums: np.ndarray, whole: np.ndarray, feats: np.ndarray) -> np.ndarray:
        """Gain of every cut; minus infinity where it is not allowed."""
        spec = self.spec
        left = np.cumsum(sums, axis=2)
        right = whole[:, None, None, :] - left
        ok = (left[..., 0] >= max(1, spec.min_leaf)) & (right[..., 0] >= max(1, spec.min_leaf))
        with np.errstate(divide="ignore", invalid="ignore"):
            if spec.kind == "boost":
                nl, nr = left[..., 0], right[..., 0]
                gl, gr = left[..., 1] / UNIT, right[..., 1] / UNIT
                if spec.second_order:
                    hl, hr = left[..., 2] / UNIT, right[..., 2] / UNIT
                    ok &= (hl >= spec.min_hessian) & (hr >= spec.min_hessian)
                    score = lambda g, h: g * g / (h + spec.l2)
                    gain = score(gl, hl) + score(gr, hr) - score(gl + gr, hl + hr)
                else:
                    gain = nl * nr / (nl + nr) * (gl / nl - gr / nr) ** 2
            else:
                w0, w1 = self.fit.weights
                score = lambda s: ((w0 * s[..., 1]) ** 2 + (w1 * s[..., 2]) ** 2) / (w0 * s[..., 1] + w1 * s[..., 2])
                gain = score(left) + score(right) - score(left + right)
        gain = np.where(ok & np.isfinite(gain), gain, -np.inf)
        if spec.kind == "extra":
            only = np.full(gain.shape, -np.inf)
            cut = self._random_cuts(sums[..., 0], feats)
            i, j = np.indices(cut.shape)
            only[i, j, cut] = gain[i, j, cut]
            return only
        return gain

    def _random_cuts(self, counts: np.ndarray, feats: np.ndarray) -> np.ndarray:
        """A bin per node and feature, drawn between the node's lowest and highest value."""
        present = counts > 0
        bins = counts.shape[2]
        low, high = present.argmax(axis=2), bins - 1 - present[:, :, ::-1].argmax(axis=2)
        edges = self.fit.edges[feats]
        take = lambda b: np.take_along_axis(edges, b[:, :, None], axis=2)[:, :, 0]
        key = np.array(self.open, np.uint64)[:, None] * np.uint64(1 << 16) + feats.astype(np.uint64)
        u = uniform(key, self.spec.seed, self.fit.series, self.number, 3)
        at = take(low) + u * (take(high) - take(low))
        cut = (edges <= at[:, :, None]).sum(axis=2) - 1
        return np.clip(np.maximum(cut, low), 0, bins - 1)

    def done(self) -> Tree:
        if self.spec.max_leaves:
            _best_first(self.tree, self.spec.max_leaves)
        return self.tree


def _best_first(tree: Tree, max_leaves: int) -> None:
    """Keep the splits that best-first growth makes before it has ``max_leaves`` leaves.

    A split's gain does not depend on the others, so the queue of leaf gains can be run on
    the tree that was grown to full depth."""
    queue, leaves = [(-tree.gain[0], 0)] if tree.feature[0] >= 0 else [], 1
    kept = set()
    while queue and leaves < max_leaves:
        _, node = heapq.heappop(queue)
        kept.add(node)
        leaves += 1
        for child in (tree.left[node], tree.left[node] + 1):
            if tree.feature[child] >= 0:
                heapq.heappush(queue, (-tree.gain[child], child))
    for node, feature in enumerate(tree.feature):
        if feature >= 0 and node not in kept:
            tree.feature[node] = -1


# --- one block -----------------------------------------------------------------------------------
class BlockRows:
    """The rows of one block as a fit sees them."""

    def __init__(self, record: dict, fit: Fit, like: BlockRows | None = None):
        """``like`` has the same rows as another fit of the same fold sees them."""
        k = len(fit.bin_map)
        if like is not None and like.fit.fold == fit.fold and np.array_equal(like.fit.bin_map, fit.bin_map):
            self.x, self.label, self.key, inside = like.x, like.label, like.key, like.inside
        else:
            raw = np.frombuffer(record["bins"], np.uint8).reshape(-1, k)
            fold = np.frombuffer(record["fold"], np.int8)
            inside = np.ones(len(raw), bool) if fit.fold < 0 else fold != fit.fold
            self.x = np.stack([fit.bin_map[i][raw[inside, i]] for i in range(k)]).T  # columns lie together
            self.label = np.frombuffer(record["label"], np.uint8)[inside].astype(np.int64)
            self.key = np.frombuffer(record["key"], np.uint64)[inside]
        self.weight = np.where(self.label == 1, fit.weights[1], fit.weights[0])
        self.fit, self.inside = fit, inside
        self.bins = fit.bin_map.max(axis=1).astype(np.int64) + 1
        self._sample = uniform_start(self.key, fit.spec.seed, fit.series)
        self._joint: tuple = ((), [])
        self.score = None
        if fit.spec.kind == "boost":
            self.score = np.full(len(self.x), fit.start)

    def channels(self, number: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rows that tree ``number`` uses, and what it adds up over them.

        Three arrays (one, gradient, second derivative) for boosting.  Forests have two: where the
        sums of the row's class begin, and one with the row's bootstrap count above ``PACK`` bits;
        where every row counts once, only the first."""
        spec = self.fit.spec
        if spec.kind == "boost":
            p = 1.0 / (1.0 + np.exp(-self.score))
            used = np.ones(len(p), bool)
            if spec.row_share < 1:
                used = uniform_end(self._sample, number, 4) < spec.row_share
            g = np.rint(self.weight * (self.label - p) * UNIT)
            h = np.rint(self.weight * p * (1 - p) * UNIT)
            return used, [np.ones(len(p)), g, h]
        classes = (self.label * MAX_BINS).astype(np.uint8)
        if spec.kind == "extra":
            return np.ones(len(self.x), bool), [classes]
        u, times = uniform_end(self._sample, number, 4), np.zeros(len(self.x))
        for step in _POISSON:
            times += u > step
        return times > 0, [classes, times * (1 << PACK) + 1]

    def joint(self, feats: np.ndarray) -> list[tuple[list[int], np.ndarray]]:
        """``_cells`` of all rows, kept for the next tree that looks at the same features."""
        if self._joint[0] != tuple(feats):
            self._joint = tuple(feats), list(_cells(self.x.T, feats, self.bins, None, JOINT))
        return self._joint[1]

    def add(self, tree: Tree, leaves: list[tuple[int, np.ndarray]] = ()) -> None:
        """Move the scores by a finished boosted tree; ``leaves`` are those whose rows are known."""
        if not leaves:
            self.score = self.score + np.array(tree.value)[tree.leaf_of(self.x)]
            return
        rest = np.ones(len(self.x), bool)
        for _, rows in leaves:
            rest[rows] = False
        at = tree.leaf_of(self.x, np.flatnonzero(rest))
        for node, rows in leaves:
            at[rows] = node
        self.score = self.score + np.array(tree.value)[at]


def _rows_at(at: np.ndarray, nodes: list[int]) -> list[np.ndarray]:
    """The rows that stand at each of ``nodes``."""
    order = np.argsort(at.astype(np.int16) if at.max(initial=0) < 1 << 15 else at, kind="stable")
    ends = np.cumsum(np.bincount(at, minlength=max(nodes) + 1))
    return [order[ends[node - 1] if node else 0 : ends[node]] for node in nodes]


def _sums(columns: np.ndarray, stand: list[np.ndarray], channels: list[np.ndarray], feats: np.ndarray, once: bool) -> np.ndarray:
    """``level_sums`` of the nodes whose rows are ``stand``, a column at a time."""
    m, f = feats.shape
    rows = stand[0] if m == 1 else np.concatenate(stand)
    channels, a = [c.take(rows) for c in channels], None
    if m > 1:
        a = np.repeat(np.arange(m), [len(r) for r in stand])
    same = (feats == feats[0]).all()  # all nodes look at the same features
    forest = len(channels) < 3
    width = 2 * MAX_BINS if forest else MAX_BINS
    out = np.zeros((m, f, MAX_BINS, 3), np.int64)
    for j in range(f):
        cell = columns[feats[0, j]].take(rows) if same else columns.reshape(-1).take(feats[a, j] * columns.shape[1] + rows)
        if forest:
            cell = cell + channels[0]  # bins are below 64, so both classes fit into a byte
        cell = cell.astype(np.intp) if a is None else a * width + cell
        if forest:
            out[:, j] = _unpacked(_packed(cell, channels, m * width).reshape(m, 2, MAX_BINS))
        else:
            out[:, j, :, 0] = np.bincount(cell, minlength=m * width).reshape(m, -1)
            for i in (1, 2) if j == 0 or not once else (1,):
                out[:, j, :, i] = np.bincount(cell, channels[i], m * width).reshape(m, -1)
    return out


def _packed(cell: np.ndarray, channels: list[np.ndarray], cells: int) -> np.ndarray:
    """Rows per cell, and their bootstrap counts above ``PACK`` bits."""
    if len(channels) == 1:
        return np.bincount(cell, minlength=cells) * ((1 << PACK) + 1)
    return np.bincount(cell, channels[1], cells).astype(np.int64)


def _unpacked(packed: np.ndarray) -> np.ndarray:
    """(n, bins, 3) rows and counts of either class from packed numbers (n, classes, bins)."""
    out = np.empty((len(packed), MAX_BINS, 3), np.int64)
    out[:, :, 0] = (packed & ((1 << PACK) - 1)).sum(axis=1)
    out[:, :, 1:] = (packed >> PACK).transpose(0, 2, 1)
    return out


def _groups(bins: list[int], most: int) -> list[list[int]]:
    """Places of features by groups whose numbers of bins multiply to ``most`` cells at the most."""
    groups, sizes = [], []
    for j in sorted(range(len(bins)), key=lambda j: -bins[j]):
        i = next((i for i, size in enumerate(sizes) if size * bins[j] <= most), len(groups))
        if i == len(groups):
            groups.append([])
            sizes.append(1)
        groups[i].append(j)
        sizes[i] *= bins[j]
    return groups


def _cells(columns: np.ndarray, feats: np.ndarray, bins: np.ndarray, rows: np.ndarray | None, most: int):
    """Groups of places in ``feats`` and each row's cell in the table of all bins of the group."""
    for group in _groups(bins[feats].tolist(), most):
        cell = None
        for j in group:
            bin_ = columns[feats[j]] if rows is None else columns[feats[j]].take(rows)
            if cell is None:
                cell = bin_.astype(np.uint16)
            else:
                cell *= np.uint16(bins[feats[j]])
                cell += bin_
        yield group, cell


def _sums_of_node(
    columns: np.ndarray, rows: np.ndarray, channels: list[np.ndarray], feats: np.ndarray, bins: np.ndarray, joint: list | None, once: bool
) -> np.ndarray:
    """``level_sums`` of one node: features with few bins are counted in one table, whose margins are their sums."""
    channels, forest = [c.take(rows) for c in channels], len(channels) < 3
    out = np.zeros((len(feats), 2, MAX_BINS) if forest else (len(feats), MAX_BINS, 3), np.int64)
    if joint is not None:
        joint = ((group, cell.take(rows)) for group, cell in joint)
    classes = (channels[0] >= MAX_BINS).astype(np.uint16) if forest else None
    for group, cell in joint or _cells(columns, feats, bins, rows, min(JOINT, len(rows))):
        sizes = bins[feats[group]].tolist()
        size = math.prod(sizes)
        if forest:
            table = _packed((cell + classes * np.uint16(size)).astype(np.intp), channels, 2 * size)
        else:
            cell, added = cell.astype(np.intp), channels[1:] if 0 in group or not once else channels[1:2]
            table = np.stack([np.bincount(cell, minlength=size), *(np.bincount(cell, c, size) for c in added)])
        table = table.reshape(-1, size)
        for j, b in zip(group, sizes):
            table = table.reshape(len(table), b, -1)
            margin = table.sum(axis=2)
            if forest:
                out[j, :, :b] = margin
            else:
                kept = len(margin) if j == 0 or not once else 2
                out[j, :b, :kept] = margin[:kept].T
            table = table.sum(axis=1)
    return _unpacked(out) if forest else out


def level_sums(
    x: np.ndarray, at: np.ndarray | list[np.ndarray], channels: list[np.ndarray], nodes: list[int], feats: np.ndarray, once: bool = False,
    bins: np.ndarray | None = None, joint: list | None = None,
) -> np.ndarray:
    """Sums (open nodes, features, bins, channels) over the rows that stand at open nodes.

    ``at`` is the node of each row, or the rows of each open node.  The second derivatives are
    added up by the first feature only where ``once``: gains on residuals do not need them.
    ``bins`` are the numbers of bins of the features, ``joint`` the ``_cells`` of all rows
    where every node looks at the same features; sums of large nodes are faster with them."""
    stand = at if isinstance(at, list) else _rows_at(at, nodes)
    columns = np.ascontiguousarray(x.T)
    if sum(map(len, stand)) < FEW_ROWS * len(nodes):
        return _sums(columns, stand, channels, feats, once)
    bins = np.full(len(columns), MAX_BINS) if bins is None else bins
    return np.stack([
        _sums_of_node(columns, rows, channels, feats[i], bins, joint if len(rows) >= JOINT else None, once) for i, rows in enumerate(stand)
    ])


def _sums_of_pairs(
    x: np.ndarray, at: np.ndarray | list[np.ndarray], channels: list[np.ndarray], nodes: list[int], feats: np.ndarray, parents: np.ndarray, once: bool = False,
    bins: np.ndarray | None = None, joint: list | None = None,
) -> np.ndarray:
    """``level_sums`` where ``nodes`` are pairs of children and ``parents`` the sums of the nodes
    above them: the smaller child is added up, the other is what its parent has besides."""
    stand = at if isinstance(at, list) else _rows_at(at, nodes)
    size = np.array([len(rows) for rows in stand]).reshape(-1, 2)
    pair, less = np.arange(len(size)), size.argmin(axis=1)
    smaller = (2 * pair + less).tolist()
    out = np.empty((len(size), 2, *parents.shape[1:]), np.int64)
    out[pair, less] = level_sums(x, [stand[i] for i in smaller], channels, [nodes[i] for i in smaller], feats[: len(size)], once, bins, joint)
    out[pair, 1 - less] = parents - out[pair, less]
    return out.reshape(len(nodes), *parents.shape[1:])


def grow_in_block(rows: BlockRows, number: int, leaves: list[tuple[int, np.ndarray]] | None = None) -> Tree:
    """A whole tree from a block that holds all rows.

    ``leaves`` receives the rows it was grown from by the leaves that they reach, if it is a boosted
    tree none of whose splits is taken back."""
    used, channels = rows.channels(number)
    growth, stand = Growth(rows.fit, number), [np.flatnonzero(used)]
    spec, tree, sums = growth.spec, growth.tree, None
    once, boost, same = not spec.second_order, spec.kind == "boost", spec.node_features is None
    joint = rows.joint(growth.usable) if same else None
    while growth.open:
        nodes, feats, last = growth.open, growth.looked_at(), growth.level == spec.depth
        if last and sums is not None:  # only totals are needed
            totals = [[len(r), *(c.take(r).sum() for c in channels[1:])] for r in stand] if boost else below
            sums = np.array(totals).astype(np.int64).reshape(len(nodes), 1, 1, 3)
        elif sums is not None and same:
            sums = _sums_of_pairs(rows.x, stand, channels, nodes, feats, sums[parents], once, rows.bins, joint)
        else:
            sums = level_sums(rows.x, stand, channels, nodes, feats, once, rows.bins, joint)
        growth.split(sums, feats)
        parents = [i for i, node in enumerate(nodes) if tree.feature[node] >= 0]
        if leaves is not None and boost and not spec.max_leaves:
            leaves += [(node, r) for node, r in zip(nodes, stand) if tree.feature[node] < 0]
        if growth.level == spec.depth and not boost:
            below = [side for i in parents for side in _sums_below(tree, nodes[i], sums[i], feats[i])]
        else:
            stand = [part for i in parents for _, part in tree.sides(nodes[i], rows.x.T, stand[i])]
    return growth.done()


def _sums_below(tree: Tree, node: int, sums: np.ndarray, feats: np.ndarray) -> list[np.ndarray]:
    """Totals of the two nodes below a split one, by its sums (features, bins, 3)."""
    by_bin = sums[feats.tolist().index(tree.feature[node])]
    left = by_bin[: tree.cut[node] + 1].sum(axis=0)
    return [left, by_bin.sum(axis=0) - left]


# --- blocks as a table ---------------------------------------------------------------------------
def bin_edges(rows: DataFrame, columns: list[str]) -> np.ndarray:
    """(features, MAX_BINS - 2): quantiles of each column, the last repeated to fill the row."""
    probs = [(i + 1) / (MAX_BINS - 1) for i in range(MAX_BINS - 2)]
    found = rows.agg(*[F.percentile_approx(c, probs, 100 * MAX_BINS).alias(c) for c in columns]).first()
    out = np.empty((len(columns), MAX_BINS - 2))
    for i, c in enumerate(columns):
        distinct = sorted(set(found[c] or [0.0]))
        out[i] = [*distinct, *[distinct[-1]] * (MAX_BINS - 2 - len(distinct))]
    return out


def binned_blocks(rows: DataFrame, columns: list[str], edges: np.ndarray, label: str, fold: str, key: str, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """(bins, label, fold, key) written as one row per block, and the number of blocks."""
    n = rows.count()
    parts = 1
    if n > block_rows:
        team = _members(rows, n)  # each of which gets as many blocks as the others
        parts = -(-max(1, -(-n // (block_rows // 2))) // team) * team
    narrow = rows.select(*[F.col(c).cast("double") for c in columns], F.col(label).cast("int").alias("_y"), F.col(fold).cast("int").alias("_f"), F.col(key).alias("_k"))
    dealt = narrow.repartition(parts, "_k").sortWithinPartitions("_k")

    def pack(batches):
        held, size = [], 0

        def out():
            x = np.concatenate([h[0] for h in held])
            cols = [x.tobytes(), *(np.concatenate([h[i] for h in held]).tobytes() for i in (1, 2, 3))]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cols], ["bins", "label", "fold", "key"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, block_rows - size)
                x = np.empty((part.num_rows, len(columns)), np.uint8)
                for i in range(len(columns)):
                    v = part.column(i).to_numpy(zero_copy_only=False)
                    x[:, i] = np.where(np.isnan(v), MISSING, np.searchsorted(np.unique(edges[i]), v, side="left"))
                y, f, k = (part.column(len(columns) + j).to_numpy(zero_copy_only=False) for j in range(3))
                held.append((x, y.astype(np.uint8), f.astype(np.int8), k.astype(np.int64)))
                at, size = at + part.num_rows, size + part.num_rows
                if size == block_rows:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    blocks = written(dealt.mapInArrow(pack, "bins binary, label binary, fold binary, key binary"), "binned")
    return blocks, blocks.count()


def fit_tables(form: list[tuple], columns: list[str], edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin map, upper ends of the bins) of a fit, by sending the edges through its stages.

    ``form`` is what the stages do to rows held as arrays; they are monotone in each column.
    A row without values shows what is imputed; one with the largest number shows where the
    last bin ends."""
    top = np.full((1, len(columns)), np.finfo(float).max / 4)
    out = apply_arrays(form, np.concatenate([edges.T, top, np.full_like(top, np.nan)]))
    moved, filled = out[:-1], out[-1]
    bin_map = np.zeros((len(columns), 256), np.uint8)
    ends = np.empty((len(columns), MAX_BINS))
    for i in range(len(columns)):
        distinct = len(np.unique(edges[i]))
        t = np.concatenate([moved[:distinct, i], moved[-1:, i]])  # of each bin, the last one open
        bin_map[i, : len(t)] = np.searchsorted(t, t, side="left")
        bin_map[i, MISSING] = min(np.searchsorted(t, filled[i], side="left"), len(t) - 1)
        ends[i] = [*t, *[t[-1]] * (MAX_BINS - len(t))]
    return bin_map, ends


# --- growing ------------------------------------------------------------------------------------------
def grow(blocks: DataFrame, n_blocks: int, fits: list[Fit]) -> dict[tuple, list[Tree]]:
    """The trees of every fit, all fits side by side."""
    fits = [replace(f, number=i) for i, f in enumerate(fits)]
    if n_blocks <= 1:
        return _grow_in_tasks(blocks, fits)
    places, members, rows = _placed(blocks)
    groups = _team_fits(fits, rows)
    if members < 2 or groups is None:
        return _grow_by_levels(blocks, fits)
    out: dict[tuple, list[Tree]] = {}
    for group in groups:
        found = _grow_in_team(blocks, group, places, members)
        if found is None:
            return _grow_by_levels(blocks, fits)
        out |= found
    return out


def _grow_in_tasks(blocks: DataFrame, fits: list[Fit]) -> dict[tuple, list[Tree]]:
    jobs = []
    for fit in fits:
        step = fit.spec.trees if fit.spec.kind == "boost" else FOREST_TREES
        jobs += [(fit.number, at, min(at + step, fit.spec.trees)) for at in range(0, fit.spec.trees, step)]
    jobs.sort(key=lambda j: j[1] - j[2])  # the longest first

    def run(batches):
        for batch in batches:
            for record in batch.to_pylist():
                number, start, end = jobs[record["job"]]
                rows, trees = BlockRows(record, fits[number]), []
                for tree_no in range(start, end):
                    leaves: list[tuple[int, np.ndarray]] = []
                    trees.append(grow_in_block(rows, tree_no, leaves))
                    if rows.score is not None:
                        rows.add(trees[-1], leaves)
                text = json.dumps([t.to_dict() for t in trees])
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([start]), pa.array([text])], ["fit", "start", "trees"])

    # one partition per job, in their order; the block is one row of bounded size
    block = blocks.select(F.struct("*")).scalar()
    spark = blocks.sparkSession
    dealt = spark.range(0, len(jobs), 1, len(jobs)).select(F.col("id").alias("job"), block.alias("b")).select("job", "b.*")
    out: dict[tuple, list[Tree]] = {f.key: [] for f in fits}
    for row in sorted(dealt.mapInArrow(run, "fit bigint, start bigint, trees string").collect(), key=lambda r: (r[0], r[1])):
        out[fits[row["fit"]].key] += [Tree.from_dict(t) for t in json.loads(row["trees"])]
    return out


class TeamTree:
    """A tree while a team grows it: one member's rows, whose sums add up to those of all rows."""

    def __init__(self, rows: BlockRows, number: int):
        used, self.channels = rows.channels(number)
        self.rows, self.growth, self.leaves = rows, Growth(rows.fit, number), []
        spec = self.growth.spec
        self.once, self.boost = not spec.second_order, spec.kind == "boost"
        self.joint = rows.joint(self.growth.usable) if spec.node_features is None else None
        # of the splits of the level above: their sums, the smaller of the two nodes below, totals of both
        self.stand, self.above, self.smaller, self.below = [np.flatnonzero(used)], None, None, None

    def sums(self) -> np.ndarray:
        """(cells, 3): what this member adds to the sums that the open nodes wait for, bins that no row has left out."""
        growth, rows, stand = self.growth, self.rows, self.stand
        self.nodes, self.feats = growth.open, growth.looked_at()
        self.paired = False
        if growth.level == growth.spec.depth and self.above is not None:  # only totals are needed
            if not self.boost:
                return np.empty((0, 3), np.int64)  # known from the level above
            return np.array([[len(r), *(c.take(r).sum() for c in self.channels[1:])] for r in stand]).astype(np.int64)
        nodes, feats = self.nodes, self.feats
        if self.above is not None and growth.spec.node_features is None:
            self.paired = True
            nodes, stand = [nodes[i] for i in self.smaller], [stand[i] for i in self.smaller]
            feats = feats[: len(nodes)]
        found = level_sums(rows.x, stand, self.channels, nodes, feats, self.once, rows.bins, self.joint)
        self.cells = np.arange(MAX_BINS) < rows.bins[feats][..., None]
        return found[self.cells]

    def split(self, total: np.ndarray) -> None:
        """Split the open nodes by ``total``, the ``sums`` of all members."""
        growth, nodes, feats, tree = self.growth, self.nodes, self.feats, self.growth.tree
        if growth.level == growth.spec.depth and self.above is not None:
            sums = (total if self.boost else np.array(self.below)).reshape(len(nodes), 1, 1, 3)
        else:
            sums = np.zeros((*self.cells.shape, 3), np.int64)
            sums[self.cells] = total
            if self.paired:
                pair, one = np.arange(len(sums)), np.array(self.smaller) % 2
                both = np.empty((len(sums), 2, *sums.shape[1:]), np.int64)
                both[pair, one], both[pair, 1 - one] = sums, self.above - sums
                sums = both.reshape(len(nodes), *sums.shape[1:])
        growth.split(sums, feats)
        parents = [i for i, node in enumerate(nodes) if tree.feature[node] >= 0]
        if self.boost and not growth.spec.max_leaves:
            self.leaves += [(node, r) for node, r in zip(nodes, self.stand) if tree.feature[node] < 0]
        self.below = [side for i in parents for side in _sums_below(tree, nodes[i], sums[i], feats[i])]
        self.smaller = [i + (self.below[i + 1][0] < self.below[i][0]) for i in range(0, len(self.below), 2)]
        self.above = sums[parents]
        if growth.open and (self.boost or growth.level < growth.spec.depth):
            self.stand = [part for i in parents for _, part in tree.sides(nodes[i], self.rows.x.T, self.stand[i])]


def team_trees(record: dict, fits: list[Fit], gather: Callable[[np.ndarray], Iterator[np.ndarray]]) -> list[list[Tree]]:
    """The trees of every fit, grown from the rows of a record and those of the other members.

    ``gather`` hands a member's numbers to all members and returns those of all.  Numbers are
    whole, so every member chooses the same splits."""
    seen: dict[int, BlockRows] = {}
    rows = []
    for fit in fits:
        rows.append(BlockRows(record, fit, seen.get(fit.fold)))
        seen.setdefault(fit.fold, rows[-1])
    out: list[list[Tree]] = [[] for _ in fits]
    step = 1 if any(r.score is not None for r in rows) else max(1, TEAM_TREES // len(fits))
    for start in range(0, max(f.spec.trees for f in fits), step):
        growing = [(i, TeamTree(r, n)) for i, r in enumerate(rows) for n in range(start, min(start + step, fits[i].spec.trees))]
        while live := [g for _, g in growing if g.growth.open]:
            parts = [g.sums() for g in live]
            total = sum(gather(np.concatenate(parts)))
            ends = np.cumsum([len(p) for p in parts])
            for g, p, end in zip(live, parts, ends):
                g.split(total[end - len(p) : end])
        for i, g in growing:
            out[i].append(g.growth.done())
            if g.rows.score is not None:
                g.rows.add(out[i][-1], g.leaves)
    return out


def _slots(df: DataFrame) -> int:
    """Tasks that can run at the same time; 1 where their number changes, as a barrier stage needs a fixed one."""
    spark = df.sparkSession
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 1
    context = spark.sparkContext._jsc.sc()
    return context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())


def _members(df: DataFrame, rows: int) -> int:
    """Members of the team that grows trees from so many rows."""
    return max(1, min(_slots(df), TEAM_SIZE, rows // TEAM_ROWS))


def _placed(blocks: DataFrame) -> tuple[dict[int, int], int, int]:
    """The member that gets each block, by the hash of its keys; members; rows of the one with the most."""
    sizes: dict[int, int] = {}
    for name, n in blocks.select(F.xxhash64("key"), F.length("label")).collect():  # blocks
        sizes[name] = sizes.get(name, 0) + n
    held = [0] * min(len(sizes), _members(blocks, sum(sizes.values())))
    places = {}
    for name in sorted(sizes, key=lambda h: (-sizes[h], h)):
        places[name] = held.index(min(held))
        held[places[name]] += sizes[name]
    return places, len(held), max(held)


def _team_fits(fits: list[Fit], rows: int) -> list[list[Fit]] | None:
    """Fits by groups whose rows a member can hold, fits of one fold together; None where one fit is too many."""
    groups: list[list[Fit]] = []
    held, folds = 0, set()
    for fit in sorted(fits, key=lambda f: (f.fold, f.number)):
        own, shared = 64 * rows, (3 * len(fit.bin_map) + 17) * rows  # bins, joint tables, label, key
        more = own + (0 if fit.fold in folds else shared)
        if own + shared > TEAM_BYTES:
            return None
        if not groups or held + more > TEAM_BYTES:
            groups.append([])
            held, folds, more = 0, set(), own + shared
        groups[-1].append(fit)
        held += more
        folds.add(fit.fold)
    return groups


class TeamFiles:
    """Numbers that the members of a team on one machine hand each other through a folder in memory or on disk."""

    def __init__(self, folder: str, member: int, members: int):
        self.folder, self.member, self.members, self.turn = folder, member, members, 0

    def _path(self, turn: int, member: int) -> str:
        return f"{self.folder}/{turn}-{member}"

    def gather(self, own: np.ndarray) -> Iterator[np.ndarray]:
        """The numbers of all members, each as soon as they are there."""
        turn, self.turn = self.turn, self.turn + 1
        own.tofile(self._path(turn, self.member) + ".part")
        os.rename(self._path(turn, self.member) + ".part", self._path(turn, self.member))
        if turn > 1:  # who has the numbers of a turn has read those before
            os.unlink(self._path(turn - 2, self.member))
        for member in range(self.members):
            path, since = self._path(turn, member), time.monotonic()
            while member != self.member and not os.path.exists(path):
                if time.monotonic() - since > TEAM_WAIT:
                    raise TimeoutError(f"member {member} of a team of {self.members} did not go on")
                time.sleep(0.0005)
            yield own if member == self.member else np.fromfile(path, own.dtype).reshape(own.shape)


def _team_files(context: BarrierTaskContext) -> TeamFiles | None:
    """The files of a stage's tasks in a folder that the first makes; None where one of them does not see it."""
    member, members = context.partitionId(), len(context.getTaskInfos())
    memory = "/dev/shm"
    made = tempfile.mkdtemp(prefix="team-", dir=memory if os.access(memory, os.W_OK) else None) if member == 0 else ""
    folder = context.allGather(made)[0]
    try:
        open(f"{folder}/here-{member}", "x").close()
    except OSError:
        pass
    context.barrier()
    seen = len([n for n in os.listdir(folder) if n.startswith("here-")]) if os.path.isdir(folder) else 0
    together = all(n == str(members) for n in context.allGather(str(seen)))
    return TeamFiles(folder, member, members) if together else None


def _cleared(context: BarrierTaskContext, files: TeamFiles | None) -> None:
    """Take the folder away once all members are done with it."""
    context.barrier()
    if files is not None and files.member == 0:
        for name in os.listdir(files.folder):
            os.unlink(f"{files.folder}/{name}")
        os.rmdir(files.folder)


def _grow_in_team(blocks: DataFrame, fits: list[Fit], places: dict[int, int], members: int) -> dict[tuple, list[Tree]] | None:
    """The trees of all fits from one stage whose tasks run together, each with its blocks; None if they are not on one machine."""
    names = ("bins", "label", "fold", "key")

    def run(batches):
        held = [r for batch in batches for r in batch.to_pylist()]
        context = BarrierTaskContext.get()
        files = _team_files(context)
        grown = []
        if files is not None:
            grown = team_trees({c: b"".join(r.pop(c) for r in held) for c in names}, fits, files.gather)
        _cleared(context, files)
        if context.partitionId() == 0:  # all members have the same trees
            for i, trees in enumerate(grown):
                text = json.dumps([t.to_dict() for t in trees])
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([text])], ["fit", "trees"])

    member = F.create_map(*chain.from_iterable((F.lit(h), F.lit(p)) for h, p in places.items()))[F.xxhash64("key")]
    dealt = blocks.select(*names).repartitionById(members, member)
    found = dealt.mapInArrow(run, "fit bigint, trees string", barrier=True).collect()
    return {fits[r["fit"]].key: [Tree.from_dict(t) for t in json.loads(r["trees"])] for r in found} or None


def _one_level(blocks: DataFrame, growths: list[Growth], scored: list[list[Tree]] | None = None) -> None:
    """Split the open nodes of all ``growths`` by one aggregate over the blocks.

    ``scored`` holds, per growth, boosted trees that the written scores do not contain."""
    wanted = [(g.fit, g.number, g.tree, g.open, g.looked_at()) for g in growths]

    def partial(batches):
        for batch in batches:
            for record in batch.to_pylist():
                seen: dict[int, BlockRows] = {}
                for i, (fit, number, tree, nodes, feats) in enumerate(wanted):
                    rows = seen.get(fit.number)
                    if rows is None:
                        rows = seen[fit.number] = BlockRows(record, fit)
                        if rows.score is not None and record.get("scores") is not None:
                            rows.score = np.frombuffer(record["scores"][fit.number])[rows.inside]
                        for t in scored[i] if scored else []:
                            rows.add(t)
                    used, channels = rows.channels(number)
                    x = np.compress(used, rows.x.T, axis=1).T
                    sums = level_sums(x, tree.leaf_of(x), [c[used] for c in channels], nodes, feats, not fit.spec.second_order, rows.bins)
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["at", "sums"])

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(packed, np.int64)
                sums[i] = sums[i] + part if i in sums else part.copy()
        for i, whole in sums.items():
            growth, feats = growths[i], wanted[i][4]
            growth.split(whole.reshape(*feats.shape, MAX_BINS, -1), feats)
            state = json.dumps({"tree": growth.tree.to_dict(), "open": growth.open, "level": growth.level})
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([state])], ["at", "state"])

    dealt = blocks.mapInArrow(partial, "at int, sums binary").repartition(len(growths), "at")
    for row in dealt.mapInArrow(total, "at int, state string").collect():
        state, growth = json.loads(row["state"]), growths[row["at"]]
        growth.tree, growth.open, growth.level = Tree.from_dict(state["tree"]), state["open"], state["level"]


def _grow_by_levels(blocks: DataFrame, fits: list[Fit]) -> dict[tuple, list[Tree]]:
    out: dict[tuple, list[Tree]] = {f.key: [] for f in fits}
    forests = [Growth(f, n) for f in fits if f.spec.kind != "boost" for n in range(f.spec.trees)]
    for at in range(0, len(forests), LEVEL_TREES):
        chunk = forests[at : at + LEVEL_TREES]
        while live := [g for g in chunk if g.open]:
            _one_level(blocks, live)
        for g in chunk:
            out[g.fit.key].append(g.done())
    boosted = [f for f in fits if f.spec.kind == "boost"]
    state, since = blocks, 0
    for number in range(max((f.spec.trees for f in boosted), default=0)):
        growths = [Growth(f, number) for f in boosted if number < f.spec.trees]
        while live := [g for g in growths if g.open]:
            _one_level(state, live, [out[g.fit.key][number - since :] for g in live])
        for g in growths:
            out[g.fit.key].append(g.done())
        since += 1
        if since == SETTLE_TREES:
            state, since = _settled(state, boosted, {f.key: out[f.key][number + 1 - since :] for f in boosted}, len(fits)), 0
    return out


def _settled(blocks: DataFrame, fits: list[Fit], trees: dict[tuple, list[Tree]], n_fits: int) -> DataFrame:
    """The blocks with the rows' scores after ``trees``, written."""

    def move(batches):
        for batch in batches:
            for record in batch.to_pylist():
                scores = [b""] * n_fits
                for fit in fits:
                    rows = BlockRows(record, replace(fit, fold=-1))
                    if record.get("scores") is not None:
                        rows.score = np.frombuffer(record["scores"][fit.number])
                    for t in trees[fit.key]:
                        rows.add(t)
                    scores[fit.number] = rows.score.tobytes()
                row = {c: record[c] for c in ("bins", "label", "fold", "key")}
                yield pa.RecordBatch.from_pylist([row | {"scores": scores}], _SCORED)

    return written(blocks.mapInArrow(move, "bins binary, label binary, fold binary, key binary, scores array<binary>"), "scores")


_SCORED = pa.schema([(c, pa.binary()) for c in ("bins", "label", "fold", "key")] + [("scores", pa.list_(pa.binary()))])


# --- the fitted model -------------------------------------------------------------------------------------
class TreeEnsembleModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Scores vectors by an ensemble; adds ``probability`` (of no event, of the event)."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    ensemble = Param(Params._dummy(), "ensemble", "nodes of all trees as JSON", TypeConverters.toString)

    @classmethod
    def of(cls, fit: Fit, trees: list[Tree], features_col: str) -> TreeEnsembleModel:
        nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "value", "cover", "gain")}
        roots = []
        for t in trees:
            base = len(nodes["feature"])
            roots.append(base)
            nodes["feature"] += t.feature
            nodes["threshold"] += [float(fit.edges[f, c]) if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)]
            nodes["left"] += [base + x if f >= 0 else -1 for f, x in zip(t.feature, t.left)]
            for k in ("value", "cover", "gain"):
                nodes[k] += [float(v) for v in getattr(t, k)]
        boosted = fit.spec.kind == "boost"
        model = cls()
        model._set(featuresCol=features_col, ensemble=json.dumps(
            nodes | {"roots": roots, "features": len(fit.bin_map), "boosted": boosted, "start": fit.start}
        ))
        return model

    def nodes(self) -> dict:
        """Node arrays, roots, and how leaf values become a probability."""
        if not hasattr(self, "_nodes"):
            raw = json.loads(self.getOrDefault(self.ensemble))
            kinds = {"feature": np.int64, "left": np.int64, "roots": np.int64, "threshold": float, "value": float, "cover": float, "gain": float}
            self._nodes = {k: np.array(v, kinds[k]) if k in kinds else v for k, v in raw.items()}
        return self._nodes

    @property
    def featureImportances(self) -> DenseVector:
        """Gain per feature, the sum being one."""
        n = self.nodes()
        inner = n["feature"] >= 0
        total = np.bincount(n["feature"][inner], n["gain"][inner], n["features"])
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def scorer(self) -> Callable[[list[np.ndarray]], np.ndarray]:
        """The event probability of rows whose features are given as columns."""
        nodes = self.nodes()

        def scores(columns: list[np.ndarray], rows_at_once: int = 1 << 15) -> np.ndarray:
            out = np.empty(len(columns[0]))
            for at in range(0, len(out), rows_at_once):
                part = slice(at, at + rows_at_once)
                out[part] = ensemble_probability(np.stack([c[part] for c in columns], axis=1), nodes)
            return out

        return scores

    def _transform(self, dataset: DataFrame) -> DataFrame:
        nodes = self.nodes()

        @F.arrow_udf("double")
        def event(vectors: pa.Array) -> pa.Array:
            x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
            return pa.array(ensemble_probability(x, nodes))

        p = event(vector_to_array(F.col(self.getOrDefault(self.featuresCol))))
        with_p = dataset.withColumn("_event", p)
        return with_p.withColumn("probability", array_to_vector(F.array(1 - F.col("_event"), F.col("_event")))).drop("_event")


def raw_scores(x: np.ndarray, nodes: dict, rows_at_once: int = 256) -> np.ndarray:
    """Sum of the leaf values of all trees per row of ``x``; few rows at a time stay in a core's cache."""
    out, flat, k = np.empty(len(x)), np.ascontiguousarray(x).reshape(-1), x.shape[1]
    leaf = nodes["feature"] < 0
    # a leaf sends every row back to itself
    feature, threshold = np.where(leaf, 0, nodes["feature"]), np.where(leaf, np.inf, nodes["threshold"])
    left, value = np.where(leaf, np.arange(len(leaf)), nodes["left"]), nodes["value"]
    for start in range(0, len(x), rows_at_once):
        first = np.arange(start, min(start + rows_at_once, len(x)))[:, None] * k
        at, before = np.tile(nodes["roots"], (len(first), 1)), None
        while before is None or (at != before).any():
            before = at
            at = left.take(at) + (flat.take(feature.take(at) + first) > threshold.take(at))
        out[start : start + rows_at_once] = value.take(at).sum(axis=1)
    return out


def ensemble_probability(x: np.ndarray, nodes: dict) -> np.ndarray:
    total = raw_scores(x, nodes)
    if nodes["boosted"]:
        return 1.0 / (1.0 + np.exp(-(nodes["start"] + total)))
    return total / max(1, len(nodes["roots"]))
