"""Tree learners that pass over binned rows: boosted trees and forests of two classes, as Spark ML models.

Numbers are replaced once by the bins (at most ``MOST_BINS``) between cut points of their feature, and rows are packed
into blocks kept by the executors.  A pass is one job: its tasks add up counts and slopes per node, feature and bin, and
the driver picks the splits of a whole level from the total.  All nodes of a level, in a forest of many trees, share a
pass, and so do boosted models that are fitted together, of which each is at a level of its own.  What a task hands on is
bounded by nodes and bins, whatever the rows.

Which rows a tree draws is a hash of the claim id, the seed and the tree, so retries and other partitions draw the same.
Functions that tasks run are nested: they travel with the job, so executors need not have this package.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.workspace import fresh_path, stage_table

#: Bins of a feature, as Spark's learners have by default, and how exact the places of quantiles are.
MOST_BINS = 32
QUANTILE_ERROR = 0.001
#: Rounds after which the margins kept with the rows are brought up to date; later trees are applied in every pass.
KEPT_ROUNDS = 5
#: Sums (8 bytes each) that a task of a forest holds at a time.
OPEN_SUMS = 1_000_000
#: Nodes of a forest that the driver splits at a time, and nodes of a model that it writes at a time.
SPLIT_NODES = 256
WRITTEN_NODES = 20_000
NODE_ROW = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, "
    "rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


@dataclass
class Tree:
    """A tree by levels: the children of node ``i`` are ``2 i + 1`` and ``2 i + 2``.

    Bins up to ``cut`` of ``feature`` go left; a node without feature is a leaf.  ``stats`` has a row of sums per node,
    whose first number is its weight.
    """

    feature: np.ndarray
    cut: np.ndarray
    rows: np.ndarray
    gain: np.ndarray
    stats: np.ndarray

    @staticmethod
    def empty(depth: int, sums: int) -> Tree:
        size = (2 << depth) - 1
        return Tree(np.full(size, -1), np.full(size, 255, np.uint8), np.zeros(size, np.int64), np.full(size, -1.0), np.zeros((size, sums)))

    def path(self, levels: int) -> tuple[np.ndarray, np.ndarray]:
        """Feature and cut of all nodes above a level; from a leaf rows go on to the left."""
        above = (1 << levels) - 1
        return np.maximum(self.feature[:above], 0).astype(np.int32), self.cut[:above]


# --- rows -----------------------------------------------------------------------------------------

def cut_points(df: DataFrame) -> list[np.ndarray]:
    """Cut points of every feature: between all values where there are few, else at quantiles of all rows."""
    values, most = df.select(vector_to_array(F.col("features")).alias("x")), MOST_BINS

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                found = found or [np.zeros(0)] * x.shape[1]
                found = [f if len(f) > most else np.unique(np.append(f, c[~np.isnan(c)]))[: most + 1] for f, c in zip(found, x.T)]
        if found:
            yield pa.RecordBatch.from_pydict({"feature": pa.array(range(len(found)), pa.int32()), "seen": pa.array(found, pa.list_(pa.float64()))})

    held: dict[int, np.ndarray] = {}
    for row in values.mapInArrow(distinct, "feature int, seen array<double>").collect():  # 33 numbers a feature and partition
        held[row["feature"]] = np.unique(np.append(held.get(row["feature"], []), row["seen"]))
    cuts = [(held[j][1:] + held[j][:-1]) / 2 for j in range(len(held))]
    wide = [j for j in range(len(held)) if len(held[j]) > most]
    if wide:
        shares = [i / most for i in range(1, most)]
        numbers = values.select(*[F.get("x", F.lit(j)).alias(f"x{j}") for j in wide])
        for j, found in zip(wide, numbers.approxQuantile(numbers.columns, shares, QUANTILE_ERROR)):
            cuts[j] = np.unique(found)
    return cuts


def binned(df: DataFrame, sets: Sequence[tuple[int | None, Sequence[np.ndarray], int]], seed: int, sparse: bool) -> RDD:
    """Blocks (set, bins, codes, labels, draws, margins) of rows, kept while in use.

    A set is the rows without one value of ``_fold`` (none: all rows), its cut points, and for how many models it has
    margins.  With ``sparse`` a row has the codes of its bins other than the first of each feature; most features are
    flags, so these are few, and sums of first bins are what the others leave of the node's.
    """
    sets = list(sets)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            labels, draws, fold = np.asarray(batch.column("y")).astype(np.uint8), np.asarray(batch.column("h")).view(np.uint64), np.asarray(batch.column("f"))
            for number, (without, cuts, models) in enumerate(sets):
                keep = np.arange(len(labels)) if without is None else np.flatnonzero(fold != without)
                n = len(keep)
                if not n:
                    continue
                bins = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, numbers[keep].T)], axis=1).astype(np.uint8)
                codes = np.zeros((n, 0), np.uint16)
                if sparse:
                    starts = np.cumsum([0, *[len(c) + 1 for c in cuts]])
                    row, column = np.nonzero(bins)
                    many = np.bincount(row, minlength=n)
                    codes = np.full((n, max(1, many.max())), starts[-1], np.uint16)
                    codes[row, np.arange(len(row)) - (np.cumsum(many) - many)[row]] = starts[column] + bins[row, column]
                parts = bins, codes, labels[keep], draws[keep], np.zeros((models, n))
                yield pa.RecordBatch.from_pydict({"s": pa.array([number], pa.int32())} | {f"p{i}": pa.array([p.tobytes()], pa.binary()) for i, p in enumerate(parts)})

    same = K.KEY if K.KEY in df.columns else vector_to_array(F.col("features"))  # without an id, equal rows are drawn together
    fold = F.col("_fold").cast("int") if any(without is not None for without, _, _ in sets) else F.lit(0)
    rows = df.select(vector_to_array(F.col("features")).alias("x"), F.col("label").cast("int").alias("y"), F.xxhash64(same, F.lit(seed)).alias("h"), fold.alias("f"))
    made = rows.mapInArrow(pack, "s int, " + ", ".join(f"p{i} binary" for i in range(5)))
    return made.rdd.map(lambda row: (row[0], *[bytes(p) for p in row[1:]])).persist(StorageLevel.MEMORY_AND_DISK)


def _tools(width: int) -> tuple[Callable, Callable, Callable]:
    """Unpack a block, draw numbers of 64 bits for a tree, and walk rows down some levels of a tree."""

    def unpack(block: tuple) -> tuple[np.ndarray, ...]:
        _, bins, codes, labels, draws, margins = block
        n = len(labels)
        return np.frombuffer(bins, np.uint8), np.frombuffer(codes, np.uint16).reshape(n, -1), np.frombuffer(labels, np.uint8), np.frombuffer(draws, np.uint64), np.frombuffer(margins).reshape(-1, n) if margins else None

    def draw(h: np.ndarray, tree: int) -> np.ndarray:
        z = h + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))

    def walk(bins: np.ndarray, base: np.ndarray, path: tuple[np.ndarray, np.ndarray], levels: int) -> np.ndarray:
        """Number of each row's node within its level."""
        feature, cut = path
        node = np.zeros(len(base), np.int32)
        for _ in range(levels):
            at = feature.take(node)
            at += base
            right = bins.take(at) > cut.take(node)
            node += node
            node += 1
            node += right
        return node - ((1 << levels) - 1)

    return unpack, draw, walk


def total(blocks: RDD, sums: Callable[[tuple], np.ndarray]) -> np.ndarray:
    """``sums`` of all blocks, in one job.  One array a task reaches the driver, whole numbers as small as they fit."""

    def add(part: Iterator[tuple]) -> Iterator[np.ndarray]:
        held = None
        for block in part:
            found = sums(block)
            if held is None:
                held = found
            else:
                held += found
        if held is not None:
            yield held.astype(np.min_scalar_type(held.max(initial=0))) if held.dtype.kind in "iu" else held

    cores = max(1, blocks.context.defaultParallelism)
    few = blocks.coalesce(cores) if blocks.getNumPartitions() > cores else blocks
    out = None
    for found in few.mapPartitions(add).collect():
        kind = np.float64 if found.dtype.kind == "f" else np.int64
        out = found.astype(kind) if out is None else out + found
    return out


# --- boosted trees --------------------------------------------------------------------------------

def _best(left: np.ndarray, whole: np.ndarray, allowed: np.ndarray, min_leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Per node the place with the largest fall of the weighted variance, and the fall per weight (-1: none).

    ``left`` holds rows, weight and slope left of every place, ``whole`` those of the nodes.
    """
    right = whole[:, None] - left
    open_ = allowed & (left[..., 0] >= min_leaf) & (right[..., 0] >= min_leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(open_, left[..., 2] ** 2 / left[..., 1] + right[..., 2] ** 2 / right[..., 1], -np.inf)
    at = score.argmax(axis=1)
    own = whole[:, 2] ** 2 / whole[:, 1]
    fall = score[np.arange(len(at)), at] - own
    return at, np.where(fall > 1e-12 * np.abs(own), fall / whole[:, 1], -1.0)


@dataclass(frozen=True)
class Boosting:
    """How one boosted model is fitted, and on which rows: those without a value of ``_fold``, or all.

    Weights are those of the classes, negative one first.
    """

    rounds: int = 200
    depth: int = 5
    step: float = 0.05
    row_share: float = 0.8
    column_share: float = 1.0
    min_leaf: int = 1
    weights: tuple[float, float] = (1.0, 1.0)
    without: int | None = None


#: What a boosted model wants of a pass: its round and level, the path to the level, and the open nodes' slots.
Wanted = tuple[int, int, tuple, np.ndarray]


@dataclass
class Growing:
    """A boosted model that is being fitted, one pass after the other."""

    how: Boosting
    seed: int
    cuts: Sequence[np.ndarray]
    group: int  # the set of its rows
    place: int  # which of the set's margins are its own
    trees: list[Tree] = field(default_factory=list)
    pending: list[tuple] = field(default_factory=list)  # trees that the kept margins lack: path and values

    def __post_init__(self):
        self.width, self.starts = len(self.cuts), np.cumsum([0, *[len(c) + 1 for c in self.cuts]])
        self.owner, self.cells = np.repeat(np.arange(self.width), np.diff(self.starts)), int(self.starts[-1])
        self.inner = np.ones(self.cells, np.bool_)
        self.inner[self.starts[1:] - 1] = False  # right of a feature's last bin is nothing
        self.kinds, self.each = (1, np.ones(1)) if self.how.weights == (1.0, 1.0) else (2, np.array(self.how.weights))

    def values(self, tree: Tree, number: int) -> np.ndarray:
        """What a tree adds to the margin of rows at its last level."""
        out = np.zeros(len(tree.rows))
        for i in range(len(out)):
            out[i] = tree.stats[i, 1] / tree.stats[i, 0] if tree.rows[i] else out[(i - 1) // 2]
        return out[-(1 << self.how.depth) :] * (self.how.step if number else 1.0)

    def histograms(self, found: np.ndarray) -> np.ndarray:
        """Rows, weight and slope of (node, bin); the last bin is the whole node."""
        counts, pulls = found.reshape(2, -1, self.kinds, self.cells + 1)
        out = np.stack((counts.sum(axis=1), np.tensordot(self.each, counts, (0, 1)), pulls.sum(axis=1)), axis=-1)
        first = self.starts[:-1]
        out[:, first] = 0.0
        out[:, first] = out[:, -1:] - np.add.reduceat(out[:, : self.cells], first, axis=1)
        return out

    def finish(self, tree: Tree, squares: np.ndarray) -> None:
        """Squared slopes of the last nodes, added up to the root."""
        tree.stats[-(1 << self.how.depth) :, 2] = squares
        for i in reversed(range((1 << self.how.depth) - 1)):
            tree.stats[i, 2] = tree.stats[2 * i + 1, 2] + tree.stats[2 * i + 2, 2]

    def grow(self) -> Generator[Wanted, np.ndarray, None]:
        """Grows all trees; yields what it wants of the next pass and is sent the sums."""
        depth, min_leaf, owner, starts, cells = self.how.depth, self.how.min_leaf, self.owner, self.starts, self.cells
        for number in range(self.how.rounds):
            tree, hist, numbers = Tree.empty(depth, 3), np.zeros((0, cells + 1, 3)), np.zeros(1, np.int64)
            for level in range(depth):
                first = (1 << level) - 1
                small = numbers if not level else numbers[0::2] + (tree.rows[numbers[0::2]] > tree.rows[numbers[1::2]])
                slots = np.full(1 << level, -1)
                slots[small - first] = np.arange(len(small))
                found = yield number, level, tree.path(level), slots
                if level == 0 and self.pending:
                    self.finish(self.trees[-1], found[-(1 << depth) :])
                fresh = self.histograms(found[: -(1 << depth)])
                if level:
                    both = np.empty((len(numbers), *fresh.shape[1:]))
                    right = small != numbers[0::2]
                    both[np.arange(len(small)) * 2 + right], both[np.arange(len(small)) * 2 + ~right] = fresh, hist - fresh
                    fresh = both
                whole = fresh[:, -1]
                if level == 0:
                    tree.rows[0], tree.stats[0, :2] = whole[0, 0], whole[0, 1:]
                left = np.cumsum(fresh[:, :cells], axis=1)
                left -= np.concatenate((np.zeros_like(left[:, :1]), left), axis=1)[:, starts[owner]]
                allowed = np.tile(self.inner, (len(numbers), 1))
                if self.how.column_share < 1.0:
                    some = math.ceil(self.how.column_share * self.width)
                    for i, node in enumerate(numbers):
                        chosen = np.random.default_rng([self.seed, number, int(node)]).choice(self.width, some, replace=False)
                        allowed[i] &= np.isin(owner, chosen)
                at, gain = _best(left, whole, allowed, min_leaf)
                split = np.flatnonzero(gain > 0)
                node = numbers[split]
                tree.feature[node], tree.cut[node], tree.gain[node] = owner[at[split]], at[split] - starts[owner[at[split]]], gain[split]
                for side, part in ((1, left[split, at[split]]), (2, whole[split] - left[split, at[split]])):
                    tree.rows[2 * node + side], tree.stats[2 * node + side, :2] = np.rint(part[:, 0]), part[:, 1:]
                if not len(node):
                    break
                hist, numbers = fresh[split], np.stack((2 * node + 1, 2 * node + 2), axis=1).ravel()
                # A pair of children too small to be split is left alone.
                go = np.repeat((tree.rows[numbers].reshape(-1, 2) >= 2 * min_leaf).any(axis=1), 2)
                hist, numbers = hist[go[::2]], numbers[go]
                if not len(numbers):
                    break
            self.trees.append(tree)
            self.pending.append((tree.path(depth), self.values(tree, number)))
        self.finish(self.trees[-1], (yield self.how.rounds, 0, self.trees[-1].path(0), np.full(1, -1)))

    def sums(self, wanted: Wanted) -> tuple[int, Callable]:
        """How many numbers a block gives for a pass, and how: rows and slopes per open node, kind and bin, then per last
        node of the tree before its squared slopes.  Margins are worked out for the rows that the pass adds up only."""
        number, level, path, slots = wanted
        used, place, open_ = list(self.pending), self.place, int(slots.max(initial=-1)) + 1
        depth, width, cells, kinds, each = self.how.depth, self.width, self.cells, self.kinds, self.each
        bound = int(min(self.how.row_share, 1.0) * (1 << 53))
        _, draw, walk = _tools(width)

        def slopes(number: int, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sign = 2.0 * y - 1.0
            return each[y * (kinds - 1)], sign if not number else 4.0 * sign / (1.0 + np.exp(np.minimum(2.0 * sign * margin, 700.0)))

        def run(bins: np.ndarray, codes: np.ndarray, labels: np.ndarray, h: np.ndarray, margins: np.ndarray) -> np.ndarray:
            base, last, margin = np.arange(len(labels), dtype=np.int32) * np.int32(width), np.zeros(1 << depth), margins[place]
            if level == 0:
                for way, added in used[:-1]:
                    margin = margin + added[walk(bins, base, way, depth)]
                for way, added in used[-1:]:
                    leaf = walk(bins, base, way, depth)
                    weight, pull = slopes(number - 1, labels.astype(np.int64), margin)
                    last = np.bincount(leaf, weight * pull**2 * ((draw(h, number - 1) >> np.uint64(11)) < bound), len(last))
                    margin = margin + added[leaf]
            if not open_:
                return last
            at = np.flatnonzero((draw(h, number) >> np.uint64(11)) < bound)
            slot = slots[walk(bins, base[at], path, level)]
            at, slot = at[slot >= 0], slot[slot >= 0]
            margin, y = margin[at], labels[at].astype(np.int64)
            for way, added in used if level else ():
                margin = margin + added[walk(bins, base[at], way, depth)]
            weight, pull = slopes(number, y, margin)
            where = slot * kinds + y * (kinds - 1)
            code = codes.take(at, axis=0).astype(np.int64)
            code += (where * (cells + 1))[:, None]
            size = open_ * kinds * (cells + 1)
            counts = np.bincount(code.ravel(), minlength=size).astype(np.float64).reshape(-1, cells + 1)
            pulls = np.bincount(code.ravel(), np.repeat(weight * pull, codes.shape[1]), size).reshape(-1, cells + 1)
            counts[:, -1], pulls[:, -1] = np.bincount(where, minlength=open_ * kinds), np.bincount(where, weight * pull, open_ * kinds)
            return np.concatenate((counts.ravel(), pulls.ravel(), last))

        return 2 * open_ * kinds * (cells + 1) + (1 << depth), run


def boosted_together(df: DataFrame, fits: Sequence[Boosting], seed: int) -> list[tuple[list[Tree], Sequence[np.ndarray]]]:
    """Trees and cut points of several boosted models.  Each pass serves all that are not done, so they take as many passes as
    the longest one alone; those of the same rows share the rows' bins.

    Trees are those of gradient boosting by the logistic loss of labels -1 and 1.  The first tree is fitted to the labels and
    counts whole, each later one to the slopes, by ``step``.  Of two children only the smaller one's rows are added up; the
    other has what is left of its parent.
    """
    groups = list(dict.fromkeys(how.without for how in fits))
    cuts = [cut_points(df if without is None else df.filter(F.col("_fold") != without)) for without in groups]
    members = [[i for i, how in enumerate(fits) if how.without == without] for without in groups]
    models = [Growing(how, seed, cuts[g], g, members[g].index(i)) for i, how in enumerate(fits) for g in [groups.index(how.without)]]
    blocks, old = binned(df, [(without, cuts[g], len(members[g])) for g, without in enumerate(groups)], seed, True), None
    unpack = _tools(0)[0]

    def passed(parts: list[tuple[int, int, int, Callable]], size: int) -> Callable[[tuple], np.ndarray]:
        def sums(block: tuple) -> np.ndarray:
            arrays, out = unpack(block), np.zeros(size)
            for group, at, to, run in parts:
                if group == block[0]:
                    out[at:to] = run(*arrays)
            return out

        return sums

    def brought_up(kept: RDD, used: list[tuple[int, int, int, list]]) -> RDD:
        tools = {width: _tools(width) for _, _, width, _ in used}

        def run(block: tuple) -> tuple:
            bins, _, y, _, margins = unpack(block)
            margins = margins.copy()
            for group, place, width, ways in used:
                if group == block[0]:
                    base = np.arange(len(y), dtype=np.int32) * np.int32(width)
                    for way, added in ways:
                        margins[place] += added[tools[width][2](bins, base, way, len(added).bit_length() - 1)]
            return (*block[:5], margins.tobytes())

        return kept.map(run).persist(StorageLevel.MEMORY_AND_DISK)

    try:
        running = {i: model.grow() for i, model in enumerate(models)}
        wanted = {i: next(steps) for i, steps in running.items()}
        while wanted:
            if max(len(models[i].pending) for i in wanted) > KEPT_ROUNDS:
                # The last tree stays pending for its squared slopes.
                blocks, old = brought_up(blocks, [(m.group, m.place, m.width, m.pending[:-1]) for m in map(models.__getitem__, wanted)]), blocks
                for i in wanted:
                    models[i].pending = models[i].pending[-1:]
            parts, size = [], 0
            for i, what in wanted.items():
                more, run = models[i].sums(what)
                parts.append((models[i].group, size, size + more, run))
                size += more
            found = total(blocks, passed(parts, size))
            if old is not None:
                old.unpersist()
                old = None
            for (_, at, to, _), i in zip(parts, list(wanted)):
                try:
                    wanted[i] = running[i].send(found[at:to])
                except StopIteration:
                    del wanted[i]
        return [(model.trees, model.cuts) for model in models]
    finally:
        blocks.unpersist()
        if old is not None:
            old.unpersist()


# --- forests --------------------------------------------------------------------------------------

def forest_trees(df: DataFrame, trees: int, depth: int, min_leaf: int, weights: tuple[float, float], seed: int) -> tuple[list[Tree], list[np.ndarray]]:
    """Trees of a random forest by the Gini index, and the cut points.

    A tree has each row as often as a Poisson number of mean one tells; a node looks at a random choice of features, the
    square root of their number.  Trees go down level by level together, as many in a pass as ``OPEN_SUMS`` allows.
    """
    cuts = cut_points(df)
    width, sizes = len(cuts), np.array([len(c) + 1 for c in cuts])
    some = math.ceil(math.sqrt(width))
    chance = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(10)])
    copies = np.searchsorted(chance, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
    unpack, draw, walk = _tools(width)
    blocks = binned(df, [(None, cuts, 0)], seed, False)
    grown = [Tree.empty(depth, 2) for _ in range(trees)]
    each = np.array(weights)

    def group_sums(level: int, members: list[tuple]) -> Callable[[tuple], np.ndarray]:
        """Rows per open node, chosen feature, bin and label of some trees."""

        def sums(block: tuple) -> np.ndarray:
            bins, _, labels, h, _ = unpack(block)
            twice = (bins.reshape(len(labels), width) * np.uint8(2) + labels[:, None]).ravel()  # bin and label, 64 at most
            base, out = np.arange(len(labels), dtype=np.int32) * np.int32(width), []
            for number, path, slots, features, places, size in members:
                many = copies[draw(h, number) >> np.uint64(48)]
                at = np.flatnonzero(many)
                slot = slots[walk(bins, base[at], path, level)]
                at, slot = at[slot >= 0], slot[slot >= 0]
                cell, where = places.take(slot, axis=0), features.take(slot, axis=0)
                where += base.take(at)[:, None]
                cell += twice.take(where)
                out.append(np.bincount(cell.ravel(), np.repeat(many.take(at), features.shape[1]), size).astype(np.int64))
            return np.concatenate(out)

        return sums

    def split(tree: Tree, numbers: np.ndarray, features: np.ndarray, places: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Splits the open nodes of a tree; the children that are open in turn."""
        counts = found.reshape(-1, 2).astype(np.float64)
        most = int(sizes.max())
        offset = np.arange(most)
        inside = offset < sizes[features][..., None]
        table = np.where(inside[..., None], counts[np.where(inside, places[..., None] + offset, 0)], 0.0)  # node, feature, bin, label
        left = table.cumsum(axis=2).reshape(len(numbers), -1, 2)
        whole = table[:, 0].sum(axis=1)
        if numbers[0] == 0:
            tree.rows[0], tree.stats[0] = whole[0].sum(), whole[0] * each
        three = lambda c: np.stack((c.sum(axis=-1), c @ each, c[..., 1] * each[1]), axis=-1)
        allowed = (offset < sizes[features][..., None] - 1).reshape(len(numbers), -1)
        at, gain = _best(three(left), three(whole), allowed, min_leaf)
        cut = np.flatnonzero(gain > 0)
        node, at = numbers[cut], at[cut]
        tree.feature[node], tree.cut[node], tree.gain[node] = features[cut, at // most], at % most, 2 * gain[cut]
        for side, part in ((1, left[cut, at]), (2, whole[cut] - left[cut, at])):
            tree.rows[2 * node + side], tree.stats[2 * node + side] = part.sum(axis=1), part * each
        below = np.stack((2 * node + 1, 2 * node + 2), axis=1).ravel()
        return below[(tree.rows[below] >= 2 * min_leaf) & (tree.stats[below].min(axis=1) > 0)]

    try:
        open_ = [np.zeros(1, np.int64)] * trees
        for level in range(depth):
            group, held, below = [], 0, [np.zeros(0, np.int64)] * trees

            def flush() -> None:
                found = total(blocks, group_sums(level, [member for member, _ in group]))
                for (number, _, _, features, places, size), numbers in group:
                    for at in range(0, len(numbers), SPLIT_NODES):
                        to = slice(at, at + SPLIT_NODES)
                        below[number] = np.append(below[number], split(grown[number], numbers[to], features[to], places[to] // 2, found[:size]))
                    found = found[size:]
                group.clear()

            for number, numbers in enumerate(open_):
                for start in range(0, len(numbers), 1 << 15):
                    part = numbers[start : start + (1 << 15)]
                    random = np.random.default_rng([seed, number, level, start])
                    features = np.argsort(random.random((len(part), width)), axis=1)[:, :some].astype(np.int32)
                    ends = np.cumsum(sizes[features].ravel())
                    places = (ends - sizes[features].ravel()).reshape(features.shape)
                    slots = np.full(1 << level, -1)
                    slots[part - ((1 << level) - 1)] = np.arange(len(part))
                    size = 2 * int(ends[-1])
                    if group and held + size > OPEN_SUMS:
                        flush()
                        held = 0
                    group.append(((number, grown[number].path(level), slots, features, 2 * places, size), part))
                    held += size
            if group:
                flush()
            open_ = below
        return grown, cuts
    finally:
        blocks.unpersist()


# --- models ---------------------------------------------------------------------------------------

def node_rows(number: int, tree: Tree, cuts: Sequence[np.ndarray], classes: bool) -> list[tuple]:
    """The nodes of a tree in the order and form in which Spark ML stores them.

    As in Spark's learners, a node whose two leaves predict the same becomes a leaf.
    """
    weight = tree.stats.sum(axis=1) if classes else tree.stats[:, 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        share = tree.stats / weight[:, None]
        impurity = 1.0 - (share**2).sum(axis=1) if classes else np.maximum(share[:, 2] - share[:, 1] ** 2, 0.0)
    prediction = (tree.stats[:, 1] > tree.stats[:, 0]).astype(float) if classes else share[:, 1]
    feature = tree.feature.copy()
    for i in reversed(range(len(feature) // 2)):
        if feature[i] >= 0 and feature[2 * i + 1] < 0 and feature[2 * i + 2] < 0 and prediction[2 * i + 1] == prediction[2 * i + 2]:
            feature[i] = -1
    order, todo = [], [0]
    while todo:
        i = todo.pop()
        order.append(i)
        if feature[i] >= 0:
            todo += [2 * i + 2, 2 * i + 1]
    place = {i: at for at, i in enumerate(order)}
    rows = []
    for at, i in enumerate(order):
        j, own = int(feature[i]), (at, float(prediction[i]), float(impurity[i]), tree.stats[i].tolist(), int(tree.rows[i]))
        if j < 0:
            rows.append((number, (*own, -1.0, -1, -1, (-1, [], -1))))
        else:
            rows.append((number, (*own, float(tree.gain[i]), place[2 * i + 1], place[2 * i + 2], (j, [float(cuts[j][tree.cut[i]])], -1))))
    return rows


def tree_model(df: DataFrame, learner: Any, trees: Sequence[Tree], cuts: Sequence[np.ndarray], weights: Sequence[float], settings: dict) -> Any:
    """The Spark ML model of given trees, read from a folder of Spark ML's form.

    Its settings are those of a model that ``learner`` makes of a single row.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "trees")
    bare_features = array_to_vector(vector_to_array(F.col("features"))).alias("features")  # Spark wants more bins than one row gives for named levels
    few = df.select(bare_features).limit(1).withColumn("label", F.lit(1.0)).withColumn("weight", F.lit(1.0))
    bare = learner.fit(stage_table(few, "tree"))
    bare.write().save(f"{path}/bare")
    about = json.loads(spark.read.text(f"{path}/bare/metadata").first()[0])
    about["paramMap"].update(settings)
    about["numTrees"] = len(trees)
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    one = spark.read.parquet(f"{path}/bare/treesMetadata").first()
    told = [(i, one[1], float(w)) for i, w in enumerate(weights)]
    spark.createDataFrame(told, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    classes = trees[0].stats.shape[1] == 2
    kind = spark.createDataFrame([], NODE_ROW).schema
    node = [f.name for f in kind["nodeData"].dataType.fields]
    cut = ("featureIndex", "leftCategoriesOrThreshold", "numCategories")
    parts: list[pa.Table] = []
    for i, tree in enumerate(trees):
        rows = [{"treeID": k, "nodeData": dict(zip(node, (*n[:-1], dict(zip(cut, n[-1])))))} for k, n in node_rows(i, tree, cuts, classes)]
        parts.append(pa.Table.from_pylist(rows, _arrow()))
        if i + 1 == len(trees) or sum(p.num_rows for p in parts) >= WRITTEN_NODES:
            spark.createDataFrame(pa.concat_tables(parts), kind).coalesce(1).write.mode("append").parquet(f"{path}/model/data")
            parts = []
    return type(bare).load(f"{path}/model")


def _arrow() -> pa.Schema:
    cut = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
    node = pa.struct([
        ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()),
        ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", cut),
    ])
    return pa.schema([("treeID", pa.int32()), ("nodeData", node)])
