"""Histogram gradient boosting (M5, M9, W16): leaf-wise trees over features binned to a byte, logistic loss.

Each feature is cut at the quantiles of its training rows (one mergeable sketch aggregate), so a value becomes one of at
most 255 bins and NULL or NaN the bin 0. The binned rows are written once, in blocks of one byte a value, with a margin a
row. A wave is one job: tasks sum gradients, Hessians and row counts per (node, feature, bin) over their blocks, the sums
meet in a shuffle by (node, feature), and the best cut of each pair (at most nodes x features rows) comes to the driver.

Leaves are opened in order of gain up to ``n_leaves``. A wave looks at the children of every leaf that may still be
opened, so a tree takes about as many jobs as it has levels, and the order is that of opening one leaf at a time. Gradients
are rounded to 1 / SCALE before they are summed: sums of integers don't depend on their order, so the same rows give the
same trees in any partitioning, and after lost tasks.

After each tree the margins move and are cached anew; every ``CUT_TREES`` trees they are written, so the lineage stays
short. The validation loss comes with the next tree's first wave: one fit with patience, without a job of its own.

NULL and NaN features go to the side of a cut that gains more. Rows with a NULL label are left out. Without training rows
the fit raises ``ValueError``; without validation rows all trees stay. An empty frame scores to an empty frame.
"""

from __future__ import annotations

import heapq
import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.config import FEATURE_COLUMNS, TARGET_COL, JobConfig
from scorewright.operators.model import class_weights, split_bucket
from scorewright.session import cut_lineage, drop_table

BINS = 255  # beside bin 0 for missing values
BLOCK_ROWS = 65_536
SCALE = float(2**20)
CUT_TREES = 25
MIN_HESSIAN = 1e-3
NODES = "tree int, node int, feature int, bin int, missing_left boolean, left int, right int, value double, gain double, n long"


@dataclass(frozen=True)
class BoostParams:
    n_trees: int = 500
    learning_rate: float = 0.05
    n_leaves: int = 63
    min_leaf_rows: int = 20
    l1: float = 0.1
    l2: float = 0.1
    feature_fraction: float = 0.8
    stopping_rounds: int = 50
    seed: int = 42

    @staticmethod
    def of(cfg: JobConfig) -> BoostParams:
        return BoostParams(n_trees=cfg.n_trees, learning_rate=cfg.learning_rate, stopping_rounds=cfg.stopping_rounds, seed=cfg.seed)


@dataclass
class Tree:
    """Nodes as parallel lists; ``feature`` is -1 in a leaf. Rows go left if their bin is at most ``bin``."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    n: list[int] = field(default_factory=list)

    def add(self, value: float, n: int) -> int:
        for column, x in zip((self.feature, self.bin, self.missing_left, self.left, self.right, self.value, self.gain, self.n), (-1, 0, False, -1, -1, value, 0.0, n)):
            column.append(x)
        return len(self.feature) - 1

    def split(self, node: int, cut: Cut, children: tuple[int, int]) -> None:
        self.feature[node], self.bin[node], self.missing_left[node] = cut.feature, cut.bin, cut.missing_left
        self.left[node], self.right[node] = children
        self.gain[node] = cut.gain

    def rows_of_leaves(self, bins: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, its rows) of the first ``n`` rows of a block."""
        todo = [(0, np.arange(n))]
        while todo:
            node, rows = todo.pop()
            f = self.feature[node]
            if f < 0:
                yield node, rows
                continue
            goes_left = np.arange(BINS + 1) <= self.bin[node]
            goes_left[0] = self.missing_left[node]
            side = goes_left[bins[f][rows]]
            todo += [(self.left[node], rows[side]), (self.right[node], rows[~side])]


@dataclass(frozen=True)
class Cut:
    """The best cut of a node; sums are of the rounded gradients, in units of 1 / SCALE."""

    gain: float
    feature: int
    bin: int
    missing_left: bool
    sums_left: tuple[int, int, int]
    sums: tuple[int, int, int]


# ---------------------------------------------------------------- cuts of a histogram


def _shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_value(sums: tuple[int, int, int], p: BoostParams) -> float:
    """The step of a leaf with these sums of gradients, Hessians and rows."""
    h = sums[1] / SCALE + p.l2
    return 0.0 if h <= 0 else float(-_shrunk(sums[0] / SCALE, p.l1) / h * p.learning_rate)


def best_cut(hist: np.ndarray, feature: int, p: BoostParams) -> Cut | None:
    """The best cut of one (node, feature) from its integer (bin, 3) histogram; ties go to the lower bin, and to missing
    values on the right."""
    total = hist.sum(axis=0)
    below = np.cumsum(hist[1:], axis=0)[:-1]  # bins 1..b, for each b but the last
    best = None
    for missing_left in (False, True):
        if missing_left and not hist[0, 2]:
            break
        left = below + hist[0] if missing_left else below
        if not missing_left and hist[0, 2]:
            left = np.vstack([left, left[-1:] + hist[-1:]]) if len(left) else hist[1:2]  # present values against missing ones
        if not len(left):
            continue
        gain = np.zeros(len(left))
        enough = np.ones(len(left), dtype=bool)
        for part in (left, total - left):
            h = part[:, 1] / SCALE
            gain += _shrunk(part[:, 0] / SCALE, p.l1) ** 2 / np.maximum(h + p.l2, 1e-12)
            enough &= (part[:, 2] >= p.min_leaf_rows) & (h >= MIN_HESSIAN)
        gain -= _shrunk(total[0] / SCALE, p.l1) ** 2 / max(total[1] / SCALE + p.l2, 1e-12)
        gain[~enough] = -np.inf
        at = int(np.argmax(gain))
        if gain[at] > 0 and (best is None or gain[at] > best.gain):
            ints = lambda x: tuple(int(v) for v in x)
            best = Cut(float(gain[at]), feature, at + 1, missing_left, ints(left[at]), ints(total))
    return best


# ---------------------------------------------------------------- rows in blocks


def _blocked(frame: DataFrame, features: list[str], edges: list[np.ndarray]) -> DataFrame:
    """Blocks of binned rows: training rows first, then validation rows; a byte a value, feature by feature."""

    def blocks(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield block(held)
                held, size = [], 0
        if size:
            yield block(held)

    def block(batches):
        t = pa.Table.from_batches(batches)
        is_val = t.column("is_val").to_numpy()
        order = np.argsort(is_val, kind="stable")
        y = t.column("y").to_numpy()[order].astype(np.uint8)
        bins = np.stack([binned(t.column(f).to_numpy(), e)[order] for f, e in zip(features, edges)])
        return pa.RecordBatch.from_pydict({
            "n_train": pa.array([int((~is_val).sum())], pa.int32()),
            **{k: pa.array([v.tobytes()], pa.binary()) for k, v in (("bins", bins), ("y", y), ("margin", np.zeros(len(y))))},
        })

    inputs = frame.select(
        (F.col("split") == "val").alias("is_val"), F.col(TARGET_COL).cast("int").alias("y"), *[F.col(f).cast("double").alias(f) for f in features]
    )
    return inputs.mapInArrow(blocks, "n_train int, bins binary, y binary, margin binary")


def binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """1 + the number of edges below a value; 0 for a missing one."""
    return np.where(np.isnan(values), 0, 1 + np.searchsorted(edges, values, side="left")).astype(np.uint8)


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for n_train, bins, y, margin in zip(*(batch.column(c).to_pylist() for c in ("n_train", "bins", "y", "margin"))):
        labels = np.frombuffer(y, np.uint8)
        yield n_train, np.frombuffer(bins, np.uint8).reshape(-1, len(labels)), labels, np.frombuffer(margin)


def bin_edges(train: DataFrame, features: list[str]) -> list[np.ndarray]:
    """Upper edges of all bins but the last, at most BINS - 1 a feature: values at evenly spaced ranks (one aggregate of
    mergeable quantile sketches)."""
    ranks = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    row = train.agg(*[F.percentile_approx(F.nanvl(F.col(f).cast("double"), F.lit(None)), ranks, 10_000).alias(f) for f in features]).first()
    return [np.unique(np.array(row[f] or [], dtype=np.float64)) for f in features]


def _moved(state: DataFrame, tree: Tree) -> DataFrame:
    """The blocks with a finished tree added to their margins."""

    def move(batches):
        for batch in batches:
            margins = []
            for _, bins, y, margin in _arrays(batch):
                out = margin.copy()
                for leaf, rows in tree.rows_of_leaves(bins, len(y)):
                    out[rows] += tree.value[leaf]
                margins.append(out.tobytes())
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margins, pa.binary()))

    return state.mapInArrow(move, state.schema)


def _wave(state: DataFrame, tree: Tree, nodes: list[int], features: list[int], sizes: list[int], by_class: np.ndarray, p: BoostParams, loss: bool) -> tuple[dict[int, Cut], tuple[int, int]]:
    """Best cut of each of the tree's leaves ``nodes``; with ``loss`` also the sum of the validation log losses (in units
    of 1 / SCALE) and the number of validation rows."""
    slot = {node: i for i, node in enumerate(nodes)}

    def sums(batches):
        totals = {f: np.zeros((3, len(nodes) * sizes[f]), np.int64) for f in features}
        lost = np.zeros(2, np.int64)
        for batch in batches:
            for n_train, bins, y, margin in _arrays(batch):
                if loss:
                    z = margin[n_train:]
                    lost += [int(np.rint((np.logaddexp(0.0, z) - z * y[n_train:]) * SCALE).sum()), len(z)]
                parts = [(slot[node], rows) for node, rows in tree.rows_of_leaves(bins, n_train) if node in slot]
                rows = np.concatenate([r for _, r in parts])
                at = np.repeat([s for s, _ in parts], [len(r) for _, r in parts])
                prob = 1.0 / (1.0 + np.exp(-margin[rows]))
                w = by_class[y[rows]]
                g = np.rint(w * (prob - y[rows]) * SCALE)
                h = np.rint(w * prob * (1.0 - prob) * SCALE)
                for f in features:
                    cell, size = at * sizes[f] + bins[f][rows], len(nodes) * sizes[f]
                    for i, x in enumerate((g, h, None)):
                        totals[f][i] += np.bincount(cell, x, size).astype(np.int64)
        found = [(i, f, totals[f].reshape(3, len(nodes), sizes[f])[:, i].T) for f in features for i in range(len(nodes))]
        found = [(i, f, x.tobytes()) for i, f, x in found if x[:, 2].any()] + ([(-1, -1, lost.tobytes())] if loss else [])
        if found:
            yield pa.RecordBatch.from_pylist([dict(zip(("slot", "feature", "sums"), r)) for r in found], schema=SUMS)

    def cuts(batches):
        merged: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, f, raw in zip(*(batch.column(c).to_pylist() for c in ("slot", "feature", "sums"))):
                x = np.frombuffer(raw, np.int64)
                merged[i, f] = merged[i, f] + x if (i, f) in merged else x
        out = []
        for (i, f), x in merged.items():
            if i < 0:
                out.append((i, f, 0.0, 0, False, [int(v) for v in x]))
            elif c := best_cut(x.reshape(-1, 3), f, p):
                out.append((i, f, c.gain, c.bin, c.missing_left, [*c.sums_left, *c.sums]))
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(CUTS.names, r)) for r in out], schema=CUTS)

    partial = state.mapInArrow(sums, "slot int, feature int, sums binary")
    rows = partial.repartition("slot", "feature").mapInArrow(cuts, "slot int, feature int, gain double, bin int, missing_left boolean, sums array<bigint>").collect()
    best: dict[int, Cut] = {}
    lost = (0, 0)
    for r in sorted(rows, key=lambda r: (r["slot"], r["feature"])):
        if r["slot"] < 0:
            lost = tuple(r["sums"])
            continue
        node = nodes[r["slot"]]
        if node not in best or r["gain"] > best[node].gain:
            best[node] = Cut(r["gain"], r["feature"], r["bin"], r["missing_left"], tuple(r["sums"][:3]), tuple(r["sums"][3:]))
    return best, lost


SUMS = pa.schema([("slot", pa.int32()), ("feature", pa.int32()), ("sums", pa.binary())])
CUTS = pa.schema(
    [("slot", pa.int32()), ("feature", pa.int32()), ("gain", pa.float64()), ("bin", pa.int32()), ("missing_left", pa.bool_()), ("sums", pa.list_(pa.int64()))]
)


# ---------------------------------------------------------------- trees


def _grown(state: DataFrame, features: list[int], sizes: list[int], by_class: np.ndarray, p: BoostParams, loss: bool) -> tuple[Tree, tuple[int, int]]:
    """One tree. ``ahead`` holds every cut found so far; at the end those stay that are taken in order of gain.

    A leaf is reached once all cuts above it are taken, so its rank follows from the least gain on its path. Leaves beyond
    rank ``n_leaves`` - 1 among the known ones can't be taken any more; a wave opens all others at once."""
    ahead = Tree()
    ahead.add(0.0, 0)
    cut, lost = _wave(state, ahead, [0], features, sizes, by_class, p, loss)
    reach = {node: c.gain for node, c in cut.items()}  # least gain on the path
    while True:
        bound = sorted(reach.values(), reverse=True)[: p.n_leaves - 1][-1] if reach else 0.0
        opened = [node for node, gain in reach.items() if gain >= bound and ahead.feature[node] < 0]
        if not opened:
            return _kept(ahead, _in_order(ahead, cut, p.n_leaves)), lost
        above = {child: reach[node] for node in opened for child in _opened(ahead, node, cut[node], p)}
        new = [node for node in above if ahead.n[node] >= 2 * p.min_leaf_rows]
        found = _wave(state, ahead, new, features, sizes, by_class, p, False)[0] if new else {}
        cut |= found
        reach |= {node: min(above[node], c.gain) for node, c in found.items()}


def _in_order(ahead: Tree, cut: dict[int, Cut], n_leaves: int) -> set[int]:
    """The cuts taken when the leaf of most gain is opened next, until there are ``n_leaves``."""
    taken: set[int] = set()
    heap = [(-cut[0].gain, 0)] if 0 in cut else []
    while heap and len(taken) < n_leaves - 1:
        _, node = heapq.heappop(heap)
        taken.add(node)
        for child in (ahead.left[node], ahead.right[node]):
            if child in cut:
                heapq.heappush(heap, (-cut[child].gain, child))
    return taken


def _opened(tree: Tree, node: int, c: Cut, p: BoostParams) -> list[int]:
    rest = tuple(a - b for a, b in zip(c.sums, c.sums_left))
    children = tuple(tree.add(leaf_value(s, p), s[2]) for s in (c.sums_left, rest))
    if node == 0:
        tree.n[0], tree.value[0] = c.sums[2], leaf_value(c.sums, p)
    tree.split(node, c, children)
    return list(children)


def _kept(ahead: Tree, taken: set[int]) -> Tree:
    """The part of ``ahead`` whose cuts were taken, numbered from the root, left before right."""
    out = Tree()

    def copy(node: int) -> int:
        at = out.add(ahead.value[node], ahead.n[node])
        if node in taken:
            out.feature[at], out.bin[at], out.missing_left[at], out.gain[at] = ahead.feature[node], ahead.bin[node], ahead.missing_left[node], ahead.gain[node]
            out.left[at], out.right[at] = copy(ahead.left[node]), copy(ahead.right[node])
        return at

    copy(0)
    return out


@dataclass
class BoostedTrees:
    """A fitted ensemble: the trees, the bin edges of each feature, and the validation loss after each round."""

    features: list[str]
    edges: list[np.ndarray]
    trees: list[Tree]
    losses: list[float]

    def score(self, frame: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` columns and the probability ``p`` of the positive class."""
        shared = frame.sparkSession.sparkContext.broadcast((self.features, self.edges, self.trees))  # at most trees x 2 leaves nodes

        def scores(batches):
            features, edges, trees = shared.value
            for batch in batches:
                bins = np.stack([binned(batch.column(f"f{i}").to_numpy(zero_copy_only=False), e) for i, e in enumerate(edges)])
                margin = np.zeros(batch.num_rows)
                for tree in trees:
                    for leaf, rows in tree.rows_of_leaves(bins, batch.num_rows):
                        margin[rows] += tree.value[leaf]
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(1.0 / (1.0 + np.exp(-margin)))], names=[*keep, "p"])

        inputs = frame.select(*keep, *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(self.features)])
        fields = ", ".join(f"`{k}` {frame.schema[k].dataType.simpleString()}" for k in keep)
        return inputs.mapInArrow(scores, f"{fields}, p double")

    def importances(self, top: int = 15) -> list[tuple[str, int]]:
        """The features most often cut at, with their number of cuts; ties in the order of features."""
        counts = np.bincount([f for t in self.trees for f in t.feature if f >= 0], minlength=len(self.features))
        return sorted(zip(self.features, counts.tolist()), key=lambda kv: -kv[1])[:top]

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row a node."""
        return spark.createDataFrame([(i, j, *r) for i, t in enumerate(self.trees) for j, r in enumerate(
            zip(t.feature, t.bin, t.missing_left, t.left, t.right, t.value, t.gain, t.n))], NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        rows = [(i, f, e.tolist()) for i, (f, e) in enumerate(zip(self.features, self.edges))]
        spark.createDataFrame(rows, "at int, feature string, edges array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        named = spark.read.parquet(f"{path}/features").orderBy("at").collect()
        trees: list[Tree] = []
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            if r["node"] == 0:
                trees.append(Tree())
            t = trees[-1]
            at = t.add(r["value"], r["n"])
            t.feature[at], t.bin[at], t.missing_left[at], t.gain[at] = r["feature"], r["bin"], r["missing_left"], r["gain"]
            t.left[at], t.right[at] = r["left"], r["right"]
        return BoostedTrees([r["feature"] for r in named], [np.array(r["edges"]) for r in named], trees, [])


def fit(train_val: DataFrame, weights: dict[int, float], p: BoostParams = BoostParams(), features: list[str] = FEATURE_COLUMNS) -> BoostedTrees:
    """Trees up to the round of least validation log loss, after which ``p.stopping_rounds`` rounds brought no gain.

    ``weights`` of the classes count in training and not in the validation loss."""
    spark = train_val.sparkSession
    rows = train_val.where(F.col(TARGET_COL).isNotNull())
    edges = bin_edges(rows.where(F.col("split") == "train"), features)
    sizes = [len(e) + 2 for e in edges]
    written = state = cut_lineage(_blocked(rows, features, edges), "boosting_blocks")
    if not state.where(F.col("n_train") > 0).limit(1).count():
        raise ValueError("no training rows")
    by_class = np.array([weights.get(0, 1.0), weights.get(1, 1.0)])
    trees: list[Tree] = []
    losses: list[float] = []
    best, cached = 0, []
    for t in range(p.n_trees + 1):
        drawn = sorted(random.Random(f"{p.seed}-{t}").sample(range(len(features)), max(1, round(p.feature_fraction * len(features)))))
        if t < p.n_trees:
            tree, (lost, n) = _grown(state, drawn, sizes, by_class, p, True)
        else:
            root = Tree()
            root.add(0.0, 0)
            lost, n = _wave(state, root, [0], drawn, sizes, by_class, p, True)[1]
        for older in cached[:-1]:  # the newest margins are cached by now
            older.unpersist()
        cached = cached[-1:]
        if t and n:
            losses.append(lost / SCALE / n)
            if losses[-1] < losses[best]:
                best = t - 1
            elif t - 1 - best >= p.stopping_rounds:
                break
        if t == p.n_trees:
            break
        trees.append(tree)
        state = _moved(state, tree)
        if len(trees) % CUT_TREES:
            cached.append(state.persist())
        else:
            before, written = written, cut_lineage(state, "boosting_blocks")
            state = written
            for older in cached:
                older.unpersist()
            cached = []
            drop_table(before)
    for older in cached:
        older.unpersist()
    drop_table(written)
    return BoostedTrees(list(features), edges, trees[: best + 1] if losses else trees, losses)


def train(train_val: DataFrame, cfg: JobConfig = JobConfig()) -> BoostedTrees:
    """``fit`` with the job's parameters, balanced class weights and its bound on the rows of the fit."""
    if cfg.max_training_rows is not None:
        n = max(train_val.count(), 1)
        train_val = train_val.filter(split_bucket(seed=cfg.seed + 1) < cfg.max_training_rows / n)
    rows = class_weights(train_val.filter((F.col("split") == "train") & F.col(TARGET_COL).isNotNull())).collect()  # a row a class
    return fit(train_val, {int(r[TARGET_COL]): r["weight"] for r in rows}, BoostParams.of(cfg))
