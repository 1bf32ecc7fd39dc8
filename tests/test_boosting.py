"""Histogram boosting against a booster in plain Python that opens one leaf at a time and sums row by row."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.config import ID_COL, TARGET_COL
from scorewright.operators import boosting as B

FEATURES = ["a", "b", "c", "d", "e"]
PARAMS = B.BoostParams(n_trees=6, learning_rate=0.3, n_leaves=9, min_leaf_rows=5, stopping_rounds=50, feature_fraction=0.8, seed=3)


def rows(n=900, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.random() * 10, float(rng.randrange(6))
        c = None if rng.random() < 0.3 else rng.gauss(0, 1)
        d = float("nan") if rng.random() < 0.1 else float(rng.randrange(2))
        y = int((a > 6) != (b in (2, 3)) or (c is None and rng.random() < 0.7) or rng.random() < 0.1)
        out.append((f"k{i}", y, "val" if i % 5 == 0 else "train", a, b, c, d, 7.0))
    return out


def frame(spark, data, parts=3):
    schema = f"{ID_COL} string, {TARGET_COL} int, split string, " + ", ".join(f"{f} double" for f in FEATURES)
    return spark.createDataFrame(data, schema).repartition(parts)


def plain(data, weights, edges, p):
    """Node lists of each tree and the validation losses: leaves opened one at a time, every cut summed anew."""
    missing = lambda v: v is None or v != v
    bins = [[0 if missing(v) else 1 + sum(e < v for e in es) for v, es in zip(r[3:], edges)] for r in data]
    train = [i for i, r in enumerate(data) if r[2] == "train"]
    val = [i for i, r in enumerate(data) if r[2] == "val"]
    margin = [0.0] * len(data)
    shrunk = lambda g: np.sign(g) * max(abs(g) - p.l1, 0.0)
    trees, losses = [], []
    for t in range(p.n_trees):
        drawn = sorted(random.Random(f"{p.seed}-{t}").sample(range(len(FEATURES)), max(1, round(p.feature_fraction * len(FEATURES)))))
        g, h = {}, {}
        for i in train:
            q, w = 1.0 / (1.0 + float(np.exp(-margin[i]))), weights[data[i][1]]
            g[i], h[i] = round(w * (q - data[i][1]) * B.SCALE), round(w * q * (1.0 - q) * B.SCALE)

        def term(part):
            return shrunk(sum(g[i] for i in part) / B.SCALE) ** 2 / (sum(h[i] for i in part) / B.SCALE + p.l2)

        def cut(part):
            best = None
            for f in drawn:
                for missing_left in (False, True):
                    if missing_left and all(bins[i][f] for i in part):
                        continue
                    for b in range(1, len(edges[f]) + 2):
                        left = [i for i in part if (bins[i][f] <= b and bins[i][f]) or (not bins[i][f] and missing_left)]
                        right = [i for i in part if i not in set(left)]
                        if min(len(left), len(right)) < p.min_leaf_rows or (missing_left and b > len(edges[f])):
                            continue
                        gain = term(left) + term(right) - term(part)
                        if gain > 0 and (best is None or gain > best[0] + 1e-12):
                            best = (gain, f, b, missing_left, left, right)
            return best

        leaves, cuts = {(): train}, {(): cut(train)}
        taken = {}
        while len(leaves) < p.n_leaves and any(cuts.get(k) for k in leaves):
            k = max((k for k in leaves if cuts[k]), key=lambda k: cuts[k][0])
            taken[k] = cuts[k][1:4]
            for side, part in zip("lr", cuts[k][4:]):
                leaves[k + (side,)], cuts[k + (side,)] = part, cut(part)
            del leaves[k]
        values = {k: -shrunk(sum(g[i] for i in v) / B.SCALE) / (sum(h[i] for i in v) / B.SCALE + p.l2) * p.learning_rate for k, v in leaves.items()}
        for i in range(len(data)):
            k = ()
            while k in taken:
                f, b, missing_left = taken[k]
                k += ("l" if (bins[i][f] <= b if bins[i][f] else missing_left) else "r",)
            margin[i] += values[k]
        trees.append((taken, values))
        losses.append(sum(float(np.logaddexp(0.0, margin[i])) - margin[i] * data[i][1] for i in val) / len(val))
    return trees, losses, margin


def paths(tree):
    """(cuts by path, leaf values by path) of a fitted tree."""
    taken, values, todo = {}, {}, [((), 0)]
    while todo:
        k, i = todo.pop()
        if tree.feature[i] < 0:
            values[k] = tree.value[i]
            continue
        taken[k] = (tree.feature[i], tree.bin[i], tree.missing_left[i])
        todo += [(k + ("l",), tree.left[i]), (k + ("r",), tree.right[i])]
    return taken, values


@pytest.fixture
def few_bins(monkeypatch):
    monkeypatch.setattr(B, "BINS", 12)
    monkeypatch.setattr(B, "CUT_TREES", 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 200)


def test_trees_equal_a_plain_booster(spark, few_bins, tmp_path):
    data = rows(400)
    weights = {0: 0.8, 1: 1.3}
    model = B.fit(frame(spark, data), weights, PARAMS, FEATURES)
    trees, losses, margin = plain(data, weights, [e.tolist() for e in model.edges], PARAMS)
    np.testing.assert_allclose(model.losses, losses, atol=1e-5)
    assert len(model.trees) == int(np.argmin(losses)) + 1
    for ours, (taken, values) in zip(model.trees, trees):
        got, got_values = paths(ours)
        assert got == taken
        assert {k: pytest.approx(v, abs=1e-9) for k, v in values.items()} == got_values
    if len(model.trees) == PARAMS.n_trees:
        scored = {r[ID_COL]: r["p"] for r in model.score(frame(spark, data), [ID_COL]).collect()}
        np.testing.assert_allclose([scored[r[0]] for r in data], 1 / (1 + np.exp(-np.array(margin))), atol=1e-9)
    model.save(spark, str(tmp_path / "m"))
    again = B.BoostedTrees.load(spark, str(tmp_path / "m"))
    assert again.trees == model.trees and again.importances() == model.importances()
    assert again.score(frame(spark, data), [ID_COL]).exceptAll(model.score(frame(spark, data), [ID_COL])).isEmpty()


def test_trees_do_not_depend_on_the_partitioning(spark):
    data = rows(3000)
    p = B.BoostParams(n_trees=3, n_leaves=31, learning_rate=0.1)
    one, many = (B.fit(frame(spark, data, n), {}, p, FEATURES) for n in (1, 9))
    assert one.trees == many.trees and one.losses == many.losses
    assert all(n >= 20 for t in one.trees for n, f in zip(t.n, t.feature) if f < 0) and max(len(t.n) for t in one.trees) <= 61


def test_patience_and_files(spark):
    from scorewright.session import checkpoint_dir
    import glob

    data = [(k, random.Random(k).randrange(2), *rest) for k, _, *rest in rows(500)]
    p = B.BoostParams(n_trees=60, learning_rate=1.0, stopping_rounds=3)
    model = B.fit(frame(spark, data), {}, p, FEATURES)
    assert len(model.losses) == len(model.trees) + 3 < 60
    assert not glob.glob(checkpoint_dir(spark).split(":", 1)[-1] + "/tables/boosting_blocks*/*.parquet")


def test_the_job_s_parameters_and_class_weights(spark):
    from scorewright.config import FEATURE_COLUMNS, JobConfig

    data = frame(spark, rows(300)).withColumnsRenamed(dict(zip(FEATURES, FEATURE_COLUMNS)))
    data = data.select("*", *[F.lit(None).cast("double").alias(c) for c in FEATURE_COLUMNS[len(FEATURES):]])
    cfg = JobConfig(n_trees=2, learning_rate=0.2)
    counts = {r[0]: r[1] for r in data.where("split = 'train'").groupBy(TARGET_COL).count().collect()}
    weights = {k: sum(counts.values()) / (2 * n) for k, n in counts.items()}
    assert B.train(data, cfg).trees == B.fit(data, weights, B.BoostParams.of(cfg)).trees
    assert B.BoostParams.of(JobConfig()) == B.BoostParams(500, 0.05, 63, 20, 0.1, 0.1, 0.8, 50, 42)


def test_edges(spark):
    p = B.BoostParams(n_trees=2, min_leaf_rows=1)
    with pytest.raises(ValueError):
        B.fit(frame(spark, rows(20)).limit(0), {}, p, FEATURES)
    one_class = B.fit(frame(spark, [(*r[:1], 1, *r[2:]) for r in rows(60)]), {}, p, FEATURES)
    no_val = B.fit(frame(spark, [(*r[:2], "train", *r[3:]) for r in rows(60)]), {}, p, FEATURES)
    assert len(no_val.trees) == 2 and no_val.losses == []
    blank = [("n", None, "train", *[None] * 5), *rows(60)]
    with_blank = B.fit(frame(spark, blank), {}, p, FEATURES)  # a row without label is left out
    assert with_blank.trees == B.fit(frame(spark, rows(60)), {}, p, FEATURES).trees
    assert one_class.score(frame(spark, blank).limit(0), [ID_COL]).count() == 0
    assert one_class.score(frame(spark, blank), [ID_COL]).where(F.col("p").between(0, 1)).count() == 61
