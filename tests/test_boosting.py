"""The leaf-wise booster against a plain one, and what must not change it."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripcast.operators import leafwise as LW

FEATURES = ["a", "b", "c"]
PLAIN = {"num_leaves": 6, "max_bin": 63, "min_data_in_leaf": 15, "feature_fraction": 1.0, "bagging_fraction": 1.0,
         "lambda_l1": 0.5, "lambda_l2": 2.0, "stepSize": 0.3}


def invented(n: int = 600, seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"a": rng.integers(0, 12, n).astype(float), "b": np.round(rng.normal(size=n), 1), "c": rng.integers(0, 2, n).astype(float)})
    pdf["label"] = np.sin(pdf["a"]) + (pdf["b"] > 0.3) * pdf["c"] + rng.normal(scale=0.1, size=n)
    pdf["draw"] = rng.integers(0, 2**31, n)
    pdf["grp"] = rng.integers(0, 4, n)
    return pdf


def plain_tree(x: np.ndarray, g: np.ndarray, p: dict) -> list[tuple]:
    """Splits in order (node, feature, threshold, rows), one leaf at a time, from all values."""
    def worth(part: np.ndarray) -> float:
        return max(abs(part.sum()) - p["lambda_l1"], 0.0) ** 2 / (len(part) + p["lambda_l2"])

    leaves, out = {0: np.arange(len(g))}, []
    while len(leaves) < p["num_leaves"]:
        best = None
        for node, rows in sorted(leaves.items()):
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    left = x[rows, f] <= cut
                    if min(left.sum(), (~left).sum()) < p["min_data_in_leaf"]:
                        continue
                    gain = worth(g[rows[left]]) + worth(g[rows[~left]]) - worth(g[rows])
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, node, f, cut)
        if best is None:
            break
        _, node, f, cut = best
        rows = leaves.pop(node)
        out.append((node, f, float(cut), len(rows)))
        left = x[rows, f] <= cut
        leaves[2 * len(out) - 1], leaves[2 * len(out)] = rows[left], rows[~left]
    return out


@pytest.fixture(scope="module")
def table(spark):
    return invented()


@pytest.mark.parametrize("local", [0, 100, 1 << 14])
def test_first_tree_is_that_of_a_plain_search(spark, table, monkeypatch, local):
    monkeypatch.setattr(LW, "LOCAL_ROWS", local)
    model = LW.fit(spark.createDataFrame(table), PLAIN, 1, FEATURES)
    x = table[FEATURES].to_numpy()
    g = np.rint((table["label"] - model.getOrDefault(model.base)) * 65536).to_numpy() / 65536
    want = plain_tree(x, g, PLAIN)
    nodes = model.node_rows()
    split = nodes[nodes["feature"] >= 0].sort_values("left")
    assert [(int(r.node), int(r.feature), float(r.threshold), int(r.n)) for r in split.itertuples()] == want
    for r in nodes[nodes["feature"] < 0].itertuples():
        rows = x[model.trees[0].leaf(x, model.trees[0].threshold) == r.node]
        own = g[model.trees[0].leaf(x, model.trees[0].threshold) == r.node]
        assert len(rows) == r.n >= PLAIN["min_data_in_leaf"]
        total = np.sign(own.sum()) * max(abs(own.sum()) - 0.5, 0)
        assert r.value == pytest.approx(0.3 * total / (len(own) + 2.0))


def test_leaves_and_penalties(spark, table):
    df = spark.createDataFrame(table)
    few, many = (LW.fit(df, {**PLAIN, "num_leaves": n, "min_data_in_leaf": 5}, 1, FEATURES) for n in (4, 20))
    assert (few.node_rows()["feature"] < 0).sum() == 4 and 4 < (many.node_rows()["feature"] < 0).sum() <= 20
    for name in ("lambda_l1", "lambda_l2"):
        other = LW.fit(df, {**PLAIN, name: 40.0}, 1, FEATURES)
        assert np.abs(other.node_rows()["value"]).max() < np.abs(LW.fit(df, PLAIN, 1, FEATURES).node_rows()["value"]).max()


def test_trees_do_not_depend_on_partitions(spark, table):
    p = {**PLAIN, "bagging_fraction": 0.7, "feature_fraction": 0.6}
    one, many = (LW.fit(spark.createDataFrame(table).repartition(n), p, 3, FEATURES) for n in (1, 7))
    assert one.node_rows().equals(many.node_rows())
    assert one.trees[0].n[0] not in (0, len(table)) and one.trees[0].n[0] != one.trees[1].n[0]    # another bag each


def test_saved_loaded_and_continued_equals_one_run(spark, table, tmp_dir):
    df = spark.createDataFrame(table)
    p = {**PLAIN, "bagging_fraction": 0.8, "feature_fraction": 0.7}
    whole = LW.fit_incremental(df, "grp", p, 2, features=FEATURES)
    assert len(whole.trees) == 8
    LW.fit_incremental(df.filter("grp < 3"), "grp", p, 2, features=FEATURES).save(f"{tmp_dir}/m")
    loaded = LW.BoostedTrees.load(f"{tmp_dir}/m")
    assert len(loaded.trees) == 6
    continued = LW.fit_incremental(df.filter("grp = 3"), "grp", p, 2, start=loaded, features=FEATURES)
    assert continued.node_rows().equals(whole.node_rows())
    assert len(loaded.trees) == 6       # the model gone on from stays as it was
    a, b = (m.transform(df).select("log_correction").toPandas()["log_correction"] for m in (whole, continued))
    assert a.equals(b) and ((table["label"] - a) ** 2).mean() < table["label"].var()


def test_losses_of_every_prefix(spark, table):
    df = spark.createDataFrame(table)
    model = LW.fit(df, PLAIN, 4, FEATURES)
    best, losses = LW.best_prefix(model, df)
    for n, loss in enumerate(losses, 1):
        own = model.first_trees(n).transform(df).agg(F.avg(F.pow(F.col("label") - F.col("log_correction"), 2))).first()[0]
        assert loss == pytest.approx(own)
    assert losses == sorted(losses, reverse=True) and best == 4


def test_missing_values_and_odd_tables(spark):
    rows = [(None if i % 3 == 0 else float("nan") if i % 3 == 1 else float(i % 7), 1.0, float(i % 3 == 2), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, label double, draw long")
    model = LW.fit(df, PLAIN, 1, ["a", "b"])
    out = model.transform(df).groupBy("label").agg(F.count_distinct("log_correction").alias("k"), F.avg("log_correction").alias("p"))
    found = {r["label"]: r["p"] for r in out.collect()}
    assert found[1.0] > found[0.0]      # missing values went one way, numbers the other
    for odd in (df.filter("draw < 0"), df.filter("draw < 3"), df.withColumn("label", F.lit(None).cast("double"))):
        nothing = LW.fit(odd, PLAIN, 2, ["a", "b"])
        assert all(len(t.left) == 1 for t in nothing.trees) and nothing.transform(df).count() == 300


def test_a_pass_reads_blocks_not_rows(spark, table):
    """What grows with the rows is numpy's work, not rows handed to Python and shuffled."""
    df = spark.createDataFrame(table).repartition(3)
    edges = LW.bin_edges(df, FEATURES, 63)
    rows = LW.binned(df, LW.BoostedTrees(FEATURES), edges, "label", "draw")
    assert rows.count() <= 3
    held = rows.toArrow().to_batches()
    assert sum(len(b.label) for b in LW.blocks_of(held, len(FEATURES))) == len(table)
    for block in LW.blocks_of(held, len(FEATURES)):
        assert block.bins.shape == (len(FEATURES), len(block.label)) and np.isin(block.draw, table["draw"]).all()


def test_edges_of_odd_values(spark):
    odd = [None, float("nan"), 0.0, 1.0, 1.0, 7.5, -3.0]
    df = spark.createDataFrame([(x, 2.0, float(i), None) for i, x in enumerate(odd * 9)], "a double, b double, c double, d double")
    edges = LW.bin_edges(df, ["a", "b", "c", "d"], 4)
    assert [list(e) for e in edges[:2]] == [[-3.0, 0.0, 1.0], []] and list(edges[3]) == []
    assert list(edges[2]) == [15.0, 31.0, 47.0]
    some = spark.createDataFrame([(float(i),) for i in range(10)] + [(None,)] * 10, "a double")
    assert list(LW.bin_edges(some.dropna(), ["a"], 2)[0]) == [4.0] and not list(LW.bin_edges(some, ["a"], 2)[0])
    assert not list(LW.bin_edges(df.withColumn("a", F.lit(float("inf"))), ["a"], 4)[0])


def test_growth_here_is_that_of_a_plain_search(table):
    x = table[FEATURES].to_numpy()
    cuts = [np.unique(c) for c in x.T]
    columns = np.stack([np.searchsorted(e, c) for e, c in zip(cuts, x.T, strict=True)]).astype(np.uint8)
    g = np.rint(table["label"].to_numpy() * 65536)
    found = LW.grow_here(columns, g, [0, 1, 2], 64, PLAIN, PLAIN["num_leaves"] - 1)
    want = plain_tree(x, g / 65536, PLAIN)
    assert [(at, f, cuts[f][b]) for at, f, b, *_, child in found if child > 0] == [(node, f, cut) for node, f, cut, _ in want]


def test_of_two_children_the_smaller_is_counted(spark, table, monkeypatch):
    passes, plain = [], LW.node_sums

    def counting(rows, tree, wanted, bag, n_bins):
        passes.append([int(tree.n[w]) for w in wanted])
        return plain(rows, tree, wanted, bag, n_bins)

    monkeypatch.setattr(LW, "LOCAL_ROWS", 0)
    monkeypatch.setattr(LW, "node_sums", counting)
    LW.fit(spark.createDataFrame(table), {**PLAIN, "num_leaves": 12, "min_data_in_leaf": 5}, 1, FEATURES)
    assert len(passes) > 2 and all(sum(sizes) <= len(table) / 2 for sizes in passes[1:])


def test_a_pass_reads_the_bag_alone(spark, table):
    """Bins of the tree's features and gradients of the rows drawn, nothing else."""
    df, bag = spark.createDataFrame(table).repartition(3), LW.Bag(1, [0, 2], 0.5)
    edges = LW.bin_edges(df, FEATURES, 63)
    held = LW.binned(df, LW.BoostedTrees(FEATURES), edges, "label", "draw", bag).toArrow().to_batches()
    n = 0
    for columns, g in LW.bags_of(held, bag):
        n += len(g)
        assert sorted(columns) == [0, 2] and all(len(c) == len(g) for c in columns.values())
    assert n == LW.drawn(table["draw"].to_numpy(), 1, 0.5).sum() < len(table)


def test_candidates_share_the_binned_rows(spark, monkeypatch):
    from tripcast import schema as S

    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({c: rng.integers(0, 9, 400).astype(float) for c in S.FEATURE_COLUMNS})
    pdf["label"], pdf["draw"] = np.sin(pdf["trip_distance"]), rng.integers(0, 2**31, 400)
    df, made, plain = spark.createDataFrame(pdf), [], LW.binned
    monkeypatch.setattr(LW, "binned", lambda *a, **k: made.append(1) or plain(*a, **k))
    grid = [{"stepSize": r, "num_leaves": n, "min_data_in_leaf": 10} for r in (0.1, 0.3) for n in (3, 6)] + [
        {"stepSize": 0.3, "num_leaves": 6, "min_data_in_leaf": 10, "max_bin": 4}]
    models = []
    runs = LW.grid_search(df, df, grid, lambda m: models.append(m) or {"id": id(m)}, 2)
    assert len(made) == 2       # one for each number of bins
    for run, params in zip(runs, grid, strict=True):
        alone = LW.fit(df, params, 2)
        assert next(m for m in models if id(m) == run["id"]).node_rows().equals(alone.first_trees(run["best_iteration"]).node_rows())


def test_rows_go_to_python_twice_before_the_first_tree(spark, table, monkeypatch):
    """For the counts of cells and for the bins; the ranges are found without."""
    df, made = spark.createDataFrame(table), []
    plain = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: made.append(1) or plain(self, *a, **k))
    ready = LW.prepare(df, {**LW.DEFAULT_PARAMS, **PLAIN}, FEATURES)
    assert len(made) == 2 and spark.read.schema(LW.BINNED).parquet(ready.first).count() > 0


def test_whole_numbers_are_those_of_round(spark):
    odd = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 1e15 + 0.5, 4503599627370497.5, -7.2, 3.0, 1e17, None]
    rows = spark.createDataFrame([(x,) for x in odd], "x double").select(LW.whole(F.col("x")).alias("a"), F.round("x").cast("long").alias("b"))
    assert rows.filter("not a <=> b").collect() == []


def test_losses_of_candidates_take_one_pass(spark, table, monkeypatch):
    df, made = spark.createDataFrame(table), []
    models = [LW.fit(df, {**PLAIN, "num_leaves": n}, 2, FEATURES) for n in (3, 6)]
    want = [LW.losses(m, df) for m in models]
    plain = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: made.append(1) or plain(self, *a, **k))
    assert [pytest.approx(own) for own in want] == LW.losses_of(models, df) and len(made) == 1
