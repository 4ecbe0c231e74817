"""The queries named ``tree_*`` grow whole ensembles, and equal candidates are
told apart by their number alone."""

from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from tripcast.operators import aggregates as A
from tripcast.operators import hybrid as H
from tripcast.operators import leafwise as LW
from tripcast.plans import oracles_trees as OT
from tripcast.plans import queries_models as QM

SF = "/root/testdata/sf0.001"
GRID = {127: 40, 255: 40}        # leaves: trees


@pytest.mark.parametrize("name, trees", [("tree_grid", [GRID]), ("tree_predict", [{255: 20}]), ("tree_metrics", [{255: 20}]),
                                         ("tree_training_run", [{**GRID, n: GRID[n] + 20} for n in GRID])])
def test_whole_ensembles_are_grown(spark, monkeypatch, name, trees):
    grown = []

    def stump(rows, bag, edges, p):
        grown.append(p["num_leaves"])
        return LW.as_tree([LW.Node(g=65536, n=1, known=True)], edges, p)

    monkeypatch.setattr(QM, "_FITTED", {})
    monkeypatch.setattr(LW, "grow", stump)
    E.queries()[name](spark, SF).collect()
    assert dict(Counter(grown)) in trees


def test_sql_takes_the_splits_in_order():
    """A few odd rows of one feature, with more splits than leaves: the SQL's tree is that of ``grow_here``."""
    rng = np.random.default_rng(5)
    n = 4000
    x, label = rng.integers(0, 40, n).astype(float), rng.normal(size=n) * rng.integers(1, 9, n)
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t AS SELECT unnest({list(range(n))}) AS r, unnest({x.tolist()}) AS x, unnest({label.tolist()}) AS label")
    features = ", ".join(f"x AS {c}" for c in OT.S.FEATURE_COLUMNS if c != "pickup_year")
    mx = f"""WITH RECURSIVE mx AS MATERIALIZED (SELECT r, label, r * 7 AS draw, 100.0 AS trip_duration, 90.0 AS baseline, {features},
        2000 - r % 2 AS pickup_year FROM t), vals AS (SELECT r, unnest(range({OT.N})) AS f,
        unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in OT.S.FEATURE_COLUMNS)}]) AS x FROM mx)"""
    sql = mx + OT.boosted("a", "true", "SELECT 0 AS run, 0.1 AS rate, 7 AS leaves") + " SELECT r, score FROM alast ORDER BY r"
    got = con.execute(sql).df()["score"].to_numpy()

    p = {**LW.DEFAULT_PARAMS, "num_leaves": 7}
    values = np.unique(x)
    columns = np.stack([np.searchsorted(values, x)] * OT.N).astype(np.uint8)
    year = OT.S.FEATURE_COLUMNS.index("pickup_year")
    columns[year] = 1 - np.arange(n) % 2
    score = np.full(n, np.sum(np.copysign(np.floor(np.abs(label * 65536) + 0.5), label)) / n / 65536)
    for t in range(OT.ROUNDS):
        own = LW.features_of(t, OT.N, p["feature_fraction"], 42)
        rows = np.flatnonzero(LW.drawn(np.arange(n) * 7, t, p["bagging_fraction"]))
        g = np.rint((label - score) * LW.SCALE)
        root = LW.Node(int(g[rows].sum()), len(rows))
        found = LW.grow_here(columns[own][:, rows], g[rows], own, len(values), p, p["num_leaves"] - 1)
        LW.attach(root, LW.pd.DataFrame(found, columns=["id", "feature", "bin", "gain", "left_g", "left_n", "children"]))
        tree = LW.as_tree(LW.replay(root, p["num_leaves"])[0], [values] * OT.N, p)
        assert (tree.left != np.arange(len(tree.left))).sum() == 6
        score = score + tree.value[tree.leaf(columns.T, tree.bin)]
    assert np.allclose(got, score, rtol=0, atol=1e-9)


def test_equal_candidates_tie(spark):
    runs = spark.createDataFrame([(0, 2.0 + 1e-13), (1, 2.0), (2, 3.0)], "run_no int, rmse double")
    assert A.best_run(runs, digits=H.METRIC_DIGITS).first()["run_no"] == 0
    assert A.best_run(runs).first()["run_no"] == 1
