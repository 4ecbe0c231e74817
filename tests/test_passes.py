"""What the booster's passes over the rows cost, and that they still add up."""

import numpy as np
import pytest

import __spark_entry__ as E
from tests.test_boosting import FEATURES, PLAIN, invented
from tripcast.operators import leafwise as LW
from tripcast.plans import queries_models as QM

SF = "/root/testdata/sf0.001"


def test_both_kinds_of_nodes_take_one_pass(spark, monkeypatch):
    df, passes, plain = spark.createDataFrame(invented()), [], LW.one_pass
    params = {**PLAIN, "num_leaves": 20, "min_data_in_leaf": 5}

    def seen(rows, tree, counted, few, *more):
        passes.append((list(counted), list(few)))
        return plain(rows, tree, counted, few, *more)

    monkeypatch.setattr(LW, "one_pass", seen)
    monkeypatch.setattr(LW, "LOCAL_ROWS", 0)
    want = LW.fit(df, params, 2, FEATURES).node_rows()
    assert all(not few for _, few in passes)
    passes.clear()
    monkeypatch.setattr(LW, "LOCAL_ROWS", 200)
    assert LW.fit(df, params, 2, FEATURES).node_rows().equals(want)
    assert any(counted and few for counted, few in passes)
    assert any(set(counted) & set(few) for counted, few in passes)      # a small child is counted for its sibling too


@pytest.mark.parametrize("scale", [1.0, 2.0**16, 2.0**30, 2.0**36])
@pytest.mark.parametrize("n", [0, 1, 500, 9000, 150000])
def test_counts_of_both_kinds_are_exact(n, scale):
    rng = np.random.default_rng(n)
    columns = rng.integers(0, 63, (5, n)).astype(np.uint8)
    g = np.rint(rng.normal(size=n) * scale)
    g_sum, n_sum = LW.histograms(columns, g, 63)
    for f in range(5):
        for b in (0, 7, 62):
            here = columns[f] == b
            assert n_sum[f, b] == here.sum() and g_sum[f, b] == sum(int(x) for x in g[here])


def test_most_bins_that_fit_in_a_byte():
    columns = np.array([[255, 0, 255, 3], [255, 255, 0, 3]] * 1, np.uint8).repeat(20000, axis=1)
    g_sum, n_sum = LW.histograms(columns, np.ones(80000), 256)
    assert n_sum[0, 255] == g_sum[0, 255] == 40000 and n_sum[1, 3] == 20000 and n_sum.sum() == 160000


def test_blocks_are_packed(spark):
    table = invented(5000)
    df = spark.createDataFrame(table).coalesce(1)
    edges = LW.bin_edges(df, FEATURES, 63)
    held = LW.binned(df, LW.BoostedTrees(FEATURES), edges, "label", "draw", LW.Bag(0, [0, 1, 2], 1.0)).toArrow().to_batches()
    rows = held[0].num_rows
    assert rows == 1 and len(held[0].column("bag")[0].as_py()) < 3 * len(table)
    (columns, g), = LW.bags_of(held, LW.Bag(0, [0, 1, 2], 1.0))
    assert (g == np.rint(table["label"].to_numpy() * 65536)).all() and (columns[2] == table["c"]).all()


def test_rows_of_members_and_leaves():
    """Masks and numbers say the same, also where numbers are missing."""
    tree = LW.Tree(*(np.array(x) for x in ([0, 0, 1, 0, 0], [0] * 5, [0.5, 0, 2.0, 0, 0], [1, 1, 3, 3, 4], [2, 1, 4, 3, 4],
                                           [0.0, 1.0, 0.0, 2.0, 3.0], [0.0] * 5, [0] * 5)), 2)
    x = np.array([[0.0, 9.0], [1.0, 1.0], [1.0, 3.0], [np.nan, np.nan], [np.nan, 2.0]] + [[0.0, 0.0]] * 500)
    want = [1, 3, 4, 4, 3] + [1] * 500
    assert tree.leaf(x, tree.threshold).tolist() == want
    assert {k: v.tolist() for k, v in tree.members(x.T, tree.threshold, len(x), [4]).items()} == {4: [2, 3]}


@pytest.mark.parametrize("name", ["model_residuals", "booster_check"])
def test_test_rows_are_written_where_they_are_read_again(spark, monkeypatch, name):
    """Neither query cleans and scores the trips once per reader."""
    def stump(rows, bag, edges, p):
        return LW.as_tree([LW.Node(g=65536, n=1, known=True)], edges, p)

    made, plain = [], QM.H.written
    monkeypatch.setattr(QM, "_FITTED", {})
    monkeypatch.setattr(LW, "grow", stump)
    monkeypatch.setattr(QM.H, "written", lambda df, *a: made.append(df.columns) or plain(df, *a))
    out = E.queries()[name](spark, SF)
    assert len(made) == 2 and out.count() > 0       # the training matrix, and this
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert name == "booster_check" or "ArrowEvalPython" not in plan
