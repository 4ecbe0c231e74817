"""Driver contract: entry() smoke, registry shape, and the SQL oracle on the
smallest scale factor for the cheap queries."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FAST = ["scan_trips", "remove_outliers", "preprocess", "daily_stats", "cleaning_audit", "is_holiday",
        "sample_exact", "regression_metrics", "sliding_rmse", "drift_alert", "ridge_trend", "hybrid_predict",
        "union_batches", "json_requests", "validation_rmse", "scan_batches", "sample_fraction", "cap_batches",
        "lost_rows", "validation_calls", "prediction_pages", "log_runs", "months_layout", "rescan_rows",
        "transformer_round_trip", "density_curve", "residual_sketch", "stream_drift_models",
        "tree_first", "tree_continued", "tree_grid", "tree_predict", "tree_round_trip", "tree_metrics", "tree_training_run"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"date_int", "avg_duration", "n_trips"} <= set(df.columns)


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=E.__file__.rsplit("/", 1)[0], capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split() == [str(len(E.queries())), str(len(E.oracle_sql()))]


def test_oracles_are_for_registered_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def _norm(df):
    df = df[sorted(df.columns)]
    out = []
    for rec in df.itertuples(index=False):
        vals = []
        for v in rec:
            if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
                vals.append("NULL")
            elif isinstance(v, bool) or type(v).__name__ == "bool_":
                vals.append(str(bool(v)))
            elif isinstance(v, (int, float)) or type(v).__module__ == "numpy":
                vals.append(f"{float(v):.4f}")
            elif hasattr(v, "isoformat"):
                vals.append(pd.Timestamp(v).isoformat())
            else:
                vals.append(str(v))
        out.append("|".join(vals))
    return sorted(out)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert _norm(got) == _norm(exp)
