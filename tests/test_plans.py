"""Physical-plan checks: filters and column pruning reach the parquet scan,
aggregates are partial + final, the flagship has one exchange."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    """The text of ``df.explain("formatted")``."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_flagship_pushdown_and_pruning(spark):
    plan = _plan(E.queries()["daily_stats"](spark, SF))
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters:")]
    assert pushed, plan
    assert "IsNotNull(trip_distance)" in pushed[0] and "GreaterThan(trip_distance,0.0)" in pushed[0]
    assert "GreaterThanOrEqual(trip_distance,0.1)" in pushed[0]
    # only the three columns the query needs are read
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "tpep_dropoff_datetime", "tpep_pickup_datetime", "trip_distance"]
    assert "partial_sum(trip_duration" in plan  # map-side partial aggregate
    assert plan.count("Exchange (") == 1 and "hashpartitioning(date_int" in plan


def test_window_query_has_no_python(spark):
    plan = _plan(E.queries()["sliding_rmse"](spark, SF))
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_no_window_over_all_rows_lacks_a_partition(spark):
    """Keys 2^22 apart make every row a chunk of its own: what is ordered in
    one task is the top of the tree of sums alone."""
    from pyspark.sql import functions as F

    from tripcast.operators import windows as W

    df = spark.range(2000).select((F.col("id") * (1 << 22)).alias("key"), F.lit(1.0).alias("sq_err"))
    out = W.sliding_rmse(df, "key", chunk_rows=4096)
    plan = _plan(out)
    # partition keys of the windows in the plan; an empty list would be a window over everything
    windows = re.findall(r"\(\d+\) Window(?:GroupLimit)?\n(?:.*\n)*?Arguments: (.*)", plan)
    alone = [w for w in windows if "windowspecdefinition" in w and re.search(r"\], \[_[a-z]+", w) is None]
    assert windows and all("_up" in w or "_first" in w for w in alone)
    got = out.orderBy("key").collect()
    assert [r["window_size"] for r in got[:6]] == [1, 2, 3, 4, 5, 5] and len(got) == 2000
    top = W.sum_before(df.select((F.col("key") / (1 << 22)).cast("long").alias("n"), F.lit(2).alias("v")), "n", "v", "s")
    assert all(r["s"] == 2 * r["n"] for r in top.collect())


def test_month_and_day_slices_reach_the_scan(spark):
    plan = _plan(E.queries()["months_slice"](spark, SF))
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters:")][0]
    assert "GreaterThanOrEqual(tpep_pickup_datetime,1998-01-01T00:00)" in pushed
    assert "LessThan(tpep_pickup_datetime,1998-07-01T00:00)" in pushed
    plan = _plan(E.queries()["validation_day"](spark, SF))
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters:")][0]
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2000-03-15T00:00)" in pushed


def test_months_slice_merges_ranges(spark):
    import datetime as dt

    from tripcast.sources.trips import months_slice

    days = [(dt.datetime(1997, m, 15),) for m in range(1, 13)] + [(dt.datetime(1998, 1, 2),)]
    df = spark.createDataFrame(days, "tpep_pickup_datetime timestamp_ntz")
    got = months_slice(df, [1997, 1998], [12, 1, 2]).orderBy("tpep_pickup_datetime").collect()
    assert [(r[0].year, r[0].month) for r in got] == [(1997, 1), (1997, 2), (1997, 12), (1998, 1)]
    assert months_slice(df, [1997]).count() == 12


def test_loader_batches_need_no_sort(spark):
    """Batch ids come from file and row index: no range exchange, no checkpoint."""
    for name in ("scan_batches", "sample_fraction", "sample_exact", "sample_small_batches", "cap_batches", "daily_partial"):
        plan = _plan(E.queries()[name](spark, SF))
        assert "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan, name


def test_months_are_pruned_by_folder(spark):
    plan = _plan(E.queries()["months_layout"](spark, SF))
    filters = next(ln for ln in plan.splitlines() if ln.startswith("PartitionFilters:"))
    assert "year" in filters and "month" in filters


def test_a_month_loaded_again_is_replaced(spark, tmp_dir):
    import datetime as dt

    from tripcast.sources import trips as T

    def trips(*days):
        return spark.createDataFrame([(dt.datetime(*d),) for d in days], "tpep_pickup_datetime timestamp_ntz")

    T.write_months(trips((1998, 1, 2), (1998, 2, 3), (1998, 2, 4)), f"{tmp_dir}/m")
    T.write_months(trips((1998, 2, 5)), f"{tmp_dir}/m")
    got = T.read_months(spark, f"{tmp_dir}/m", "tpep_pickup_datetime timestamp_ntz", [1998]).collect()
    assert sorted(r[0].day for r in got) == [2, 5]
