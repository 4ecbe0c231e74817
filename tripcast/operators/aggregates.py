"""Aggregations.

All of them are hash aggregates with a map-side partial step, so what is
shuffled is one row per (task, group) -- a day, a batch, a bin -- never the
trips themselves.  Grouping keys are low-cardinality (days, bins, batches)
and a hot key costs nothing extra because partial aggregation collapses it
before the exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.operators.joins import join_small


def daily_partial(df: DataFrame, batch_cols: list[str]) -> DataFrame:
    """A1: per batch and day, the sum and count of durations."""
    return (df.groupBy(*batch_cols, "date_int")
              .agg(F.sum(S.TARGET).alias("sum_duration"), F.count(S.TARGET).alias("n_trips"),
                   F.min("sin_time").alias("sin_time"), F.min("cos_time").alias("cos_time")))


def daily_stats(df: DataFrame) -> DataFrame:
    """A2: one row per day: sum, count and mean duration plus the day's
    sine/cosine (a function of the day, so ``min`` just carries it).

    The partial+final HashAggregate pair is the merge of per-batch partials."""
    return (df.groupBy("date_int")
              .agg(F.sum(S.TARGET).alias("sum_duration"),
                   F.count(S.TARGET).alias("n_trips"),
                   F.min("sin_time").alias("sin_time"),
                   F.min("cos_time").alias("cos_time"))
              .withColumn("avg_duration", F.col("sum_duration") / F.col("n_trips")))


def merge_partials(partials: DataFrame) -> DataFrame:
    """A2 over A1 output: sum of sums and counts per day."""
    return (partials.groupBy("date_int")
                    .agg(F.sum("sum_duration").alias("sum_duration"), F.sum("n_trips").alias("n_trips"),
                         F.min("sin_time").alias("sin_time"), F.min("cos_time").alias("cos_time"))
                    .withColumn("avg_duration", F.col("sum_duration") / F.col("n_trips")))


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                       group_cols: list[str] | None = None) -> DataFrame:
    """A3: n, RMSE, MAE and R^2 = 1 - SS_res / SS_tot in one aggregate pass.

    SS_tot = sum(y^2) - n * mean(y)^2 would cancel badly on large n, so it is
    taken as n * var_pop(y), which Spark computes with a stable merge."""
    y, p = F.col(actual), F.col(predicted)
    err = y - p
    aggs = [F.count(err).alias("n"),
            F.sqrt(F.avg(err * err)).alias("rmse"),
            F.avg(F.abs(err)).alias("mae"),
            (F.lit(1.0) - F.sum(err * err) / (F.count(err) * F.var_pop(y))).alias("r2")]
    return df.groupBy(*(group_cols or [])).agg(*aggs)


def batch_metrics(df: DataFrame, batch_cols: list[str], every: int = 15,
                  actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """A4: RMSE / MAE for every batch (its number is the last of
    ``batch_cols``), with ``is_logged`` marking every ``every``-th."""
    m = regression_metrics(df, actual, predicted, batch_cols).drop("r2")
    return m.withColumn("is_logged", (F.col(batch_cols[-1]) % every == 0))


def density_2d(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
               cell: float = 60.0) -> DataFrame:
    """A5: counts on a square grid of ``cell`` seconds over the whole range;
    empty cells do not appear, rows without a value count in a NULL cell."""
    a, p = F.col(actual), F.col(predicted)
    return (df.groupBy(F.floor(a / cell).cast("long").alias("actual_bin"),
                       F.floor(p / cell).cast("long").alias("predicted_bin"))
              .agg(F.count(F.lit(1)).alias("n")))


def residual_histogram(df: DataFrame, residual: str = "residual", bins: int = 100) -> DataFrame:
    """``bins`` equal-width bins over [min, max] of the residual.

    The range is a one-row aggregate joined back as a broadcast (its size is
    one row whatever the data size)."""
    rng = df.agg(F.min(residual).alias("lo"), F.max(residual).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    binned = df.select(residual).crossJoin(F.broadcast(rng)).select(
        F.when(width == 0, F.lit(0)).otherwise(
            F.least(F.floor((F.col(residual) - F.col("lo")) / width), F.lit(bins - 1))).cast("int").alias("bin"),
        "lo", "hi")
    return (binned.groupBy("bin")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.min("hi").alias("hi"))
                  .select("bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_lo"),
                          "n"))


def density_curve(df: DataFrame, value: str = "residual", points: int = 100, cells: int = 1000) -> DataFrame:
    """The smoothed density of a column at ``points`` equally spaced places
    from its least to its greatest value: Gaussian kernels of Scott's width
    (standard deviation times n^(-1/5)) over the counts of ``cells`` cells.

    Two aggregates over the rows; what is convolved is at most ``cells``
    counts, each spread over the ``points``."""
    one = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("n"), F.stddev_samp(value).alias("sd"))
    one = one.select("lo", "hi", "n", (F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))).alias("h")).filter("h > 0")
    width = (F.col("hi") - F.col("lo")) / F.lit(float(cells))
    cell = F.least(F.floor((F.col(value) - F.col("lo")) / width), F.lit(cells - 1))
    counts = df.filter(F.col(value).isNotNull()).crossJoin(F.broadcast(one)).groupBy(cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("k"), *[F.min(c).alias(c) for c in ("lo", "hi", "n", "h")])
    x = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / F.lit(float(points - 1))
    centre = F.col("lo") + (F.col("cell") + 0.5) * width
    z = (F.col("x") - centre) / F.col("h")
    spread = counts.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("x", x)
    weight = F.col("k") * F.exp(-z * z / 2) / (F.col("n") * F.col("h") * F.sqrt(F.lit(2 * math.pi)))
    return spread.groupBy("point").agg(F.min("x").alias("x"), F.sum(weight).alias("density"))


SKETCH_K = 800


def residual_sketches(df: DataFrame, by: list[str], predicted: str = "predicted", residual: str = "residual",
                      cell: float = 60.0, k: int = SKETCH_K) -> DataFrame:
    """A7 for any range of days: one quantile sketch of the residuals per
    ``by`` (a day) and bin of predicted values, to be stored and merged."""
    binned = df.filter(F.col(residual).isNotNull()).withColumn("predicted_bin", F.floor(F.col(predicted) / cell).cast("long"))
    return binned.groupBy(*by, "predicted_bin").agg(F.kll_sketch_agg_double(F.col(residual).cast("double"), F.lit(k)).alias("sketch"))


def merged_profile(sketches: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75), k: int = SKETCH_K) -> DataFrame:
    """Count and quantiles per bin from stored sketches (of the days the
    caller keeps), without the trips."""
    merged = sketches.groupBy("predicted_bin").agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    return merged.select("predicted_bin", F.kll_sketch_get_n_double("sketch").alias("n"), *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"q{round(100 * q)}") for q in quantiles])


def residual_profile(df: DataFrame, predicted: str = "predicted", residual: str = "residual",
                     cell: float = 60.0, fine: float = 1.0) -> DataFrame:
    """Residuals binned by predicted value: count, mean, stddev and the
    exact median.

    No task holds a bin's residuals: they are counted in cells of ``fine``
    seconds first (partial aggregates), the running count per bin tells which
    cells hold the one or two middle ranks, and only the distinct values of
    those cells are counted and ranked."""
    e = F.col(residual)
    rows = df.select(F.floor(F.col(predicted) / cell).cast("long").alias("predicted_bin"), e.alias("_e"))
    stats = rows.groupBy("predicted_bin").agg(F.count("_e").alias("n"), F.avg("_e").alias("mean_residual"),
                                              F.stddev_samp("_e").alias("sd_residual"))
    valued = rows.filter("_e is not null").withColumn("_b", F.coalesce("predicted_bin", F.lit(-(1 << 62))))
    valued = valued.withColumn("_c", F.floor(F.col("_e") / fine))
    by_bin = Window.partitionBy("_b")
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1

    def ranked(counts: DataFrame, order: str, start) -> DataFrame:
        upto = F.sum("_k").over(by_bin.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
        return counts.withColumn("_to", upto + start)

    cells = ranked(valued.groupBy("_b", "_c").agg(F.count(F.lit(1)).alias("_k")).withColumn(
        "_n", F.sum("_k").over(by_bin)), "_c", F.lit(0))
    # at most two cells a bin
    middle = cells.filter((F.col("_to") >= low) & (F.col("_to") - F.col("_k") < high)).select(
        "_b", "_c", "_n", (F.col("_to") - F.col("_k")).alias("_before"))
    values = (join_small(valued, middle, ["_b", "_c"], "inner").groupBy("_b", "_c", "_e")
              .agg(F.count(F.lit(1)).alias("_k"), F.min("_n").alias("_n"), F.min("_before").alias("_before")))
    first = F.min("_before").over(by_bin)
    values = ranked(values.withColumn("_first", first), "_e", F.col("_first"))
    here = (F.col("_to") >= low) & (F.col("_to") - F.col("_k") < high)
    median = values.filter(here).groupBy("_b").agg(((F.min("_e") + F.max("_e")) / 2).alias("median_residual"))
    keyed = stats.withColumn("_b", F.coalesce("predicted_bin", F.lit(-(1 << 62))))
    return join_small(keyed, median, ["_b"], "left").drop("_b")


def best_run(runs: DataFrame, metric: str = "rmse", order_col: str = "run_no", digits: int | None = None) -> DataFrame:
    """The run with the lowest metric; the earliest run wins a tie.
    Runs without a metric (NULL or NaN) can't win.  Metrics that differ only
    after ``digits`` decimals, if these are given, are a tie.  ``min_by`` over
    a struct is one partial/final aggregate."""
    scored = runs.filter(F.col(metric).isNotNull() & ~F.isnan(metric))
    rank = F.col(metric) if digits is None else F.round(metric, digits)
    best = scored.agg(F.min_by(F.struct(*runs.columns), F.struct(rank, order_col)).alias("k"))
    return best.filter(F.col("k").isNotNull()).select("k.*")


def round_doubles(df: DataFrame, digits: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column (used only at the edge of a registered query
    so that two engines' last-bit differences do not matter)."""
    cols: list[Column] = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double" and f.name not in skip:
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def hexbin_density(df: DataFrame, x: str = "actual", y: str = "predicted", gridsize: int = 50) -> DataFrame:
    """A5 as hexagonal bins (the plot's ``gridsize=50``, ``mincnt=1``): the
    data range is split into ``gridsize`` hexagons across x and
    ``int(gridsize / sqrt(3))`` rows; a point belongs to the nearer of two
    candidate centres, one on the integer lattice (``bround``) and one on the
    half-offset lattice (``floor`` + 0.5), with y distances weighted by 3.
    The range is a one-row aggregate (broadcast); the rest is a narrow
    projection and one grouped count.  Output: lattice (1 or 2), i, j,
    centre_x, centre_y, n -- empty cells do not appear.

    Fixed values: the x padding of 1e-9 of the range is part of the binning
    rule."""
    nx, ny = gridsize, int(gridsize / math.sqrt(3))
    rng = df.agg(F.min(x).alias("_xlo"), F.max(x).alias("_xhi"), F.min(y).alias("_ylo"), F.max(y).alias("_yhi"))
    pad = (F.col("_xhi") - F.col("_xlo")) * F.lit(1e-9)
    rng = rng.select((F.col("_xlo") - pad).alias("_x0"), (F.col("_xhi") + pad).alias("_x1"),
                     F.col("_ylo").alias("_y0"), F.col("_yhi").alias("_y1"))
    d = df.select(x, y).filter(F.col(x).isNotNull() & F.col(y).isNotNull()).crossJoin(F.broadcast(rng))
    sx = (F.col("_x1") - F.col("_x0")) / F.lit(float(nx))
    sy = (F.col("_y1") - F.col("_y0")) / F.lit(float(ny))
    d = d.select("_x0", "_y0", ((F.col(x) - F.col("_x0")) / sx).alias("_ix"),
                 ((F.col(y) - F.col("_y0")) / sy).alias("_iy"), sx.alias("_sx"), sy.alias("_sy"))
    ix1, iy1 = F.bround(F.col("_ix"), 0), F.bround(F.col("_iy"), 0)
    ix2, iy2 = F.floor(F.col("_ix")), F.floor(F.col("_iy"))
    d1 = (F.col("_ix") - ix1) ** 2 + F.lit(3.0) * (F.col("_iy") - iy1) ** 2
    d2 = (F.col("_ix") - ix2 - F.lit(0.5)) ** 2 + F.lit(3.0) * (F.col("_iy") - iy2 - F.lit(0.5)) ** 2
    first = d1 < d2
    d = d.select("_x0", "_y0", "_sx", "_sy",
                 F.when(first, F.lit(1)).otherwise(F.lit(2)).alias("lattice"),
                 F.when(first, ix1).otherwise(ix2).cast("long").alias("i"),
                 F.when(first, iy1).otherwise(iy2).cast("long").alias("j"))
    off = F.when(F.col("lattice") == 1, F.lit(0.0)).otherwise(F.lit(0.5))
    return (d.groupBy("lattice", "i", "j")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.min(F.col("_x0") + F.col("_sx") * (F.col("i") + off)).alias("centre_x"),
                  F.min(F.col("_y0") + F.col("_sy") * (F.col("j") + off)).alias("centre_y")))
