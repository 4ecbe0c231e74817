"""Ridge trend on log daily duration (M1-M4).

The trend is fit on the per-day table (one row per day, so it is small by
construction): minimise ||y - Xw - b||^2 + alpha ||w||^2 with an unpenalised
intercept and unscaled features (date_int, sin_time, cos_time), y =
log1p(mean daily duration).

``fit_ridge`` solves it in closed form entirely as Spark expressions: one
aggregate for the means, one for the centred cross moments, and Cramer's rule
for the 3x3 system -- so the coefficients come out as a one-row DataFrame and
nothing is collected.  ``fit_ridge_mllib`` gives the same coefficients with
MLlib's normal-equation ``LinearRegression`` (the regularisation is rescaled
because MLlib standardises the label internally).
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.session import ensure_checkpoint_dir

X = S.TREND_COLUMNS  # date_int, sin_time, cos_time
COEFS = ["w_date", "w_sin", "w_cos", "intercept"]


def _det3(a11, a12, a13, a21, a22, a23, a31, a32, a33) -> Column:
    return (a11 * (a22 * a33 - a23 * a32) - a12 * (a21 * a33 - a23 * a31) + a13 * (a21 * a32 - a22 * a31))


def fit_ridge(daily: DataFrame, y_col: str = "avg_duration", alpha: float = S.RIDGE_ALPHA) -> DataFrame:
    """M1: one row (w_date, w_sin, w_cos, intercept, n_days).

    The per-day input (one row per day) is checkpointed first: both passes
    read it, and neither may re-run the trip scan behind it."""
    ensure_checkpoint_dir(daily.sparkSession)
    d = daily.select(*[F.col(c).cast("double").alias(c) for c in X],
                     F.log1p(F.col(y_col)).alias("_y")).checkpoint(eager=True)
    means = d.agg(*[F.avg(c).alias(f"m_{c}") for c in X + ["_y"]], F.count(F.lit(1)).alias("n_days"))
    c = d.crossJoin(F.broadcast(means)).select(
        *[(F.col(v) - F.col(f"m_{v}")).alias(f"c_{v}") for v in X + ["_y"]])
    names = ["date_int", "sin_time", "cos_time"]
    mom = {}
    aggs = []
    for i, a in enumerate(names):
        for b in names[i:]:
            aggs.append(F.sum(F.col(f"c_{a}") * F.col(f"c_{b}")).alias(f"s_{a}_{b}"))
        aggs.append(F.sum(F.col(f"c_{a}") * F.col("c__y")).alias(f"s_{a}_y"))
    m = c.agg(*aggs).crossJoin(means)
    for i, a in enumerate(names):
        for b in names[i:]:
            mom[(a, b)] = mom[(b, a)] = F.col(f"s_{a}_{b}")
    A = [[mom[(a, b)] + (F.lit(alpha) if a == b else F.lit(0.0)) for b in names] for a in names]
    r = [F.col(f"s_{a}_y") for a in names]
    det = _det3(*A[0], *A[1], *A[2])
    w = []
    for j in range(3):
        cols = [[r[i] if k == j else A[i][k] for k in range(3)] for i in range(3)]
        w.append(_det3(*cols[0], *cols[1], *cols[2]) / det)
    intercept = F.col("m__y") - (w[0] * F.col("m_date_int") + w[1] * F.col("m_sin_time") + w[2] * F.col("m_cos_time"))
    return m.select(w[0].alias("w_date"), w[1].alias("w_sin"), w[2].alias("w_cos"),
                    intercept.alias("intercept"), F.col("n_days"))


def fit_ridge_mllib(daily: DataFrame, y_col: str = "avg_duration", alpha: float = S.RIDGE_ALPHA):
    """M1 with MLlib: returns the fitted ``LinearRegressionModel``.

    MLlib minimises (1/2n)||y - Xw - b||^2 + (lambda/2)||w||^2 on a label
    divided by its standard deviation, so ridge's alpha maps to
    lambda = alpha * stddev_pop(y) / n (checked against ``fit_ridge`` in the
    tests).  The two statistics come from one aggregate of the daily table."""
    d = daily.select(*X, F.log1p(F.col(y_col)).alias("label"))
    st = d.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("sd")).first()
    vec = VectorAssembler(inputCols=X, outputCol="features").transform(d)
    lr = LinearRegression(featuresCol="features", labelCol="label", regParam=alpha * st["sd"] / st["n"],
                          elasticNetParam=0.0, standardization=False, solver="normal", fitIntercept=True)
    return lr.fit(vec)


def trend_log(coefs_prefix: str = "") -> Column:
    p = coefs_prefix
    return (F.col(f"{p}w_date") * F.col("date_int") + F.col(f"{p}w_sin") * F.col("sin_time")
            + F.col(f"{p}w_cos") * F.col("cos_time") + F.col(f"{p}intercept"))


def trend_predict(df: DataFrame, coefs: DataFrame, out_col: str = "baseline") -> DataFrame:
    """M2: baseline seconds = max(expm1(w . x + b), 1).  The coefficients are
    a one-row table, joined by broadcast."""
    c = coefs.select(*COEFS)
    return (df.crossJoin(F.broadcast(c))
              .withColumn(out_col, F.greatest(F.expm1(trend_log()), F.lit(S.TREND_FLOOR_S)))
              .drop(*COEFS))


def log_ratio_target(df: DataFrame, baseline: str = "baseline", out_col: str = "label") -> DataFrame:
    """M3: log1p(duration) - log1p(baseline)."""
    return df.withColumn(out_col, F.log1p(F.col(S.TARGET)) - F.log1p(F.col(baseline)))


def trend_anatomy(daily: DataFrame, coefs: DataFrame) -> DataFrame:
    """M4: per day the drift line (w_date * date + b), the season line
    (w_sin * sin + w_cos * cos + mean daily duration) and the full log
    prediction, plus the slope and the wave amplitude."""
    mean_val = daily.agg(F.avg("avg_duration").alias("mean_duration"))
    d = daily.crossJoin(F.broadcast(coefs.select(*COEFS))).crossJoin(F.broadcast(mean_val))
    return d.select(
        "date_int", "avg_duration",
        F.col("w_date").alias("slope"),
        F.sqrt(F.col("w_sin") ** 2 + F.col("w_cos") ** 2).alias("amplitude"),
        (F.col("date_int") * F.col("w_date") + F.col("intercept")).alias("drift"),
        (F.col("sin_time") * F.col("w_sin") + F.col("cos_time") * F.col("w_cos") + F.col("mean_duration"))
        .alias("season"),
        trend_log().alias("full_log_prediction"))
