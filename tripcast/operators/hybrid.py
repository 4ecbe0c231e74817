"""The two-model predictor: trend x exp(booster) (M9-M12), its persistence
(S9) and the run records (S10).

The model is an MLlib ``PipelineModel``:
  TrendBaseline (ridge coefficients as Params) -> BoostedTrees (log
  correction) -> SQLTransformer (product, minutes)
so it saves and loads with the standard MLlib writer, scores with
``transform``, and the serving form just puts the ``TripPreprocessor`` in
front.  (An MLlib booster works as well, behind a ``VectorAssembler``.)
"""

from __future__ import annotations

import datetime as _dt

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from tripcast import schema as S
from tripcast.operators import aggregates as A
from tripcast.operators import leafwise as LW
from tripcast.operators import sampling as L
from tripcast.operators import trend as TR
from tripcast.operators.clean import TripPreprocessor
from tripcast.session import scratch_path


class TrendBaseline(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """M2 as a pipeline stage: baseline = max(expm1(w . x + b), 1)."""

    wDate = Param(Params._dummy(), "wDate", "weight of date_int", typeConverter=TypeConverters.toFloat)
    wSin = Param(Params._dummy(), "wSin", "weight of sin_time", typeConverter=TypeConverters.toFloat)
    wCos = Param(Params._dummy(), "wCos", "weight of cos_time", typeConverter=TypeConverters.toFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, wDate=0.0, wSin=0.0, wCos=0.0, intercept=0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        log_trend = (F.lit(g(self.wDate)) * F.col("date_int") + F.lit(g(self.wSin)) * F.col("sin_time")
                     + F.lit(g(self.wCos)) * F.col("cos_time") + F.lit(g(self.intercept)))
        return df.withColumn("baseline", F.greatest(F.expm1(log_trend), F.lit(S.TREND_FLOOR_S)))


PRODUCT_SQL = ("SELECT *, baseline * exp(log_correction) AS predicted_seconds, "
               "baseline * exp(log_correction) / 60.0 AS duration_minutes FROM __THIS__")


def trend_stage(coefs: dict) -> TrendBaseline:
    return TrendBaseline(wDate=coefs["w_date"], wSin=coefs["w_sin"], wCos=coefs["w_cos"], intercept=coefs["intercept"])


def scoring_pipeline(coefs: dict, booster) -> PipelineModel:
    vectors = [] if isinstance(booster, LW.BoostedTrees) else [
        VectorAssembler(inputCols=S.FEATURE_COLUMNS, outputCol="features", handleInvalid="keep")]
    return PipelineModel(stages=[trend_stage(coefs), *vectors, booster, SQLTransformer(statement=PRODUCT_SQL)])


def serving_pipeline(scoring: PipelineModel) -> PipelineModel:
    """M10 serving form: raw request rows in (pickup as timestamp, no
    dropoff), nothing dropped, minutes out."""
    pre = TripPreprocessor(standardizeColumns=False, removeOutliers=False, createFeatures=True,
                           predicting=True, skipValidation=True)
    return PipelineModel(stages=[pre] + list(scoring.stages))


def coefs_dict(coefs: DataFrame) -> dict:
    """The four ridge numbers (one row) as Python floats for the Params."""
    row = coefs.select(*TR.COEFS).first()
    return {k: float(row[k]) for k in TR.COEFS}


def with_draw(trips: DataFrame) -> DataFrame:
    """The number that bagging goes by: a mix of the trip's key columns."""
    return trips.withColumn("draw", L.mix(L.trip_key_parts(trips)))


def boosting_matrix(featured: DataFrame, trend: TrendBaseline) -> DataFrame:
    """Baseline and log-ratio label for featured rows that have their draw."""
    return TR.log_ratio_target(trend.transform(featured))


BOOSTED = [*S.FEATURE_COLUMNS, "label", "draw"]         # what a booster is fitted on
SCORED = [*S.FEATURE_COLUMNS, S.TARGET, "baseline", "label"]     # what it is scored on


#: by which candidates are compared: equal models' sums differ in their last bits from job to job
METRIC_DIGITS = 6


def written(matrix: DataFrame, wanted: list[str] = BOOSTED) -> DataFrame:
    """The ``wanted`` columns of a matrix, written once to the shared
    checkpoint folder (``checkpoint`` would run the plan twice)."""
    used = [c for c in matrix.columns if c in wanted]
    path = scratch_path(matrix.sparkSession, "matrix")
    matrix.select(*used).write.parquet(path)
    return matrix.sparkSession.read.schema(matrix.select(*used).schema).parquet(path)


def training_matrix(featured: DataFrame, coefs: DataFrame) -> DataFrame:
    """M9: baseline and log-ratio label for featured rows (trees not used)."""
    return TR.log_ratio_target(TR.trend_predict(featured, coefs))


def evaluate(scored: DataFrame) -> DataFrame:
    """M11 metrics on scored rows (actual = trip_duration, seconds)."""
    ev = scored.select(F.col(S.TARGET).alias("actual"), F.col("predicted_seconds").alias("predicted"))
    return A.regression_metrics(ev)


def save_model(model: PipelineModel, path: str) -> None:
    """MLlib writer (metadata + parquet per stage)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_no", T.LongType()),
    T.StructField("logged_at", T.TimestampNTZType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
])


def runs_frame(spark: SparkSession, run_id: str, results: list[dict]) -> DataFrame:
    """One row per run with its params (a map) and metrics; a handful of
    rows made on the driver from values it already holds."""
    rows = []
    now = _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0, tzinfo=None)
    for r in results:
        params = {k: str(v) for k, v in r.items() if k not in ("run_no", "rmse", "mae", "r2", "n")}
        rows.append((run_id, int(r["run_no"]), now, params, r.get("rmse"), r.get("mae"), r.get("r2")))
    return spark.createDataFrame(rows, RUNS_SCHEMA)


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def log_runs(runs: DataFrame, path: str) -> None:
    """S10, idempotent: the rows of each run id replace what the log holds for
    that id (one folder per run id), so a retried run counts once; other runs
    stay."""
    runs.write.partitionBy("run_id").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(path)


def persist(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


# ---------------------------------------------------------------------------
# The whole training run
# ---------------------------------------------------------------------------

def _featurize(raw: DataFrame) -> DataFrame:
    """Cleaned rows with features and draw."""
    return TripPreprocessor(standardizeColumns=False, createFeatures=True,
                            keepColumns=[*S.KEEP_COLUMNS, "draw"]).transform(with_draw(raw))


def test_scores(model: LW.BoostedTrees, matrix: DataFrame) -> dict:
    """RMSE, MAE and R2 of trend x exp(booster) on the rows of a matrix."""
    scored = model.transform(matrix).withColumn("predicted_seconds", F.col("baseline") * F.exp(F.col("log_correction")))
    r = evaluate(scored).first()
    return {"rmse": r["rmse"], "mae": r["mae"], "r2": r["r2"]}


def train_and_evaluate(train_raw: DataFrame, test_raw: DataFrame, batch_cols: list[str],
                       grid: list[dict], model_path: str, max_rounds: int = 20, final_rounds: int = 20,
                       tune_sample: tuple[float, int] = S.TUNE_SAMPLE,
                       final_sample: tuple[float, int] = S.FINAL_SAMPLE,
                       min_batch_rows: int | None = None, parallelism: int = 2) -> list[dict]:
    """Tune the booster on ``tune_sample`` (rate, seed) of the training
    rows, fit the final one on ``final_sample`` with the best parameters and
    ``final_rounds`` trees, save the model (S9).  Only booster fits see a
    sample: the trend is fitted on every training row, candidates are compared
    and the saved model is scored on every test row.  Returns one dict per run
    (grid runs, then the final run) for S10.

    ``*_raw`` are raw trip rows with loader batch ids ``batch_cols``.  Every
    sample is a hash draw of the rows; if ``min_batch_rows`` is given, batches
    of at most that many rows are taken whole.  Matrices are written once for
    the boosting passes."""
    test = _featurize(test_raw)
    coefs = coefs_dict(TR.fit_ridge(A.daily_stats(_featurize(train_raw))))

    def matrix(df: DataFrame, wanted: list[str]) -> DataFrame:
        return written(boosting_matrix(df, trend_stage(coefs)), wanted)

    def sampled(rate: float, seed: int) -> DataFrame:
        return matrix(_featurize(L.sample_fraction(train_raw, rate, seed, batch_cols, min_batch_rows)), BOOSTED)

    valid = matrix(test, SCORED)
    results = LW.grid_search(sampled(*tune_sample), valid, grid, lambda m: test_scores(m, valid), max_rounds, parallelism)
    best = min(results, key=lambda r: (r["rmse"] if r["rmse"] is None else round(r["rmse"], METRIC_DIGITS), r["run_no"]))
    params = {k: best[k] for k in grid[best["run_no"]]}
    booster = LW.fit(sampled(*final_sample), params, final_rounds)
    save_model(scoring_pipeline(coefs, booster), model_path)

    m = evaluate(load_model(model_path).transform(test)).first()
    results.append({"run_no": len(results), **params, "rounds": len(booster.trees), "final": True,
                    "rmse": m["rmse"], "mae": m["mae"], "r2": m["r2"], "n": m["n"]})
    return results
