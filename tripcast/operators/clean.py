"""Cleaning and feature steps (P1-P14, F1-F9) and the composite
``TripPreprocessor`` transformer (P12).

Every step is a DataFrame -> DataFrame function made of native column
expressions; the steps are row-local, so the whole chain is one narrow stage
(scan -> filter -> project) with no shuffle.  The step order is part of the
contract and is kept as written: Catalyst may merge adjacent deterministic
filters, which does not change results.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast import schema as S
from tripcast.functions import calendar as cal


def epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


# ---------------------------------------------------------------------------
# P1 / P2
# ---------------------------------------------------------------------------

def standardize_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name, then map known variants to the
    standard names.  Renamed by position, since Spark resolves names without
    regard to case; two columns that end up with one name are an error."""
    names = []
    for c in df.columns:
        low = c.lower()
        names.append(S.COLUMN_ALIASES.get(low, low))
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"columns collide after standardising names: {dupes}")
    return df.toDF(*names)


def keep_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep exactly ``columns`` in that order; a missing one is an error."""
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing:
        raise KeyError(f"required columns missing: {missing}")
    return df.select(*columns)


def columns_to_keep(predicting: bool, columns: list[str] | None = None) -> list[str]:
    cols = list(columns) if columns else list(S.KEEP_COLUMNS)
    if not predicting and S.DROPOFF not in cols:
        cols.append(S.DROPOFF)
    return cols


# ---------------------------------------------------------------------------
# timestamps
# ---------------------------------------------------------------------------

def micros_to_timestamp(c: Column) -> Column:
    """Microseconds since epoch -> TIMESTAMP_NTZ (naive, no zone shift)."""
    return F.timestamp_add("MICROSECOND", c, epoch_ntz())


def parse_timestamp_column(df: DataFrame, name: str) -> Column:
    """Non-datetime values are read as microseconds since epoch; values
    that are not numbers become NULL.  A zoned timestamp is taken at its wall
    clock in the session zone."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        return c.cast(T.TimestampNTZType())
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return micros_to_timestamp(c.cast("long"))
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return micros_to_timestamp(F.floor(c).cast("long"))
    return micros_to_timestamp(F.expr(f"try_cast(`{name}` AS BIGINT)"))


def parse_timestamps(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    cols = [c for c in (columns or S.DATETIME_COLUMNS) if c in df.columns]
    return df.withColumns({c: parse_timestamp_column(df, c) for c in cols}) if cols else df


def parse_request_timestamps(df: DataFrame, column: str = S.PICKUP) -> DataFrame:
    """ISO text ('2013-01-01 00:20:00' or with 'T') -> TIMESTAMP_NTZ; bad
    text -> NULL (the caller routes such rows to a reject output)."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, F.expr(f"try_cast(`{column}` AS TIMESTAMP_NTZ)"))
    return parse_timestamps(df, [column])


# ---------------------------------------------------------------------------
# P5-P11
# ---------------------------------------------------------------------------

def number(value: Column) -> Column:
    """NaN as NULL (in Spark's order NaN is above every number)."""
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


def drop_invalid(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """P5: drop rows without pickup / dropoff, with non-positive duration (only
    when the target already exists) or non-positive distance.  A SQL NULL
    comparison is not true, so NULL and NaN distances drop."""
    cond = F.lit(True)
    if S.PICKUP in df.columns:
        cond = cond & F.col(S.PICKUP).isNotNull()
    if S.DROPOFF in df.columns:
        cond = cond & F.col(S.DROPOFF).isNotNull()
    if target in df.columns:
        cond = cond & (F.col(target) > 0)
    if S.DISTANCE in df.columns:
        cond = cond & (F.col(S.DISTANCE) > 0) & ~F.isnan(S.DISTANCE)    # the comparison reaches the scan
    return df.filter(cond)


def duration_seconds(pickup: Column, dropoff: Column) -> Column:
    return (F.timestamp_diff("MICROSECOND", pickup, dropoff) / F.lit(1e6)).cast("double")


def add_trip_duration(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Dropoff - pickup in fractional seconds, when both columns exist."""
    if S.PICKUP in df.columns and S.DROPOFF in df.columns:
        return df.withColumn(target, duration_seconds(F.col(S.PICKUP), F.col(S.DROPOFF)))
    return df


def speed_mph(distance: Column, duration_s: Column) -> Column:
    """miles per hour; NULL (not an error) when the duration is 0."""
    return F.try_divide(distance, duration_s / F.lit(3600.0))


def remove_outliers(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Duration 60..10800 s, distance 0.1..100 mi, speed 0.5..65 mph."""
    has_t, has_d = target in df.columns, S.DISTANCE in df.columns
    if has_t:
        df = df.filter(F.col(target).between(S.MIN_DURATION_S, S.MAX_DURATION_S))
    if has_d:
        df = df.filter(F.col(S.DISTANCE).between(S.MIN_DISTANCE_MI, S.MAX_DISTANCE_MI))
    if has_t and has_d:
        df = df.filter(speed_mph(F.col(S.DISTANCE), F.col(target)).between(S.MIN_SPEED_MPH, S.MAX_SPEED_MPH))
    return df


def coerce_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Numeric columns as double; NaN and text that is not a number -> NULL."""
    out = {}
    for c in columns or S.NUMERIC_COLUMNS:
        if c in df.columns:
            out[c] = number(F.expr(f"try_cast(`{c}` AS DOUBLE)"))
    return df.withColumns(out) if out else df


def fill_passengers(df: DataFrame) -> DataFrame:
    """P10: NULL or NaN passenger_count -> 1 (a 0 stays 0)."""
    if S.PASSENGERS in df.columns:
        kind = df.schema[S.PASSENGERS].dataType
        count = number(F.col(S.PASSENGERS)) if isinstance(kind, T.FractionalType) else F.col(S.PASSENGERS)
        return df.withColumn(S.PASSENGERS, F.coalesce(count, F.lit(S.DEFAULT_PASSENGERS)))
    return df


def fill_categoricals(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Listed categorical columns as text, NULL -> '0'."""
    cols = [c for c in (columns if columns is not None else S.CATEGORICAL_COLUMNS) if c in df.columns]
    if not cols:
        return df
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in cols})


# ---------------------------------------------------------------------------
# F1-F8: features
# ---------------------------------------------------------------------------

def feature_columns(ts: Column, full: bool = True) -> dict[str, Column]:
    """The feature expressions over a pickup timestamp, in output order."""
    hour = F.hour(ts).cast("int")
    wd = F.weekday(ts).cast("int")  # Monday = 0
    cols = {"pickup_hour": hour, "pickup_weekday": wd}
    if full:
        cols.update({
            "pickup_day": F.dayofmonth(ts).cast("int"),
            "pickup_month": F.month(ts).cast("int"),
            "pickup_year": F.year(ts).cast("int"),
            "is_weekend": (wd >= 5).cast("int"),
            "is_morning_rush": (hour.between(7, 10) & (wd < 5)).cast("int"),
            "is_evening_rush": (hour.between(16, 19) & (wd < 5)).cast("int"),
            "is_night": ((hour >= 22) | (hour <= 6)).cast("int"),
            "is_holiday": cal.is_us_holiday(F.to_date(ts)),
            "date_int": cal.days_since_epoch(ts),
            "sin_time": cal.season_sin(ts),
            "cos_time": cal.season_cos(ts),
        })
    return cols


def add_features(df: DataFrame, full: bool = True) -> DataFrame:
    """F1-F8 from the pickup time, then the raw timestamps are dropped."""
    df = df.withColumns(feature_columns(F.col(S.PICKUP), full))
    return df.drop(*[c for c in (S.PICKUP, S.DROPOFF) if c in df.columns])


# ---------------------------------------------------------------------------
# The composite transformer
# ---------------------------------------------------------------------------

class TripPreprocessor(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Standardise -> keep -> parse -> drop invalid -> duration ->
    outliers -> numeric -> fill -> features.  Stateless (no fit)."""

    standardizeColumns = Param(Params._dummy(), "standardizeColumns", "lower-case and map column names",
                               typeConverter=TypeConverters.toBoolean)
    removeOutliers = Param(Params._dummy(), "removeOutliers", "apply the outlier bounds",
                           typeConverter=TypeConverters.toBoolean)
    createFeatures = Param(Params._dummy(), "createFeatures", "make the full calendar feature set",
                           typeConverter=TypeConverters.toBoolean)
    predicting = Param(Params._dummy(), "predicting", "serving input: no dropoff column",
                       typeConverter=TypeConverters.toBoolean)
    skipValidation = Param(Params._dummy(), "skipValidation", "leave out the invalid-row filter",
                           typeConverter=TypeConverters.toBoolean)
    targetColumn = Param(Params._dummy(), "targetColumn", "name of the duration target",
                         typeConverter=TypeConverters.toString)
    keepColumns = Param(Params._dummy(), "keepColumns", "columns kept (dropoff added when training)",
                        typeConverter=TypeConverters.toListString)
    categoricalColumns = Param(Params._dummy(), "categoricalColumns", "columns filled with '0' as text",
                               typeConverter=TypeConverters.toListString)
    numericColumns = Param(Params._dummy(), "numericColumns", "columns coerced to double",
                           typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, standardizeColumns=True, removeOutliers=True, createFeatures=False,
                 predicting=False, skipValidation=False, targetColumn=S.TARGET,
                 keepColumns=None, categoricalColumns=None, numericColumns=None):
        super().__init__()
        self._setDefault(standardizeColumns=True, removeOutliers=True, createFeatures=False,
                         predicting=False, skipValidation=False, targetColumn=S.TARGET,
                         keepColumns=list(S.KEEP_COLUMNS), categoricalColumns=list(S.CATEGORICAL_COLUMNS),
                         numericColumns=list(S.NUMERIC_COLUMNS))
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        target = g(self.targetColumn)
        if g(self.standardizeColumns):
            df = standardize_columns(df)
        df = keep_columns(df, columns_to_keep(g(self.predicting), g(self.keepColumns)))
        df = parse_timestamps(df)
        if not g(self.skipValidation):
            df = drop_invalid(df, target)
        df = add_trip_duration(df, target)
        if g(self.removeOutliers):
            df = remove_outliers(df, target)
        df = coerce_numeric(df, g(self.numericColumns))
        df = fill_passengers(df)
        df = fill_categoricals(df, g(self.categoricalColumns))
        return add_features(df, g(self.createFeatures))


def preprocess(df: DataFrame, standardize_columns: bool = False, remove_outliers: bool = True,
               create_features: bool = False, predicting: bool = False, skip_validation: bool = False,
               target_column: str = S.TARGET, columns_to_keep: list[str] | None = None,
               categorical_cols: list[str] | None = None, numeric_cols: list[str] | None = None):
    """Function form of P12 (its ``standardize_columns`` default is False, the
    class default is True).  Returns ``(frame, transformer)``."""
    t = TripPreprocessor(standardizeColumns=standardize_columns, removeOutliers=remove_outliers,
                         createFeatures=create_features, predicting=predicting,
                         skipValidation=skip_validation, targetColumn=target_column,
                         keepColumns=list(columns_to_keep) if columns_to_keep else None,
                         categoricalColumns=categorical_cols, numericColumns=numeric_cols)
    return t.transform(df), t


def cleaning_audit(raw: DataFrame, target: str = S.TARGET) -> DataFrame:
    """One pass that counts what each cleaning stage removes.

    Columns: rows_in, unused_columns, invalid_rows, outlier_rows, rows_out.
    Conditional counts (``count_if``) over one scan, so it costs one partial +
    final aggregate and no extra pass per rule.
    """
    kept = columns_to_keep(False)
    unused = len([c for c in standardize_columns(raw).columns if c not in kept])
    df = add_trip_duration(parse_timestamps(keep_columns(standardize_columns(raw), kept)), target)
    valid = (F.col(S.PICKUP).isNotNull() & F.col(S.DROPOFF).isNotNull()
             & (number(F.col(S.DISTANCE)) > 0))
    t, d = F.col(target), F.col(S.DISTANCE)
    inlier = (t.between(S.MIN_DURATION_S, S.MAX_DURATION_S)
              & d.between(S.MIN_DISTANCE_MI, S.MAX_DISTANCE_MI)
              & speed_mph(d, t).between(S.MIN_SPEED_MPH, S.MAX_SPEED_MPH))
    valid = F.coalesce(valid, F.lit(False))
    inlier = F.coalesce(inlier, F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.lit(unused).cast("long").alias("unused_columns"),
        F.count_if(~valid).alias("invalid_rows"),
        F.count_if(valid & ~inlier).alias("outlier_rows"),
        F.count_if(valid & inlier).alias("rows_out"),
    )


def observed_cleaning(raw: DataFrame, **preprocess_kwargs):
    """P13 / P14 without an extra pass: returns ``(cleaned, counts)`` where
    ``counts()`` gives rows_in / rows_valid / rows_out, collected by
    ``DataFrame.observe`` while ``cleaned`` is being written by the caller
    (call it after the first action on ``cleaned``)."""
    from pyspark.sql import Observation

    obs_in, obs_valid, obs_out = Observation("rows_in"), Observation("rows_valid"), Observation("rows_out")
    kw = dict(preprocess_kwargs)
    standardize = kw.pop("standardize_columns", False)
    src = standardize_columns(raw) if standardize else raw
    src = src.observe(obs_in, F.count(F.lit(1)).alias("n"))
    kept = parse_timestamps(keep_columns(src, columns_to_keep(kw.get("predicting", False),
                                                               kw.get("columns_to_keep"))))
    valid = kept if kw.get("skip_validation") else drop_invalid(kept)
    valid = valid.observe(obs_valid, F.count(F.lit(1)).alias("n"))
    df = add_trip_duration(valid)
    if kw.get("remove_outliers", True):
        df = remove_outliers(df)
    df = fill_categoricals(fill_passengers(coerce_numeric(df)), kw.get("categorical_cols"))
    df = add_features(df, kw.get("create_features", False))
    df = df.observe(obs_out, F.count(F.lit(1)).alias("n"))

    def counts() -> dict:
        return {"rows_in": obs_in.get["n"], "rows_valid": obs_valid.get["n"], "rows_out": obs_out.get["n"]}

    return df, counts


def serving_row_check(raw: DataFrame, sink=None) -> dict:
    """P14 in one pass: run the serving path (no validation, no outlier
    removal) into ``sink`` (a function taking the output DataFrame; default
    the ``noop`` writer) while ``observe`` counts the rows going in and
    coming out.  Returns rows_in, rows_out and whether they are equal (the
    reference warns when they are not)."""
    from pyspark.sql import Observation

    o_in, o_out = Observation("serving_in"), Observation("serving_out")
    src = raw.observe(o_in, F.count(F.lit(1)).alias("n"))
    out, _ = preprocess(src, remove_outliers=False, create_features=True, predicting=True, skip_validation=True)
    out = out.observe(o_out, F.count(F.lit(1)).alias("n"))
    (sink or (lambda d: d.write.format("noop").mode("overwrite").save()))(out)
    n_in, n_out = o_in.get["n"], o_out.get["n"]
    return {"rows_in": n_in, "rows_out": n_out, "equal": n_in == n_out}
