"""DuckDB SQL building blocks for the correctness oracle.

The oracle is written independently of the Spark code as plain SQL over the
pre-registered views (``lineitem``, ``events``); shared here are only fixed
values (bounds, holiday table, feature names).  Every oracle is
``WITH <ctes> SELECT ...``.
"""

from __future__ import annotations

from tripcast import schema as S
from tripcast.functions.calendar import FIXED_HOLIDAYS, WEEKDAY_HOLIDAYS


def _hm(m: int) -> str:
    return (f"(((l_orderkey % {m}) * {100_000_000 % m} + (l_partkey % {m}) * {1000 % m} "
            f"+ l_linenumber) % {m})")


TRIPS_RAW = f"""
 tr_k AS (SELECT *, (l_orderkey*7919 + l_partkey*104729 + l_linenumber*1299709) % 86400 AS sod FROM lineitem),
 tr_p AS (SELECT tr_k.*, (l_shipdate + to_seconds(CAST(sod AS BIGINT))) AS pu,
        CASE WHEN {_hm(97)} = 0 THEN 0.0 WHEN {_hm(89)} = 0 THEN 150.0 ELSE l_quantity/4.0 END AS dist FROM tr_k),
 tr_d AS (SELECT tr_p.*, CASE WHEN {_hm(83)} = 0 THEN -30 WHEN {_hm(79)} = 0 THEN 14400 WHEN {_hm(73)} = 0 THEN 20
        ELSE CAST(floor(120 + (l_quantity/4.0)*(150 + 6*(12-abs(CAST(floor(sod/3600) AS INT)-14)) + 100*({_hm(11)}))/4.0) AS BIGINT) END AS secs FROM tr_p),
 trips_raw AS (SELECT CAST(1 + l_suppkey % 2 AS BIGINT) AS VendorID, pu AS tpep_pickup_datetime,
        CASE WHEN {_hm(101)} = 0 THEN NULL ELSE (pu + to_seconds(CAST(secs AS BIGINT))) END AS tpep_dropoff_datetime,
        CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber % 6 AS DOUBLE) END AS passenger_count,
        CAST(dist AS DOUBLE) AS trip_distance, CAST(1 + l_partkey % 265 AS BIGINT) AS PULocationID,
        CAST(1 + (l_suppkey*31) % 265 AS BIGINT) AS DOLocationID, l_extendedprice AS fare_amount FROM tr_d)"""

# total order of raw trips (all columns; NULLs first as in Spark)
RAW_ORDER = ("tpep_pickup_datetime NULLS FIRST, tpep_dropoff_datetime NULLS FIRST, VendorID, "
             "PULocationID, DOLocationID, trip_distance, passenger_count NULLS FIRST, fare_amount")


def dur(p: str = "tpep_pickup_datetime", d: str = "tpep_dropoff_datetime") -> str:
    return f"(CAST(epoch_us({d}) - epoch_us({p}) AS DOUBLE) / 1e6)"


def holiday(d: str) -> str:
    """US federal holiday rule on a DATE expression, DuckDB isodow (Mon=1)."""
    iso = {1: 7, 2: 1, 5: 4, 6: 5, 7: 6}  # spark dayofweek -> isodow
    parts = []
    for m, day, y0 in FIXED_HOLIDAYS:
        parts.append(f"(month({d}) = {m} AND day({d}) = {day} AND year({d}) >= {y0})")
        parts.append(f"(isodow({d}) = 5 AND month({d} + 1) = {m} AND day({d} + 1) = {day} AND year({d} + 1) >= {y0})")
        parts.append(f"(isodow({d}) = 1 AND month({d} - 1) = {m} AND day({d} - 1) = {day} AND year({d} - 1) >= {y0})")
    for m, dow, nth, y0 in WEEKDAY_HOLIDAYS:
        which = (f"day({d}) > day(last_day({d})) - 7" if nth == -1
                 else f"floor((day({d}) - 1) / 7) = {nth - 1}")
        parts.append(f"(month({d}) = {m} AND isodow({d}) = {iso[dow]} AND {which} AND year({d}) >= {y0})")
    return "CAST((" + " OR ".join(parts) + ") AS INTEGER)"


def _rd(expr: str, digits: int | None) -> str:
    return expr if digits is None else f"round({expr}, {digits})"


def feature_select(ts: str = "tpep_pickup_datetime", full: bool = True, digits: int | None = None) -> str:
    hour = f"CAST(hour({ts}) AS INTEGER)"
    wd = f"CAST(isodow({ts}) - 1 AS INTEGER)"
    cols = [f"{hour} AS pickup_hour", f"{wd} AS pickup_weekday"]
    if full:
        cols += [
            f"CAST(day({ts}) AS INTEGER) AS pickup_day",
            f"CAST(month({ts}) AS INTEGER) AS pickup_month",
            f"CAST(year({ts}) AS INTEGER) AS pickup_year",
            f"CAST({wd} >= 5 AS INTEGER) AS is_weekend",
            f"CAST({hour} BETWEEN 7 AND 10 AND {wd} < 5 AS INTEGER) AS is_morning_rush",
            f"CAST({hour} BETWEEN 16 AND 19 AND {wd} < 5 AS INTEGER) AS is_evening_rush",
            f"CAST({hour} >= 22 OR {hour} <= 6 AS INTEGER) AS is_night",
            f"{holiday(f'CAST({ts} AS DATE)')} AS is_holiday",
            f"CAST(date_diff('day', DATE '1970-01-01', CAST({ts} AS DATE)) AS BIGINT) AS date_int",
            f"{_rd(f'sin(2*pi()*dayofyear({ts})/365.25)', digits)} AS sin_time",
            f"{_rd(f'cos(2*pi()*dayofyear({ts})/365.25)', digits)} AS cos_time",
        ]
    return ", ".join(cols)


CLEAN_BASE = f"""
 tc_v AS (SELECT VendorID, tpep_pickup_datetime, passenger_count, trip_distance, PULocationID, DOLocationID,
        tpep_dropoff_datetime FROM trips_raw
        WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND trip_distance > 0),
 tc_d AS (SELECT *, {dur()} AS trip_duration FROM tc_v),
 tc_o AS (SELECT * FROM tc_d WHERE trip_duration BETWEEN {S.MIN_DURATION_S} AND {S.MAX_DURATION_S}
        AND trip_distance BETWEEN {S.MIN_DISTANCE_MI} AND {S.MAX_DISTANCE_MI}
        AND trip_distance / (trip_duration / 3600.0) BETWEEN {S.MIN_SPEED_MPH} AND {S.MAX_SPEED_MPH}),
 trips_clean AS (SELECT VendorID, tpep_pickup_datetime, COALESCE(passenger_count, 1.0) AS passenger_count,
        trip_distance, PULocationID, DOLocationID, tpep_dropoff_datetime, trip_duration FROM tc_o)"""

TRIPS_FEATURES = """
 trips_feat AS (SELECT VendorID, passenger_count, trip_distance, PULocationID, DOLocationID, trip_duration,
        {feats} FROM trips_clean)""".format(feats=feature_select())


TRIPS_FEATP = """
 trips_featp AS (SELECT *, {feats} FROM trips_clean)""".format(feats=feature_select())

# --- fixed values: the congruential mix (same as the Spark sampler) --------
_MOD, _MUL, _INC = 2147483648, 1103515245, 12345


def _step(x: str) -> str:
    return f"(({x}) * {_MUL} + {_INC}) % {_MOD}"


def _pmod(x: str) -> str:
    return f"(((({x}) % {_MOD}) + {_MOD}) % {_MOD})"


TRIP_KEY_PARTS = [
    "COALESCE(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', tpep_pickup_datetime), 0)",
    "COALESCE(PULocationID, 0)", "COALESCE(DOLocationID, 0)", "COALESCE(VendorID, 0)",
    "COALESCE(CAST(floor(trip_distance * 100) AS BIGINT), 0)",
]


def mix(seed: int, parts: list[str] = TRIP_KEY_PARTS) -> str:
    h = _step(_pmod(str(seed)))
    for p in parts:
        h = _step(_pmod(f"{h} + {p}"))
    return h


def below(seed: int, fraction: float, parts: list[str] = TRIP_KEY_PARTS) -> str:
    """The draw that keeps a fraction of the rows."""
    return f"({mix(seed, parts)}) < {fraction * _MOD}"


def with_ctes(*blocks: str) -> str:
    return "WITH " + ",".join(b.strip("\n") for b in blocks) + "\n"


BASE = with_ctes(TRIPS_RAW, CLEAN_BASE, TRIPS_FEATURES)


def r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"
