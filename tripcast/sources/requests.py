"""Scoring requests (S7) and prediction output.

A request body is JSON ``{"data": [ {column: value, ...}, ... ]}``.  Parsing
is ``from_json`` with a declared schema plus ``explode_outer`` -- native,
row-local, no Python.  A body that does not have the ``data`` list, or an
element that lacks a required column or has an unreadable pickup time, is
not an error for the whole job: it comes out with ``is_valid = false`` so
the caller can route it to a reject output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast import schema as S
from tripcast.operators.clean import parse_request_timestamps

BODY_SCHEMA = T.StructType([T.StructField("data", T.ArrayType(S.REQUEST_ROW_SCHEMA))])
REQUIRED = [S.VENDOR, S.PICKUP, S.DISTANCE, S.PU_ZONE, S.DO_ZONE]


def request_bodies(trips: DataFrame) -> DataFrame:
    """One body per trip (pickup as text, no dropoff).  Trips without a
    passenger count get a body without ``data`` -- a malformed request."""
    row = F.struct(F.col(S.VENDOR), F.date_format(S.PICKUP, "yyyy-MM-dd HH:mm:ss").alias(S.PICKUP),
                   F.col(S.PASSENGERS), F.col(S.DISTANCE), F.col(S.PU_ZONE), F.col(S.DO_ZONE))
    good = F.to_json(F.struct(F.array(row).alias("data")))
    return trips.select(F.when(F.col(S.PASSENGERS).isNull(), F.lit('{"invalid_field":"test"}'))
                         .otherwise(good).alias("body"))


def parse_requests(bodies: DataFrame, body_col: str = "body", carry: tuple[str, ...] = ()) -> DataFrame:
    """Body text -> one row per requested trip, with ``is_valid``.  With
    ``carry`` columns (a request id) each row keeps them and its ``position``
    in the body, so results can go back to their request in order."""
    rows = bodies.select(*carry, F.posexplode_outer(F.from_json(F.col(body_col), BODY_SCHEMA)["data"]).alias("position", "r"))
    rows = rows.select(*carry, "position", *[F.col("r")[f.name].alias(f.name) for f in S.REQUEST_ROW_SCHEMA.fields])
    rows = parse_request_timestamps(rows)
    ok = F.lit(True)
    for c in REQUIRED:
        ok = ok & F.col(c).isNotNull()
    rows = rows.withColumn("is_valid", ok)
    return rows if carry else rows.drop("position")


def predictions_body(scored: DataFrame, order_col: str, value_col: str = "duration_minutes",
                     request_cols: tuple[str, ...] = ()) -> DataFrame:
    """``{"predictions": [...]}`` in request order, one row per request:
    a group holds one request's rows.  Without ``request_cols`` ``scored`` is
    one request; write larger outputs as parquet instead."""
    arr = F.sort_array(F.collect_list(F.struct(F.col(order_col), F.col(value_col))))
    return scored.groupBy(*request_cols).agg(
        F.to_json(F.struct(F.transform(arr, lambda s: s[value_col]).alias("predictions"))).alias("body"))


def prediction_pages(scored: DataFrame, request_cols: tuple[str, ...], position_col: str, page_rows: int,
                     value_col: str = "duration_minutes") -> DataFrame:
    """S8 for requests of any size: one ``{"predictions": [...]}`` per page of
    ``page_rows`` rows of a request, by the rows' position in it (from 0), so
    no task holds more of a request than a page.  The pages of a request in
    order are its answer in order."""
    paged = scored.withColumn("page", F.floor(F.col(position_col) / page_rows).cast("long"))
    return predictions_body(paged, position_col, value_col, (*request_cols, "page"))
