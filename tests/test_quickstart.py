"""The README quick start as a test: train from trip files with file-position
batches, save, load, serve one JSON request."""

import json

from pyspark.sql import functions as F

from tripcast.operators import hybrid as H
from tripcast.operators.clean import standardize_columns
from tripcast.schema import GBT_GRID
from tripcast.session import scratch_path
from tripcast.sources.requests import parse_requests
from tripcast.sources.trips import scan_trips, trips_raw_path, with_batch_ids


def test_train_from_files_and_serve(spark):
    trip_dir = trips_raw_path(spark, "/root/testdata/sf0.001")
    raw = with_batch_ids(standardize_columns(scan_trips(spark, trip_dir)), batch_size=500)
    year = F.year("tpep_pickup_datetime")
    model_path = scratch_path(spark, "qs-model")
    runs = H.train_and_evaluate(raw.filter(year < 2000), raw.filter(year == 2000),
                                ["file_no", "batch_in_file"],
                                GBT_GRID[:2], model_path=model_path, max_rounds=2, final_rounds=2)
    assert len(runs) == 3 and runs[-1]["final"] is True and runs[-1]["n"] > 0
    serve = H.serving_pipeline(H.load_model(model_path))
    body = json.dumps({"data": [{"VendorID": 1, "tpep_pickup_datetime": "2000-03-15 08:20:00",
                                 "passenger_count": 1, "trip_distance": 2.5,
                                 "PULocationID": 100, "DOLocationID": 200}]})
    rows = parse_requests(spark.createDataFrame([(body,)], "body string"))
    out = serve.transform(rows.filter("is_valid").drop("is_valid")).select("duration_minutes").collect()
    assert len(out) == 1 and 0 < out[0][0] < 180
