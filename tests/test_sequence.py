import numpy as np
import pandas as pd

from tripcast.operators.sequence import batch_numbers, dense_sequence


def test_dense_sequence_matches_rank(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.integers(0, 20, 3000), "b": rng.normal(size=3000)})
    pdf["a"] = pdf["a"].astype("int64")
    got = dense_sequence(spark.createDataFrame(pdf), ["a", "b"]).toPandas()
    exp = pdf.sort_values(["a", "b"]).reset_index(drop=True)
    got = got.sort_values("seq").reset_index(drop=True)
    assert list(got["seq"]) == list(range(3000))
    assert np.allclose(got["b"], exp["b"])


def test_batch_numbers(spark):
    pdf = pd.DataFrame({"f": [0] * 25 + [1] * 7, "k": list(range(25)) + list(range(7))})
    got = batch_numbers(spark.createDataFrame(pdf), "f", ["k"], 10).toPandas()
    sizes = got.groupby(["f", "batch_no"]).size().to_dict()
    assert sizes == {(0, 0): 10, (0, 1): 10, (0, 2): 5, (1, 0): 7}
