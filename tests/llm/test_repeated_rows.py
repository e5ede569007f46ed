"""Nearest vectors where rows are repeated or ids are shared."""

import numpy as np
from pyspark.sql import functions as F

from postloom.llm import ann


def test_repeated_rows_take_no_neighbour(spark):
    x = np.random.default_rng(5).standard_normal((60, 8)).astype("f4")
    once = [(i, v.tolist()) for i, v in enumerate(x)]
    other = (0, x[30].tolist())  # another vector of id 0
    more = once + [once[0]] * 4 + [once[i] for i in range(1, 60)] + [other]
    near = lambda rows: ann.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), F.col("vec_id") == 0).collect()
    key = lambda r: (r["rank"], r.vec_id, round(r.score, 9))
    assert sorted(map(key, near(more))) == sorted(map(key, near(once) + near([other] + once[1:])))
    assert len(near(more)) == 10
