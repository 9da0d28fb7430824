"""Mergeable profiles: the stated errors, and that merging changes neither."""

import random

from pyspark.sql import functions as F

from sievelake.operators import sketches as Q
from sievelake.scratch import materialize


def test_profiles_keep_their_error_when_merged(spark):
    rng = random.Random(1)
    rows = [(i % 40, int(rng.paretovariate(1) * 100), rng.randrange(20000)) for i in range(60000)] + [(1, None, None), (99, None, 7)]
    df = spark.createDataFrame(rows, "part int, v long, k long")
    kept = materialize(Q.profiles(df, ["part"], "v", "k"), "profiles")
    assert kept.count() == 41 and kept.select(F.max(F.length("quantiles") + F.length("keys"))).first()[0] < 60000
    shares = {"a": 0.1, "b": 0.5, "c": 0.99}
    for parts in (range(40), range(0, 40, 7)):
        found = Q.merged(kept.where(F.col("part").isin(list(parts))).withColumn("all", F.lit(1)), ["all"], shares).first()
        mine = [r for r in rows if r[0] in parts and r[1] is not None]
        assert found["n"] == len(mine)
        for name, q in shares.items():
            low, high = sum(v < found[name] for _, v, _ in mine), sum(v <= found[name] for _, v, _ in mine)
            assert low / len(mine) - 0.015 <= q <= high / len(mine) + 0.015
        keys = len({k for _, _, k in mine})
        assert abs(found["n_keys"] - keys) <= 0.08 * keys
    assert Q.merged(kept.where("part = 99"), ["part"], shares).count() == 0
