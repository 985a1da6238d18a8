from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from roadloom.operators import stats


def test_quota_and_sample_as_in_the_reference(spark):
    r = np.random.default_rng(3)
    data = {"big": np.concatenate([r.normal(0, 1, 900), r.normal(9, 0.2, 25)]), "fits": np.concatenate([r.normal(0, 1, 190), [30.0, 31.0]])}
    rows = [(k, float(x), i) for k, v in data.items() for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "key string, x double, row long")
    for power in (1.0, 2.0):
        got = {(q.key, q.bin): (q.n, q.quota) for q in stats.density_quota(df, "key", "x", 40, 200, power).collect()}
        for k, v in data.items():
            counts, _ = np.histogram(v, bins=40)
            share = counts.astype(float) ** power
            take = counts if len(v) <= 200 else np.minimum(counts, np.round(share / share.sum() * 200).astype(int))
            for b in np.flatnonzero(counts):
                assert got[k, int(b)] == (counts[b], take[b])
    taken = stats.density_sample(df, "key", "x", "row", F.xxhash64("row"), 40, 200)
    sizes = Counter(x.key for x in taken.collect())
    assert sizes["fits"] == 192 and abs(sizes["big"] - 200) <= 20
    assert taken.where("key = 'big' and x > 8").count() > 0  # a rare lane stays in the sample
