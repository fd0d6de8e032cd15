from __future__ import annotations

import collections

from pyspark.sql import functions as F

from logtally.llm import common


def test_hot_keys_are_dealt_out_by_their_count(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 50)
    monkeypatch.setattr(common, "HOT_KEYS", 400)
    keys = ["hot"] * 9000 + [None] * 4000 + ["warm"] * 60 + ["cold"] * 10 + ["alone"]
    left = spark.createDataFrame(list(enumerate(keys)), "id bigint, key string")
    right = spark.createDataFrame([("hot", 1), (None, 2), ("warm", 3), ("cold", 4), ("unused", 5)], "key string, value int")
    counts = left.groupBy("key").count().withColumnRenamed("count", "n")
    value = {"hot": 1, None: 2, "warm": 3, "cold": 4}
    for how in ("inner", "left"):
        joined = common.join_hot(left, right, ["key"], counts, ["id"], how)
        assert joined.columns == ["id", "key", "value"]
        found = sorted((r["id"], r["value"]) for r in joined.collect())
        assert found == [(k, value.get(key)) for k, key in enumerate(keys) if how == "left" or key in value]
    # 9,000 rows in parts of 50 are more parts than any fixed number of a few dozen.
    assert collections.Counter(keys)["hot"] / 50 > 64
    empty = common.join_hot(left.limit(0), right, ["key"], counts.limit(0), ["id"])
    assert empty.count() == 0


def test_a_counted_right_side_is_joined_once(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 50)
    monkeypatch.setattr(common, "HOT_KEYS", 400)
    keys = ["hot"] * 9000 + [None] * 4000 + ["warm"] * 51 + ["cold"] * 50
    left = spark.createDataFrame(list(enumerate(keys)), "id bigint, key string")
    counts = left.groupBy("key").count().withColumnRenamed("count", "n")
    value = {"hot": 1, None: 2, "warm": 3, "cold": 4}
    right = counts.join(spark.createDataFrame(list(value.items()), "k string, value int"), counts["key"].eqNullSafe(F.col("k"))).drop("k").checkpoint()
    joined = common.join_hot(left, right, ["key"], counts, ["id"], counted=True)
    assert joined.columns == ["id", "key", "value"]
    assert sorted((r["id"], r["value"]) for r in joined.collect()) == [(k, value[key]) for k, key in enumerate(keys)]
    # The hot keys' parts are joined to the left side only.
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2
