from __future__ import annotations

from pathlib import Path

from logtally.functions.literal import literal_rows
from logtally.session import shared_folder, shared_root, tune

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_tune_leaves_a_value_of_the_users_own(spark):
    before = spark.conf.get(LIMIT)
    try:
        spark.conf.unset(LIMIT)
        assert tune(spark).conf.get(LIMIT) == "8000"
        spark.conf.set(LIMIT, "12345")
        assert tune(spark).conf.get(LIMIT) == "12345"
    finally:
        spark.conf.set(LIMIT, before)


def test_shared_folders_lie_below_the_folder_the_session_names(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != two and Path(one).parent == Path(two).parent == Path(root)


def test_literal_rows_are_part_of_the_plan(spark):
    rows = literal_rows(spark, "n, name", [(1, "one"), (2, "")])
    assert [tuple(r) for r in rows.collect()] == [(1, "one"), (2, "")]
    assert "ExistingRDD" not in rows._jdf.queryExecution().executedPlan().toString()
