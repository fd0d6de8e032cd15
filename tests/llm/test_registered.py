from __future__ import annotations

import __spark_entry__ as entry_points
from logtally.llm.common import map_batches


def test_every_corpus_query_is_registered():
    names = entry_points.queries().keys()
    assert {int(name[2:].split("_")[0]) for name in names if name.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names


def test_map_batches_keeps_every_row(spark):
    found = map_batches(spark.range(2500), lambda batches: batches, "id bigint").collect()
    assert sorted(r["id"] for r in found) == list(range(2500))
