"""Shared helpers."""

from __future__ import annotations

import pytest

from slipstream.llm.common import packed, semi_join, unpacked


@pytest.mark.parametrize("most", [25, 12, 3])
def test_semi_join(spark, most):
    rows = spark.range(5_000).selectExpr("id % 4000 as k", "id")
    keys = spark.createDataFrame([(i,) for i in [*range(0, 4_000, 7), 3, 3, 9_999, None]], "k long")
    assert sorted(r.id for r in semi_join(rows, keys, "k", most).collect()) == [
        i for i in range(5_000) if (i % 4_000) % 7 == 0 or i % 4_000 == 3
    ]
    assert semi_join(rows, keys.limit(0), "k", most).count() == 0


def test_packed_columns_come_back(spark):
    rows = spark.createDataFrame([(1, "t", 2, "x")], "doc_id long, text string, _other int, `a.b` string")
    again = packed(rows, ("text",)).select(*unpacked(rows.columns, ("text",)))
    assert again.columns == rows.columns and again.collect() == rows.collect()
