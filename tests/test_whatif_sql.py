"""The what-if reports in their order of rows, which the comparison with SQL does not see."""

from __future__ import annotations

import __spark_entry__ as entry


def test_sheet_is_sorted(spark, small):
    rows = entry.queries()["q25_sheet_scenario_summary"](spark, small).collect()
    assert rows and rows == sorted(rows, key=lambda r: (r["Route"], r["Schedule"]))


def test_one_best_row_and_text_per_scenario(spark, small):
    best = {r.scenario_id: r for r in entry.queries()["w11_best_strategy"](spark, small).collect()}
    text = {r.scenario_id: r.narrative for r in entry.queries()["x5_narrative"](spark, small).collect()}
    assert set(best) == set(text)
    assert all(text[i].endswith(r.Recommendation) for i, r in best.items())
