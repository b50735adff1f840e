"""Queries whose SQL asks for every NULL = NULL pair: no limit that nobody set refuses them."""

import pytest

from core_helpers import SF0001, rows
from shopfloor.operators import integrate
from shopfloor.plans import catalog, pipeline, reports
from shopfloor.streaming import incremental

REFUSE = integrate.refuse_null_pairs


@pytest.fixture
def refusing(monkeypatch):
    """Any limit that is still set allows no pair at all."""
    def refuse(pairs, limit):
        assert pairs > 0
        REFUSE(pairs, limit and 0)

    for module in (pipeline, incremental):
        monkeypatch.setattr(module, "refuse_null_pairs", refuse)
    monkeypatch.setattr(pipeline, "PAIRS_PER_TASK", 0)          # so that they are counted
    for memo in ("_PLANS", "_RUNS"):
        monkeypatch.setattr(catalog, memo, {})


def test_published_tables_hold_all_pairs(spark, refusing):
    want = pipeline.from_sf_dir(spark, SF0001)
    assert rows(catalog.REGISTRY["line_pass_rate"].run(spark, SF0001)) == rows(
        reports.line_pass_rate(reports.Tables(None, want.checks, None)))
    assert catalog._published(spark, SF0001).readings.count() == want.joined.count()


def test_streamed_readings_hold_all_pairs(spark, refusing):
    """defect_alerts streams them alike."""
    want = reports.round_doubles(pipeline.from_sf_dir(spark, SF0001).summary)
    got = catalog.REGISTRY["stream_hourly_summary"].run(spark, SF0001)
    assert rows(got.select(*want.columns)) == rows(want)


def test_deliveries_hold_all_pairs(spark, refusing):
    """incremental_load and incremental_report read what the same deliveries left."""
    want = pipeline.from_sf_dir(spark, SF0001).readings
    got = catalog.REGISTRY["incremental_readings"].run(spark, SF0001)
    assert rows(got.select(*want.columns)) == rows(want)
