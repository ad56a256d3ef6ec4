"""Queries that take silver part by part decode the messages once."""

import pytest

from lakeride.plans import catalog as C
from lakeride.plans import catalog_tables as CT


@pytest.fixture
def decoded_rows(spark, monkeypatch):
    """Rows that came out of the decode, counted as they pass."""
    seen = spark.sparkContext.accumulator(0)

    def counted(session, d):
        def run(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        rows = C.silver(session, d)
        return rows.mapInArrow(run, rows.schema)

    monkeypatch.setattr(CT, "silver", counted)
    return seen


def _rows(spark, sf0001, name):
    return C.CATALOG[name](spark, sf0001).collect()


def test_compaction(spark, sf0001, decoded_rows):
    n = C.silver(spark, sf0001).count()
    for i, name in enumerate(("compact", "compact_dates"), 1):
        assert len(_rows(spark, sf0001, name)) == n
        assert decoded_rows.value == i * n


def test_hourly_gold_from_states(spark, sf0001, decoded_rows):
    assert len(_rows(spark, sf0001, "hourly_gold_from_states")) == len(_rows(spark, sf0001, "hourly_gold")) > 0
    assert decoded_rows.value == C.silver(spark, sf0001).count()


def test_dq_results_from_states(spark, sf0001, decoded_rows):
    assert sorted(map(str, _rows(spark, sf0001, "dq_results_from_states"))) == sorted(map(str, _rows(spark, sf0001, "dq_results")))
    assert decoded_rows.value == C.silver(spark, sf0001).count()
