"""The driver contract on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tools.compare import compare, connect

QUICK = [
    "delay_whatif_grid", "flatten_nested", "describe_quartiles_by_group", "boxplot_stats", "f1_threshold_sweep", "roc_auc",
    "tfidf_long", "padded_sequences", "access_decision", "resident_snapshot", "stream_dedup", "html_fields_fallback",
]


def test_flagship(spark):
    assert contract.entry(spark).count() == 50


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUICK)
def test_same_as_sql(spark, folder, name):
    note, _, good = compare(spark, connect(folder), folder, name)
    assert good, note
