"""Every registered query beside its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check
from tidewell import oracles
from tidewell import queries as registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


def test_every_query_has_a_counterpart():
    assert set(registry.queries()) == set(oracles.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["user_id", "date", "recovery_score", "recovery_state"] and df.count() > 0


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_matches_sql(spark, duck, name):
    outcome = check.compare(spark, duck, SF, name)
    assert outcome.startswith("ok") and "types" not in outcome, outcome
