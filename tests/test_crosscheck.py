"""Every registered query against its SQL twin on the smallest data set."""

from concurrent.futures import ThreadPoolExecutor

import crosscheck
import pytest

import __spark_entry__ as entry
from gridvoice.plans import registry

DIRECTORY = "/root/testdata/sf0.001"
QUERIES = dict(registry.QUERIES)
ORACLES = registry.oracles()


@pytest.fixture(scope="module")
def outcomes(spark):
    """All comparisons; a few queries run side by side to use the local cores."""
    duck = crosscheck.duck(DIRECTORY)

    def check(name):
        try:
            return crosscheck.compare(spark, duck.cursor(), name, QUERIES[name], ORACLES[name], DIRECTORY)
        except Exception as exc:  # reported by the test of this query
            return False, -1, 0.0, f"{type(exc).__name__}: {exc}"

    with ThreadPoolExecutor(4) as pool:
        return dict(zip(QUERIES, pool.map(check, QUERIES)))


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(outcomes, name):
    ok, _, _, note = outcomes[name]
    assert ok, note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["region", "type_reclamation"]
