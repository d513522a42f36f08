"""Every registered query agrees with its SQL on the smallest tables."""

from pathlib import Path

import pytest
from compare import difference

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the given tables are absent")


def test_the_flagship_query_gives_verdicts(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and {"asset", "success"} <= set(rows[0].asDict())


OWN = sorted(name for name, build in entry_points.queries().items()
             if not build.__wrapped__.__module__.startswith(("landfall.llm", "corpus_pipeline")))


def test_every_query_has_its_sql():
    assert set(OWN) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, name):
    assert difference(
        spark, SF_DIR, entry_points.queries()[name], entry_points.oracle_sql()[name]
    ) is None
